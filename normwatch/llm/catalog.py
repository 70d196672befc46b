"""The queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from normwatch.llm.alignment import op13_tokenizer_alignment
from normwatch.llm.bpe import op5_byte_bpe
from normwatch.llm.decontamination import OP11_SQL, op11_decontamination
from normwatch.llm.exact_dedup import OP7_SQL, op7_exact_dedup
from normwatch.llm.mixing import op10_temperature_mixing
from normwatch.llm.nn_descent import op2_nn_descent
from normwatch.llm.quality import op1_quality
from normwatch.llm.sharding import op3_lpt_sharding
from normwatch.llm.simhash import op4_simhash
from normwatch.llm.substrings import op9_substring_dedup
from normwatch.llm.token_counts import op6_token_counts
from normwatch.llm.variants import op12_spelling_variants
from normwatch.llm.warc import OP8_SQL, op8_warc_revisits

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_quality,
        op2_nn_descent,
        op3_lpt_sharding,
        op4_simhash,
        op5_byte_bpe,
        op6_token_counts,
        op7_exact_dedup,
        op8_warc_revisits,
        op9_substring_dedup,
        op10_temperature_mixing,
        op11_decontamination,
        op12_spelling_variants,
        op13_tokenizer_alignment,
    )
}
ORACLES: dict[str, str] = {
    "op7_exact_dedup": OP7_SQL,
    "op8_warc_revisits": OP8_SQL,
    "op11_decontamination": OP11_SQL,
}
