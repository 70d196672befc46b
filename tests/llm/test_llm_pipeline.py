from pathlib import Path

import duckdb
import pytest
from llm_cases import ROWS, edge_docs
from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from normwatch.llm.catalog import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


def test_stages_in_order():
    assert [name for name, _ in pipeline.STAGES] == [
        "quality_classifier",
        "exact_dedup",
        "simhash_near_dedup",
        "mixing",
        "byte_bpe",
    ]


def test_stages_keep_the_columns_and_act(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    counts = [docs.count()]
    for name, stage in pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns, name
        docs = pipeline.stored(out, name)
        counts.append(docs.count())
    assert counts[0] > counts[1] > counts[2] >= counts[3] <= counts[4]
    once = docs.dropDuplicates(["doc_id"])
    assert once.count() == counts[3]
    plain = F.regexp_replace("text", r"[\x20\x09-\x0D]", "")
    assert once.select(plain).distinct().count() == counts[3]
    encoded = pipeline.STAGES[-1][1](spark, docs, SF)
    same = encoded.join(docs.distinct(), "doc_id").where(F.col("decoded") == F.col("text").cast("binary"))
    assert same.count() == counts[4]


def test_edge_rows_go_through(spark, tmp_path):
    # Only the first stage needs labels; without any it keeps all rows.
    edge_docs(spark).write.parquet(str(tmp_path / "documents.parquet"))
    empty = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    empty.write.parquet(str(tmp_path / "labels.parquet"))
    rows = pipeline.run(spark, str(tmp_path)).collect()
    texts = {i: t or "" for i, t, _ in ROWS}
    assert rows and all(bytes(r["decoded"]).decode() == texts[r["doc_id"]] for r in rows if r["doc_id"])


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, name):
    connection = duckdb.connect()
    for file in Path(SF).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    want = connection.execute(ORACLES[name])
    columns = [c[0] for c in want.description]
    got = QUERIES[name](spark, SF)
    assert sorted(got.columns) == sorted(columns)
    rows = [tuple(r) for r in got.select(*columns).collect()]
    assert sorted(rows, key=str) == sorted(want.fetchall(), key=str)


CONTRACT = {
    "op1_quality": "doc_id bigint, held_out boolean, score double, predicted int",
    "op2_nn_descent": "query_id bigint, rank int, vec_id bigint, score double",
    "op3_lpt_sharding": "doc_id bigint, size bigint, text_crc32 bigint, law string, shard int, slot bigint, grown_shard int",
    "op4_simhash": "doc_id bigint, fingerprint string, component_id bigint",
    "op5_byte_bpe": "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string",
    "op6_token_counts": "doc_id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean",
    "op7_exact_dedup": "doc_id bigint, keep_id bigint, group_size bigint, kept boolean, text_sha256 string",
}


@pytest.mark.parametrize("name", sorted(CONTRACT))
def test_columns_of_the_contract(spark, name):
    got = QUERIES[name](spark, SF)
    assert [f"{c} {t}" for c, t in got.dtypes] == CONTRACT[name].split(", ")
    if name != "op2_nn_descent":
        assert got.count() == spark.read.parquet(f"{SF}/documents.parquet").count()
