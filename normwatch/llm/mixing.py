"""Temperature mixing of sources, realised as budgeted block permutations.

Weights are token shares raised to an exponent and normalised.  The exponent is found by bisection,
so that the entropy of the weights meets a target or no source is repeated more often than a limit.

Each source then gets a token budget, made of full passes and a part of one more.  A source is cut
into blocks of documents by a hash.  Every pass takes the blocks in another permutation; the last
one stops within the block in which the budget ends.  Membership in a pass depends on the row, the
permutation of the blocks and one threshold per source, so texts are never shuffled.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from normwatch.llm.common import bounded_side, same, stored, table
from normwatch.session import literal_table

MAX_REPEATS = 2.0
BLOCK_TOKENS = 1 << 18
# Blocks of one source at most; larger sources get larger blocks.
MOST_BLOCKS = 1 << 16
# Totals per source pass the driver.  More sources than this raise an error.
MOST_SOURCES = 200_000
_STEPS = 200


def tempered(shares: list[float], exponent: float) -> list[float]:
    """Normalised powers of the shares."""
    logs = [exponent * math.log(p) for p in shares]
    top = max(logs)
    powers = [math.exp(x - top) for x in logs]
    total = sum(powers)
    return [x / total for x in powers]


def entropy(weights: list[float]) -> float:
    return -sum(w * math.log(w) for w in weights if w > 0)


def exponent_for_entropy(shares: list[float], target: float, most: float = 64.0) -> float:
    """The exponent at which the weights have the target entropy (nats), by bisection.

    Entropy falls from that of equal weights at 0 as the exponent grows; a target outside what
    0 .. ``most`` reach gives the nearer end.
    """
    low, high = 0.0, most
    for _ in range(_STEPS):
        middle = (low + high) / 2
        if entropy(tempered(shares, middle)) > target:
            low = middle
        else:
            high = middle
    return (low + high) / 2


def exponent_for_repeats(tokens: list[int], limit: float, budget: float | None) -> float:
    """The smallest exponent in 0 .. 1 at which no source is passed more than ``limit`` times."""
    shares = [t / sum(tokens) for t in tokens]
    low, high = 0.0, 1.0
    for _ in range(_STEPS):
        middle = (low + high) / 2
        weights = tempered(shares, middle)
        size = whole_budget(tokens, weights) if budget is None else budget
        if max(w * size / t for w, t in zip(weights, tokens)) > limit:
            low = middle
        else:
            high = middle
    return high


def whole_budget(tokens: list[int], weights: list[float]) -> float:
    """The least budget under which every source is passed at least once."""
    return max(t / w for t, w in zip(tokens, weights))


@dataclass
class Mixture:
    """What each source gets."""

    sources: list[str | None]
    tokens: list[int]
    exponent: float
    weights: list[float]
    budgets: list[int]


def plan_mixture(
    totals: list[tuple[str | None, int]],
    max_repeats: float | None = MAX_REPEATS,
    target_entropy: float | None = None,
    budget: int | None = None,
) -> Mixture:
    """Weights and token budgets from the tokens of each source.

    Give either a target entropy or a repetition limit.  Without a ``budget`` every source is
    passed at least once.  A limit that the budget cannot meet (budget > limit x tokens) gives the
    natural shares.
    """
    totals = sorted(totals, key=lambda s: (s[0] is None, s[0] or ""))
    sources, tokens = [s for s, _ in totals], [t for _, t in totals]
    if not sources:
        return Mixture([], [], 1.0, [], [])
    shares = [t / sum(tokens) for t in tokens]
    if target_entropy is not None:
        exponent = exponent_for_entropy(shares, target_entropy)
    elif max_repeats is not None:
        exponent = exponent_for_repeats(tokens, max_repeats, budget)
    else:
        exponent = 1.0
    weights = tempered(shares, exponent)
    size = whole_budget(tokens, weights) if budget is None else budget
    exact = [w * size for w in weights]
    # Without a budget the source that is passed exactly once must not lose a token to rounding.
    budgets = [int(round(x)) if budget is None else int(x) for x in exact]
    if budget is None:
        budgets = [max(b, t) for b, t in zip(budgets, tokens)]
    else:
        order = sorted(range(len(exact)), key=lambda i: (budgets[i] - exact[i], i))
        for i in order[: budget - sum(budgets)]:
            budgets[i] += 1
    return Mixture(sources, tokens, exponent, weights, budgets)


def words_and_end(text: Column) -> Column:
    """Tokens of a document for mixing: its words, and one for its end."""
    plain = F.coalesce(text.cast("string"), F.lit(""))
    return (F.regexp_count(plain, F.lit(r"[^\x20\x09-\x0D]+")) + 1).cast("long")


def _hash(*parts: Column) -> Column:
    return F.xxhash64(*parts)


@dataclass
class MixPlan:
    """The mixture, and the written tables that say which rows each pass takes."""

    mixture: Mixture
    sources: DataFrame  # m_source, tokens, budget, passes, blocks
    blocks: DataFrame  # b_source, b_block, b_pass, block_rank, before, taken, upto
    seed: int

    def rows(self, keyed: DataFrame) -> DataFrame:
        """``keyed`` (with mix_key and source) once for every pass that takes a row.

        Adds mix_pass, mix_block, mix_rank (place of the block in the pass) and mix_at (share of
        the source's budget that lies before the block).
        """
        placed = self.placed(keyed)
        passes = placed.select(
            "*", F.explode(F.sequence(F.lit(0), F.col("passes") - 1)).alias("mix_pass")
        )
        here = (
            same(F.col("m_source"), F.col("b_source"))
            & (F.col("mix_block") == F.col("b_block"))
            & (F.col("mix_pass") == F.col("b_pass"))
        )
        joined = passes.join(bounded_side(self.blocks, 80), here)
        taken = joined.where(F.col("taken") | (F.col("mix_order") <= F.col("upto")))
        at = (F.col("mix_pass") * F.col("tokens") + F.col("before")) / F.col("budget")
        return taken.select(
            *[F.col(f"`{c}`") for c in keyed.columns],
            "mix_pass",
            "mix_block",
            F.col("block_rank").alias("mix_rank"),
            at.alias("mix_at"),
        )

    def placed(self, keyed: DataFrame) -> DataFrame:
        return _placed(keyed, self.sources, self.seed)


def _placed(keyed: DataFrame, sources: DataFrame, seed: int) -> DataFrame:
    """Adds what the plan knows of the source, the block of the row, and its order in the block."""
    order = _hash(F.col("mix_key"), F.lit(seed))
    joined = keyed.join(
        F.broadcast(sources), same(F.col("source").cast("string"), F.col("m_source"))
    )
    block = F.pmod(_hash(F.col("mix_key"), F.lit(seed + 1)), F.col("blocks"))
    return joined.withColumn("mix_block", block.cast("int")).withColumn("mix_order", order)


def make_plan(
    rows: DataFrame,
    max_repeats: float | None = MAX_REPEATS,
    target_entropy: float | None = None,
    budget: int | None = None,
    seed: int = 1,
    block_tokens: int = BLOCK_TOKENS,
) -> MixPlan:
    """Plan from written rows as ``keyed_rows`` gives them, of at least one token each."""
    spark = rows.sparkSession
    sums = rows.groupBy(F.col("source").cast("string").alias("source")).agg(
        F.sum("n_tokens").alias("t")
    )
    totals = [(r["source"], int(r["t"])) for r in sums.limit(MOST_SOURCES + 1).collect()]
    if len(totals) > MOST_SOURCES:
        raise ValueError(f"more than {MOST_SOURCES} sources; group them first")
    mixture = plan_mixture(totals, max_repeats, target_entropy, budget)
    told = [
        (
            s,
            t,
            b,
            -(-b // t),
            max(1, min(MOST_BLOCKS, -(-t // block_tokens))),
        )
        for s, t, b in zip(mixture.sources, mixture.tokens, mixture.budgets)
    ]
    sources = literal_table(
        spark, told, "m_source string, tokens bigint, budget bigint, passes bigint, blocks bigint"
    )
    placed = _placed(rows, sources, seed)
    sizes = placed.groupBy("m_source", "tokens", "budget", "passes", "mix_block").agg(
        F.sum("n_tokens").alias("n")
    )
    each = sizes.where("passes > 0").select(
        "*", F.explode(F.sequence(F.lit(0), F.col("passes") - 1)).alias("b_pass")
    )
    # Each pass has its own permutation; a pass of a source has at most MOST_BLOCKS blocks.
    each = each.withColumn(
        "shuffled", _hash(F.col("m_source"), F.col("mix_block"), F.col("b_pass"), F.lit(seed))
    )
    over = "over (partition by m_source, b_pass order by shuffled, mix_block)"
    ranked = each.selectExpr(
        "m_source",
        "mix_block",
        "b_pass",
        "n",
        f"row_number() {over} - 1 as block_rank",
        f"sum(n) {over} - n as before",
        "least(tokens, budget - b_pass * tokens) as room",
    )
    ranked = stored(ranked, "blocks")
    # In the block where the budget ends, rows are taken in hash order while there is room.
    cut = ranked.where("before < room and before + n > room").select(
        F.col("m_source").alias("c_source"),
        F.col("mix_block").alias("c_block"),
        F.col("b_pass").alias("c_pass"),
        (F.col("room") - F.col("before")).alias("rest"),
    )
    inside = placed.join(
        F.broadcast(cut),
        same(F.col("m_source"), F.col("c_source")) & (F.col("mix_block") == F.col("c_block")),
    )
    # Rows that share doc_id and text share their place and are taken or left together.
    inside = inside.groupBy("c_source", "c_block", "c_pass", "rest", "mix_order").agg(
        F.sum("n_tokens").alias("n")
    )
    inside = inside.selectExpr(
        "*", "sum(n) over (partition by c_source, c_block, c_pass order by mix_order) as upto_here"
    )
    ends = (
        inside.where("upto_here <= rest")
        .groupBy("c_source", "c_block", "c_pass")
        .agg(F.max("mix_order").alias("upto"))
    )
    blocks = ranked.where("before < room").join(
        ends,
        same(F.col("m_source"), F.col("c_source"))
        & (F.col("mix_block") == F.col("c_block"))
        & (F.col("b_pass") == F.col("c_pass")),
        "left",
    )
    blocks = blocks.select(
        F.col("m_source").alias("b_source"),
        F.col("mix_block").alias("b_block"),
        "b_pass",
        "block_rank",
        "before",
        (F.col("before") + F.col("n") <= F.col("room")).alias("taken"),
        "upto",
    )
    return MixPlan(mixture, sources, stored(blocks, "mix_blocks"), seed)


def _place_key() -> Column:
    """What a row is placed by: its id and its text, so rows without ids are spread too."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return F.xxhash64(F.col("doc_id").cast("long"), text)


def keyed_rows(docs: DataFrame) -> DataFrame:
    """doc_id, mix_key, source and n_tokens of every row, written."""
    return stored(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            _place_key().alias("mix_key"),
            F.col("source").cast("string").alias("source"),
            words_and_end(F.col("text")).alias("n_tokens"),
        ),
        "tokens",
    )


def mix(docs: DataFrame, **options) -> DataFrame:
    """doc_id, source, n_tokens, mix_pass, mix_block, mix_rank and mix_at of every row taken.

    Rows are placed by doc_id and text, so null and repeated ids are spread; rows that share both are
    taken or left together.  Sorted by mix_at the rows are the mixed stream, a block of one source at a time.  A null source
    is a source of its own; a null or empty text counts one token.  Options as in ``make_plan``.
    """
    rows = keyed_rows(docs)
    return make_plan(rows, **options).rows(rows).drop("mix_key")


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` with all their columns, once for each pass that takes them."""
    plan = make_plan(keyed_rows(docs), **options)
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    keyed = docs.select(row, _place_key().alias("mix_key"), F.col("source").alias("source"))
    return plan.rows(keyed).select("row.*")


def op10_temperature_mixing(spark, sf_dir: str) -> DataFrame:
    """All ``documents``, every source at least once and none more than twice."""
    return mix(table(spark, sf_dir, "documents"))
