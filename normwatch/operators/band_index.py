"""Many bands of one system and property, found without comparing each with each observation.

The bounds of a key, sorted, cut the numbers into slots: each bound is one, and each gap between
neighbours.  A band covers a range of slots, which is a few blocks of ``RADIX`` to some power.  An
observation finds its slot by binary search, first among the first bounds of the chunks of its key
and then in one chunk, and meets the bands of the blocks that hold its slot by equality.  So the
join gives matches only, and work for an observation grows with the logarithm of the bands.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from normwatch.operators.joins import spread_join
from normwatch.session import cut_lineage

# Bounds held in one array.
CHUNK = 256
RADIX = 8
_LONG = "long"
# Bands that make a block a full one, whose matches are counted ahead, and matches that one task
# should get of a block.
FULL_BLOCK = 64
BLOCK_MATCHES = 5_000_000


def _count_below(values: Column, value: Column, size: int, or_equal: bool = False) -> Column:
    """How many of the sorted ``values`` (at most ``size``) are less than ``value``."""

    def halved(range_: Column, _: Column) -> Column:
        low, high = range_["low"], range_["high"]
        middle = F.floor((low + high) / 2).cast("int")
        found = F.get(values, middle)
        before = found <= value if or_equal else found < value
        after = F.struct((middle + 1).alias("low"), high.alias("high"))
        upto = F.struct(low.alias("low"), middle.alias("high"))
        return F.when(low >= high, range_).when(before, after).otherwise(upto)

    whole = F.struct(F.lit(0).alias("low"), F.size(values).alias("high"))
    steps = F.sequence(F.lit(1), F.lit(max(size, 1).bit_length()))
    return F.aggregate(steps, whole, halved, lambda range_: range_["low"])


def _run(first: Column, after: Column) -> Column:
    none = F.array().cast("array<long>")
    return F.when(first < after, F.sequence(first, after - 1)).otherwise(none)


def _covering(low: Column, high: Column, levels: int) -> Column:
    """Blocks (level, block) that make up the slots low to high, fewest at the highest levels."""

    def at(level: int) -> Column:
        size, above = RADIX**level, RADIX ** (level + 1)
        first, after = F.ceil(low / size).cast(_LONG), F.floor((high + 1) / size).cast(_LONG)
        if level + 1 == levels:
            blocks = _run(first, after)
        else:
            inner = F.ceil(low / above).cast(_LONG) * RADIX
            outer = F.floor((high + 1) / above).cast(_LONG) * RADIX
            both = F.concat(_run(first, inner), _run(outer, after))
            blocks = F.when(inner < outer, both).otherwise(_run(first, after))
        return F.transform(
            blocks, lambda b: F.struct(F.lit(level).alias("level"), b.alias("block"))
        )

    return F.concat(*[at(level) for level in range(levels)])


class BandIndex:
    """The index of some bands; ``key`` are the columns that observations and bands share the values
    of, and bands have ``minValue`` and ``maxValue``, open where NULL and strict."""

    def __init__(self, bands: DataFrame, key: Sequence[str], full_block: int = FULL_BLOCK):
        self.key = list(key)
        self.names = bands.columns
        line = Window.partitionBy(*self.key).orderBy("bound")
        ends = bands.select(*self.key, F.explode(F.array("minValue", "maxValue")).alias("bound"))
        ends = ends.where("bound is not null").distinct()
        ends = cut_lineage(ends.withColumn("rank", F.row_number().over(line) - 1))
        self.most = (ends.agg(F.max("rank")).first()[0] or 0) + 1
        # Slots 2i + 1 are bounds, those between and around them even.
        self.levels = 1
        while RADIX**self.levels < 2 * self.most + 1:
            self.levels += 1
        chunk = F.floor(F.col("rank") / CHUNK).cast("int").alias("chunk")
        bounds = F.sort_array(F.collect_list("bound")).alias("bounds")
        chunks = ends.groupBy(*self._as("x_"), chunk).agg(bounds)
        self.chunks = cut_lineage(chunks)
        first = F.sort_array(F.collect_list(F.element_at("bounds", 1))).alias("firsts")
        self.firsts = self.chunks.groupBy(*[f"x_{k}" for k in self.key]).agg(first)
        self.firsts = self.firsts.select(
            *[F.col(f"x_{k}").alias(f"y_{k}") for k in self.key], "firsts"
        )
        total = ends.groupBy(*self._as("t_")).agg(F.count("*").alias("total"))
        placed = bands.where("minValue is not null or maxValue is not null")
        placed = spread_join(placed, total, [(k, f"t_{k}") for k in self.key])
        for bound, mark in (("minValue", "lo"), ("maxValue", "hi")):
            rank = ends.select(
                *self._as(f"{mark}_"), F.col("bound").alias(f"{mark}_bound"), F.col("rank").alias(mark)
            )
            on = [(k, f"{mark}_{k}") for k in self.key] + [(bound, f"{mark}_bound")]
            placed = spread_join(placed, rank, on, how="left")
        low = F.coalesce(2 * F.col("lo") + 2, F.lit(0)).cast(_LONG)
        high = F.coalesce(2 * F.col("hi"), 2 * F.col("total")).cast(_LONG)
        covering = F.explode(_covering(low, high, self.levels)).alias("b")
        self.blocks = placed.select(*self.names, covering).select(
            *self.names, F.col("b.level").alias("b_level"), F.col("b.block").alias("b_block")
        )
        full = self.blocks.groupBy(
            *self._as("f_"), F.col("b_level").alias("f_level"), F.col("b_block").alias("f_block")
        ).agg(F.count("*").alias("n_bands"))
        self.full = cut_lineage(full.where(F.col("n_bands") >= full_block))

    def _as(self, mark: str) -> list[Column]:
        return [F.col(k).alias(f"{mark}{k}") for k in self.key]

    def matches(
        self, rows: DataFrame, on: Sequence[str], value: Column, block_matches: int = BLOCK_MATCHES
    ) -> DataFrame:
        """``rows`` with each band of their key (columns ``on``) that ``value`` lies in."""
        kept = rows.columns
        pairs = list(zip(on, self.key))
        valued = rows.withColumn("v_", value.cast("double")).where("v_ is not null")
        known = spread_join(valued, self.firsts, [(a, f"y_{k}") for a, k in pairs])
        n_chunks = -(-self.most // CHUNK)
        before = _count_below(F.col("firsts"), F.col("v_"), n_chunks, or_equal=True)
        # Below the first bound of all, the first chunk has none below either.
        placed = known.withColumn("c_", F.greatest(before - 1, F.lit(0))).select(*kept, "v_", "c_")
        in_chunk = [(a, f"x_{k}") for a, k in pairs] + [("c_", "chunk")]
        held = spread_join(placed, self.chunks, in_chunk)
        below = _count_below(F.col("bounds"), F.col("v_"), CHUNK)
        # NaN equals itself, as elsewhere in Spark.
        at = F.when(F.get("bounds", below) == F.col("v_"), 1).otherwise(0)
        slot = (2 * (F.col("c_") * CHUNK + below) + at).cast(_LONG)
        held = held.select(*kept, slot.alias("slot_"))
        probes = F.array(
            *[
                F.struct(F.lit(k).alias("level"), F.floor(F.col("slot_") / RADIX**k).alias("block"))
                for k in range(self.levels)
            ]
        )
        probed = held.select(*kept, F.explode(probes).alias("p_"))
        probed = probed.select(*kept, F.col("p_.level").alias("l_"), F.col("p_.block").alias("n_"))
        meets = [*pairs, ("l_", "b_level"), ("n_", "b_block")]
        if self.full.isEmpty():
            return spread_join(probed, self.blocks, meets).select(*kept, *self.names)
        found = held.groupBy(*on, "slot_").agg(F.count("*").alias("n_slot"))
        found = found.select(*on, "n_slot", F.explode(probes).alias("p_"))
        found = found.select(*on, "n_slot", F.col("p_.level").alias("l_"), F.col("p_.block").alias("n_"))
        spread = self._spread(found, pairs, block_matches)
        # The rows that meet such a block are dealt over salts, and its bands copied for each.
        at_block = [*[(a, f"s_{k}") for a, k in pairs], ("l_", "s_level"), ("n_", "s_block")]
        plain = [f.name for f in rows.schema if isinstance(f.dataType, T.AtomicType)]
        row_hash = F.xxhash64(F.spark_partition_id(), "slot_", *[F.col(f"`{c}`") for c in plain])
        salted = held.select(*kept, row_hash.alias("h_"), F.explode(probes).alias("p_")).select(
            *kept, "h_", F.col("p_.level").alias("l_"), F.col("p_.block").alias("n_")
        )
        salted = spread_join(salted, spread, at_block, how="left")
        salt = F.pmod("h_", F.coalesce("salts", F.lit(1))).alias("salt_")
        salted = salted.select(*kept, "l_", "n_", salt)
        of_block = [*[(k, f"s_{k}") for k in self.key], ("b_level", "s_level"), ("b_block", "s_block")]
        copied = spread_join(self.blocks, spread, of_block, how="left")
        number = F.explode(F.sequence(F.lit(0).cast(_LONG), F.coalesce("salts", F.lit(1)) - 1))
        copied = copied.select(*self.names, "b_level", "b_block", number.alias("b_salt"))
        return spread_join(salted, copied, [*meets, ("salt_", "b_salt")]).select(*kept, *self.names)

    def _spread(self, found: DataFrame, pairs: list[tuple[str, str]], most: int) -> DataFrame:
        """The blocks (s_ and key, s_level, s_block) with more than ``most`` matches, and over how
        many salts their rows are dealt, so that each gets about so many."""
        on = [*[(a, f"f_{k}") for a, k in pairs], ("l_", "f_level"), ("n_", "f_block")]
        met = spread_join(found, self.full, on)
        names = [F.col(f"f_{k}").alias(f"s_{k}") for k in self.key]
        work = met.groupBy(
            *names, F.col("f_level").alias("s_level"), F.col("f_block").alias("s_block")
        ).agg(F.sum("n_slot").alias("n_rows"), F.max("n_bands").alias("n_bands"))
        salts = F.least("n_rows", F.ceil(F.col("n_rows") * F.col("n_bands") / most))
        return cut_lineage(work.withColumn("salts", salts).where("salts > 1").drop("n_rows", "n_bands"))


def indexed_matches(
    rows: DataFrame, bands: DataFrame, on: Sequence[tuple[str, str]], value: Column, many: int
) -> DataFrame:
    """What a join on equal columns and the bounds gives, by an index for keys of ``many`` bands.

    Keys with fewer bands, and bands open on both sides, are joined plainly.  The bands are counted
    and the index is written when this is called.
    """
    left, right = [a for a, _ in on], [b for _, b in on]
    bands = cut_lineage(bands.dropna(subset=right))
    open_ = F.col("minValue").isNull() & F.col("maxValue").isNull()
    counts = bands.where(~open_).groupBy(*[F.col(b).alias(f"h_{b}") for b in right])
    heavy = cut_lineage(counts.agg(F.count("*").alias("n_bands")).where(F.col("n_bands") >= many))
    of_heavy = [(b, f"h_{b}") for b in right]
    few = spread_join(bands.where(~open_), heavy, of_heavy, how="left_anti")
    several = spread_join(bands.where(~open_), heavy, of_heavy, how="left_semi")
    above = F.col("minValue").isNull() | (value > F.col("minValue"))
    below = F.col("maxValue").isNull() | (value < F.col("maxValue"))
    plain = spread_join(rows, few.unionByName(bands.where(open_)), on, where=above & below)
    index = BandIndex(cut_lineage(several), right)
    return plain.unionByName(index.matches(rows, left, value))
