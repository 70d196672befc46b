"""Rows that every operator has to cope with."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

WORDS = "thion ater the of hand onre, ist and er bleou thanst inwh edly resh it to".split()


def prose(seed, n):
    import random

    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + rng.choice(["", "a", "en", "or"]) for _ in range(n))


LONG = prose(1, 60_000)
ROWS = [
    (1, prose(2, 80), "a"),
    (2, prose(2, 80), "a"),
    (3, prose(2, 80) + "\n", "b"),
    (4, "", "a"),
    (5, None, None),
    (6, "  \t\x0b\x0c\r\n ", "b"),
    (7, LONG, "a"),
    (8, "One", "c"),
    (8, "One", "c"),
    (9, "Éa ß 漢字 🙂", None),
    (10, prose(3, 120), "a"),
    (None, prose(3, 120), "b"),
    (None, None, None),
    (11, "a a a a a a a a a a a a a a", "c"),
    (12, prose(2, 79) + " other", "a"),
]
SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("source", T.StringType()),
    ]
)
# Names that operators use inside, or return.
CLASHES = ["row", "digest", "batch", "fp", "shard", "score", "kept", "ids", "id", "size", "node", "label"]


def edge_docs(spark):
    rows = spark.createDataFrame(ROWS, SCHEMA)
    lang = F.when(F.col("doc_id") % 2 == 0, "en")
    rows = rows.withColumn("lang", lang).withColumn("n_chars", F.length("text").cast("long"))
    for name in CLASHES:
        rows = rows.withColumn(name, F.lit(f"own {name}"))
    return rows.repartition(3)


def no_docs(spark):
    return edge_docs(spark).where("false")


def texts_of(rows=ROWS):
    return [(i, t or "") for i, t, _ in rows]
