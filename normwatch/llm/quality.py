"""Quality classifier: a regularised quadratic discriminant over document statistics.

Each text gives a vector of transformed statistics (lengths, shares of characters, repetition).
Class means and covariances come from sums of rows and of their outer products, which Spark adds up
before anything reaches the driver.  Covariances are shrunk towards the pooled one and towards a
multiple of the identity.  The score is the logistic function of the difference of the two
log-densities; Mahalanobis distances use the inverse Cholesky factors, which are computed once and
kept in the model.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from normwatch.llm.common import binary_text, bounded_side, in_arrow, stored, table

# Weight of the pooled covariance, and of the identity, in a class covariance.
POOLED = 0.7
IDENTITY = 0.01
_CLASSES = ("upper", "lower", "digit", "space", "newline", "stop", "exclaim", "mark", "high")


def _byte_classes() -> np.ndarray:
    kinds = {
        "upper": range(65, 91),
        "lower": range(97, 123),
        "digit": range(48, 58),
        "space": (9, 32),
        "newline": (10, 13),
        "stop": b".,;:'\"()-",
        "exclaim": b"!?",
        "high": range(128, 256),
    }
    of = np.full(256, _CLASSES.index("mark"))
    for name, members in kinds.items():
        of[list(members)] = _CLASSES.index(name)
    return np.eye(len(_CLASSES))[of]


_BYTE_CLASSES = _byte_classes()
_EPS = 0.002


def _logit(share: float) -> float:
    return float(np.log((share + _EPS) / (1.0 - share + _EPS)))


def text_statistics(text: bytes) -> list[float]:
    """The statistics of one whole text; all finite, also for an empty one."""
    size = len(text)
    counts = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    shares = (counts @ _BYTE_CLASSES) / max(1, size)
    used = counts[counts > 0] / max(1, size)
    entropy = float(-(used * np.log2(used)).sum())
    words = text.split()
    n = len(words)
    often = Counter(words)
    lengths = np.fromiter(map(len, words), np.int64, n)
    mean = float(lengths.mean()) if n else 0.0
    spread = float(lengths.std()) if n else 0.0
    lines = text.split(b"\n")
    packed = len(zlib.compress(text, 1))
    return [
        np.log1p(size),
        np.log1p(n),
        np.log1p(mean),
        np.log1p(spread),
        _logit(len(often) / n if n else 0.0),
        _logit(max(often.values()) / n if n else 0.0),
        _logit(float((lengths > 14).mean()) if n else 0.0),
        _logit(float((lengths < 4).mean()) if n else 0.0),
        np.log1p(size / len(lines)),
        _logit(len(set(lines)) / len(lines)),
        np.log((packed + 8) / (size + 64)),
        entropy,
        *[_logit(float(s)) for s in shares],
    ]


WIDTH = len(text_statistics(b""))


def _statistics_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        stats = [text_statistics(t) for t in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(stats, pa.list_(pa.float64()))], names=["doc_id", "stats"]
        )


def document_statistics(docs: DataFrame) -> DataFrame:
    """doc_id and stats for every row; a null text counts as empty."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), binary_text().alias("text"))
    return in_arrow(rows, _statistics_batches, "doc_id long, stats array<double>")


def held_out(doc_id: F.Column) -> F.Column:
    """Whether labels of the row are kept from training: crc32 of the id as text, modulo 3, is 1."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 3 == 1


@dataclass
class Discriminant:
    """Per class 0 and 1: mean, inverse Cholesky factor, log-determinant and log prior."""

    means: list[np.ndarray]
    factors: list[np.ndarray]
    logdets: list[float]
    priors: list[float]
    fallback: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Probabilities of class 1, softened by the root of the number of statistics."""
        if not self.factors:
            return np.full(len(x), self.fallback)
        logs = []
        for mean, factor, logdet, prior in zip(self.means, self.factors, self.logdets, self.priors):
            z = (x - mean) @ factor.T
            logs.append(prior - 0.5 * ((z * z).sum(axis=1) + logdet))
        ratio = (logs[1] - logs[0]) / np.sqrt(x.shape[1])
        return 1.0 / (1.0 + np.exp(-np.clip(ratio, -500, 500)))


def _moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        label = batch.column(0).to_numpy()
        x = batch.column(1).flatten().to_numpy().reshape(batch.num_rows, -1)
        x = np.hstack([np.ones((len(x), 1)), x])
        for k in (0, 1):
            own = x[label == k]
            sums[k] = sums.get(k, 0.0) + own.T @ own
    for k, total in sums.items():
        yield pa.RecordBatch.from_arrays(
            [pa.array([k], pa.int32()), pa.array([total.ravel().tolist()], pa.list_(pa.float64()))],
            names=["label", "sums"],
        )


def fit(
    stats: DataFrame, labels: DataFrame, pooled: float = POOLED, identity: float = IDENTITY
) -> Discriminant:
    """Learn from labels (doc_id, quality) of documents with known statistics.

    All labelled rows count; rows of other labels than 0 and 1, and null ids, are ignored; a
    repeated label counts as often as it occurs.  If a class has no row, the model returns the
    smoothed share of class 1 for every text.
    """
    known = labels.where("quality in (0, 1) and doc_id is not null").select(
        F.col("doc_id").cast("long").alias("l_id"), F.col("quality").cast("int").alias("label")
    )
    rows = stats.join(known, F.col("doc_id") == F.col("l_id")).select("label", "stats")
    sums = in_arrow(rows, _moments, "label int, sums array<double>")
    cells = sums.select("label", F.posexplode("sums").alias("cell", "v"))
    total = cells.groupBy("label", "cell").agg(F.sum("v").alias("v")).collect()
    moments = np.zeros((2, (WIDTH + 1) ** 2))
    for cell in total:
        moments[cell["label"], cell["cell"]] = cell["v"]
    moments = moments.reshape(2, WIDTH + 1, WIDTH + 1)
    sizes = moments[:, 0, 0]
    fallback = float((sizes[1] + 1) / (sizes.sum() + 2))
    if sizes.min() < 1:
        return Discriminant([], [], [], [], fallback)
    means = [m[0, 1:] / m[0, 0] for m in moments]
    scatter = [m[1:, 1:] - m[0, 0] * np.outer(a, a) for m, a in zip(moments, means)]
    common = sum(scatter) / max(1.0, sizes.sum() - 2)
    factors, logdets = [], []
    for own, n in zip(scatter, sizes):
        cov = (1 - pooled) * own / max(1.0, n - 1) + pooled * common
        level = max(np.trace(cov) / WIDTH, 1e-6)
        cov = (1 - identity) * cov + identity * level * np.eye(WIDTH)
        lower = np.linalg.cholesky((cov + cov.T) / 2)
        factors.append(np.linalg.inv(lower))
        logdets.append(float(2 * np.log(np.diag(lower)).sum()))
    priors = [float(np.log(n / sizes.sum())) for n in sizes]
    return Discriminant(means, factors, logdets, priors, fallback)


def score(stats: DataFrame, model: Discriminant) -> DataFrame:
    """doc_id, score (probability of label 1) and predicted (1 from 0.5 on) of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column(1).flatten().to_numpy().reshape(batch.num_rows, -1)
            p = model.scores(x)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(p), pa.array((p >= 0.5).astype(np.int32))],
                names=["doc_id", "score", "predicted"],
            )

    return in_arrow(stats.select("doc_id", "stats"), run, "doc_id long, score double, predicted int")


def training_labels(labels: DataFrame) -> DataFrame:
    """The labels that may be learnt from."""
    return labels.where(~held_out(F.col("doc_id").cast("long"))).select("doc_id", "quality")


def accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are predicted to be of quality 1, with all their columns.

    Only labelled documents are read for training; then one pass scores and filters the rows where
    they lie, whatever their ids.  Repeated rows are treated alike.
    """
    known = stored(training_labels(labels), "labels")
    ids = bounded_side(known.select(F.col("doc_id").cast("long").alias("l_id")), 24)
    own = docs.select("doc_id", "text").join(
        ids, F.col("doc_id").cast("long") == F.col("l_id"), "left_semi"
    )
    model = fit(stored(document_statistics(own), "statistics"), known)
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(at).cast(pa.binary()).to_pylist()
            x = np.array([text_statistics(t or b"") for t in texts]).reshape(len(texts), WIDTH)
            yield batch.filter(pa.array(model.scores(x) >= 0.5))

    return in_arrow(docs, run, docs.schema)


def op1_quality(spark, sf_dir: str) -> DataFrame:
    """Scores of all ``documents``, learnt from the labels of two folds in three."""
    stats = stored(document_statistics(table(spark, sf_dir, "documents")), "statistics")
    model = fit(stats, training_labels(table(spark, sf_dir, "labels")))
    return score(stats, model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted"
    )
