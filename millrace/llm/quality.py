"""Quality classifier: a regularised quadratic discriminant over document statistics.

Each text becomes ``len(STATISTICS)`` numbers (lengths, shares of symbols, repetition), transformed by
square root or logarithm so that each class is closer to a normal distribution. Per class the mean and
the covariance are estimated from sums that every partition forms for itself; the covariance is shrunk
towards its diagonal and a small multiple of the identity. A text's log-density under a class is a
Mahalanobis distance by the class's inverse Cholesky factor, computed once, plus its log-determinant.
The difference of both, pressed by asinh, is calibrated by a logistic fit on a histogram.

Only the sums (two classes x some 200 numbers) and the histogram (2 x ``BINS`` counts) reach the driver,
and the fit uses every labelled row.

Defined cases: a null text counts as empty, and an empty text has a score like any other; labels that
contradict each other for one doc_id, and null labels, are left out, repeated ones count once; a document
whose doc_id is repeated or null is scored by its text alone (a null id has no label). Without both
classes among the labels every score is the smoothed share of good labels (0.5 without labels). Columns
of the input keep their names and values, except that ``score`` and ``predicted`` are added.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import give_back, id_fold, table
from millrace.llm.registry import query
from millrace.session import settle

STATISTICS = (
    "words",
    "word_length",
    "word_length_spread",
    "distinct_words",
    "commonest_word",
    "repeated_neighbours",
    "repeated_pairs",
    "symbols",
    "rare_symbols",
    "exclamations",
    "capitals",
    "digits",
    "words_without_letters",
    "lines_per_word",
    "repeated_lines",
    "shortest_line",
)
SHRINKAGE = 0.1
RIDGE = 1e-3
BINS = 400
FOLDS, HELD_OUT = 3, 1

_USUAL = np.zeros(256, bool)
_USUAL[list(b".,;:!?'\"-()")] = True
_PRINTED = np.zeros(256, bool)
_PRINTED[33:127] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_LOWER = np.zeros(256, bool)
_LOWER[97:123] = True
_SYMBOL = _PRINTED & ~_DIGIT & ~_UPPER & ~_LOWER
_NO_LETTER = bytes(np.flatnonzero(~(_UPPER | _LOWER | (np.arange(256) > 127))).astype(np.uint8))


def _matrix(rows: pa.Array) -> np.ndarray:
    return rows.flatten().to_numpy(zero_copy_only=False).reshape(len(rows), -1)


def statistics(text: str | None) -> list[float]:
    """The transformed statistics of one whole text."""
    raw = (text or "").encode()
    words = raw.split()
    n = len(words)
    if not n:
        return [0.0] * len(STATISTICS)
    counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    visible = max(1, int(counts[33:].sum()))
    letters = max(1, int(counts[_UPPER | _LOWER].sum()))
    lengths = np.fromiter(map(len, words), np.float64, n)
    seen = Counter(words)
    lines = [x for x in raw.split(b"\n") if x.strip()]
    pairs = len(set(zip(words, words[1:])))
    share = (
        max(seen.values()) / n,
        sum(map(bytes.__eq__, words, words[1:])) / n,
        1 - pairs / (n - 1) if n > 1 else 0.0,
        counts[_SYMBOL].sum() / visible,
        counts[_SYMBOL & ~_USUAL].sum() / visible,
        counts[33] / visible,
        counts[_UPPER].sum() / letters,
        counts[_DIGIT].sum() / visible,
        sum(not w.translate(None, _NO_LETTER) for w in seen) / len(seen),
        len(lines) / n,
        1 - len(set(lines)) / len(lines),
    )
    return [
        float(np.log1p(n)),
        float(np.log1p(lengths.mean())),
        float(np.log1p(lengths.std())),
        float(np.log1p(len(seen)) / np.log1p(n)),
        *(float(x) ** 0.5 for x in share),
        float(np.log1p(min(map(len, lines)))),
    ]


def with_statistics(docs: DataFrame, text: str = "text", out: str = "statistics") -> DataFrame:
    """``docs`` with the array column ``out``."""

    @F.arrow_udf("array<double>")
    def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield pa.array([statistics(t.as_py()) for t in texts], pa.list_(pa.float64()))
        give_back()

    return docs.withColumn(out, of(F.col(text).cast("string")))


@dataclass(frozen=True)
class Discriminant:
    """Per class a mean, an inverse Cholesky factor and a log-determinant; then the calibration."""

    means: np.ndarray
    factors: np.ndarray
    log_determinants: np.ndarray
    slope: float = 1.0
    intercept: float = 0.0
    constant: float | None = None

    def difference(self, x: np.ndarray) -> np.ndarray:
        """asinh of the log-density of class 1 minus that of class 0."""
        density = []
        for mean, factor, log_determinant in zip(self.means, self.factors, self.log_determinants):
            away = (x - mean) @ factor.T
            density.append(-0.5 * (np.einsum("ij,ij->i", away, away) + log_determinant))
        return np.arcsinh(density[1] - density[0])

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(x), self.constant)
        return 1 / (1 + np.exp(-np.clip(self.slope * self.difference(x) + self.intercept, -700, 700)))


def labels_of(labels: DataFrame, column: str = "quality") -> DataFrame:
    """doc_id and label (0 or 1), one row per doc_id whose labels agree."""
    kept = labels.filter(F.col("doc_id").isNotNull() & F.col(column).isin(0, 1))
    agreed = kept.groupBy("doc_id").agg(F.min(column).alias("label"), F.max(column).alias("__most"))
    return agreed.filter("label = __most").select("doc_id", F.col("label").cast("int").alias("label"))


def _moments(labelled: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per class the number of rows, the sums and the sums of products; every partition adds its own."""
    d = len(STATISTICS)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, 1 + d + d * d))
        for batch in batches:
            label = batch.column(0).to_numpy(zero_copy_only=False)
            x = batch.column(1).flatten().to_numpy().reshape(-1, d)
            for k in (0, 1):
                own = x[label == k]
                total[k, 0] += len(own)
                total[k, 1 : 1 + d] += own.sum(axis=0)
                total[k, 1 + d :] += (own.T @ own).ravel()
        yield pa.RecordBatch.from_pydict(
            {"label": pa.array([0, 1], pa.int32()), "sums": pa.array(total.tolist(), pa.list_(pa.float64()))}
        )

    parts = labelled.select("label", "statistics").mapInArrow(sums, "label int, sums array<double>")
    added = parts.select("label", F.posexplode("sums")).groupBy("label", "pos").agg(F.sum("col").alias("sum"))
    total = np.zeros((2, 1 + d + d * d))
    for row in added.collect():
        total[row["label"], row["pos"]] = row["sum"]
    return total[:, 0], total[:, 1 : 1 + d], total[:, 1 + d :].reshape(2, d, d)


def _calibrated(model: Discriminant, labelled: DataFrame) -> Discriminant:
    """The logistic fit of the label on the pressed difference, from a histogram of it."""
    width = 0.05

    @F.arrow_udf("int")
    def binned(x: pa.Array) -> pa.Array:
        d = model.difference(_matrix(x))
        return pa.array(np.clip(np.rint(d / width), -BINS // 2, BINS // 2).astype("int32"))

    counted = labelled.groupBy("label", binned("statistics").alias("bin")).count().collect()
    x = np.array([r["bin"] * width for r in counted])
    y = np.array([r["label"] for r in counted], float)
    w = np.array([r["count"] for r in counted], float)
    # A weak pull towards slope 1 keeps the fit finite when the classes are separated.
    slope, intercept = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(slope * x + intercept, -500, 500)))
        g = np.array([(w * (y - p) * x).sum() - (slope - 1.0), (w * (y - p)).sum() - 0.01 * intercept])
        v = w * p * (1 - p)
        h = np.array([[(v * x * x).sum() + 1.0, (v * x).sum()], [(v * x).sum(), v.sum() + 0.01]])
        step = np.clip(np.linalg.solve(h, g), -1.0, 1.0)
        slope, intercept = max(0.05, slope + step[0]), intercept + step[1]
        if np.abs(step).max() < 1e-9:
            break
    return Discriminant(model.means, model.factors, model.log_determinants, float(slope), float(intercept))


def fit(labelled: DataFrame, shrinkage: float = SHRINKAGE, ridge: float = RIDGE) -> Discriminant:
    """The classifier of rows (label, statistics)."""
    n, sums, products = _moments(labelled)
    if n.min() < 2:
        none = np.zeros(0)
        return Discriminant(none, none, none, constant=float((n[1] + 1) / (n.sum() + 2)))
    means = sums / n[:, None]
    pooled = products.sum(axis=0) / n.sum() - np.outer(sums.sum(axis=0), sums.sum(axis=0)) / n.sum() ** 2
    scale = np.maximum(np.diag(pooled), 1e-9)
    factors, log_determinants = [], []
    for k in (0, 1):
        covariance = products[k] / n[k] - np.outer(means[k], means[k])
        diagonal = np.diag(np.diag(covariance))
        covariance = (1 - shrinkage) * covariance + shrinkage * diagonal + ridge * np.diag(scale)
        lower = np.linalg.cholesky(covariance)
        factors.append(np.linalg.inv(lower))
        log_determinants.append(2 * np.log(np.diag(lower)).sum())
    return _calibrated(Discriminant(means, np.array(factors), np.array(log_determinants)), labelled)


def with_scores(rows: DataFrame, model: Discriminant) -> DataFrame:
    """``rows``, which have ``statistics``, with ``score`` and ``predicted`` in its place."""

    @F.arrow_udf("double")
    def scored(x: pa.Array) -> pa.Array:
        return pa.array(model.score(_matrix(x)))

    out = rows.withColumn("score", scored("statistics")).drop("statistics")
    return out.withColumn("predicted", F.when(F.col("score") >= 0.5, 1).otherwise(0))


def text_score(text: str, model: Discriminant) -> Column:
    """The score of a text column, statistics and all in one pass through Python."""

    @F.arrow_udf("double")
    def scored(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield pa.array(model.score(np.array([statistics(t.as_py()) for t in texts]).reshape(len(texts), -1)))
        give_back()

    return scored(F.col(text).cast("string"))


def train(docs: DataFrame, labels: DataFrame) -> tuple[Discriminant, DataFrame]:
    """The classifier, and the written statistics (doc_id, statistics) of all documents."""
    measured = settle(with_statistics(docs.select("doc_id", "text")).select("doc_id", "statistics"), "statistics")
    return fit(measured.join(labels_of(labels), "doc_id")), measured


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents the classifier does not reject, all columns as they were."""
    model, _ = train(docs, labels)
    return docs.withColumn("__score", text_score("text", model)).filter("__score >= 0.5").select(*docs.columns)


@query()
def op1_quality(spark, sf_dir: str) -> DataFrame:
    """The quality of every document, learnt from two thirds of the labels."""
    held_out = F.coalesce(id_fold("doc_id", FOLDS) == HELD_OUT, F.lit(False))
    labels = table(spark, sf_dir, "labels").filter(~held_out)
    model, measured = train(table(spark, sf_dir, "documents"), labels)
    return with_scores(measured, model).select("doc_id", held_out.alias("held_out"), "score", "predicted")
