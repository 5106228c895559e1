"""Text quality by a regularised quadratic discriminant over transformed document statistics."""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetgauge.llm.common import fold, materialize, row_tag, table

SYMBOLS, ENDS = b"#*$%&|<>{}[]\\~^_=+@", b".,;:!?"
UPPER = bytes(range(65, 91))
DIGITS = b"0123456789"
FEATURES = [
    "log_words", "word_length", "symbols", "upper_case", "digits", "distinct_words", "repeated_lines", "symbol_ends",
    "short_words", "top_word", "repeated_pairs", "line_words", "capital_words", "shouts", "bars",
]
#: Weights of the shared covariance and of its diagonal in each class's covariance, and what is added to the diagonal.
SHARED, DIAGONAL, RIDGE = 0.10, 0.05, 1e-3
THRESHOLD = 0.3


def _share(part: float, whole: float) -> float:
    """Logarithm of a share; a hundredth is added so that rare traits stay on one scale."""
    return float(np.log(part / whole + 0.01)) if whole else float(np.log(0.01))


def statistics(text: str | None) -> list[float]:
    """The statistics of a whole text; a null or empty one has those of no words."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.split()
    n, size = len(words), len(raw) - raw.count(b" ") - raw.count(b"\n")
    lower = raw.lower().split()
    counts, pairs = Counter(lower), len(set(zip(lower, lower[1:])))
    lines = [x for x in raw.split(b"\n") if x.strip()]
    return [
        float(np.log1p(n)),
        float(np.log1p(size / n)) if n else 0.0,
        _share(size - len(raw.translate(None, SYMBOLS + b" \n")), size),
        _share(len(raw) - len(raw.translate(None, UPPER)), size),
        _share(len(raw) - len(raw.translate(None, DIGITS)), size),
        _share(len(counts), n),
        _share(len(lines) - len(set(lines)), len(lines)),
        _share(sum(1 for w in words if w[-1:] in SYMBOLS or w[-2:] == b"!!"), n),
        _share(sum(1 for w in words if len(w) < 4), n),
        _share(max(counts.values(), default=0), n),
        _share(n - 1 - pairs, n - 1) if n > 1 else _share(0, 0),
        float(np.log1p(n / len(lines))) if lines else 0.0,
        _share(sum(1 for w in words if 65 <= w[0] <= 90), n),
        _share(raw.count(b"!"), n),
        _share(raw.count(b"|"), n),
    ]


def _described(batches):
    for batch in batches:
        rows = np.array([statistics(t) for t in batch.column("__text").to_pylist()], np.float64).reshape(-1, len(FEATURES))
        values = pa.FixedSizeListArray.from_arrays(pa.array(rows.ravel()), len(FEATURES)).cast(pa.list_(pa.float64()))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), values], names=["doc_id", "x"])


def describe(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and the statistics ``x`` of every row; other columns are not read."""
    slim = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("__text"))
    kind = dict(slim.dtypes)["doc_id"]
    return slim.mapInArrow(_described, f"doc_id {kind}, x array<double>")


@dataclass
class Discriminant:
    """Class means, inverted Cholesky factors of the covariances, half log-determinants and the log prior ratio."""

    means: list[np.ndarray]
    factors: list[np.ndarray]
    half_logs: list[float]
    prior: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Probability of class 1 from the difference of the log densities."""
        logs = [-0.5 * (((x - m) @ f.T) ** 2).sum(axis=1) - h for m, f, h in zip(self.means, self.factors, self.half_logs)]
        return 1 / (1 + np.exp(-np.clip(logs[1] - logs[0] + self.prior, -500, 500)))


def discriminant(n: np.ndarray, sums: np.ndarray, products: np.ndarray) -> Discriminant | float:
    """From counts, sums and sums of products of both classes. The share of class 1 if a class has no two rows."""
    if n.min() < 2:
        return float(n[1] / n.sum()) if n.sum() else 1.0
    means = [sums[c] / n[c] for c in (0, 1)]
    own = [products[c] / n[c] - np.outer(means[c], means[c]) for c in (0, 1)]
    shared = (n[0] * own[0] + n[1] * own[1]) / n.sum()
    factors, half_logs = [], []
    for c in (0, 1):
        mixed = (1 - SHARED - DIAGONAL) * own[c] + SHARED * shared + DIAGONAL * np.diag(np.diag(shared)) + RIDGE * np.eye(len(shared))
        lower = np.linalg.cholesky(mixed)
        factors.append(np.linalg.inv(lower))
        half_logs.append(float(np.log(np.diag(lower)).sum()))
    return Discriminant(means, factors, half_logs, float(np.log(n[1] / n[0])))


def _moments(batches):
    k = len(FEATURES)
    total = {c: np.zeros(1 + k + k * k) for c in (0, 1)}
    for batch in batches:
        x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, k)
        label = batch.column("quality").to_numpy(zero_copy_only=False)
        for c in (0, 1):
            own = x[label == c]
            total[c] += np.concatenate([[len(own)], own.sum(axis=0), (own.T @ own).ravel()])
    size = 1 + k + k * k
    columns = [np.repeat([0, 1], size), np.tile(np.arange(size), 2), np.concatenate([total[0], total[1]])]
    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["label", "cell", "value"])


def fit(described: DataFrame, labels: DataFrame) -> Discriminant | float:
    """Learns from all labelled rows (``doc_id``, ``quality`` 0 or 1; other values are ignored, a document labelled both
    ways counts as 0). Only sums travel: one number for each class and pair of statistics."""
    labels = labels.where("quality IN (0, 1)").groupBy("doc_id").agg(F.min("quality").cast("int").alias("quality"))
    rows = described.join(labels, "doc_id").select("x", "quality")
    cells = rows.mapInArrow(_moments, "label long, cell long, value double").groupBy("label", "cell").agg(F.sum("value").alias("v"))
    k = len(FEATURES)
    total = np.zeros((2, 1 + k + k * k))
    for label, cell, value in cells.collect():  # 2 * (1 + k + k * k) numbers
        total[label, cell] = value
    return discriminant(total[:, 0], total[:, 1 : 1 + k], total[:, 1 + k :].reshape(2, k, k))


def score(described: DataFrame, model: Discriminant | float) -> DataFrame:
    """``doc_id`` and ``score`` of every described row."""
    kind = dict(described.dtypes)["doc_id"]

    def run(batches):
        for batch in batches:
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, len(FEATURES))
            values = np.full(len(x), model) if isinstance(model, float) else model.scores(x)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(values)], names=["doc_id", "score"])

    return described.select("doc_id", "x").mapInArrow(run, f"doc_id {kind}, score double")


def classify(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``held_out``, ``score`` (0 to 1), ``predicted`` (1 from ``threshold`` on).

    Labels with a CRC-32 of the id's text divisible by 5 are held out. Only the text enters a score. Null and empty texts
    are scored as texts of no words. Without labels of both classes every score is the share of class 1 (1 without any
    labels). A null id cannot be labelled, is never held out and is scored. Repeated rows are scored one by one; an empty
    table gives no rows.
    """
    described = materialize(describe(docs), "statistics")
    model = fit(described.where(fold("doc_id") != 0), labels.select("doc_id", "quality").where(fold("doc_id") != 0))
    held = F.coalesce(fold("doc_id") == 0, F.lit(False))
    return score(described, model).select("doc_id", held.alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not rejected.

    Rows are told apart by their id and all their columns, so a rejected text takes no other text of its id along. Equal
    rows have equal scores: they stay or go together. Rows with a null id are judged as well.
    """
    rows = docs.withColumn("__row", F.struct(F.col("doc_id"), row_tag(docs).alias("tag")))
    described = materialize(describe(rows, "__row"), "statistics")
    model = fit(
        described.withColumn("doc_id", F.col("doc_id.doc_id")).where(fold("doc_id") != 0),
        labels.select("doc_id", "quality").where(fold("doc_id") != 0),
    )
    bad = score(described, model).where(F.col("score") < THRESHOLD).select(F.col("doc_id").alias("__bad")).distinct()
    return rows.join(bad, F.col("__row").eqNullSafe(F.col("__bad")), "left_anti").drop("__row")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES = {"op4_quality_qda": query}
ORACLE: dict[str, str] = {}
