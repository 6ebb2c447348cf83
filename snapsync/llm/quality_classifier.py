"""Quality classifier: regularised quadratic discriminant over document statistics.

A text becomes a few ratios, logarithms of counts among them. Each class is a Gaussian
whose covariance is shrunk towards a diagonal one; a score is the difference of the two
log densities and the log prior, through Mahalanobis distances with Cholesky factors
that are computed once. The moments of the classes are sums over all labelled rows; the
driver gets one row of sums per class, whatever the number of documents.

NULL texts are empty. An empty text has all-zero counts and is scored as any other.
Labels that are NULL, or whose document is not there, teach nothing; if one document
has several labels the lower counts. Without labels of both classes every score is 1:
nothing is known against any document.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapsync.llm.common import dealt, fold, many, slices, written

SHRINKAGE = 0.1
LEAST_VARIANCE = 1e-4
FOLDS, HELD_OUT = 3, 1

_DROP = {
    "letters": regex.compile(r"[^\p{L}]+"),
    "upper": regex.compile(r"[^\p{Lu}]+"),
    "digits": regex.compile(r"[^\p{N}]+"),
    "symbols": regex.compile(r"[^#*$%&|<>]+"),
    "stops": regex.compile(r"[^.!?]+"),
    "commas": regex.compile(r"[^,;:]+"),
}
FEATURES = [
    "log_words", "mean_word", "spread_word", "distinct_words", "top_word", "entropy",
    "log_lines", "distinct_lines", "words_a_line", *_DROP, "distinct_pairs", "repeated_eights",
]


def features(text: str) -> list[float]:
    """The statistics of one text, in the order of FEATURES."""
    words = text.split()
    n, chars = max(1, len(words)), max(1, len(text))
    lengths = np.fromiter(map(len, words), np.float64, len(words))
    counts = Counter(words)
    shares = np.fromiter(counts.values(), np.float64, len(counts)) / n
    lines = [line for line in text.split("\n") if line.strip()]
    pairs = len(set(zip(words, words[1:])))
    eights = Counter(zip(*[words[i:] for i in range(8)])) if len(words) > 8 else {}
    windows = max(1, len(words) - 7)
    twice = sum(c for c in eights.values() if c > 1) if len(eights) < windows else 0
    ratios = [len(p.sub("", text)) / chars for p in _DROP.values()]
    return [
        np.log1p(len(words)),
        np.log1p(lengths.mean() if words else 0.0),
        np.log1p(lengths.std() if words else 0.0),
        len(counts) / n,
        np.sqrt(shares.max(initial=0.0)),
        float(-(shares * np.log(shares)).sum() / np.log(n + 1)),
        np.log1p(len(lines)),
        len(set(lines)) / max(1, len(lines)),
        np.log1p(len(words) / max(1, len(lines))),
        *[float(np.sqrt(r)) for r in ratios],
        pairs / max(1, len(words) - 1),
        float(np.sqrt(twice / windows)),
    ]


def featured(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``text_hash`` and the feature vector ``x`` of every row."""
    rows = df.select(
        F.col(f"`{key}`").cast("long").alias("doc_id"),
        F.xxhash64(F.col(f"`{text}`")).alias("text_hash"),
        F.col(f"`{text}`").alias("text"),
    )

    def run(batches):
        for batch in slices(batches):
            found = [features(t) for t in pc.fill_null(batch.column("text"), "").to_pylist()]
            flat = pa.array(np.array(found, np.float64).ravel())
            ends = pa.array(np.arange(len(found) + 1, dtype=np.int32) * len(FEATURES))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("text_hash"),
                    pa.ListArray.from_arrays(ends, flat),
                ],
                ["doc_id", "text_hash", "x"],
            )

    return rows.mapInArrow(run, "doc_id long, text_hash long, x array<double>")


@dataclass(frozen=True)
class Gaussian:
    """One class: mean, the inverse of the Cholesky factor, log determinant, log prior."""

    mean: np.ndarray
    inverse: np.ndarray
    log_det: float
    log_prior: float

    def log_density(self, x: np.ndarray) -> np.ndarray:
        z = (x - self.mean) @ self.inverse.T
        return self.log_prior - 0.5 * (self.log_det + (z * z).sum(1))


def gaussian(n: int, s: np.ndarray, ss: np.ndarray, prior: float, shrinkage: float) -> Gaussian:
    """A class from its count, sum and sum of products."""
    mean = s / n
    cov = ss / n - np.outer(mean, mean)
    own = np.maximum(np.diag(cov), LEAST_VARIANCE)
    cov = (1 - shrinkage) * cov + shrinkage * np.diag(own)
    cov[np.diag_indices_from(cov)] += LEAST_VARIANCE
    factor = np.linalg.cholesky(cov)
    return Gaussian(
        mean, np.linalg.inv(factor), 2 * float(np.log(np.diag(factor)).sum()), float(np.log(prior))
    )


def moments(rows: DataFrame) -> dict[int, tuple[int, np.ndarray, np.ndarray]]:
    """Count, sums and sums of products of ``x`` per ``quality``."""
    d = len(FEATURES)

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            x = pc.list_flatten(batch.column("x")).to_numpy().reshape(-1, d)
            quality = batch.column("quality").to_numpy(zero_copy_only=False)
            for label in np.unique(quality).tolist():
                own = x[quality == label]
                sums = np.r_[len(own), own.sum(0), (own.T @ own).ravel()]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([label] * len(sums), pa.int32()),
                        pa.array(np.arange(len(sums)), pa.int32()),
                        pa.array(sums),
                    ],
                    ["quality", "k", "v"],
                )

    sums = (
        rows.select("quality", "x")
        .mapInArrow(run, "quality int, k int, v double")
        .groupBy("quality", "k")
        .agg(F.sum("v").alias("v"))
        .collect()
    )
    found = {}
    for label in {r.quality for r in sums}:
        v = np.array([r.v for r in sorted(sums, key=lambda r: r.k) if r.quality == label])
        found[label] = (int(v[0]), v[1 : d + 1], v[d + 1 :].reshape(d, d))
    return found


def fit(rows: DataFrame, shrinkage: float = SHRINKAGE) -> dict[int, Gaussian] | None:
    """The two classes from ``x`` and ``quality`` (0 or 1), or None if one has no rows."""
    sums = moments(rows.filter("quality IN (0, 1)"))
    if set(sums) != {0, 1}:
        return None
    total = sum(n for n, _, _ in sums.values())
    return {q: gaussian(n, s, ss, n / total, shrinkage) for q, (n, s, ss) in sums.items()}


def score(rows: DataFrame, classes: dict[int, Gaussian] | None) -> DataFrame:
    """``rows`` with ``score`` in place of ``x``: the probability of quality 1."""
    if classes is None:
        return rows.drop("x").withColumn("score", F.lit(1.0))
    names = [c for c in rows.columns if c != "x"]
    d = len(FEATURES)

    def run(batches):
        for batch in batches:
            x = pc.list_flatten(batch.column("x")).to_numpy().reshape(-1, d)
            margin = classes[1].log_density(x) - classes[0].log_density(x)
            found = 1 / (1 + np.exp(-np.clip(margin, -700, 700)))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in names), pa.array(found)], [*names, "score"]
            )

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != "x")
    return rows.mapInArrow(run, f"{schema}, score double")


def held_out(key: Column) -> Column:
    return fold(key, FOLDS) == HELD_OUT


def classified(
    df: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``doc_id``, ``text_hash``, ``held_out`` and ``score`` of every row."""
    rows = written(featured(df, key, text), "quality-features")
    known = (
        labels.filter(F.col(key).isNotNull() & ~held_out(F.col(key)))
        .groupBy(F.col(key).cast("long").alias("doc_id"))
        .agg(F.min("quality").cast("int").alias("quality"))
    )
    classes = fit(rows.join(dealt(known, many(labels)), "doc_id"))
    return score(rows, classes).withColumn("held_out", held_out(F.col("doc_id")))


def kept(df: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``df`` that score 0.5 or more."""
    found = classified(df, labels, key, text)
    # A score depends on the text alone, so rows are told apart by key and text.
    # Written, they are counted: texts are only shuffled if there are many.
    bad = found.filter("score < 0.5").select("doc_id", "text_hash")
    bad = written(bad.distinct(), "quality-rejected")
    # As one column, so that no name of a row's meets one used here.
    rows = df.select(
        F.struct("*").alias("row"),
        F.col(f"`{key}`").cast("long").alias("key"),
        F.xxhash64(F.col(f"`{text}`")).alias("hash"),
    )
    same = F.col("key").eqNullSafe(F.col("doc_id")) & (F.col("hash") == F.col("text_hash"))
    return rows.join(dealt(bad, many(bad)), same, "left_anti").select("row.*")
