"""URL filter: host and path rules first, then two character language models.

Rules decide what they fit, the longest first. The URLs so judged teach two models of
characters, one of allowed and one of blocked URLs. A model mixes the orders 0 to 4: the
estimate of an order leans on the next lower one the more, the less often its context
was seen. A URL without a rule is allowed if the mean log-likelihood difference per
character reaches a threshold, which is set on a fifth of the judged URLs that the models
have not seen.

Every n-gram is counted by itself; n-grams are told apart by 64-bit hashes. As in LM
scoring, URLs are packed into batches, and a batch asks for just the n-grams it has
(``key_counts``); no task holds more than a batch or as much of the counts.

NULL and empty URLs have no host and no path, and a difference of 0.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from snapsync.llm import key_counts
from snapsync.llm.common import fold, slices, written
from snapsync.llm.key_counts import unpacked_counts

ORDER = 4
BATCH_BYTES = 1 << 20  # of URLs; a byte has ten n-grams of eight bytes at most
PULL = 4.0
FOLDS, CALIBRATES = 5, 0
# Parts: without a rule, judged to learn from, judged to set the threshold.
OPEN, TRAINS, SETS = 0, 1, 2
# The threshold lies on a grid of mean differences in nats.
GRID, REACH = 0.01, 10.0
BEGIN, END = 1, 2


@dataclass(frozen=True)
class Rule:
    """``host`` and its subdomains, paths that begin with ``path``."""

    text: str
    verdict: str

    @property
    def host(self) -> str:
        return self.text.partition("/")[0]

    @property
    def path(self) -> str:
        return self.text[len(self.host) :]


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z in lower case) and path; both empty without ``://``."""
    at = F.locate("://", url)
    after = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    after = F.coalesce(after, F.lit(""))
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    host = F.translate(F.regexp_extract(after, "^([^/?#]*)", 1), letters, letters.lower())
    return host, F.regexp_extract(after, "^[^/?#]*([^?#]*)", 1)


def longest_rule(rules: list[Rule], value) -> Column:
    """``value(rule)`` of the longest rule that fits columns ``host`` and ``path``."""
    found = None
    for rule in sorted(rules, key=lambda r: -len(r.text)):
        host = (F.col("host") == rule.host) | F.endswith("host", F.lit(f".{rule.host}"))
        fits = host & F.startswith("path", F.lit(rule.path))
        out = F.lit(value(rule))
        found = F.when(fits, out) if found is None else found.when(fits, out)
    return F.lit(None).cast("string") if found is None else found


# The models --------------------------------------------------------------


def _grams(urls: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of contexts and of contexts with their character, by order; length of each URL.

    Each URL is framed by ORDER begins and an end, which counts as a character.
    """
    parts, lengths = [], []
    for url in urls:
        chars = np.frombuffer(url.encode("utf-32-le"), "<u4")
        parts += [np.full(ORDER, BEGIN, np.uint64), chars.astype(np.uint64), np.array([END], np.uint64)]
        lengths.append(len(chars) + 1)
    flat = np.concatenate(parts) if parts else np.empty(0, np.uint64)
    lengths = np.array(lengths, np.int64)
    starts = np.cumsum(lengths + ORDER) - lengths
    at = np.repeat(starts - (np.cumsum(lengths) - lengths), lengths) + np.arange(lengths.sum())
    contexts, grams = [], []
    hashed = np.full(len(at), 0x2545F4914F6CDD1D, np.uint64)
    for order in range(ORDER + 1):
        if order:
            hashed = _stir(hashed ^ flat[at - order])
        contexts.append(_stir(hashed))
        grams.append(_stir(hashed + flat[at] * np.uint64(0xD1342543DE82EF95)))
    return np.array(contexts), np.array(grams), lengths


def _stir(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def _counted(urls: list[str], sides: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct hashes of ``urls``, and their counts in those of side 0 and of side 1."""
    contexts, grams, lengths = _grams(urls)
    keys, of = np.unique(np.concatenate([contexts, grams]), return_inverse=True)
    of, at = of.reshape(2 * ORDER + 2, -1), np.repeat(sides, lengths)
    return keys, np.stack([np.bincount(of[:, at == c].ravel(), minlength=len(keys)) for c in (0, 1)])


class Model:
    """Counts of contexts and n-grams in blocked (0) and allowed (1) URLs."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray):
        self.keys, self.counts = keys, counts  # sorted hashes; side, hash

    def _count(self, hashes: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.zeros((2, len(hashes)))
        at = np.minimum(np.searchsorted(self.keys, hashes), len(self.keys) - 1)
        return np.where(self.keys[at] == hashes, self.counts[:, at], 0)

    def difference(self, urls: list[str]) -> np.ndarray:
        """Mean log-likelihood difference per character, allowed minus blocked."""
        contexts, grams, lengths = _grams(urls)
        if not len(lengths):
            return np.empty(0)
        p = np.full((2, contexts.shape[1]), 1 / 0x110000)
        for context, gram in zip(contexts, grams):
            p = (self._count(gram) + PULL * p) / (self._count(context) + PULL)
        gain = np.log(p[1]) - np.log(p[0])
        return np.add.reduceat(gain, np.cumsum(lengths) - lengths) / lengths


def trained(rows: DataFrame) -> Model:
    """The whole model of ``url`` by ``verdict`` on the driver, for few URLs."""

    def run(batches):
        for batch in slices(batches, "url", 1 << 20):
            urls = [u or "" for u in batch.column("url").to_pylist()]
            sides = np.array([v == "allow" for v in batch.column("verdict").to_pylist()], int)
            keys, counts = _counted(urls, sides)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys.view(np.int64)), *map(pa.array, counts)], ["hash", "n0", "n1"]
            )

    sums = (
        rows.select("url", "verdict")
        .mapInArrow(run, "hash long, n0 long, n1 long")
        .groupBy("hash")
        .agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
        .toArrow()
    )
    keys = sums.column("hash").to_numpy().view(np.uint64)
    order = np.argsort(keys)
    return Model(keys[order], np.stack([sums.column(c).to_numpy()[order] for c in ("n0", "n1")]))


# Batches -----------------------------------------------------------------


def batches_of(rows: DataFrame) -> DataFrame:
    """``rows`` as a table of (batch, blob): packed by their bytes of ``url``."""
    limit = BATCH_BYTES

    def run(batches):
        task = TaskContext.get().partitionId() << 32
        made, size, waiting = 0, 0, []

        def packed():
            whole = pa.Table.from_batches(waiting).combine_chunks()
            sink = pa.BufferOutputStream()
            options = pa.ipc.IpcWriteOptions(compression="zstd")
            with pa.ipc.new_stream(sink, whole.schema, options=options) as stream:
                stream.write_table(whole)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([task + made], pa.int64()),
                    pa.array([sink.getvalue().to_pybytes()], pa.binary()),
                ],
                ["batch", "blob"],
            )

        for batch in slices(batches, "url", limit):
            own = pc.sum(pc.binary_length(batch.column("url"))).as_py() or 0
            own += 64 * batch.num_rows
            if waiting and size + own > limit:
                yield packed()
                made, size, waiting = made + 1, 0, []
            waiting.append(batch)
            size += own
        if waiting:
            yield packed()

    return written(rows.mapInArrow(run, "batch long, blob binary"), "url-batches")


def _unpacked(blob: bytes) -> tuple[pa.Table, list[str]]:
    whole = pa.ipc.open_stream(blob).read_all()
    return whole, [u or "" for u in whole.column("url").to_pylist()]


def asked(blob: bytes) -> Iterator[key_counts.Question]:
    """The n-grams that a batch has, and their counts in its URLs that train."""
    rows, urls = _unpacked(blob)
    judged = zip(*(rows.column(c).to_pylist() for c in ("verdict", "part")))
    sides = np.array([(v == "allow") if p == TRAINS else -1 for v, p in judged], int)
    keys, counts = _counted(urls, sides)
    yield 0, keys, counts[0], counts[1], True


def with_difference(rows: DataFrame) -> DataFrame:
    """``rows`` with ``difference`` by the models of those whose ``part`` is TRAINS."""
    schema = StructType([*rows.schema, StructField("difference", DoubleType())])
    packs = batches_of(rows)
    answers, _ = key_counts.counted(packs, asked, "url")

    def score(pack: pa.Table, replies: pa.Table) -> pa.Table:
        own, urls = _unpacked(pack.column("blob")[0].as_py())
        replies = replies.sort_by("span")
        sizes = replies.column("n").to_pylist()
        counts = [
            np.concatenate([unpacked_counts(v, n) for v, n in zip(replies.column(c).to_pylist(), sizes)])
            for c in ("c0", "c1")
        ]
        keys, _ = _counted(urls, np.full(len(urls), -1))
        found = Model(keys, np.stack(counts)).difference(urls)
        found[[not u for u in urls]] = 0.0
        return own.append_column("difference", pa.array(found))

    return packs.groupBy("batch").cogroup(answers.groupBy("sender")).applyInArrow(score, schema)


def threshold(judged: DataFrame) -> float:
    """The grid point that separates ``verdict`` by ``difference`` best, each side equal.

    Of equally good points that nearest to 0; 0 if one side has no rows.
    """
    cell = F.floor(F.least(F.greatest("difference", F.lit(-REACH)), F.lit(REACH)) / GRID)
    rows = judged.groupBy(cell.alias("cell"), "verdict").agg(F.count("*").alias("n")).collect()
    size = int(2 * REACH / GRID) + 2
    sides = {"allow": np.zeros(size), "block": np.zeros(size)}
    for r in rows:
        sides[r.verdict][int(r.cell + REACH / GRID)] += r.n
    if not sides["allow"].sum() or not sides["block"].sum():
        return 0.0
    missed = (np.cumsum(sides["allow"]) - sides["allow"]) / sides["allow"].sum()
    caught = (np.cumsum(sides["block"]) - sides["block"]) / sides["block"].sum()
    gain = caught - missed
    points = (np.arange(size) - REACH / GRID) * GRID
    best = np.flatnonzero(gain >= gain.max() - 1e-12)
    return float(points[best[np.argmin(np.abs(points[best]))]])


def judged(
    df: DataFrame, rules: list[Rule], key: str = "page_id", url: str = "url"
) -> DataFrame:
    """Per row: page_id, url, host, path, rule, verdict, difference."""
    host, path = host_and_path(F.col(f"`{url}`"))
    rows = df.select(
        F.col(f"`{key}`").alias("page_id"),
        F.col(f"`{url}`").alias("url"),
        host.alias("host"),
        path.alias("path"),
    )
    rows = rows.withColumns(
        {
            "rule": longest_rule(rules, lambda r: r.text),
            "verdict": longest_rule(rules, lambda r: r.verdict),
        }
    )
    held_back = fold(F.col("page_id"), FOLDS) == CALIBRATES
    part = F.when(F.col("verdict").isNull(), OPEN).when(held_back, SETS).otherwise(TRAINS)
    found = written(with_difference(rows.withColumn("part", part)), "url-differences")
    limit = threshold(found.filter(F.col("part") == SETS))
    learnt = F.when(F.col("difference") >= limit, "allow").otherwise("block")
    return found.withColumn("verdict", F.coalesce("verdict", learnt)).drop("part")
