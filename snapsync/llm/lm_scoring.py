"""Deleted-interpolation language model: n-grams of all training texts, scores of all texts.

P(w | u) mixes the maximum-likelihood estimates of ``order`` words and fewer, down to two,
one and none; the weights depend on the longest context that was seen, and how often
(buckets of powers of two), and are learnt by expectation-maximisation on counts of
held-out training texts.

Documents are packed into batches, each one row of a written table. A batch asks for the
counts of its distinct n-grams, as sorted 64-bit hashes, and scores its texts with them.
``key_counts`` has how questions and answers travel: in packed blocks, a bounded number for
each batch. No task holds more than a batch, or as much of the model.

N-grams are told apart by 64-bit hashes. Texts are split into words at space and
\\t \\n \\v \\f \\r with A-Z in lower case, and end with an end token; NULL is empty.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapsync.llm import key_counts
from snapsync.llm.common import fold, texts, written
from snapsync.llm.key_counts import packed_counts, packed_keys, unpacked_counts, unpacked_keys

BATCH_BYTES = 12 << 20
# Folds of the document key: one is never learnt from; of the others, one sets weights.
FOLDS, TEST, TUNE = 7, 2, 5
END = xxhash.xxh64_intdigest(b" end")
# Held-out tokens are counted by context bucket and by their log2 probabilities, in
# steps of 1 / STEPS.
BUCKETS, STEPS = 64, 8
ROUNDS = 50
ORDER = 2  # words of the longest n-gram


def split_at(key: Column) -> Column:
    """0: test, 1: training, 2: training that also sets the weights."""
    f = fold(key, FOLDS)
    return F.when(f == TEST, 0).when(f == TUNE, 2).otherwise(1)


# Batches -----------------------------------------------------------------


def batches_of(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Documents as rows (batch, part, tunes, blob): packed, a few megabytes each.

    Texts that set the weights are in batches of their own.
    """
    rows = df.select(
        F.col(f"`{key}`").cast("long").alias("doc_id"),
        split_at(F.col(f"`{key}`")).alias("part"),
        F.col(f"`{text}`").alias("text"),
    )

    def run(batches):
        task = TaskContext.get().partitionId() << 32
        made = 0
        waiting = {False: [], True: []}
        size = {False: 0, True: 0}

        def packed(tunes):
            nonlocal made
            whole = pa.Table.from_batches(waiting[tunes]).combine_chunks()
            sink = pa.BufferOutputStream()
            options = pa.ipc.IpcWriteOptions(compression="zstd")
            with pa.ipc.new_stream(sink, whole.schema, options=options) as stream:
                stream.write_table(whole)
            made += 1
            waiting[tunes], size[tunes] = [], 0
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([task + made], pa.int64()),
                    pa.array([tunes]),
                    pa.array([sink.getvalue().to_pybytes()], pa.binary()),
                ],
                ["batch", "tunes", "blob"],
            )

        for batch in batches:
            for tunes in (False, True):
                own = batch.filter(pc.equal(pc.equal(batch.column("part"), 2), tunes))
                sizes = pc.fill_null(pc.binary_length(own.column("text")), 0).to_numpy()
                start = 0
                for i, n in enumerate(sizes.tolist()):
                    size[tunes] += n + 16
                    if size[tunes] >= BATCH_BYTES:
                        waiting[tunes].append(own.slice(start, i + 1 - start))
                        start = i + 1
                        yield packed(tunes)
                if start < own.num_rows:
                    waiting[tunes].append(own.slice(start))
        for tunes in (False, True):
            if waiting[tunes]:
                yield packed(tunes)

    packed = rows.mapInArrow(run, "batch long, tunes boolean, blob binary")
    return written(packed, "lm-batches")


@dataclass
class Batch:
    """The tokens of a batch as n-gram hashes."""

    ids: pa.Array
    part: np.ndarray  # of each document
    ends: np.ndarray  # first token of each document, and the number of tokens
    words: np.ndarray  # hash of each token
    grams: list[np.ndarray]  # by length: hash of each token and those before it, END before the first

    @property
    def trains(self) -> np.ndarray:
        return np.repeat(self.part > 0, np.diff(self.ends))


def mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """One hash of two."""
    x = a * np.uint64(0x9E3779B97F4A7C15) ^ (b + (b << np.uint64(7)))
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


def unpacked(blob: bytes, order: int = ORDER) -> Batch:
    whole = pa.ipc.open_stream(blob).read_all().combine_chunks()
    batch = whole.to_batches()[0]
    hashes, ends = [], [0]
    for text in texts(batch):
        words = text.lower().split()
        own = np.empty(len(words) + 1, np.uint64)
        own[:-1] = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
        own[-1] = END
        hashes.append(own)
        ends.append(ends[-1] + len(own))
    words, ends = np.concatenate(hashes), np.array(ends, np.int64)
    # A text begins after ends, whatever stands before it here.
    grams, begin = [words], np.array([END], np.uint64)
    for _ in range(order - 1):
        contexts = np.r_[begin, grams[-1][:-1]]
        contexts[ends[:-1]] = begin
        grams.append(mixed(contexts, words))
        begin = mixed(begin, np.array([END], np.uint64))
    part = batch.column("part").to_numpy(zero_copy_only=False)
    return Batch(batch.column("doc_id"), part, ends, words, grams)


def _distinct(hashes: np.ndarray, trains: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct hashes, and how often each occurs in training texts."""
    # The lowest bit makes room for the training flag: 63 bits tell n-grams apart.
    order = np.sort((hashes & ~np.uint64(1)) | trains.astype(np.uint64))
    keys = order & ~np.uint64(1)
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    counts = np.add.reduceat((order & np.uint64(1)).astype(np.int64), first)
    return keys[first], counts


def asked(blob: bytes, order: int = ORDER) -> Iterator[key_counts.Question]:
    """What a batch has by length: its n-grams, their training counts, those of them tuned on."""
    b = unpacked(blob, order)
    tunes = bool((b.part == 2).any())
    for grams, hashes in enumerate(b.grams, 1):
        keys, counts = _distinct(hashes, b.trains)
        yield grams, keys, counts, counts if tunes else np.zeros_like(counts), tunes


def _arrow(schema: str) -> pa.Schema:
    kinds = {
        "int": pa.int32(), "long": pa.int64(), "boolean": pa.bool_(), "binary": pa.binary(),
        "double": pa.float64(),
    }
    return pa.schema([(n, kinds[k]) for n, k in (f.split() for f in schema.split(", "))])


# The model ---------------------------------------------------------------


def bucket(contexts: np.ndarray) -> np.ndarray:
    """Context counts by powers of two; 0 for a context that was not seen."""
    return np.where(contexts > 0, np.log2(np.maximum(contexts, 1)).astype(np.int64) + 1, 0)


@dataclass(frozen=True)
class Totals:
    tokens: int
    types: int


def states(contexts: list[np.ndarray]) -> np.ndarray:
    """The longest context that was seen, and its bucket; 0 if none was."""
    found = bucket(contexts[0])
    for level, counts in enumerate(contexts[1:], 1):
        found = np.where(counts > 0, level * BUCKETS + bucket(counts), found)
    return found


def estimates(counts: list[np.ndarray], contexts: list[np.ndarray], totals: Totals) -> np.ndarray:
    """Columns: the estimates from the longest n-gram down to a pair, a word alone, nothing."""
    longer = [n / np.maximum(c, 1) for n, c in zip(counts[1:], contexts)]
    word = counts[0] / max(totals.tokens, 1)
    return np.stack([*longer[::-1], word, np.full(len(word), 1 / (totals.types + 1))], axis=1)


def learnt(cells: dict[tuple[int, ...], int], order: int = ORDER) -> np.ndarray:
    """Weights per state by expectation-maximisation on counted held-out tokens.

    A cell is (state, -log2 of each estimate in STEPS, or -1 for zero). States without
    held-out tokens have the weights of all tokens together.
    """
    keys = np.array(list(cells), np.int64).reshape(len(cells), order + 2)
    n = np.array(list(cells.values()), np.float64)
    pooled = maximised(keys[:, 1:], n, _start(order))
    by_state = {
        b: maximised(keys[own, 1:], n[own], pooled)
        for b in np.unique(keys[:, 0]).tolist()
        for own in [keys[:, 0] == b]
    }
    return _weights(pooled, by_state, order)


def _start(order: int) -> np.ndarray:
    start = np.array([0.5, 0.3, 0.2]) if order == 2 else np.arange(order + 1, 0, -1.0)
    return start / start.sum()


def maximised(steps: np.ndarray, n: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Weights after ``ROUNDS`` rounds from ``w``, on cells counted ``n`` times."""
    p = np.where(steps < 0, 0.0, 2.0 ** (-steps / STEPS))
    start = _start(p.shape[1] - 1)
    for _ in range(ROUNDS if len(n) else 0):
        share = w * p
        share /= np.maximum(share.sum(1, keepdims=True), 1e-300)
        # One count of the start keeps every weight above zero.
        w = (share * n[:, None]).sum(0) + start
        w /= w.sum()
    return w


def learnt_by_state(cells: DataFrame, order: int) -> np.ndarray:
    """``learnt`` of a written table of cells, each state in a task of its own.

    The driver sees the cells of all states together, summed: at most as many as there are
    sets of rounded probabilities, which the length of the corpus does not change.
    """
    steps = [c for c in cells.columns if c.startswith("p")]
    whole = cells.groupBy(*steps).agg(F.sum("n").alias("n")).toArrow()

    def table_of(found: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        keys = np.column_stack([found.column(c).to_numpy() for c in steps]).astype(np.int64)
        return keys, found.column("n").to_numpy().astype(np.float64)

    pooled = maximised(*table_of(whole), _start(order))
    schema = "state int, " + ", ".join(f"w{i} double" for i in range(order + 1))

    def run(group: pa.Table) -> pa.Table:
        w = maximised(*table_of(group), pooled)
        state = pa.array([group.column("state")[0].as_py()], pa.int32())
        return pa.Table.from_arrays([state, *(pa.array([x]) for x in w)], schema=_arrow(schema))

    found = cells.groupBy("state").applyInArrow(run, schema).collect()
    return _weights(pooled, {r.state: np.array(r[1:]) for r in found}, order)


def _weights(pooled: np.ndarray, by_state: dict[int, np.ndarray], order: int) -> np.ndarray:
    found = np.tile(pooled, (BUCKETS * (order - 1), 1))
    for state, w in by_state.items():
        found[state] = w
    # A context that was not seen has no estimate.
    for level in range(1, order - 1):
        found[: level * BUCKETS, order - 2 - level] = 0.0
    found[0, : order - 1] = 0.0
    return found / found.sum(1, keepdims=True)


def _looked_up(answers: pa.Table, retained: bool, b: Batch) -> tuple[list, list]:
    """Counts of each token's n-grams by length, and of their contexts, from a batch's answers."""
    found = {}
    for grams, hashes in enumerate(b.grams, 1):
        own = answers.filter(pc.equal(answers.column("kind"), grams)).sort_by("span")
        keys = np.unique(hashes & ~np.uint64(1))
        sizes = own.column("n").to_pylist()

        def flat(name):
            packed = own.column(name).to_pylist()
            return np.concatenate([unpacked_counts(c, n) for c, n in zip(packed, sizes)])

        # Without the texts that set the weights, where they are to be set.
        counts = flat("c0") - flat("c1") if retained else flat("c0")
        if len(counts) != len(keys):
            raise ValueError("a batch differs from the one that asked")
        found[grams] = keys, counts

    def of(grams, hashes):
        keys, counts = found[grams]
        return counts[np.searchsorted(keys, hashes & ~np.uint64(1))]

    counts = [of(grams, hashes) for grams, hashes in enumerate(b.grams, 1)]
    # As many texts begin as end.
    ends = of(1, np.array([END], np.uint64))
    contexts = []
    for n in counts[:-1]:
        before = np.r_[ends, n[:-1]]
        before[b.ends[:-1]] = ends
        contexts.append(before)
    return counts, contexts


SCORES = (
    "doc_id long, part int, n_tokens long, n_known long, base_score double, score double"
)


def _met(packs: DataFrame, answers: DataFrame, use, schema: str, order: int) -> DataFrame:
    """``use(batch, its answers)`` for every batch."""

    def run(key, pack, replies):
        if not pack.num_rows:
            return pa.Table.from_pylist([], schema=_arrow(schema))
        return use(unpacked(pack.column("blob")[0].as_py(), order), replies)

    return packs.groupBy("batch").cogroup(answers.groupBy("sender")).applyInArrow(run, schema)


def cells_of(packs: DataFrame, answers: DataFrame, totals: Totals, order: int) -> DataFrame:
    names = ["state", *(f"p{i}" for i in range(order, -1, -1))]
    schema = ", ".join([*(f"{c} int" for c in names), "n long"])

    def use(b: Batch, replies: pa.Table) -> pa.Table:
        counts, contexts = _looked_up(replies, True, b)
        p = estimates(counts, contexts, totals)
        with np.errstate(divide="ignore"):
            steps = np.where(p > 0, np.rint(-np.log2(p) * STEPS), -1).astype(np.int64)
        rows, n = np.unique(np.column_stack([states(contexts), steps]), axis=0, return_counts=True)
        columns = [pa.array(c, pa.int32()) for c in rows.T] + [pa.array(n, pa.int64())]
        return pa.Table.from_arrays(columns, schema=_arrow(schema))

    found = _met(packs.filter("tunes"), answers.filter("c1 IS NOT NULL"), use, schema, order)
    return found.groupBy(*names).agg(F.sum("n").alias("n"))


def scores_of(packs: DataFrame, answers: DataFrame, totals: Totals, weights, order: int) -> DataFrame:
    def use(b: Batch, replies: pa.Table) -> pa.Table:
        counts, contexts = _looked_up(replies, False, b)
        p = (estimates(counts, contexts, totals) * weights[states(contexts)]).sum(1)
        word = counts[0]
        base = (word + 1) / (totals.tokens + totals.types + 1)
        at = b.ends[:-1]
        columns = [
            b.ids,
            pa.array(b.part, pa.int32()),
            pa.array(np.diff(b.ends), pa.int64()),
            pa.array(np.add.reduceat((word > 0).astype(np.int64), at)),
            pa.array(np.add.reduceat(np.log10(base), at)),
            pa.array(np.add.reduceat(np.log10(p), at)),
        ]
        return pa.Table.from_arrays(columns, schema=_arrow(SCORES))

    return _met(packs, answers, use, SCORES, order)


def scored(
    df: DataFrame, key: str = "doc_id", text: str = "text", order: int = ORDER
) -> DataFrame:
    """Per row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    ``base_score`` is the add-one unigram log10 probability, ``score`` the model's; both
    count the end token. Rows without a key are learnt from.
    """
    packs = batches_of(df, key, text)
    answers, sums = key_counts.counted(packs, lambda blob: asked(blob, order), "lm")
    words = sums.filter("kind = 1").first()
    tokens, tuned, types, retained = (words.s0, words.s1, words.t0, words.t1) if words else (0, 0, 0, 0)
    cells = written(cells_of(packs, answers, Totals(tokens - tuned, retained), order), "lm-cells")
    weights = learnt_by_state(cells, order)
    found = scores_of(packs, answers, Totals(tokens, types), weights, order)
    return found.select(
        "doc_id",
        (F.col("part") == 0).alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(tokens).cast("long").alias("train_tokens"),
        "base_score",
        "score",
    )
