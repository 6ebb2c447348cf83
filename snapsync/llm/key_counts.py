"""Counts of sorted keys over all batches, handed back to each batch for just its keys.

A batch asks for the counts of the keys that it has. With one message for each range of
keys, every batch would send as many messages as there are batches. So a batch sends
``FAN`` at most: questions are routed in hops, each of which cuts a range of keys in
``fan`` and joins the questions of ``fan`` groups of batches into one, keys once. After the
last hop a range has the questions of all batches, answers them, and answers go back the
same way. There are as many groups in each hop as batches, none larger than a batch;
messages grow with the batches, times the number of hops: one up to 128 batches, two up to
16,384, four at a hundred terabytes.

Keys are 64-bit hashes, counts come in two columns. Both are packed: differences by byte
planes, and deflated.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapsync.llm.common import written

FAN = 128


def packed_keys(keys: np.ndarray) -> bytes:
    """Sorted hashes: their differences by byte planes, which zlib makes small."""
    steps = np.diff(keys, prepend=np.uint64(0)).astype("<u8")
    planes = steps.view(np.uint8).reshape(-1, 8).T
    used = 8 - int(np.argmax(planes[::-1].any(1))) if len(keys) and planes.any() else 0
    return bytes([used]) + zlib.compress(np.ascontiguousarray(planes[:used]).tobytes(), 1)


def unpacked_keys(data: bytes, n: int) -> np.ndarray:
    planes = np.zeros((8, n), np.uint8)
    used = data[0]
    flat = np.frombuffer(zlib.decompress(data[1:]), np.uint8)
    planes[:used] = flat.reshape(used, n)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<u8").ravel(), dtype=np.uint64)


def packed_counts(counts: np.ndarray) -> bytes:
    planes = counts.astype("<u8").view(np.uint8).reshape(-1, 8).T
    used = 8 - int(np.argmax(planes[::-1].any(1))) if planes.any() else 0
    return bytes([used]) + zlib.compress(np.ascontiguousarray(planes[:used]).tobytes(), 1)


def unpacked_counts(data: bytes, n: int) -> np.ndarray:
    planes = np.zeros((8, n), np.uint8)
    used = data[0]
    planes[:used] = np.frombuffer(zlib.decompress(data[1:]), np.uint8).reshape(used, n)
    return np.ascontiguousarray(planes.T).view("<u8").ravel().astype(np.int64)


# Messages ----------------------------------------------------------------

# ``span``: the range of keys, ``team``: the group of batches, ``sender``: the batch, or the
# team of the hop before. ``both``: whether the second column is asked for.
ASKED = "span long, team long, sender long, kind int, both boolean, n long, keys binary, c0 binary, c1 binary"
ANSWERED = "span long, sender long, kind int, n long, c0 binary, c1 binary"
SUMS = "kind int, s0 long, s1 long, t0 long, t1 long"
Question = tuple[int, np.ndarray, np.ndarray, np.ndarray, bool]


def _arrow(schema: str) -> pa.Schema:
    kinds = {"int": pa.int32(), "long": pa.int64(), "boolean": pa.bool_(), "binary": pa.binary()}
    return pa.schema([(n, kinds[k]) for n, k in (f.split() for f in schema.split(", "))])


def hops_for(batches: int, most: int | None = None) -> tuple[int, int]:
    """(hops, fan): the fewest hops of which none cuts in more than ``most``."""
    most, hops = most or FAN, 1
    while most**hops < batches:
        hops += 1
    fan = max(1, round(batches ** (1 / hops)))
    while fan**hops < batches:
        fan += 1
    return hops, fan


def _split(keys: np.ndarray, span: int, parts: int, fan: int) -> Iterator[tuple[int, int, int]]:
    """(range, first, end) of the filled ones of ``fan`` ranges in range ``span`` of ``parts``."""
    spans = range(span * fan + 1, span * fan + fan)
    edges = np.array([-(-(s << 64) // (parts * fan)) for s in spans], np.uint64)
    at = [0, *np.searchsorted(keys, edges).tolist(), len(keys)]
    for i, (a, b) in enumerate(zip(at, at[1:])):
        if a < b:
            yield span * fan + i, a, b


def _message(span, team, sender, kind, both, keys, c0, c1) -> pa.RecordBatch:
    values = [span, team, sender, kind, both, len(keys), packed_keys(keys), packed_counts(c0), packed_counts(c1)]
    return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(values, _arrow(ASKED))], schema=_arrow(ASKED))


def _columns(group: pa.Table, *names: str) -> list[list]:
    return [group.column(c).to_pylist() for c in names]


def _joined(group: pa.Table) -> tuple:
    """Distinct keys of questions, the sums of both columns, and where each question's lie."""
    sizes, keys, c0, c1 = _columns(group, "n", "keys", "c0", "c1")
    flat = np.concatenate([unpacked_keys(k, n) for k, n in zip(keys, sizes)])
    known, where = np.unique(flat, return_inverse=True)
    del flat
    sums = [
        np.bincount(where, np.concatenate([unpacked_counts(c, n) for c, n in zip(column, sizes)]), len(known)).astype(np.int64)
        for column in (c0, c1)
    ]
    return known, sums, where, np.cumsum([0, *sizes])


def _answers(group: pa.Table, sums: list[np.ndarray], where: np.ndarray, ends: np.ndarray) -> pa.Table:
    """Each question of a group with the sums for its keys."""
    both = group.column("both").to_pylist()
    spans = list(zip(ends, ends[1:]))
    return pa.Table.from_arrays(
        [
            group.column("span"), group.column("sender"), group.column("kind"), group.column("n"),
            pa.chunked_array([pa.array([packed_counts(sums[0][where[a:b]]) for a, b in spans], pa.binary())]),
            pa.chunked_array(
                [pa.array([packed_counts(sums[1][where[a:b]]) if w else None for (a, b), w in zip(spans, both)], pa.binary())]
            ),
        ],
        schema=_arrow(ANSWERED),
    )


def _next_hop(questions: DataFrame, parts: int, fan: int) -> DataFrame:
    """The questions of the next hop: those of a group joined, and cut in ``fan`` ranges."""

    def forward(group: pa.Table) -> pa.Table:
        span, team, kind = (group.column(c)[0].as_py() for c in ("span", "team", "kind"))
        known, (c0, c1), _, _ = _joined(group)
        both = any(group.column("both").to_pylist())
        return pa.Table.from_batches(
            [
                _message(s, team // fan, team, kind, both, known[a:b], c0[a:b], c1[a:b])
                for s, a, b in _split(known, span, parts, fan)
            ],
            schema=_arrow(ASKED),
        )

    return questions.groupBy("span", "team", "kind").applyInArrow(forward, ASKED)


def _handed_back(questions: DataFrame, answers: DataFrame, fan: int) -> DataFrame:
    """Answers to the questions of a hop, from those to the hop that followed."""

    def back(asked: pa.Table, replies: pa.Table) -> pa.Table:
        known, _, where, ends = _joined(asked)
        replies = replies.sort_by("span")
        sizes, *columns = _columns(replies, "n", "c0", "c1")
        if sum(sizes) != len(known):
            raise ValueError("a group differs from the one that asked")
        sums = [
            np.concatenate(
                [np.zeros(n, np.int64) if c is None else unpacked_counts(c, n) for c, n in zip(column, sizes)]
            )
            for column in columns
        ]
        return _answers(asked, sums, where, ends)

    up = answers.select(F.floor(F.col("span") / fan).alias("at"), F.col("sender").alias("of"), "*")
    asked = questions.groupBy("span", "team", "kind")
    return asked.cogroup(up.groupBy("at", "of", "kind")).applyInArrow(back, ANSWERED)


def counted(
    packs: DataFrame, ask: Callable[[bytes], Iterator[Question]], label: str
) -> tuple[DataFrame, DataFrame]:
    """Answers to what ``ask(blob)`` wants for each row (batch, blob) of the written ``packs``.

    ``ask`` gives (kind, sorted distinct keys, first counts, second counts, whether the
    second sums are wanted). The answers (sender, kind, span, n, c0, c1) of a batch have the
    sums for its keys, in order of ``span``. The other table has per kind the sums of both
    columns, and how many keys have more than none in the first (``t0``), and more in the
    first than in the second (``t1``).
    """
    batches = max(1, packs.count())
    hops, fan = hops_for(batches)
    teams = -(-batches // fan)

    def first(rows):
        for batch in rows:
            for number, team, blob in zip(*(batch.column(c).to_pylist() for c in ("batch", "team", "blob"))):
                for kind, keys, c0, c1, both in ask(blob):
                    for s, a, b in _split(keys, 0, 1, fan):
                        yield _message(s, team, number, kind, both, keys[a:b], c0[a:b], c1[a:b])

    team = F.pmod(F.xxhash64("batch"), F.lit(teams)).alias("team")
    questions = [packs.select("batch", team, "blob").mapInArrow(first, ASKED)]
    if hops > 1:
        questions[0] = written(questions[0], f"{label}-asked")
    for hop in range(1, hops):
        questions.append(_next_hop(questions[-1], fan**hop, fan))
        if hop + 1 < hops:
            questions[-1] = written(questions[-1], f"{label}-asked")

    def answer(group: pa.Table) -> pa.Table:
        kind = group.column("kind")[0].as_py()
        known, sums, where, ends = _joined(group)
        found = _answers(group, sums, where, ends)
        # One row without a sender has the totals, packed as the counts are.
        totals = [sums[0].sum(), sums[1].sum(), (sums[0] > 0).sum(), (sums[0] > sums[1]).sum()]
        row = [group.column("span")[0].as_py(), None, kind, 4, packed_counts(np.array(totals, np.int64)), None]
        whole = pa.Table.from_arrays([pa.array([v], f.type) for v, f in zip(row, _arrow(ANSWERED))], schema=_arrow(ANSWERED))
        return pa.concat_tables([found, whole])

    last = written(questions[-1].groupBy("span", "kind").applyInArrow(answer, ANSWERED), f"{label}-answers")

    def totals(rows):
        for batch in rows:
            found = [unpacked_counts(c, 4) for c in batch.column("c0").to_pylist()]
            values = np.array(found, np.int64).reshape(-1, 4).T
            yield pa.RecordBatch.from_arrays([batch.column("kind"), *map(pa.array, values)], schema=_arrow(SUMS))

    sums = last.filter("sender IS NULL").select("kind", "c0").mapInArrow(totals, SUMS)
    sums = sums.groupBy("kind").agg(*[F.sum(c).alias(c) for c in ("s0", "s1", "t0", "t1")])
    answers = last.filter("sender IS NOT NULL")
    for hop in range(hops - 2, -1, -1):
        answers = written(_handed_back(questions[hop], answers, fan), f"{label}-answers")
    return answers, sums
