"""Product codes of vectors; nearest codebook entries by Orchard's search.

Vectors of scaled integers are cut into equal parts, and each part position has a small
codebook, learnt in rounds of assignment and averaging. An assignment walks from entry to
entry: every entry keeps the others sorted by their distance to it, the walk goes down the
list of the best entry so far, jumps to the list of any entry that is nearer, marks what it
has measured, and stops where the list goes beyond twice the best distance, as by the
triangle inequality nothing nearer can follow. All is integer arithmetic on squared
distances, so the walk ends at the very entry that measuring all of them gives.

A round is one pass over the written vectors: tasks add up their parts by entry, and only
sums, as many as codebook numbers, reach the driver. Codebooks are sent to the tasks: their
size is that of ``entries`` vectors, whatever the table's.

NULL vectors and those with a NULL, NaN or infinite component are dropped. A vector whose
length differs from that of the first one by id, or cannot be cut into equal parts, stays
with NULL as code and error and teaches nothing. Rows may repeat; repeated ids count once as
entries, by the vector that is least as bytes. A NULL id is the greatest one. Components of ``LIMIT`` and
beyond (after scaling) raise an error, as their squares would not fit in 64 bits. Other
columns are ignored; an empty table gives no rows and empty codebooks.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapsync.llm.common import written

SCALE = 4096
PARTS, ENTRIES, ROUNDS = 8, 16, 6
LIMIT = 1 << 27
ROWS = 8192  # vectors that a task works on at a time


def scaled(
    df: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label",
    scale: int = SCALE,
) -> DataFrame:
    """``vec_id``, ``label`` and ``vector`` (integers of 32 bits, packed) of usable rows."""
    x = F.col(f"`{vector}`").cast("array<double>")
    rows = df.select(
        F.col(f"`{key}`").alias("vec_id"), F.col(f"`{label}`").alias("label"), x.alias("x")
    )
    schema = rows.select("vec_id", "label", F.lit(b"").alias("vector")).schema

    def run(batches):
        for batch in batches:
            x = batch.column("x")
            x = x.combine_chunks() if isinstance(x, pa.ChunkedArray) else x
            flat = x.flatten()
            values = np.floor(scale * pc.fill_null(flat, np.nan).to_numpy(zero_copy_only=False))
            sizes = pc.fill_null(pc.list_value_length(x), 0).to_numpy().astype(np.int64)
            ends = np.r_[0, np.cumsum(sizes)]
            odd = np.r_[0, np.cumsum(~np.isfinite(values))]
            good = (odd[ends[1:]] == odd[ends[:-1]]) & np.asarray(x.is_valid())
            if (np.abs(values[np.repeat(good, sizes)]) >= LIMIT).any():
                raise ValueError(f"a component is {LIMIT / scale} or greater")
            numbers = np.where(np.isfinite(values), values, 0).astype("<i4")
            packed = [numbers[a:b].tobytes() for a, b, g in zip(ends, ends[1:], good) if g]
            kept = batch.filter(pa.array(good))
            yield pa.RecordBatch.from_arrays(
                [kept.column("vec_id"), kept.column("label"), pa.array(packed, pa.binary())],
                ["vec_id", "label", "vector"],
            )

    return rows.mapInArrow(run, schema)


@dataclass(frozen=True)
class Codebooks:
    """Entries by part: an array (parts, entries, width) of integers."""

    entries: np.ndarray

    @property
    def dimension(self) -> int:
        return self.entries.shape[0] * self.entries.shape[2]

    def digest(self) -> str:
        """SHA-256 of all numbers by part, entry and position, joined by commas."""
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()


class Orchard:
    """One codebook with each entry's list of the others, nearest first."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        apart = ((entries[:, None] - entries[None]) ** 2).sum(2)
        n = len(entries)
        # The entry itself is left out; equal distances go by index.
        order = np.argsort(apart, axis=1, kind="stable")
        self.order = order[order != np.arange(n)[:, None]].reshape(n, max(n - 1, 0))
        self.apart = np.take_along_axis(apart, self.order, 1)

    def nearest(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The nearest entry of each point, ties to the lower index, and the squared distance.

        All walks go on at once, a step of each that has not ended at a time.
        """
        n, size = len(points), len(self.entries)
        best = np.zeros(n, np.int64)
        least = ((points - self.entries[0]) ** 2).sum(1)
        at = np.zeros(n, np.int64)
        seen = np.zeros((n, size), bool)
        seen[:, 0] = True
        going = np.arange(n)
        while size > 1 and len(going):
            here, place = best[going], at[going]
            # Beyond twice the distance; at exactly twice an equal distance may follow.
            on = self.apart[here, place] <= 4 * least[going]
            going, here, place = going[on], here[on], place[on]
            entry = self.order[here, place]
            at[going] = place + 1
            fresh = ~seen[going, entry]
            rows, entry = going[fresh], entry[fresh]
            seen[rows, entry] = True
            found = ((points[rows] - self.entries[entry]) ** 2).sum(1)
            nearer = (found < least[rows]) | ((found == least[rows]) & (entry < best[rows]))
            rows = rows[nearer]
            best[rows], least[rows], at[rows] = entry[nearer], found[nearer], 0
            going = going[at[going] < size - 1]
        return best, least


def _points(batch: pa.RecordBatch, books: Codebooks) -> tuple[np.ndarray, np.ndarray]:
    """Which vectors have the right length, and those as an array (rows, parts, width)."""
    packed = batch.column("vector")
    fits = pc.equal(pc.binary_length(packed), 4 * books.dimension).to_numpy(zero_copy_only=False)
    data = b"".join(packed.filter(pa.array(fits)).to_pylist())
    parts, _, width = books.entries.shape
    rows = int(fits.sum())
    return fits, np.frombuffer(data, "<i4").astype(np.int64).reshape(rows, parts, width)


def first_books(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES) -> Codebooks:
    """The parts of the ``entries`` vectors of smallest id."""
    order = F.col("vec_id").asc_nulls_last()
    ids = [r.vec_id for r in vectors.select("vec_id").distinct().orderBy(order).limit(entries).collect()]
    wanted = F.col("vec_id").isin([i for i in ids if i is not None])
    own = vectors.filter(wanted | F.col("vec_id").isNull() if None in ids else wanted)
    # The least by its numbers' bytes, where an id has several vectors.
    found = own.groupBy("vec_id").agg(F.min("vector").alias("vector")).orderBy(order).collect()
    found = [np.frombuffer(bytes(r.vector), "<i4").astype(np.int64) for r in found]
    if not found or len(found[0]) % parts:
        return Codebooks(np.zeros((parts, 0, 0), np.int64))
    alike = [v for v in found if len(v) == len(found[0])]
    return Codebooks(np.stack(alike).reshape(len(alike), parts, -1).swapaxes(0, 1))


def _sums(vectors: DataFrame, books: Codebooks) -> np.ndarray:
    """(parts, entries, 1 + width): how many parts each entry is nearest to, and their sum."""
    parts, size, width = books.entries.shape
    sent = vectors.sparkSession.sparkContext.broadcast(books)

    def run(batches):
        books = sent.value
        total = np.zeros((parts, size, 1 + width), np.int64)
        trees = [Orchard(e) for e in books.entries]
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS):
                _, points = _points(batch.slice(start, ROWS), books)
                for p, tree in enumerate(trees):
                    own = np.ascontiguousarray(points[:, p])
                    best, _ = tree.nearest(own)
                    np.add.at(total[p, :, 0], best, 1)
                    np.add.at(total[p, :, 1:], best, own)
        flat = total.ravel()
        used = np.flatnonzero(flat)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(flat[used])], ["place", "amount"])

    sums = vectors.select("vector").mapInArrow(run, "place long, amount long")
    flat = np.zeros(parts * size * (1 + width), np.int64)
    for row in sums.groupBy("place").agg(F.sum("amount").alias("amount")).collect():
        flat[row.place] = row.amount
    return flat.reshape(parts, size, 1 + width)


def trained(
    vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS
) -> Codebooks:
    """Codebooks of the written table ``vectors``; an entry that nothing is nearest to stays."""
    books = first_books(vectors, parts, entries)
    for _ in range(rounds if books.entries.size else 0):
        sums = _sums(vectors, books)
        count, total = sums[..., :1], sums[..., 1:]
        means = np.floor_divide(total, np.maximum(count, 1))
        books = Codebooks(np.where(count > 0, means, books.entries))
    return books


def coded(vectors: DataFrame, books: Codebooks) -> DataFrame:
    """``vectors`` with ``code`` (a byte for each part) and ``error`` (squared distance)."""
    sent = vectors.sparkSession.sparkContext.broadcast(books)
    schema = vectors.select(
        "vec_id", "label", F.lit(b"").alias("code"), F.lit(0).cast("long").alias("error")
    ).schema
    for field in schema.fields:
        field.nullable = True

    def run(batches):
        books = sent.value
        trees = [Orchard(e) for e in books.entries]
        for whole in batches:
            for start in range(0, whole.num_rows, ROWS):
                batch = whole.slice(start, ROWS)
                if not books.entries.size:
                    # Vectors without numbers, or none that can be cut: nothing to code with.
                    codes, errors = [None] * batch.num_rows, [None] * batch.num_rows
                else:
                    fits, points = _points(batch, books)
                    best = np.zeros((len(points), len(trees)), np.uint8)
                    error = np.zeros(len(points), np.int64)
                    for p, tree in enumerate(trees):
                        best[:, p], least = tree.nearest(np.ascontiguousarray(points[:, p]))
                        error += least
                    where = np.cumsum(fits) - 1
                    codes = [best[w].tobytes() if f else None for w, f in zip(where, fits)]
                    errors = [int(error[w]) if f else None for w, f in zip(where, fits)]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("vec_id"), batch.column("label"),
                        pa.array(codes, pa.binary()), pa.array(errors, pa.int64()),
                    ],
                    ["vec_id", "label", "code", "error"],
                )

    return vectors.mapInArrow(run, schema)


def decoded(codes: Column, books: Codebooks) -> Column:
    """The scaled integers that a code stands for."""
    numbers = [
        F.array(*[F.array(*[F.lit(v) for v in entry]) for entry in part])
        for part in books.entries.tolist()
    ]
    digits = F.hex(codes)
    return F.concat(
        *[
            F.get(part, F.conv(F.substring(digits, 2 * p + 1, 2), 16, 10).cast("int"))
            for p, part in enumerate(numbers)
        ]
    )


def with_label_error(found: DataFrame) -> DataFrame:
    """``found`` with the errors summed over equal labels, NULLs together.

    Labels meet their sum in a join that Spark can cut where a label has many rows.
    """
    sums = found.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error"))
    return found.join(sums, F.col("label").eqNullSafe(F.col("of"))).drop("of")


def compressed(
    df: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label",
    parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE,
) -> tuple[DataFrame, Codebooks]:
    """Per usable row: vec_id, label, code, error, label_error; and the codebooks."""
    if not 1 <= entries <= 256:
        raise ValueError("1 to 256 entries")
    vectors = written(scaled(df, key, vector, label, scale), "vectors")
    books = trained(vectors, parts, entries, rounds)
    return with_label_error(written(coded(vectors, books), "codes")), books
