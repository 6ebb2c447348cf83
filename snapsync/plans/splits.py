"""How a table is cut into key ranges.

``n`` ranges over the keys ``min..max`` start at ``min + i * (max - min + 1) div n``,
so their widths differ by one at most. The first is open below and takes NULL
keys, the last is open above: whatever the bounds, each row is in exactly one.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapsync.functions.names import quoted
from snapsync.functions.predicates import bound_predicates
from snapsync.sources import base
from snapsync.sources.base import Cell, Opened, at_once

LONG_SAFE = 2**62

KEY_RANGES = T.StructType(
    [
        T.StructField("table_name", T.StringType()),
        T.StructField("key_column", T.StringType()),
        T.StructField("min_key", T.LongType()),
        T.StructField("max_key", T.LongType()),
    ]
)


def key_range(opened: Opened, keys: Mapping[str, str]) -> DataFrame:
    """``table_name, key_column, min_key, max_key`` of each table's key."""
    if not keys:
        return base.local_frame(opened.spark, [], KEY_RANGES)
    return base.union_all(
        opened.key_stats(name, key).select(
            F.lit(name).alias("table_name"),
            F.lit(key).alias("key_column"),
            "min_key",
            "max_key",
        )
        for name, key in keys.items()
    )


def split_bounds(plan: DataFrame) -> DataFrame:
    """``table_name, split_id, lower, upper`` of every split of every table that
    has a key range. ``lower`` is inside the split, ``upper`` is not; NULL is open."""
    lowest = F.col("min_key").cast("decimal(20,0)")
    span = F.col("max_key").cast("decimal(20,0)") - lowest + 1

    def start(split: Column) -> Column:
        # Decimal arithmetic, as a span of longs and its multiples do not fit a long.
        offset = split.cast("decimal(10,0)") * span
        n = F.col("n_splits").cast("decimal(10,0)")
        return (lowest + (offset - offset % n) / n).cast("long")

    split = F.col("split_id")
    return (
        plan.filter(F.col("min_key").isNotNull())
        .select(
            "table_name",
            "min_key",
            "max_key",
            "n_splits",
            F.explode(F.sequence(F.lit(0), F.col("n_splits") - 1)).alias("split_id"),
        )
        .select(
            "table_name",
            "split_id",
            F.when(split > 0, start(split)).alias("lower"),
            F.when(split < F.col("n_splits") - 1, start(split + 1)).alias("upper"),
        )
    )


def range_starts(low: int, high: int, n: int) -> list[int]:
    """Where the second and later of ``n`` equal-width ranges start."""
    return [low + i * (high - low + 1) // n for i in range(1, n)]


def split_of(key: str, low: int, high: int, n: int) -> Column:
    """The number of the range that holds a row."""
    column = quoted(key)
    span = high - low + 1
    if span * n < LONG_SAFE and -LONG_SAFE < low:
        k, base_key, width = f"CAST({column} AS BIGINT)", f"{low}L", f"{span}L"
    else:
        k = f"CAST({column} AS DECIMAL(20,0))"
        base_key, width = f"CAST('{low}' AS DECIMAL(20,0))", f"CAST('{span}' AS DECIMAL(20,0))"
    return F.expr(
        f"CAST(CASE WHEN {column} IS NULL OR {k} < {base_key} THEN 0"
        f" WHEN {k} > CAST('{high}' AS DECIMAL(20,0)) THEN {n - 1}"
        f" ELSE (({k} - {base_key} + 1) * {n} - 1) div {width} END AS INT)"
    )


def split_histogram(df: DataFrame, key: str, low: int, high: int, n: int) -> DataFrame:
    """Rows and keys per split, to see how even the splits are."""
    k = F.col(quoted(key)).cast("long")
    return (
        df.select(split_of(key, low, high, n).alias("split_id"), k.alias("k"))
        .groupBy("split_id")
        .agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.min("k").alias("min_key"),
            F.max("k").alias("max_key"),
        )
    )


# Pieces that an overfull range is cut into before it is counted again.
REFINE = 16


def even_cells(
    count: Callable[[int, int, int], list[Cell]], low: int, high: int, n: int
) -> list[tuple[int, int]]:
    """About ``n`` ranges as (start, pieces), none above twice its share of the rows.

    ``count(low, high, n)`` has the filled ones of ``n`` equally wide ranges. Ranges above
    twice their share are cut and counted again, until they are small enough or a single
    key; small neighbours are joined. Only counts travel, and each pass reads no more than
    what is still overfull. A key that is too large by itself has as many ``pieces`` as
    it needs.
    """
    cells = count(low, high, n)
    share = max(1, -(-sum(c.n_rows for c in cells) // n))
    done: list[Cell] = []
    while cells:
        wide: list[Cell] = []
        for c in cells:
            (wide if c.n_rows > 2 * share and c.low < c.high else done).append(c)
        cells = [c for part in at_once(lambda c: count(c.low, c.high, REFINE), wide) for c in part]
    packs: list[tuple[int, int]] = []
    held = share
    for c in sorted(done, key=lambda c: c.low):
        if c.n_rows > 2 * share:
            packs.append((c.low, -(-c.n_rows // share)))
            held = share
        elif held + c.n_rows > share:
            packs.append((c.low, 1))
            held = c.n_rows
        else:
            held += c.n_rows
    return packs


def split_predicates(
    opened: Opened,
    name: str,
    columns: Sequence[str],
    n: int,
    where: str | None = None,
    key: Sequence[str] = (),
    fixed: Sequence[str] = (),
) -> list[str]:
    """SQL predicates, about ``n``, that each row of a table (or of ``where``) meets once.

    Ranges of the first column; a value of it that holds several shares is cut by ranges
    of the next column, and so on. Where no column is left, by a hash of the other columns
    of ``key``, of any type, or of all others of the table, if the database has a function
    for it. ``fixed`` columns have one value in ``where``.
    """
    if not columns:
        return ["1 = 1"]
    column, quote = columns[0], opened.quote
    span = opened.key_stats(name, column, where).first()
    if n < 2 or span.max_key is None:
        return ["1 = 1"]

    def count(low: int, high: int, parts: int) -> list[Cell]:
        return opened.key_cells(name, column, low, high, parts, where)

    packs = even_cells(count, span.min_key, span.max_key, n)
    ranges = range_predicates(quote(column), [start for start, _ in packs[1:]])
    same = [*fixed, column]

    def pieces(pack: tuple[tuple[int, int], str]) -> list[str]:
        (start, parts), rows = pack
        if parts < 2:
            return [rows]
        hot = f"{quote(column)} = {start}"
        if columns[1:]:
            inner = split_predicates(
                opened, name, columns[1:], parts, f"{where} AND {hot}" if where else hot, key, same
            )
        else:
            others = [c for c in key if c not in same]
            others = others or [c for c in opened.hashable_columns(name) if c not in same]
            # Rows of one column alone are all alike.
            inner = opened.hash_predicates(others or [column], parts) or ["1 = 1"]
        return [rows] if inner == ["1 = 1"] else [f"{rows} AND {p}" for p in inner]

    return [p for part in at_once(pieces, zip(packs, ranges)) for p in part]


def split_by(predicates: Sequence[str]) -> tuple[Column, Column]:
    """The number of the predicate that reads a row, and how many predicates do."""
    meets = [F.coalesce(F.expr(p), F.lit(False)) for p in predicates]
    number = F.coalesce(*[F.when(m, F.lit(i)) for i, m in enumerate(meets)])
    hits = [m.cast("int") for m in meets]
    return number, sum(hits[1:], hits[0])


def range_predicates(column: str, starts: Sequence[int]) -> list[str]:
    """One SQL predicate per range; ``column`` is quoted for the database."""
    return bound_predicates(column, sorted(set(starts)))


def residue_predicates(column: str, n: int) -> list[str]:
    """``n`` SQL predicates by remainder; NULLs go with remainder 0."""
    if n < 2:
        return ["1 = 1"]
    # Twice, as the remainder of a negative number is negative.
    residue = f"MOD(MOD({column}, {n}) + {n}, {n})"
    return [
        f"({residue} = 0 OR {column} IS NULL)",
        *(f"({residue} = {i})" for i in range(1, n)),
    ]


def composite_predicates(
    leading: str, second: str, starts: Sequence[int], n_residues: int = 1
) -> list[str]:
    """Ranges on the leading key column times remainders of the second."""
    residues = residue_predicates(second, n_residues)
    return [
        rows if n_residues == 1 else f"{rows} AND {r}"
        for rows in range_predicates(leading, starts)
        for r in residues
    ]


def composite_split_of(
    leading: str, second: str, low: int, high: int, n: int, n_residues: int
) -> Column:
    """The number of the range-times-remainder split that holds a row."""
    residue = F.pmod(F.coalesce(F.col(quoted(second)), F.lit(0)), F.lit(n_residues))
    return (split_of(leading, low, high, n) * n_residues + residue).cast("int")
