"""Catalog relations of an opened source: tables, columns and keys."""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapsync.functions.names import quoted
from snapsync.sources import base
from snapsync.sources.base import Opened

CANDIDATES = T.StructType(
    [
        T.StructField("table_name", T.StringType()),
        T.StructField("column_name", T.StringType()),
        T.StructField("ordinal_position", T.IntegerType()),
        T.StructField("is_key", T.BooleanType()),
    ]
)

# The error of estimated distinct counts. A column is ruled out only if the estimate is
# below half the rows, which is ten times that error away from a key.
DISTINCT_ERROR = 0.05

KEY_JOIN = ["constraint_name", "table_schema", "table_name"]


def tables(
    opened: Opened, sizes: str = "stored", wanted: Callable[[str], bool] | None = None
) -> DataFrame:
    """One row per base table of the source's database, with its size."""
    return (
        opened.tables(sizes, wanted)
        .filter(F.col("table_schema") == opened.database)
        .filter(F.col("data_length").isNotNull())
        .select(
            "table_name",
            "table_rows",
            "data_length",
            "index_length",
            (F.col("data_length") + F.coalesce("index_length", F.lit(0))).alias("size_bytes"),
        )
    )


def columns(opened: Opened) -> DataFrame:
    return (
        opened.columns()
        .filter(F.col("table_schema") == opened.database)
        .select("table_name", "column_name", "ordinal_position", "data_type")
    )


def primary_keys(constraints: DataFrame, key_usage: DataFrame, database: str) -> DataFrame:
    """``table_name, primary_key`` with the key columns in their declared order."""
    return (
        constraints.filter(F.col("constraint_type") == "PRIMARY KEY")
        .filter(F.col("table_schema") == database)
        .join(key_usage, KEY_JOIN)
        .groupBy("table_name")
        .agg(
            F.transform(
                F.array_sort(F.collect_list(F.struct("ordinal_position", "column_name"))),
                lambda c: c["column_name"],
            ).alias("primary_key")
        )
    )


def keys(opened: Opened) -> DataFrame:
    return primary_keys(opened.constraints(), opened.key_usage(), opened.database)


# Key discovery, for sources that declare none ---------------------------


def _can_be_key(data_type: T.DataType) -> bool:
    return not isinstance(data_type, (T.ArrayType, T.MapType, T.StructType, T.VariantType))


def _compact(column: Column, data_type: T.DataType) -> Column:
    """Values of 32 bytes and more as their SHA-256, so that a distinct count
    shuffles at most 32 bytes a value; shorter ones stay as they are."""
    if not isinstance(data_type, (T.StringType, T.BinaryType)):
        return column
    raw = column.cast("binary")
    return F.when(F.octet_length(raw) >= 32, F.unhex(F.sha2(raw, 256))).otherwise(raw)


def _may_be_keys(df: DataFrame) -> list[str]:
    """The columns that may be keys, from one pass without a shuffle.

    A column with a NULL is no key, nor is one with fewer possible values between its
    least and greatest than there are rows, nor one with far fewer distinct values.
    """
    fields = [f for f in df.schema.fields if _can_be_key(f.dataType)]
    if not fields:
        return []
    n = F.count(F.lit(1))
    checks = [n > 0]
    for f in fields:
        column = F.col(quoted(f.name))
        may_be = (F.count(column) == n) & (
            F.approx_count_distinct(column, DISTINCT_ERROR) * 2 >= n
        )
        if isinstance(f.dataType, T.IntegralType):
            wide = column.cast("decimal(20,0)")
            may_be = may_be & (F.max(wide) - F.min(wide) + 1 >= n)
        checks.append(may_be)
    some, *found = df.agg(*[c.alias(f"c{i}") for i, c in enumerate(checks)]).first()
    return [f.name for f, may_be in zip(fields, found) if some and may_be]


def _as_bytes(column: Column, data_type: T.DataType) -> Column:
    """Values as bytes that are equal where the values are."""
    if isinstance(data_type, T.TimestampType):
        # As text, both sides of a clock change would be the same.
        column = F.unix_micros(column)
    elif isinstance(data_type, (T.DoubleType, T.FloatType)):
        column = F.when(column == 0, F.abs(column)).otherwise(column)
    if not isinstance(data_type, T.BinaryType):
        column = column.cast("string").cast("binary")
    return _compact(column, T.BinaryType())


def candidate_keys(frames: dict[str, DataFrame]) -> DataFrame:
    """``table_name, column_name, ordinal_position, is_key`` for every column:
    whether the table has rows, none is NULL there and no two are the same.

    One pass over each table rules out most columns. The values of the others are
    counted exactly, all of them in one shuffle; values stay in Spark.
    """
    if not frames:
        raise ValueError("no tables to profile")
    spark = next(iter(frames.values())).sparkSession
    found = base.at_once(_may_be_keys, frames.values())
    may_be = {(name, c) for name, columns in zip(frames, found) for c in columns}
    listed, values = [], []
    for name, df in frames.items():
        counted = []
        for position, f in enumerate(df.schema.fields, start=1):
            listed.append((name, f.name, position, False))
            if (name, f.name) in may_be:
                value = _as_bytes(F.col(quoted(f.name)), f.dataType)
                counted.append(
                    F.struct(F.lit(f.name).alias("column_name"), value.alias("v"))
                )
        if counted:
            values.append(
                df.select(F.explode(F.array(counted)).alias("c")).select(
                    F.lit(name).alias("table_name"), "c.*"
                )
            )
    columns = base.local_frame(spark, listed, CANDIDATES)
    if not values:
        return columns
    which = ["table_name", "column_name"]
    found = (
        base.union_all(values)
        .groupBy(*which, "v")
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy(*which)
        .agg((F.max("n") == 1).alias("unique"))
    )
    return columns.join(found, which, "left").select(
        *which, "ordinal_position", F.coalesce("unique", F.lit(False)).alias("is_key")
    )


KEY_SETS = T.StructType(
    [
        T.StructField("table_name", T.StringType()),
        T.StructField("key", T.ArrayType(T.StringType())),
    ]
)
# The error of estimates of sets, and how far below the rows one rules a set out: six times it.
SET_ERROR = 0.02
# Of so many hashes one is counted before all are.
FEW = 64


def _estimates(df: DataFrame, sets: Sequence[Sequence[str]]) -> list[int]:
    """The rows, and how many different values each set of columns has, estimated in one pass.

    The sketches of tasks are merged; no value leaves its task.
    """
    hashes = [F.xxhash64(*[F.col(quoted(c)) for c in columns]) for columns in sets]
    counts = [F.approx_count_distinct(h, SET_ERROR).alias(f"c{i}") for i, h in enumerate(hashes)]
    return list(df.agg(F.count(F.lit(1)).alias("n"), *counts).first())


def _set_value(df: DataFrame, columns: Sequence[str]) -> Column:
    """32 bytes that are equal where the values of all columns are."""
    parts = []
    for c in columns:
        value = _as_bytes(F.col(quoted(c)), df.schema[c].dataType)
        # The length keeps ("a", "bc") and ("ab", "c") apart.
        parts += [F.octet_length(value).cast("string"), F.lit(":"), F.hex(value)]
    return F.unhex(F.sha2(F.concat(*parts).cast("binary"), 256))


def _set_hash(columns: Sequence[str]) -> Column:
    """64 bits that are equal where the values of all columns are; NULL where one is NULL."""
    values = [F.col(quoted(c)) for c in columns]
    some_null = reduce(Column.__or__, [v.isNull() for v in values])
    return F.when(~some_null, F.xxhash64(*values))


def _repeated(df: DataFrame, sets: Sequence[tuple[str, ...]], one_in: int = 1) -> dict[int, list[int | None]]:
    """The least and the greatest hash that several rows have, by the number of the set.

    Of the hashes, those that ``one_in`` divides. A hash travels once a row and is not
    counted before, as nearly all of them differ.
    """
    hashes = [F.struct(F.lit(i).alias("i"), _set_hash(c).alias("h")) for i, c in enumerate(sets)]
    rows = df.select(F.explode(F.array(hashes)).alias("s")).select("s.*")
    if one_in > 1:
        rows = rows.filter(F.col("h") % one_in == 0)
    counted = rows.repartition("i", "h").groupBy("i", "h").agg(F.count(F.lit(1)).alias("n"))
    found = counted.filter("n > 1").groupBy("i").agg(F.min("h").alias("low"), F.max("h").alias("high"))
    return {r.i: [r.low, r.high] for r in found.collect()}


def _is_repeated(df: DataFrame, columns: tuple[str, ...], hashes: Sequence[int | None] | None = None) -> bool:
    """Whether two rows have the same values, of all or of those with one of the hashes."""
    if hashes is not None:
        own = _set_hash(columns)
        df = df.filter(reduce(Column.__or__, [own.eqNullSafe(F.lit(h)) for h in hashes]))
    values = df.select(_set_value(df, columns).alias("v"))
    return not values.groupBy("v").count().filter("count > 1").isEmpty()


def _unique_sets(df: DataFrame, sets: Sequence[tuple[str, ...]]) -> list[tuple[str, ...]]:
    """The sets of columns of which no two rows have the same values.

    Sets that repeat among the few hashes that FEW divides are ruled out first. Then all
    hashes of the others are counted, those of all sets in one shuffle. Where none repeats
    no values do; else the values behind two of them are compared, and all values if those
    only share their hash.
    """
    left = list(sets)
    for one_in in (FEW, 1):
        if not left:
            break
        repeated = _repeated(df, left, one_in)
        gone = [i for i, h in repeated.items() if _is_repeated(df, left[i], h)]
        if one_in == 1:
            gone += [i for i in repeated if i not in gone and _is_repeated(df, left[i])]
        left = [c for i, c in enumerate(left) if i not in gone]
    return left


def minimal_keys(df: DataFrame, width: int = 2) -> list[tuple[str, ...]]:
    """The sets of up to ``width`` columns that are keys, and of which no part is one.

    Level by level: sets are made of columns without NULLs, none of them around a key that
    is known. A set is ruled out if its columns have fewer combinations than there are rows,
    then by its estimate; only what is left is counted. Measurements are no key columns.
    """
    fields = [f for f in df.schema.fields if _can_be_key(f.dataType)]
    fields = [f.name for f in fields if not isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    if not fields:
        return []
    n, *filled = df.agg(F.count(F.lit(1)), *[F.count(F.col(quoted(c))) for c in fields]).first()
    columns = [c for c, k in zip(fields, filled) if n and k == n]
    found: list[tuple[str, ...]] = []
    distinct: dict[str, int] = {}
    for size in range(1, width + 1):
        sets = [s for s in combinations(columns, size) if not any(set(k) <= set(s) for k in found)]
        if size > 1:
            # Of an estimate that is too low by all of its error.
            most = {s: math.prod(distinct[c] * (1 + 6 * SET_ERROR) for c in s) for s in sets}
            sets = [s for s in sets if most[s] >= n]
        if not sets:
            continue
        _, *estimates = _estimates(df, sets)
        if size == 1:
            distinct = {s[0]: e for s, e in zip(sets, estimates)}
        likely = [s for s, e in zip(sets, estimates) if e >= n * (1 - 6 * SET_ERROR)]
        found += _unique_sets(df, likely)
    return found


def composite_keys(frames: Mapping[str, DataFrame], width: int = 2) -> DataFrame:
    """``table_name, key``: the minimal keys of tables that no single column is a key of.

    Of integral columns, as texts and measurements that happen to differ are no keys.
    """

    def integral(df: DataFrame) -> DataFrame:
        names = [f.name for f in df.schema.fields if isinstance(f.dataType, T.IntegralType)]
        return df.select(*map(quoted, names))

    found = base.at_once(lambda df: minimal_keys(integral(df), width), frames.values())
    rows = [
        (name, list(key))
        for name, keys in zip(frames, found)
        if not any(len(k) == 1 for k in keys)
        for key in keys
    ]
    return base.local_frame(next(iter(frames.values())).sparkSession, rows, KEY_SETS)


def check_keys(frames: dict[str, DataFrame], keys: Mapping[str, Sequence[str]]) -> DataFrame:
    """``table_name, n_rows, n_keys, is_key`` of declared keys of any width.

    ``n_keys`` counts the different keys without a NULL in them. Tables that are not
    there are left out.
    """
    n = F.count(F.lit(1))
    counted = []
    for name, columns in keys.items():
        if name not in frames:
            continue
        df = frames[name]
        n_keys = F.count_distinct(
            *[_compact(F.col(quoted(c)), df.schema[c].dataType) for c in columns]
        )
        counted.append(
            df.select(
                F.lit(name).alias("table_name"),
                n.alias("n_rows"),
                n_keys.alias("n_keys"),
                ((n == n_keys) & (n > 0)).alias("is_key"),
            )
        )
    return base.union_all(counted)


def inferred_constraints(
    candidates: DataFrame, columns: DataFrame, database: str
) -> tuple[DataFrame, DataFrame]:
    """Candidate keys as ``(constraints, key_usage)``, as a guess.

    The first integral one of a table becomes its primary key, the others are unique
    constraints: a column of texts or measurements that happen to differ is no key.
    """
    spark = candidates.sparkSession
    integral = F.lower("data_type").isin(*base.INTEGRAL_TYPES).alias("integral")
    kinds = columns.select("table_name", "column_name", integral)
    # One short row per key column; both relations are built from it.
    found = (
        candidates.filter("is_key")
        .join(kinds, ["table_name", "column_name"])
        .orderBy("table_name", "ordinal_position")
        .collect()
    )
    constraints, usage, seen = [], [], set()
    for r in found:
        primary = r.integral and r.table_name not in seen
        if primary:
            seen.add(r.table_name)
        name = "PRIMARY" if primary else f"unique_{r.column_name}"
        kind = "PRIMARY KEY" if primary else "UNIQUE"
        constraints.append((name, database, r.table_name, kind))
        usage.append((name, database, r.table_name, r.column_name, 1))
    return (
        base.local_frame(spark, constraints, base.CONSTRAINTS),
        base.local_frame(spark, usage, base.KEY_USAGE),
    )
