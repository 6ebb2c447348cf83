"""Scans of whole tables, as their plan row says."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapsync.functions.names import quoted
from snapsync.functions.predicates import hot_bound_predicates
from snapsync.options import CopyOptions
from snapsync.plans.splits import (
    composite_predicates,
    range_starts,
    split_predicates,
)
from snapsync.sources.base import Opened
from snapsync.sources.jdbc import OpenedJdbc, literal

# Queries of a table without any key: each scans all of it in the database, so there are
# few of them, and one more for each further 4 GB.
HASH_SPLITS, HASH_BYTES = 8, 4 << 30


def read_table(
    opened: Opened,
    row: Mapping[str, Any],
    options: CopyOptions | None = None,
    above: int | None = None,
) -> DataFrame:
    """All rows of one table, or those with a key greater than ``above``.

    Where the plan row has an ``upper_cut``, rows with a greater key are left out: the
    condition goes into the query of every split.
    """
    df = _all_rows(opened, row, options or CopyOptions(), above)
    cut, key = row.get("upper_cut"), row.get("cut_column")
    if cut is None or key is None:
        return df
    return df.filter((F.col(quoted(key)) <= F.lit(cut)) | F.col(quoted(key)).isNull())


def _all_rows(
    opened: Opened, row: Mapping[str, Any], options: CopyOptions, above: int | None
) -> DataFrame:
    """The rows as the plan row says how to read them.

    A database is read in ``n_splits`` parallel queries where the plan row has a
    key range, and in one otherwise. Files are cut into tasks by Spark itself; a
    ``bytes_per_split`` above Spark's own makes them fewer.
    """
    name, key, n = row["table_name"], row.get("key_column"), row.get("n_splits") or 1
    low, high, second = row.get("min_key"), row.get("max_key"), row.get("second_column")
    if not isinstance(opened, OpenedJdbc):
        # One scan per key range would only read the same row groups many times.
        df = opened.read(name)
        if above is not None:
            return df.filter(F.col(quoted(row["append_key"])) > above)
        # Larger splits than Spark cuts, where that leaves work for all cores. This
        # joins tasks without a shuffle, and makes fewer and larger files.
        wanted = -(-(row.get("size_bytes") or 0) // options.bytes_per_split)
        enough = wanted >= opened.spark.sparkContext.defaultParallelism
        return df.coalesce(wanted) if enough else df
    if above is not None:
        n, high = (n, high) if high is not None and high > above else (1, above)
        return opened.read_range(name, row["append_key"], above, high, n, above)
    if n < 2:
        return opened.read(name)
    if row.get("split_by") == "order":
        return _without_integral_key(opened, name, row, n)
    if key is None or low is None or high is None:
        return opened.read(name)
    columns = [key] if second is None else [key, second]
    if row.get("bounds"):
        return opened.read_where(name, sketched_predicates(opened, name, key, row))
    if (row.get("split_by") or options.split_by) == "rows":
        primary = row.get("primary_key") or []
        integral = [f.name for f in opened.read(name).schema if isinstance(f.dataType, T.IntegralType)]
        columns += [c for c in primary if c in integral and c not in columns]
        return opened.read_where(name, split_predicates(opened, name, columns, n, key=primary))
    n_ranges = min(n, high - low + 1)
    n_residues = -(-n // n_ranges)
    if second is not None and n_residues > 1:
        leading, other = map(opened.quote, columns)
        starts = range_starts(low, high, n_ranges)
        return opened.read_where(name, composite_predicates(leading, other, starts, n_residues))
    return opened.read_range(name, key, low, high, n_ranges)


def sketched_predicates(opened: Opened, name: str, key: str, row: Mapping[str, Any]) -> list[str]:
    """Ranges between the keys of ``bounds``; one that repeats is cut by the other columns."""
    others = [c for c in row.get("primary_key") or [] if c != key]
    others = others or [c for c in opened.hashable_columns(name) if c != key]
    cuts = [literal(b) for b in row["bounds"]]
    return hot_bound_predicates(
        opened.quote(key), cuts, lambda parts: opened.hash_predicates(others, parts)
    )


def _without_integral_key(opened: OpenedJdbc, name: str, row: Mapping[str, Any], n: int):
    """Parallel queries of a table that has no integral key to cut by.

    Ranges of its leading key column, placed by the order of the database's index; without
    a key, or one of a type without literals, remainders of a hash of its columns, each of
    which scans the table.
    """
    key = row.get("primary_key")
    if key:
        # NULLs, and keys below the first bound, are in the first range.
        bounds = opened.key_bounds(name, key[0], n)
        if bounds:
            # A value that fills several ranges is cut by the rest of its key.
            others = key[1:] or [c for c in opened.hashable_columns(name) if c != key[0]]
            cut = hot_bound_predicates(
                opened.quote(key[0]), bounds, lambda parts: opened.hash_predicates(others, parts)
            )
            return opened.read_where(name, cut)
    queries = max(HASH_SPLITS, -(-(row.get("size_bytes") or 0) // HASH_BYTES))
    hashed = opened.hash_predicates(opened.hashable_columns(name), min(n, queries))
    return opened.read_where(name, hashed) if hashed else opened.read(name)
