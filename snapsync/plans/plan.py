"""The copy plan: one row per table to copy."""

from __future__ import annotations

import logging
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapsync.functions.names import target_name
from snapsync.options import MUTABLE_MARKER, CopyOptions
from snapsync.plans.select import chosen_tables, selected
from snapsync.plans.splits import KEY_RANGES, key_range
from snapsync.sources import catalog
from snapsync.sources.base import INTEGRAL_TYPES, Opened, local_frame

log = logging.getLogger(__name__)


def _never_updated(marker: str) -> Column:
    return ~F.bool_or(F.lower("column_name") == marker.lower())


def immutability(columns: DataFrame, marker: str = MUTABLE_MARKER) -> DataFrame:
    """``table_name, immutable``: a table is mutable iff it has the marker column."""
    return columns.groupBy("table_name").agg(_never_updated(marker).alias("immutable"))


def bytes_to_sync(high_water: Column) -> Column:
    """Bytes of the rows above the high-water mark, if keys are spread evenly;
    all bytes where there is no mark."""
    low, high = F.col("min_key").cast("double"), F.col("max_key").cast("double")
    share = (high - high_water.cast("double")) / F.greatest(high - low, F.lit(1.0))
    partial = F.col("size_bytes") * F.greatest(F.lit(0.0), F.least(F.lit(1.0), share))
    return F.coalesce(F.ceil(partial), F.col("size_bytes")).cast("long")


def split_count(options: CopyOptions) -> Column:
    """Splits for the bytes to read: at least one, and of an integral key without a second
    column no more than there are keys."""
    by_size = F.ceil(F.col("bytes_to_sync") / F.lit(options.bytes_per_split))
    n = by_size if options.max_splits is None else F.least(by_size, F.lit(options.max_splits))
    span = (
        F.col("max_key").cast("decimal(20,0)") - F.col("min_key").cast("decimal(20,0)") + 1
    )
    n = F.when(F.col("second_column").isNull(), F.least(n, span)).otherwise(n)
    if not options.auto_split:
        n = F.lit(1)
    may_split = F.col("key_column").isNotNull() | F.col("by_order")
    return F.when(may_split, F.greatest(n, F.lit(1))).otherwise(F.lit(1)).cast("int")


def split_rule(options: CopyOptions) -> Column:
    """How to place the split bounds: by key ``range``, by ``rows`` that the source counts
    per range, or by the ``order`` of keys that are not integral."""
    rule = F.lit("range" if options.split_by == "range" else "rows")
    rule = F.when(F.col("key_column").isNotNull(), rule).otherwise(F.lit("order"))
    return F.when(F.col("n_splits") > 1, rule)


def _reachable_ranges(opened: Opened, keys: dict[str, str]) -> DataFrame:
    """Key ranges, one row per table, without the tables that cannot be read."""

    def find(key: tuple[str, str]):
        try:
            return key_range(opened, dict([key])).first()
        except Exception as e:
            # Planned unsplit; the copy will fail alike, and report it.
            log.warning("no key range of %s: %s", key[0], type(e).__name__)

    with ThreadPoolExecutor(max_workers=8) as pool:
        found = [r for r in pool.map(find, keys.items()) if r is not None]
    return local_frame(opened.spark, found, KEY_RANGES)


def plan_tables(
    opened: Opened,
    options: CopyOptions,
    prefix: str = "",
    sizes: str = "stored",
    tables: DataFrame | None = None,
    ranges: bool = True,
    high_water: DataFrame | None = None,
    keep_skipped: bool = False,
) -> DataFrame:
    """Selected tables with size, mutability, keys, key range and split count.

    ``key_column`` is the split column: the leading column of the primary key, for
    tables larger than ``min_split_bytes`` whose leading column is integral.
    ``second_column`` is the next integral column of the key. ``high_water``
    (``table_name, high_water``) sizes the splits for the rows above it.
    ``keep_skipped`` keeps the tables that are not to be copied, with their
    ``skip_reason``.
    """
    spark = opened.spark
    if tables is None:
        tables = chosen_tables(opened, options, sizes)
    described = (
        catalog.columns(opened)
        .groupBy("table_name")
        .agg(
            _never_updated(options.marker).alias("immutable"),
            F.collect_list(
                F.when(F.lower("data_type").isin(*INTEGRAL_TYPES), F.col("column_name"))
            ).alias("integral_columns"),
        )
    )
    key = F.col("primary_key")
    large = (F.col("size_bytes") > options.min_split_bytes) & F.col("skip_reason").isNull()
    integral = F.col("integral_columns")
    leading = F.get(key, F.lit(0))
    others = F.filter(F.slice(key, 2, F.size(key)), lambda c: F.array_contains(integral, c))
    facts = (
        (tables if keep_skipped else selected(tables))
        .join(described, "table_name", "left")
        .join(catalog.keys(opened), "table_name", "left")
        .select(
            "table_name",
            "skip_reason",
            "table_rows",
            "size_bytes",
            F.coalesce("immutable", F.lit(True)).alias("immutable"),
            "primary_key",
            F.when(large & F.array_contains(integral, leading), leading).alias("split_key"),
            F.get(others, F.lit(0)).alias("split_second"),
            # Databases order other keys, or hash the rows of tables without one.
            (
                F.lit(opened.splits_any_key)
                & large
                & ~F.coalesce(F.array_contains(integral, leading), F.lit(False))
            ).alias("by_order"),
            F.when((F.size(key) == 1) & F.array_contains(integral, leading), leading).alias(
                "append_key"
            ),
        )
    )
    # One row per table. The driver has to know the large keyed tables to ask for
    # their key ranges, and no others.
    rows = facts.collect()
    facts = local_frame(spark, rows, facts.schema)
    if ranges:
        wanted = {r.table_name: r.split_key for r in rows if r.split_key is not None}
        found = _reachable_ranges(opened, wanted).drop("key_column")
        facts = facts.join(found, "table_name", "left")
        usable = F.col("max_key").isNotNull()
    else:
        facts = facts.withColumns(
            {c: F.lit(None).cast("long") for c in ("min_key", "max_key")}
        )
        usable = F.lit(True)
    if high_water is None:
        facts = facts.withColumn("high_water", F.lit(None).cast("long"))
    else:
        facts = facts.join(high_water, "table_name", "left")
    plan = (
        facts.withColumn("key_column", F.when(usable, F.col("split_key")))
        .withColumn(
            "second_column", F.when(F.col("key_column").isNotNull(), F.col("split_second"))
        )
        .withColumn("bytes_to_sync", bytes_to_sync(F.col("high_water")))
        .withColumn("n_splits", split_count(options))
        .select(
            "table_name",
            target_name("table_name", prefix).alias("target_name"),
            "size_bytes",
            "immutable",
            "primary_key",
            "append_key",
            "key_column",
            "second_column",
            "min_key",
            "max_key",
            "bytes_to_sync",
            "n_splits",
            split_rule(options).alias("split_by"),
            "skip_reason",
        )
    )
    return plan if keep_skipped else plan.drop("skip_reason")
