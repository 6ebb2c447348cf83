"""Copies of one table and of all selected tables."""

from __future__ import annotations

import logging
import time
from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapsync.functions.names import quoted
from snapsync.operators import sink
from snapsync.operators.reconcile import reconciled
from snapsync.operators.schema import conform, required
from snapsync.options import ConnectorTarget, CopyOptions, FileTarget, Target
from snapsync.plans.plan import plan_tables
from snapsync.plans.select import chosen_tables
from snapsync.sources.base import Opened, at_once, local_frame
from snapsync.sources.jdbc import LONG_MAX, OpenedJdbc
from snapsync.sources.read import read_table

log = logging.getLogger(__name__)

REPORT = T.StructType(
    [
        T.StructField("table_name", T.StringType()),
        T.StructField("target_name", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("mode", T.StringType()),
        T.StructField("attempts", T.IntegerType()),
        T.StructField("rows", T.LongType()),
        T.StructField("schema", T.StringType()),
        T.StructField("target_schema", T.StringType()),
        T.StructField("skip_reason", T.StringType()),
        T.StructField("error", T.StringType()),
    ]
)
MARKS = T.StructType(
    [T.StructField("table_name", T.StringType()), T.StructField("high_water", T.LongType())]
)


class CopyFailed(RuntimeError):
    """Some tables failed; ``report`` says which."""

    def __init__(self, report: DataFrame, names: list[str]):
        super().__init__(f"failed to copy: {', '.join(names)}")
        self.report = report


def _schema_pairs(schema: T.StructType) -> list[tuple[str, str]]:
    return [(f.name, f.dataType.simpleString()) for f in schema.fields]


def copy_snapshot(
    opened: Opened,
    target: Target,
    row: Mapping[str, Any],
    options: CopyOptions,
    declared: T.StructType | None = None,
) -> sink.Written:
    """Replace the target table by all rows of the source table."""
    df = read_table(opened, row, options)
    if declared is not None:
        df = conform(df, declared)
        if isinstance(target, ConnectorTarget):
            # The connector makes the table from the schema of the rows.
            df = required(df, declared)
    log.info("writing %s: %s", row["target_name"], df.schema.simpleString())
    return sink.write_snapshot(
        df,
        target,
        row["target_name"],
        row.get("append_key"),
        options.overwrite_existing,
        options.create_if_absent,
    )


def copy_incremental(
    opened: Opened,
    target: Target,
    row: Mapping[str, Any],
    options: CopyOptions,
    declared: T.StructType | None = None,
) -> tuple[str, sink.Written]:
    """Append the rows above the target's greatest key, for tables that only grow.

    The whole table is copied when the target is empty, absent, of another schema,
    not a ``FileTarget``, or holds unsigned keys beyond a long. So it is when the source
    has NULL keys, which no mark is below, or its greatest key is below the mark: then it
    was loaded anew. Rows committed late are found up to ``lookback`` keys back.
    """
    spark, name, key = opened.spark, row["target_name"], row["append_key"]
    if not isinstance(target, FileTarget):
        return "snapshot", copy_snapshot(opened, target, row, options, declared)
    mark = sink.high_water(spark, target, name, key)
    if mark is None or mark > LONG_MAX:
        return "snapshot", copy_snapshot(opened, target, row, options, declared)
    source = opened.append_stats(row["table_name"], key).first()
    if source.null_keys or source.max_key is None or source.max_key < mark:
        log.info("%s does not only grow: copying it whole", row["table_name"])
        return "snapshot", copy_snapshot(opened, target, row, options, declared)
    floor = mark - options.lookback
    present = sink.read_snapshot(spark, target, name)
    df = read_table(opened, row, options, above=floor)
    if declared is not None:
        df = conform(df, declared)
    if _schema_pairs(df.schema) != _schema_pairs(present.schema):
        return "snapshot", copy_snapshot(opened, target, row, options, declared)
    if options.lookback:
        # Both sides hold the look-back window only, whatever the table's size.
        k = F.col(quoted(key))
        df = df.join(present.filter(k > floor).select(k), key, "left_anti").select(
            [quoted(c) for c in present.columns]
        )
    log.info("appending to %s above %s: %s", name, floor, df.schema.simpleString())
    return "append", sink.append_increment(df, target, name, key)


def _marker_of(schema: T.StructType, options: CopyOptions) -> str | None:
    return next((c for c in schema.fieldNames() if c.lower() == options.marker.lower()), None)


def copy_delta(
    opened: Opened,
    target: Target,
    row: Mapping[str, Any],
    options: CopyOptions,
    declared: T.StructType | None = None,
) -> tuple[str, sink.Written]:
    """Copy the rows that the marker column says have changed; the newest of a key wins.

    Rows from the latest marker that was copied on, so those of its very moment come again,
    and those without a marker always. The rows that they replace are not written again.
    The whole table is copied the first time, for other targets, for tables without a key,
    and when the schema changed. Deleted rows stay: ``copy_reconciled`` finds them.
    """
    spark, name, keys = opened.spark, row["target_name"], row.get("primary_key")
    df = read_table(opened, row, options)
    if declared is not None:
        df = conform(df, declared)
        if isinstance(target, ConnectorTarget):
            df = required(df, declared)
    marker = _marker_of(df.schema, options)
    # Keys are compared by their values; those of the declared schema may be renamed in case.
    names = {c.lower(): c for c in df.columns}
    keys = [names.get(k.lower()) for k in keys or []]
    key = names.get(row["append_key"].lower()) if row.get("append_key") else None

    def whole() -> tuple[str, sink.Written]:
        done = sink.write_snapshot(
            df, target, name, key, options.overwrite_existing, options.create_if_absent, marker
        )
        return "snapshot", done

    if not isinstance(target, FileTarget) or marker is None or not keys or None in keys:
        return whole()
    mark = sink.latest_marker(spark, target, name, marker)
    if mark is None:
        return whole()
    present = sink.read_snapshot(spark, target, name)
    if _schema_pairs(df.schema) != _schema_pairs(present.schema):
        return whole()
    m = F.col(quoted(marker))
    changed = df.filter((m >= sink.marker_value(mark, df.schema[marker].dataType)) | m.isNull())
    log.info("changes of %s from %s on", name, mark)
    return "delta", sink.append_delta(changed, target, name, keys, marker, key)


def copy_reconciled(
    opened: Opened,
    target: Target,
    row: Mapping[str, Any],
    options: CopyOptions,
    declared: T.StructType | None = None,
) -> tuple[str, sink.Written]:
    """Copy the key ranges in which source and target differ, whatever made them differ.

    The whole table is copied the first time, for other targets, and when the schema changed.
    """
    spark, name, key = opened.spark, row["target_name"], row["append_key"]
    if not isinstance(target, FileTarget) or not sink.target_exists(spark, target, name):
        return "snapshot", copy_snapshot(opened, target, row, options, declared)
    df = read_table(opened, row, options)
    if declared is not None:
        df = conform(df, declared)
    present = sink.read_snapshot(spark, target, name)
    if _schema_pairs(df.schema) != _schema_pairs(present.schema):
        return "snapshot", copy_snapshot(opened, target, row, options, declared)
    ranges, rows = reconciled(df, present, row)
    log.info("%s differs in %s ranges", name, len(ranges))
    if not ranges:
        return "ranges", sink.unchanged(target, name, df.schema)
    return "ranges", sink.replace_ranges(rows, target, name, key, ranges)


def _way(row: Mapping[str, Any], options: CopyOptions):
    """How a table is copied that need not be copied whole; None for one that is."""
    if options.reconcile and row.get("append_key") is not None:
        return copy_reconciled
    if options.incremental and row["immutable"] and row.get("append_key") is not None:
        return copy_incremental
    if options.delta and not row["immutable"] and row.get("primary_key"):
        return copy_delta
    return None


def copy_table(
    opened: Opened,
    target: Target,
    row: Mapping[str, Any],
    options: CopyOptions,
    declared: T.StructType | None = None,
) -> tuple:
    """Copy one table, in up to ``max_attempts`` attempts -> a report row.

    An attempt is the whole copy, so nothing of a failed one is left behind, and
    no error gets out.
    """
    name, target_name = row["table_name"], target.qualified(row["target_name"])
    way = _way(row, options)
    attempts, error = 0, ""
    while attempts < options.max_attempts:
        if attempts and options.retry_wait_seconds:
            time.sleep(options.retry_wait_seconds)
        attempts += 1
        try:
            if way is not None:
                mode, done = way(opened, target, row, options, declared)
            else:
                mode, done = "snapshot", copy_snapshot(opened, target, row, options, declared)
            log.info("copied %s to %s: %s rows", name, done.target_name, done.rows)
            return (
                name, done.target_name, "ok", mode, attempts, done.rows, done.schema,
                done.target_schema, None, None,
            )
        except Exception as e:
            error = _message(opened, e)
            log.warning("attempt %s of %s failed: %s", attempts, name, error)
            if isinstance(e, sink.TargetStateError):
                break
    log.error("failed to copy %s to %s: %s", name, target_name, error)
    return (name, target_name, "failed", None, attempts, None, None, None, None, error)


def _message(opened: Opened, error: Exception) -> str:
    """The whole error, as its root cause may be at the end."""
    text = str(error) or type(error).__name__
    return opened.source.masked(text) if isinstance(opened, OpenedJdbc) else text


def _high_water(
    opened: Opened, target: Target, options: CopyOptions, rows: list
) -> DataFrame | None:
    """``table_name, high_water`` of the tables an increment is meant for."""
    if not isinstance(target, FileTarget):
        return None

    def mark(r) -> tuple:
        try:
            found = sink.high_water(opened.spark, target, r.target_name, r.append_key)
            return (r.table_name, None if found is None or found > LONG_MAX else found)
        except Exception as e:
            # The copy of this table will fail alike, and report it.
            log.warning("no high-water mark of %s: %s", r.table_name, _message(opened, e))
            return (r.table_name, None)

    growing = [
        r for r in rows if r.skip_reason is None and r.immutable and r.append_key is not None
    ]
    return local_frame(opened.spark, at_once(mark, growing), MARKS)


def _noted_bounds(opened: Opened, target: Target, row: Mapping[str, Any]) -> list[int]:
    """Split bounds of a database table from the sketches of its last copy, if it has any."""
    splits = (row.get("n_splits") or 1) > 1 and row.get("split_by") == "rows"
    if not splits or not isinstance(opened, OpenedJdbc) or not isinstance(target, FileTarget):
        return []
    key = row.get("key_column")
    try:
        return sink.key_bounds(
            opened.spark, target, row["target_name"], key, row["n_splits"], row.get("max_key")
        )
    except Exception as e:
        log.warning("no noted bounds of %s: %s", row["table_name"], _message(opened, e))
        return []


def upper_cuts(opened: Opened, plan: list) -> dict[str, tuple[str, int]]:
    """``table: (key column, greatest key)`` now, of the tables that have an integral key.

    All are asked for at once, before any is read. Tables without such a key have no mark
    that tells the rows that come later.
    """

    def cut(row) -> tuple[str, tuple[str, int] | None]:
        key = row.append_key or row.key_column
        if key is None:
            return row.table_name, None
        try:
            high = opened.key_stats(row.table_name, key).first().max_key
        except Exception as e:
            # The copy of this table will fail alike, and report it.
            log.warning("no upper cut of %s: %s", row.table_name, _message(opened, e))
            return row.table_name, None
        return row.table_name, None if high is None else (key, int(high))

    return {name: found for name, found in at_once(cut, plan) if found is not None}


def copy_planned(
    opened: Opened,
    target: Target,
    plan: list,
    options: CopyOptions,
    declared: Mapping[str, T.StructType] | None = None,
) -> list[tuple]:
    """Copy the tables of collected plan rows -> their report rows.

    Up to ``max_parallel_writers`` tables are copied at a time, the largest first.
    The driver threads only start Spark jobs; with ``spark.scheduler.mode=FAIR``
    each table gets its own pool, so small ones do not wait behind large ones.
    """
    declared = declared or {}
    spark = opened.spark
    cuts = upper_cuts(opened, plan) if options.consistent else {}

    def run(row) -> tuple:
        context = spark.sparkContext
        context.setLocalProperty("spark.scheduler.pool", f"copy-{row.table_name}")
        context.setLocalProperty("spark.job.description", f"copy {row.table_name}")
        cut_column, upper_cut = cuts.get(row.table_name, (None, None))
        planned = row.asDict() | {"cut_column": cut_column, "upper_cut": upper_cut}
        planned["bounds"] = _noted_bounds(opened, target, planned)
        return copy_table(opened, target, planned, options, declared.get(row.table_name))

    largest_first = sorted(plan, key=lambda r: (-r.bytes_to_sync, r.table_name))
    with ThreadPoolExecutor(max_workers=options.max_parallel_writers) as pool:
        running = [pool.submit(inheritable_thread_target(spark)(run), r) for r in largest_first]
        return [f.result() for f in running]


def collect_plan(opened: Opened, target: Target, options: CopyOptions) -> list:
    """The plan, skipped tables included. It has one short row per table."""
    tables = chosen_tables(opened, options)

    def planned(ranges: bool, marks: DataFrame | None = None) -> list:
        return plan_tables(
            opened,
            options,
            target.prefix,
            tables=tables,
            ranges=ranges,
            high_water=marks,
            keep_skipped=True,
        ).collect()

    # Files are split by bytes: their key ranges are of no use here.
    if not isinstance(opened, OpenedJdbc):
        return planned(False)
    if not options.incremental:
        return planned(True)
    return planned(True, _high_water(opened, target, options, planned(False)))


def copy_all(
    spark: SparkSession,
    source,
    target: Target,
    options: CopyOptions | None = None,
    declared: Mapping[str, T.StructType] | None = None,
) -> DataFrame:
    """Copy all selected tables -> report, one row per table of the source.

    ``declared`` gives target schemas by table name. A table that fails does not
    stop the others.
    """
    options = options or CopyOptions()
    opened = source if isinstance(source, Opened) else source.open(spark)
    plan = collect_plan(opened, target, options)
    skipped = [
        (r.table_name, target.qualified(r.target_name), "skipped", None, 0, None, None, None,
         r.skip_reason, None)
        for r in plan
        if r.skip_reason is not None
    ]
    chosen = [r for r in plan if r.skip_reason is None]
    outcomes = copy_planned(opened, target, chosen, options, declared)
    report = local_frame(spark, sorted(outcomes + skipped, key=lambda r: r[0]), REPORT)
    failed = sorted(o[0] for o in outcomes if o[2] == "failed")
    if failed:
        log.error("failed to copy %s of %s tables: %s", len(failed), len(chosen), ", ".join(failed))
        if options.raise_on_failure:
            raise CopyFailed(report, failed)
    return report


def failed_tables(report: DataFrame) -> DataFrame:
    """``n_failed, failed`` of a report."""
    names = F.array_sort(F.collect_list("table_name"))
    return report.filter("status = 'failed'").agg(
        F.count(F.lit(1)).alias("n_failed"), names.alias("failed")
    )
