"""The queries of this repository, each with SQL that gives the same rows.

Every query reads the whole tables of ``sf_dir``. Copies go to a new folder below
``spark.checkpoint.dir`` (see ``snapsync.storage.workspace``).
"""

from __future__ import annotations

import json
import sys
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

import embedded_db
from snapsync.functions.names import qualified_name, target_name
from snapsync.functions.predicates import hash_remainders, hot_bound_predicates
from snapsync.functions.text import render_fixed_width
from snapsync.operators import sink
from snapsync.operators.copy import (
    copy_all,
    copy_delta,
    copy_incremental,
    copy_reconciled,
    failed_tables,
)
from snapsync.operators.schema import conform, load_schema, target_schema
from snapsync.options import CopyOptions, FileTarget
from snapsync.plans.plan import immutability, plan_tables
from snapsync.plans.select import select_tables
from snapsync.plans.splits import (
    composite_predicates,
    key_range,
    range_predicates,
    range_starts,
    split_bounds,
    split_by,
    split_histogram,
    split_predicates,
)
from snapsync.sources import catalog
from snapsync.sources.base import union_all
from snapsync.sources.files import FileSource, OpenedFiles
from snapsync.sources.read import read_table
from snapsync.storage import workspace

SMOKE_DIR = "/root/testdata/sf0.001"

# The primary keys of the test tables (lineitem has none), and
# the lists and sizes the queries and their SQL agree on.
KEYS = {
    "region": ["r_regionkey"],
    "nation": ["n_nationkey"],
    "customer": ["c_custkey"],
    "supplier": ["s_suppkey"],
    "part": ["p_partkey"],
    "orders": ["o_orderkey"],
    "events": ["event_id"],
    "documents": ["doc_id"],
    "labels": ["doc_id"],
    "pages": ["page_id"],
    "benchmark": ["item_id"],
    "conversations": ["conv_id", "turn"],
    "embeddings": ["vec_id"],
}
TABLES = sorted([*KEYS, "lineitem"])
PREFIX = "snap_"
MARKER = "ts"
WHITELIST = ["Orders", "LINEITEM", "customer", "events", "documents", "pages"]
BLACKLIST = ["EVENTS", "pages", "region"]
MIN_SPLIT_BYTES = 131072
BYTES_PER_SPLIT = 65536
SPLITS = 8
RANGES, RESIDUES = 4, 3
PLAN_OPTIONS = CopyOptions(
    marker=MARKER, min_split_bytes=MIN_SPLIT_BYTES, bytes_per_split=BYTES_PER_SPLIT
)
DECLARED_PART = """[
  {"name": "p_name", "type": "STRING", "mode": "REQUIRED", "description": "part name"},
  {"name": "p_partkey", "type": "INT64", "mode": "REQUIRED"},
  {"name": "p_size", "type": "INT64", "mode": "NULLABLE"},
  {"name": "p_retailprice", "type": "STRING", "mode": "NULLABLE"},
  {"name": "p_brand", "type": "STRING", "mode": "NULLABLE"},
  {"name": "p_type", "type": "STRING", "mode": "NULLABLE"},
  {"name": "p_comment", "type": "STRING", "mode": "NULLABLE"}
]"""
# Types that could lose something, and do not on these rows.
DECLARED_ORDERS = """[
  {"name": "o_orderkey", "type": "FLOAT64", "mode": "REQUIRED"},
  {"name": "o_custkey", "type": "STRING"},
  {"name": "o_orderstatus", "type": "STRING"},
  {"name": "o_totalprice", "type": "NUMERIC", "precision": 15, "scale": 2},
  {"name": "o_orderdate", "type": "DATE"},
  {"name": "o_orderpriority", "type": "STRING"}
]"""
DECLARED_TEXTS = """[
  {"name": "p_partkey", "type": "INT64", "mode": "REQUIRED"},
  {"name": "p_name", "type": "STRING", "mode": "REQUIRED"},
  {"name": "p_size", "type": "INT64"}
]"""
# The letters of l_returnflag are no numbers: this copy fails while it writes.
DECLARED_LINEITEM = """[
  {"name": "l_orderkey", "type": "INT64"},
  {"name": "l_partkey", "type": "INT64"},
  {"name": "l_suppkey", "type": "INT64"},
  {"name": "l_linenumber", "type": "INT64"},
  {"name": "l_quantity", "type": "FLOAT64"},
  {"name": "l_extendedprice", "type": "FLOAT64"},
  {"name": "l_discount", "type": "FLOAT64"},
  {"name": "l_tax", "type": "FLOAT64"},
  {"name": "l_returnflag", "type": "INT64"},
  {"name": "l_linestatus", "type": "STRING"},
  {"name": "l_shipdate", "type": "DATETIME"}
]"""


def _open(spark: SparkSession, sf_dir: str) -> OpenedFiles:
    return FileSource(sf_dir, keys=KEYS).open(spark)


def _target(spark: SparkSession, label: str) -> FileTarget:
    return FileTarget(workspace(spark, label), prefix=PREFIX)


def _plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plan_tables(_open(spark, sf_dir), PLAN_OPTIONS, PREFIX, sizes="logical")


# Sources -----------------------------------------------------------------


def catalog_tables(spark, sf_dir):
    tables = catalog.tables(_open(spark, sf_dir), "logical")
    return tables.select("table_name", "table_rows", "size_bytes")


def catalog_columns(spark, sf_dir):
    return catalog.columns(_open(spark, sf_dir))


def catalog_keys(spark, sf_dir):
    opened = _open(spark, sf_dir)
    checked = catalog.check_keys(opened.frames, KEYS)
    return catalog.keys(opened).join(checked, "table_name").select(
        "table_name",
        F.array_join("primary_key", ",").alias("primary_key"),
        "n_rows",
        "n_keys",
        "is_key",
    )


def candidate_keys(spark, sf_dir):
    return catalog.candidate_keys(_open(spark, sf_dir).frames)


def inferred_keys(spark, sf_dir):
    opened = _open(spark, sf_dir)
    found = catalog.inferred_constraints(
        catalog.candidate_keys(opened.frames), catalog.columns(opened), opened.database
    )
    keys = catalog.primary_keys(*found, opened.database)
    return keys.select("table_name", F.array_join("primary_key", ",").alias("primary_key"))


def composite_keys(spark, sf_dir):
    found = catalog.composite_keys(_open(spark, sf_dir).frames)
    return found.select("table_name", F.array_join("key", ",").alias("key"))


def full_scan(spark, sf_dir):
    return read_table(_open(spark, sf_dir), {"table_name": "customer"})


def _with_split(opened, table, predicates):
    """Rows with the number of the query that would read them from a database."""
    number, hits = split_by(predicates)
    return read_table(opened, {"table_name": table}).withColumns(
        {"split_id": number, "n_queries": hits}
    )


def partitioned_scan(spark, sf_dir):
    opened = _open(spark, sf_dir)
    span = key_range(opened, {"orders": "o_orderkey"}).first()
    starts = range_starts(span.min_key, span.max_key, SPLITS)
    return _with_split(opened, "orders", range_predicates("o_orderkey", starts))


def composite_split(spark, sf_dir):
    opened = _open(spark, sf_dir)
    span = key_range(opened, {"conversations": "conv_id"}).first()
    starts = range_starts(span.min_key, span.max_key, RANGES)
    predicates = composite_predicates("conv_id", "turn", starts, RESIDUES)
    return _with_split(opened, "conversations", predicates)


# JDBC scans. They need the embedded database, which only the driver's JVM sees.


def _jdbc(spark, sf_dir, table):
    return embedded_db.load(spark, sf_dir, {table: KEYS[table]}).open(spark)


def _jdbc_row(opened, table, n_splits):
    key = KEYS[table][0]
    span = key_range(opened, {table: key}).first()
    second = KEYS[table][1] if len(KEYS[table]) > 1 else None
    return {**span.asDict(), "n_splits": n_splits, "second_column": second}


def jdbc_catalog_keys(spark, sf_dir):
    opened = _jdbc(spark, sf_dir, "conversations")
    rows = catalog.tables(opened, "counted").select("table_name", "table_rows")
    keys = catalog.keys(opened).filter("table_name = 'conversations'")
    return keys.join(rows, "table_name").select(
        "table_name", F.array_join("primary_key", ",").alias("primary_key"), "table_rows"
    )


def jdbc_full_scan(spark, sf_dir):
    return read_table(_jdbc(spark, sf_dir, "customer"), {"table_name": "customer"})


def jdbc_partitioned_scan(spark, sf_dir):
    opened = _jdbc(spark, sf_dir, "orders")
    return read_table(opened, _jdbc_row(opened, "orders", SPLITS))


def jdbc_composite_split(spark, sf_dir):
    opened = _jdbc(spark, sf_dir, "conversations")
    row = _jdbc_row(opened, "conversations", SPLITS)
    # More splits than leading keys, so that the second column has to help.
    row["n_splits"] = 2 * (row["max_key"] - row["min_key"] + 1)
    return read_table(opened, row)


# Plans -------------------------------------------------------------------


def selected_tables(spark, sf_dir):
    options = CopyOptions(whitelist=WHITELIST, blacklist=BLACKLIST)
    tables = select_tables(catalog.tables(_open(spark, sf_dir), "counted"), options)
    return tables.select("table_name", "table_rows", "skip_reason")


def immutable_tables(spark, sf_dir):
    return immutability(catalog.columns(_open(spark, sf_dir)), MARKER)


def key_ranges(spark, sf_dir):
    opened = _open(spark, sf_dir)
    leading = {name: key[0] for name, key in KEYS.items()}
    return key_range(opened, leading | {"lineitem": "l_orderkey"})


def sync_plan(spark, sf_dir):
    return _plan(spark, sf_dir).select(
        "table_name",
        "target_name",
        "size_bytes",
        "immutable",
        F.array_join("primary_key", ",").alias("primary_key"),
        "key_column",
        "min_key",
        "max_key",
        "bytes_to_sync",
        "n_splits",
    )


def all_split_bounds(spark, sf_dir):
    return split_bounds(_plan(spark, sf_dir))


def all_split_histograms(spark, sf_dir):
    opened = _open(spark, sf_dir)
    # One row per table.
    plan = plan_tables(opened, PLAN_OPTIONS, PREFIX, sizes="logical").filter("n_splits > 1")
    return union_all(
        split_histogram(
            opened.read(r.table_name), r.key_column, r.min_key, r.max_key, r.n_splits
        ).select(F.lit(r.table_name).alias("table_name"), "*")
        for r in plan.collect()
    )


def balanced_splits(spark, sf_dir):
    # Ranges with counted rows, of a key that repeats, and of one whose values below a
    # tenth of the keys are all one key: it is cut by the next column.
    opened = _open(spark, sf_dir)
    span = key_range(opened, {"lineitem": "l_orderkey"}).first()
    low = span.min_key
    tenth = low + (span.max_key - low) // 10
    hot = opened.read("lineitem").selectExpr(
        f"IF(l_orderkey < {tenth}, {low}L, l_orderkey * 1000) AS k",
        "l_partkey * 7 AS part",
    )
    path = workspace(spark, "skewed")
    hot.write.parquet(f"{path}/skewed.parquet")
    skewed = FileSource(path).open(spark)
    results = []
    for source, table, columns in (
        (opened, "lineitem", ["l_orderkey", "l_linenumber"]),
        (skewed, "skewed", ["k", "part"]),
    ):
        number, hits = split_by(split_predicates(source, table, columns, SPLITS))
        rows = source.read(table).select(number.alias("split_id"), hits.alias("hits"))
        per_split = rows.groupBy("split_id").agg(
            F.count(F.lit(1)).alias("n"), F.max("hits").alias("hits")
        )
        even = F.max("n") * SPLITS <= 2 * F.sum("n") + 2 * SPLITS
        results.append(
            per_split.agg(
                F.sum("n").alias("n_rows"),
                F.max("hits").alias("queries_of_a_row"),
                (F.count("split_id") >= SPLITS // 2).alias("enough_splits"),
                even.alias("none_above_twice_its_share"),
            ).select(F.lit(table).alias("table_name"), "*")
        )
    return union_all(results)


def sketched_splits(spark, sf_dir):
    # The same from the sketches that a copy noted: bounds without a look at the keys.
    opened, target = _open(spark, sf_dir), _target(spark, "sketched")
    lineitem = opened.read("lineitem")
    # Most keys in a corner, and a fifth of the rows of one key.
    skewed = lineitem.selectExpr(
        "CASE WHEN l_linenumber = 1 THEN 5L ELSE l_orderkey * l_orderkey END AS k", "l_partkey * 7 AS part"
    )
    results = []
    for name, df, key in (("lineitem", lineitem, "l_orderkey"), ("skewed", skewed, "k")):
        sink.write_snapshot(df, target, name, key)
        bounds = sink.key_bounds(spark, target, name, key, SPLITS)
        other = next(c for c in df.columns if c != key)
        cut = hot_bound_predicates(
            key, [f"{b}L" for b in bounds], lambda n, c=other: hash_remainders(f"ABS(HASH({c}))", n)
        )
        number, hits = split_by(cut)
        rows = df.select(number.alias("split_id"), hits.alias("hits"))
        per_split = rows.groupBy("split_id").agg(F.count(F.lit(1)).alias("n"), F.max("hits").alias("hits"))
        even = F.max("n") * SPLITS <= 2 * F.sum("n") + 2 * SPLITS
        results.append(
            per_split.agg(
                F.sum("n").alias("n_rows"),
                F.max("hits").alias("queries_of_a_row"),
                even.alias("none_above_twice_its_share"),
            ).select(F.lit(name).alias("table_name"), "*")
        )
    return union_all(results)


def target_names(spark, sf_dir):
    names = target_name("table_name", PREFIX)
    return catalog.tables(_open(spark, sf_dir)).select(
        "table_name",
        names.alias("target_name"),
        qualified_name(names, "dataset", "project").alias("qualified_name"),
    )


def dated_targets(spark, sf_dir):
    orders = _open(spark, sf_dir).read("orders")
    days = orders.groupBy(F.to_date("o_orderdate").alias("day"))
    name = target_name(F.lit("orders"), PREFIX, F.col("day"))
    return days.agg(F.count(F.lit(1)).alias("n_rows")).select(name.alias("target_name"), "n_rows")


# Targets -----------------------------------------------------------------


def target_schemas(spark, sf_dir):
    return union_all(
        target_schema(df).select(F.lit(name).alias("table_name"), "*")
        for name, df in _open(spark, sf_dir).frames.items()
    )


def conform_schema(spark, sf_dir):
    return conform(_open(spark, sf_dir).read("part"), load_schema(DECLARED_PART))


def conform_types(spark, sf_dir):
    return conform(_open(spark, sf_dir).read("orders"), load_schema(DECLARED_ORDERS))


def fixed_width(spark, sf_dir):
    return render_fixed_width(_open(spark, sf_dir).read("customer"))


def snapshot_overwrite(spark, sf_dir):
    target = _target(spark, "overwrite")
    orders = _open(spark, sf_dir).read("orders")
    # A table of another shape first: the second snapshot has to replace all of it.
    sink.write_snapshot(orders.withColumn("old", F.lit(1)), target, "orders")
    sink.write_snapshot(orders, target, "orders")
    return sink.read_snapshot(spark, target, "orders")


def incremental_append(spark, sf_dir):
    opened, target = _open(spark, sf_dir), _target(spark, "append")
    orders = opened.read("orders")
    row = {"table_name": "orders", "target_name": "orders", "append_key": "o_orderkey"}
    span = key_range(opened, {"orders": "o_orderkey"}).first()
    # The table as it was when it had half its keys, then the rows since.
    earlier = orders.filter(F.col("o_orderkey") <= (span.min_key + span.max_key) // 2)
    sink.write_snapshot(earlier, target, "orders", "o_orderkey")
    copy_incremental(opened, target, row, CopyOptions(incremental=True))
    return sink.read_snapshot(spark, target, "orders")


def incremental_lookback(spark, sf_dir):
    opened, target = _open(spark, sf_dir), _target(spark, "lookback")
    events = opened.read("events")
    row = {"table_name": "events", "target_name": "events", "append_key": "event_id"}
    span = key_range(opened, {"events": "event_id"}).first()
    width = span.max_key - span.min_key + 1
    half = span.min_key + width // 2
    late = (F.col("event_id") > half - width // 10) & (F.col("event_type") == "click")
    # Rows of one kind below the highest key had not been committed yet.
    earlier = events.filter((F.col("event_id") <= half) & ~late)
    sink.write_snapshot(earlier, target, "events", "event_id")
    options = CopyOptions(incremental=True, lookback=width // 5)
    copy_incremental(opened, target, row, options)
    return sink.read_snapshot(spark, target, "events")


def _reloaded(spark, table, before, after, key):
    """The target after a copy of ``before`` and an incremental one of ``after``."""
    target, row = _target(spark, "reloaded"), {"table_name": table, "append_key": key}
    for df in (before, after):
        path = workspace(spark, "source")
        df.write.parquet(f"{path}/{table}.parquet")
        opened = FileSource(path, keys={table: [key]}).open(spark)
        copy_incremental(opened, target, row | {"target_name": table}, CopyOptions())
    return sink.read_snapshot(spark, target, table)


def incremental_nulls(spark, sf_dir):
    # New rows without a key are above no mark: the table is copied whole.
    orders = _open(spark, sf_dir).read("orders")
    key = F.when(F.col("o_orderkey") % 7 != 0, F.col("o_orderkey")).alias("o_orderkey")
    others = [c for c in orders.columns if c != "o_orderkey"]
    before = orders.filter(F.col("o_orderkey") % 7 != 0)
    return _reloaded(spark, "orders", before, orders.select(key, *others), "o_orderkey")


def incremental_reload(spark, sf_dir):
    # The source was loaded anew with fewer rows.
    opened = _open(spark, sf_dir)
    events, span = opened.read("events"), key_range(opened, {"events": "event_id"}).first()
    half = (span.min_key + span.max_key) // 2
    return _reloaded(spark, "events", events, events.filter(F.col("event_id") <= half), "event_id")


def incremental_joined(spark, sf_dir):
    # Increments are joined into a new version when there are too many.
    target = FileTarget(workspace(spark, "joined"), prefix=PREFIX, max_parts=2)
    orders = _open(spark, sf_dir).read("orders")
    for step in range(5):
        part = orders.filter(F.col("o_orderkey") % 5 == step)
        if step:
            sink.append_increment(part, target, "orders", "o_orderkey")
        else:
            sink.write_snapshot(part, target, "orders", "o_orderkey")
    return sink.read_snapshot(spark, target, "orders")


def incremental_tiers(spark, sf_dir):
    # As many increments as make parts of three levels.
    target = FileTarget(workspace(spark, "tiers"), prefix=PREFIX, tier=3)
    orders = _open(spark, sf_dir).read("orders")
    for step in range(10):
        part = orders.filter(F.pmod(F.hash("o_orderkey"), F.lit(10)) == step)
        if step:
            sink.append_increment(part, target, "orders", "o_orderkey")
        else:
            sink.write_snapshot(part, target, "orders", "o_orderkey")
    return sink.read_snapshot(spark, target, "orders")


def _later(days: int):
    return F.expr(f"timestampadd(DAY, {days}, ts)")


def delta_updates(spark, sf_dir):
    # A table that is edited between copies: rows change, come, and change again.
    events, target = _open(spark, sf_dir).read("events"), _target(spark, "delta")
    k = F.col("event_id")
    latest = events.agg(F.max("ts").alias("latest"), F.min("ts").alias("first")).first()
    span = (latest.latest - latest.first).days + 1

    def edited(df, when, step):
        """Rows that change get a new value and a marker later than any before."""
        return df.withColumns(
            {
                "value": F.when(when, F.col("value") * 2 + step).otherwise(F.col("value")),
                "ts": F.when(when, _later(step * span)).otherwise(F.col("ts")),
            }
        )

    first = events.filter(k % 4 != 1)
    second = edited(events.filter(k % 4 != 3), (k % 10 == 2) | (k % 4 == 1), 1)
    # Those of remainder 3 come again, with a new marker.
    third = edited(edited(events, (k % 10 == 2) | (k % 4 == 1), 1), (k % 20 == 2) | (k % 4 == 3), 2)
    row = {"table_name": "events", "target_name": "events", "append_key": "event_id", "primary_key": ["event_id"]}
    for df in (first, second, third):
        path = workspace(spark, "source")
        df.write.parquet(f"{path}/events.parquet")
        opened = FileSource(path, keys={"events": ["event_id"]}).open(spark)
        copy_delta(opened, target, row, CopyOptions(delta=True, marker=MARKER))
    return sink.read_snapshot(spark, target, "events")


def range_reconcile(spark, sf_dir):
    # Rows below the mark change, go, come and get other keys, without any marker.
    orders, target = _open(spark, sf_dir).read("orders"), _target(spark, "reconcile")
    k = F.col("o_orderkey")
    sink.write_snapshot(orders.filter(k % 1000 != 5), target, "orders", "o_orderkey")
    edited = orders.filter(k % 1000 != 7).withColumns(
        {
            "o_orderkey": F.when(k % 1000 == 9, -k).otherwise(k),
            "o_totalprice": F.when(k % 1000 == 11, F.lit(0.5)).otherwise(F.col("o_totalprice")),
        }
    )
    path = workspace(spark, "source")
    edited.write.parquet(f"{path}/orders.parquet")
    opened = FileSource(path, keys={"orders": ["o_orderkey"]}).open(spark)
    row = {"table_name": "orders", "target_name": "orders", "append_key": "o_orderkey"}
    copy_reconciled(opened, target, row, CopyOptions(reconcile=True))
    return sink.read_snapshot(spark, target, "orders")


def quarantine(spark, sf_dir):
    # A part table of texts, some of which say no value of the declared type.
    part, target = _open(spark, sf_dir).read("part"), _target(spark, "quarantine")
    k = F.col("p_partkey")
    texts = part.select(
        F.when(k % 11 == 0, F.lit("p")).otherwise(k.cast("string")).alias("p_partkey"),
        F.when(k % 13 == 0, None).otherwise(F.col("p_name")).alias("p_name"),
        F.when(k % 7 == 0, F.concat(F.col("p_size").cast("string"), F.lit(".5")))
        .otherwise(F.col("p_size").cast("string")).alias("p_size"),
    )
    sink.write_conforming(texts, target, "part", load_schema(DECLARED_TEXTS))
    good = sink.read_snapshot(spark, target, "part").select(
        F.lit("row").alias("kind"), F.col("p_partkey").cast("string").alias("p_partkey"), "p_name",
        F.col("p_size").cast("string").alias("p_size"), F.lit(None).cast("string").alias("problem"),
    )
    ledger = sink.read_ledger(spark, target, "part")
    bad = ledger.select(
        F.lit("problem").alias("kind"), "source.*", F.concat_ws(": ", "column", "reason").alias("problem")
    )
    return good.unionByName(bad)


def hash_splits(spark, sf_dir):
    # The queries of a table without a key, of which some rows have no hash: as where a
    # database gives none for a long row.
    rows = _open(spark, sf_dir).read("lineitem")
    text = "CONCAT_WS('|', l_orderkey, l_partkey, l_shipdate)"
    hashed = f"CRC32(CAST(IF(l_linenumber = 3, NULL, {text}) AS BINARY))"
    number, hits = split_by(hash_remainders(hashed, SPLITS))
    seen = rows.select("l_linenumber", number.alias("split_id"), hits.alias("hits"))
    return seen.groupBy("l_linenumber").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.max("hits").alias("queries_of_a_row"),
        F.max(F.when(F.col("l_linenumber") == 3, F.col("split_id"))).alias("split_without_hash"),
    )


def verified_parts(spark, sf_dir):
    # Every part of a verified copy still holds the rows that were written.
    target = FileTarget(workspace(spark, "verified"), prefix=PREFIX, verify=True)
    copy_all(spark, FileSource(sf_dir, keys=KEYS), target)
    found = [
        sink.read_snapshot(spark, target, name)
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .select(F.lit(name).alias("target_name"), "n_rows", F.lit(len(sink.damaged_parts(spark, target, name))).alias("damaged"))
        for name in sink.list_tables(spark, target)
    ]
    return union_all(found)


def incremental_copy(spark, sf_dir):
    target = _target(spark, "incremental")
    source = FileSource(sf_dir, keys=KEYS)
    options = CopyOptions(incremental=True, marker=MARKER)
    copy_all(spark, source, target, options)
    # Nothing is new for the second copy: append-only tables get no rows, the others
    # are copied whole.
    return copy_all(spark, source, target, options).select(
        "table_name", "status", "mode", "rows"
    )


def copied_tables(spark, sf_dir):
    target = _target(spark, "copy")
    report = copy_all(spark, FileSource(sf_dir, keys=KEYS), target)
    counted = union_all(
        sink.read_snapshot(spark, target, name)
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .select(F.lit(name).alias("copied"), "n_rows")
        for name in sink.list_tables(spark, target)
    )
    name = target_name("table_name", PREFIX)
    return report.join(counted, name == F.col("copied"), "left").select(
        "table_name", name.alias("target_name"), "status", "n_rows"
    )


def _report(spark, sf_dir):
    options = CopyOptions(max_attempts=2, blacklist=["region"])
    declared = {"lineitem": load_schema(DECLARED_LINEITEM)}
    source = FileSource(sf_dir, keys=KEYS)
    return copy_all(spark, source, _target(spark, "report"), options, declared)


def copy_report(spark, sf_dir):
    return _report(spark, sf_dir).select(
        "table_name", "status", "mode", "attempts", "rows", "schema", "target_schema",
        "skip_reason", F.col("error").isNotNull().alias("has_error"),
    )


def failed_copies(spark, sf_dir):
    return failed_tables(_report(spark, sf_dir)).select(
        "n_failed", F.array_join("failed", ",").alias("failed")
    )


def entry(spark: SparkSession) -> DataFrame:
    """Copy every table of the smallest data set and count the copies."""
    return copied_tables(spark, SMOKE_DIR)


def copy_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "catalog_tables": catalog_tables,
        "catalog_columns": catalog_columns,
        "catalog_keys": catalog_keys,
        "candidate_keys": candidate_keys,
        "inferred_keys": inferred_keys,
        "composite_keys": composite_keys,
        "select_tables": selected_tables,
        "immutability": immutable_tables,
        "key_range": key_ranges,
        "sync_plan": sync_plan,
        "split_bounds": all_split_bounds,
        "split_histogram": all_split_histograms,
        "balanced_splits": balanced_splits,
        "full_scan": full_scan,
        "partitioned_scan": partitioned_scan,
        "composite_split": composite_split,
        "jdbc_catalog_keys": jdbc_catalog_keys,
        "jdbc_full_scan": jdbc_full_scan,
        "jdbc_partitioned_scan": jdbc_partitioned_scan,
        "jdbc_composite_split": jdbc_composite_split,
        "snapshot_overwrite": snapshot_overwrite,
        "sketched_splits": sketched_splits,
        "target_names": target_names,
        "dated_targets": dated_targets,
        "target_schema": target_schemas,
        "conform_schema": conform_schema,
        "conform_types": conform_types,
        "fixed_width": fixed_width,
        "copy_all": copied_tables,
        "copy_report": copy_report,
        "failed_tables": failed_copies,
        "incremental_append": incremental_append,
        "incremental_lookback": incremental_lookback,
        "incremental_nulls": incremental_nulls,
        "incremental_reload": incremental_reload,
        "incremental_joined": incremental_joined,
        "incremental_tiers": incremental_tiers,
        "delta_updates": delta_updates,
        "range_reconcile": range_reconcile,
        "quarantine": quarantine,
        "hash_splits": hash_splits,
        "verified_parts": verified_parts,
        "incremental_copy": incremental_copy,
    }


# SQL ---------------------------------------------------------------------

# The columns of the test tables.
COLUMNS = {
    "benchmark": "item_id bigint, text string",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double,"
    " c_mktsegment string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string,"
    " value double, props string",
    "labels": "doc_id bigint, quality int, toxic int",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int,"
    " l_quantity double, l_extendedprice double, l_discount double, l_tax double,"
    " l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string,"
    " o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string",
    "pages": "page_id bigint, url string, html string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int,"
    " p_retailprice double",
    "region": "r_regionkey int, r_name string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
}
TARGET_NAMES = {
    "bigint": "INT64", "int": "INT64", "double": "FLOAT64", "string": "STRING",
    "timestamp_ntz": "DATETIME", "array<float>": "FLOAT64",
}
WIDTHS = {"bigint": 8, "double": 8, "timestamp_ntz": 8, "int": 4}


def _columns(table: str) -> list[tuple[str, str]]:
    return [tuple(c.split()) for c in COLUMNS[table].split(",")]


def _union(selects) -> str:
    return "\nUNION ALL\n".join(selects)


def _sizes_sql() -> str:
    """table_name, table_rows, size_bytes"""
    selects = []
    for table in TABLES:
        fixed = sum(WIDTHS.get(t, 0) for _, t in _columns(table))
        sums = [f"count(*) * {fixed}"]
        for name, kind in _columns(table):
            if kind == "string":
                sums.append(f"coalesce(sum(strlen({name})), 0)")
            elif kind == "array<float>":
                sums.append(f"coalesce(sum(4 * len({name})), 0)")
        selects.append(
            f"SELECT '{table}' AS table_name, count(*) AS table_rows,"
            f" CAST({' + '.join(sums)} AS BIGINT) AS size_bytes FROM {table}"
        )
    return _union(selects)


def _ranges_sql() -> str:
    """table_name, key_column, min_key, max_key"""
    leading = {name: key[0] for name, key in KEYS.items()} | {"lineitem": "l_orderkey"}
    return _union(
        f"SELECT '{t}' AS table_name, '{k}' AS key_column, CAST(min({k}) AS BIGINT) AS min_key,"
        f" CAST(max({k}) AS BIGINT) AS max_key FROM {t}"
        for t, k in leading.items()
    )


def _plan_sql() -> str:
    """The plan, as a list of common table expressions that ends with ``plan``."""
    keys = ", ".join(
        f"('{t}', '{','.join(KEYS[t])}', {len(KEYS[t])})" for t in TABLES if t in KEYS
    )
    marked = ", ".join(f"'{t}'" for t in TABLES if MARKER in dict(_columns(t)))
    return f"""sizes AS ({_sizes_sql()}),
ranges AS ({_ranges_sql()}),
keys(table_name, primary_key, width) AS (VALUES {keys}),
facts AS (
  SELECT s.table_name, s.size_bytes, s.table_name NOT IN ({marked}) AS immutable,
         k.primary_key, k.width,
         CASE WHEN k.primary_key IS NOT NULL AND s.size_bytes > {MIN_SPLIT_BYTES}
              THEN r.key_column END AS key_column,
         r.min_key AS low, r.max_key AS high
  FROM sizes s LEFT JOIN keys k USING (table_name) LEFT JOIN ranges r USING (table_name)
  WHERE s.table_rows > 0
),
plan AS (
  SELECT table_name, '{PREFIX}' || table_name AS target_name, size_bytes, immutable,
         primary_key, key_column,
         CASE WHEN key_column IS NOT NULL THEN low END AS min_key,
         CASE WHEN key_column IS NOT NULL THEN high END AS max_key,
         size_bytes AS bytes_to_sync,
         CAST(CASE WHEN key_column IS NULL THEN 1
                   WHEN width > 1 THEN ceil(size_bytes / {BYTES_PER_SPLIT})
                   ELSE least(ceil(size_bytes / {BYTES_PER_SPLIT}), high - low + 1)
              END AS INTEGER) AS n_splits
  FROM facts
)"""


def _candidates_sql() -> str:
    selects = []
    for table in TABLES:
        for position, (name, kind) in enumerate(_columns(table), start=1):
            unique = f"count(*) = count(DISTINCT {name}) AND count(*) > 0"
            if kind.startswith("array"):
                unique = "count(*) < 0"
            selects.append(
                f"SELECT '{table}' AS table_name, '{name}' AS column_name,"
                f" {position} AS ordinal_position,"
                f" {unique} AS is_key FROM {table}"
            )
    return _union(selects)


def _counts_sql(extra: Callable[[str], str]) -> str:
    return _union(
        f"SELECT '{t}' AS table_name, {extra(t)} FROM {t}" for t in TABLES
    )


def _composite_sql() -> str:
    """Pairs of columns of one table that tell its rows apart, where no column does."""

    def pairs(table: str) -> str:
        columns = [n for n, kind in _columns(table) if kind in ("bigint", "int")]
        single = " OR ".join(f"count(DISTINCT {c}) = count(*)" for c in columns)
        found = _union(
            f"""SELECT '{a},{b}' AS key FROM {table} HAVING count(*) > 0
                AND count(DISTINCT ({a}, {b})) = count(*)
                AND count({a}) = count(*) AND count({b}) = count(*)"""
            for i, a in enumerate(columns)
            for b in columns[i + 1 :]
        )
        return f"SELECT '{table}' AS table_name, key FROM ({found}), (SELECT {single} AS one FROM {table}) WHERE NOT one"

    kinds = {t: [k for _, k in _columns(t) if k in ("bigint", "int")] for t in TABLES}
    return _union(pairs(t) for t in TABLES if len(kinds[t]) > 1)


def copy_sql() -> dict[str, str]:
    spark_type = """CASE data_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int'
        WHEN 'DOUBLE' THEN 'double' WHEN 'VARCHAR' THEN 'string'
        WHEN 'TIMESTAMP' THEN 'timestamp_ntz' WHEN 'FLOAT[]' THEN 'array<float>' END"""
    listed = "table_schema = 'main' AND table_name IN (" + ", ".join(f"'{t}'" for t in TABLES) + ")"
    integral = ", ".join(
        f"('{t}', '{n}')" for t in TABLES for n, kind in _columns(t) if kind in ("bigint", "int")
    )
    lists = {
        "white": ", ".join(f"'{n.lower()}'" for n in WHITELIST),
        "black": ", ".join(f"'{n.lower()}'" for n in BLACKLIST),
    }
    columns = ", ".join(name for name, _ in _columns("customer"))

    def filled(value, empty="NULL") -> str:
        return f"CASE WHEN count(*) > 0 THEN {value} ELSE {empty} END"

    def copy_row(table: str) -> str:
        schema = "struct<" + ",".join(f"{n}:{k}" for n, k in _columns(table)) + ">"
        target = json.dumps(
            [
                {
                    "name": n,
                    "mode": "REPEATED" if k.startswith("array") else "NULLABLE",
                    "type": TARGET_NAMES[k],
                }
                for n, k in _columns(table)
            ]
        )
        if table == "lineitem":
            return (
                "'failed' AS status, CAST(NULL AS VARCHAR) AS mode, 2 AS attempts,"
                " CAST(NULL AS BIGINT) AS rows, CAST(NULL AS VARCHAR) AS schema,"
                " CAST(NULL AS VARCHAR) AS target_schema,"
                " CAST(NULL AS VARCHAR) AS skip_reason, count(*) > 0 AS has_error"
            )
        if table == "region":
            return (
                "'skipped' AS status, NULL AS mode, 0 AS attempts, NULL AS rows,"
                " NULL AS schema, NULL AS target_schema, CASE WHEN count(*) = 0 THEN 'empty' ELSE 'blacklisted' END"
                " AS skip_reason, false AS has_error"
            )
        return (
            f"{filled("'ok'", "'skipped'")} AS status, {filled("'snapshot'")} AS mode,"
            f" {filled(1, 0)} AS attempts, nullif(count(*), 0) AS rows,"
            f" {filled(f"'{schema}'")} AS schema, {filled(f"'{target}'")} AS target_schema,"
            f" {filled("NULL", "'empty'")} AS skip_reason, false AS has_error"
        )

    return {
        "catalog_tables": _sizes_sql(),
        "catalog_columns": f"""SELECT table_name, column_name,
            CAST(ordinal_position AS INTEGER) AS ordinal_position, {spark_type} AS data_type
            FROM information_schema.columns WHERE {listed}""",
        "catalog_keys": _union(
            f"SELECT '{t}' AS table_name, '{','.join(k)}' AS primary_key,"
            f" CAST(coalesce(sum(n), 0) AS BIGINT) AS n_rows, count(*) AS n_keys,"
            f" coalesce(sum(n) = count(*), false) AS is_key"
            f" FROM (SELECT count(*) AS n FROM {t} GROUP BY {', '.join(k)})"
            for t, k in KEYS.items()
        ),
        "candidate_keys": _candidates_sql(),
        "composite_keys": _composite_sql(),
        "sketched_splits": _union(
            f"SELECT '{t}' AS table_name, count(*) AS n_rows, 1 AS queries_of_a_row,"
            " true AS none_above_twice_its_share FROM lineitem"
            for t in ("lineitem", "skewed")
        ),
        "inferred_keys": f"""SELECT table_name, arg_min(column_name, ordinal_position)
            AS primary_key FROM ({_candidates_sql()})
            WHERE is_key AND (table_name, column_name) IN ({integral}) GROUP BY table_name""",
        "select_tables": f"""SELECT table_name, table_rows,
            CASE WHEN table_rows = 0 THEN 'empty'
                 WHEN table_name NOT IN ({lists["white"]}) THEN 'not_whitelisted'
                 WHEN table_name IN ({lists["black"]}) THEN 'blacklisted' END AS skip_reason
            FROM ({_counts_sql(lambda t: "count(*) AS table_rows")})""",
        "immutability": f"""SELECT table_name,
            NOT bool_or(lower(column_name) = '{MARKER}') AS immutable
            FROM information_schema.columns WHERE {listed} GROUP BY table_name""",
        "key_range": _ranges_sql(),
        "sync_plan": f"WITH {_plan_sql()} SELECT * FROM plan",
        "split_bounds": f"""WITH {_plan_sql()},
            splits AS (
              SELECT table_name, n_splits, CAST(unnest(range(n_splits)) AS INTEGER) AS split_id,
                     min_key, CAST(max_key - min_key + 1 AS HUGEINT) AS span
              FROM plan WHERE min_key IS NOT NULL)
            SELECT table_name, split_id,
                   CASE WHEN split_id > 0
                        THEN CAST(min_key + split_id * span // n_splits AS BIGINT) END AS lower,
                   CASE WHEN split_id < n_splits - 1
                        THEN CAST(min_key + (split_id + 1) * span // n_splits AS BIGINT)
                        END AS upper
            FROM splits""",
        "split_histogram": f"""WITH {_plan_sql()},
            bounds AS (
              SELECT table_name, split_id, CASE WHEN split_id > 0
                THEN min_key + split_id * CAST(max_key - min_key + 1 AS HUGEINT) // n_splits
                END AS lower
              FROM (SELECT *, CAST(unnest(range(n_splits)) AS INTEGER) AS split_id
                    FROM plan WHERE n_splits > 1)),
            ends AS (
              SELECT *, lead(lower) OVER (PARTITION BY table_name ORDER BY split_id) AS upper
              FROM bounds),
            rows AS ({_union(
                f"SELECT '{t}' AS table_name, CAST({k[0]} AS BIGINT) AS k FROM {t}"
                for t, k in KEYS.items()
            )})
            SELECT r.table_name, e.split_id, count(*) AS n_rows, min(k) AS min_key,
                   max(k) AS max_key
            FROM rows r JOIN ends e ON r.table_name = e.table_name
              AND (e.lower IS NULL OR r.k >= e.lower) AND (e.upper IS NULL OR r.k < e.upper)
            GROUP BY r.table_name, e.split_id""",
        "balanced_splits": _union(
            f"SELECT '{t}' AS table_name, count(*) AS n_rows, 1 AS queries_of_a_row,"
            " true AS enough_splits, true AS none_above_twice_its_share FROM lineitem"
            for t in ("lineitem", "skewed")
        ),
        "full_scan": "SELECT * FROM customer",
        "partitioned_scan": f"""WITH r AS (SELECT min(o_orderkey) AS low,
              max(o_orderkey) - min(o_orderkey) + 1 AS span FROM orders)
            SELECT orders.*,
              CAST(coalesce(((o_orderkey - low + 1) * {SPLITS} - 1) // span, 0) AS INTEGER)
                AS split_id, 1 AS n_queries
            FROM orders, r""",
        "composite_split": f"""WITH r AS (SELECT min(conv_id) AS low,
              max(conv_id) - min(conv_id) + 1 AS span FROM conversations)
            SELECT conversations.*,
              CAST(coalesce(((conv_id - low + 1) * {RANGES} - 1) // span, 0) * {RESIDUES}
                   + (coalesce(turn, 0) % {RESIDUES} + {RESIDUES}) % {RESIDUES}
                   AS INTEGER) AS split_id, 1 AS n_queries
            FROM conversations, r""",
        "jdbc_catalog_keys": """SELECT 'conversations' AS table_name,
            'conv_id,turn' AS primary_key, count(*) AS table_rows FROM conversations
            HAVING count(*) = (SELECT count(*) FROM
                               (SELECT DISTINCT conv_id, turn FROM conversations))""",
        "jdbc_full_scan": "SELECT * FROM customer",
        "jdbc_partitioned_scan": "SELECT * FROM orders",
        "jdbc_composite_split": "SELECT * FROM conversations",
        "snapshot_overwrite": "SELECT * FROM orders",
        "target_names": f"""SELECT table_name, '{PREFIX}' || table_name AS target_name,
            'project:dataset.{PREFIX}' || table_name AS qualified_name
            FROM (SELECT DISTINCT table_name FROM information_schema.columns WHERE {listed})""",
        "dated_targets": f"""SELECT '{PREFIX}orders_' || strftime(o_orderdate, '%Y%m%d')
            AS target_name, count(*) AS n_rows FROM orders GROUP BY 1""",
        "target_schema": f"""SELECT table_name, column_name,
            CASE data_type WHEN 'BIGINT' THEN 'INT64' WHEN 'INTEGER' THEN 'INT64'
              WHEN 'DOUBLE' THEN 'FLOAT64' WHEN 'FLOAT[]' THEN 'FLOAT64'
              WHEN 'VARCHAR' THEN 'STRING' WHEN 'TIMESTAMP' THEN 'DATETIME' END AS target_type,
            CASE WHEN data_type LIKE '%[]' THEN 'REPEATED' ELSE 'NULLABLE' END AS mode
            FROM information_schema.columns WHERE {listed}""",
        "conform_schema": """SELECT p_name, p_partkey, CAST(p_size AS BIGINT) AS p_size,
            CAST(p_retailprice AS VARCHAR) AS p_retailprice, p_brand, p_type,
            CAST(NULL AS VARCHAR) AS p_comment FROM part""",
        "conform_types": """SELECT CAST(o_orderkey AS DOUBLE) AS o_orderkey,
            CAST(o_custkey AS VARCHAR) AS o_custkey, o_orderstatus,
            CAST(o_totalprice AS DECIMAL(15, 2)) AS o_totalprice,
            CAST(o_orderdate AS DATE) AS o_orderdate, o_orderpriority FROM orders""",
        "fixed_width": "SELECT "
        + " || ".join(
            f"CASE WHEN length(coalesce(CAST({n} AS VARCHAR), 'null')) >= 50"
            f" THEN CAST({n} AS VARCHAR)"
            f" ELSE rpad(coalesce(CAST({n} AS VARCHAR), 'null'), 50, ' ') END"
            for n in columns.split(", ")
        )
        + " AS line FROM customer",
        "copy_all": _counts_sql(
            lambda t: f"'{PREFIX}{t}' AS target_name, {filled("'ok'", "'skipped'")} AS status,"
            " nullif(count(*), 0) AS n_rows"
        ),
        "copy_report": "SELECT * FROM ("
        + _union(
            f"SELECT '{t}' AS table_name, {copy_row(t)} FROM {t}"
            for t in ["lineitem", *(t for t in TABLES if t != "lineitem")]
        )
        + ")",
        "failed_tables": """SELECT count(*) AS n_failed, coalesce(string_agg(t, ','), '') AS failed
            FROM (SELECT 'lineitem' AS t FROM lineitem GROUP BY 1)""",
        "incremental_append": "SELECT * FROM orders",
        "incremental_lookback": "SELECT * FROM events",
        "incremental_nulls": "SELECT * REPLACE"
        " (CASE WHEN o_orderkey % 7 <> 0 THEN o_orderkey END AS o_orderkey) FROM orders",
        "incremental_reload": """SELECT * FROM events WHERE event_id <=
            (SELECT (min(event_id) + max(event_id)) // 2 FROM events)""",
        "incremental_joined": "SELECT * FROM orders",
        "incremental_tiers": "SELECT * FROM orders",
        "delta_updates": """WITH span AS (
            SELECT CAST(floor(epoch(max(ts) - min(ts)) / 86400) AS INTEGER) + 1 AS days FROM events
          ), changes AS (
            SELECT *, event_id % 10 = 2 OR event_id % 4 = 1 AS first,
              event_id % 20 = 2 OR event_id % 4 = 3 AS second FROM events
          ), once AS (
            SELECT * REPLACE (CASE WHEN first THEN value * 2 + 1 ELSE value END AS value,
              CASE WHEN first THEN ts + days * INTERVAL 1 DAY ELSE ts END AS ts)
            FROM changes, span
          )
          SELECT event_id, CASE WHEN second THEN ts + 2 * days * INTERVAL 1 DAY ELSE ts END AS ts,
            user_id, event_type, CASE WHEN second THEN value * 2 + 2 ELSE value END AS value, props
          FROM once""",
        "range_reconcile": """SELECT * REPLACE (
            CASE WHEN o_orderkey % 1000 = 9 THEN -o_orderkey ELSE o_orderkey END AS o_orderkey,
            CASE WHEN o_orderkey % 1000 = 11 THEN 0.5 ELSE o_totalprice END AS o_totalprice)
          FROM orders WHERE o_orderkey % 1000 <> 7""",
        "quarantine": """WITH texts AS (
            SELECT CASE WHEN p_partkey % 11 = 0 THEN 'p' ELSE CAST(p_partkey AS VARCHAR) END AS p_partkey,
              CASE WHEN p_partkey % 13 <> 0 THEN p_name END AS p_name,
              CAST(p_size AS VARCHAR) || CASE WHEN p_partkey % 7 = 0 THEN '.5' ELSE '' END AS p_size,
              p_partkey % 11 = 0 AS a, p_partkey % 13 = 0 AS b, p_partkey % 7 = 0 AS c
            FROM part
          )
          SELECT 'row' AS kind, p_partkey, p_name, p_size, CAST(NULL AS VARCHAR) AS problem
          FROM texts WHERE NOT (a OR b OR c)
          UNION ALL SELECT 'problem', p_partkey, p_name, p_size, unnest(list_filter([
            CASE WHEN a THEN 'p_partkey: value does not fit bigint' END,
            CASE WHEN b THEN 'p_name: required value is NULL' END,
            CASE WHEN c THEN 'p_size: value does not fit bigint' END], lambda x: x IS NOT NULL))
          FROM texts""",
        "hash_splits": """SELECT l_linenumber, count(*) AS n_rows, 1 AS queries_of_a_row,
            CASE WHEN l_linenumber = 3 THEN 0 END AS split_without_hash
          FROM lineitem GROUP BY l_linenumber""",
        "verified_parts": "SELECT * EXCLUDE (table_name) FROM (" + _counts_sql(
            lambda t: f"'{PREFIX}{t}' AS target_name, count(*) AS n_rows, 0 AS damaged"
        ) + ")",
        "incremental_copy": _counts_sql(
            lambda t: f"{filled("'ok'", "'skipped'")} AS status,"
            + f" {filled("'append'")} AS mode, {filled("0::BIGINT")} AS rows"
            if len(KEYS.get(t, ())) == 1 and MARKER not in dict(_columns(t))
            else f"{filled("'ok'", "'skipped'")} AS status,"
            + f" {filled("'snapshot'")} AS mode, nullif(count(*), 0) AS rows"
        ),
    }


# The operators on documents and their pipeline are optional, and so is what they import.
try:
    import corpus_pipeline
    from snapsync.llm import queries as llm
except ModuleNotFoundError as missing:
    # A module of the library itself that is missing is an error.
    own = (missing.name or "").startswith("snapsync")
    if own and not missing.name.startswith("snapsync.llm"):
        raise
    print(f"without the operators on documents: {missing}", file=sys.stderr)
    llm = None


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    if llm is None:
        return copy_queries()
    return {**copy_queries(), **llm.queries(), "pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    if llm is None:
        return copy_sql()
    pipeline = corpus_pipeline.ORACLE_SQL
    return {**copy_sql(), **llm.oracle_sql(), **({"pipeline": pipeline} if pipeline else {})}
