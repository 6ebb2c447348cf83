"""What the physical plans may and may not hold."""

import re

import embedded_db
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from snapsync.functions.text import render_fixed_width
from snapsync.operators import sink
from snapsync.operators.schema import conform, load_schema
from snapsync.options import CopyOptions, FileTarget
from snapsync.plans.splits import split_histogram, split_of
from snapsync.sources import catalog
from snapsync.sources.base import local_frame
from snapsync.sources.files import FileSource
from snapsync.sources.read import read_table


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


def read_columns(df):
    """Columns that the file scans of a plan read."""
    found = re.findall(r"ReadSchema: struct<([^>]*)>", physical(df))
    return sorted({c.split(":")[0] for schema in found for c in schema.split(",") if c})


@pytest.fixture(scope="module")
def opened(spark, sf_dir):
    return FileSource(sf_dir, keys=entry.KEYS, names=entry.TABLES).open(spark)


def test_copies_do_not_shuffle(spark, opened):
    declared = load_schema(entry.DECLARED_PART)
    for df in (
        read_table(opened, {"table_name": "lineitem"}),
        conform(opened.read("part"), declared),
        render_fixed_width(opened.read("customer")),
        opened.read("orders").withColumn("split_id", split_of("o_orderkey", 0, 1499, 8)),
    ):
        assert "Exchange" not in physical(df) and "Python" not in physical(df)


@pytest.fixture
def small_tasks(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "6000")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_larger_splits_of_files(spark, tmp_path, small_tasks):
    spark.range(40_000).repartition(40).write.parquet(f"{tmp_path}/t")
    opened = FileSource(str(tmp_path)).open(spark)
    size = catalog.tables(opened).first().size_bytes
    row = {"table_name": "t", "size_bytes": size}

    def tasks(bytes_per_split):
        df = read_table(opened, row, CopyOptions(bytes_per_split=bytes_per_split))
        assert "Exchange" not in physical(df) and df.count() == 40_000
        return df.rdd.getNumPartitions()

    cut = opened.read("t").rdd.getNumPartitions()
    assert cut > 12 and tasks(size // 1000) == cut
    assert tasks(size // 12 + 1) == 12
    # Fewer splits than cores would leave some idle.
    assert tasks(size) == cut


def test_increments_push_the_mark_down(spark, opened, tmp_path):
    row = {"table_name": "orders", "append_key": "o_orderkey"}
    plan = physical(read_table(opened, row, above=700))
    assert "GreaterThan(o_orderkey,700)" in plan and "Exchange" not in plan
    target = FileTarget(str(tmp_path))
    sink.write_snapshot(opened.read("orders"), target, "orders", "o_orderkey")
    present = sink.read_snapshot(spark, target, "orders").filter("o_orderkey > 700")
    new = read_table(opened, row, above=700).join(
        present.select("o_orderkey"), "o_orderkey", "left_anti"
    )
    assert physical(new).count("GreaterThan(o_orderkey,700)") >= 2


def test_database_scans_push_down(spark, sf_dir):
    database = embedded_db.load(spark, sf_dir, {"orders": ["o_orderkey"]}).open(spark)
    row = {
        "table_name": "orders", "append_key": "o_orderkey", "key_column": "o_orderkey",
        "min_key": 0, "max_key": 1499, "n_splits": 4,
    }
    df = read_table(database, row, above=700).select("o_totalprice")
    assert "GreaterThan(o_orderkey,700)" in physical(df)
    assert "o_orderstatus" not in physical(df)
    # The range of a key comes from the database, not from fetched rows.
    stats = database.key_stats("orders", "o_orderkey")
    assert "Aggregate" not in physical(stats)


def test_scans_read_what_they_need(opened):
    assert read_columns(catalog.tables(opened, "counted")) == []
    wide = read_columns(catalog.tables(opened, "logical"))
    assert "text" in wide and not {"l_quantity", "o_orderdate", "event_id"} & set(wide)
    histogram = split_histogram(opened.read("orders"), "o_orderkey", 0, 1499, 8)
    assert read_columns(histogram) == ["o_orderkey"]
    # Partial counts before the one shuffle.
    assert physical(histogram).count("Exchange") == 1
    assert physical(histogram).count("HashAggregate") == 2
    keys = catalog.check_keys(opened.frames, {"conversations": ["conv_id", "turn"]})
    assert read_columns(keys) == ["conv_id", "turn"]


def test_first_look_reads_no_table(opened):
    stored = catalog.tables(opened)
    assert "FileScan" not in physical(stored)


def test_catalog_frames_have_a_known_size(spark, opened):
    joined = catalog.keys(opened).join(catalog.columns(opened), "table_name")
    assert "SortMergeJoin" not in physical(joined)
    assert local_frame(spark, [], opened.columns().schema).isEmpty()


def test_no_python_per_row(spark, sf_dir):
    for name in ("fixed_width", "conform_schema", "partitioned_scan", "composite_split",
                 "dated_targets", "split_histogram", "candidate_keys"):
        plan = physical(entry.queries()[name](spark, sf_dir).filter(F.lit(True)))
        assert "Python" not in plan and "CartesianProduct" not in plan
        assert "NestedLoop" not in plan
