import json
import subprocess
import sys
import threading
from pathlib import Path

import embedded_db
import pytest
from conftest import rows
from pyspark.sql import functions as F

from snapsync.__main__ import run
from snapsync.operators import copy as copying
from snapsync.operators import sink
from snapsync.operators.copy import CopyFailed, copy_all, copy_incremental, failed_tables
from snapsync.operators.schema import load_schema
from snapsync.options import CatalogTarget, CopyOptions, FileTarget
from snapsync.sources.files import FileSource
from snapsync.sources.read import read_table

ROOT = Path(__file__).resolve().parents[1]


@pytest.fixture
def target(tmp_path):
    return FileTarget(str(tmp_path / "target"), prefix="p_")


def status(report):
    return {r.table_name: r for r in report.collect()}


def same_rows(a, b):
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_copy_all_tables(spark, sf_dir, target):
    report = copy_all(spark, FileSource(sf_dir), target)
    source = FileSource(sf_dir).open(spark)
    found = status(report)
    assert set(found) == set(source.frames) and len(found) == 14
    for name, df in source.frames.items():
        copy = sink.read_snapshot(spark, target, f"p_{name}")
        assert copy.dtypes == df.dtypes and same_rows(copy, df)
        row = found[name]
        assert (row.status, row.mode, row.attempts) == ("ok", "snapshot", 1)
        assert row.rows == df.count() and row.schema == df.schema.simpleString()
        assert row.target_name == f"{target.path}/p_{name}"


def test_lists_and_empty_tables(spark, write_tables, target):
    path = write_tables(
        Users=spark.range(3), tags=spark.range(2), both=spark.range(1), hollow=spark.range(0)
    )
    options = CopyOptions(whitelist=["users", "BOTH", "hollow"], blacklist=["both"])
    found = status(copy_all(spark, FileSource(path), target, options))
    assert {n: (r.status, r.skip_reason, r.attempts) for n, r in found.items()} == {
        "Users": ("ok", None, 1),
        "both": ("skipped", "blacklisted", 0),
        "hollow": ("skipped", "empty", 0),
        "tags": ("skipped", "not_whitelisted", 0),
    }
    assert sink.list_tables(spark, target) == ["p_Users"]


BAD_NUMBER = load_schema('[{"name": "id", "type": "INT64"}, {"name": "s", "type": "INT64"}]')


@pytest.mark.parametrize("attempts,made", [(0, 1), (1, 1), (3, 3)])
def test_failures_stay_with_their_table(spark, write_tables, target, attempts, made):
    old = spark.range(2).withColumn("s", F.lit(5))
    sink.write_snapshot(old, target, "p_bad")
    bad = spark.range(0, 500, 1, 4).withColumn(
        "s", F.when(F.col("id") == 499, "x").otherwise(F.col("id").cast("string"))
    )
    path = write_tables(bad=bad, good=spark.range(4))
    options = CopyOptions(max_attempts=attempts, max_parallel_writers=2)
    report = copy_all(spark, FileSource(path), target, options, {"bad": BAD_NUMBER})
    found = status(report)
    assert (found["bad"].status, found["bad"].attempts) == ("failed", made)
    assert "s: value does not fit" in found["bad"].error and found["bad"].rows is None
    assert (found["good"].status, found["good"].error) == ("ok", None)
    assert same_rows(sink.read_snapshot(spark, target, "p_bad"), old)
    assert rows(failed_tables(report)) == [(1, ["bad"])]
    with pytest.raises(CopyFailed, match="bad") as failed:
        copy_all(
            spark, FileSource(path), target, options.with_(raise_on_failure=True),
            {"bad": BAD_NUMBER},
        )
    assert status(failed.value.report)["good"].status == "ok"


def test_retry_succeeds(spark, write_tables, target, monkeypatch):
    path = write_tables(t=spark.range(4))
    calls = []
    write = sink.write_snapshot

    def flaky(*args):
        calls.append(args)
        if len(calls) < 3:
            raise OSError("store is away")
        return write(*args)

    monkeypatch.setattr(sink, "write_snapshot", flaky)
    found = status(copy_all(spark, FileSource(path), target, CopyOptions(max_attempts=5)))
    assert (found["t"].status, found["t"].attempts, found["t"].rows) == ("ok", 3, 4)


def test_unreadable_table(spark, write_tables, target, tmp_path):
    path = write_tables(t=spark.range(4))
    Path(f"{path}/broken.parquet").write_text("no parquet")
    found = status(copy_all(spark, FileSource(path), target))
    assert found["broken"].status == "failed" and found["broken"].error
    assert found["t"].status == "ok"


def test_target_flags(spark, write_tables, target):
    path = write_tables(old=spark.range(4), new=spark.range(5))
    sink.write_snapshot(spark.range(1), target, "p_old")
    source = FileSource(path)
    options = CopyOptions(overwrite_existing=False, max_attempts=3)
    found = status(copy_all(spark, source, target, options))
    assert (found["old"].status, found["old"].attempts) == ("failed", 1)
    assert "exists" in found["old"].error and found["new"].status == "ok"
    fresh = FileTarget(target.path + "2")
    sink.write_snapshot(spark.range(1), fresh, "old")
    found = status(copy_all(spark, source, fresh, CopyOptions(create_if_absent=False)))
    assert found["old"].status == "ok" and "absent" in found["new"].error


def test_writers_are_bounded(spark, sf_dir, target, monkeypatch):
    lock, running, most = threading.Lock(), set(), []
    copy_table = copying.copy_table

    def watched(opened, target, row, *rest):
        with lock:
            running.add(row["table_name"])
            most.append(len(running))
        try:
            return copy_table(opened, target, row, *rest)
        finally:
            with lock:
                running.discard(row["table_name"])

    monkeypatch.setattr(copying, "copy_table", watched)
    copy_all(spark, FileSource(sf_dir), target, CopyOptions(max_parallel_writers=3))
    assert max(most) == 3


def test_catalog_target(spark, write_tables):
    spark.sql("CREATE DATABASE IF NOT EXISTS copies")
    path = write_tables(t=spark.range(4))
    target = CatalogTarget("copies", prefix="c_")
    source = FileSource(path, keys={"t": ["id"]})
    for _ in range(2):
        found = status(copy_all(spark, source, target, CopyOptions(incremental=True)))
        assert (found["t"].mode, found["t"].target_name) == ("snapshot", "copies.c_t")
    assert spark.table("copies.c_t").count() == 4


# Increments --------------------------------------------------------------


def growing(spark, tmp_path, stop, start=0, version=0, extra=False):
    df = spark.range(start, stop).withColumn("v", F.lit(version))
    if extra:
        df = df.withColumn("w", F.lit("x"))
    path = f"{tmp_path}/source{version}"
    df.write.parquet(f"{path}/t.parquet")
    df.withColumn("updated_at", F.lit("x")).write.parquet(f"{path}/mutable.parquet")
    return FileSource(path, keys={"t": ["id"], "mutable": ["id"]})


def test_only_new_rows_are_appended(spark, tmp_path, target):
    options = CopyOptions(incremental=True)
    first = status(copy_all(spark, growing(spark, tmp_path, 10, version=0), target, options))
    assert (first["t"].mode, first["t"].rows) == ("snapshot", 10)
    second = status(copy_all(spark, growing(spark, tmp_path, 14, version=1), target, options))
    assert (second["t"].mode, second["t"].rows) == ("append", 4)
    # A table that is updated in place is copied whole.
    assert (second["mutable"].mode, second["mutable"].rows) == ("snapshot", 14)
    found = sink.read_snapshot(spark, target, "p_t").groupBy("v").count()
    assert rows(found) == [(0, 10), (1, 4)]
    third = status(copy_all(spark, growing(spark, tmp_path, 14, version=2), target, options))
    assert (third["t"].mode, third["t"].rows) == ("append", 0)
    off = status(copy_all(spark, growing(spark, tmp_path, 14, version=3), target))
    assert off["t"].mode == "snapshot"


def test_lookback_finds_late_rows_once(spark, tmp_path, target):
    early = spark.range(100).filter("id % 7 <> 0")
    sink.write_snapshot(early, target, "t", "id")
    path = f"{tmp_path}/s"
    spark.range(130).write.parquet(f"{path}/t.parquet")
    opened = FileSource(path, keys={"t": ["id"]}).open(spark)
    row = {"table_name": "t", "target_name": "t", "append_key": "id"}
    mode, done = copy_incremental(
        opened, target, row, CopyOptions(incremental=True, lookback=200)
    )
    assert (mode, done.rows) == ("append", 130 - early.count())
    assert same_rows(sink.read_snapshot(spark, target, "t"), spark.range(130).toDF("id"))


def test_changed_schema_is_copied_whole(spark, tmp_path, target):
    options = CopyOptions(incremental=True)
    copy_all(spark, growing(spark, tmp_path, 10, version=0), target, options)
    wider = growing(spark, tmp_path, 12, version=1, extra=True)
    found = status(copy_all(spark, wider, target, options))
    assert (found["t"].mode, found["t"].rows) == ("snapshot", 12)
    assert sink.read_snapshot(spark, target, "p_t").columns == ["id", "v", "w"]


def test_appending_is_not_overwriting(spark, tmp_path, target):
    source = growing(spark, tmp_path, 10, version=0)
    options = CopyOptions(incremental=True, overwrite_existing=False, whitelist=["t"])
    assert status(copy_all(spark, source, target, options))["t"].mode == "snapshot"
    source = growing(spark, tmp_path, 12, version=1)
    assert status(copy_all(spark, source, target, options))["t"].mode == "append"
    # A whole copy would be.
    source = growing(spark, tmp_path, 14, version=2, extra=True)
    found = status(copy_all(spark, source, target, options))["t"]
    assert found.status == "failed" and "exists" in found.error
    assert sink.read_snapshot(spark, target, "p_t").count() == 12


def test_null_keys_and_reloads_are_copied_whole(spark, tmp_path, target):
    row = {"table_name": "t", "target_name": "t", "append_key": "id"}

    def increment(number, df):
        df.write.parquet(f"{tmp_path}/s{number}/t.parquet")
        opened = FileSource(f"{tmp_path}/s{number}", keys={"t": ["id"]}).open(spark)
        mode, done = copy_incremental(opened, target, row, CopyOptions())
        assert same_rows(sink.read_snapshot(spark, target, "t"), opened.read("t"))
        return mode, done.rows

    first = spark.range(10).select("id")
    assert increment(0, first) == ("snapshot", 10)
    assert increment(1, spark.range(12).select("id")) == ("append", 2)
    with_null = spark.range(12).unionByName(spark.sql("SELECT CAST(NULL AS bigint) AS id"))
    assert increment(2, with_null) == ("snapshot", 13)
    # A source that was loaded anew.
    assert increment(3, spark.range(5)) == ("snapshot", 5)
    assert increment(4, spark.range(0)) == ("snapshot", 0)
    assert increment(5, spark.range(3)) == ("snapshot", 3)


def test_errors_are_whole(spark, write_tables, target):
    path = write_tables(t=spark.createDataFrame([("x" * 5000 + "the cause",)], "a string"))
    declared = {"t": load_schema('[{"name": "a", "type": "STRING"}, {"name": "' + "b" * 3000
                                 + '", "type": "STRING", "mode": "REQUIRED"}]')}
    found = status(copy_all(spark, FileSource(path), target, declared=declared))
    assert "required column is missing" in found["t"].error and len(found["t"].error) > 3000


def test_unsigned_keys_beyond_a_long(spark, tmp_path, target):
    path = f"{tmp_path}/u"
    df = spark.sql("SELECT CAST(id AS DECIMAL(20,0)) + 18446744073709551000 AS id FROM range(9)")
    df.select(df.id.cast("decimal(20,0)")).write.parquet(f"{path}/t.parquet")
    opened = FileSource(path, keys={"t": ["id"]}).open(spark)
    row = {"table_name": "t", "target_name": "t", "append_key": "id"}
    options = CopyOptions(incremental=True)
    for _ in range(2):
        mode, done = copy_incremental(opened, target, row, options)
        assert (mode, done.rows) == ("snapshot", 9)
    assert sink.high_water(spark, target, "t", "id") == 18446744073709551008


def test_retried_increment_does_not_repeat_rows(spark, tmp_path, target, monkeypatch):
    options = CopyOptions(incremental=True, max_attempts=3, whitelist=["t"])
    copy_all(spark, growing(spark, tmp_path, 10, version=0), target, options)
    append, calls = sink.append_increment, []

    def lost_answer(*args):
        done = append(*args)
        calls.append(done.rows)
        if len(calls) == 1:
            raise OSError("published, but the answer was lost")
        return done

    monkeypatch.setattr(sink, "append_increment", lost_answer)
    found = status(copy_all(spark, growing(spark, tmp_path, 15, version=1), target, options))
    assert (found["t"].status, found["t"].attempts) == ("ok", 2) and calls == [5, 0]
    assert sink.read_snapshot(spark, target, "p_t").count() == 15


# Databases ---------------------------------------------------------------


def test_copy_a_database(spark, sf_dir, target, monkeypatch):
    keys = {"orders": ["o_orderkey"], "conversations": ["conv_id", "turn"], "nation": []}
    source = embedded_db.load(spark, sf_dir, keys, name="copydb")
    scans = {}

    def watched(opened, row, *rest, **named):
        df = read_table(opened, row, *rest, **named)
        scans[row["table_name"]] = df.rdd.getNumPartitions()
        return df

    monkeypatch.setattr(copying, "read_table", watched)
    options = CopyOptions(min_split_bytes=5000, bytes_per_split=5000, incremental=True)
    report = status(copy_all(spark, source, target, options))
    assert {n: r.status for n, r in report.items()} == dict.fromkeys(keys, "ok")
    assert scans["orders"] > 4 and scans["nation"] == 1
    for name in keys:
        original = spark.read.parquet(f"{sf_dir}/{name}.parquet")
        assert same_rows(sink.read_snapshot(spark, target, f"p_{name}"), original)
    embedded_db.execute(
        spark, "copydb",
        """INSERT INTO APP."orders" VALUES (90000, 1, 'O', 2.5, CURRENT_TIMESTAMP, '1')""",
    )
    report = status(copy_all(spark, source, target, options))
    assert (report["orders"].mode, report["orders"].rows) == ("append", 1)
    assert report["conversations"].mode == "snapshot"
    # One row above the mark is no reason to open many connections.
    assert scans["orders"] <= 60


def test_a_table_that_is_gone(spark, sf_dir, target, monkeypatch):
    keys = {"orders": ["o_orderkey"], "nation": ["n_nationkey"]}
    opened = embedded_db.load(spark, sf_dir, keys, name="gonedb").open(spark)
    tables, columns, usage = opened.tables(), opened.columns(), opened.key_usage()
    constraints = opened.constraints()
    for name, frame in (("tables", tables), ("columns", columns),
                        ("constraints", constraints), ("key_usage", usage)):
        # The catalog as it was before the table went.
        kept = spark.createDataFrame(frame.collect(), frame.schema)
        monkeypatch.setattr(opened, name, lambda *_, kept=kept: kept)
    embedded_db.execute(spark, "gonedb", 'DROP TABLE APP."orders"')
    options = CopyOptions(min_split_bytes=100, bytes_per_split=1000, max_attempts=2)
    found = status(copy_all(spark, opened, target, options))
    assert (found["orders"].status, found["orders"].attempts) == ("failed", 2)
    assert (found["nation"].status, found["nation"].rows) == ("ok", 25)


def test_errors_do_not_show_the_password(spark, target):
    source = embedded_db.source("gone", user="u", password="hidden-word")
    opened = source.open(spark)
    assert copying._message(opened, ValueError("url?password=hidden-word")) == "url?password=***"


# Program -----------------------------------------------------------------


def test_run_settings(spark, write_tables, tmp_path):
    path = write_tables(t=spark.range(4), u=spark.range(4))
    settings = {
        "source-files": {"path": path, "tables-whitelist": ["t"]},
        "target-files": {"path": f"{tmp_path}/out", "table-prefix": "x_"},
        "max-parallel-writers": 2,
    }
    found = status(run(spark, json.dumps(settings)))
    assert (found["t"].status, found["u"].skip_reason) == ("ok", "not_whitelisted")


def test_program(spark, write_tables, tmp_path):
    path = write_tables(t=spark.range(4))
    file = tmp_path / "settings.json"
    file.write_text(
        json.dumps({"source-files": {"path": path}, "target-files": {"path": f"{tmp_path}/out"}})
    )
    shown = subprocess.run(
        [sys.executable, "-m", "snapsync", str(file), "--report", f"{tmp_path}/report"],
        cwd=tmp_path,
        env={"PYTHONPATH": str(ROOT), "PATH": "/usr/bin:/bin:/usr/local/bin", "SPARK_CONF_OPTS": ""}
        | {k: v for k, v in __import__("os").environ.items() if k in ("JAVA_HOME", "SPARK_HOME")}
        | {"PYSPARK_SUBMIT_ARGS": "--master local[2] --conf spark.ui.enabled=false pyspark-shell"},
        capture_output=True,
        text=True,
        timeout=300,
    )
    assert shown.returncode == 0, shown.stderr
    assert [json.loads(line)["rows"] for line in shown.stdout.splitlines()] == [4]
    assert [r.status for r in spark.read.json(f"{tmp_path}/report").collect()] == ["ok"]
