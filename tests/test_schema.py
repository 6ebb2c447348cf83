import datetime
import json
from decimal import Decimal

import embedded_db
import pytest
from conftest import rows
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapsync import copy_all
from snapsync.functions.names import qualified_name, target_name
from snapsync.functions.text import render_fixed_width
from snapsync.operators import sink
from snapsync.operators.schema import (
    conform,
    conform_or_tell,
    load_schema,
    required,
    target_fields,
    target_schema,
)
from snapsync.options import ConnectorTarget, CopyOptions, FileTarget
from snapsync.sources.files import FileSource

ALL_TYPES = (
    "b boolean, i1 tinyint, i2 smallint, i4 int, i8 bigint, f float, d double, s string,"
    " x binary, day date, ts timestamp, ntz timestamp_ntz, n decimal(20,0),"
    " n2 decimal(38,9), big decimal(38,10), wide decimal(35,2), a array<string>,"
    " r struct<p:int,q:array<double>>, m map<string,long>"
)


def test_target_schema(spark):
    df = spark.createDataFrame([], ALL_TYPES)
    found = [tuple(r) for r in target_schema(df).collect()]
    assert found == [
        ("b", "BOOL", "NULLABLE"),
        ("i1", "INT64", "NULLABLE"),
        ("i2", "INT64", "NULLABLE"),
        ("i4", "INT64", "NULLABLE"),
        ("i8", "INT64", "NULLABLE"),
        ("f", "FLOAT64", "NULLABLE"),
        ("d", "FLOAT64", "NULLABLE"),
        ("s", "STRING", "NULLABLE"),
        ("x", "BYTES", "NULLABLE"),
        ("day", "DATE", "NULLABLE"),
        ("ts", "TIMESTAMP", "NULLABLE"),
        ("ntz", "DATETIME", "NULLABLE"),
        ("n", "NUMERIC", "NULLABLE"),
        ("n2", "NUMERIC", "NULLABLE"),
        ("big", "BIGNUMERIC", "NULLABLE"),
        ("wide", "BIGNUMERIC", "NULLABLE"),
        ("a", "STRING", "REPEATED"),
        ("r", "RECORD", "NULLABLE"),
        ("r.p", "INT64", "NULLABLE"),
        ("r.q", "FLOAT64", "REPEATED"),
        ("m", "RECORD", "REPEATED"),
        ("m.key", "STRING", "REQUIRED"),
        ("m.value", "INT64", "NULLABLE"),
    ]


@pytest.mark.parametrize("kind", ["interval day to second", "array<array<int>>"])
def test_types_without_a_target(spark, kind):
    with pytest.raises(TypeError, match="c: "):
        target_schema(spark.createDataFrame([], T.StructType.fromDDL(f"c {kind}")))


def test_sized_strings():
    fields = target_fields(T.StructType.fromDDL("v varchar(9), c char(2)"))
    assert [f["type"] for f in fields] == ["STRING", "STRING"]


def test_derived_schema_loads_back(spark):
    schema = T.StructType.fromDDL("i int, n decimal(20,0), a array<float>, r struct<p:date>")
    loaded = load_schema(json.dumps(target_fields(schema)))
    assert loaded.simpleString() == (
        "struct<i:bigint,n:decimal(20,0),a:array<double>,r:struct<p:date>>"
    )


def test_load_schema():
    schema = load_schema(
        """[{"name": "id", "type": "INTEGER", "mode": "REQUIRED", "description": "key"},
            {"name": "tags", "type": "string", "mode": "repeated"},
            {"name": "price", "type": "NUMERIC"},
            {"name": "at", "type": "RECORD", "fields": [{"name": "day", "type": "DATE"}]}]"""
    )
    assert not schema["id"].nullable and schema["tags"].nullable
    assert schema["id"].metadata == {"description": "key"}
    assert schema.simpleString() == (
        "struct<id:bigint,tags:array<string>,price:decimal(38,9),at:struct<day:date>>"
    )


@pytest.mark.parametrize(
    "text",
    [
        "{}",
        '["id"]',
        '[{"name": "id"}]',
        '[{"name": "id", "type": "SHAPE"}]',
        '[{"name": "id", "type": "STRING", "mode": "MAYBE"}]',
        '[{"name": "id", "type": "STRING"}, {"name": "ID", "type": "STRING"}]',
    ],
)
def test_bad_schemas(text):
    with pytest.raises(ValueError):
        load_schema(text)


def declared(**columns):
    modes = {True: "NULLABLE", False: "REQUIRED"}
    return load_schema(
        json.dumps(
            [
                {"name": n, "type": t.rstrip("!"), "mode": modes[not t.endswith("!")]}
                for n, t in columns.items()
            ]
        )
    )


def test_conform(spark):
    df = spark.createDataFrame(
        [(1, "2", 3.0, "2024-01-31"), (None, None, None, None)],
        "a int, B string, c double, d string",
    )
    wanted = declared(d="DATE", b="INT64", a="INT64", c="INT64", extra="STRING")
    found = conform(df, wanted)
    assert found.dtypes == [
        ("d", "date"), ("b", "bigint"), ("a", "bigint"), ("c", "bigint"), ("extra", "string"),
    ]
    assert rows(found) == [
        (None, None, None, None, None),
        (datetime.date(2024, 1, 31), 2, 1, 3, None),
    ]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


@pytest.mark.parametrize("ansi", ["true", "false"])
@pytest.mark.parametrize(
    "value,have,want",
    [
        ("x", "string", "INT64"),
        (1.5, "double", "INT64"),
        (1e30, "double", "INT64"),
        ("2024-13-01", "string", "DATE"),
        (Decimal("1.25"), "decimal(5,2)", {"type": "NUMERIC", "precision": 5, "scale": 1}),
        (Decimal("1.123456789012"), "decimal(20,12)", "NUMERIC"),
        (Decimal("1" * 29), "decimal(38,0)", "FLOAT64"),
        (0.12345678912345, "double", "NUMERIC"),
        (9007199254740993, "bigint", "FLOAT64"),
        (2, "int", "BOOL"),
        (float("nan"), "double", "NUMERIC"),
        ("1.23456789012345", "string", "NUMERIC"),
        ("9007199254740993", "string", "FLOAT64"),
        ("0.1234567890123456789", "string", "FLOAT64"),
        ("2024-01-02 23:59:58", "string", "DATE"),
        ("2024-01-02 03:04:05.1234567", "string", "DATETIME"),
        ("2024-01-02 03:04:05+02:00", "string", "DATETIME"),
        ("2024-01-02T03:04:05Z", "string", "DATETIME"),
        (datetime.datetime(2024, 1, 2, 23, 59, 58), "timestamp_ntz", "DATE"),
        (datetime.datetime(2024, 1, 2, 0, 0, 0, 1), "timestamp", "DATE"),
        (b"\xff", "binary", "STRING"),
        ({"k": "x"}, "map<string,string>", {
            "type": "RECORD", "mode": "REPEATED",
            "fields": [{"name": "key", "type": "STRING"}, {"name": "value", "type": "INT64"}],
        }),
        (Decimal("12345"), "decimal(9,0)", {"type": "NUMERIC", "precision": 4, "scale": 0}),
        (None, "string", {"type": "STRING", "mode": "REQUIRED"}),
        (["1", "x"], "array<string>", {"type": "INT64", "mode": "REPEATED"}),
        (
            ("x",),
            "struct<p:string>",
            {"type": "RECORD", "fields": [{"name": "p", "type": "INT64"}]},
        ),
    ],
)
def test_values_that_do_not_fit(spark, value, have, want, ansi):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        entry = {"name": "c"} | (want if isinstance(want, dict) else {"type": want})
        df = spark.createDataFrame([(value,)], f"c {have}")
        with pytest.raises(PySparkException, match="c(\\[\\])?(\\.(p|value))?: "):
            conform(df, load_schema(json.dumps([entry]))).collect()
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_values_that_fit(spark, ansi):
    pairs = [
        (Decimal("1.100000000000"), "decimal(20,12)", "NUMERIC", Decimal("1.1")),
        (Decimal("0.1"), "decimal(3,1)", "FLOAT64", 0.1),
        (0.1, "double", "NUMERIC", Decimal("0.1")),
        (0.1, "float", "FLOAT64", pytest.approx(0.1)),
        (2**53, "bigint", "FLOAT64", 2.0**53),
        (7, "bigint", "NUMERIC", Decimal(7)),
        (1, "int", "BOOL", True),
        ("007", "string", "INT64", 7),
        (" +1.50 ", "string", "NUMERIC", Decimal("1.5")),
        ("-.5", "string", "NUMERIC", Decimal("-0.5")),
        ("0.0", "string", "NUMERIC", Decimal(0)),
        ("1e3", "string", "NUMERIC", Decimal(1000)),
        ("0.1", "string", "FLOAT64", 0.1),
        ("9007199254740992", "string", "FLOAT64", 2.0**53),
        ("1.5e300", "string", "FLOAT64", 1.5e300),
        ("2024-01-02 00:00:00", "string", "DATE", datetime.date(2024, 1, 2)),
        ("2024-01-02 03:04:05.1234560", "string", "DATETIME",
         datetime.datetime(2024, 1, 2, 3, 4, 5, 123456)),
        (datetime.datetime(2024, 1, 2), "timestamp_ntz", "DATE", datetime.date(2024, 1, 2)),
        (datetime.date(2024, 1, 2), "date", "DATETIME", datetime.datetime(2024, 1, 2)),
        (datetime.date(2024, 1, 2), "date", "STRING", "2024-01-02"),
        (b"ok", "binary", "STRING", "ok"),
    ]
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        names = [f"c{i}" for i in range(len(pairs))]
        schema = ", ".join(f"{n} {p[1]}" for n, p in zip(names, pairs))
        df = spark.createDataFrame([tuple(p[0] for p in pairs), (None,) * len(pairs)], schema)
        found = conform(df, declared(**{n: p[2] for n, p in zip(names, pairs)})).collect()
        assert [tuple(r) for r in found if r.c0 is not None] == [tuple(p[3] for p in pairs)]
        assert all(v is None for v in found[1])
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


def test_maps_as_their_own_target_fields(spark):
    df = spark.createDataFrame([({"b": 2, "a": None},), (None,)], "m map<string,int>")
    found = conform(df, load_schema(json.dumps(target_fields(df.schema))))
    assert [r.m and sorted(map(tuple, r.m)) for r in found.collect()] == [
        [("a", None), ("b", 2)], None,
    ]


def test_conform_nested(spark):
    df = spark.createDataFrame(
        [((1, "5"), ["1", None]), (None, None)], "r struct<p:int,q:string>, a array<string>"
    )
    text = """[{"name": "a", "type": "INT64", "mode": "REPEATED"},
               {"name": "r", "type": "RECORD", "fields": [
                  {"name": "q", "type": "INT64"}, {"name": "new", "type": "STRING"},
                  {"name": "p", "type": "STRING"}]}]"""
    assert rows(conform(df, load_schema(text))) == [(None, None), ([1, None], (5, None, "1"))]


def test_columns_that_do_not_match(spark):
    df = spark.range(1)
    with pytest.raises(ValueError, match="not declared"):
        conform(df, declared(other="STRING"))
    with pytest.raises(ValueError, match="missing"):
        conform(df, declared(id="INT64", other="STRING!"))


def test_fixed_width(spark):
    df = spark.createDataFrame([(7, "x" * 60, None)], "`a.b` int, s string, n string")
    (line,) = [r.line for r in render_fixed_width(df).collect()]
    assert line == f"{'7':50}{'x' * 60}{'null':50}"
    assert render_fixed_width(df, 3).first().line == "7  " + "x" * 60 + "null"


def test_names(spark):
    df = spark.sql("SELECT 'Tags' AS n, DATE'2024-02-09' AS d")
    found = df.select(
        target_name("n").alias("a"),
        target_name("n", "pre_").alias("b"),
        target_name(F.col("n"), "pre_", "d").alias("c"),
        qualified_name("n", "data").alias("e"),
        qualified_name("n", "data", "proj").alias("f"),
    )
    assert tuple(found.first()) == (
        "Tags", "pre_Tags", "pre_Tags_20240209", "data.Tags", "proj:data.Tags",
    )


# Texts that say less, more or something else than the value they would be cast to.
PARTIAL = [
    ("12:30:45", "TIMESTAMP"), ("12:30:45", "DATETIME"), ("2024", "DATE"), ("2024-03", "DATE"), ("2024", "TIMESTAMP"),
    ("2024-03", "DATETIME"), ("T12:30", "TIMESTAMP"), ("1e400", "FLOAT64"), ("-1e400", "FLOAT64"), ("1e-400", "FLOAT64"),
    ("0.1d", "FLOAT64"), ("1F", "FLOAT64"), ("2.D ", "FLOAT64"), ("today", "DATE"), ("now", "TIMESTAMP"),
]
FULL = [
    ("2024-03-01", "DATE"), (" 2024-3-1 ", "DATE"), ("2024-03-01 12:30:45", "TIMESTAMP"), ("2024-03-01T12:30", "DATETIME"),
    ("Infinity", "FLOAT64"), ("-inf", "FLOAT64"), ("NaN", "FLOAT64"), ("0.1", "FLOAT64"), ("0e9", "FLOAT64"), ("1e300", "FLOAT64"),
]


@pytest.mark.parametrize("text,kind", PARTIAL)
def test_texts_that_do_not_say_the_whole_value_are_refused(spark, text, kind):
    df = spark.createDataFrame([(text,)], "v string")
    with pytest.raises(PySparkException, match="v: value does not fit"):
        conform(df, load_schema(json.dumps([{"name": "v", "type": kind}]))).collect()


def test_texts_that_say_the_whole_value_are_taken(spark):
    for text, kind in FULL:
        df = spark.createDataFrame([(text,)], "v string")
        (row,) = conform(df, load_schema(json.dumps([{"name": "v", "type": kind}]))).collect()
        assert row.v is not None


BAD_SCHEMA = """[{"name": "k", "type": "INT64", "mode": "REQUIRED"},
  {"name": "n", "type": "INT64"}, {"name": "day", "type": "DATE"},
  {"name": "r", "type": "RECORD", "fields": [{"name": "x", "type": "INT64", "mode": "REQUIRED"},
    {"name": "l", "type": "INT64", "mode": "REPEATED"}]}]"""
BAD_ROWS = [
    ("1", "2", "2024-01-01", (5, ["1", "2"])),
    ("x", "2.5", "2024", (5, ["1"])),
    (None, None, None, None),
    ("4", "4", "2024-02-30", (None, ["q", None, "3"])),
    ("5", None, None, (1, None)),
]
BAD_KIND = "k string, n string, day string, r struct<x:int,l:array<string>>"


def test_problems_are_told_row_by_row(spark):
    schema, df = load_schema(BAD_SCHEMA), spark.createDataFrame(BAD_ROWS, BAD_KIND)
    told = conform_or_tell(df, schema).collect()
    found = [[(p.column, p.reason.split()[0]) for p in r.problems] for r in told]
    assert [sorted(f) for f in found] == [
        [], [("day", "value"), ("k", "value"), ("n", "value")], [("k", "required")],
        [("day", "value"), ("r.l[]", "value"), ("r.x", "required")], [],
    ]
    # The rows without problems are those that conform gives.
    good = [told[i].row for i in (0, 4)]
    assert good == conform(df.filter("k IN ('1', '5')"), schema).collect()
    assert told[1].row.k is None and told[3].row.n == 4


def test_quarantine(spark, tmp_path):
    target, schema = FileTarget(str(tmp_path)), load_schema(BAD_SCHEMA)
    df = spark.createDataFrame(BAD_ROWS * 20, BAD_KIND).repartition(3)
    done = sink.write_conforming(df, target, "t", schema, "k")
    assert (done.rows, done.bad_rows) == (40, 60)
    kept = sink.read_snapshot(spark, target, "t")
    assert kept.columns == ["k", "n", "day", "r"] and {r.k for r in kept.collect()} == {1, 5}
    assert sink.high_water(spark, target, "t", "k") == 5
    ledger = sink.read_ledger(spark, target, "t")
    assert ledger.schema["source"].dataType == df.schema
    assert ledger.count() == 7 * 20
    assert {(r.source.k, r.column) for r in ledger.collect()} == {
        ("x", "k"), ("x", "n"), ("x", "day"), (None, "k"), ("4", "day"), ("4", "r.x"), ("4", "r.l[]"),
    }
    # All rows conform, or none does.
    for some, good in ((BAD_ROWS[:1], 1), (BAD_ROWS[1:2], 0), ([], 0)):
        done = sink.write_conforming(spark.createDataFrame(some, BAD_KIND), target, "t", schema)
        assert (done.rows, done.bad_rows) == (good, len(some) - good)
        assert sink.read_snapshot(spark, target, "t").count() == good
        assert sink.read_ledger(spark, target, "t").count() == (3 if len(some) > good else 0)


def test_a_failed_quarantine_publishes_nothing(spark, tmp_path):
    target, schema = FileTarget(str(tmp_path)), load_schema(BAD_SCHEMA)
    df = spark.createDataFrame(BAD_ROWS, BAD_KIND)
    sink.write_conforming(df, target, "t", schema)
    boom = df.withColumn("n", F.when(F.col("k") == "5", F.raise_error(F.lit("boom"))).otherwise(F.col("n")))
    with pytest.raises(Exception, match="boom"):
        sink.write_conforming(boom, target, "t", schema)
    assert sink.read_snapshot(spark, target, "t").count() == 2
    assert sink.read_ledger(spark, target, "t").count() == 7
    with pytest.raises(ValueError, match="conforms"):
        sink.write_conforming(df, target, "t", load_schema('[{"name": "conforms", "type": "BOOL"}]'))
    sink.write_snapshot(df, target, "t")
    with pytest.raises(FileNotFoundError, match="no ledger"):
        sink.read_ledger(spark, target, "t")


def test_required_columns_reach_the_connector(spark, write_tables):
    kinds = ["BOOL", "INT64", "FLOAT64", "NUMERIC", "STRING", "BYTES", "DATE", "DATETIME", "TIMESTAMP"]
    entries = [{"name": f"c{i}", "type": k, "mode": "REQUIRED", "description": k} for i, k in enumerate(kinds)]
    entries += [{"name": "r", "type": "RECORD", "mode": "REQUIRED", "fields": [{"name": "x", "type": "INT64"}]}]
    entries += [{"name": "n", "type": "INT64"}]
    schema = load_schema(json.dumps(entries))
    values = "true, 1, 0.5D, 2.5, 'x', X'00', DATE'2024-01-02', TIMESTAMP_NTZ'2024-01-02 03:04:05', TIMESTAMP'2024-01-02 03:04:05Z'"
    columns = [f"c{i}" for i in range(len(kinds))] + ["r", "n"]
    df = spark.sql(f"SELECT {values}, named_struct('x', 7), 3").toDF(*columns)
    fitted = required(conform(df, schema), schema)
    assert [f.nullable for f in fitted.schema.fields] == [False] * 10 + [True]
    assert [f.dataType for f in fitted.schema.fields] == [f.dataType for f in schema.fields]
    assert fitted.schema["c1"].metadata == {"description": "INT64"}
    assert fitted.collect() == conform(df, schema).collect()
    for name in columns[:-1]:
        lost = df.withColumn(name, F.lit(None).cast(df.schema[name].dataType))
        with pytest.raises(PySparkException, match=f"{name}: required value is NULL"):
            required(conform(lost, schema), schema).collect()

    embedded_db.execute(spark, "requireddb", 'CREATE TABLE APP."seen"("id" INT)')
    source = embedded_db.source("requireddb")
    target = ConnectorTarget(
        dataset="APP", format="jdbc", options={"url": source.url, "dbtable": "{table}", "driver": source.driver}
    )
    path = write_tables(T=df.select("c1", "c4", "n"))
    declared = load_schema(json.dumps([entries[1], entries[4], entries[-1]]))
    report = copy_all(spark, FileSource(path), target, CopyOptions(), declared={"T": declared})
    assert [r.status for r in report.collect()] == ["ok"]
    made = {r["COLUMN_NAME"].lower(): r["IS_NULLABLE"] for r in source.open(spark)._metadata_column_rows() if r["TABLE_NAME"] == "T"}
    assert made == {"c1": "NO", "c4": "NO", "n": "YES"}
