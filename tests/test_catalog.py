import embedded_db
import pytest
from conftest import rows
from pyspark.sql import functions as F

from snapsync import FileTarget, copy_all, read_snapshot
from snapsync.options import CopyOptions
from snapsync.plans.plan import immutability, plan_tables
from snapsync.plans.select import check_empty_estimates, select_tables, selected
from snapsync.sources import base, catalog
from snapsync.sources.files import FileSource
from snapsync.sources.jdbc import JdbcSource


def tables_frame(spark, *found):
    return base.local_frame(spark, [("db", *t) for t in found], base.TABLES)


def test_key_of_a_table(spark):
    embedded_db.execute(
        spark,
        "keys",
        'CREATE TABLE APP."mytable1"("keycolumn" INT NOT NULL GENERATED ALWAYS AS IDENTITY'
        ' PRIMARY KEY)',
        'CREATE TABLE APP."mytable2"("mycolumn" INT NOT NULL)',
        'CREATE TABLE APP."mytable3"("a" INT NOT NULL, "b" INT NOT NULL, PRIMARY KEY ("b", "a"))',
        'CREATE TABLE APP."mytable4"("u" INT NOT NULL UNIQUE)',
        'CREATE VIEW APP."myview" AS SELECT "a" FROM APP."mytable3"',
    )
    opened = embedded_db.source("keys").open(spark)
    assert rows(catalog.keys(opened)) == [
        ("mytable1", ["keycolumn"]),
        ("mytable3", ["b", "a"]),
    ]
    assert rows(catalog.tables(opened).select("table_name", "table_rows")) == [
        ("mytable1", 0),
        ("mytable2", 0),
        ("mytable3", 0),
        ("mytable4", 0),
    ]
    assert ("mytable3", "b", 2, "integer") in rows(catalog.columns(opened))


@pytest.fixture(scope="module")
def information_schema(spark):
    """A database with the catalog relations that MySQL has."""
    name = "infoschema"
    embedded_db.execute(
        spark,
        name,
        "CREATE SCHEMA information_schema",
        """CREATE TABLE information_schema.tables(table_schema VARCHAR(64),
           table_name VARCHAR(64), table_rows BIGINT, data_length BIGINT, index_length BIGINT)""",
        """CREATE TABLE information_schema.columns(table_schema VARCHAR(64),
           table_name VARCHAR(64), column_name VARCHAR(64), ordinal_position BIGINT,
           data_type VARCHAR(64))""",
        """CREATE TABLE information_schema.table_constraints(constraint_name VARCHAR(64),
           table_schema VARCHAR(64), table_name VARCHAR(64), constraint_type VARCHAR(64))""",
        """CREATE TABLE information_schema.key_column_usage(constraint_name VARCHAR(64),
           table_schema VARCHAR(64), table_name VARCHAR(64), column_name VARCHAR(64),
           ordinal_position BIGINT)""",
        'CREATE TABLE APP."big"("id" BIGINT NOT NULL PRIMARY KEY, "v" INT)',
        'INSERT INTO APP."big" VALUES (-5, 1), (3, 2), (100, NULL)',
        'CREATE TABLE APP."pair"("x" INT NOT NULL, "y" INT NOT NULL, PRIMARY KEY ("y", "x"))',
        'INSERT INTO APP."pair" VALUES (1, 7), (2, 7), (3, 8)',
        'CREATE TABLE APP."text_key"("code" VARCHAR(9) NOT NULL PRIMARY KEY)',
        """INSERT INTO APP."text_key" VALUES ('1'), ('2')""",
        'CREATE TABLE APP."stale"("id" INT)',
        'INSERT INTO APP."stale" VALUES 1',
        'CREATE TABLE APP."hollow"("id" INT)',
        'CREATE TABLE APP."no_rows_yet"("id" INT NOT NULL PRIMARY KEY, "updated_at" DATE)',
        """INSERT INTO information_schema.tables VALUES
           ('APP', 'big', 3, 900, 100), ('APP', 'pair', 3, 5000, NULL),
           ('APP', 'text_key', 2, 5000, 0), ('APP', 'stale', 0, 10, 0),
           ('APP', 'hollow', 0, 10, 0), ('APP', 'no_rows_yet', 7, 9000, 0),
           ('APP', 'some_view', NULL, NULL, NULL), ('OTHER', 'big', 9, 9, 9)""",
        """INSERT INTO information_schema.columns VALUES
           ('APP', 'big', 'id', 1, 'bigint'), ('APP', 'big', 'v', 2, 'int'),
           ('APP', 'pair', 'x', 1, 'int'), ('APP', 'pair', 'y', 2, 'int'),
           ('APP', 'text_key', 'code', 1, 'varchar'), ('APP', 'stale', 'id', 1, 'int'),
           ('APP', 'hollow', 'id', 1, 'int'), ('APP', 'no_rows_yet', 'id', 1, 'int'),
           ('APP', 'no_rows_yet', 'updated_at', 2, 'date'),
           ('OTHER', 'big', 'updated_at', 1, 'date')""",
        """INSERT INTO information_schema.table_constraints VALUES
           ('PRIMARY', 'APP', 'big', 'PRIMARY KEY'), ('PRIMARY', 'APP', 'pair', 'PRIMARY KEY'),
           ('uk', 'APP', 'stale', 'UNIQUE'), ('fk', 'APP', 'big', 'FOREIGN KEY'),
           ('PRIMARY', 'APP', 'text_key', 'PRIMARY KEY'),
           ('PRIMARY', 'APP', 'no_rows_yet', 'PRIMARY KEY'),
           ('PRIMARY', 'OTHER', 'big', 'PRIMARY KEY')""",
        """INSERT INTO information_schema.key_column_usage VALUES
           ('PRIMARY', 'APP', 'big', 'id', 1), ('fk', 'APP', 'big', 'v', 1),
           ('PRIMARY', 'APP', 'pair', 'x', 2), ('PRIMARY', 'APP', 'pair', 'y', 1),
           ('uk', 'APP', 'stale', 'id', 1), ('PRIMARY', 'APP', 'text_key', 'code', 1),
           ('PRIMARY', 'APP', 'no_rows_yet', 'id', 1),
           ('PRIMARY', 'OTHER', 'big', 'updated_at', 1)""",
    )
    return embedded_db.source(name, catalog="information_schema").open(spark)


def test_information_schema(information_schema):
    opened = information_schema
    assert rows(catalog.tables(opened)) == [
        ("big", 3, 900, 100, 1000),
        ("hollow", 0, 10, 0, 10),
        ("no_rows_yet", 7, 9000, 0, 9000),
        ("pair", 3, 5000, None, 5000),
        ("stale", 0, 10, 0, 10),
        ("text_key", 2, 5000, 0, 5000),
    ]
    assert rows(catalog.keys(opened)) == [
        ("big", ["id"]),
        ("no_rows_yet", ["id"]),
        ("pair", ["y", "x"]),
        ("text_key", ["code"]),
    ]
    assert ("big", "updated_at", 1, "date") not in rows(catalog.columns(opened))


def test_stale_zero_counts_are_checked(information_schema):
    tables = catalog.tables(information_schema)
    options = CopyOptions()
    checked = check_empty_estimates(information_schema, tables, options)
    chosen = select_tables(checked, options)
    reasons = dict(rows(chosen.select("table_name", "skip_reason")))
    assert reasons["hollow"] == "empty" and reasons["stale"] is None


def test_plan_of_a_database(information_schema):
    options = CopyOptions(min_split_bytes=999, bytes_per_split=300)
    plan = plan_tables(information_schema, options, prefix="p_")
    found = {r.table_name: r for r in plan.collect()}
    assert set(found) == {"big", "pair", "text_key", "stale", "no_rows_yet"}
    big = found["big"]
    assert (big.target_name, big.key_column, big.min_key, big.max_key) == ("p_big", "id", -5, 100)
    assert (big.size_bytes, big.bytes_to_sync, big.n_splits) == (1000, 1000, 4)
    assert big.immutable and big.append_key == "id"
    pair = found["pair"]
    assert (pair.primary_key, pair.key_column, pair.second_column) == (["y", "x"], "y", "x")
    # Two leading keys, but the second column allows all 17 splits.
    assert (pair.min_key, pair.max_key, pair.n_splits, pair.append_key) == (7, 8, 17, None)
    text_key = found["text_key"]
    assert (text_key.key_column, text_key.append_key, text_key.n_splits) == (None, None, 1)
    # A catalog that is ahead of the rows: no greatest key, so no split.
    late = found["no_rows_yet"]
    assert (late.key_column, late.max_key, late.n_splits, late.immutable) == (None, None, 1, False)


def test_copy_by_information_schema(spark, information_schema, tmp_path):
    target = FileTarget(str(tmp_path), prefix="i_")
    options = CopyOptions(min_split_bytes=999, bytes_per_split=300, max_parallel_writers=3)
    report = copy_all(spark, information_schema, target, options)
    found = {r.table_name: (r.status, r.rows, r.skip_reason) for r in report.collect()}
    assert found == {
        "big": ("ok", 3, None),
        "pair": ("ok", 3, None),
        "text_key": ("ok", 2, None),
        "stale": ("ok", 1, None),
        "hollow": ("skipped", None, "empty"),
        # The catalog counts rows that are not there.
        "no_rows_yet": ("ok", 0, None),
    }
    assert rows(read_snapshot(spark, target, "i_big")) == [(-5, 1), (3, 2), (100, None)]
    assert rows(read_snapshot(spark, target, "i_pair")) == [(1, 7), (2, 7), (3, 8)]
    assert read_snapshot(spark, target, "i_no_rows_yet").columns == ["id", "updated_at"]


def test_plan_without_splits(information_schema):
    options = CopyOptions(min_split_bytes=999, bytes_per_split=300, auto_split=False)
    assert {r.n_splits for r in plan_tables(information_schema, options).collect()} == {1}


def test_split_threshold_is_inclusive(information_schema):
    for threshold, split in ((999, True), (1000, False), (1001, False)):
        options = CopyOptions(min_split_bytes=threshold, bytes_per_split=300, whitelist=["big"])
        (row,) = plan_tables(information_schema, options).collect()
        assert (row.key_column == "id") is split
        # Small tables keep the key that increments need.
        assert row.append_key == "id"


@pytest.mark.parametrize(
    "split_by,big,pair",
    [("auto", "rows", "rows"), ("range", "range", "range"), ("rows", "rows", "rows")],
)
def test_split_rule(information_schema, split_by, big, pair):
    options = CopyOptions(min_split_bytes=999, bytes_per_split=300, split_by=split_by)
    found = {r.table_name: r for r in plan_tables(information_schema, options).collect()}
    # 106 possible keys for three rows; a key that repeats; no split.
    assert [found[t].split_by for t in ("big", "pair", "stale")] == [big, pair, None]


def test_split_rule_of_keys(spark, write_tables, monkeypatch):
    path = write_tables(t=spark.sql("SELECT id, CAST(id AS string) AS s FROM range(1000)"))
    options = CopyOptions(min_split_bytes=0, bytes_per_split=1000)

    def rule(*key, **changes):
        opened = FileSource(path, keys={"t": key} if key else {}).open(spark)
        monkeypatch.setattr(opened, "splits_any_key", True, raising=False)
        row = plan_tables(opened, options.with_(**changes), sizes="logical").first()
        return row.split_by, row.n_splits > 1

    assert rule("id") == ("rows", True)
    assert rule("id", split_by="range") == ("range", True)
    assert rule("s") == ("order", True) and rule("s", "id") == ("order", True)
    assert rule() == ("order", True)
    assert rule("s", auto_split=False) == (None, False)
    assert rule(min_split_bytes=10**9) == (None, False)


def test_only_listed_tables_are_looked_into(spark):
    class Estimates(base.Opened):
        database = "db"
        looked = []

        def probe_empty_estimates(self):
            return True

        def read(self, name):
            self.looked.append(name)
            if name == "denied":
                raise PermissionError(name)
            return self.spark.range(1 if name == "stale" else 0)

    opened = Estimates()
    opened.spark = spark
    names = ("stale", "hollow", "denied", "dropped")
    tables = catalog_rows(spark, *((n, 0, 10, 0) for n in names))
    options = CopyOptions(blacklist=["dropped"])
    found = select_tables(check_empty_estimates(opened, tables, options), options)
    assert dict(rows(found.select("table_name", "skip_reason"))) == {
        "stale": None, "hollow": "empty", "denied": None, "dropped": "blacklisted",
    }
    assert sorted(opened.looked) == ["denied", "hollow", "stale"]


def test_tables_that_cannot_be_counted(spark, monkeypatch):
    opened = JdbcSource("jdbc:postgresql://h/d", "public").open(spark)
    asked = []

    def query(sql):
        asked.append(sql)
        if "denied" in sql:
            raise PermissionError
        return spark.sql("SELECT 7 AS n, 700 AS b")

    columns = [("wide", "id", "-5"), ("wide", "doc", "2005"), ("denied", "id", "4"), ("off", "id", "4")]
    rows_found = [dict(zip(("TABLE_NAME", "COLUMN_NAME", "DATA_TYPE"), c)) for c in columns]
    monkeypatch.setattr(opened, "query", query)
    monkeypatch.setattr(opened, "_metadata_column_rows", lambda: rows_found)
    assert rows(opened._metadata_tables(lambda name: name != "off")) == [
        ("public", "denied", None, 0, 0), ("public", "off", None, 0, 0), ("public", "wide", 7, 700, 0),
    ]
    # A long text is measured, not taken for eight bytes.
    (sql,) = [s for s in asked if "wide" in s]
    assert "COUNT(*) * 8" in sql and 'SUM(CAST(OCTET_LENGTH("doc") AS BIGINT))' in sql


def test_integral_types_by_portable_code(spark, monkeypatch):
    opened = JdbcSource("jdbc:postgresql://h/d", "public").open(spark)
    found = [
        {"TABLE_NAME": "t", "COLUMN_NAME": c, "DATA_TYPE": code, "TYPE_NAME": name, "ORDINAL_POSITION": i}
        for i, (c, code, name) in enumerate(
            [("a", "-5", "int8"), ("b", "-5", "bigint identity"), ("c", "4", "serial"), ("d", "12", "TEXT")], 1
        )
    ]
    monkeypatch.setattr(opened, "_metadata_column_rows", lambda: found)
    assert [r.data_type for r in opened._metadata_columns().orderBy("ordinal_position").collect()] == [
        "bigint", "bigint", "integer", "text",
    ]


def test_database_names_are_no_patterns(spark):
    class Metadata:
        def getSearchStringEscape(self):
            return "\\"

    opened = JdbcSource("jdbc:postgresql://h/d", "a_b%c").open(spark)
    assert opened._pattern(Metadata()) == "a\\_b\\%c"
    assert opened._in_database({"TABLE_SCHEM": "a_b%c"}) and opened._in_database({"TABLE_SCHEM": None})
    assert not opened._in_database({"TABLE_SCHEM": "axb%c"})


def catalog_rows(spark, *found):
    return tables_frame(spark, *found).drop("table_schema")


def test_unreadable_keys_do_not_stop_the_plan(information_schema, monkeypatch):
    key_stats = information_schema.key_stats

    def denied(name, key, where=None):
        df = key_stats(name, key)
        return df if name == "pair" else df.withColumn("max_key", F.raise_error(F.lit("denied")))

    monkeypatch.setattr(information_schema, "key_stats", denied)
    options = CopyOptions(min_split_bytes=999, bytes_per_split=300)
    found = {r.table_name: r for r in plan_tables(information_schema, options).collect()}
    assert (found["pair"].n_splits, found["big"].n_splits, found["big"].key_column) == (17, 1, None)
    assert found["big"].append_key == "id"


def test_second_column_is_the_next_integral_one(spark, write_tables):
    path = write_tables(t=spark.sql("SELECT id a, 'x' s, id b, 1.5D d FROM range(9)"))
    options = CopyOptions(min_split_bytes=0, bytes_per_split=1)

    def second(*key):
        opened = FileSource(path, keys={"t": key}).open(spark)
        row = plan_tables(opened, options, sizes="logical").first()
        return row.key_column, row.second_column

    assert second("a", "s", "b") == ("a", "b")
    assert second("b", "a", "s") == ("b", "a")
    assert second("a", "s", "d") == ("a", None)
    assert second("a") == ("a", None)
    assert second("s", "a") == (None, None)


def test_max_splits(information_schema):
    options = CopyOptions(min_split_bytes=0, bytes_per_split=1, max_splits=6, whitelist=["big"])
    assert plan_tables(information_schema, options).first().n_splits == 6
    # There are only 106 keys.
    options = options.with_(max_splits=1000)
    assert plan_tables(information_schema, options).first().n_splits == 106


def test_bytes_to_sync_above_a_mark(spark, information_schema):
    options = CopyOptions(min_split_bytes=0, bytes_per_split=100, whitelist=["big"])
    marks = spark.createDataFrame([("big", 79)], "table_name string, high_water long")
    row = plan_tables(information_schema, options, high_water=marks).first()
    assert (row.bytes_to_sync, row.n_splits) == (200, 2)


def test_skip_reasons(spark):
    tables = tables_frame(
        spark,
        ("Users", 5, 10, 0),
        ("empty_listed", 0, 10, 0),
        ("both", 5, 10, 0),
        ("other", 5, 10, 0),
    )
    options = CopyOptions(whitelist=["users", "EMPTY_LISTED", "both"], blacklist=["Both", "other"])
    chosen = select_tables(tables, options)
    assert rows(chosen.select("table_name", "skip_reason")) == [
        ("Users", None),
        ("both", "blacklisted"),
        ("empty_listed", "empty"),
        ("other", "not_whitelisted"),
    ]
    assert [r.table_name for r in selected(chosen).collect()] == ["Users"]


def test_no_lists_select_all(spark):
    tables = tables_frame(spark, ("a", 1, 1, 0), ("b", None, 1, 0), ("c", 0, 1, 0))
    reasons = rows(select_tables(tables, CopyOptions()).select("table_name", "skip_reason"))
    assert reasons == [("a", None), ("b", None), ("c", "empty")]


def test_immutability(spark):
    columns = base.local_frame(
        spark,
        [
            ("db", "a", "id", 1, "int"),
            ("db", "a", "Updated_At", 2, "date"),
            ("db", "b", "updated_at_utc", 1, "date"),
        ],
        base.COLUMNS,
    )
    assert rows(immutability(columns)) == [("a", False), ("b", True)]
    assert rows(immutability(columns, "ID")) == [("a", False), ("b", True)]


def test_candidate_keys(spark, write_tables):
    path = write_tables(
        t=spark.createDataFrame(
            [
                (1, 1, "x" * 100, "a", None, 1.5),
                (2, 1, "x" * 99 + "y", "A", "q", 1.5),
                (9, 2, "", "b", "r", 2.0),
            ],
            "id long, dup int, wide string, name string, gap string, d double",
        ),
        hollow=spark.createDataFrame([], "id long"),
        nested=spark.createDataFrame([([1.0],), ([2.0],)], "v array<double>"),
    )
    opened = FileSource(path).open(spark)
    found = {(r.table_name, r.column_name): r.is_key for r in
             catalog.candidate_keys(opened.frames).collect()}
    assert found == {
        ("t", "id"): True,
        ("t", "dup"): False,
        ("t", "wide"): True,
        ("t", "name"): True,
        ("t", "gap"): False,
        ("t", "d"): False,
        ("hollow", "id"): False,
        ("nested", "v"): False,
    }
    constraints, usage = catalog.inferred_constraints(
        catalog.candidate_keys(opened.frames), catalog.columns(opened), opened.database
    )
    assert rows(catalog.primary_keys(constraints, usage, opened.database)) == [("t", ["id"])]
    assert constraints.filter("constraint_type = 'UNIQUE'").count() == 2


def test_texts_are_no_primary_keys(spark, write_tables):
    path = write_tables(t=spark.createDataFrame([("a", 1), ("b", 1)], "text string, n int"))
    opened = FileSource(path).open(spark)
    constraints, usage = catalog.inferred_constraints(
        catalog.candidate_keys(opened.frames), catalog.columns(opened), opened.database
    )
    assert rows(catalog.primary_keys(constraints, usage, opened.database)) == []


def test_keys_of_moments(spark):
    # Both sides of an autumn clock change, and years that Python does not have.
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
    try:
        frames = {
            "clock": spark.range(30).selectExpr(
                "timestamp_seconds(1698537600 + id * 600) AS at",
                "CAST(timestamp_seconds(1698537600 + id * 600) AS timestamp_ntz) AS local",
            ),
            "far": spark.sql("SELECT explode(array(1, 2)) AS i").selectExpr(
                "timestamp_seconds(400000000000 + i) AS at",
                "IF(i = 1, -0.0D, 0.0D) AS zero",
                "CAST('NaN' AS double) AS nan",
            ),
        }
        found = {(r.table_name, r.column_name): r.is_key for r in
                 catalog.candidate_keys(frames).collect()}
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert found == {
        ("clock", "at"): True, ("clock", "local"): False, ("far", "at"): True,
        ("far", "zero"): False, ("far", "nan"): False,
    }


def test_check_keys(spark, write_tables):
    path = write_tables(
        t=spark.createDataFrame([(1, 1), (1, 2), (2, 1), (2, None)], "a int, b int")
    )
    frames = FileSource(path).open(spark).frames
    assert rows(catalog.check_keys(frames, {"t": ["a", "b"]})) == [("t", 4, 3, False)]
    assert rows(catalog.check_keys(frames, {"t": ["a"]})) == [("t", 4, 2, False)]


def test_file_tables(spark, write_tables):
    path = write_tables(
        filled=spark.createDataFrame(
            [(1, "äb", [1, 2], {"k": "vw"}, None), (2, None, None, None, (3, "xyz"))],
            "id int, s string, a array<long>, m map<string,string>, r struct<i:int,t:string>",
        ),
        hollow=spark.createDataFrame([], "id int"),
    )
    opened = FileSource(path).open(spark)
    sizes = catalog.tables(opened, "logical").select("table_name", "table_rows", "size_bytes")
    # Two ids of 4; 3 bytes of text; two longs; a map of 1 + 2; a record of 4 + 3.
    assert rows(sizes) == [("filled", 2, 8 + 3 + 16 + 3 + 7), ("hollow", 0, 0)]
    stored = catalog.tables(opened).collect()
    assert all(r.size_bytes > 100 for r in stored)
    assert {r.table_name: r.table_rows for r in stored} == {"filled": None, "hollow": 0}
    counted = catalog.tables(opened, "counted")
    assert rows(counted.select("table_name", "table_rows")) == [("filled", 2), ("hollow", 0)]
    assert rows(counted.select("size_bytes")) == rows(catalog.tables(opened).select("size_bytes"))
    with pytest.raises(ValueError):
        catalog.tables(opened, "guessed")


def test_empty_directory(spark, tmp_path):
    opened = FileSource(str(tmp_path)).open(spark)
    assert catalog.tables(opened).count() == 0
    assert catalog.columns(opened).count() == 0
    assert plan_tables(opened, CopyOptions()).count() == 0


def test_minimal_keys(spark):
    df = spark.range(400).selectExpr(
        "id % 20 AS a", "id div 20 AS b", "CAST(id % 20 AS string) AS c", "IF(id = 7, NULL, id) AS holes",
        "id / 3.0D AS measured", "id % 2 AS few", "1 AS one", "array(id) AS list",
    )
    assert catalog.minimal_keys(df) == [("a", "b"), ("b", "c")]
    # The same with a row that repeats, and with one that has other values of either column.
    assert catalog.minimal_keys(df.unionAll(df.limit(1))) == []
    assert catalog.minimal_keys(df.selectExpr("a", "b", "a * 100 + b AS id")) == [("id",), ("a", "b")]
    assert catalog.minimal_keys(df.limit(0)) == [] and catalog.minimal_keys(spark.sql("SELECT 1.5D AS x")) == []
    three = spark.range(1000).selectExpr("id % 10 AS x", "id div 10 % 10 AS y", "id div 100 AS z", "id % 5 AS w")
    assert catalog.minimal_keys(three) == []
    assert catalog.minimal_keys(three, 3) == [("x", "y", "z")]


def test_set_values_do_not_run_together(spark):
    df = spark.createDataFrame([("a", "bc"), ("ab", "c"), ("", "abc")], "x string, y string")
    assert ("x", "y") in catalog._unique_sets(df, [("x", "y")])
    assert catalog._unique_sets(df.unionAll(df), [("x", "y")]) == []


def test_unique_sets_by_hashes(spark, monkeypatch):
    df = spark.range(2000).selectExpr("id DIV 40 AS x", "id % 40 AS y", "IF(id = 7, 6, id) AS z")
    sets = [("x", "y"), ("x", "z"), ("y", "z"), ("z",)]
    assert catalog._unique_sets(df, sets) == [("x", "y"), ("y", "z")]
    nulls = spark.createDataFrame([(1, None), (2, None), (3, 3)], "x bigint, y bigint")
    assert catalog._unique_sets(nulls, [("x", "y"), ("x",)]) == [("x",)]
    # Hashes that many values share change nothing.
    monkeypatch.setattr(catalog, "_set_hash", lambda columns: F.xxhash64(columns[-1]) % 64)
    assert catalog._unique_sets(df, sets) == [("x", "y"), ("y", "z")]


def test_set_hashes_travel_once_a_row(spark, monkeypatch):
    """A key costs a hash of 8 bytes a row, and what is none costs a part of that."""
    counted = []
    whole = catalog._repeated
    monkeypatch.setattr(catalog, "_repeated", lambda df, sets, one_in=1: counted.append((len(sets), one_in)) or whole(df, sets, one_in))
    df = spark.range(20_000).selectExpr("id AS a", "id DIV 2 AS b", "id DIV 4 AS c")
    assert catalog._unique_sets(df, [("a",), ("b",), ("c",)]) == [("a",)]
    assert counted == [(3, catalog.FEW), (1, 1)]


def test_composite_keys_of_tables(spark):
    frames = FileSource("/root/testdata/sf0.01").open(spark).frames
    frames = {t: frames[t] for t in ("conversations", "lineitem", "orders")}
    found = [(r.table_name, tuple(r.key)) for r in catalog.composite_keys(frames).collect()]
    assert found[0] == ("conversations", ("conv_id", "turn"))
    assert {t for t, _ in found} == {"conversations"}


@pytest.fixture(scope="module")
def sized(spark):
    """Tables of skewed widths, without rows, and with a name in two cases."""
    name = "sized"
    embedded_db.execute(
        spark,
        name,
        'CREATE TABLE APP."skewed"("id" BIGINT NOT NULL PRIMARY KEY, "note" CLOB)',
        'CREATE TABLE APP."hollow"("id" INT)',
        'CREATE TABLE APP."Hollow"("id" INT)',
        "CREATE SCHEMA OTHER",
        'CREATE TABLE OTHER."skewed"("id" INT)',
        'INSERT INTO APP."Hollow" VALUES 1',
    )
    # One row in twenty is 200 times as long as the others. One writer fills the pages.
    df = spark.range(0, 4000, 1, 1).select("id", F.repeat(F.lit("x"), F.when(F.expr("id % 20 = 3"), 4000).otherwise(20).cast("int")).alias("note"))
    df.write.format("jdbc").mode("append").options(
        url=f"jdbc:derby:memory:{name}", dbtable='APP."skewed"', driver=embedded_db.source(name).driver,
    ).save()
    return embedded_db.source(name).open(spark)


def test_sizes_without_a_look_at_the_data(sized, monkeypatch):
    measured = {r.table_name: r for r in catalog.tables(sized, "logical").collect()}
    asked, query = [], sized.query
    monkeypatch.setattr(sized, "query", lambda sql: asked.append(sql) or query(sql))
    monkeypatch.setattr(sized, "_measured", None)
    stored = {r.table_name: r for r in catalog.tables(sized).collect()}
    (sql,) = asked
    assert "note" not in sql and "skewed" not in sql
    assert {n: r.table_rows for n, r in stored.items()} == {"skewed": None, "hollow": 0, "Hollow": None}
    # Pages have the heads of rows (mostly of 28 bytes here) besides the values.
    true = measured["skewed"].data_length
    assert true <= stored["skewed"].data_length <= 1.25 * true and stored["skewed"].index_length > 0
    counted = {r.table_name: r.table_rows for r in catalog.tables(sized, "counted").collect()}
    assert counted == {"skewed": 4000, "hollow": 0, "Hollow": 1} and len(asked) == 2


def test_tables_without_statistics_are_measured(spark, sized, monkeypatch):
    known = sized._statistics()
    measured = {r.table_name: r.data_length for r in catalog.tables(sized, "logical").collect()}
    monkeypatch.setattr(sized, "_statistics", lambda: {n: v for n, v in known.items() if n != "skewed"})
    found = {r.table_name: (r.table_rows, r.data_length) for r in catalog.tables(sized).collect()}
    assert found["skewed"] == (4000, measured["skewed"]) and found["hollow"] == (0, known["hollow"][1])
    monkeypatch.undo()

    def denied(sql):
        raise PermissionError

    monkeypatch.setattr(sized, "query", denied)
    assert sized._statistics() == {}


def test_statistics_that_were_never_made(spark, monkeypatch):
    opened = JdbcSource("jdbc:postgresql://h/d", "public").open(spark)
    found = "values ('old', -1L, 8192L, 0L), ('new', 7L, 99L, 5L), ('none', NULL, NULL, NULL)"
    asked = []
    monkeypatch.setattr(opened, "query", lambda sql: asked.append(sql) or spark.sql(found))
    assert opened._statistics() == {"old": (None, 8192, 0), "new": (7, 99, 5)}
    assert "s.nspname = 'public'" in asked[0] and opened.probe_empty_estimates()
    # A database that is not known has none.
    other = JdbcSource("jdbc:h2:mem:x", "public").open(spark)
    assert other._statistics() == {} and not other.probe_empty_estimates()


def test_aggregates_by_the_catalog_interface(spark, sized):
    df = sized.aggregated("skewed", F.count("*").alias("n"), F.min("id").alias("a"), F.max("id").alias("z"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregates: [COUNT(*), MIN(id), MAX(id)]" in plan and "HashAggregate" not in plan
    low = sized.key_stats("skewed", "id").first()
    assert tuple(df.first()) == (4000, low.min_key, low.max_key) == (4000, 0, 3999)
    assert tuple(sized.append_stats("skewed", "id").first()) == (3999, 0)
    # What the database does not compute is not fetched for it.
    assert sized.aggregated("skewed", F.approx_count_distinct("id")) is None
    assert sized.row_count("Hollow") == 1 and sized.row_count("hollow") == 0
