import random
import time

import embedded_db
import pytest
from conftest import rows
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from snapsync.functions.predicates import hash_remainders, hot_bound_predicates
from snapsync.options import CopyOptions
from snapsync.plans.splits import (
    composite_predicates,
    composite_split_of,
    even_cells,
    key_range,
    range_predicates,
    range_starts,
    residue_predicates,
    split_bounds,
    split_by,
    split_histogram,
    split_of,
    split_predicates,
)
from snapsync.sources import jdbc
from snapsync.sources.base import Cell
from snapsync.sources.files import FileSource
from snapsync.sources.read import read_table

LONG_MIN, LONG_MAX = -(2**63), 2**63 - 1
EDGE_KEYS = [None, -50, -1, 0, 5, 9, 100]


def keys_frame(spark, keys):
    return spark.createDataFrame([(k,) for k in keys], "k long")


def ranges_of(low, high, n):
    """Half-open ranges by definition: (inclusive lower, exclusive upper)."""
    starts = [low + i * (high - low + 1) // n for i in range(n)]
    return [
        (None if i == 0 else starts[i], None if i == n - 1 else starts[i + 1]) for i in range(n)
    ]


def home(key, ranges):
    if key is None:
        return 0
    (found,) = [
        i
        for i, (a, b) in enumerate(ranges)
        if (a is None or key >= a) and (b is None or key < b)
    ]
    return found


def plan_frame(spark, *rows):
    return spark.createDataFrame(
        rows, "table_name string, min_key long, max_key long, n_splits int"
    )


@pytest.mark.parametrize(
    "low,high,n",
    [
        (0, 9, 3),
        (0, 0, 1),
        (-9, -1, 4),
        (0, 3, 4),
        (7, 1000, 13),
        (LONG_MIN, LONG_MAX, 7),
        (LONG_MAX - 5, LONG_MAX, 3),
        (LONG_MIN, LONG_MIN + 2, 2),
    ],
)
def test_bounds_and_split_numbers_agree(spark, low, high, n):
    expected = ranges_of(low, high, n)
    bounds = split_bounds(plan_frame(spark, ("t", low, high, n))).orderBy("split_id").collect()
    assert [(r.lower, r.upper) for r in bounds] == expected
    rng = random.Random(n)
    keys = [None, LONG_MIN, LONG_MAX, low, high, 0, *range_starts(low, high, n)]
    keys += [rng.randint(low, high) for _ in range(50)]
    keys += [k - 1 for k in keys if k is not None and k > LONG_MIN]
    df = keys_frame(spark, keys).select("k", split_of("k", low, high, n).alias("s"))
    assert {(r.k, r.s) for r in df.collect()} == {(k, home(k, expected)) for k in keys}


def test_no_bounds_without_a_range(spark):
    assert split_bounds(plan_frame(spark, ("t", None, None, 1))).count() == 0


def test_histogram(spark):
    df = keys_frame(spark, EDGE_KEYS)
    assert rows(split_histogram(df, "k", 0, 9, 3)) == [
        (0, 4, -50, 0),
        (1, 1, 5, 5),
        (2, 2, 9, 100),
    ]


def test_skew_shows(spark):
    df = spark.range(1000).select(
        F.when(F.col("id") < 900, 9000 + F.col("id")).otherwise(F.col("id") * 9 % 9000).alias("k")
    )
    n_rows = {r.split_id: r.n_rows for r in split_histogram(df, "k", 0, 9999, 10).collect()}
    assert n_rows[9] >= 900 and sum(n_rows.values()) == 1000


@settings(max_examples=25, deadline=None)
@given(
    st.lists(st.one_of(st.none(), st.integers(-60, 60)), max_size=40),
    st.lists(st.integers(-50, 50), max_size=9),
    st.integers(1, 5),
)
def test_predicates_cover_each_row_once(spark, keys, starts, n):
    pairs = [(k, keys[-i - 1]) for i, k in enumerate(keys)]
    df = spark.createDataFrame(pairs, "a long, b long").cache()
    for predicates in (
        range_predicates("a", starts),
        residue_predicates("b", n),
        composite_predicates("a", "b", sorted(starts), n),
    ):
        # A row is read where a predicate is true, not where it is NULL.
        hits = [F.when(F.expr(p), 1).otherwise(0) for p in predicates]
        assert df.filter(sum(hits[1:], hits[0]) != 1).count() == 0
    df.unpersist()


class Views(jdbc.OpenedJdbc):
    """A database whose SQL Spark answers, from temporary views."""

    def __init__(self, spark, url="jdbc:mysql://x/y"):
        super().__init__(spark, jdbc.JdbcSource(url, "db"))
        self.asked = []

    def quote(self, name):
        return f"`{name}`"

    def qualified(self, name):
        return f"`{name}`"

    def query(self, sql):
        self.asked.append(sql)
        return self.spark.sql(sql)

    def read(self, name):
        return self.spark.table(name)

    def read_where(self, name, predicates):
        self.predicates = predicates
        parts = [self.spark.table(name).filter(p).withColumn("q", F.lit(i))
                 for i, p in enumerate(predicates)]
        out = parts[0]
        for part in parts[1:]:
            out = out.unionByName(part)
        return out


def even(df, predicates, n):
    """Each row is read once, and no query reads above twice its share."""
    number, hits = split_by(predicates)
    found = df.select(number.alias("s"), hits.alias("hits")).groupBy("s").agg(
        F.count("*").alias("n"), F.min("hits").alias("low"), F.max("hits").alias("high")
    )
    counts = found.collect()
    assert {(r.low, r.high) for r in counts} == {(1, 1)}
    total = sum(r.n for r in counts)
    assert total == df.count()
    assert max(r.n for r in counts) <= 2 * -(-total // n) + 1
    return len(counts)


SHAPES = {
    "dense": "SELECT id AS a, 0 AS b FROM range(3000)",
    "sparse": "SELECT IF(id < 2900, id, id * 1000000000000) AS a, id AS b FROM range(3000)",
    "far_apart": "SELECT IF(id % 2 = 0, id, 9000000000000000000 - id) AS a, id AS b FROM range(3000)",
    "hot": "SELECT IF(id < 1200, 50, id % 100) AS a, id AS b FROM range(3000)",
    "hot_tens": "SELECT IF(id < 1200, 50, id % 100) AS a, id * 10 AS b FROM range(3000)",
    "one_key": "SELECT 7 AS a, id * 10 AS b FROM range(3000)",
    "negative": "SELECT -id AS a, id AS b FROM range(3000)",
    "nulls": "SELECT IF(id % 30 = 0, NULL, id) AS a, id AS b FROM range(3000)",
    "extremes": "SELECT explode(array(-9223372036854775808, 0, 9223372036854775807)) AS a, 1 AS b",
    "squares": "SELECT id * id AS a, id AS b FROM range(3000)",
}


@pytest.mark.parametrize("shape", SHAPES)
def test_splits_are_even(spark, write_tables, shape):
    df = spark.sql(SHAPES[shape]).selectExpr("CAST(a AS bigint) a", "CAST(b AS bigint) b")
    df.createOrReplaceTempView(f"even_{shape}")
    opened = FileSource(write_tables(t=df)).open(spark)
    n = 3 if shape == "extremes" else 10
    predicates = split_predicates(opened, "t", ["a", "b"], n)
    assert even(df, predicates, n) >= n // 2
    # A database is asked for the same cells in its own SQL.
    assert split_predicates(Views(spark), f"even_{shape}", ["a", "b"], n) == predicates


def test_hot_key_without_another_column(spark):
    df = spark.sql("SELECT CAST(IF(id < 1200, 50, id % 100) AS bigint) AS a FROM range(3000)")
    df.createOrReplaceTempView("hot_alone")
    found = split_predicates(Views(spark, "jdbc:postgresql://x/y"), "hot_alone", ["a"], 10)
    assert sum("HASHTEXT" in p for p in found) == 5
    # A database without a hash function reads it in one query.
    found = split_predicates(Views(spark, "jdbc:derby:memory:x"), "hot_alone", ["a"], 10)
    number, hits = split_by(found)
    assert df.select(hits.alias("h")).distinct().collect() == [(1,)]


def test_many_splits():
    # Keys of a hundred thousand splits, counted in cells of a histogram.
    def count(low, high, n):
        width = -(-(high - low + 1) // n)
        return [Cell(a, min(a + width - 1, high), min(width, high - a + 1))
                for a in range(low, high + 1, width)]

    packs = even_cells(count, 0, 9_999_999, 100_000)
    starts = [a for a, _ in packs] + [10_000_000]
    assert len(packs) == 100_000 and {b - a for a, b in zip(starts, starts[1:])} == {100}


@pytest.mark.parametrize(
    "keys",
    [
        "CONCAT('k', LPAD(CAST(id AS string), 6, '0'), '\\\\''x')",
        "CONCAT(CAST(id % 50 AS string), 'same')",
        "DATE'2024-01-01' + CAST(id % 700 AS int)",
        "CAST(id AS decimal(20,2)) / 4",
        "IF(id % 10 = 0, NULL, CAST(id AS string))",
    ],
)
def test_keys_that_are_not_integral(spark, keys):
    df = spark.sql(f"SELECT {keys} AS k, id FROM range(1000)")
    df.createOrReplaceTempView("other_keys")
    row = {"table_name": "other_keys", "primary_key": ["k"], "n_splits": 8, "split_by": "order"}
    opened = Views(spark)
    found = read_table(opened, row)
    counts = {r.q: r["count"] for r in found.groupBy("q").count().collect()}
    assert sum(counts.values()) == 1000 and len(counts) >= 6 and max(counts.values()) <= 300
    assert same_rows(found.drop("q"), df)


def test_tables_without_a_key(spark):
    df = spark.sql("SELECT id, CAST(id AS string) AS s FROM range(1000)")
    df.createOrReplaceTempView("no_key")
    row = {"table_name": "no_key", "primary_key": None, "n_splits": 1000, "split_by": "order"}
    opened = Views(spark)
    found = read_table(opened, row)
    assert len(opened.predicates) == 8 and "CRC32" in opened.predicates[0]
    assert opened.predicates[7].endswith("= 7)") and "`id`, `s`" in opened.predicates[7]
    # Spark's CRC32 takes bytes; the remainders are what matters here.
    assert found.columns == ["id", "s", "q"]
    assert read_table(Views(spark, "jdbc:derby:memory:x"), row).columns == ["id", "s"]


@pytest.mark.parametrize("modulo", ["MOD({}, {})", "({} % {})"])
def test_rows_without_a_hash_are_in_one_query(spark, modulo):
    df = spark.sql("SELECT id, IF(id % 3 = 0, NULL, CRC32(CAST(id AS string))) AS h FROM range(300)")
    number, hits = split_by(hash_remainders("h", 4, modulo))
    found = df.select("h", number.alias("q"), hits.alias("hits"))
    assert {r.hits for r in found.collect()} == {1}
    assert {r.q for r in found.filter("h IS NULL").collect()} == {0}
    assert found.select("q").distinct().count() == 4


def test_hot_bounds_are_cut_by_other_columns(spark):
    """A value between bounds that repeat is read in several queries, what follows it in one."""
    df = spark.sql("SELECT IF(id < 700, 'hot', CONCAT('k', id)) AS k, id FROM range(1000)")
    cuts = ["'hot'", "'hot'", "'hot'", "'k800'"]
    found = hot_bound_predicates("k", cuts, lambda n: hash_remainders("CRC32(CAST(id AS string))", n))
    assert len(found) == 6
    number, hits = split_by(found)
    counts = df.select(number.alias("q"), hits.alias("hits")).groupBy("q").agg(F.count("*").alias("n"), F.max("hits").alias("hits")).collect()
    assert sum(r.n for r in counts) == 1000 and {r.hits for r in counts} == {1}
    assert max(r.n for r in counts) < 320
    # Without another column the value is one query.
    assert len(hot_bound_predicates("k", cuts, lambda n: None)) == 3


def test_even_cells_are_linear():
    """Very many cells that are all too wide are cut without comparing each with each."""
    n = 40_000
    cells = [Cell(i * 1000, i * 1000 + 999, 10) for i in range(n)]

    def count(low, high, parts):
        return cells if low == 0 and high == n * 1000 else [Cell(low, low, 10)]

    begun = time.time()
    packs = even_cells(count, 0, n * 1000, 10 * n)
    assert [p for p, _ in packs] == [c.low for c in cells] and time.time() - begun < 10


def test_sql_server_has_hashes():
    opened = jdbc.OpenedJdbc.__new__(jdbc.OpenedJdbc)
    opened.source = jdbc.JdbcSource("jdbc:sqlserver://h", "db")
    opened.quote = lambda c: f"[{c}]"
    assert opened.hash_predicates(["a", "b"], 2) == [
        "((ABS(CAST(BINARY_CHECKSUM([a], [b]) AS BIGINT)) % 2) = 0 OR ABS(CAST(BINARY_CHECKSUM([a], [b]) AS BIGINT)) IS NULL)",
        "((ABS(CAST(BINARY_CHECKSUM([a], [b]) AS BIGINT)) % 2) = 1)",
    ]


def test_composite_split_numbers(spark):
    df = spark.createDataFrame(
        [(0, 0), (0, -1), (0, None), (5, 4), (9, 8), (None, 1)], "a long, b long"
    )
    found = df.select("a", "b", composite_split_of("a", "b", 0, 9, 2, 3).alias("s"))
    assert rows(found) == [
        (None, 1, 1), (0, None, 0), (0, -1, 2), (0, 0, 0), (5, 4, 4), (9, 8, 5),
    ]


def test_key_range(spark, write_tables):
    path = write_tables(
        negative=keys_frame(spark, [-9, -1, None]),
        hollow=keys_frame(spark, []),
    )
    opened = FileSource(path).open(spark)
    assert rows(key_range(opened, {"negative": "k", "hollow": "k"})) == [
        ("hollow", "k", None, None),
        ("negative", "k", -9, -1),
    ]
    assert key_range(opened, {}).count() == 0


# JDBC scans --------------------------------------------------------------


@pytest.fixture(scope="module")
def database(spark, sf_dir):
    keys = {
        "customer": ["c_custkey"],
        "orders": ["o_orderkey"],
        "conversations": ["conv_id", "turn"],
        "events": ["event_id"],
        "lineitem": [],
    }
    opened = embedded_db.load(spark, sf_dir, keys).open(spark)
    embedded_db.execute(
        spark,
        opened.source.url.removeprefix("jdbc:derby:memory:"),
        'CREATE TABLE APP."edge"("k" BIGINT)',
        'INSERT INTO APP."edge" VALUES NULL, -50, -1, 0, 5, 9, 100',
        'CREATE TABLE APP."hollow"("k" BIGINT)',
    )
    return opened


def same_rows(a, b):
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def partitions(df):
    return df.rdd.getNumPartitions()


@pytest.mark.parametrize("table", ["customer", "orders", "conversations", "events", "lineitem"])
def test_full_scan(spark, database, sf_dir, table):
    df = read_table(database, {"table_name": table})
    assert partitions(df) == 1
    assert same_rows(df, spark.read.parquet(f"{sf_dir}/{table}.parquet"))


def plan_row(database, table, key, n, second=None):
    span = key_range(database, {table: key}).first().asDict()
    return {**span, "n_splits": n, "second_column": second}


@pytest.mark.parametrize("split_by", ["range", "rows"])
@pytest.mark.parametrize("table,key", [("orders", "o_orderkey"), ("lineitem", "l_orderkey")])
def test_partitioned_scan(database, table, key, split_by):
    df = read_table(database, plan_row(database, table, key, 6), CopyOptions(split_by=split_by))
    assert partitions(df) == 6
    assert same_rows(df, database.read(table))


@pytest.mark.parametrize("split_by", ["range", "rows"])
def test_keys_outside_the_bounds_are_read(database, split_by):
    row = {"table_name": "edge", "key_column": "k", "min_key": 0, "max_key": 9, "n_splits": 3}
    df = read_table(database, row, CopyOptions(split_by=split_by))
    assert sorted(df.toPandas()["k"].fillna(-999)) == sorted([-999, -50, -1, 0, 5, 9, 100])


@pytest.mark.parametrize("keys", [range(-9, 0), [0], [-(2**63), 0, 2**63 - 1]])
@pytest.mark.parametrize("split_by", ["range", "rows"])
def test_ranges_of_odd_keys(spark, database, keys, split_by):
    name = f"odd_{split_by}_{len(keys)}"
    values = ", ".join(f"({k})" for k in keys)
    embedded_db.execute(
        spark,
        database.source.url.removeprefix("jdbc:derby:memory:"),
        f'CREATE TABLE APP."{name}"("k" BIGINT NOT NULL PRIMARY KEY)',
        f'INSERT INTO APP."{name}" VALUES {values}',
    )
    row = plan_row(database, name, "k", 4)
    df = read_table(database, row, CopyOptions(split_by=split_by))
    assert sorted(r.k for r in df.collect()) == list(keys)


def test_more_splits_than_keys(database):
    row = {"table_name": "edge", "key_column": "k", "min_key": 0, "max_key": 3, "n_splits": 10}
    df = read_table(database, row)
    assert partitions(df) <= 4 and df.count() == 7


def test_empty_table(database):
    assert key_range(database, {"hollow": "k"}).first().max_key is None
    df = read_table(database, {**plan_row(database, "hollow", "k", 4)})
    assert df.columns == ["k"] and df.count() == 0


@pytest.mark.parametrize("split_by", ["range", "rows"])
def test_composite_scan(database, split_by):
    row = plan_row(database, "conversations", "conv_id", 4, "turn")
    span = row["max_key"] - row["min_key"] + 1
    row["n_splits"] = 3 * span
    df = read_table(database, row, CopyOptions(split_by=split_by))
    assert partitions(df) > span
    assert same_rows(df, database.read("conversations"))


def test_incremental_scan(database):
    row = plan_row(database, "orders", "o_orderkey", 3) | {"append_key": "o_orderkey"}
    df = read_table(database, row, above=1000)
    assert "PushedFilters" in df._jdf.queryExecution().toString()
    assert partitions(df) == 3
    assert same_rows(df, database.read("orders").filter("o_orderkey > 1000"))
    assert read_table(database, row, above=row["max_key"]).count() == 0


HOT_VALUES = {
    "u": ("SELECT IF(id < 1200, 50, id % 100) AS a, 0L AS b, uuid() AS u FROM range(3000)", ["a"], ["a", "u"]),
    "ab": (
        "SELECT IF(id < 1500, 50, id % 100) AS a, IF(id < 1500, 7, id) AS b, CAST(id AS string) AS u FROM range(3000)",
        ["a", "b"], ["a", "b", "u"],
    ),
    "rest": ("SELECT IF(id < 1200, 50, id % 100) AS a, NULL AS b, CAST(id AS string) AS u FROM range(3000)", ["a"], ["a"]),
}


@pytest.mark.parametrize("shape", HOT_VALUES)
def test_hot_value_is_cut_by_what_tells_its_rows_apart(spark, write_tables, shape):
    sql, columns, key = HOT_VALUES[shape]
    path = write_tables(t=spark.sql(sql).selectExpr("CAST(a AS bigint) a", "CAST(b AS bigint) b", "u"))
    df = spark.read.parquet(f"{path}/t.parquet")
    df.createOrReplaceTempView(f"hot_{shape}")
    opened = Views(spark)
    row = {"table_name": f"hot_{shape}", "key_column": "a", "second_column": None, "n_splits": 10,
           "min_key": 0, "max_key": 99, "primary_key": key, "split_by": "rows"}
    assert read_table(opened, row).count() == 3000
    assert even(df, opened.predicates, 10) >= 5
    hashed = [p for p in opened.predicates if "CRC32" in p]
    assert len(hashed) > 2 and all(df.filter(p).count() > 0 for p in hashed)


def test_queries_of_a_table_without_key_follow_its_size(spark):
    df = spark.sql("SELECT CAST(id AS string) AS u, NULL AS v FROM range(3000)")
    df.createOrReplaceTempView("keyless")
    opened = Views(spark)
    row = {"table_name": "keyless", "n_splits": 400, "split_by": "order", "size_bytes": 80 << 30}
    assert read_table(opened, row).count() == 3000
    assert len(opened.predicates) == 20 and even(df, opened.predicates, 20) == 20
