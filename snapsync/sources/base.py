"""What every source offers: four catalog relations and a table scan."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


TABLES = T.StructType(
    [
        T.StructField("table_schema", T.StringType()),
        T.StructField("table_name", T.StringType()),
        T.StructField("table_rows", T.LongType()),
        T.StructField("data_length", T.LongType()),
        T.StructField("index_length", T.LongType()),
    ]
)
COLUMNS = T.StructType(
    [
        T.StructField("table_schema", T.StringType()),
        T.StructField("table_name", T.StringType()),
        T.StructField("column_name", T.StringType()),
        T.StructField("ordinal_position", T.IntegerType()),
        T.StructField("data_type", T.StringType()),
    ]
)
CONSTRAINTS = T.StructType(
    [
        T.StructField("constraint_name", T.StringType()),
        T.StructField("table_schema", T.StringType()),
        T.StructField("table_name", T.StringType()),
        T.StructField("constraint_type", T.StringType()),
    ]
)
KEY_USAGE = T.StructType(
    [
        T.StructField("constraint_name", T.StringType()),
        T.StructField("table_schema", T.StringType()),
        T.StructField("table_name", T.StringType()),
        T.StructField("column_name", T.StringType()),
        T.StructField("ordinal_position", T.IntegerType()),
    ]
)

# Names under which catalogs report integral column types. Not
# tinyint: MySQL's tinyint(1) is read as a boolean, which cannot be a split column.
INTEGRAL_TYPES = (
    "smallint",
    "mediumint",
    "int",
    "integer",
    "bigint",
)


ARROW_TYPES = {
    T.StringType: pa.string(),
    T.LongType: pa.int64(),
    T.IntegerType: pa.int32(),
    T.BooleanType: pa.bool_(),
    T.ArrayType: pa.list_(pa.string()),
}


def local_frame(spark: SparkSession, rows: Iterable[tuple], schema: T.StructType) -> DataFrame:
    """A few rows that the driver holds, such as a catalog, as a DataFrame.

    It goes through Arrow because Spark then knows how small it is, and joins it
    without a shuffle by its own choice.
    """
    arrow = pa.schema([(f.name, ARROW_TYPES[type(f.dataType)]) for f in schema.fields])
    names = schema.fieldNames()
    table = pa.Table.from_pylist([dict(zip(names, r)) for r in rows], schema=arrow)
    return spark.createDataFrame(table, schema)


def union_all(frames: Iterable[DataFrame], empty: DataFrame | None = None) -> DataFrame:
    """One DataFrame of all rows, as a shallow tree of unions; ``empty`` for no frames."""
    level = list(frames)
    if not level:
        if empty is None:
            raise ValueError("a union of no frames")
        return empty
    while len(level) > 1:
        level = [
            reduce(DataFrame.unionByName, level[i : i + 8]) for i in range(0, len(level), 8)
        ]
    return level[0]


@dataclass(frozen=True)
class Cell:
    """Keys from ``low`` to ``high``, both of which occur, and their rows."""

    low: int
    high: int
    n_rows: int


def at_once(call: Callable, items: Iterable) -> list:
    """``call`` of each item, eight at a time: the driver's calls mostly wait."""
    with ThreadPoolExecutor(max_workers=8) as pool:
        return list(pool.map(call, items))


class Opened:
    """A source bound to a session."""

    spark: SparkSession
    database: str
    # Whether tables without an integral key can be read in several queries.
    splits_any_key = False

    def tables(
        self, sizes: str = "stored", wanted: Callable[[str], bool] | None = None
    ) -> DataFrame:
        """The tables; those that are not ``wanted`` need not be measured."""
        raise NotImplementedError

    def columns(self) -> DataFrame:
        raise NotImplementedError

    def constraints(self) -> DataFrame:
        raise NotImplementedError

    def key_usage(self) -> DataFrame:
        raise NotImplementedError

    def read(self, name: str) -> DataFrame:
        """The whole table, in one unsplit scan where the source is a database."""
        raise NotImplementedError

    def quote(self, name: str) -> str:
        """A name as the source's predicates have it."""
        raise NotImplementedError

    def key_stats(self, name: str, key: str, where: str | None = None) -> DataFrame:
        """One row ``(min_key, max_key)`` of longs, NULL for an empty table."""
        raise NotImplementedError

    def key_cells(
        self, name: str, key: str, low: int, high: int, n: int, where: str | None = None
    ) -> list[Cell]:
        """The filled ones of ``n`` equally wide ranges of the keys ``low..high``."""
        raise NotImplementedError

    def hash_predicates(self, columns: Sequence[str], n: int) -> list[str] | None:
        """``n`` predicates by a hash of columns; None if the source has no function."""
        return None

    def hashable_columns(self, name: str) -> list[str]:
        """The columns that can go into a hash."""
        return self.read(name).columns

    def append_stats(self, name: str, key: str) -> DataFrame:
        """One row ``(max_key, null_keys)``: what an increment has to know beforehand."""
        raise NotImplementedError

    def probe_empty_estimates(self) -> bool:
        """Whether a row count of zero is an estimate that needs a look."""
        return False
