"""A directory of Parquet tables as a source."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapsync.functions.names import quoted
from snapsync.functions.sizes import row_bytes
from snapsync.sources import base
from snapsync.storage import Storage

SUFFIX = ".parquet"


@dataclass(frozen=True)
class FileSource:
    """``<path>/<table>.parquet`` files or ``<path>/<table>/`` directories.

    Files declare no keys, so the primary keys of tables can be given in
    ``keys``. ``names`` limits the tables; ``paths`` adds tables kept elsewhere.
    """

    path: str
    database: str = "files"
    keys: Mapping[str, Sequence[str]] = field(default_factory=dict)
    names: Sequence[str] | None = None
    paths: Mapping[str, str] = field(default_factory=dict)

    def open(self, spark: SparkSession) -> "OpenedFiles":
        return OpenedFiles(spark, self)


class OpenedFiles(base.Opened):
    def __init__(self, spark: SparkSession, source: FileSource):
        self.spark = spark
        self.source = source
        self.database = source.database

    @cached_property
    def locations(self) -> dict[str, str]:
        storage = Storage(self.spark, self.source.path)
        found = {}
        for status in storage.children():
            name = status.getPath().getName()
            if name.endswith(SUFFIX) or status.isDirectory():
                found[name.removesuffix(SUFFIX)] = status.getPath().toString()
        found.update(self.source.paths)
        if self.source.names is not None:
            found = {n: found[n] for n in self.source.names}
        return dict(sorted(found.items()))

    @cached_property
    def _opened(self) -> dict[str, DataFrame | Exception]:
        # Opening a scan reads one footer, and fails for a damaged table.
        def open_one(location: str) -> DataFrame | Exception:
            try:
                return self.spark.read.parquet(location)
            except Exception as e:
                return e

        with ThreadPoolExecutor(max_workers=8) as pool:
            return dict(zip(self.locations, pool.map(open_one, self.locations.values())))

    @property
    def frames(self) -> dict[str, DataFrame]:
        """Each readable table as a scan."""
        return {n: df for n, df in self._opened.items() if isinstance(df, DataFrame)}

    def tables(
        self, sizes: str = "stored", wanted: Callable[[str], bool] | None = None
    ) -> DataFrame:
        """Tables with their sizes, measured in one of three ways.

        ``stored``: the size of the files. Whether a table is empty takes a look at
        its first row; other row counts stay NULL, for unknown. ``counted``: the same
        with exact row counts, from all footers. ``logical``: row counts and the sum
        of all value widths, which reads the variable-width columns.
        """
        if sizes not in ("stored", "counted", "logical"):
            raise ValueError("sizes must be 'stored', 'counted' or 'logical'")
        wanted = wanted or (lambda name: True)
        frames = {n: df for n, df in self.frames.items() if wanted(n)}
        locations = {n: at for n, at in self.locations.items() if wanted(n)}
        empty: set[str] = set()
        with ThreadPoolExecutor(max_workers=8) as pool:
            measured = pool.map(lambda at: Storage(self.spark, at).size(), locations.values())
            stored = dict.fromkeys(self.locations, 0) | dict(zip(locations, measured))
            if sizes == "stored":
                looked = pool.map(DataFrame.isEmpty, frames.values())
                empty = {n for n, is_empty in zip(frames, looked) if is_empty}
        # A table that cannot be opened has no known count; its copy will report why.
        listed = base.local_frame(
            self.spark,
            [(self.database, n, 0 if n in empty else None, b, 0) for n, b in stored.items()],
            base.TABLES,
        )
        if sizes == "stored" or not frames:
            return listed
        # All tables in one aggregate: each task sends on one short row.
        widths = [
            df.select(
                F.lit(name).alias("table_name"),
                (row_bytes(df.schema) if sizes == "logical" else F.lit(0).cast("long")).alias("b"),
            )
            for name, df in frames.items()
        ]
        counted = (
            base.union_all(widths)
            .groupBy("table_name")
            .agg(F.count(F.lit(1)).alias("n"), F.sum("b").alias("b"))
        )
        # A table without rows is in the list only.
        readable = F.col("table_name").isin(list(frames))
        n = F.when(readable, F.coalesce("n", F.lit(0)))
        data_length = F.col("data_length")
        if sizes == "logical":
            data_length = F.when(readable, F.coalesce("b", F.lit(0))).otherwise(data_length)
        return listed.join(counted, "table_name", "left").select(
            "table_schema",
            "table_name",
            n.cast("long").alias("table_rows"),
            data_length.cast("long").alias("data_length"),
            "index_length",
        )

    def columns(self) -> DataFrame:
        rows = [
            (self.database, name, f.name, position, f.dataType.simpleString())
            for name, df in self.frames.items()
            for position, f in enumerate(df.schema.fields, start=1)
        ]
        return base.local_frame(self.spark, rows, base.COLUMNS)

    def constraints(self) -> DataFrame:
        rows = [
            ("PRIMARY", self.database, name, "PRIMARY KEY")
            for name in self.source.keys
            if name in self.locations
        ]
        return base.local_frame(self.spark, rows, base.CONSTRAINTS)

    def key_usage(self) -> DataFrame:
        rows = [
            ("PRIMARY", self.database, name, column, position)
            for name, key in self.source.keys.items()
            if name in self.locations
            for position, column in enumerate(key, start=1)
        ]
        return base.local_frame(self.spark, rows, base.KEY_USAGE)

    def read(self, name: str) -> DataFrame:
        opened = self._opened[name]
        if isinstance(opened, Exception):
            raise opened
        return opened

    def quote(self, name: str) -> str:
        return quoted(name)

    def _rows(self, name: str, where: str | None) -> DataFrame:
        df = self.read(name)
        return df.filter(where) if where else df

    def key_stats(self, name: str, key: str, where: str | None = None) -> DataFrame:
        column = F.col(quoted(key)).cast("long")
        return self._rows(name, where).agg(
            F.min(column).alias("min_key"), F.max(column).alias("max_key")
        )

    def key_cells(
        self, name: str, key: str, low: int, high: int, n: int, where: str | None = None
    ) -> list[base.Cell]:
        k = F.col(quoted(key)).cast("long")
        width = -(-(high - low + 1) // n)
        offset = k.cast("decimal(20,0)") - F.lit(low).cast("decimal(20,0)")
        cells = (
            self._rows(name, where)
            .filter(k.between(low, high))
            .groupBy(F.floor(offset / F.lit(width).cast("decimal(20,0)")).alias("cell"))
            .agg(F.min(k).alias("low"), F.max(k).alias("high"), F.count(F.lit(1)).alias("n"))
        )
        return [base.Cell(r.low, r.high, r.n) for r in cells.collect()]

    def append_stats(self, name: str, key: str) -> DataFrame:
        column = F.col(quoted(key))
        return self.read(name).agg(
            F.max(column).cast("decimal(38,0)").alias("max_key"),
            F.count_if(column.isNull()).alias("null_keys"),
        )
