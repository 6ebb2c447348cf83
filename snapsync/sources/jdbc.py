"""A relational database as a source, read through Spark's JDBC reader."""

from __future__ import annotations

import hashlib
import logging
import re
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapsync.functions.names import quoted
from snapsync.functions.predicates import hash_remainders
from snapsync.sources import base

# Fixed value: the driver class of MySQL's own connector.
MYSQL_DRIVER = "com.mysql.cj.jdbc.Driver"

# Where passwords are: in options, as a parameter of a URL, or before its host.
SECRET_NAME = re.compile(r"(?i)password|passwd|pwd|secret|token")
SECRET_IN_URL = re.compile(r"(?i)[?&;,(](?:password|passwd|pwd)=([^&;,)]+)")
SECRET_BEFORE_HOST = re.compile(r"//[^/:@]*:([^/@]+)@")

LONG_MIN, LONG_MAX = -(2**63), 2**63 - 1

# Codes of java.sql.Types, with the bytes of a value, and the names that the
# catalog has for the integral ones and for dates and timestamps.
FIXED_WIDTHS = {
    -7: 1, 16: 1, -6: 1, 5: 2, 4: 4, -5: 8, 7: 4, 6: 8, 8: 8, 2: 16, 3: 16, 91: 4, 92: 8,
    93: 8, 2013: 8, 2014: 8,
}
TYPE_NAMES = {5: "smallint", 4: "integer", -5: "bigint", 91: "date", 93: "timestamp"}
# Functions for the bytes of a value, where it is not OCTET_LENGTH.
OCTET_FUNCTIONS = {
    "jdbc:sqlserver:": "DATALENGTH({})",
    "jdbc:oracle:": "LENGTH({})",
    "jdbc:derby:": "LENGTH({})",
}

# A function that hashes columns to numbers from 0, and what joins them.
HASH_FUNCTIONS = {
    "jdbc:mysql:": ("CRC32(CONCAT_WS('|', {}))", ", "),
    "jdbc:mariadb:": ("CRC32(CONCAT_WS('|', {}))", ", "),
    "jdbc:postgresql:": ("ABS(CAST(HASHTEXT(CONCAT_WS('|', {})) AS BIGINT))", ", "),
    "jdbc:oracle:": ("ORA_HASH({})", " || '|' || "),
    "jdbc:sqlserver:": ("ABS(CAST(BINARY_CHECKSUM({}) AS BIGINT))", ", "),
}
# What databases know of their tables without reading them: name, rows (NULL or
# negative where unknown), bytes of the table, bytes of its indexes. ``{}`` is the schema.
STATISTICS = {
    "jdbc:postgresql:": (
        "SELECT c.relname AS name, CAST(c.reltuples AS BIGINT) AS n, pg_table_size(c.oid) AS b,"
        " pg_indexes_size(c.oid) AS i FROM pg_class c JOIN pg_namespace s ON s.oid = c.relnamespace"
        " WHERE c.relkind = 'r' AND s.nspname = {}"
    ),
    "jdbc:sqlserver:": (
        "SELECT t.name AS name, SUM(CASE WHEN p.index_id < 2 THEN p.row_count ELSE 0 END) AS n,"
        " SUM(CASE WHEN p.index_id < 2 THEN p.used_page_count ELSE 0 END) * 8192 AS b,"
        " SUM(CASE WHEN p.index_id < 2 THEN 0 ELSE p.used_page_count END) * 8192 AS i"
        " FROM sys.tables t JOIN sys.schemas s ON s.schema_id = t.schema_id"
        " JOIN sys.dm_db_partition_stats p ON p.object_id = t.object_id"
        " WHERE s.name = {} GROUP BY t.name"
    ),
    "jdbc:oracle:": (
        "SELECT table_name AS name, num_rows AS n, num_rows * avg_row_len AS b, 0 AS i"
        " FROM all_tables WHERE owner = {}"
    ),
    "jdbc:db2:": (
        "SELECT tabname AS name, card AS n, CASE WHEN card >= 0 THEN card * avgrowsize END AS b,"
        " 0 AS i FROM syscat.tables WHERE type = 'T' AND tabschema = {}"
    ),
    "jdbc:derby:": (
        "SELECT t.tablename AS name, CAST(NULL AS BIGINT) AS n,"
        " SUM(CASE WHEN p.isindex = 0 THEN p.numallocatedpages * p.pagesize ELSE 0 END) AS b,"
        " SUM(CASE WHEN p.isindex = 0 THEN 0 ELSE p.numallocatedpages * p.pagesize END) AS i"
        " FROM sys.systables t JOIN sys.sysschemas s ON s.schemaid = t.schemaid,"
        " TABLE (SYSCS_DIAG.SPACE_TABLE()) p"
        " WHERE p.tableid = t.tableid AND s.schemaname = {} GROUP BY t.tablename"
    ),
}
V2_CATALOG = "org.apache.spark.sql.execution.datasources.v2.jdbc.JDBCTableCatalog"

# Types, in lower case, that databases do not concatenate or compare.
LONG_TYPES = frozenset(
    "blob clob nclob long bfile xmltype xml tinyblob mediumblob longblob text ntext image"
    " tinytext mediumtext longtext json jsonb bytea geography geometry".split()
)

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class JdbcSource:
    """One schema of a database.

    ``catalog`` says where the catalog relations come from: SQL over
    ``information_schema``, or the driver's own metadata calls for databases
    without one. By default MySQL-like URLs use the former.
    """

    # Not shown: it may hold a password.
    url: str = field(repr=False)
    database: str
    user: str | None = None
    password: str | None = field(default=None, repr=False)
    driver: str | None = None
    fetchsize: int = 10_000
    options: Mapping[str, str] = field(default_factory=dict, repr=False)
    catalog: str | None = None

    def open(self, spark: SparkSession) -> "OpenedJdbc":
        return OpenedJdbc(spark, self)

    @property
    def is_mysql(self) -> bool:
        return self.url.startswith(("jdbc:mysql:", "jdbc:mariadb:"))

    def secrets(self) -> list[str]:
        """Texts that must not be logged, the longest first."""
        found = {self.password}
        found |= {v for k, v in self.options.items() if SECRET_NAME.search(k)}
        for url in (self.url, self.options.get("url", "")):
            found |= {m[1] for m in SECRET_IN_URL.finditer(url)}
            found |= {m[1] for m in SECRET_BEFORE_HOST.finditer(url)}
        return sorted((t for t in found if t), key=len, reverse=True)

    def masked(self, text: str) -> str:
        for secret in self.secrets():
            text = text.replace(secret, "***")
        return text

    @property
    def catalog_kind(self) -> str:
        return self.catalog or ("information_schema" if self.is_mysql else "metadata")

    def reader_options(self) -> dict[str, str]:
        """Connection options of every read; holds the password, never log it."""
        url = self.url
        if self.is_mysql and "useCursorFetch=" not in url:
            # Without a cursor the driver holds the whole result in memory,
            # whatever the fetch size.
            url += ("&" if "?" in url else "?") + "useCursorFetch=true"
        # Database timestamps without a zone stay without one; read as instants they
        # would shift with the zone of each JVM.
        chosen = {"url": url, "fetchsize": str(self.fetchsize), "preferTimestampNTZ": "true"}
        driver = self.driver or (MYSQL_DRIVER if self.url.startswith("jdbc:mysql:") else None)
        for key, value in (("user", self.user), ("password", self.password), ("driver", driver)):
            if value is not None:
                chosen[key] = value
        chosen.update(self.options)
        return chosen


def literal(number: int) -> str:
    """A long as SQL; the least one has no literal of its own."""
    return f"({LONG_MIN + 1} - 1)" if number == LONG_MIN else f"({number})"


def sql_string(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


class OpenedJdbc(base.Opened):
    @property
    def splits_any_key(self) -> bool:
        # Derby numbers rows, but in no order that can be asked for.
        return not self.source.url.startswith("jdbc:derby:")

    def __init__(self, spark: SparkSession, source: JdbcSource):
        self.spark = spark
        self.source = source
        self.database = source.database
        self._dialect = spark._jvm.org.apache.spark.sql.jdbc.JdbcDialects.get(source.url)

    def quote(self, name: str) -> str:
        return self._dialect.quoteIdentifier(name)

    def qualified(self, name: str) -> str:
        return f"{self.quote(self.database)}.{self.quote(name)}"

    def _reader(self):
        return self.spark.read.format("jdbc").options(**self.source.reader_options())

    def query(self, sql: str) -> DataFrame:
        return self._reader().option("query", sql).load()

    def _information_schema(
        self, relation: str, schema: T.StructType, where: str = ""
    ) -> DataFrame:
        names = ", ".join(schema.fieldNames())
        df = self.query(
            f"SELECT {names} FROM information_schema.{relation}"
            f" WHERE table_schema = {sql_string(self.database)}{where}"
        )
        # Databases differ in the case and the integer types they answer with.
        df = df.toDF(*schema.fieldNames())
        return df.select([F.col(f.name).cast(f.dataType) for f in schema.fields])

    # Catalog relations ---------------------------------------------------

    def tables(
        self, sizes: str = "stored", wanted: Callable[[str], bool] | None = None
    ) -> DataFrame:
        """Catalog figures; the row counts may be estimates. Views have no size.

        Without an information schema, ``stored`` are the database's own statistics, which cost
        no look at the data; ``counted`` has exact row counts with them. What has no statistics,
        and all tables with ``logical``, is counted and measured by a query for each table.
        """
        if self.source.catalog_kind == "metadata":
            wanted = wanted or (lambda name: True)
            known = {} if sizes == "logical" else self._statistics()
            if not known:
                return self._metadata_tables(wanted)
            return self._known_tables(known, wanted, sizes == "counted")
        return self._information_schema("tables", base.TABLES, " AND data_length IS NOT NULL")

    def columns(self) -> DataFrame:
        if self.source.catalog_kind == "metadata":
            return self._metadata_columns()
        return self._information_schema("columns", base.COLUMNS)

    def constraints(self) -> DataFrame:
        if self.source.catalog_kind == "metadata":
            return self._metadata_keys().select(base.CONSTRAINTS.fieldNames()).distinct()
        return self._information_schema("table_constraints", base.CONSTRAINTS)

    def key_usage(self) -> DataFrame:
        if self.source.catalog_kind == "metadata":
            return self._metadata_keys().select(base.KEY_USAGE.fieldNames())
        return self._information_schema("key_column_usage", base.KEY_USAGE)

    def _metadata(self, *calls) -> list[dict]:
        """Rows of driver metadata calls, by column name, over one connection."""
        jvm = self.spark._jvm
        options = self.source.reader_options()
        properties = jvm.java.util.Properties()
        for key in ("user", "password"):
            if key in options:
                properties.setProperty(key, options[key])
        if "driver" in options:
            jvm.org.apache.spark.sql.execution.datasources.jdbc.DriverRegistry.register(
                options["driver"]
            )
        connection = jvm.java.sql.DriverManager.getConnection(options["url"], properties)
        try:
            metadata, rows = connection.getMetaData(), []
            for call in calls:
                found = call(metadata)
                header = found.getMetaData()
                names = [header.getColumnName(i + 1) for i in range(header.getColumnCount())]
                while found.next():
                    rows.append({n.upper(): found.getString(n) for n in names})
                found.close()
            return rows
        finally:
            connection.close()

    def _pattern(self, metadata) -> str:
        """The database's name, where metadata calls take a LIKE pattern."""
        escape = metadata.getSearchStringEscape() or ""
        return re.sub(r"[_%]", lambda m: escape + m[0], self.database) if escape else self.database

    def _in_database(self, row: dict) -> bool:
        # Some drivers have databases as catalogs, and then no schema.
        return row.get("TABLE_SCHEM") in (None, "", self.database)

    def _metadata_names(self) -> list[str]:
        kinds = self.spark.sparkContext._gateway.new_array(self.spark._jvm.java.lang.String, 1)
        kinds[0] = "TABLE"
        rows = self._metadata(lambda m: m.getTables(None, self._pattern(m), "%", kinds))
        return sorted({r["TABLE_NAME"] for r in rows if self._in_database(r)})

    def _metadata_column_rows(self) -> list[dict]:
        tables = set(self._metadata_names())
        rows = self._metadata(lambda m: m.getColumns(None, self._pattern(m), "%", "%"))
        return [r for r in rows if r["TABLE_NAME"] in tables and self._in_database(r)]

    def _measured(self, name: str, long_columns: list[str], width: int) -> tuple:
        """Rows and bytes of a table, counted in the database; unknown if that fails.

        Columns without a fixed width are measured, not guessed from their type.
        """
        lengths = "".join(
            f" + COALESCE(SUM(CAST({self._octets(c)} AS BIGINT)), 0)" for c in long_columns
        )
        sql = f"SELECT COUNT(*) AS n, COUNT(*) * {width}{lengths} AS b FROM {self.qualified(name)}"
        try:
            found = self.query(sql).toDF("n", "b").first()
            return (self.database, name, int(found.n), int(found.b or 0), 0)
        except Exception as e:
            # Planned unsplit; the copy will fail alike, and report it.
            log.warning("no size of %s: %s", name, type(e).__name__)
            return (self.database, name, None, 0, 0)

    def _octets(self, column: str) -> str:
        quoted_column = self.quote(column)
        for start, function in OCTET_FUNCTIONS.items():
            if self.source.url.startswith(start):
                return function.format(quoted_column)
        return f"OCTET_LENGTH({quoted_column})"

    def _statistics(self) -> dict[str, tuple[int | None, int, int]]:
        """Rows (NULL: unknown), bytes and index bytes by table; empty if there are none."""
        for start, sql in STATISTICS.items():
            if self.source.url.startswith(start):
                try:
                    found = self.query(sql.format(sql_string(self.database))).toDF("name", "n", "b", "i")
                    return {
                        r.name: (None if r.n is None or r.n < 0 else int(r.n), int(r.b), int(r.i or 0))
                        for r in found.collect()
                        if r.b is not None
                    }
                except Exception as e:
                    log.warning("no statistics of %s: %s", self.database, type(e).__name__)
        return {}

    def _known_tables(
        self, known: Mapping[str, tuple], wanted: Callable[[str], bool], counted: bool
    ) -> DataFrame:
        names = self._metadata_names()

        def rows_of(name: str) -> int | None:
            if not wanted(name):
                return known[name][0]
            try:
                if counted:
                    return self.row_count(name)
                # Unknown is not empty; whether a table has a row is cheap to tell.
                n = known[name][0]
                return 0 if n is None and self.read(name).isEmpty() else n
            except Exception as e:
                log.warning("no look into %s: %s", name, type(e).__name__)
                return None

        there = [n for n in names if n in known]
        counts = base.at_once(rows_of, there)
        rows = [(self.database, name, n, *known[name][1:]) for name, n in zip(there, counts)]
        found = base.local_frame(self.spark, rows, base.TABLES)
        missing = set(names) - set(there)
        if not missing:
            return found
        return found.unionByName(self._metadata_tables(wanted, missing))

    def _metadata_tables(
        self, wanted: Callable[[str], bool], names: set[str] | None = None
    ) -> DataFrame:
        # The driver knows no sizes: the database counts, one query per table.
        fixed: dict[str, int] = {}
        longer: dict[str, list[str]] = {}
        for r in self._metadata_column_rows():
            name, code = r["TABLE_NAME"], int(r["DATA_TYPE"])
            if names is not None and name not in names:
                continue
            fixed.setdefault(name, 0)
            if code in FIXED_WIDTHS:
                fixed[name] += FIXED_WIDTHS[code]
            else:
                longer.setdefault(name, []).append(r["COLUMN_NAME"])

        def measure(name: str) -> tuple:
            if not wanted(name):
                return (self.database, name, None, 0, 0)
            return self._measured(name, longer.get(name, []), fixed[name])

        with ThreadPoolExecutor(max_workers=8) as pool:
            rows = list(pool.map(measure, sorted(fixed)))
        return base.local_frame(self.spark, rows, base.TABLES)

    def _metadata_columns(self) -> DataFrame:
        rows = [
            (
                self.database,
                r["TABLE_NAME"],
                r["COLUMN_NAME"],
                int(r["ORDINAL_POSITION"]),
                # The portable code where there is a name for it; vendors have their own.
                TYPE_NAMES.get(int(r["DATA_TYPE"]), r["TYPE_NAME"].lower()),
            )
            for r in self._metadata_column_rows()
        ]
        return base.local_frame(self.spark, rows, base.COLUMNS)

    @cached_property
    def _metadata_key_rows(self) -> list[tuple]:
        # Drivers list the keys of one table at a time.
        calls = [
            lambda m, name=name: m.getPrimaryKeys(None, self.database, name)
            for name in self._metadata_names()
        ]
        return [
            (
                r["PK_NAME"] or "PRIMARY",
                self.database,
                r["TABLE_NAME"],
                "PRIMARY KEY",
                r["COLUMN_NAME"],
                int(r["KEY_SEQ"]),
            )
            for r in self._metadata(*calls)
        ]

    def _metadata_keys(self) -> DataFrame:
        schema = T.StructType(base.CONSTRAINTS.fields + base.KEY_USAGE.fields[-2:])
        return base.local_frame(self.spark, self._metadata_key_rows, schema)

    # Scans ---------------------------------------------------------------

    @cached_property
    def _catalog(self) -> str:
        """The name of a catalog of Spark for this database, which pushes aggregates down."""
        options = self.source.reader_options()
        name = "snapsync_" + hashlib.sha256(repr(sorted(options.items())).encode()).hexdigest()[:16]
        setting = f"spark.sql.catalog.{name}"
        for key, value in options.items():
            self.spark.conf.set(f"{setting}.{key}", value)
        self.spark.conf.set(setting, V2_CATALOG)
        return name

    def table(self, name: str) -> DataFrame:
        """The table through Spark's catalog interface."""
        return self.spark.table(".".join(quoted(p) for p in (self._catalog, self.database, name)))

    def aggregated(self, name: str, *columns: Column) -> DataFrame | None:
        """Aggregates of the whole table, by the database.

        None if Spark would have to fetch the rows for it, as with databases that it does
        not know the functions of.
        """
        df = self.table(name).agg(*columns)
        plan = df._jdf.queryExecution().sparkPlan().toString()
        return df if "PushedAggregates: [" in plan and "Aggregate(" not in plan else None

    def row_count(self, name: str) -> int:
        df = self.aggregated(name, F.count("*").alias("n"))
        if df is None:
            df = self.query(f"SELECT COUNT(*) AS n FROM {self.qualified(name)}").toDF("n")
        return int(df.first().n)

    def read(self, name: str) -> DataFrame:
        return self._reader().option("dbtable", self.qualified(name)).load()

    def read_range(
        self, name: str, key: str, low: int, high: int, n_splits: int, above: int | None = None
    ) -> DataFrame:
        """The table as ``n_splits`` key ranges; ``above`` drops keys up to it."""
        # The bounds only set the stride: the first range is open below and takes
        # NULL keys, the last is open above.
        df = (
            self._reader()
            .option("dbtable", self.qualified(name))
            .option("partitionColumn", key)
            .option("lowerBound", str(low))
            .option("upperBound", str(min(high + 1, LONG_MAX)))
            .option("numPartitions", str(n_splits))
            .load()
        )
        return df if above is None else df.filter(F.col(quoted(key)) > F.lit(above))

    def read_where(self, name: str, predicates: list[str]) -> DataFrame:
        """The rows of each SQL predicate, one split per predicate."""
        options = self.source.reader_options()
        url = options.pop("url")
        return self.spark.read.jdbc(
            url, self.qualified(name), predicates=predicates, properties=options
        )

    def key_stats(self, name: str, key: str, where: str | None = None) -> DataFrame:
        # Written as SQL because the reader would fetch every key to aggregate.
        column = self.quote(key)
        rows = f" WHERE {where}" if where else ""
        df = self.query(
            f"SELECT MIN({column}) AS min_key, MAX({column}) AS max_key"
            f" FROM {self.qualified(name)}{rows}"
        ).toDF("min_key", "max_key")
        # Keys beyond the long range cannot be split columns.
        fits = F.col("max_key").cast("decimal(38,0)") <= F.lit(LONG_MAX)
        return df.select(
            [F.when(fits, F.col(c)).cast("long").alias(c) for c in ("min_key", "max_key")]
        )

    def key_cells(
        self, name: str, key: str, low: int, high: int, n: int, where: str | None = None
    ) -> list[base.Cell]:
        """Counted by the database along its index, in up to eight queries at a time."""
        width = -(-(high - low + 1) // n)
        each = -(-n // 8) * width
        starts = range(low, high + 1, each)
        parts = base.at_once(
            lambda a: self._counted(name, key, a, min(a + each - 1, high), width, where), starts
        )
        return [cell for part in parts for cell in part]

    def _counted(
        self, name: str, key: str, low: int, high: int, width: int, where: str | None
    ) -> list[base.Cell]:
        column = self.quote(key)
        rows = f"{column} >= {literal(low)} AND {column} <= {literal(high)}"
        rows += f" AND {where}" if where else ""
        offset = f"({column} - {literal(low)})"
        # SQL Server divides integers and has no MOD; others may divide to a fraction.
        whole = offset if self.is_sql_server else f"({offset} - MOD({offset}, {width}))"
        df = self.query(
            "SELECT cell, MIN(k) AS low_key, MAX(k) AS high_key, COUNT(*) AS n_rows FROM"
            f" (SELECT {column} AS k, {whole} / {width} AS cell"
            f" FROM {self.qualified(name)} WHERE {rows}) cells GROUP BY cell"
        ).toDF("cell", "low", "high", "n")
        return [base.Cell(int(r.low), int(r.high), int(r.n)) for r in df.collect()]

    @property
    def is_sql_server(self) -> bool:
        return self.source.url.startswith("jdbc:sqlserver:")

    def hash_predicates(self, columns: Sequence[str], n: int) -> list[str] | None:
        names = [self.quote(c) for c in columns]
        for start, (function, glue) in HASH_FUNCTIONS.items():
            if self.source.url.startswith(start):
                hashed = function.format(glue.join(names))
                modulo = "({} % {})" if self.is_sql_server else "MOD({}, {})"
                return hash_remainders(hashed, n, modulo)
        return None

    def hashable_columns(self, name: str) -> list[str]:
        """Columns that can go into a hash, or all where the catalog has none that can."""
        # The functions of the others take any type.
        if not self.source.url.startswith(("jdbc:oracle:", "jdbc:sqlserver:")):
            return self.read(name).columns
        kinds = self.columns().filter(F.col("table_name") == name).select("column_name", "data_type")
        long = {r.column_name.lower() for r in kinds.collect() if str(r.data_type).lower() in LONG_TYPES}
        names = self.read(name).columns
        return [c for c in names if c.lower() not in long] or names

    def key_bounds(self, name: str, key: str, n: int) -> list[str]:
        """Literals of the keys that cut a table of any ordered key into ``n`` even ranges.

        The database numbers the keys in the order of its index and sends every n-th.
        """
        column, table = self.quote(key), self.qualified(name)
        # Before anything is counted: a key that has no literals has no bounds.
        kind = self.read(name).schema[key].dataType
        if not isinstance(kind, self._literal_kinds()):
            return []
        total = self.query(f"SELECT COUNT({column}) AS n FROM {table}").toDF("n").first().n
        step = max(1, -(-int(total) // n))
        nth = f"(place - 1) % {step} = 0" if self.is_sql_server else f"MOD(place - 1, {step}) = 0"
        df = self.query(
            "SELECT place, k FROM"
            f" (SELECT {column} AS k, ROW_NUMBER() OVER (ORDER BY {column}) AS place"
            f" FROM {table} WHERE {column} IS NOT NULL) ordered WHERE place > 1 AND {nth}"
        ).toDF("place", "k")
        # In the order of the database, which may not be that of the texts.
        shown = F.hex("k") if isinstance(kind, T.BinaryType) else F.col("k").cast("string")
        rows = df.select("place", shown.alias("k")).collect()
        found = [r.k for r in sorted(rows, key=lambda r: int(r.place))]
        if isinstance(kind, T.StringType):
            escaped = [k.replace("\\", "\\\\") if self.source.is_mysql else k for k in found]
            return [sql_string(k) for k in escaped]
        if isinstance(kind, T.DateType):
            return [f"DATE {sql_string(k)}" for k in found]
        if isinstance(kind, (T.TimestampNTZType, T.TimestampType)):
            return [f"TIMESTAMP {sql_string(k)}" for k in found]
        if isinstance(kind, T.BinaryType):
            return [f"X'{k}'" for k in found]
        return found

    def _literal_kinds(self) -> tuple:
        """Types of which a value can stand in a predicate. Floating ones are not exact."""
        known = (
            T.StringType, T.DateType, T.TimestampNTZType, T.TimestampType, T.DecimalType, T.IntegralType,
        )
        return (*known, T.BinaryType) if self.source.is_mysql else known

    def append_stats(self, name: str, key: str) -> DataFrame:
        # A primary key has no NULLs, and its greatest value is at the end of the index.
        stats = self.aggregated(name, F.max(quoted(key)).alias("max_key"))
        if stats is None:
            stats = self.query(
                f"SELECT MAX({self.quote(key)}) AS max_key FROM {self.qualified(name)}"
            ).toDF("max_key")
        return stats.select(
            F.col("max_key").cast("decimal(38,0)").alias("max_key"),
            F.lit(0).cast("long").alias("null_keys"),
        )

    def probe_empty_estimates(self) -> bool:
        # Statistics may be as old.
        return self.source.catalog_kind == "information_schema" or any(
            map(self.source.url.startswith, STATISTICS)
        )
