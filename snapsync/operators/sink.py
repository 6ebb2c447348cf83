"""Targets: snapshots that replace a table, and increments that add to one.

A ``FileTarget`` keeps each table as numbered versions::

    <path>/<table>/v0000000007-<run>/p000000-<run>/   snapshot
    <path>/<table>/v0000000007-<run>/p000001-<run>/   increment

A part holds Parquet files and, once they are all there, ``_manifest.json``. Parts
without a manifest are staged: no reader sees them. So one small file publishes a
whole write, a reader sees the old table or the new one, and a failed write changes
nothing. No directory is renamed for it, which matters on object stores, where that
means to copy it. The highest published version is current.

Increments pile up as parts. As soon as the newest ``tier`` of them are of one level, they
are merged into one of the next level, by a Spark job over these parts alone; parts that
were merged stay for one more merge, for readers that have begun. So a row is written again
only when the number of increments has grown by that factor. From ``max_parts`` on, the next
one is joined with them all into a new version. ``parts`` has what parts do to each other.

One job at a time may write a table.
"""

from __future__ import annotations

import base64
import json
import logging
import re
import time
import uuid
from collections.abc import Mapping
from dataclasses import dataclass
from itertools import groupby
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapsync.functions.checksums import DIGEST, digest
from snapsync.functions.names import quoted
from snapsync.operators import parts as together
from snapsync.operators.schema import PROBLEMS, conform_or_tell, target_fields
from snapsync.options import CatalogTarget, ConnectorTarget, FileTarget, Target
from snapsync.sources.base import at_once
from snapsync.storage import Storage

log = logging.getLogger(__name__)

MANIFEST = "_manifest.json"
VERSION = re.compile(r"v(\d{10})-[0-9a-f]+")
PART = re.compile(r"p(\d{6})-[0-9a-f]+")


class TargetStateError(RuntimeError):
    """The target table exists and must not, or is absent and must exist."""


@dataclass(frozen=True)
class Written:
    """``target_schema``: the target's columns, as JSON entries that can be declared."""

    target_name: str
    rows: int
    schema: str
    target_schema: str | None = None


def _written(name: str, rows: int, schema: T.StructType) -> Written:
    return Written(name, rows, schema.simpleString(), target_text(schema))


def target_text(schema: T.StructType) -> str | None:
    """The target schema as JSON; None for types that a target has no name for."""
    try:
        return json.dumps(target_fields(schema))
    except TypeError:
        return None


def new_run() -> str:
    return uuid.uuid4().hex[:16]


# Versioned files ---------------------------------------------------------


def _numbered(storage: Storage, pattern: re.Pattern, *parts: str) -> list[str]:
    return [n for n in storage.child_names(*parts) if pattern.fullmatch(n)]


def _next(names: list[str], pattern: re.Pattern) -> int:
    return int(pattern.fullmatch(names[-1])[1]) + 1 if names else 0


def _published_parts(storage: Storage, name: str, version: str) -> list[str]:
    parts = _numbered(storage, PART, name, version)
    published = at_once(lambda p: storage.exists(name, version, p, MANIFEST), parts)
    return [p for p, there in zip(parts, published) if there]


def _manifest(storage: Storage, *where: str) -> dict | None:
    text = storage.read_text(*where, MANIFEST)
    return None if text is None else json.loads(text)


def _all_parts(storage: Storage, name: str, version: str) -> list[tuple[str, dict]]:
    """The published parts of a version with their manifests, merged ones included."""
    names = _numbered(storage, PART, name, version)
    found = at_once(lambda p: _manifest(storage, name, version, p), names)
    return [(p, m) for p, m in zip(names, found) if m is not None]


def _state(storage: Storage, name: str) -> tuple[str, list[tuple[str, dict]]] | None:
    """The newest published version, and its parts with their manifests."""
    for version in reversed(_numbered(storage, VERSION, name)):
        parts = _all_parts(storage, name, version)
        if parts:
            return version, together.live(parts)
    return None


def _current(storage: Storage, name: str) -> tuple[str, list[str]] | None:
    """The newest published version and its parts."""
    state = _state(storage, name)
    return state and (state[0], [p for p, _ in state[1]])


def _manifests(storage: Storage, name: str) -> list[dict]:
    state = _state(storage, name)
    return [] if state is None else [m for _, m in state[1]]


def _whole(key) -> int | None:
    return None if key is None else int(key)


def _stored(spark: SparkSession, path: str, schema: T.StructType) -> dict[str, int]:
    """The digest of the files of a part: one pass, of which a row a task leaves it."""
    return spark.read.schema(schema).parquet(path).agg(*digest(schema)).first().asDict()


def _stored_rows(stored: Mapping[str, int]) -> int:
    return stored["n"]


def _compared(where: str, seen: Mapping[str, int], stored: Mapping[str, int]) -> None:
    n = _stored_rows(stored)
    if seen["n"] != n:
        raise OSError(f"{where}: {seen['n']} rows were written, but {n} are stored")
    if any(seen[c] != stored[c] for c in DIGEST):
        raise OSError(f"{where}: the stored rows are not those that were written")


def _mark(column: str, kind: T.DataType) -> Column:
    """The greatest value of a marker, as text that ``marker_value`` reads again."""
    latest = F.max(F.col(quoted(column)))
    return (F.unix_micros(latest) if isinstance(kind, T.TimestampType) else latest).cast("string")


def marker_value(text: str, kind: T.DataType) -> Column:
    value = F.lit(text)
    return F.timestamp_micros(value.cast("long")) if isinstance(kind, T.TimestampType) else value.cast(kind)


def _write_part(
    df: DataFrame,
    target: FileTarget,
    storage: Storage,
    where: tuple[str, str, str],
    key: str | None,
    marker: str | None = None,
    about: Mapping[str, Any] | None = None,
) -> int:
    """Write rows to a new part and publish it -> the number of rows."""
    counts = digest(df.schema) if target.verify else [F.count(F.lit(1)).alias("n")]
    if key is not None:
        k = F.col(quoted(key))
        counts += [F.min(k).alias("least"), F.max(k).alias("greatest")]
        # How the keys lie, in a few KB whatever the rows, for splits of later reads.
        counts.append(F.kll_sketch_agg_bigint(k.try_cast("long")).alias("sketch"))
    if marker is not None:
        counts.append(_mark(marker, df.schema[marker].dataType).alias("latest"))
    # All that is taken while the rows pass by; there is no second scan.
    observed = Observation()
    (
        df.observe(observed, *counts)
        .write.mode("errorifexists")
        .options(**target.write_options)
        .parquet(storage.path(*where).toString())
    )
    found = observed.get
    if target.verify:
        path = storage.path(*where).toString()
        _compared(path, found, _stored(df.sparkSession, path, df.schema))
    manifest = {
        "rows": found["n"],
        "schema": json.loads(df.schema.json()),
        "target_schema": json.loads(target_text(df.schema) or "null"),
        "key": key,
        "min_key": _whole(found.get("least")),
        "max_key": _whole(found.get("greatest")),
        "sketch": base64.b64encode(found["sketch"]).decode() if found.get("sketch") else None,
        "marker": marker,
        "max_marker": found.get("latest"),
        "digest": {c: found[c] for c in DIGEST} if target.verify else None,
        "level": 0,
    }
    storage.write_text(json.dumps(manifest | dict(about or {})), *where, MANIFEST)
    return found["n"]


def damaged_parts(spark: SparkSession, target: FileTarget, name: str) -> list[str]:
    """Parts of the current version whose files no longer hold the rows that were written.

    Their digests were noted by writes with ``verify``; parts without one are not checked.
    """
    storage = Storage(spark, target.path)
    version, parts = _state(storage, name) or (None, [])

    def damaged(part: tuple[str, dict]) -> bool:
        path, manifest = storage.path(name, version, part[0]).toString(), part[1]
        try:
            _compared(path, manifest["digest"], _stored(spark, path, T.StructType.fromJson(manifest["schema"])))
        except Exception as e:
            log.warning("%s: %s", path, e)
            return True
        return False

    noted = [p for p in parts if p[1].get("digest")]
    return [p for (p, _), bad in zip(noted, at_once(damaged, noted)) if bad]


def _write_version(
    spark: SparkSession,
    df: DataFrame,
    target: FileTarget,
    name: str,
    key: str | None,
    marker: str | None = None,
) -> int:
    storage, run = Storage(spark, target.path), new_run()
    versions = _numbered(storage, VERSION, name)
    version = f"v{_next(versions, VERSION):010d}-{run}"
    try:
        where = (name, version, f"p000000-{run}")
        rows = _write_part(df, target, storage, where, key, marker, {"mode": "snapshot"})
    except BaseException:
        # Only ever what this run made.
        storage.delete(name, version)
        raise
    older = [v for v in versions if _published_parts(storage, name, v)]
    for old in older[: len(older) + 1 - target.keep_versions]:
        storage.delete(name, old)
    return rows


def _add_part(
    spark: SparkSession,
    df: DataFrame,
    target: FileTarget,
    name: str,
    key: str | None,
    marker: str | None = None,
    about: Mapping[str, Any] | None = None,
) -> int:
    storage, run = Storage(spark, target.path), new_run()
    state = _state(storage, name)
    if state is None:
        raise FileNotFoundError(target.qualified(name))
    version, parts = state
    about = {"mode": "append"} | dict(about or {})
    if len(parts) >= target.max_parts and about["mode"] == "append":
        observed = Observation()
        new = df.observe(observed, F.count(F.lit(1)).alias("n"))
        present = _read_files(spark, target, name)
        _write_version(spark, present.unionByName(new), target, name, key, marker)
        return observed.get["n"]
    number = _next(_numbered(storage, PART, name, version), PART)
    where = (name, version, f"p{number:06d}-{run}")
    try:
        rows = _write_part(df, target, storage, where, key, marker, about)
    except BaseException:
        storage.delete(*where)
        raise
    if rows == 0 and not about.get("replaces"):
        storage.delete(*where)
        return rows
    while _merge_tier(spark, target, storage, name):
        pass
    if len(_state(storage, name)[1]) > target.max_parts:
        # Parts that replace rows: the version is written anew without what they replaced.
        _write_version(spark, _read_files(spark, target, name), target, name, key, marker)
    return rows


def _merge_tier(spark: SparkSession, target: FileTarget, storage: Storage, name: str) -> bool:
    """Merge the newest parts if they are enough of one level -> whether they were."""
    version, parts = _state(storage, name)
    chosen = together.tier(parts, target.tier)
    if not chosen:
        return False
    own = [(p, m) for p, m in parts if p in chosen]
    newest = own[-1][1]
    # What was merged before this has had its time.
    for old in {p for p, _ in _all_parts(storage, name, version)} - {p for p, _ in parts}:
        storage.delete(name, version, old)
    rows = together.rows_of(
        spark, _located(storage, name, version, own), T.StructType.fromJson(newest["schema"])
    )
    number = _next(_numbered(storage, PART, name, version), PART)
    where = (name, version, f"p{number:06d}-{new_run()}")
    about = together.merged([m for _, m in own]) | {"merges": chosen}
    try:
        _write_part(rows, target, storage, where, newest["key"], newest.get("marker"), about)
    except BaseException:
        storage.delete(*where)
        raise
    return True


def _located(storage: Storage, name: str, version: str, parts) -> list[tuple[str, dict]]:
    """Parts with their paths: the folder itself, or that of the rows that conform."""
    return [
        (storage.path(name, version, p, *filter(None, [m.get("rows_in")])).toString(), m)
        for p, m in parts
    ]


def remove_unfinished(
    spark: SparkSession, target: FileTarget, name: str, older_than_seconds: float
) -> list[str]:
    """Delete what runs that were killed left of a table -> the deleted folders.

    The age has to be above that of any write that is still going on.
    """
    storage, removed = Storage(spark, target.path), []
    latest = time.time() - older_than_seconds
    for version in _numbered(storage, VERSION, name):
        published = _published_parts(storage, name, version)
        stale = [(name, version, p) for p in _numbered(storage, PART, name, version)
                 if p not in published]
        for where in [(name, version)] if not published else stale:
            if storage.modified(*where) <= latest:
                storage.delete(*where)
                removed.append("/".join(where))
    return removed


def _read_files(spark: SparkSession, target: FileTarget, name: str) -> DataFrame:
    storage = Storage(spark, target.path)
    state = _state(storage, name)
    if state is None:
        raise FileNotFoundError(target.qualified(name))
    version, parts = state
    schema = T.StructType.fromJson(parts[-1][1]["schema"])
    return together.rows_of(spark, _located(storage, name, version, parts), schema)


# Catalog tables ----------------------------------------------------------


CATALOG_VERSION = re.compile(r"v(\d{10})-[0-9a-f]+")


def _leftover(target: CatalogTarget, name: str) -> str:
    return f"{quoted(target.database)}.{quoted(f'{name}__replaced')}"


def _catalog_name(target: CatalogTarget, name: str) -> str:
    return f"{quoted(target.database)}.{quoted(name)}"


def recover_catalog(spark: SparkSession, target: CatalogTarget, name: str) -> None:
    """Put a table back that a run was about to replace when it was killed."""
    final, old = _catalog_name(target, name), _leftover(target, name)
    if spark.catalog.tableExists(old):
        if spark.catalog.tableExists(final):
            spark.sql(f"DROP TABLE {old}")
        else:
            spark.sql(f"ALTER TABLE {old} RENAME TO {final}")


def _location(spark: SparkSession, table: str) -> str | None:
    rows = spark.sql(f"DESCRIBE FORMATTED {table}").filter("col_name = 'Location'").collect()
    return rows[0].data_type if rows else None


def _same_columns(spark: SparkSession, table: str, schema: T.StructType, format: str) -> bool:
    described = spark.sql(f"DESCRIBE FORMATTED {table}").filter("col_name = 'Provider'").collect()
    provider = described[0].data_type.lower() if described else ""
    pairs = [[(f.name, f.dataType) for f in s.fields] for s in (spark.table(table).schema, schema)]
    return provider == format.lower() and pairs[0] == pairs[1]


def _write_catalog(spark: SparkSession, df: DataFrame, target: CatalogTarget, name: str) -> int:
    """Write a new version of the files, then point the table at it.

    That is one call to the catalog for a table of the same columns. For others, the old
    table is renamed, the new one is made, and the old one dropped; a run that dies in
    between leaves the renamed table, which the next read or write puts back.
    """
    recover_catalog(spark, target, name)
    final, old = _catalog_name(target, name), _leftover(target, name)
    root = spark.catalog.getDatabase(target.database).locationUri
    storage = Storage(spark, f"{root.rstrip('/')}/{name}__versions")
    versions = _numbered(storage, CATALOG_VERSION)
    version = f"v{_next(versions, CATALOG_VERSION):010d}-{new_run()}"
    path = storage.path(version).toString()
    exists = spark.catalog.tableExists(final)
    seen = Observation()
    try:
        (
            df.observe(seen, F.count(F.lit(1)).alias("n"))
            .write.format(target.format)
            .options(**target.write_options)
            .save(path)
        )
        if exists and _same_columns(spark, final, df.schema, target.format):
            spark.sql(f"ALTER TABLE {final} SET LOCATION '{path}'")
            spark.catalog.refreshTable(final)
        else:
            if exists:
                spark.sql(f"ALTER TABLE {final} RENAME TO {old}")
            try:
                spark.catalog.createTable(final, path, target.format, df.schema)
            except Exception:
                recover_catalog(spark, target, name)
                raise
            if exists:
                spark.sql(f"DROP TABLE {old}")
    except BaseException:
        # Only what this run made, and only if no table reads it.
        held = _location(spark, final) if spark.catalog.tableExists(final) else None
        if held is None or not held.endswith(version):
            storage.delete(version)
        raise
    # The version before stays for readers that have begun.
    for older in versions[:-1]:
        storage.delete(older)
    return seen.get["n"]


# Connectors --------------------------------------------------------------


def _write_connector(
    df: DataFrame, target: ConnectorTarget, name: str, overwrite: bool, create: bool
) -> int:
    """The connector stages and replaces the table itself."""
    seen = Observation()
    (
        df.observe(seen, F.count(F.lit(1)).alias("n"))
        .write.format(target.format)
        .options(**target.write_options(name, create))
        .mode("overwrite" if overwrite else "errorifexists")
        .save()
    )
    return seen.get["n"]


# All targets -------------------------------------------------------------


def target_exists(spark: SparkSession, target: Target, name: str) -> bool:
    if isinstance(target, FileTarget):
        return _current(Storage(spark, target.path), name) is not None
    if isinstance(target, CatalogTarget):
        recover_catalog(spark, target, name)
        return spark.catalog.tableExists(_catalog_name(target, name))
    try:
        spark.read.format(target.format).options(**target.write_options(name)).load()
    except Exception:
        return False
    return True


def check_target(
    spark: SparkSession, target: Target, name: str, overwrite: bool = True, create: bool = True
) -> None:
    """Raise unless the table may be written in its present state."""
    if overwrite and create:
        return
    exists = target_exists(spark, target, name)
    if exists and not overwrite:
        raise TargetStateError(f"{target.qualified(name)} exists and is not to be overwritten")
    if not exists and not create:
        raise TargetStateError(f"{target.qualified(name)} is absent and is not to be created")


def write_snapshot(
    df: DataFrame,
    target: Target,
    name: str,
    key: str | None = None,
    overwrite: bool = True,
    create: bool = True,
    marker: str | None = None,
) -> Written:
    """Make the target table hold exactly the rows of ``df``.

    ``key`` is an integral column whose range is noted for later increments, ``marker`` one
    whose greatest value is noted for later deltas.
    """
    spark = df.sparkSession
    check_target(spark, target, name, overwrite, create)
    if isinstance(target, FileTarget):
        rows = _write_version(spark, df, target, name, key, marker)
    elif isinstance(target, CatalogTarget):
        rows = _write_catalog(spark, df, target, name)
    else:
        rows = _write_connector(df, target, name, overwrite, create)
    return _written(target.qualified(name), rows, df.schema)


GOOD, BAD = "conforms=true", "conforms=false"


@dataclass(frozen=True)
class Quarantined(Written):
    """A snapshot of the rows that conform; ``bad_rows`` are in the ledger beside them."""

    bad_rows: int = 0


def write_conforming(
    df: DataFrame, target: FileTarget, name: str, schema: T.StructType, key: str | None = None
) -> Quarantined:
    """A snapshot of the rows that conform to ``schema``; the others go to its ledger.

    One pass writes both, into two folders of one part, so that they are published together
    or not at all. The ledger has a row's values before the cast, and what is wrong where.
    """
    spark = df.sparkSession
    whole = df.select("*", F.struct("*").alias(SOURCE))
    told = conform_or_tell(whole, _with_source(df.schema, schema))
    rows = told.select(
        F.col("row.*"), F.col("problems"), (F.size("problems") == 0).alias("conforms")
    )
    names = schema.fieldNames()
    good = F.col("conforms")
    # Only one side has columns that the other needs not.
    laid = rows.select(
        *[F.when(good, F.col(quoted(c))).alias(c) for c in names],
        F.when(~good, F.col(quoted(SOURCE))).alias(SOURCE),
        F.when(~good, F.col("problems")).alias(PROBLEM_LIST),
        good,
    )
    storage, run = Storage(spark, target.path), new_run()
    versions = _numbered(storage, VERSION, name)
    version = f"v{_next(versions, VERSION):010d}-{run}"
    where = (name, version, f"p000000-{run}")
    counts = [F.count_if(good).alias("n"), F.count_if(~good).alias("bad")]
    if key is not None:
        k = F.col(quoted(key))
        counts += [F.min(k).alias("least"), F.max(k).alias("greatest")]
    observed = Observation()
    try:
        (
            laid.observe(observed, *counts)
            .write.mode("errorifexists")
            .options(**target.write_options)
            .partitionBy("conforms")
            .parquet(storage.path(*where).toString())
        )
        found = observed.get
        for folder in (GOOD, BAD):
            storage.make_folder(*where, folder)
        manifest = {
            "mode": "snapshot", "rows": found["n"], "rows_in": GOOD, "ledger": BAD, "bad_rows": found["bad"],
            "schema": json.loads(schema.json()), "source_schema": json.loads(df.schema.json()),
            "target_schema": json.loads(target_text(schema) or "null"),
            "key": key, "min_key": _whole(found.get("least")), "max_key": _whole(found.get("greatest")),
            "marker": None, "max_marker": None, "digest": None, "level": 0,
        }
        storage.write_text(json.dumps(manifest), *where, MANIFEST)
    except BaseException:
        storage.delete(name, version)
        raise
    older = [v for v in versions if _published_parts(storage, name, v)]
    for old in older[: len(older) + 1 - target.keep_versions]:
        storage.delete(name, old)
    done = _written(target.qualified(name), found["n"], schema)
    return Quarantined(done.target_name, done.rows, done.schema, done.target_schema, found["bad"])


SOURCE, PROBLEM_LIST = "source row", "problem list"


def _with_source(have: T.StructType, schema: T.StructType) -> T.StructType:
    taken = {SOURCE, PROBLEM_LIST, "conforms"} & {c.lower() for c in schema.fieldNames()}
    if taken:
        raise ValueError(f"names that the ledger needs: {', '.join(sorted(taken))}")
    return T.StructType([*schema.fields, T.StructField(SOURCE, have)])


def read_ledger(spark: SparkSession, target: FileTarget, name: str) -> DataFrame:
    """Rows that did not conform: their values as ``source``, and each ``column`` and ``reason``."""
    storage = Storage(spark, target.path)
    state = _state(storage, name)
    if state is None:
        raise FileNotFoundError(target.qualified(name))
    version, parts = state
    kept = [(p, m) for p, m in parts if m.get("ledger")]
    if not kept:
        raise FileNotFoundError(f"{target.qualified(name)} has no ledger")
    have = T.StructType.fromJson(kept[0][1]["source_schema"])
    schema = T.StructType([T.StructField(SOURCE, have)]).add(PROBLEM_LIST, PROBLEMS)
    paths = [storage.path(name, version, p, m["ledger"]).toString() for p, m in kept]
    rows = spark.read.schema(schema).parquet(*paths)
    return rows.select(F.col(quoted(SOURCE)).alias("source"), F.inline(F.col(quoted(PROBLEM_LIST))))


def append_increment(df: DataFrame, target: FileTarget, name: str, key: str) -> Written:
    """Add the rows of ``df`` to the current version, all of them or none."""
    rows = _add_part(df.sparkSession, df, target, name, key)
    return _written(target.qualified(name), rows, df.schema)


def append_delta(
    df: DataFrame, target: FileTarget, name: str, keys: list[str], marker: str, key: str | None = None
) -> Written:
    """Add rows that replace those of the same ``keys``, without writing these again."""
    about = {"mode": "delta", "keys": list(keys)}
    rows = _add_part(df.sparkSession, df, target, name, key, marker, about)
    return _written(target.qualified(name), rows, df.schema)


def replace_ranges(
    df: DataFrame, target: FileTarget, name: str, key: str, ranges: list[together.Range]
) -> Written:
    """Let the rows of ``df`` stand for all whose key is in one of the ranges."""
    about = {"mode": "ranges", "replaces": [list(r) for r in ranges]}
    rows = _add_part(df.sparkSession, df, target, name, key, None, about)
    return _written(target.qualified(name), rows, df.schema)


def unchanged(target: FileTarget, name: str, schema: T.StructType) -> Written:
    """What a write of nothing would return."""
    return _written(target.qualified(name), 0, schema)


def latest_marker(spark: SparkSession, target: FileTarget, name: str, marker: str) -> str | None:
    """The greatest marker that was copied; None unless every part has noted its own."""
    found = _manifests(Storage(spark, target.path), name)
    if not found or any(m.get("marker") != marker for m in found):
        return None
    kind = T.StructType.fromJson(found[-1]["schema"])[marker].dataType
    noted = [m["max_marker"] for m in found if m["max_marker"] is not None]
    if not noted:
        return None
    by = (int if isinstance(kind, (T.TimestampType, T.IntegralType)) else str)
    return max(noted, key=by)


def read_snapshot(spark: SparkSession, target: Target, name: str) -> DataFrame:
    """The current rows of a target table."""
    if isinstance(target, FileTarget):
        return _read_files(spark, target, name)
    if isinstance(target, CatalogTarget):
        recover_catalog(spark, target, name)
        return spark.table(_catalog_name(target, name))
    return spark.read.format(target.format).options(**target.write_options(name)).load()


def high_water(spark: SparkSession, target: FileTarget, name: str, key: str) -> int | None:
    """The greatest key in the target: from the manifests, or else from the rows."""
    manifests = _manifests(Storage(spark, target.path), name)
    if not manifests:
        return None
    # Rows may be gone that a part noted, where later ones replace some.
    grows = all(together.mode_of(m) in ("snapshot", "append") for m in manifests)
    if grows and all(m["key"] == key for m in manifests):
        return max((m["max_key"] for m in manifests if m["max_key"] is not None), default=None)
    rows = read_snapshot(spark, target, name)
    return _whole(rows.agg(F.max(F.col(quoted(key))).alias("high")).first().high)


def key_bounds(
    spark: SparkSession, target: FileTarget, name: str, key: str, n: int, high: int | None = None
) -> list[int]:
    """Keys that cut the table into ``n`` ranges of about as many rows; a key may repeat.

    They come from the sketches that the parts noted when they were written, merged: no key
    is read. Keys that the source has beyond the copied ones, up to ``high``, are cut as
    densely as those. Empty if a part has no sketch.
    """
    found = _manifests(Storage(spark, target.path), name)
    noted = [m for m in found if m["key"] != key or m["min_key"] is not None]
    if n < 2 or not noted or any(m["key"] != key or not m.get("sketch") for m in noted):
        return []
    sketches = spark.createDataFrame([(base64.b64decode(m["sketch"]),) for m in noted], "s binary")
    low, top = min(m["min_key"] for m in noted), max(m["max_key"] for m in noted)
    # The splits that the keys copied before get, and those of the keys that came since.
    fresh = max(0, (high or top) - top)
    more = min(n - 1, -(-n * fresh // (fresh + top - low + 1)))
    steps = FINE * (n - more)
    ranks = F.array(*[F.lit(i / steps) for i in range(1, steps)])
    merged = F.kll_merge_agg_bigint("s")
    fine = sketches.agg(F.kll_sketch_get_quantile_bigint(merged, ranks).alias("b")).first().b
    return [*_packed_bounds(fine), *(top + 1 + i * fresh // more for i in range(more))]


FINE = 4  # quantiles for each split, so that what follows a frequent key is cut off soon


def _packed_bounds(fine: list[int]) -> list[int]:
    """Bounds out of ``FINE`` times as many quantiles.

    A key that fills most of a split is a bound as often as it fills one, and so is the next
    quantile after it; elsewhere every ``FINE``-th is.
    """
    bounds: list[int] = []
    held, after = 0, False
    for key, same in groupby(fine):
        times = len(list(same))
        held += times
        if times >= FINE - 1:
            bounds += [key] * -(-times // FINE)
            held, after = 0, True
        elif held >= FINE or after:
            bounds.append(key)
            held, after = 0, False
    return bounds


def list_tables(spark: SparkSession, target: FileTarget) -> list[str]:
    storage = Storage(spark, target.path)
    return [n for n in storage.child_names() if _current(storage, n) is not None]
