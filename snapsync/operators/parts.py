"""What the parts of a version are together.

A manifest says what its part does to the parts before it:

``append``    nothing: its rows are added.
``delta``     its rows replace those of the same ``keys``: the newest wins.
``ranges``    its rows replace all that have a key in one of its ``replaces``.

``snapshot`` is the first part. A part that ``merges`` others stands for them; these are
no longer read. It follows the parts that it stands for, as only the newest are merged.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapsync.functions.names import quoted
from snapsync.sources.base import union_all

Manifest = Mapping[str, Any]
# A key range: (least, greatest), both included. A range without a least key has NULL keys.
Range = Sequence[int | None]


def mode_of(manifest: Manifest) -> str:
    return manifest.get("mode") or "append"


def live(parts: Sequence[tuple[str, Manifest]]) -> list[tuple[str, Manifest]]:
    """The parts that are not merged into another one."""
    gone = {p for _, m in parts for p in m.get("merges") or ()}
    return [(p, m) for p, m in parts if p not in gone]


def tier(parts: Sequence[tuple[str, Manifest]], fan: int) -> list[str]:
    """The newest parts if there are ``fan`` of one level and kind, which then are merged.

    So a row is merged again only when ``fan`` times as many parts have come: it is
    written once more for each power of ``fan`` that the number of increments reaches.
    """
    found: list[str] = []
    kind = None
    for part, manifest in reversed(parts):
        own = (manifest.get("level") or 0, mode_of(manifest), manifest.get("keys"), manifest.get("key"))
        if own[1] == "snapshot" or (kind is not None and own != kind):
            break
        kind = own
        found.append(part)
        if len(found) == fan:
            return found[::-1]
    return []


def in_ranges(key: str, ranges: Sequence[Range]) -> Column:
    """Whether a row's key is in one of the ranges; never NULL."""
    k = F.col(quoted(key))

    def inside(low: int | None, high: int | None) -> Column:
        found = F.lit(True)
        if low is not None:
            found = found & (k >= low)
        if high is not None:
            found = found & (k <= high)
        return F.coalesce(found, F.lit(False)) if low is not None else found | k.isNull()

    def either(first: int, last: int) -> Column:
        # By halves: Spark goes down into a predicate as deep as it is nested.
        if last - first == 1:
            return inside(*ranges[first])
        middle = (first + last) // 2
        return either(first, middle) | either(middle, last)

    return F.coalesce(either(0, len(ranges)) if ranges else F.lit(False), F.lit(False))


def free_name(schema: T.StructType, name: str) -> str:
    taken = {c.lower() for c in schema.fieldNames()}
    while name in taken:
        name += "_"
    return name


def rows_of(
    spark: SparkSession, parts: Sequence[tuple[str, Manifest]], schema: T.StructType
) -> DataFrame:
    """The rows that the parts (path, manifest), in their order, are together."""
    replaced = [mode_of(m) == "ranges" for _, m in parts]
    deltas = [mode_of(m) == "delta" for _, m in parts]

    def read(paths: list[str]) -> DataFrame:
        return spark.read.schema(schema).parquet(*paths)

    if not any(replaced) and not any(deltas):
        return read([p for p, _ in parts])
    # Neighbours that the same later parts act upon are read together.
    groups: list[tuple[tuple, list[int]]] = []
    for i in range(len(parts)):
        later = tuple(j for j in range(i + 1, len(parts)) if replaced[j] or deltas[j])
        if not groups or deltas[i] or groups[-1][0] != later:
            groups.append((later, []))
        groups[-1][1].append(i)
    place = free_name(schema, "place")
    frames = []
    for later, members in groups:
        df = read([parts[i][0] for i in members])
        for j in later:
            if replaced[j]:
                # As a filter on the key it reaches the files' statistics.
                df = df.filter(~in_ranges(parts[j][1]["key"], parts[j][1]["replaces"]))
        frames.append(df.withColumn(place, F.lit(members[-1])))
    if not any(deltas):
        return union_all(frames).drop(place)
    keys = next(m["keys"] for (_, m), d in zip(parts, deltas) if d)
    newest = free_name(schema, "newest")
    changed = union_all(
        read([parts[i][0]]).select(*map(quoted, keys)).withColumn(newest, F.lit(i))
        for i in range(len(parts))
        if deltas[i]
    )
    changed = changed.groupBy(*map(quoted, keys)).agg(F.max(newest).alias(newest))
    same = F.lit(True)
    whole = union_all(frames).alias("row")
    changed = changed.alias("change")
    for k in keys:
        same = same & F.col(f"row.{quoted(k)}").eqNullSafe(F.col(f"change.{quoted(k)}"))
    met = whole.join(changed, same, "left")
    kept = met.filter(F.col(newest).isNull() | (F.col(newest) <= F.col(place)))
    return kept.select(*[F.col(f"row.{quoted(c)}") for c in schema.fieldNames()])


def merged(parts: Sequence[Manifest]) -> dict[str, Any]:
    """What a part that stands for ``parts`` says of itself."""
    first = parts[0]
    found = {"mode": mode_of(first), "level": (first.get("level") or 0) + 1}
    if first.get("keys"):
        found["keys"] = first["keys"]
    if mode_of(first) == "ranges":
        found["replaces"] = [r for m in parts for r in m["replaces"]]
    return found
