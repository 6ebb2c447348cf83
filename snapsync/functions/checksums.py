"""Digests of rows that do not depend on their order.

A row's hash is 64 bits of all its values, their places and which of them are NULL. Rows
are added up: the count and the sums of both halves of the hashes, so that equal rows are
told from none, whatever tasks they are in. Sums are exact up to 2^31 rows in a group.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapsync.functions.names import quoted

DIGEST = ("n", "low", "high")


def _hashed(value: Column, kind: T.DataType) -> Column:
    """A hash that is not NULL: other for NULL than for any value that is likely."""
    if isinstance(kind, T.StructType):
        parts = [_hashed(value.getField(f.name), f.dataType) for f in kind.fields]
        inner = F.xxhash64(F.lit(len(parts)), *parts)
    elif isinstance(kind, T.ArrayType):
        inner = F.xxhash64(F.size(value), F.transform(value, lambda v: _hashed(v, kind.elementType)))
    elif isinstance(kind, T.MapType):
        # Entries have no order: their hashes are sorted.
        entry = T.StructType([T.StructField("key", kind.keyType), T.StructField("value", kind.valueType)])
        hashes = F.transform(F.map_entries(value), lambda v: _hashed(v, entry))
        inner = F.xxhash64(F.size(value), F.array_sort(hashes))
    else:
        inner = F.xxhash64(value)
    return F.when(value.isNull(), F.lit(-1).cast("long")).otherwise(inner)


def row_hash(schema: T.StructType) -> Column:
    """64 bits of a whole row; columns count by their order, not by their names."""
    return F.xxhash64(F.lit(len(schema)), *[_hashed(F.col(quoted(f.name)), f.dataType) for f in schema.fields])


def digest(schema: T.StructType) -> list[Column]:
    """Aggregates ``n, low, high`` of the rows of ``schema``."""
    h = row_hash(schema)
    low = h.bitwiseAND(F.lit(0xFFFFFFFF))
    return [
        F.count(F.lit(1)).alias("n"),
        F.coalesce(F.sum(low), F.lit(0)).alias("low"),
        F.coalesce(F.sum(F.shiftrightunsigned(h, 32)), F.lit(0)).alias("high"),
    ]
