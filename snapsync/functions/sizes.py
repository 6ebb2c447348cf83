"""Logical size of rows, as a sum of column widths."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapsync.functions.names import quoted

# Bytes per value of the fixed-width types.
FIXED_WIDTHS = {
    T.BooleanType: 1,
    T.ByteType: 1,
    T.ShortType: 2,
    T.IntegerType: 4,
    T.FloatType: 4,
    T.DateType: 4,
    T.LongType: 8,
    T.DoubleType: 8,
    T.TimestampType: 8,
    T.TimestampNTZType: 8,
}


def fixed_width(data_type: T.DataType) -> int | None:
    """Bytes per value, or None where the width varies."""
    if isinstance(data_type, T.DecimalType):
        return 8 if data_type.precision <= 18 else 16
    return FIXED_WIDTHS.get(type(data_type))


def _value_bytes(column: Column, data_type: T.DataType) -> Column:
    width = fixed_width(data_type)
    if width is not None:
        return F.lit(width).cast("long")
    if isinstance(data_type, (T.StringType, T.BinaryType)):
        size = F.octet_length(column).cast("long")
    elif isinstance(data_type, T.ArrayType):
        width = fixed_width(data_type.elementType)
        if width is not None:
            size = F.size(column).cast("long") * width
        else:
            size = F.aggregate(
                column,
                F.lit(0).cast("long"),
                lambda total, v: total + _value_bytes(v, data_type.elementType),
            )
    elif isinstance(data_type, T.MapType):
        size = _value_bytes(F.map_keys(column), T.ArrayType(data_type.keyType)) + _value_bytes(
            F.map_values(column), T.ArrayType(data_type.valueType)
        )
    elif isinstance(data_type, T.StructType):
        size = F.lit(0).cast("long")
        for f in data_type.fields:
            size = size + _value_bytes(column.getField(f.name), f.dataType)
    else:
        raise TypeError(f"no size rule for {data_type.simpleString()}")
    return F.when(column.isNull(), F.lit(0).cast("long")).otherwise(size)


def row_bytes(schema: T.StructType) -> Column:
    """Logical bytes of a row. Fixed-width columns count by their type alone, so a
    scan for this reads none but the variable-width columns."""
    fixed = 0
    total = F.lit(0).cast("long")
    for f in schema.fields:
        width = fixed_width(f.dataType)
        if width is not None:
            fixed += width
        else:
            total = total + _value_bytes(F.col(quoted(f.name)), f.dataType)
    return total + F.lit(fixed).cast("long")
