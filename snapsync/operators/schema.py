"""Schemas of target tables, and rows made to fit a declared one."""

from __future__ import annotations

import datetime
import json
from collections.abc import Callable, Mapping
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapsync.functions.names import quoted
from snapsync.sources.base import local_frame

# Target types of Spark types, and Spark types of declared names.
TARGET_TYPES = {
    T.BooleanType: "BOOL",
    T.ByteType: "INT64",
    T.ShortType: "INT64",
    T.IntegerType: "INT64",
    T.LongType: "INT64",
    T.FloatType: "FLOAT64",
    T.DoubleType: "FLOAT64",
    T.StringType: "STRING",
    T.CharType: "STRING",
    T.VarcharType: "STRING",
    T.BinaryType: "BYTES",
    T.DateType: "DATE",
    T.TimestampType: "TIMESTAMP",
    T.TimestampNTZType: "DATETIME",
}
DECLARED_TYPES = {
    "BOOL": T.BooleanType(),
    "BOOLEAN": T.BooleanType(),
    "INT64": T.LongType(),
    "INTEGER": T.LongType(),
    "FLOAT64": T.DoubleType(),
    "FLOAT": T.DoubleType(),
    "NUMERIC": T.DecimalType(38, 9),
    "BIGNUMERIC": T.DecimalType(38, 18),
    "STRING": T.StringType(),
    "JSON": T.StringType(),
    "BYTES": T.BinaryType(),
    "DATE": T.DateType(),
    "DATETIME": T.TimestampNTZType(),
    "TIMESTAMP": T.TimestampType(),
}
NUMERIC_MAX_SCALE = 9
NUMERIC_MAX_WHOLE_DIGITS = 29
TARGET_COLUMNS = T.StructType(
    [T.StructField(c, T.StringType()) for c in ("column_name", "target_type", "mode")]
)


def target_field(name: str, data_type: T.DataType, nullable: bool = True) -> dict[str, Any]:
    """A column as a declared-schema entry (``name, type, mode, fields``)."""
    if isinstance(data_type, T.ArrayType):
        element = target_field(name, data_type.elementType)
        if element["mode"] == "REPEATED":
            raise TypeError(f"{name}: the target has no arrays of arrays")
        return element | {"mode": "REPEATED"}
    if isinstance(data_type, T.MapType):
        entry = T.StructType(
            [
                T.StructField("key", data_type.keyType, False),
                T.StructField("value", data_type.valueType),
            ]
        )
        return target_field(name, entry) | {"mode": "REPEATED"}
    field: dict[str, Any] = {"name": name, "mode": "NULLABLE" if nullable else "REQUIRED"}
    if isinstance(data_type, T.StructType):
        field["type"] = "RECORD"
        field["fields"] = [target_field(f.name, f.dataType, f.nullable) for f in data_type.fields]
    elif isinstance(data_type, T.DecimalType):
        whole = data_type.precision - data_type.scale
        small = data_type.scale <= NUMERIC_MAX_SCALE and whole <= NUMERIC_MAX_WHOLE_DIGITS
        field["type"] = "NUMERIC" if small else "BIGNUMERIC"
        field["precision"], field["scale"] = data_type.precision, data_type.scale
    elif type(data_type) in TARGET_TYPES:
        field["type"] = TARGET_TYPES[type(data_type)]
    else:
        raise TypeError(f"{name}: no target type for {data_type.simpleString()}")
    return field


def target_fields(schema: T.StructType) -> list[dict[str, Any]]:
    """A schema as the list of entries that ``load_schema`` reads."""
    # Sources rarely mean what they say about NULLs, so no column is REQUIRED.
    return [target_field(f.name, f.dataType) for f in schema.fields]


def target_schema(df: DataFrame) -> DataFrame:
    """``column_name, target_type, mode`` of the table that ``df`` is copied to.

    Fields of records follow their record as ``record.field``.
    """
    rows: list[tuple[str, str, str]] = []

    def add(field: Mapping[str, Any], path: str) -> None:
        name = path + field["name"]
        rows.append((name, field["type"], field["mode"]))
        for child in field.get("fields", ()):
            add(child, name + ".")

    for field in target_fields(df.schema):
        add(field, "")
    return local_frame(df.sparkSession, rows, TARGET_COLUMNS)


def _declared_field(entry: Mapping[str, Any]) -> T.StructField:
    try:
        name, kind = entry["name"], str(entry["type"]).upper()
    except (KeyError, TypeError) as e:
        raise ValueError(f"a declared column needs a name and a type: {entry!r}") from e
    if kind in ("RECORD", "STRUCT"):
        data_type: T.DataType = T.StructType([_declared_field(f) for f in entry.get("fields", ())])
    elif kind in DECLARED_TYPES:
        data_type = DECLARED_TYPES[kind]
        if isinstance(data_type, T.DecimalType) and entry.get("precision") is not None:
            data_type = T.DecimalType(int(entry["precision"]), int(entry.get("scale") or 0))
    else:
        raise ValueError(f"{name}: unknown type {entry['type']!r}")
    mode = str(entry.get("mode") or "NULLABLE").upper()
    if mode not in ("NULLABLE", "REQUIRED", "REPEATED"):
        raise ValueError(f"{name}: unknown mode {entry['mode']!r}")
    if mode == "REPEATED":
        data_type = T.ArrayType(data_type)
    metadata = {"description": entry["description"]} if entry.get("description") else {}
    return T.StructField(name, data_type, mode != "REQUIRED", metadata)


def load_schema(text: str) -> T.StructType:
    """A declared schema (JSON list of ``name, type, mode, description, fields``)."""
    entries = json.loads(text)
    if not isinstance(entries, list):
        raise ValueError("a declared schema is a list of columns")
    schema = T.StructType([_declared_field(e) for e in entries])
    names = [n.lower() for n in schema.fieldNames()]
    if len(set(names)) < len(names):
        raise ValueError("a declared schema names each column once")
    return schema


def _refuse(path: str, why: str, data_type: T.DataType) -> Column:
    return F.raise_error(F.lit(f"{path}: {why}")).cast(data_type)


# What a text has to look like, beyond being castable, to be the value it is cast to.
# A whole date, more digits after the second than a timestamp keeps, a zone after a time,
# an infinity that is meant, and the letter of a type after a number.
WHOLE_DATE = r"^\s*[+-]?\d{4,}-\d{1,2}-\d{1,2}(\D|$)"
INFINITY = r"(?i)^\s*[+-]?inf(inity)?\s*$"
TYPE_LETTER = r"(?i)[\d.](d|f|l|s|y|bd)\s*$"
TOO_FINE = r"\.\d{6}\d*[1-9]"
ZONED = r"\d:\d.*([zZ]|[A-Za-z]{3}|[+-]\d{1,2}(:?\d{2})*)\s*$"


def _number_text(text: Column) -> Column:
    """A number's text without what does not change it: spaces, plus, outer zeros."""
    text = F.regexp_replace(F.trim(text), r"^\+", "")
    text = F.regexp_replace(text, r"^(-?)0+(?=\d)", "$1")
    text = F.regexp_replace(text, r"(\.\d*?)0+$", "$1")
    text = F.regexp_replace(text, r"\.$", "")
    return F.regexp_replace(F.regexp_replace(text, r"^(-?)\.", "$10."), r"^-0$", "0")


def _text_changes(value: Column, cast: Column, want: T.DataType) -> Column:
    """Whether a text that can be cast says something else than the cast value."""
    if isinstance(want, T.DecimalType):
        # Without an exponent only digits after the point can be too many.
        fraction = F.regexp_extract(_number_text(value), r"\.(\d+)$", 1)
        same = F.length(fraction) <= want.scale
        # With an exponent digits do not line up; a double has 15 that are safe.
        scientific = value.rlike("[eE]")
        digits = F.length(F.regexp_replace(value, r"[eE].*|\D", ""))
        close = (value.try_cast("double") == cast.cast("double")) & (digits <= 15)
        return ~F.when(scientific, close).otherwise(same)
    if isinstance(want, T.DoubleType):
        # 15 digits are safe; the double of 16 or 17 has to read the same again.
        exact, back = (c.try_cast(T.DecimalType(38, 20)) for c in (value, cast.cast("string")))
        digits = F.length(F.regexp_replace(_number_text(value), r"[eE].*|\D|^-?0\.0*", ""))
        endless = cast.isin(float("inf"), float("-inf")) & ~value.rlike(INFINITY)
        # A number that is not zero, and too small for a double.
        vanished = (cast == 0) & value.rlike(r"^[^eE]*[1-9]")
        other = endless | vanished | value.rlike(TYPE_LETTER)
        return other | (digits > 15) & (F.coalesce(exact != back, F.lit(True)) | (digits > 17))
    if isinstance(want, T.DateType):
        moment = value.try_cast(T.TimestampNTZType())
        later = moment.isNotNull() & (moment != cast.cast(T.TimestampNTZType()))
        return ~value.rlike(WHOLE_DATE) | later
    # Of a time without a date, or a part of a date, the rest would be made up.
    if isinstance(want, T.TimestampType):
        return ~value.rlike(WHOLE_DATE) | value.rlike(TOO_FINE)
    if isinstance(want, T.TimestampNTZType):
        return ~value.rlike(WHOLE_DATE) | value.rlike(TOO_FINE) | value.rlike(ZONED)
    return F.lit(False)


def _changes(value: Column, cast: Column, have: T.DataType, want: T.DataType) -> Column:
    """Whether a cast value is another one than before.

    It is cast back and compared in the type that it had: a common type of both might
    have dropped the same digits.
    """
    if isinstance(have, T.StringType):
        return _text_changes(value, cast, want)
    if isinstance(want, T.StringType):
        return ~F.is_valid_utf8(cast) if isinstance(have, T.BinaryType) else F.lit(False)
    return ~cast.try_cast(have).eqNullSafe(value)


Refusal = Callable[[str, str, T.DataType], Column]


def _fitted(
    value: Column, have: T.DataType, want: T.DataType, path: str, refuse: Refusal = _refuse
) -> Column:
    """The value as type ``want``; a value that would change is what ``refuse`` says."""
    if isinstance(want, T.ArrayType) and isinstance(have, T.MapType):
        entry = T.StructType(
            [T.StructField("key", have.keyType), T.StructField("value", have.valueType)]
        )
        return _fitted(F.map_entries(value), T.ArrayType(entry), want, path, refuse)
    if isinstance(want, T.ArrayType) and isinstance(have, T.ArrayType):
        return F.transform(
            value, lambda v: _fitted(v, have.elementType, want.elementType, f"{path}[]", refuse)
        )
    if isinstance(want, T.StructType) and isinstance(have, T.StructType):
        record = F.struct(*_columns(have, want, value.getField, f"{path}.", refuse))
        return F.when(value.isNotNull(), record)
    if have == want:
        return value
    cast = value.try_cast(want)
    lost = cast.isNull() | _changes(value, cast, have, want)
    why = f"value does not fit {want.simpleString()}"
    return F.when(value.isNull(), F.lit(None).cast(want)).otherwise(
        F.when(lost, refuse(path, why, want)).otherwise(cast)
    )


def _columns(
    have: T.StructType, want: T.StructType, get, path: str = "", refuse: Refusal = _refuse
) -> list[Column]:
    present = {f.name.lower(): f for f in have.fields}
    extra = present.keys() - {f.name.lower() for f in want.fields}
    if extra:
        raise ValueError(f"columns that are not declared: {sorted(path + e for e in extra)}")
    fitted = []
    for f in want.fields:
        source = present.get(f.name.lower())
        where = path + f.name
        if source is not None:
            value = _fitted(get(source.name), source.dataType, f.dataType, where, refuse)
            if not f.nullable:
                missing = refuse(where, "required value is NULL", f.dataType)
                value = F.coalesce(value, missing)
        elif f.nullable:
            value = F.lit(None).cast(f.dataType)
        else:
            raise ValueError(f"{where}: required column is missing")
        fitted.append(value.alias(f.name, metadata=f.metadata))
    return fitted


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Rows with exactly the declared columns, in order and with their types.

    Columns missing from the source are NULL. A NULL in a REQUIRED column, or a
    value that a cast would lose or change, fails the job that reads the rows;
    checks and casts are one projection of the same scan.
    """
    return df.select(_columns(df.schema, schema, lambda n: F.col(quoted(n))))


def _filler(data_type: T.DataType) -> Column:
    """Some value of a type that is not NULL, and that Spark knows not to be."""
    if isinstance(data_type, T.StructType):
        return F.struct(*[F.lit(None).cast(f.dataType).alias(f.name) for f in data_type.fields])
    if isinstance(data_type, T.ArrayType):
        return F.array().cast(data_type)
    if isinstance(data_type, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return F.lit(datetime.datetime(1970, 1, 1)).cast(data_type)
    text = isinstance(data_type, (T.StringType, T.BinaryType))
    return F.lit("" if text else 0).cast(data_type)


def required(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Conforming rows, with REQUIRED columns as such that Spark knows to have no NULL.

    Writers make the columns of other systems from that, and from the descriptions that
    ``conform`` leaves with the columns. The NULLs have been refused: no value is replaced.
    """
    return df.select(
        [
            F.col(quoted(f.name))
            if f.nullable
            else F.coalesce(F.col(quoted(f.name)), _filler(f.dataType)).alias(f.name, metadata=f.metadata)
            for f in schema.fields
        ]
    )


# Rows that do not conform ------------------------------------------------


def _fits(value: Column, have: T.DataType, want: T.DataType) -> Column:
    cast = value.try_cast(want)
    return value.isNull() | (cast.isNotNull() & ~_changes(value, cast, have, want))


def _value_problems(
    value: Column, have: T.DataType, want: T.DataType, path: str
) -> list[tuple[Column, str, str]]:
    """What can be wrong with a value: (whether it is, path, reason)."""
    if isinstance(want, T.ArrayType) and isinstance(have, T.MapType):
        entry = T.StructType(
            [T.StructField("key", have.keyType), T.StructField("value", have.valueType)]
        )
        return _value_problems(F.map_entries(value), T.ArrayType(entry), want, path)
    if isinstance(want, T.ArrayType) and isinstance(have, T.ArrayType):

        def inner(v: Column) -> list[tuple[Column, str, str]]:
            return _value_problems(v, have.elementType, want.elementType, f"{path}[]")

        def any_of(i: int) -> Column:
            return F.coalesce(F.exists(value, lambda v: inner(v)[i][0]), F.lit(False))

        told = inner(F.lit(None).cast(have.elementType))
        return [(any_of(i), where, why) for i, (_, where, why) in enumerate(told)]
    if isinstance(want, T.StructType) and isinstance(have, T.StructType):
        found = _problems(have, want, value.getField, f"{path}.")
        return [(value.isNotNull() & wrong, where, why) for wrong, where, why in found]
    if have == want:
        return []
    return [(~_fits(value, have, want), path, f"value does not fit {want.simpleString()}")]


def _problems(
    have: T.StructType, want: T.StructType, get, path: str = ""
) -> list[tuple[Column, str, str]]:
    present = {f.name.lower(): f for f in have.fields}
    found = []
    for f in want.fields:
        source = present.get(f.name.lower())
        if source is None:
            continue
        where, value = path + f.name, get(source.name)
        found += _value_problems(value, source.dataType, f.dataType, where)
        if not f.nullable:
            found.append((value.isNull(), where, "required value is NULL"))
    return found


PROBLEMS = T.ArrayType(
    T.StructType([T.StructField(c, T.StringType()) for c in ("column", "reason")])
)


def conform_or_tell(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Two columns: ``row``, as ``conform`` would have it, and ``problems``, what is wrong.

    A row without problems conforms; in others, values that do not fit are NULL. It is one
    projection, in which no value fails the job. What no row could mend, such as a required
    column that is missing, raises at once.
    """
    get = lambda n: F.col(quoted(n))
    empty = lambda path, why, kind: F.lit(None).cast(kind)
    fitted = _columns(df.schema, schema, get, refuse=empty)
    told = [
        F.when(wrong, F.struct(F.lit(where).alias("column"), F.lit(why).alias("reason")))
        for wrong, where, why in _problems(df.schema, schema, get)
    ]
    problems = F.filter(F.array(*told), lambda p: p.isNotNull()) if told else F.array()
    return df.select(F.struct(*fitted).alias("row"), problems.cast(PROBLEMS).alias("problems"))
