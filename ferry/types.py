"""Canonical column types and the names under which sources report them."""

from __future__ import annotations

import re
from dataclasses import dataclass, replace

from pyspark.sql import types as T

# Other spellings of the canonical type names.
ALIASES = {
    "BOOL": "BOOLEAN",
    "CHARACTER VARYING": "VARCHAR",
    "CHARCTER VARYING": "VARCHAR",
    "DECIMAL": "NUMERIC",
    "DOUBLE PRECISION": "DOUBLE",
    "FLOAT4": "REAL",
    "FLOAT8": "DOUBLE",
    "INT": "INTEGER",
    "INT2": "SMALLINT",
    "INT4": "INTEGER",
    "INT8": "BIGINT",
}

# What each source calls a type -> canonical type. Names not listed
# only go through ALIASES.
SOURCE_TYPES = {
    "postgres": {},
    "sqlserver": {
        "BIT": "BOOLEAN",
        "DATETIME": "TIMESTAMP",
        "DATETIME2": "TIMESTAMP",
        "DATETIMEOFFSET": "TIMESTAMPTZ",
        "DECIMAL": "NUMERIC",
        "FLOAT": "DOUBLE",
        "INT": "INTEGER",
        "MONEY": "NUMERIC",
        "NVARCHAR": "TEXT",
        "SMALLDATETIME": "TIMESTAMP",
        "TINYINT": "SMALLINT",
        "UNIQUEIDENTIFIER": "UUID",
    },
    "snowflake": {
        "ARRAY": "JSONB",
        "FIXED": "NUMERIC",
        "FLOAT": "DOUBLE",
        "NUMBER": "NUMERIC",
        "REAL": "DOUBLE",
        "TIMESTAMPLTZ": "TIMESTAMP",
        "TIMESTAMPNTZ": "TIMESTAMP",
        "TIMESTAMP_LTZ": "TIMESTAMP",
        "TIMESTAMP_NTZ": "TIMESTAMP",
        "TIMESTAMP_TZ": "TIMESTAMPTZ",
        "VARIANT": "JSONB",
    },
}

# Fixed value: from this declared length on, a Snowflake text column is unbounded.
SNOWFLAKE_TEXT_LENGTH = 16777216

# Fixed value: digits of Spark's widest decimal.
DECIMAL_DIGITS = 38

JSON_TYPES = ("JSON", "JSONB", "_TEXT")

_DECLARED = re.compile(r"^\s*([A-Za-z_][A-Za-z0-9_ ]*?)\s*(?:\(\s*(\d+)\s*(?:,\s*(\d+)\s*)?\))?\s*$")


@dataclass(frozen=True)
class Column:
    name: str
    database_type: str = ""
    type: str = ""
    length: int = 0
    nullable: bool | None = None
    position: int = 0
    scale: int = 0
    precision: int = 0


def type_alias(name: str) -> str:
    return ALIASES.get(name, name)


def parse_declared(text: str) -> tuple[str, int, int]:
    """`NUMERIC(15,2)` -> ("NUMERIC", 15, 2); `VARCHAR(10)` -> ("VARCHAR", 10, 0)."""
    m = _DECLARED.match(text)
    if not m:
        raise ValueError(f"not a type name: {text!r}")
    return m[1].upper(), int(m[2] or 0), int(m[3] or 0)


def declared_column(name: str, declared: str, source: str | None = None, **extra) -> Column:
    """Column as a source declares it, with its canonical type."""
    base, size, scale = parse_declared(declared)
    column = map_source_type(Column(name, database_type=base, length=size, precision=size, scale=scale, **extra), source)
    if column.type == "NUMERIC":
        return replace(column, length=0)
    return replace(column, precision=0, scale=0)


def map_source_type(column: Column, source: str | None = None) -> Column:
    """Set the canonical `type` from `database_type` by the rules of one source."""
    if source is not None and source not in SOURCE_TYPES:
        raise ValueError(f"unknown source: {source}")
    reported = column.database_type.upper()
    mapped = SOURCE_TYPES.get(source or "", {}).get(reported) or type_alias(reported)
    if source == "snowflake" and reported == "TEXT" and 0 < column.length < SNOWFLAKE_TEXT_LENGTH:
        mapped = "VARCHAR"
    if source == "sqlserver" and reported == "MONEY" and not column.precision:
        column = replace(column, precision=19, scale=4)
    return replace(column, type=mapped)


def spark_type(column: Column) -> T.DataType | None:
    """Spark type of a canonical type. None for types whose values may stay nested."""
    simple = {
        "BIGINT": T.LongType(),
        "BOOLEAN": T.BooleanType(),
        "DATE": T.DateType(),
        "DOUBLE": T.DoubleType(),
        "INTEGER": T.IntegerType(),
        "REAL": T.FloatType(),
        "SMALLINT": T.ShortType(),
        "TIMESTAMP": T.TimestampNTZType(),
        "TIMESTAMPTZ": T.TimestampType(),
    }
    if column.type in simple:
        return simple[column.type]
    if column.type in JSON_TYPES:
        return None
    if column.type == "NUMERIC":
        if column.precision <= 0:
            return T.DoubleType()
        if column.scale > column.precision:
            raise ValueError(f"NUMERIC({column.precision},{column.scale}) of column {column.name} has more fraction digits than digits")
        if column.precision > DECIMAL_DIGITS:
            return T.StringType()  # Spark's decimals end there: the digits are kept as text
        return T.DecimalType(column.precision, column.scale)
    return T.StringType()


def is_known(name: str) -> bool:
    """Whether a canonical type is one that spark_type tells from text."""
    return name in ("NUMERIC", "TEXT", "UUID", "VARCHAR", *JSON_TYPES) or spark_type(Column("", type=name)) != T.StringType()


def is_nested(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.ArrayType, T.MapType, T.StructType, T.VariantType))


def column_of(field: T.StructField, position: int) -> Column:
    """Column of a Spark field. Declared names in the field's metadata win over its Spark type."""
    meta = field.metadata or {}
    base = Column(field.name, nullable=field.nullable, position=position)
    if meta.get("logical_type"):
        sizes = {k: int(meta.get(k, 0) or 0) for k in ("length", "precision", "scale")}
        base = replace(base, type=meta["logical_type"], **sizes)
    dtype = field.dataType
    database_type = meta.get("source_type") or meta.get("jdbcClientType") or dtype.simpleString().upper()
    base = replace(base, database_type=parse_declared(database_type)[0] if _DECLARED.match(database_type) else database_type)
    declared = meta.get("__CHAR_VARCHAR_TYPE_STRING")
    if declared:
        base = replace(base, length=parse_declared(declared)[1], type=base.type or "VARCHAR")
    if isinstance(dtype, (T.VarcharType, T.CharType)):
        base = replace(base, length=dtype.length, type=base.type or "VARCHAR")
    if isinstance(dtype, T.DecimalType):
        base = replace(base, precision=dtype.precision, scale=dtype.scale)
    return base if base.type else replace(base, type=canonical_type(dtype))


def canonical_type(dtype: T.DataType) -> str:
    names = {
        T.BooleanType: "BOOLEAN",
        T.ByteType: "SMALLINT",
        T.DateType: "DATE",
        T.DecimalType: "NUMERIC",
        T.DoubleType: "DOUBLE",
        T.FloatType: "REAL",
        T.IntegerType: "INTEGER",
        T.LongType: "BIGINT",
        T.ShortType: "SMALLINT",
        T.StringType: "TEXT",
        T.TimestampNTZType: "TIMESTAMP",
        T.TimestampType: "TIMESTAMPTZ",
    }
    if isinstance(dtype, T.ArrayType) and isinstance(dtype.elementType, T.StringType):
        return "_TEXT"
    if is_nested(dtype):
        return "JSONB"
    return names.get(type(dtype), dtype.simpleString().upper())
