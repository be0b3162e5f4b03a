"""Schema discovery, type overrides and the projection that applies them."""

from __future__ import annotations

import json
from collections import Counter
from collections.abc import Iterable, Mapping
from dataclasses import fields, replace

import yaml
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ferry.functions.casts import cast_expr
from ferry.functions.uuids import fix_sqlserver_uuid
from ferry.types import DECIMAL_DIGITS, Column, canonical_type, column_of, declared_column, is_known, map_source_type, parse_declared, type_alias

DESCRIBE_SCHEMA = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField("database_type", T.StringType()),
        T.StructField("type", T.StringType()),
        T.StructField("length", T.LongType()),
        T.StructField("nullable", T.BooleanType()),
        T.StructField("position", T.IntegerType()),
        T.StructField("scale", T.LongType()),
        T.StructField("precision", T.LongType()),
    ]
)


def columns_of(df: DataFrame, source: str | None = None, declared: Mapping[str, str] | None = None) -> list[Column]:
    """Columns of a DataFrame in canonical types, from its analysed schema: no job runs.

    `declared` gives the source's own type names by column name (case-insensitive); without it the
    names a JDBC source left in the field metadata are used, then the Spark types.
    """
    by_name = {k.lower(): v for k, v in (declared or {}).items()}
    out = []
    for i, field in enumerate(df.schema.fields):
        if field.name.lower() in by_name:
            column = declared_column(field.name, by_name[field.name.lower()], source, nullable=field.nullable, position=i)
            if column.type == "NUMERIC" and not column.precision and isinstance(field.dataType, T.DecimalType):
                column = replace(column, precision=field.dataType.precision, scale=field.dataType.scale)
            out.append(column)
            continue
        column = column_of(field, i)
        if source is not None and (field.metadata or {}).get("jdbcClientType"):
            column = map_source_type(column, source)
            # Drivers have more names for numbers than one, as `bigserial`.
            if not is_known(column.type) and isinstance(field.dataType, (T.NumericType, T.BooleanType)):
                column = replace(column, type=canonical_type(field.dataType))
        out.append(column)
    return out


def describe(df: DataFrame, **kwargs) -> DataFrame:
    """The columns of a query as rows. Only the schema is analysed."""
    names = [f.name for f in DESCRIBE_SCHEMA.fields]
    rows = [tuple(getattr(c, n) for n in names) for c in columns_of(df, **kwargs)]
    return df.sparkSession.createDataFrame(rows, DESCRIBE_SCHEMA)


def parse_column_specs(text: str) -> list[Column]:
    """Override list from JSON or YAML text."""
    try:
        items = json.loads(text)
    except json.JSONDecodeError:
        try:
            items = yaml.safe_load(text)
        except yaml.YAMLError as e:
            raise ValueError(f"columns are neither JSON nor YAML: {e}") from e
    return [column_spec(item) for item in items or []]


def column_spec(item: Mapping | Column) -> Column:
    if isinstance(item, Column):
        return item
    if not isinstance(item, Mapping):
        raise ValueError(f"a column override needs a name and settings: {item!r}")
    known = {f.name for f in fields(Column)}
    unknown = set(item) - known
    if unknown or not item.get("name"):
        raise ValueError(f"bad column override {dict(item)!r}")
    return Column(**{k: v for k, v in item.items() if v is not None})


def override_columns(columns: Iterable[Column], overrides: Iterable[Column | Mapping]) -> list[Column]:
    """Columns with the settings of same-named overrides; unknown names are ignored, order is kept.

    An override type may carry sizes, as in `NUMERIC(15,2)`.
    """
    wanted = {o.name.lower(): o for o in map(column_spec, overrides)}
    out = []
    for column in columns:
        o = wanted.get(column.name.lower())
        if o is None:
            out.append(column)
            continue
        changes = {k: getattr(o, k) for k in ("length", "position", "scale", "precision") if getattr(o, k)}
        if o.nullable is not None:
            changes["nullable"] = o.nullable
        if o.type:
            name, size, scale = parse_declared(o.type)
            changes["type"] = type_alias(name)
            if size and changes["type"] == "NUMERIC":
                changes = {"precision": size, "scale": scale, **changes}
            elif size:
                changes.setdefault("length", size)
        changed = replace(column, **changes)
        if o.type and changed.type == "NUMERIC" and changed.precision <= 0:
            raise ValueError(f"NUMERIC of column {column.name} needs a precision: its digits would be cut to those of a double")
        out.append(changed)
    return out


def check_unique(columns: Iterable[Column]) -> None:
    double = [n for n, k in Counter(c.name for c in columns).items() if k > 1]
    if double:
        raise ValueError(f"duplicate column names: {', '.join(sorted(double))}")


def conform(
    df: DataFrame,
    columns: list[Column],
    source_columns: list[Column] | None = None,
    on_error: str = "fail",
    strict_scale: bool = False,
    fix_uuids: bool = False,
) -> DataFrame:
    """One projection: every column of `df`, by position, converted to its canonical type.

    UUIDs become text, JSON text and nested values stay as they are; the canonical type goes
    into the field's metadata. `fix_uuids` reorders the bytes of binary UUID columns first.
    """
    check_unique(columns)
    source_columns = source_columns or columns_of(df)
    fields = df.schema.fields
    names = [f"_c{i}" for i in range(len(columns))]
    df = df.toDF(*names)
    picked, fixed = [], {}
    for name, field, source, target in zip(names, fields, source_columns, columns, strict=True):
        if fix_uuids and target.type == "UUID" and isinstance(field.dataType, T.BinaryType):
            fixed[name] = fix_sqlserver_uuid(F.col(name))
        value = cast_expr(name, field.dataType, target, source.type, on_error, strict_scale)
        picked.append(value.alias(target.name, metadata=column_metadata(target)))
    return df.withColumns(fixed).select(*picked) if fixed else df.select(*picked)


def normalise(
    df: DataFrame, source: str | None = None, declared: Mapping[str, str] | None = None, on_error: str = "fail"
) -> DataFrame:
    """Columns cast from what the source declares to canonical types."""
    columns = columns_of(df, source, declared)
    return conform(df, columns, columns_of(df), on_error, fix_uuids=source == "sqlserver")


def override(df: DataFrame, overrides: Iterable[Column | Mapping], on_error: str = "fail", strict_scale: bool = False) -> DataFrame:
    """Columns of `df` with the types of the overrides."""
    columns = columns_of(df)
    return conform(df, override_columns(columns, overrides), columns, on_error, strict_scale)


def column_metadata(column: Column) -> dict:
    """Name, type and length for readers of the output, and the field id that Parquet stores; of numbers kept as text also
    their sizes."""
    wide = {"precision": column.precision, "scale": column.scale} if column.type == "NUMERIC" and column.precision > DECIMAL_DIGITS else {}
    return {
        "name": column.name,
        "logical_type": column.type,
        "length": column.length,
        "parquet.field.id": column.position,
        **wide,
    }
