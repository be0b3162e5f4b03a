"""Conversion of a value to a canonical type, as one Catalyst expression per column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ferry.functions.decimals import to_numeric
from ferry.functions.jsontext import html_safe, json_value
from ferry.functions.render import is_json, render_text
from ferry.functions.uuids import to_uuid
from ferry.functions.wide import to_wide_numeric
from ferry.types import JSON_TYPES, is_nested, spark_type
from ferry.types import Column as ColumnSpec

ON_ERROR = ("fail", "null", "zero")
_ZERO = (T.BooleanType, T.IntegralType, T.FloatType, T.DoubleType)


def plain_cast(c: Column, target: T.DataType, on_error: str = "fail") -> Column:
    """ANSI cast, or NULL / zero where the value does not convert. NULL stays NULL."""
    if on_error == "fail":
        return c.cast(target)
    tried = c.try_cast(target)
    if on_error == "zero" and isinstance(target, _ZERO):
        return F.when(c.isNull(), F.lit(None)).otherwise(F.coalesce(tried, F.lit(0).cast(target)))
    return tried


def cast_expr(
    name: str,
    dtype: T.DataType,
    target: ColumnSpec,
    source_type: str = "",
    on_error: str = "fail",
    strict_scale: bool = False,
) -> Column:
    """Column `name` of Spark type `dtype` (canonical `source_type`) as the canonical type of `target`."""
    if on_error not in ON_ERROR:
        raise ValueError(f"on_error must be one of {ON_ERROR}: {on_error!r}")
    wanted = spark_type(target)
    c = F.col(name)
    if target.type in JSON_TYPES:
        if is_nested(dtype) or isinstance(dtype, T.StringType):
            return c
        return F.when(c.isNotNull(), F.expr(html_safe(json_value(name, dtype))))
    if target.type == "UUID":
        return to_uuid(c, dtype, on_error, target.name)
    if target.type == "NUMERIC" and isinstance(wanted, T.StringType):
        if is_nested(dtype):
            raise TypeError(f"cannot convert {dtype.simpleString()} to {target.type} (column {target.name})")
        text = c.cast("string") if isinstance(dtype, (T.StringType, T.BinaryType)) else F.expr(render_text(name, dtype, source_type))
        return to_wide_numeric(text, target.precision, target.scale, on_error, strict_scale)
    if isinstance(wanted, T.StringType):
        if isinstance(dtype, T.StringType) or isinstance(dtype, T.BinaryType) and target.type == source_type:
            return c
        text = render_text(name, dtype, source_type)
        return F.expr(html_safe(text) if is_json(dtype, source_type) else text)
    if dtype == wanted:
        return c
    if is_nested(dtype):
        raise TypeError(f"cannot convert {dtype.simpleString()} to {target.type} (column {target.name})")
    if isinstance(wanted, T.DecimalType):
        return to_numeric(c, dtype, wanted, on_error, strict_scale)
    if isinstance(dtype, T.BinaryType):
        c, dtype = c.cast("string"), T.StringType()
    return plain_cast(c, wanted, on_error)
