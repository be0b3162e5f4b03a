"""Rows as CSV and JSON lines, and URL redaction."""

from __future__ import annotations

from pyspark.sql import Column as SparkColumn
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ferry.functions.jsontext import html_safe, json_object, json_value, or_null, quoted_name
from ferry.functions.render import csv_field, is_json, may_need_escape, render_text
from ferry.operators.columns import check_unique, columns_of


def typed_columns(df: DataFrame) -> list[tuple[str, T.DataType, str, str]]:
    """(SQL name, Spark type, canonical type, plain name) of every column."""
    columns = columns_of(df)
    check_unique(columns)
    return [(quoted_name(c.name), f.dataType, c.type, c.name) for f, c in zip(df.schema.fields, columns)]


def rendered(df: DataFrame, leave_out: tuple[str, ...] = ()) -> DataFrame:
    """Every column as its text, in two projections so that JSON is written once and then escaped."""
    texts, safe = [], []
    for c, dtype, logical, name in typed_columns(df):
        kept = name in leave_out
        texts.append(c if kept else f"{render_text(c, dtype, logical)} AS {c}")
        safe.append(f"{html_safe(c)} AS {c}" if is_json(dtype, logical) and not kept else c)
    return df.selectExpr(*texts).selectExpr(*safe)


def csv_lines(df: DataFrame, null_value: str = "NULL") -> DataFrame:
    """One CSV line per row in column `value`, without header."""
    parts = [csv_field(c, dtype, logical, null_value) for c, dtype, logical, _ in typed_columns(df)]
    return rendered(df).selectExpr(f"concat_ws(',', {', '.join(parts)}) AS value")


def jsonl_lines(df: DataFrame, leave_out: tuple[str, ...] = ()) -> DataFrame:
    """One JSON object per row in column `value`, keys sorted; columns left out follow as they are.

    The values are written in a first projection, escaped and joined in a second: one projection
    would repeat the first one's work in the second's branches.
    """
    values, members, kept = [], [], []
    for c, dtype, logical, name in typed_columns(df):
        if name in leave_out:
            values.append(c)
            kept.append(c)
            continue
        value = json_value(c, dtype, logical)
        if may_need_escape(dtype, logical):
            value, member = f"coalesce({value}, 'null')", html_safe(c)
        else:
            member = or_null(c)
        values.append(f"{value} AS {c}")
        members.append((name, member))
    return df.selectExpr(*values).selectExpr(f"{json_object(members)} AS value", *kept)


def redact_url(url: SparkColumn) -> SparkColumn:
    """URL without user information and query."""
    no_user = F.regexp_replace(url, r"^([a-zA-Z][a-zA-Z0-9+.-]*://)[^/?#]*@", "$1")
    return F.regexp_replace(no_user, r"[?][^#]*", "")
