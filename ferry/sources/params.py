"""Typed query parameters, bound in the order of their sorted keys."""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping
from dataclasses import dataclass
from datetime import date, datetime
from decimal import Decimal, InvalidOperation

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ferry.types import parse_declared, type_alias

_INTEGERS = {"SMALLINT": 16, "INTEGER": 32, "BIGINT": 64}
_TEXTS = ("TEXT", "VARCHAR", "UUID", "JSON", "JSONB")
_TRUE, _FALSE = ("true", "t", "1"), ("false", "f", "0")


@dataclass(frozen=True)
class Param:
    value: str
    type: str = "TEXT"


def make_param(item: Param | Mapping | str) -> Param:
    if isinstance(item, Param):
        return item
    if isinstance(item, Mapping):
        return Param(_text(item.get("value", "")), str(item.get("type") or "TEXT"))
    return Param(_text(item))


def _text(value: object) -> str:
    return str(value).lower() if isinstance(value, bool) else str(value)


def overlay_params(params: Mapping[str, Param], env: Mapping[str, str], prefix: str) -> dict[str, Param]:
    """Params with values from `<prefix><key>` environment variables; new keys are text."""
    out = dict(params)
    for name, value in env.items():
        if name.startswith(prefix) and len(name) > len(prefix):
            key = name[len(prefix):]
            out[key] = Param(value, out[key].type if key in out else "TEXT")
    return out


def typed_value(param: Param) -> object:
    """Python value of a parameter; an unknown type or a value that does not fit it is an error."""
    kind = type_alias(parse_declared(param.type or "TEXT")[0])
    text = param.value
    try:
        if kind in _TEXTS:
            return text
        if kind in _INTEGERS:
            number = int(text)
            if not -(1 << _INTEGERS[kind] - 1) <= number < 1 << _INTEGERS[kind] - 1:
                raise ValueError("out of range")
            return number
        if kind == "BOOLEAN":
            if text.lower() not in _TRUE + _FALSE:
                raise ValueError("not a boolean")
            return text.lower() in _TRUE
        if kind in ("REAL", "DOUBLE"):
            return float(text)
        if kind == "NUMERIC":
            return Decimal(text)
        if kind == "DATE":
            return date.fromisoformat(text)
        if kind == "TIMESTAMP":
            moment = datetime.fromisoformat(text)
            if moment.tzinfo is not None:
                raise ValueError("has a time zone")
            return moment
        if kind == "TIMESTAMPTZ":
            moment = datetime.fromisoformat(text)
            if moment.tzinfo is None:
                raise ValueError("has no time zone")
            return moment
    except (ValueError, InvalidOperation) as e:
        raise ValueError(f"parameter value {text!r} is not {kind}: {e}") from e
    raise ValueError(f"unsupported parameter type: {param.type!r}")


def spark_literal(value: object) -> Column:
    if isinstance(value, datetime):
        return F.expr(f"{'TIMESTAMP' if value.tzinfo else 'TIMESTAMP_NTZ'}'{value.isoformat(sep=' ')}'")
    if isinstance(value, date):
        return F.expr(f"DATE'{value.isoformat()}'")
    return F.lit(value)


def jdbc_literal(value: object, dialect: str) -> str:
    """Literal text for databases whose reader cannot bind values."""
    if isinstance(value, bool):
        return str(int(value)) if dialect == "sqlserver" else str(value).upper()
    if isinstance(value, (int, Decimal, float)):
        number = Decimal(str(value))
        if not number.is_finite():
            raise ValueError(f"not a finite number: {value}")
        if isinstance(value, float):  # as a floating-point literal: written out, a large one has hundreds of digits
            return f"{value!r}" if "e" in repr(value) else f"{value!r}E0"
        return f"{number:f}"
    if isinstance(value, (datetime, date)):
        return f"'{value.isoformat()}'"
    if "\x00" in str(value):
        raise ValueError("text parameter holds a NUL character")
    quoted = str(value).replace("'", "''")
    if dialect in ("snowflake", "spark"):
        quoted = quoted.replace("\\", "\\\\")
    return ("N'" if dialect == "sqlserver" else "'") + quoted + "'"


def _replace_markers(sql: str, keys: list[str], dialect: str, put: Callable[[int], str]) -> str:
    """Replace `$n`, `@name`, `:name` and `?` markers outside of quotes and comments."""
    backslash = r"\\.|" if dialect in ("spark", "snowflake") else ""
    skipped = [rf"'(?:{backslash}''|[^'{backslash and chr(92) * 2}])*'", r'"[^"]*"', "`[^`]*`", r"--[^\n]*", r"/\*.*?\*/", "::", "@@"]
    if dialect == "postgres":
        skipped.append(r"\$(?P<tag>[A-Za-z_]*)\$.*?\$(?P=tag)\$")
    positional = r"|(?P<next>\?)" if dialect != "postgres" else ""
    markers = re.compile(
        f"(?P<skip>{'|'.join(skipped)})|" + r"\$(?P<number>\d+)|(?<!\w)[@:](?P<name>[A-Za-z_]\w*)" + positional, re.S
    )
    index = {key: i for i, key in enumerate(keys)}
    seen = 0

    def one(m: re.Match) -> str:
        nonlocal seen
        if m["skip"] is not None:
            return m[0]
        if m["name"] is not None:
            return put(index[m["name"]]) if m["name"] in index else m[0]
        if m["number"] is not None:
            at = int(m["number"]) - 1
        else:
            at, seen = seen, seen + 1
        if not 0 <= at < len(keys):
            raise ValueError(f"no parameter for {m[0]} (number {at + 1} of {len(keys)})")
        return put(at)

    return markers.sub(one, sql)


def run_sql(spark: SparkSession, sql: str, params: Mapping[str, Param] | None = None) -> DataFrame:
    """`spark.sql` with the parameters bound as typed literals."""
    keys = sorted(params or {})
    if not keys:
        return spark.sql(sql)
    bound = _replace_markers(sql, keys, "spark", lambda i: f":ferry_{i}")
    return spark.sql(bound, args={f"ferry_{i}": spark_literal(typed_value(params[k])) for i, k in enumerate(keys)})


def inline_params(sql: str, params: Mapping[str, Param] | None, dialect: str) -> str:
    """SQL text with the parameters written in as literals of the database."""
    keys = sorted(params or {})
    literals = [jdbc_literal(typed_value(params[k]), dialect) for k in keys]
    return _replace_markers(sql, keys, dialect, literals.__getitem__) if keys else sql
