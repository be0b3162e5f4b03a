"""Ranges of one column that parallel readers fetch side by side."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable
from datetime import date, datetime, timedelta
from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Sampled rows per part from which cut points of text are taken, and characters of a cut point.
SAMPLED, CUT_LENGTH = 1024, 256


def range_predicates(column: str, low: object, high: object, parts: int, literal: Callable[[object], str] = str) -> list[str]:
    """Conditions that part [low, high] into equal strides.

    Every row meets exactly one: NULLs and anything below go to the first, anything above to the last.
    """
    if parts < 1:
        raise ValueError("parts must be at least 1")
    if low is None or high is None or low >= high or parts == 1:
        return ["1 = 1"]
    if isinstance(low, str):
        raise ValueError(f"text has no equal strides: split {column} by hash, or by modulo of a number made from it")
    if isinstance(low, float):
        high = min(high, 1.7e308) if high == high else low  # NaN and infinity go to the last part
        if not math.isfinite(low) or not low < high:
            return ["1 = 1"]
    width = None if isinstance(low, float) else high - low
    if isinstance(low, datetime):
        cuts = [low + timedelta(microseconds=(width // timedelta(microseconds=1)) * i // parts) for i in range(1, parts)]
    elif isinstance(low, date):
        cuts = [low + timedelta(days=width.days * i // parts) for i in range(1, parts)]
    elif isinstance(low, float):
        cuts = [low * (1 - i / parts) + high * (i / parts) for i in range(1, parts)]
    elif isinstance(low, Decimal):
        cuts = [low + width * i / parts for i in range(1, parts)]
    else:
        cuts = [low + width * i // parts for i in range(1, parts)]
    cuts = [literal(c) for c in sorted({c for c in cuts if c > low})]
    if not cuts:
        return ["1 = 1"]
    middle = [f"{column} >= {a} AND {column} < {b}" for a, b in zip(cuts, cuts[1:])]
    return [f"{column} < {cuts[0]} OR {column} IS NULL", *middle, f"{column} >= {cuts[-1]}"]


def depth_predicates(column: str, cuts: list, literal: Callable[[object], str] = str) -> list[str]:
    """Conditions that part a column at its quantiles, given in any order, into parts of about as many rows each.

    Every row meets exactly one; NULLs go to the first. A value that is several quantiles fills more than a part: it gets
    one of its own.
    """
    times = Counter(c for c in cuts if c is not None and c == c)
    ends = []  # where parts meet: before a value, and after it if it has its own
    for value in sorted(times):
        ends.append((">=", "<", literal(value)))
        if times[value] > 1 and not (isinstance(value, str) and len(value) >= CUT_LENGTH):
            ends.append((">", "<=", literal(value)))
    if not ends:
        return ["1 = 1"]
    middle = [f"{column} {a} {x} AND {column} {b} {y}" for (a, _, x), (_, b, y) in zip(ends, ends[1:])]
    return [f"{column} {ends[0][1]} {ends[0][2]} OR {column} IS NULL", *middle, f"{column} {ends[-1][0]} {ends[-1][2]}"]


def depth_query(dialect: str, column: str, parts: int, table: str) -> str:
    """Statement that answers with one row of the quantiles that part a column into so many parts. The database sorts the
    column for it once; values are compared there, so its collation holds for quantiles and conditions alike."""
    over, distinct = (" OVER ()", "DISTINCT ") if dialect == "sqlserver" else ("", "")
    each = ", ".join(
        f"PERCENTILE_DISC({i / parts!r}) WITHIN GROUP (ORDER BY {column}){over} AS c{i}" for i in range(1, parts)
    )
    return f"SELECT {distinct}{each} FROM {table}"


def cut_points(df: DataFrame, column: str, parts: int, sampled: int = SAMPLED, seed: int = 17) -> list:
    """Quantiles that part a column of a DataFrame into so many parts.

    Of numbers and times by Spark's approximate quantiles, one aggregate pass whose partial results stay small. Of text
    from a sample of rows, so many per part whatever the table's size: only as many of the smallest random numbers and
    the first characters of their texts reach the driver. A part is then within a tenth of its share, nearly always.
    """
    kind = df.select(column).schema[0].dataType
    if parts <= 1:
        return []
    if not isinstance(kind, T.StringType):
        shares = [i / parts for i in range(1, parts)]
        row = df.agg(F.percentile_approx(column, shares, 100 * max(100, parts)).alias("cuts")).first()
        return list(row.cuts or [])
    some = df.select(F.substring(column, 1, CUT_LENGTH).alias("v")).filter("v IS NOT NULL")
    values = sorted(r.v for r in some.orderBy(F.rand(seed)).limit(parts * sampled).collect())
    return [values[len(values) * i // parts] for i in range(1, parts)] if values else []


def modulo_predicates(column: str, parts: int, remainder: str = "MOD({}, {})") -> list[str]:
    """Conditions by remainder, for integer keys whose values crowd in some ranges."""
    if parts <= 1:
        return ["1 = 1"]
    rest = f"ABS({remainder.format(column, parts)})"
    return [f"{rest} = {i}" + (f" OR {column} IS NULL" if i == 0 else "") for i in range(parts)]


def hash_predicates(column: str, parts: int, hashed: str) -> list[str]:
    """Conditions by the remainder of a hash, for keys of any type; `hashed` makes a number of 0 or more of the column. NULLs go to the first."""
    if parts <= 1:
        return ["1 = 1"]
    rest = f"CASE WHEN {column} IS NULL THEN 0 ELSE {hashed.format(column, parts)} END"
    return [f"({rest}) = {i}" for i in range(parts)]


def bounds(df: DataFrame, column: str) -> tuple[object, object]:
    """Lowest and highest value, by one aggregate pass."""
    row = df.agg(F.min(column).alias("low"), F.max(column).alias("high")).first()
    return row["low"], row["high"]


def split_sizes(df: DataFrame, predicates: list[str]) -> DataFrame:
    """Rows that each reader would fetch, to see a crowded range before a long read. One pass."""
    counts = [F.count_if(F.expr(p)).alias(f"p{i}") for i, p in enumerate(predicates)]
    lines = [
        F.struct(F.lit(i).alias("split"), F.lit(p).alias("predicate"), F.col(f"p{i}").alias("rows"))
        for i, p in enumerate(predicates)
    ]
    return df.agg(*counts).select(F.inline(F.array(*lines)))
