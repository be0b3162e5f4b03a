"""Column facts measured from the data, for sources that declare none."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ferry.functions.render import render_text
from ferry.functions.wide import number_parts
from ferry.operators.lines import typed_columns


def measure_columns(df: DataFrame, numbers: bool = False) -> DataFrame:
    """One row per column: name, type, rows, nulls and longest text.

    With `numbers` also how many values of a number or text column are numbers, and the `precision, scale` of the smallest
    NUMERIC that holds these exactly (null where there are none): what to state in an override of a column whose source
    gives no sizes. Exponents count by what they stand for; zeros at either end do not count. A column fits if all that is
    not null is a number. NaN, infinity and times are none.

    One aggregate pass with partial sums on every task; only its single row is turned into lines.
    """
    columns = typed_columns(df)
    if numbers:  # what is read off a number is found once, in projections of their own
        plain = df.sparkSession.conf.get("spark.sql.ansi.enabled") == "true"  # else small decimals have exponents
        read = {}
        for i, (c, dtype, logical, _) in enumerate(columns):
            if _countable(dtype):
                text = F.expr(render_text(c, dtype, logical))
                read[f"p{i}"] = text if _written_out(dtype, plain) else number_parts(text)
        df = df.select(*(F.col(c).alias(f"c{i}") for i, (c, *_) in enumerate(columns)), *(e.alias(n) for n, e in read.items()))
    aggregates, lines = [F.count(F.lit(1)).alias("rows")], []
    for i, (c, dtype, logical, name) in enumerate(columns):
        c, text = F.col(f"c{i}" if numbers else c), isinstance(dtype, T.StringType)
        longest = F.max(F.length(c)) if text else F.lit(None).cast("int")
        aggregates += [F.count(c).alias(f"n{i}"), longest.alias(f"l{i}")]
        line = [
            F.lit(name).alias("name"),
            F.lit(logical).alias("type"),
            F.lit(i).alias("position"),
            F.col("rows").alias("rows"),
            (F.col("rows") - F.col(f"n{i}")).alias("nulls"),
            F.col(f"l{i}").cast("long").alias("max_length"),
        ]
        if numbers:
            aggregates += _digits(i, dtype, plain) if _countable(dtype) else [F.lit(None).cast("long").alias(f"{n}{i}") for n in "kwf"]
            found = F.col(f"k{i}") > 0
            line += [
                F.col(f"k{i}").alias("numbers"),
                F.when(found, F.greatest(F.col(f"w{i}") + F.col(f"f{i}"), F.lit(1).cast("long"))).alias("precision"),
                F.when(found, F.col(f"f{i}")).alias("scale"),
            ]
        lines.append(F.struct(*line))
    return df.agg(*aggregates).select(F.inline(F.array(*lines)))


def _countable(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.NumericType, T.StringType))


def _written_out(dtype: T.DataType, plain: bool) -> bool:
    """Whether a type's texts are digits and a point alone (or no numbers at all)."""
    return isinstance(dtype, T.NumericType) and (plain or not isinstance(dtype, T.DecimalType))


def _digits(i: int, dtype: T.DataType, plain: bool) -> list[Column]:
    """Numbers, most digits before and most behind the point."""
    p, zero = F.col(f"p{i}"), F.lit(0).cast("long")
    if _written_out(dtype, plain):
        body = F.replace(p, F.lit("-"), F.lit(""))
        number = p if isinstance(dtype, (T.IntegralType, T.DecimalType)) else F.when(~p.isin("NaN", "+Inf", "-Inf"), p)
        before = F.length(F.ltrim(F.split_part(body, F.lit("."), F.lit(1)), F.lit("0")))
        behind = F.length(F.rtrim(F.split_part(body, F.lit("."), F.lit(2)), F.lit("0")))
        before, behind = (F.when(number.isNotNull(), n.cast("long")).otherwise(zero) for n in (before, behind))
    else:
        number, some = p, p["digits"] != ""
        before = F.when(some, F.greatest(p["point"], zero)).otherwise(zero)
        behind = F.when(some, F.greatest(F.length(p["digits"]) - p["point"], zero)).otherwise(zero)
    return [F.count(number).alias(f"k{i}"), F.max(before).alias(f"w{i}"), F.max(behind).alias(f"f{i}")]
