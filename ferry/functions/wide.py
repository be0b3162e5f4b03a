"""Numbers of any number of digits, as text: Spark's decimals end at 38."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NUMBER = r"^\s*([+-]?)([0-9]*)(?:\.([0-9]*))?(?:[eE]([+-]?[0-9]+))?\s*$"
#: Stands for powers of ten too large to be whole numbers: any number with one is far too large, or nothing.
FAR = 1 << 40


def _with(value: Column, use) -> Column:
    """`use` of a value that is computed once."""
    return F.transform(F.array(value), use)[0]


def number_parts(text: Column) -> Column:
    """A number's text as `struct(sign, digits, point, fraction, power)`; null if it is none.

    Its value is `0.<digits>` times ten to the `point`; digits have no zeros at either end, and are empty for zero.
    fraction: digits behind the point as written; power: whether it has an exponent.
    """
    def group(k: int) -> Column:
        return F.regexp_extract(text, NUMBER, k)

    given = F.struct(
        group(1).alias("sign"), group(2).alias("whole"), group(3).alias("fraction"), group(4).alias("power"),
        F.concat(group(2), group(3)).alias("body"),
    )

    def parts(g: Column) -> Column:
        digits = F.regexp_replace(g["body"], "^0+", "")
        far = F.when(F.startswith(g["power"], F.lit("-")), F.lit(-FAR)).otherwise(F.lit(FAR))
        power = F.when(g["power"] == "", F.lit(0).cast("long")).otherwise(F.coalesce(g["power"].try_cast("int").cast("long"), far))
        point = F.length(g["whole"]) + power - (F.length(g["body"]) - F.length(digits))
        return F.struct(
            (g["sign"] == "-").alias("negative"), F.regexp_replace(digits, "0+$", "").alias("digits"), point.alias("point"),
            F.length(g["fraction"]).alias("fraction"), (g["power"] != "").alias("power"),
        )

    return F.when(text.rlike(NUMBER) & text.rlike(r"^\s*[+-]?\.?[0-9]"), _with(given, parts))


def _one_more(digits: Column) -> Column:
    """A string of digits plus one; the empty one is zero."""
    head = F.regexp_replace(digits, "9+$", "")

    def grown(h: Column) -> Column:
        zeros = F.repeat(F.lit("0"), F.length(digits) - F.length(h))
        last = (F.right(h, F.lit(1)).cast("int") + 1).cast("string")
        return F.when(h == "", F.concat(F.lit("1"), zeros)).otherwise(F.concat(F.left(h, F.length(h) - 1), last, zeros))

    return _with(head, grown)


def to_wide_numeric(text: Column, precision: int, scale: int, on_error: str = "fail", strict_scale: bool = False) -> Column:
    """Text of a number as NUMERIC(precision, scale) writes it: all of the scale's digits, rounded half away from zero.

    `1.5e3`, `+7`, `.5`, `5.` and white space around a number are read; the exponent may be of any size. What is no
    number or has too many digits before the point fails, or is null or zero. With strict_scale more digits behind the
    point than the scale has are an error too. Null stays null.
    """
    if not 0 <= scale <= precision or precision < 1:
        raise ValueError(f"not a size of a number: NUMERIC({precision},{scale})")

    def rounded(p: Column) -> Column:
        keep = (p["point"] + scale).cast("int")
        up = F.substring(p["digits"], keep + 1, F.lit(1)) >= "5"
        kept = F.rpad(p["digits"], keep, "0")
        whole = F.when(up, _one_more(kept)).otherwise(kept)
        return F.when(p["digits"] == "", "").when(p["point"] > precision - scale, F.lit(None)).when(p["point"] < -scale, "").otherwise(whole)

    def written(p: Column) -> Column:
        def pointed(d: Column) -> Column:
            filled = F.lpad(d, F.greatest(F.length(d), F.lit(scale + 1)), "0")
            sign = F.when(p["negative"] & d.rlike("[1-9]"), "-").otherwise("")
            body = F.concat(F.left(filled, F.length(filled) - scale), F.lit("."), F.right(filled, F.lit(scale))) if scale else filled
            return F.when(F.length(d) <= precision, F.concat(sign, body))

        return _with(rounded(p), pointed)

    parts = number_parts(text)
    out = _with(parts, written)
    if strict_scale:
        def excess(p: Column) -> Column:
            return F.when(p["power"], (F.length(p["digits"]) - p["point"] > scale) & (p["digits"] != "")).otherwise(p["fraction"] > scale)

        problem = F.concat(F.lit(f"more than {scale} fraction digits: "), text)
        out = F.when(_with(parts, excess), F.raise_error(problem)).otherwise(out)
    if on_error == "fail":
        out = F.when(text.isNotNull(), F.coalesce(out, F.raise_error(F.concat(F.lit(f"not a NUMERIC({precision},{scale}): "), text)).cast("string")))
    elif on_error == "zero":
        out = F.when(text.isNotNull(), F.coalesce(out, F.lit("0" + ("." + "0" * scale if scale else ""))))
    return out
