"""Decimal text and decimal conversion."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _fraction(text: Column) -> Column:
    return F.split_part(text, F.lit("."), F.lit(2))


def decimal_unscaled(text: Column, scale: int) -> Column:
    """Decimal text as the integer it is times 10^scale, e.g. `123.4` at scale 2 -> 12340.

    Fails on empty text, a second point, anything but digits, and more fraction digits
    than the scale holds.
    """
    negative = F.startswith(text, F.lit("-"))
    body = F.when(negative, F.substr(text, F.lit(2))).otherwise(text)
    fraction = _fraction(body)
    whole = F.split_part(body, F.lit("."), F.lit(1))
    digits = F.concat(whole, F.rpad(fraction, scale, "0"))
    good = body.rlike(r"^(?:[0-9]+\.?[0-9]*|\.[0-9]+)$") & (F.length(fraction) <= scale)
    value = F.concat(F.when(negative, F.lit("-")).otherwise(F.lit("")), digits).cast("decimal(38,0)")
    return (
        F.when(text.isNull(), F.lit(None))
        .when(good, value)
        .otherwise(F.raise_error(F.concat(F.lit(f"not a decimal with at most {scale} fraction digits: "), text)))
    )


def decimal_size(precision: int) -> int:
    """Bytes that a number of so many digits takes, with its sign."""
    return -(-((10**precision - 1).bit_length() + 1) // 8)


def unscaled_bytes(value: Column, size: int) -> Column:
    """A whole number, `decimal(38,0)` or narrower, as big-endian two's complement of so many bytes (16 at most). One that
    needs more is an error.

    A negative number is the complement of the one below its amount, so both are made of the same limbs: the upper 64
    bits and two of 32 below them, each a bigint, all turned over for a negative one.
    """
    if not 1 <= size <= 16:
        raise ValueError(f"a decimal takes 1 to 16 bytes: {size}")
    value = value.cast("decimal(38,0)")
    negative = value < 0
    # by subtraction: Spark's unary minus keeps 34 digits only
    amount = F.when(negative, (F.lit(-1).cast("decimal(38,0)") - value).cast("decimal(38,0)")).otherwise(value)
    turned = F.when(negative, F.lit(-1).cast("long")).otherwise(F.lit(0).cast("long"))
    upper, middle = F.expr(f"{1 << 64}BD"), F.expr(f"{1 << 32}BD")
    low = amount % upper
    halves = [F.call_function("div", low, middle), (low % middle).cast("long")]
    digits = F.concat(
        F.lpad(F.hex(F.call_function("div", amount, upper).bitwiseXOR(turned)), 16, "0"),
        *(F.lpad(F.hex(x.bitwiseXOR(turned.bitwiseAND(F.lit((1 << 32) - 1)))), 8, "0") for x in halves),
    )
    made = F.unhex(F.right(digits, F.lit(2 * size)))
    if size == 16:
        return made
    problem = F.raise_error(F.concat(value.cast("string"), F.lit(f" does not fit {size} bytes"))).cast("binary")
    return F.when(amount >= F.expr(f"{1 << 8 * size - 1}BD"), problem).otherwise(made)


def decimal_bytes(c: Column, dtype: T.DecimalType) -> Column:
    """A decimal's unscaled value in the bytes that its precision takes, as columnar files store it."""
    size = decimal_size(dtype.precision)
    if dtype.precision <= 18:  # a bigint, whose bytes are there already
        unscaled = (c.cast(dtype) * F.expr(f"{10**dtype.scale}BD")).cast("bigint")
        return F.unhex(F.right(F.lpad(F.hex(unscaled), 16, "0"), F.lit(2 * size)))
    digits = F.replace(F.split_part(c.cast("string"), F.lit("E"), F.lit(1)), F.lit("."), F.lit(""))
    return unscaled_bytes(digits.cast("decimal(38,0)"), size)


def to_numeric(c: Column, dtype: T.DataType, target: T.DecimalType, on_error: str = "fail", strict_scale: bool = False) -> Column:
    """Value as decimal(p,s), rounded half up.

    Floats go through their text, so that 473274.17 stays 473274.17. With strict_scale, text
    with more fraction digits than the scale is an error instead of being rounded.
    """
    if isinstance(dtype, T.BinaryType):
        c, dtype = c.cast("string"), T.StringType()
    source = c.cast("string") if isinstance(dtype, (T.FloatType, T.DoubleType)) else c
    out = source.cast(target) if on_error == "fail" else source.try_cast(target)
    if on_error == "zero":
        out = F.when(c.isNull(), F.lit(None)).otherwise(F.coalesce(out, F.lit(0).cast(target)))
    if strict_scale and isinstance(dtype, T.StringType):
        text = F.lower(F.trim(c))
        power = F.coalesce(F.split_part(text, F.lit("e"), F.lit(2)).try_cast("int"), F.lit(0))
        digits = F.rtrim(F.split_part(text, F.lit("e"), F.lit(1)))
        has_power = F.contains(text, F.lit("e"))
        significant = F.when(has_power, F.length(F.regexp_replace(_fraction(digits), "0+$", ""))).otherwise(F.length(_fraction(digits)))
        whole_zeros = F.when(has_power & (_fraction(digits).rlike("^0*$")), F.length(F.regexp_extract(F.split_part(digits, F.lit("."), F.lit(1)), "0*$", 0))).otherwise(0)
        too_long = significant - power - whole_zeros > target.scale
        message = F.concat(F.lit(f"more than {target.scale} fraction digits: "), c)
        out = F.when(too_long, F.raise_error(message)).otherwise(out)
    return out
