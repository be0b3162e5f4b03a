"""UUID values: 36-character text while in Spark, 16 bytes on request at a sink."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_GROUPS = r"([0-9a-f]{8})-([0-9a-f]{4})-([0-9a-f]{4})-([0-9a-f]{4})-([0-9a-f]{12})"
CANONICAL = f"^{_GROUPS}$"
# Fixed value: the accepted spellings (plain, URN, braces, no dashes), after lower().
UUID_TEXT = rf"^(?:(?:urn:uuid:)?{_GROUPS}|\{{{_GROUPS}\}}|[0-9a-f]{{32}})$"
_DIGITS = r"^(?:urn:uuid:|\{)?" + _GROUPS.replace("-(", "-?(") + r"\}?$"


def to_uuid(c: Column, dtype: T.DataType, on_error: str = "fail", name: str = "") -> Column:
    """Canonical lower-case text of a UUID given as text or 16 bytes; NULL stays NULL."""
    bad = F.lit(None).cast("string")
    if on_error == "fail":
        bad = F.raise_error(F.concat(F.lit(f"not a UUID in column {name}: "), c.cast("string")))
    none = F.when(c.isNull(), F.lit(None).cast("string"))
    if isinstance(dtype, T.BinaryType):
        text = F.regexp_replace(F.lower(F.hex(c)), _DIGITS, "$1-$2-$3-$4-$5")
        return none.when(F.octet_length(c) == 16, text).otherwise(bad)
    if isinstance(dtype, T.StringType):
        text = F.regexp_replace(F.lower(c), _DIGITS, "$1-$2-$3-$4-$5")
        return none.when(c.rlike(CANONICAL), c).when(F.lower(c).rlike(UUID_TEXT), text).otherwise(bad)
    raise TypeError(f"cannot read {dtype.simpleString()} as UUID (column {name})")


def uuid_text(c: str) -> str:
    """SQL expression of 16 bytes as text."""
    return f"regexp_replace(lower(hex({c})), r'{_DIGITS}', '$1-$2-$3-$4-$5')"


def uuid_bytes(c: Column) -> Column:
    """16 bytes of a canonical UUID text."""
    return F.unhex(F.replace(c, F.lit("-"), F.lit("")))


def fix_sqlserver_uuid(c: Column) -> Column:
    """Undo SQL Server's byte order (first three groups are little-endian).

    Values that are not 16 bytes long pass unchanged.
    """
    order = (4, 3, 2, 1, 6, 5, 8, 7)
    swapped = F.concat(*(F.substring(c, at, 1) for at in order), F.substring(c, 9, 8))
    return F.when(F.octet_length(c) == 16, swapped).otherwise(c)
