"""Text forms of values, as SQL expressions: what CSV fields and text columns hold."""

from __future__ import annotations

from pyspark.sql import types as T

from ferry.functions import jsontext
from ferry.functions.uuids import uuid_text
from ferry.types import JSON_TYPES, is_nested


def render_timestamp(c: str) -> str:
    """Wall-clock time as `yyyy-MM-ddTHH:mm:ss[.ffffff]`, trailing zeros of the fraction cut."""
    return f"replace(cast({c} AS string), ' ', 'T')"


def render_timestamptz(c: str) -> str:
    """Instant in the session time zone, followed by `Z` or `+hh:mm`."""
    return f"concat({render_timestamp(c)}, date_format({c}, 'XXX'))"


def render_float(c: str, dtype: T.DataType, exact: bool = False) -> str:
    """Shortest digits that give the same float back, never an exponent; `1.0` -> `1`.

    Of several texts as short, doubles below 1e-6 and from 9.2e18 on have the one that Java gives, which before Java 19 may
    have a digit too many or be off by one in the last; with `exact` they have the shortest and nearest, by all digits of
    the double. That expression is large: it is for single columns, as hundreds of it do not fit a task's memory.
    """
    plain = common_float(c, dtype, moved_point("s"))
    if not exact or not isinstance(dtype, T.DoubleType):
        return plain
    extreme = f"({c} <> 0 AND abs({c}) < 1e-6D OR abs({c}) >= 9.2e18D AND abs({c}) < double('Infinity'))"
    rest = jsontext.rarely(f"struct({c} AS x, cast({c} AS string) AS java)", "v", jsontext.rarely(_extreme("v"), "s", moved_point("s")))
    return f"CASE WHEN {extreme} THEN {rest} ELSE {plain} END"


def common_float(c: str, dtype: T.DataType, other: str) -> str:
    """Plain digits of most floats; `other` makes the text of the rest from their Java text `s`.

    Whole numbers are written as integers, up to where a float still holds every integer; past that
    only the digits that count. Java text is plain between 1e-3 and 1e7, and that of the exact decimal is up to 2^53.
    """
    double = isinstance(dtype, T.DoubleType)
    whole = 1 << (53 if double else 24)
    kind = dtype.simpleString()
    # `-1.25E-4` -> `-0.000125`: sign, zeros by size, digits.
    zeros = " ".join(f"WHEN abs({c}) >= cast(1e-{n}D AS {kind}) THEN '{'0' * (n - 1)}'" for n in (4, 5))
    digits = f"replace(substring_index(cast(abs({c}) AS string), 'E', 1), '.', '')"
    small = f"concat(if({c} < 0, '-0.', '0.'), CASE {zeros} ELSE '00000' END, trim(TRAILING '0' FROM {digits}))"
    other_plain = f"WHEN abs({c}) >= 1e-6D AND abs({c}) < cast(0.001D AS {kind}) THEN {small}"
    if double:
        other_plain += f"""
        WHEN abs({c}) >= 1e7D AND abs({c}) < {whole}D
        THEN trim(TRAILING '0' FROM cast(cast({c} AS decimal(30,10)) AS string))
        WHEN abs({c}) >= {whole}D AND abs({c}) < 9.2e18D THEN {jsontext.rarely(f"cast({c} AS bigint)", 'b', _rounded_whole())}"""
    return f"""CASE
        WHEN {c} = 0 THEN substring_index(cast({c} AS string), '.', 1)
        WHEN abs({c}) < {whole}D AND rint({c}) = {c} THEN cast(cast({c} AS bigint) AS string)
        WHEN abs({c}) >= cast(0.001D AS {kind}) AND abs({c}) < 1e7D THEN cast({c} AS string)
        {other_plain}
        WHEN {c} IS NOT NULL THEN {jsontext.rarely(c, 'x', jsontext.rarely(_shortest('x', dtype), 's', other))} END"""


def _rounded_whole() -> str:
    """Text of a whole number `b` past 2^53 as its float needs it: the rest of its digits are zeros."""
    tries = ""
    for digits in (15, 16, 17):
        steps = "".join(f" WHEN abs(b) >= {10 ** (at - 1)} THEN round(b, {digits - at})" for at in (19, 18, 17, 16) if at > digits)
        rounded = f"CASE {steps} ELSE b END"
        tries += f" WHEN cast({rounded} AS double) = cast(b AS double) THEN cast({rounded} AS string)"
    return f"CASE {tries} ELSE cast(b AS string) END"


def _extreme(v: str) -> str:
    """Text like Java's (`1.5E20`) of the double in `v.x`, Java's text of which is `v.java`: before Java 19 that may have a
    digit too many, or a last one that is off by one. No two texts of 15 digits or fewer are the same double of full
    precision, so such a text is the shortest there is."""
    few = f"length(translate(substring_index({v}.java, 'E', 1), '-.', '')) <= 15 AND abs({v}.x) >= 2.3e-308D"
    kept = f"NOT contains({v}.java, 'E') OR {few}"  # NaN and infinity have no exponent
    return f"if({kept}, {v}.java, concat(if({v}.x < 0, '-', ''), {jsontext.rarely(f'abs({v}.x)', 'x', _nearest('x'))}))"


def _exact_digits(x: str) -> str:
    """`struct(w, shift)`: a positive double is the whole number whose digits are `w`, times ten to the `shift`, exactly.

    Its bits as a bigint `m` times 2 to the `e` are, if `e` is negative, `m` times 5 to the `-e` by as many tens. The product
    is made in limbs of nine digits. `e` comes from a logarithm that may be one too high, so `m` has a bit to spare.
    """
    limb, steps = 10**9, {2: 29, 5: 12}  # a limb times one of these powers stays below 2^63
    times = f"""aggregate(l, struct(cast(array() AS array<bigint>) AS done, 0L AS carry), (a, d) -> struct(
            concat(a.done, array((d * f + a.carry) % {limb}L)) AS done, (d * f + a.carry) div {limb}L AS carry),
        a -> if(a.carry > 0, concat(a.done, array(a.carry)), a.done))"""

    def powers(base: int, e: str) -> str:
        most = steps[base]
        return f"concat(array_repeat({base**most}L, cast({e} div {most} AS int)), array(cast(round(pow({base}D, {e} % {most})) AS bigint)))"

    factors = f"if(p.e < 0, {powers(5, 'abs(p.e)')}, {powers(2, 'abs(p.e)')})"
    limbs = f"aggregate({factors}, array(p.m % {limb}L, p.m div {limb}L % {limb}L, p.m div {limb * limb}L), (l, f) -> {times})"
    digits = f"ltrim('0', array_join(transform(reverse({limbs}), d -> lpad(cast(d AS string), 9, '0')), ''))"
    # 2 to the 1074 makes any double whole; in two steps, as one alone may be no double
    scaled = f"cast({x} / pow(2D, e div 2) / pow(2D, e - e div 2) AS bigint)"
    bits = jsontext.rarely(f"greatest(cast(floor(log2({x})) AS int) - 53, -1074)", "e", f"struct(e AS e, {scaled} AS m)")
    return jsontext.rarely(bits, "p", f"struct({digits} AS w, least(p.e, 0) AS shift)")


def _nearest(x: str) -> str:
    """The fewest digits that read back as a positive double, and of those the ones nearest to it, as Java writes them. For
    each number of digits they are the exact digits cut there, or the ones above these."""
    rest, half = "substr(q.w, k + 1)", "rpad('5', length(q.w) - k, '0')"
    cut, power = "cast(left(q.w, k) AS bigint)", "length(q.w) - k + q.shift"
    nearer_above = f"({rest} > {half} OR {rest} = {half} AND {cut} % 2 = 1)"  # of two that are as near, the even one
    pair = f"array(concat({cut}, 'E', {power}), concat({cut} + 1, 'E', {power}))"
    tried = jsontext.rarely(pair, "b", f"filter(if({nearer_above}, reverse(b), b), t -> cast(t AS double) = {x})")
    found = f"get(filter(transform(sequence(1, least(17, length(q.w))), k -> get({tried}, 0)), t -> t IS NOT NULL), 0)"
    power = "length(substring_index(t, 'E', 1)) - 1 + cast(substring_index(t, 'E', -1) AS int)"
    # digits of which the last became 10 end in zeros
    shown = f"concat(left(t, 1), '.', if(d = '', '0', d), 'E', {power})"
    shown = jsontext.rarely("trim(TRAILING '0' FROM substr(substring_index(t, 'E', 1), 2))", "d", shown)
    return jsontext.rarely(_exact_digits(x), "q", jsontext.rarely(found, "t", shown))


def _shortest(x: str, dtype: T.DataType) -> str:
    """Java text of a float.

    Java before 19 may print a digit too many for large ones, so the shortest of the rounded
    forms that read back equal wins.
    """
    kind = dtype.simpleString()
    tries = ""
    for digits in (14, 15, 16) if kind == "double" else (5, 6, 7, 8):
        rounded = f"format_string('%.{digits}e', {x})"
        # `2.000000000000000e+23` -> `2.0E23`
        mantissa = rf"regexp_replace(substring_index({rounded}, 'e', 1), r'(\.[0-9]+?)0+$', '$1')"
        text = f"concat({mantissa}, 'E', cast(cast(substring_index({rounded}, 'e', -1) AS int) AS string))"
        tries += f" WHEN try_cast({rounded} AS {kind}) = {x} THEN {text}"
    large = f"abs({x}) >= 1e7D AND abs({x}) < double('Infinity')"
    return f"CASE WHEN {large} THEN CASE {tries} ELSE cast({x} AS string) END ELSE cast({x} AS string) END"


def moved_point(s: str) -> str:
    """`-1.25E-4` -> `-0.000125`, `1.0E23` -> `100000000000000000000000`.

    Digits never reach past the point here: floats this large are whole.
    """
    digits = f"replace(replace(substring_index({s}, 'E', 1), '-', ''), '.', '')"
    parts = f"""struct(if(startswith({s}, '-'), '-', '') AS sign, trim(TRAILING '0' FROM {digits}) AS digits,
        try_cast(substring_index({s}, 'E', -1) AS int) AS exponent)"""
    joined = """concat(p.sign, if(p.exponent < 0, concat('0.', repeat('0', -p.exponent - 1), p.digits),
        rpad(p.digits, p.exponent + 1, '0')))"""
    return f"""CASE {s} WHEN 'Infinity' THEN '+Inf' WHEN '-Infinity' THEN '-Inf' WHEN 'NaN' THEN {s}
        ELSE {jsontext.rarely(parts, 'p', joined)} END"""


def is_json(dtype: T.DataType, logical: str) -> bool:
    return logical in JSON_TYPES or is_nested(dtype)


def may_need_escape(dtype: T.DataType, logical: str) -> bool:
    """Values other than numbers, times, booleans and UUIDs."""
    return is_json(dtype, logical) or isinstance(dtype, (T.StringType, T.BinaryType)) and logical != "UUID"


def render_text(c: str, dtype: T.DataType, logical: str = "") -> str:
    """Text of any value by its Spark type and canonical type; NULL stays NULL. JSON is not yet `html_safe`."""
    if is_json(dtype, logical):
        return jsontext.json_text(c, dtype)
    if logical == "UUID" and isinstance(dtype, T.BinaryType):
        return uuid_text(c)
    if isinstance(dtype, T.TimestampNTZType):
        return render_timestamp(c)
    if isinstance(dtype, T.TimestampType):
        return render_timestamptz(c)
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return render_float(c, dtype)
    return c if isinstance(dtype, T.StringType) else f"cast({c} AS string)"


def csv_field(text: str, dtype: T.DataType, logical: str = "", null_value: str = "NULL") -> str:
    """CSV field of a rendered value.

    Quoted where it holds a comma, quote or line break, starts with white space, or is `\\.`.
    """
    if may_need_escape(dtype, logical):
        needs = rf"""{text} RLIKE r'[,"\r\n]|^\p{{IsWhite_Space}}|^\\\.$'"""
        text = f"""CASE WHEN {needs} THEN concat('"', replace({text}, '"', '""'), '"') ELSE {text} END"""
    return f"coalesce({text}, {jsontext.literal(null_value)})"
