"""JSON text of values, as SQL expressions over SQL expressions.

Expressions are SQL text rather than Column calls: a wide table needs thousands of calls, each a
round trip to the JVM, where one parse per column does.
"""

from __future__ import annotations

import json

from pyspark.sql import types as T

from ferry.types import JSON_TYPES, is_nested

# Characters that JSON text shows by number.
ESCAPED = "<>&\u2028\u2029"


def quoted_name(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def literal(text: str) -> str:
    """SQL literal of a text, whatever the parser's setting for backslashes."""
    parts = [f"r'{part}'" for part in text.split("'")]
    return parts[0] if len(parts) == 1 else f"concat({', chr(39), '.join(parts)})"


def rarely(c: str, variable: str, expression: str) -> str:
    """`expression` of `c`, named `variable` in it, for branches that few rows take.

    A lambda over a one-element array is interpreted: it stays out of the generated code, which would
    otherwise grow past what the JVM compiles, and it computes `c` once.
    """
    return f"transform(array({c}), {variable} -> {expression})[0]"


def or_null(text: str) -> str:
    """Uses the text twice: where an earlier projection made it, Spark then keeps the two apart."""
    return f"CASE WHEN {text} IS NULL THEN 'null' ELSE {text} END"


def html_safe(text: str) -> str:
    """Escape `<`, `>`, `&`, U+2028 and U+2029, which only occur inside JSON strings; \\u00XX in lower case.

    Give it a column that an earlier projection computed, as it uses the text more than once.
    """
    lowered = "t"
    for letter in "ABCDEF":
        found, put = rf"(?<!\\)((?:\\\\)*)\\u00([01]){letter}", rf"$1\\u00$2{letter.lower()}"
        lowered = f"regexp_replace({lowered}, r'{found}', r'{put}')"
    escaped = rf"CASE WHEN contains(t, r'\u00') THEN {lowered} ELSE t END"
    for char in ESCAPED:
        escaped = f"replace({escaped}, '{char}', {literal(_numbered(char))})"
    # Looking for a character costs a quarter of replacing it, and most texts hold none.
    wanted = " OR ".join(f"contains({text}, {literal(sign)})" for sign in (*ESCAPED, r"\u00"))
    return f"CASE WHEN {wanted} THEN {rarely(text, 't', escaped)} ELSE {text} END"


def _numbered(char: str) -> str:
    return f"\\u{ord(char):04x}"


def key_text(name: str) -> str:
    """A column name as JSON string, escaped like values."""
    text = json.dumps(name, ensure_ascii=False)
    for char in ESCAPED:
        text = text.replace(char, _numbered(char))
    return text


# Strings, numbers and what is between them.
_JSON_PARTS = r'("(?:[^"\\]|\\.)*"|-?[0-9][0-9.eE+-]*|[^"0-9-]+|-)'


def compact_json(text: str) -> str:
    """JSON text parsed and written again: no blanks, keys sorted, of repeated keys the last. Text that is not JSON fails.

    Spark writes numbers that came with an exponent like `100.0` or `1.0E21`; where one may be, parts of the text that are numbers
    get the form of `json_float`. A number too large for a double fails: Spark would write the text "Infinity".
    """
    number = _json_number("p")
    parts = f"transform(regexp_extract_all(t.made, r'{_JSON_PARTS}', 1), p -> CASE WHEN p RLIKE '^-?[0-9]' AND p RLIKE 'E|[.]' THEN {number} ELSE p END)"
    rewritten = f"array_join({parts}, '')"
    large = f"exists(regexp_extract_all(t.given, r'{_JSON_PARTS}', 1), p -> p RLIKE '^-?[0-9]' AND abs(try_cast(p AS double)) = double('Infinity'))"
    failed = f"raise_error(concat('a number is too large: ', left(t.given, 200)))"
    checked = f"CASE WHEN contains(t.made, 'Infinity\"') AND {large} THEN {failed} WHEN (contains(t.made, 'E') OR contains(t.made, '.')) AND t.made RLIKE '[0-9]E|[.][0-9]' THEN {rewritten} ELSE t.made END"
    return rarely(f"struct({text} AS given, to_json(parse_json({text})) AS made)", "t", checked)


def _json_number(p: str) -> str:
    """A number of Spark's JSON text without exponent from 1e-6 up to 1e21, and without zeros and a point at its end; other digits stay."""
    power = f"try_cast(substring_index({p}, 'E', -1) AS int)"
    signed = f"if(startswith({p}, '-'), '-', '')"
    digits = f"trim(TRAILING '0' FROM translate(substring_index({p}, 'E', 1), '-.', ''))"
    small = f"concat('0.', repeat('0', -{power} - 1), {digits})"
    whole = f"rpad({digits}, {power} + 1, '0')"
    large = f"if(length({digits}) > {power} + 1, concat(left({digits}, {power} + 1), '.', substr({digits}, {power} + 2)), {whole})"
    mantissa = f"regexp_replace(substring_index({p}, 'E', 1), r'[.]0$', '')"
    return f"""CASE WHEN NOT contains({p}, 'E') THEN regexp_replace(trim(TRAILING '0' FROM {p}), '[.]$', '')
        WHEN {power} BETWEEN -6 AND -1 THEN concat({signed}, {small})
        WHEN {power} BETWEEN 0 AND 20 THEN concat({signed}, {large})
        ELSE concat({mantissa}, 'e', if({power} < 0, '', '+'), {power}) END"""


def json_value(c: str, dtype: T.DataType, logical: str = "") -> str:
    """JSON text of one value, not yet `html_safe`. NULL gives NULL or, for text, `null`."""
    if logical in JSON_TYPES or is_nested(dtype):
        return json_text(c, dtype)
    if logical in ("NUMERIC", "UUID"):
        from ferry.functions.render import render_text

        return _quoted(render_text(c, dtype, logical))
    return _scalar(c, dtype)


def json_text(c: str, dtype: T.DataType) -> str:
    """JSON text of a JSON column: text is parsed and compacted, nested values are written out."""
    if isinstance(dtype, T.StringType):
        return compact_json(c)
    return _nested(c, dtype, 0) if is_nested(dtype) else _scalar(c, dtype)


def _scalar(c: str, dtype: T.DataType) -> str:
    from ferry.functions.render import render_timestamp, render_timestamptz

    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return json_float(c, dtype)
    if isinstance(dtype, (T.BooleanType, T.IntegralType)):
        return f"cast({c} AS string)"
    if isinstance(dtype, T.TimestampNTZType):
        return _quoted(render_timestamp(c))
    if isinstance(dtype, T.TimestampType):
        return _quoted(render_timestamptz(c))
    if isinstance(dtype, T.BinaryType):
        return _quoted(f"base64({c})")
    if isinstance(dtype, (T.DecimalType, T.DateType)):
        return _quoted(f"cast({c} AS string)")
    return json_string(c if isinstance(dtype, T.StringType) else f"cast({c} AS string)")


def json_string(c: str) -> str:
    """JSON string of a text; `null` for NULL."""
    return f"btrim(to_json(array({c})), '[]')"


def _quoted(text: str) -> str:
    """For text known to hold nothing that JSON escapes."""
    return f"concat('\"', {text}, '\"')"


def json_float(c: str, dtype: T.DataType) -> str:
    """JSON number: no exponent from 1e-6 up to 1e21, otherwise `1e-7`, `1.5e+21`. NaN and infinity fail."""
    from ferry.functions.render import common_float, moved_point

    power = "substring_index(s, 'E', -1)"
    mantissa = r"regexp_replace(substring_index(s, 'E', 1), r'\.0$', '')"
    return common_float(c, dtype, f"""CASE
        WHEN try_cast({power} AS int) >= -6 AND try_cast({power} AS int) < 21 THEN {moved_point("s")}
        WHEN contains(s, 'E') THEN concat({mantissa}, 'e', if(startswith({power}, '-'), '', '+'), {power})
        ELSE raise_error(concat(s, ' has no JSON form')) END""")


def _nested(c: str, dtype: T.DataType, depth: int) -> str:
    if isinstance(dtype, T.StructType):
        members = [(f.name, _inner(f"{c}.{quoted_name(f.name)}", f.dataType, depth)) for f in dtype.fields]
        return f"CASE WHEN {c} IS NOT NULL THEN {json_object(members)} END"
    if isinstance(dtype, T.MapType):
        e = f"e{depth}"
        pair = f"struct(cast({e}.key AS string) AS k, {_inner(f'{e}.value', dtype.valueType, depth + 1)} AS v)"
        pairs = f"array_sort(transform(map_entries({c}), {e} -> {pair}))"
        return f"concat('{{', array_join(transform({pairs}, {e} -> concat({json_string(f'{e}.k')}, ':', {e}.v)), ','), '}}')"
    if isinstance(dtype, T.ArrayType) and not isinstance(
        dtype.elementType, (T.StringType, T.BooleanType, T.IntegralType)
    ):
        e = f"e{depth}"
        return f"concat('[', array_join(transform({c}, {e} -> {_inner(e, dtype.elementType, depth + 1)}), ','), ']')"
    return f"to_json({c})"


def _inner(c: str, dtype: T.DataType, depth: int) -> str:
    """A value inside a nested one: strings there are strings, not JSON text."""
    return f"coalesce({_nested(c, dtype, depth) if is_nested(dtype) else _scalar(c, dtype)}, 'null')"


def json_object(members: list[tuple[str, str]]) -> str:
    """Object of (name, JSON text) pairs, none NULL; keys sorted by their bytes."""
    parts, lead = [], "{"
    for name, member in sorted(members, key=lambda pair: pair[0].encode()):
        parts += [literal(f"{lead}{key_text(name)}:"), member]
        lead = ","
    return f"concat({', '.join(parts)}, '}}')" if parts else "'{}'"
