"""Conversions and text forms against independent Python results."""

import json
import math
import random
import struct
import uuid
from decimal import ROUND_HALF_UP, Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

import ferry
from ferry import functions as fn
from ferry.functions import (
    compact_json, csv_field, decimal_unscaled, fix_sqlserver_uuid, html_safe, json_value, render_float, render_text, to_numeric, to_uuid,
    uuid_bytes,
)
from ferry.session import configure, work_folder


def column(spark, values, kind, partitions=2):
    rows = [(i, v) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, f"i int, x {kind}").repartition(partitions)


def results(df, expression):
    expression = F.expr(expression) if isinstance(expression, str) else expression
    return [r.y for r in df.select("i", expression.alias("y")).orderBy("i").collect()]


def plain(digits: str) -> str:
    return "-0" if digits == "-0.0" else format(Decimal(digits).normalize(), "f")


def as_json(digits: str) -> str:
    value = Decimal(digits)
    if value == 0 or Decimal("1e-6") <= abs(value) < Decimal("1e21"):
        return plain(digits)
    sign, figures, exponent = value.normalize().as_tuple()
    text = "".join(map(str, figures))
    power = len(text) - 1 + exponent
    mantissa = text[0] + ("." + text[1:] if text[1:] else "")
    return f"{'-' if sign else ''}{mantissa}e{'+' if power > 0 else ''}{power}"


def doubles():
    r = random.Random(7)
    out = [0.0, -0.0, 1.0, -1.0, 0.1, 123.45, 1e7, 9999999.5, 12345678.25, 1e15 + 0.5, 2e23, 1.2345678901234567e20, 3e-308,
           1.7976931348623157e308, 2.0**53, 2.0**53 + 2, 1e21, 9.999999999999999e20, 1e-6, 9.99e-7, 1e-3, 0.00123, 1e-5, 1e22,
           3.0e-3, 999999.9999999999, 4503599627370497.5]
    out += [r.uniform(-1, 1) * 10 ** r.uniform(-25, 30) for _ in range(3000)]
    out += [r.uniform(-1, 1) * 10 ** r.uniform(-7, -2) for _ in range(1000)]
    out += [round(r.uniform(-1e9, 1e9), 2) for _ in range(500)] + [float(r.randrange(10**18)) for _ in range(500)]
    out += [struct.unpack("<d", struct.pack("<Q", r.getrandbits(63)))[0] for _ in range(500)]
    # Java writes two digits at least, also of subnormal numbers that one digit tells apart.
    return [x for x in out if math.isfinite(x) and (x == 0 or abs(x) > 2.3e-308)]


def test_doubles(spark):
    values = doubles()
    near = [x for x in values if abs(x) < 9.2e18]
    df = column(spark, near + [None], "double")
    dtype = T.DoubleType()
    assert results(df, render_float("x", dtype)) == [plain(repr(x)) for x in near] + [None]
    assert results(df, json_value("x", dtype)) == [as_json(repr(x)) for x in near] + [None]


def test_large_doubles(spark):
    """As few digits as possible, and the same number when read back; of two such texts either may come."""
    large = [x for x in doubles() if abs(x) >= 9.2e18]
    df = column(spark, large, "double")
    for text, wanted, x in zip(results(df, render_float("x", T.DoubleType())), map(repr, large), large):
        assert float(text) == x and len(text) == len(plain(wanted)) and "e" not in text.lower()
        assert len(text.rstrip("0")) <= len(plain(wanted).rstrip("0"))
    for text, wanted, x in zip(results(df, json_value("x", T.DoubleType())), map(repr, large), large):
        assert float(text) == x and len(text) <= len(as_json(wanted))


def test_floats(spark):
    wide = [x for x in doubles() if abs(x) < 3e38 and (x == 0 or abs(x) > 1e-37)] + [12345678.9, 16777216.0, 33554432.0]
    values = [float(np.float32(x)) for x in wide]
    shortest = [np.format_float_positional(np.float32(x), unique=True, trim="-") for x in values]
    df = column(spark, values, "double").withColumn("x", F.col("x").cast("float"))
    got = results(df, render_float("x", T.FloatType()))
    assert got == [s if s != "-0." else "-0" for s in shortest]


def test_not_numbers(spark):
    df = column(spark, [float("nan"), float("inf"), float("-inf")], "double")
    assert results(df, render_float("x", T.DoubleType())) == ["NaN", "+Inf", "-Inf"]
    with pytest.raises(Exception, match="no JSON form"):
        results(df, json_value("x", T.DoubleType()))


TEXTS = ["", "plain", 'q"uote', "back\\slash", "a\nb\rc\td", "\x01\x0b\x1f\x7f", "<b>&amp;</b>", "line sep ", "é漢😀",
         "\\u000B", "\\\x0b", "[x]", "]", '"', "\b\f", "NULL", " lead", "\u3000wide", "\xa0nb", "trail ", "a,b", "\\.", "\x85x", "'", None]


def json_escaped(text):
    out = json.dumps(text, ensure_ascii=False)
    for char in "<>&\u2028\u2029":
        out = out.replace(char, f"\\u{ord(char):04x}")
    return out


def test_json_strings(spark):
    df = column(spark, TEXTS, "string").select("i", F.expr(json_value("x", T.StringType())).alias("x"))
    assert results(df, html_safe("x")) == [json_escaped(t) for t in TEXTS]


def test_json_lines_parse_back(spark):
    df = spark.sql("""SELECT 'x' k, DATE'2024-02-29' d, 1.50BD n, X'00ff' b, array('<a>', null) a, array(1D, 1e-7D, null) f,
                      map('b', 1, 'a', null) m, named_struct('z', 1, 'a', 'q"') s, '{"b": [1, 2.0], "a": "<"}' j, true t""")
    df = ferry.override(df.toDF("<k>", "d", "n", "b", "a", "f", "m", "s", "j", "t"), [{"name": "j", "type": "JSON"}])
    line = ferry.jsonl_lines(df).first().value
    assert line == (
        '{"\\u003ck\\u003e":"x","a":["\\u003ca\\u003e",null],"b":"AP8=","d":"2024-02-29","f":[1,1e-7,null],'
        '"j":{"a":"\\u003c","b":[1,2]},"m":{"a":null,"b":1},"n":"1.50","s":{"a":"q\\"","z":1},"t":true}'
    )
    assert json.loads(line)["s"] == {"a": 'q"', "z": 1}


def test_nulls_in_json_lines(spark):
    df = spark.sql("SELECT cast(null AS double) d, cast(null AS string) s, cast(null AS array<double>) a, cast(null AS int) i")
    df = ferry.override(df.withColumn("j", F.lit(None).cast("string")), [{"name": "j", "type": "JSONB"}])
    assert ferry.jsonl_lines(df).first().value == '{"a":null,"d":null,"i":null,"j":null,"s":null}'


def test_bad_json_fails(spark):
    df = ferry.override(spark.sql("SELECT '{x' j"), [{"name": "j", "type": "JSON"}])
    with pytest.raises(Exception, match="(?i)malformed"):
        ferry.csv_lines(df).collect()


def csv_quoted(text):
    if text is None:
        return "NULL"
    if any(c in text for c in ',"\r\n') or text == "\\." or text[:1] in " \t\x0b\x0c\x85\xa0\u3000" and text:
        return '"' + text.replace('"', '""') + '"'
    return text


def test_csv_fields(spark):
    df = column(spark, TEXTS, "string")
    assert results(df, csv_field("x", T.StringType())) == [csv_quoted(t) for t in TEXTS]


def test_times(spark):
    df = spark.sql("""SELECT TIMESTAMP_NTZ'2024-01-02 03:04:05.120000' a, TIMESTAMP_NTZ'2024-01-02 00:00:00' b,
                      TIMESTAMP'2024-07-02 03:04:05.000001Z' c""")
    ntz, tz = T.TimestampNTZType(), T.TimestampType()
    parts = [F.expr(render_text("a", ntz)), F.expr(render_text("b", ntz)), F.expr(render_text("c", tz))]
    assert list(df.select(*parts).first()) == ["2024-01-02T03:04:05.12", "2024-01-02T00:00:00", "2024-07-02T03:04:05.000001Z"]
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert df.select(F.expr(render_text("c", tz))).first()[0].endswith("-04:00")
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


@pytest.mark.parametrize("text, scale, unscaled", [
    ("123.45", 2, 12345), ("123", 2, 12300), ("123.4", 2, 12340), ("-123.45", 2, -12345), ("0", 2, 0),
    ("12345678901234567890", 5, 1234567890123456789000000), ("639529.823302734000000", 15, 639529823302734000000),
    ("000123.45", 2, 12345), (".45", 2, 45), ("-123", 3, -123000), ("123.456", 3, 123456), ("7.", 1, 70), (None, 2, None),
])
def test_unscaled(spark, text, scale, unscaled):
    got = results(column(spark, [text], "string"), decimal_unscaled(F.col("x"), scale))[0]
    assert got == (None if unscaled is None else Decimal(unscaled))


@pytest.mark.parametrize("text, scale", [("123.456", 2), ("", 2), ("123.45.67", 2), ("123.4a", 2), ("-", 2), (".", 0), ("1e3", 2), ("--1", 2)])
def test_unscaled_errors(spark, text, scale):
    with pytest.raises(Exception, match="not a decimal"):
        results(column(spark, [text], "string"), decimal_unscaled(F.col("x"), scale))


def test_numeric(spark):
    values = [473274.17, 2.345, -2.345, 1e10, 0.1, None]
    got = results(column(spark, values, "double"), to_numeric(F.col("x"), T.DoubleType(), T.DecimalType(15, 2)))
    cent = Decimal("0.01")
    assert got == [None if v is None else Decimal(repr(v)).quantize(cent, ROUND_HALF_UP) for v in values]
    texts = column(spark, ["1.25", "1.255", "x", None], "string")
    target = T.DecimalType(5, 2)
    assert results(texts, to_numeric(F.col("x"), T.StringType(), target, "null")) == [Decimal("1.25"), Decimal("1.26"), None, None]
    assert results(texts, to_numeric(F.col("x"), T.StringType(), target, "zero"))[2:] == [Decimal("0.00"), None]
    with pytest.raises(Exception, match="more than 2 fraction digits"):
        results(texts, to_numeric(F.col("x"), T.StringType(), target, "null", strict_scale=True))
    with pytest.raises(Exception, match="CAST_INVALID_INPUT|cannot be cast"):
        results(texts, to_numeric(F.col("x"), T.StringType(), target))


def test_uuids(spark):
    u = uuid.UUID("a0eebc99-9c0b-4ef8-bb6d-6bb9bd380a11")
    spellings = [str(u), str(u).upper(), u.hex, f"urn:uuid:{u}", f"{{{u}}}", None]
    df = column(spark, spellings, "string")
    assert results(df, to_uuid(F.col("x"), T.StringType())) == [str(u)] * 5 + [None]
    raw = column(spark, [u.bytes, b"short", None], "binary")
    assert results(raw, to_uuid(F.col("x"), T.BinaryType(), "null")) == [str(u), None, None]
    assert results(raw, render_text("x", T.BinaryType(), "UUID"))[0] == str(u)
    assert bytes(results(column(spark, [str(u)], "string"), uuid_bytes(F.col("x")))[0]) == u.bytes
    swapped = [None if b is None else bytes(b) for b in results(raw, fix_sqlserver_uuid(F.col("x")))]
    assert swapped == [u.bytes_le, b"short", None]
    for bad in ("a0eebc99", f"{{{u}", f"x{u}", ""):
        with pytest.raises(Exception, match="not a UUID in column id"):
            results(column(spark, [bad], "string"), to_uuid(F.col("x"), T.StringType(), name="id"))


def test_errors_by_mode(spark):
    df = column(spark, ["12", "x", None], "string").select("i", "x")
    wanted = [{"name": "x", "type": "INT4"}]
    assert results(ferry.override(df, wanted, on_error="null"), F.col("x")) == [12, None, None]
    assert results(ferry.override(df, wanted, on_error="zero"), F.col("x")) == [12, 0, None]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT|cannot be cast"):
        results(ferry.override(df, wanted), F.col("x"))
    with pytest.raises(ValueError, match="on_error"):
        ferry.override(df, wanted, on_error="maybe")


def test_conversions_of_overrides(spark):
    df = spark.sql("SELECT 1.90BD n, -1.90BD m, 1e3D d, X'41' b, TIMESTAMP_NTZ'2024-01-02 03:04:05' t, true f, '7' s")
    out = ferry.override(df, [
        {"name": "n", "type": "INT8"}, {"name": "m", "type": "BIGINT"}, {"name": "d", "type": "TEXT"},
        {"name": "b", "type": "TEXT"}, {"name": "t", "type": "DATE"}, {"name": "f", "type": "VARCHAR"},
        {"name": "s", "type": "DOUBLE PRECISION"},
    ])
    row = out.first()
    assert (row.n, row.m, row.d, row.b, str(row.t), row.f, row.s) == (1, -1, "1000", "A", "2024-01-02", "true", 7.0)
    json_from = ferry.override(df, [{"name": c, "type": "JSON"} for c in ("n", "f", "s")]).first()
    assert (json_from.n, json_from.f, json_from.s) == ('"1.90"', "true", "7")


def test_server_uuid_columns(spark):
    u = uuid.UUID("a0eebc99-9c0b-4ef8-bb6d-6bb9bd380a11")
    df = column(spark, [bytearray(u.bytes_le)], "binary").select("x")
    assert ferry.normalise(df, "sqlserver", {"x": "UNIQUEIDENTIFIER"}).first().x == str(u)
    assert ferry.normalise(df, None, {"x": "UUID"}).first().x == str(uuid.UUID(bytes=u.bytes_le))


def test_expressions_on_a_stream(spark, tmp_path):
    """No operator runs a job of its own, so the same projection serves a streaming DataFrame."""
    spark.range(10).selectExpr("id", "id / 4 AS x").write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("id long, x double").parquet(str(tmp_path / "in"))
    lines = ferry.jsonl_lines(ferry.override(stream, [{"name": "x", "type": "NUMERIC(9,2)"}]))
    query = lines.writeStream.format("memory").queryName("ferry_lines").start()
    query.processAllAvailable()
    query.stop()
    assert spark.table("ferry_lines").where("value = '{\"id\":9,\"x\":\"2.25\"}'").count() == 1
    assert spark.table("ferry_lines").count() == 10


@pytest.mark.parametrize("text, fits", [
    ("1.25", True), ("1.255", False), ("1e-5", False), ("12.5e-1", True), ("1.25e-1", False), ("1.255e1", True), ("100e-2", True), ("1.50e-1", True),
    (" 1E3 ", True), ("1.2500", False), ("5e-2", True),
])
def test_strict_scale_sees_exponents(spark, text, fits):
    df = spark.createDataFrame([(text,)], "x string").select(to_numeric(F.col("x"), T.StringType(), T.DecimalType(10, 2), "fail", True).alias("d"))
    if fits:
        assert df.first().d == round(Decimal(text.strip()), 2)
    else:
        with pytest.raises(Exception, match="fraction digits"):
            df.collect()


@pytest.mark.parametrize("given, text", [
    ("1e2", "100"), ("1e-7", "1e-7"), ("0.1e1", "1"), ("1e21", "1e+21"), ("1.5e300", "1.5e+300"), ("-12345.678e3", "-12345678"), ("123456789.5e0", "123456789.5"),
    ('{"b":"1e2 \\"1.0E5","a":[1.10,2.0,true,null]}', '{"a":[1.1,2,true,null],"b":"1e2 \\"1.0E5"}'), ('{"a":1,"a":{"x":2,"x":3}}', '{"a":{"x":3}}'),
    ('["Infinity",1e0]', '["Infinity",1]'), ("12345678901234567890", "12345678901234567890"), ("0.1234567890123456789", "0.1234567890123456789"),
])
def test_json_numbers_and_repeated_keys(spark, given, text):
    configure(spark)
    assert spark.createDataFrame([(given,)], "t string").select(F.expr(compact_json("t")).alias("x")).first().x == text


def test_a_json_number_that_is_too_large_fails(spark):
    for given in ("1E400", '{"a":["Infinity",-1e999]}'):
        with pytest.raises(Exception, match="too large"):
            spark.createDataFrame([(given,)], "t string").select(F.expr(compact_json("t"))).collect()


def test_work_folder_needs_a_known_place():
    class Conf(dict):
        def get(self, key, default=None):
            return super().get(key, default)

    with pytest.raises(RuntimeError, match="checkpoint"):
        work_folder(type("Session", (), {"conf": Conf()})())
    assert work_folder(type("Session", (), {"conf": Conf({"spark.checkpoint.dir": "hdfs:/shared/"})})()).startswith("hdfs:/shared/ferry-")


def test_doubles_of_every_exponent(spark):
    """The fewest digits that read back the same, and the nearest of these: Python's own choice."""
    rng = random.Random(11)
    bits = [(rng.getrandbits(1) << 63) | (e << 52) | m for e in range(2047) for m in (0, 1, (1 << 52) - 1, rng.getrandbits(52))]
    values = [struct.unpack("<d", struct.pack("<Q", b))[0] for b in bits] + [5e-324, 1.7976931348623157e308, 2.0**-44, 9.2e18, 2e23, 9007199254740993.0]
    df = spark.createDataFrame([(v,) for v in values], "x double").repartition(4)
    texts = {r.x: r.t for r in df.select("x", F.expr(fn.render_float("x", T.DoubleType(), exact=True)).alias("t")).collect()}
    assert texts == {v: f"{Decimal(repr(v)):f}".removesuffix(".0") for v in values}
