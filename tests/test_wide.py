"""Numbers of more digits than Spark's decimals, against Python's."""

import decimal
import json
import random
from decimal import Decimal

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

import ferry
from ferry import functions as fn
from ferry.sinks import Target, write

decimal.getcontext().prec = 3000

TEXTS = [
    "0", "-0", "0.00", "-0.004", "0.005", "-0.005", "0.0049999999999999999999999999999999999999999999", "1", "+7", " 12.5 ", ".5", "5.", "-.125",
    "9" * 50, "9" * 49 + ".995", "-" + "9" * 47 + ".994999", "1e49", "1E-3", "12345678901234567890123456789012345678901234567.125", "1.5e3", "1e-400",
    "0e99999999999", "0.000e-99999999999", "1e-99999999999", "99.995", "9.995e1", "000123.4500", "00000000000000000000000000000000000000000000000000000000000001.5",
]
NONE = ["", " ", ".", "-", "e5", "1e", "1.2.3", "abc", "0x10", "1,5", "NaN", "Infinity", "1 2", "--1", "1e5.5", "٣"]


def texts(spark, values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id int, t string")


def plain(text, precision, scale):
    value = Decimal(text.strip()).quantize(Decimal(1).scaleb(-scale), rounding=decimal.ROUND_HALF_UP)
    digits = f"{abs(value):f}"
    return ("-" if value < 0 else "") + digits if len(digits.replace(".", "").lstrip("0")) <= precision else None


@pytest.mark.parametrize("precision, scale", [(50, 2), (48, 0), (60, 30), (400, 399), (5, 2), (1, 1)])
def test_against_python(spark, precision, scale):
    rng = random.Random(precision)
    values = list(TEXTS)
    values += [f"{rng.choice('+- ')}".strip() + "".join(rng.choice("0959") for _ in range(rng.randrange(1, 55))) + rng.choice(["", ".", "." + "".join(rng.choice("0495") for _ in range(rng.randrange(40)))])
               + rng.choice(["", "", f"e{rng.randrange(-60, 12)}"]) for _ in range(400)]
    out = texts(spark, values).select("id", fn.to_wide_numeric(F.col("t"), precision, scale, "null").alias("v")).collect()
    want = [plain("0" if "99999999999" in v.lower().partition("e")[2] else v, precision, scale) for v in values]
    assert {r.id: r.v for r in out} == dict(enumerate(want))


def test_what_is_no_number(spark):
    df = texts(spark, [*NONE, None, "1" * 51, "1e50", "1e99999999999"])
    assert {r.v for r in df.select(fn.to_wide_numeric(F.col("t"), 50, 2, "null").alias("v")).collect()} == {None}
    assert {(r.t is None, r.v) for r in df.select("t", fn.to_wide_numeric(F.col("t"), 50, 2, "zero").alias("v")).collect()} == {(True, None), (False, "0.00")}
    for bad in (*NONE, "1" * 51):
        with pytest.raises(Exception, match="not a NUMERIC"):
            texts(spark, [bad]).select(fn.to_wide_numeric(F.col("t"), 50, 2)).collect()
    for bad in ("1.234", "1.200", "1234e-3"):
        with pytest.raises(Exception, match="more than 2 fraction digits"):
            texts(spark, [bad]).select(fn.to_wide_numeric(F.col("t"), 50, 2, strict_scale=True)).collect()
    fine = texts(spark, ["1.23", "1.2300e0", "123400e-4", "0e-9", None]).select(fn.to_wide_numeric(F.col("t"), 50, 2, strict_scale=True).alias("v"))
    assert [r.v for r in fine.collect()] == ["1.23", "1.23", "12.34", "0.00", None]
    with pytest.raises(ValueError):
        fn.to_wide_numeric(F.col("t"), 3, 4)


def test_a_move_of_wide_numbers(spark, tmp_path):
    long = "12345678901234567890123456789012345678901234567.125"
    spark.createDataFrame([(1, long, 2.5, 7), (2, "-1e3", None, None)], "id int, a string, d double, i int").createOrReplaceTempView("wide")
    spec = {"sql": "SELECT id, a, d, i, cast(i AS decimal(9,3)) AS n FROM wide", "columns": [{"name": c, "type": "NUMERIC(50,2)"} for c in "adin"]}
    for fmt in ("csv", "jsonl", "parquet", "arrow"):
        ferry.move(spark, spec | {"format": fmt, "filename": fmt}, str(tmp_path))
    first = [long[:-1] + "3", "2.50", "7.00", "7.00"]
    first[0] = "12345678901234567890123456789012345678901234567.13"
    back = ferry.read_landed(spark, str(tmp_path / "parquet"), "parquet").orderBy("id")
    assert [list(r)[1:] for r in back.collect()] == [first, ["-1000.00", None, None, None]]
    (column,) = [c for c in ferry.columns_of(back) if c.name == "a"]
    assert (column.type, column.precision, column.scale) == ("NUMERIC", 50, 2)
    assert ferry.jsonl_lines(back.filter("id = 1")).first().value == json.dumps(dict(zip("adin", first)) | {"id": 1}, separators=(",", ":"), sort_keys=True)
    line = sorted(r.value for r in spark.read.text(str(tmp_path / "csv")).collect() if r.value[0] == "1")
    assert line == ["1," + ",".join(first)]
    with pytest.raises(ferry.MoveError, match="not a NUMERIC"):
        ferry.move(spark, {"sql": "SELECT 'x' AS a", "columns": [{"name": "a", "type": "NUMERIC(39,0)"}], "format": "csv", "filename": "x"}, str(tmp_path))


@pytest.mark.parametrize("precision", [1, 4, 8, 9, 12, 18, 19, 20, 22, 28, 30, 35, 37, 38])
def test_decimal_bytes(spark, precision):
    rng, size, scale = random.Random(precision), fn.decimal_size(precision), precision // 3
    top = 10**precision - 1
    values = [0, 1, -1, top, -top, 127, -128, 255, -256, 2**31, -(2**31), 2**63, -(2**63), 2**64 - 1, -(2**64), 2**96, -(2**96) - 1]
    values = [v for v in values if abs(v) <= top] + [rng.randrange(-top, top + 1) for _ in range(60)]
    rows = spark.createDataFrame([(str(Decimal(v).scaleb(-scale)),) for v in values], "t string").select(F.expr(f"cast(t AS decimal({precision},{scale}))").alias("v"))
    for ansi in ("true", "false"):
        spark.conf.set("spark.sql.ansi.enabled", ansi)
        try:
            got = [bytes(r.b) for r in rows.select(fn.decimal_bytes(F.col("v"), rows.schema["v"].dataType).alias("b")).collect()]
        finally:
            spark.conf.unset("spark.sql.ansi.enabled")
        assert got == [v.to_bytes(size, "big", signed=True) for v in values]


# Bytes that must come out exactly so.
@pytest.mark.parametrize("text, scale, precision, expected", [
    ("123456789012345.123456789012345", 15, 38, "000000018ee90ff6c371e7c1d1605f79"),
    ("-123456789012345.123456789012345", 15, 38, "fffffffe7116f0093c8e183e2e9fa087"),
    ("-25.34", 2, 8, "fffff61a"), ("0", 2, 38, "0" * 32), ("12345678901234567890123456789012345678", 0, 38, "0949b0f6f0023313c4499050de38f34e"),
    ("123.456", 3, 8, "0001e240"),
])
def test_decimal_bytes_of_text(spark, text, scale, precision, expected):
    value = fn.unscaled_bytes(fn.decimal_unscaled(F.lit(text), scale), fn.decimal_size(precision))
    assert spark.range(1).select(F.lower(F.hex(value)).alias("h")).first().h == expected


def test_bytes_that_do_not_fit(spark):
    for value, size in ((128, 1), (-129, 1), (10**37, 15), (2**63, 8)):
        with pytest.raises(Exception, match="does not fit"):
            spark.range(1).select(fn.unscaled_bytes(F.lit(str(value)).cast("decimal(38,0)"), size)).collect()
    assert spark.range(1).select(fn.unscaled_bytes(F.lit(None).cast("decimal(38,0)"), 4).alias("b")).first().b is None
    with pytest.raises(ValueError):
        fn.unscaled_bytes(F.lit(1), 17)


def test_measured_precision(spark):
    rows = [("12.50", 1, Decimal("1.100"), 0.25, "x", "1e3"), ("-0.001", -300, Decimal("-20"), 1e20, "1", "1e-5"), (None, None, None, None, None, None), ("000", 0, Decimal(0), 0.0, "y", "0e9")]
    df = spark.createDataFrame(rows, "a string, b int, c decimal(30,10), d double, e string, f string").withColumn("g", F.lit(None).cast("string")).withColumn("h", F.current_date()).withColumn("c.x", F.lit(7))
    found = {r.name: (r.nulls, r.numbers, r.precision, r.scale) for r in ferry.measure_columns(df, numbers=True).collect()}
    assert found == {"a": (1, 3, 5, 3), "b": (1, 3, 3, 0), "c": (1, 3, 3, 1), "d": (1, 3, 23, 2), "e": (1, 1, 1, 0), "f": (1, 3, 9, 5), "g": (4, 0, None, None), "h": (0, None, None, None), "c.x": (0, 4, 1, 0)}
    plain = ferry.measure_columns(df).collect()
    assert [r.max_length for r in plain][:2] == [6, None] and len(plain[0]) == 6
    empty = ferry.measure_columns(df.filter("b > 999"), numbers=True).collect()
    assert all(r.rows == 0 and r.precision is None for r in empty)


def test_rows_of_a_row_group(spark, tmp_path):
    df = spark.range(0, 5000, 1, 2)
    for target, most in ((Target(str(tmp_path / "a"), rows_per_group=700), 700), (Target(str(tmp_path / "b"), rows_per_file=300), 300)):
        write(df, "parquet", target)
        metas = [pq.ParquetFile(p).metadata for p in (tmp_path / target.path).glob("part-*")]
        groups = [m.row_group(i).num_rows for m in metas for i in range(m.num_row_groups)]
        assert sum(groups) == 5000 and max(groups) == most
    assert len(list((tmp_path / "a").glob("part-*"))) == 2
    ferry.move(spark, {"sql": "SELECT * FROM range(0, 4000, 1, 1)", "format": "parquet", "filename": "c", "row_group_rows": 900}, str(tmp_path))
    (file,) = (tmp_path / "c").glob("part-*")
    meta = pq.ParquetFile(file).metadata
    assert [meta.row_group(i).num_rows for i in range(meta.num_row_groups)] == [900, 900, 900, 900, 400]
