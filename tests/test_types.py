import pytest
from pyspark.sql import functions as F

import ferry
from ferry.operators import columns_of, describe, override_columns, parse_column_specs
from ferry.types import Column, declared_column, spark_type, type_alias


# Fixed values here and below: type names of the sources.
@pytest.mark.parametrize("name, canonical", [
    ("INT2", "SMALLINT"), ("INT4", "INTEGER"), ("INT", "INTEGER"), ("INT8", "BIGINT"), ("DECIMAL", "NUMERIC"),
    ("FLOAT4", "REAL"), ("FLOAT8", "DOUBLE"), ("DOUBLE PRECISION", "DOUBLE"), ("CHARCTER VARYING", "VARCHAR"),
    ("CHARACTER VARYING", "VARCHAR"), ("BOOL", "BOOLEAN"), ("BPCHAR", "BPCHAR"), ("TEXT", "TEXT"),
])
def test_alias(name, canonical):
    assert type_alias(name) == canonical


@pytest.mark.parametrize("source, declared, canonical", [
    ("postgres", "int8", "BIGINT"), ("postgres", "uuid", "UUID"), ("postgres", "_text", "_TEXT"),
    ("sqlserver", "BIT", "BOOLEAN"), ("sqlserver", "INT", "INTEGER"), ("sqlserver", "FLOAT", "DOUBLE"),
    ("sqlserver", "REAL", "REAL"), ("sqlserver", "DATETIME", "TIMESTAMP"), ("sqlserver", "DATETIMEOFFSET", "TIMESTAMPTZ"),
    ("sqlserver", "UNIQUEIDENTIFIER", "UUID"), ("sqlserver", "NVARCHAR", "TEXT"), ("sqlserver", "VARCHAR(5)", "VARCHAR"),
    ("snowflake", "FIXED(10,2)", "NUMERIC"), ("snowflake", "TIMESTAMP_LTZ", "TIMESTAMP"),
    ("snowflake", "TIMESTAMP_NTZ", "TIMESTAMP"), ("snowflake", "TIMESTAMP_TZ", "TIMESTAMPTZ"),
    ("snowflake", "ARRAY", "JSONB"), ("snowflake", "VARIANT", "JSONB"), ("snowflake", "TEXT(100)", "VARCHAR"),
    ("snowflake", "TEXT(16777216)", "TEXT"), ("snowflake", "REAL", "DOUBLE"),
])
def test_source_types(source, declared, canonical):
    assert declared_column("c", declared, source).type == canonical


def test_a_numeric_override_needs_a_precision():
    text = [Column("a", "TEXT", "TEXT")]
    with pytest.raises(ValueError, match="needs a precision"):
        override_columns(text, [{"name": "a", "type": "NUMERIC"}])
    assert override_columns(text, [{"name": "a", "type": "NUMERIC", "precision": 9}])[0].precision == 9
    sized = [Column("a", "DECIMAL", "NUMERIC", precision=12, scale=3)]
    assert override_columns(sized, [{"name": "a", "type": "NUMERIC"}])[0].precision == 12


def test_money_and_limits():
    money = declared_column("c", "MONEY", "sqlserver")
    assert (money.precision, money.scale) == (19, 4)
    assert spark_type(Column("c", type="NUMERIC")).simpleString() == "double"
    assert spark_type(Column("c", type="NUMERIC", precision=38, scale=2)).simpleString() == "decimal(38,2)"
    assert spark_type(Column("c", type="NUMERIC", precision=39, scale=2)).simpleString() == "string"  # kept as digits
    with pytest.raises(ValueError, match="more fraction digits"):
        spark_type(Column("c", type="NUMERIC", precision=40, scale=41))
    with pytest.raises(ValueError, match="unknown source"):
        declared_column("c", "INT", "oracle")


def test_overrides():
    columns = [Column("a", "INT4", "INTEGER"), Column("B", "NUMERIC", "NUMERIC", precision=10, scale=2, position=1)]
    out = override_columns(columns, [
        {"name": "A", "type": "int8", "nullable": True, "database_type": "ignored"},
        {"name": "b", "scale": 4, "precision": 12},
        {"name": "missing", "type": "TEXT"},
    ])
    assert [(c.name, c.type, c.database_type) for c in out] == [("a", "BIGINT", "INT4"), ("B", "NUMERIC", "NUMERIC")]
    assert (out[1].precision, out[1].scale, out[1].position, out[0].nullable) == (12, 4, 1, True)
    assert override_columns(columns, [{"name": "a", "nullable": False}])[0].nullable is False
    sized = override_columns(columns, [{"name": "a", "type": "varchar(9)"}, {"name": "b", "type": "decimal(9,1)"}])
    assert (sized[0].length, sized[1].precision, sized[1].scale) == (9, 9, 1)


def test_column_specs():
    wanted = [Column("column1", type="TEXT"), Column("column2", type="BIGINT")]
    assert parse_column_specs("- name: column1\n  type: TEXT") == wanted[:1]
    assert parse_column_specs('[{"name": "column1", "type": "TEXT"}, {"name": "column2", "type": "BIGINT"}]') == wanted
    with pytest.raises(ValueError):
        parse_column_specs('[\n\t{"name": "column1", "type": "TEXT"},\n\t{"name": "column2", "type": "BIGINT"\n]')
    with pytest.raises(ValueError):
        parse_column_specs("- type: TEXT")


def test_describe_runs_no_job(spark):
    spark.sql("CREATE TABLE described (v VARCHAR(12), d DECIMAL(12,3), a ARRAY<STRING>, s STRUCT<x: INT>) USING parquet")
    rows = describe(spark.table("described")).collect()
    assert [(r.name, r.type, r.length, r.scale, r.precision, r.position) for r in rows] == [
        ("v", "VARCHAR", 12, 0, 0, 0), ("d", "NUMERIC", 0, 3, 12, 1), ("a", "_TEXT", 0, 0, 0, 2), ("s", "JSONB", 0, 0, 0, 3),
    ]
    bad = spark.range(5).select(F.raise_error(F.lit("read")).cast("int").alias("x"))
    assert [c.type for c in columns_of(bad)] == ["INTEGER"]


def test_jdbc_type_names_in_metadata(spark):
    df = spark.sql("SELECT 1 a, 2.50BD b, 'x' c, 7L d, 'y' e")
    for name, kind in (("a", "int4"), ("b", "numeric"), ("c", "uuid"), ("d", "bigserial"), ("e", "bpchar")):
        df = df.withMetadata(name, {"jdbcClientType": kind, "scale": 2})
    assert [c.type for c in columns_of(df, "postgres")] == ["INTEGER", "NUMERIC", "UUID", "BIGINT", "BPCHAR"]
    assert columns_of(df, "postgres")[1].precision == 3


def test_unsized_numeric_keeps_its_digits(spark):
    df = spark.sql("SELECT 1.25BD a, 1.25D b")
    out = ferry.normalise(df, "postgres", {"A": "numeric", "b": "numeric"})
    assert [t for _, t in out.dtypes] == ["decimal(3,2)", "double"]


def test_measured_columns(spark):
    df = spark.sql("SELECT * FROM VALUES (1, 'ab', null), (2, null, null), (3, 'abcé', null) t(i, s, n)")
    df = df.withColumn("n", F.col("n").cast("double"))
    rows = [tuple(r) for r in ferry.measure_columns(df).collect()]
    assert rows == [("i", "INTEGER", 0, 3, 0, None), ("s", "TEXT", 1, 3, 1, 4), ("n", "DOUBLE", 2, 3, 3, None)]
