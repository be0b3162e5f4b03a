"""Queries of the table mover and the SQL they must agree with."""

from __future__ import annotations

import importlib
import importlib.util
import sys
from collections.abc import Callable
from datetime import date
from functools import reduce
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import DataFrame, SparkSession, Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402
from pyspark.sql.types import DecimalType, DoubleType, StringType, StructField, StructType  # noqa: E402

import ferry  # noqa: E402
from ferry import functions as fn  # noqa: E402
from ferry.plans.spec import with_environment, with_tokens  # noqa: E402
from ferry.sinks import arrow, extension  # noqa: E402
from ferry.session import configure, work_folder  # noqa: E402
from ferry.sources import table_path  # noqa: E402
from ferry.sources.jdbc import split_predicates  # noqa: E402
from ferry.sources.params import jdbc_literal  # noqa: E402
from ferry.sources.splits import bounds, cut_points, depth_predicates, split_sizes  # noqa: E402

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_ORACLE: dict[str, str] = {}

DATA = "/root/testdata/sf0.001"


def _query(sql: str) -> Callable[[Query], Query]:
    def add(build: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            configure(spark)
            return build(spark, sf_dir)

        _QUERIES[build.__name__] = run
        _ORACLE[build.__name__] = sql
        return build

    return add


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def _views(spark: SparkSession, sf_dir: str, *names: str) -> None:
    ferry.register_tables(spark, sf_dir, names)


def _read_back(spark: SparkSession, path: str, like: DataFrame, fmt: str) -> DataFrame:
    if fmt == "csv":
        return spark.read.schema(like.schema).csv(
            path, header=True, multiLine=True, escape='"', nullValue="NULL",
            ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
        )
    return spark.read.schema(like.schema).json(path)


# Scans

@_query("SELECT * FROM orders")
def scan_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    _views(spark, sf_dir, "orders")
    return ferry.plan(spark, {"stream_name": "orders"})


SCAN_SQL = """
    SELECT n_name, o_orderpriority, count(*) AS orders, min(o_orderdate) AS first_order, max(o_totalprice) AS largest
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
    GROUP BY n_name, o_orderpriority"""


@_query(SCAN_SQL)
def scan_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    _views(spark, sf_dir, "orders", "customer", "nation")
    return ferry.plan(spark, {"sql": SCAN_SQL})


@_query("""SELECT l_orderkey, l_linenumber, l_quantity, l_shipdate FROM lineitem
           WHERE l_shipdate < TIMESTAMP '1998-09-02 00:00:00' AND l_quantity > 24 AND l_returnflag = 'R'""")
def scan_sql_params(spark: SparkSession, sf_dir: str) -> DataFrame:
    _views(spark, sf_dir, "lineitem")
    return ferry.plan(spark, {
        "sql": """SELECT l_orderkey, l_linenumber, l_quantity, l_shipdate FROM lineitem
                  WHERE l_shipdate < $1 AND l_quantity > $2 AND l_returnflag = $3 -- not $4""",
        "params": {
            "P1": {"value": "1998-09-02T00:00:00", "type": "TIMESTAMP"},
            "P2": {"value": "24", "type": "INT4"},
            "P3": "R",
        },
    })


@_query("""WITH ends AS (SELECT min(l_orderkey) AS low, max(l_orderkey) AS high FROM lineitem),
                splits AS (SELECT CAST(i AS INTEGER) AS split, low + (high - low) * i // 16 AS a,
                                  low + (high - low) * (i + 1) // 16 AS b FROM ends, range(16) t(i))
           SELECT split, count(l_orderkey) AS rows FROM splits LEFT JOIN lineitem
               ON (l_orderkey >= a OR split = 0) AND (l_orderkey < b OR split = 15)
           GROUP BY split""")
def jdbc_splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _table(spark, sf_dir, "lineitem")
    low, high = bounds(df, "l_orderkey")
    return split_sizes(df, split_predicates("postgres", "l_orderkey", low, high, 16)).select("split", "rows")


@_query("""SELECT CAST(CASE WHEN l_orderkey IS NULL THEN 0 ELSE l_orderkey % 16 END AS INTEGER) AS split, count(*) AS rows
           FROM lineitem GROUP BY 1""")
def jdbc_splits_modulo(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _table(spark, sf_dir, "lineitem")
    return split_sizes(df, split_predicates("sqlserver", "l_orderkey", None, None, 16, "modulo")).select("split", "rows")


FIRST_DAY = "2024-01-02"


@_query(f"""SELECT l_orderkey, l_linenumber, 'EU' AS region, l_shipdate >= TIMESTAMP '1995-06-17 00:00:00' AS late, '{FIRST_DAY[:4]}' AS year
            FROM lineitem""")
def scan_sql_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens in the query, the stream name and a parameter, with a variable from the environment."""
    _views(spark, sf_dir, "lineitem")
    spec = ferry.make_spec({
        "stream_name": "lineitem",
        "sql": "SELECT l_orderkey, l_linenumber, '{{ .REGION }}' AS region, l_shipdate >= $1 AS late, '{{ YYYY }}' AS year FROM {{stream_name}}",
        "params": {"P1": {"value": "{{ .CUT }}T00:00:00", "type": "TIMESTAMP"}},
    })
    variables = {"FERRY_VAR_REGION": "EU", "FERRY_VAR_CUT": "1995-06-17"}
    return ferry.plan(spark, with_tokens(spec, variables, date.fromisoformat(FIRST_DAY)))


@_query("""WITH ends AS (SELECT min(l_discount) AS low, max(l_discount) AS high FROM lineitem),
                splits AS (SELECT CAST(i AS INTEGER) AS split, low * (1 - i / 16) + high * (i / 16) AS a,
                                  low * (1 - (i + 1) / 16) + high * ((i + 1) / 16) AS b FROM ends, range(16) t(i))
           SELECT split, count(l_discount) AS rows FROM splits LEFT JOIN lineitem
               ON (l_discount >= a OR split = 0) AND (l_discount < b OR split = 15)
           GROUP BY split""")
def jdbc_splits_fractions(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _table(spark, sf_dir, "lineitem").select(F.col("l_discount").cast("double").alias("l_discount"))
    low, high = bounds(df, "l_discount")
    return split_sizes(df, split_predicates("postgres", "l_discount", low, high, 16)).select("split", "rows")


@_query("""SELECT CAST(split AS INTEGER) AS split, count(text) AS rows FROM range(16) r(split) LEFT JOIN (
               SELECT text, CASE WHEN text IS NULL THEN 0 ELSE CAST('0x' || left(md5(text), 8) AS BIGINT) % 16 END AS part FROM documents
           ) ON part = split GROUP BY split""")
def jdbc_splits_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _table(spark, sf_dir, "documents")
    return split_sizes(df, split_predicates("spark", "text", None, None, 16, "hash")).select("split", "rows")


DEEP = (("lineitem", "l_extendedprice"), ("lineitem", "l_shipdate"), ("lineitem", "l_returnflag"), ("customer", "c_name"), ("documents", "text"))


@_query(" UNION ALL ".join(f"SELECT '{c}' AS name, count(*) AS rows, true AS even FROM {t}" for t, c in DEEP))
def jdbc_splits_depth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts at the quantiles of numbers, days and text: together all rows, none of more than 1.2 parts' rows unless one
    value fills it."""
    lines = []
    for table, column in DEEP:
        df = _table(spark, sf_dir, table).select(column)
        predicates = depth_predicates(column, cut_points(df, column, 16), lambda v: jdbc_literal(v, "spark"))
        part = F.coalesce(*(F.when(F.expr(p), F.lit(i)) for i, p in enumerate(predicates)))
        parts = df.groupBy(part.alias("part")).agg(F.count("*").alias("n"), F.min(column).eqNullSafe(F.max(column)).alias("one"))
        fits = (F.col("n") <= 1.2 * F.sum("n").over(Window.partitionBy()) / 16 + 1) | F.col("one")
        lines.append(parts.withColumn("fits", fits).agg(F.lit(column).alias("name"), F.sum("n").alias("rows"), F.every("fits").alias("even")))
    return reduce(DataFrame.unionAll, lines)


@_query("SELECT event_type, count(*) AS events, max(value) AS largest FROM events GROUP BY event_type")
def exec_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    _views(spark, sf_dir, "events")
    ferry.exec_sql(spark, "CREATE OR REPLACE TEMPORARY VIEW ferry_large_events AS SELECT * FROM events")
    return ferry.plan(spark, {
        "sql": "SELECT event_type, count(*) AS events, max(value) AS largest FROM ferry_large_events GROUP BY event_type"
    })


TEXTS = ("TEXT", "VARCHAR", "JSONB")


def _measures(table: str, columns: str) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{name}' AS name, '{kind}' AS type, CAST({i} AS INTEGER) AS position, count(*) AS rows,
            count(*) - count({name}) AS nulls, {f'max(length({name}))' if kind in TEXTS else 'CAST(NULL AS BIGINT)'} AS max_length
            FROM {table}"""
        for i, (name, kind) in enumerate(c.split() for c in columns.split(","))
    )


@_query(_measures("documents", "doc_id BIGINT,text TEXT,lang TEXT,source TEXT,n_chars BIGINT"))
def describe_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ferry.measure_columns(_table(spark, sf_dir, "documents"))


# Column types

@_query("""SELECT l_orderkey, CAST(l_partkey AS INTEGER) AS l_partkey, CAST(l_suppkey AS INTEGER) AS l_suppkey,
                  CAST(l_linenumber AS SMALLINT) AS l_linenumber, CAST(l_quantity AS REAL) AS l_quantity,
                  CAST(CAST(l_extendedprice AS VARCHAR) AS DECIMAL(15,2)) AS l_extendedprice, l_discount, l_tax,
                  l_returnflag, l_linestatus, l_shipdate FROM lineitem""")
def type_alias(spark: SparkSession, sf_dir: str) -> DataFrame:
    declared = {
        "l_orderkey": "INT8", "l_partkey": "INT", "l_suppkey": "INT4", "l_linenumber": "INT2", "l_quantity": "FLOAT4",
        "l_extendedprice": "DECIMAL(15,2)", "l_discount": "FLOAT8", "l_tax": "DOUBLE PRECISION",
        "l_returnflag": "CHARACTER VARYING(1)",
    }
    return ferry.normalise(_table(spark, sf_dir, "lineitem"), declared=declared)


@_query("""SELECT CAST(o_orderkey AS INTEGER) AS o_orderkey, o_custkey, o_orderstatus,
                  CAST(CAST(o_totalprice AS VARCHAR) AS DECIMAL(12,1)) AS o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate,
                  o_orderpriority, o_orderstatus = 'F' AS o_done FROM orders""")
def map_types_postgres(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _table(spark, sf_dir, "orders").withColumn("o_done", F.when(F.col("o_orderstatus") == "F", "t").otherwise("f"))
    declared = {
        "o_orderkey": "int4", "o_custkey": "int8", "o_orderstatus": "bpchar(1)", "o_totalprice": "numeric(12,1)",
        "o_orderdate": "date", "o_orderpriority": "varchar(15)", "o_done": "bool",
    }
    return ferry.normalise(df, "postgres", declared)


# SQL text that puts the first three groups of a UUID's 32 digits `{0}` into their reading order.
SWAPPED = (
    "substr({0},7,2) || substr({0},5,2) || substr({0},3,2) || substr({0},1,2) || '-' || substr({0},11,2) || substr({0},9,2)"
    " || '-' || substr({0},15,2) || substr({0},13,2) || '-' || substr({0},17,4) || '-' || substr({0},21,12)"
)
DIGEST = "md5(CAST(event_id AS VARCHAR))"


@_query(f"""SELECT CAST(event_id AS INTEGER) AS event_id, ts, CAST(user_id AS SMALLINT) AS user_id, event_type,
                   CAST(CAST(value AS VARCHAR) AS DECIMAL(19,4)) AS value, props, {SWAPPED.format(DIGEST)} AS guid,
                   value > 50 AS flag FROM events""")
def map_types_sqlserver(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _table(spark, sf_dir, "events").withColumns({
        "guid": F.unhex(F.md5(F.col("event_id").cast("string"))),
        "flag": F.when(F.col("value") > 50, 1).otherwise(0),
    })
    declared = {
        "event_id": "INT", "ts": "DATETIME2", "user_id": "TINYINT", "event_type": "NVARCHAR(20)", "value": "MONEY",
        "props": "NVARCHAR", "guid": "UNIQUEIDENTIFIER", "flag": "BIT",
    }
    return ferry.normalise(df, "sqlserver", declared)


@_query("""SELECT CAST(event_id AS DECIMAL(38,0)) AS event_id, ts, CAST(user_id AS DECIMAL(10,0)) AS user_id, event_type,
                  value, props FROM events""")
def map_types_snowflake(spark: SparkSession, sf_dir: str) -> DataFrame:
    declared = {
        "event_id": "FIXED(38,0)", "ts": "TIMESTAMP_LTZ", "user_id": "NUMBER(10,0)", "event_type": "TEXT(16)",
        "value": "FLOAT", "props": "VARIANT",
    }
    return ferry.normalise(_table(spark, sf_dir, "events"), "snowflake", declared)


@_query("""SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, o_custkey, o_orderstatus,
                  CAST(CAST(o_totalprice AS VARCHAR) AS DECIMAL(15,2)) AS o_totalprice,
                  CAST(o_orderdate AS DATE) AS o_orderdate, o_orderpriority FROM orders""")
def override_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    overrides = [
        {"name": "O_TOTALPRICE", "type": "numeric", "precision": 15, "scale": 2},
        {"name": "o_orderdate", "type": "DATE"},
        {"name": "o_orderkey", "type": "TEXT"},
        {"name": "not_there", "type": "INT4"},
    ]
    return ferry.override(_table(spark, sf_dir, "orders"), overrides)


# Conversions

def _converted(df: DataFrame, **types: str) -> DataFrame:
    return ferry.override(df, [{"name": name, "type": kind} for name, kind in types.items()])


LINE_KEYS = ("l_orderkey", "l_linenumber", "l_partkey")


def _line_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines with a number as double, as text and with some NULLs."""
    quantity = F.col("l_quantity")
    return _table(spark, sf_dir, "lineitem").select(
        *LINE_KEYS,
        (quantity + F.col("l_discount")).alias("fraction"),
        (-quantity.cast("int")).cast("string").alias("text"),
        F.nullif(F.col("l_linenumber"), F.lit(3)).alias("some"),
    )


def _lines_as(kind: str) -> str:
    whole = "trunc(l_quantity + l_discount)" if kind in ("SMALLINT", "INTEGER", "BIGINT") else "l_quantity + l_discount"
    return f"""SELECT {', '.join(LINE_KEYS)}, CAST({whole} AS {kind}) AS fraction,
                      CAST(-CAST(l_quantity AS INTEGER) AS {kind}) AS text, CAST(nullif(l_linenumber, 3) AS {kind}) AS some
               FROM lineitem"""


@_query(_lines_as("SMALLINT"))
def to_smallint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _converted(_line_sources(spark, sf_dir), fraction="INT2", text="SMALLINT", some="SMALLINT")


@_query(_lines_as("INTEGER"))
def to_integer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _converted(_line_sources(spark, sf_dir), fraction="INT4", text="INTEGER", some="INT")


@_query(_lines_as("BIGINT"))
def to_bigint(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _line_sources(spark, sf_dir).withColumn("fraction", F.col("fraction").cast("string").cast("decimal(20,4)"))
    return _converted(df, fraction="INT8", text="BIGINT", some="BIGINT")


@_query(_lines_as("REAL"))
def to_real(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _converted(_line_sources(spark, sf_dir), fraction="FLOAT4", text="REAL", some="REAL")


@_query(_lines_as("DOUBLE"))
def to_double(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _converted(_line_sources(spark, sf_dir), text="FLOAT8", some="DOUBLE PRECISION")


@_query("""SELECT l_orderkey, l_linenumber, l_partkey, CAST(CAST(l_extendedprice AS VARCHAR) AS DECIMAL(15,2)) AS price,
                  CAST(CAST(l_discount AS VARCHAR) AS DECIMAL(38,15)) AS discount,
                  CAST(CAST(CAST(l_extendedprice AS VARCHAR) AS DECIMAL(15,2)) AS DECIMAL(12,1)) AS rounded,
                  CAST(l_orderkey AS DECIMAL(18,2)) AS key FROM lineitem""")
def to_numeric(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _table(spark, sf_dir, "lineitem").select(
        *LINE_KEYS,
        F.col("l_extendedprice").alias("price"),
        F.col("l_discount").cast("string").alias("discount"),
        F.col("l_extendedprice").cast("string").cast("decimal(15,2)").alias("rounded"),
        F.col("l_orderkey").alias("key"),
    )
    return _converted(df, price="NUMERIC(15,2)", discount="DECIMAL(38,15)", rounded="NUMERIC(12,1)", key="NUMERIC(18,2)")


@_query("""SELECT o_orderkey, o_orderstatus = 'F' AS flag, CASE WHEN o_orderstatus = 'P' THEN NULL
           ELSE o_orderstatus = 'O' END AS text FROM orders""")
def to_boolean(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = F.col("o_orderstatus")
    df = _table(spark, sf_dir, "orders").select(
        "o_orderkey",
        (status == "F").cast("int").alias("flag"),
        F.when(status == "O", "true").when(status == "F", "false").alias("text"),
    )
    return _converted(df, flag="BOOL", text="BOOLEAN")


@_query("""SELECT event_id, CAST(ts AS DATE) AS day, CAST(ts AS DATE) - DATE '1970-01-01' AS days FROM events""")
def to_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _table(spark, sf_dir, "events").select("event_id", F.col("ts").alias("day"))
    return _converted(df, day="DATE").select("event_id", "day", F.unix_date("day").cast("long").alias("days"))


@_query("SELECT event_id, ts, epoch_us(ts) AS micros FROM events")
def to_timestamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _table(spark, sf_dir, "events").select("event_id", F.col("ts").cast("string").alias("ts"))
    return _converted(df, ts="TIMESTAMP").select("event_id", "ts", F.unix_micros(F.col("ts").cast("timestamp")).alias("micros"))


@_query("SELECT event_id, epoch_us(ts) - 7200000000 AS micros FROM events")
def to_timestamptz(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.concat(F.col("ts").cast("string"), F.lit("+02:00")).alias("at")
    df = _table(spark, sf_dir, "events").select("event_id", text)
    return _converted(df, at="TIMESTAMPTZ").select("event_id", F.unix_micros("at").alias("micros"))


@_query(f"""SELECT event_id, CAST(CAST({DIGEST} AS UUID) AS VARCHAR) AS dashed, CAST(CAST({DIGEST} AS UUID) AS VARCHAR) AS urn,
                   CAST(CAST({DIGEST} AS UUID) AS VARCHAR) AS raw FROM events""")
def to_uuid(spark: SparkSession, sf_dir: str) -> DataFrame:
    digest = F.md5(F.col("event_id").cast("string"))
    canonical = fn.to_uuid(digest, StringType())
    df = _table(spark, sf_dir, "events").select(
        "event_id",
        F.upper(digest).alias("dashed"),
        F.concat(F.lit("urn:uuid:"), canonical).alias("urn"),
        F.unhex(digest).alias("raw"),
    )
    return _converted(df, dashed="UUID", urn="UUID", raw="UUID")


@_query(f"SELECT event_id, upper({DIGEST}) AS digits, CAST(CAST({DIGEST} AS UUID) AS VARCHAR) AS text FROM events")
def uuid_to_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _table(spark, sf_dir, "events").select("event_id", F.md5(F.col("event_id").cast("string")).alias("text"))
    return _converted(_converted(df, text="UUID"), text="TEXT").select(
        "event_id", F.hex(fn.uuid_bytes(F.col("text"))).alias("digits"), "text"
    )


@_query(f"SELECT event_id, {SWAPPED.format(DIGEST)} AS guid FROM events")
def uuid_fix_sqlserver(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _table(spark, sf_dir, "events").select("event_id", F.unhex(F.md5(F.col("event_id").cast("string"))).alias("guid"))
    return ferry.normalise(df, "sqlserver", {"guid": "UNIQUEIDENTIFIER"})


@_query("""SELECT vec_id, '[' || array_to_string(list_transform(embedding, lambda x: regexp_replace(CASE WHEN abs(x) < 0.0001
                  THEN CAST(CAST(CAST(x AS VARCHAR) AS DECIMAL(38,20)) AS VARCHAR) ELSE CAST(x AS VARCHAR) END,
                  '\\.?0+$', '')), ',') || ']' AS embedding FROM embeddings""")
def to_json_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return _converted(_converted(df, embedding="JSONB"), embedding="TEXT")


def _rendered(name: str, df: DataFrame, logical: str = ""):
    return F.expr(fn.render_text(name, df.schema[name].dataType, logical)).alias(name)


@_query("""SELECT CAST(event_id AS VARCHAR) AS event_id, replace(CAST(ts AS VARCHAR), ' ', 'T') AS ts,
                  regexp_replace(CAST(value AS VARCHAR), '\\.0$', '') AS value, CAST(value > 50 AS VARCHAR) AS flag, props FROM events""")
def to_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _table(spark, sf_dir, "events").select(
        "event_id", "ts", "value", (F.col("value") > 50).alias("flag"), "props"
    )
    return _converted(df, event_id="TEXT", ts="TEXT", value="VARCHAR(20)", flag="TEXT", props="TEXT")


@_query("""SELECT doc_id, coalesce(TRY_CAST(source AS INTEGER), 0) AS source, coalesce(TRY_CAST(lang AS DOUBLE), 0) AS lang,
                  n_chars FROM documents""")
def lenient_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "n_chars")
    return ferry.override(df, [{"name": "source", "type": "INT4"}, {"name": "lang", "type": "FLOAT8"}], on_error="zero")


# Text forms

@_query("SELECT event_id, replace(CAST(ts AS VARCHAR), ' ', 'T') AS ts FROM events")
def render_timestamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "events").select("event_id", F.expr(fn.render_timestamp("ts")).alias("ts"))


@_query("SELECT event_id, replace(CAST(ts AS VARCHAR), ' ', 'T') || 'Z' AS ts FROM events")
def render_timestamptz(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "events").select(
        "event_id", F.expr(fn.render_timestamptz("cast(ts AS timestamp)")).alias("ts")
    )


@_query("SELECT event_id, CAST(json(props) AS VARCHAR) AS props FROM events")
def render_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "events").select("event_id", F.expr(fn.compact_json("props")).alias("props"))


@_query("""SELECT event_id, '{"e":' || event_id * 100 || ',"f":' || event_id || ',"n":[{"t":"1e2 ' || event_id || '.0"},' ||
                  regexp_replace(CAST(event_id * CAST(0.001 AS DECIMAL(20,3)) AS VARCHAR), '[.]?0*$', '') || ',-0.5,1e+30,2e-9]}' AS text FROM events""")
def render_json_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers with exponents and without need of a point; text that looks like one stays."""
    text = """concat('{"f":', event_id, '.0, "e":', event_id, 'e2, "n":[{"t":"1e2 ', event_id, '.0"},', event_id, 'e-3,-0.50,1e30,0.2E-8]}')"""
    return _table(spark, sf_dir, "events").selectExpr("event_id", f"{text} AS given").select(
        "event_id", F.expr(fn.compact_json("given")).alias("text"))


@_query("""SELECT event_id, '{"a":' || event_id || ',"b":{"k":"last"}}' AS text FROM events""")
def render_json_repeated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of a key that is repeated the last value counts."""
    text = """concat('{"a":"first","b":{"k":', event_id, ',"k":"last"},"a":', event_id, '}')"""
    return _table(spark, sf_dir, "events").selectExpr("event_id", f"{text} AS given").select(
        "event_id", F.expr(fn.compact_json("given")).alias("text"))


@_query("""SELECT o_orderkey, CAST(CAST(CAST(o_totalprice AS VARCHAR) AS DECIMAL(20,6)) AS VARCHAR) AS price,
                  CAST(CAST(o_custkey AS DECIMAL(12,3)) AS VARCHAR) AS customer FROM orders""")
def render_numeric(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _table(spark, sf_dir, "orders").select(
        "o_orderkey", F.col("o_totalprice").alias("price"), F.col("o_custkey").alias("customer")
    )
    df = _converted(df, price="NUMERIC(20,6)", customer="NUMERIC(12,3)")
    return df.select("o_orderkey", _rendered("price", df), _rendered("customer", df))


FLOAT_COLUMNS = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


@_query(f"""SELECT l_orderkey, l_linenumber, l_partkey,
                   {', '.join(f"regexp_replace(CAST({c} AS VARCHAR), '[.]0$', '') AS {c}" for c in FLOAT_COLUMNS)},
                   CAST(CAST(l_extendedprice AS BIGINT) AS VARCHAR) || '00000000000' AS large
            FROM lineitem""")
def render_float(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _table(spark, sf_dir, "lineitem")
    df = df.withColumn("large", F.rint("l_extendedprice") * 1e11)
    return df.select(*LINE_KEYS, *(F.expr(fn.render_float(c, DoubleType())).alias(c) for c in (*FLOAT_COLUMNS, "large")))


@_query("SELECT o_orderkey, CAST(to_json([o_orderstatus, o_orderpriority]) AS VARCHAR) AS listed FROM orders")
def render_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _table(spark, sf_dir, "orders").select("o_orderkey", F.array("o_orderstatus", "o_orderpriority").alias("listed"))
    return df.select("o_orderkey", _rendered("listed", df))


def _csv_sql(c: str) -> str:
    return f"""CASE WHEN {c} IS NULL THEN 'NULL' WHEN regexp_matches({c}, '[,"\\r\\n]|^\\s|^\\\\\\.$')
               THEN '"' || replace({c}, '"', '""') || '"' ELSE {c} END"""


@_query(f"""SELECT CAST(doc_id AS VARCHAR) || ',' || {_csv_sql('text')} || ',' || {_csv_sql("nullif(lang, 'en')")} || ',' ||
                   {_csv_sql('source')} || ',' || CAST(n_chars AS VARCHAR) AS value FROM documents""")
def csv_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _table(spark, sf_dir, "documents").withColumn("lang", F.nullif(F.col("lang"), F.lit("en")))
    return ferry.csv_lines(df)


@_query("""SELECT '{"event_id":' || event_id || ',"event_type":"' || event_type || '","props":' || json(props) || ',"ts":"' ||
                  replace(CAST(ts AS VARCHAR), ' ', 'T') || '","user_id":' || user_id || ',"value":' ||
                  regexp_replace(CAST(value AS VARCHAR), '[.]0$', '') || '}' AS value FROM events""")
def jsonl_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ferry.jsonl_lines(_converted(_table(spark, sf_dir, "events"), props="JSONB"))


@_query("""SELECT '{"conv_id":' || conv_id || ',"role":' || CASE WHEN role = 'user' THEN 'null' ELSE to_json(role) END
                  || ',"text":' || replace(replace(replace(to_json(text), '<', '\\u003c'), '>', '\\u003e'), '&', '\\u0026')
                  || ',"turn":' || turn || '}' AS value FROM conversations""")
def jsonl_lines_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _table(spark, sf_dir, "conversations").withColumn("role", F.nullif(F.col("role"), F.lit("user")))
    return ferry.jsonl_lines(df)


@_query("""SELECT '{"html":' || replace(replace(replace(to_json(html), '<', '\\u003c'), '>', '\\u003e'), '&', '\\u0026')
                  || ',"page_id":' || page_id || ',"url":' || replace(to_json(url), '&', '\\u0026') || '}' AS value FROM pages""")
def jsonl_lines_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text in which every row holds characters that are written by number."""
    return ferry.jsonl_lines(_table(spark, sf_dir, "pages"))


@_query("""SELECT o_orderkey, CAST(replace(CAST(CAST(CAST(o_totalprice AS VARCHAR) AS DECIMAL(15,2)) AS VARCHAR), '.', '') AS BIGINT) * 1000
           AS unscaled FROM orders""")
def decimal_unscaled(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.col("o_totalprice").cast("decimal(15,2)").cast("string").alias("price")
    df = _table(spark, sf_dir, "orders").select("o_orderkey", text)
    return df.select("o_orderkey", fn.decimal_unscaled(F.col("price"), 5).cast("bigint").alias("unscaled"))


@_query(r"""SELECT page_id, regexp_replace(regexp_replace(replace(url, '://', '://user:secret@'),
            '^([a-zA-Z][a-zA-Z0-9+.-]*://)[^/?#]*@', '\1'), '[?][^#]*', '') AS url FROM pages""")
def redact_url(spark: SparkSession, sf_dir: str) -> DataFrame:
    with_user = F.replace(F.col("url"), F.lit("://"), F.lit("://user:secret@"))
    return _table(spark, sf_dir, "pages").select("page_id", ferry.redact_url(with_user).alias("url"))


# Landing

def _landed(spark: SparkSession, sf_dir: str, table: str, **spec) -> str:
    """Folder of a finished move of one table."""
    folder = work_folder(spark)
    ferry.move(spark, {"stream_name": table, "filename": "{{stream_name}}{{ext}}", **spec}, folder, f"parquet:{sf_dir}")
    return f"{folder}/{table}{extension(spec['format'], spec.get('compression', ''))}"


@_query("SELECT * FROM documents")
def sink_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _landed(spark, sf_dir, "documents", format="csv", batch_size=20000)
    return _read_back(spark, path, _table(spark, sf_dir, "documents"), "csv")


@_query("SELECT * EXCLUDE (props), CAST(json(props) AS VARCHAR) AS props FROM events")
def sink_jsonl(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _landed(spark, sf_dir, "events", format="jsonl", columns=[{"name": "props", "type": "JSONB"}])
    return _read_back(spark, path, _table(spark, sf_dir, "events"), "jsonl")


@_query("""SELECT csv AS value FROM (
    SELECT s_suppkey || ',' || s_name || ',' || s_nationkey || ',' || regexp_replace(CAST(s_acctbal AS VARCHAR), '[.]0$', '') AS csv
    FROM supplier ORDER BY s_suppkey LIMIT 20)""")
def sink_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    _views(spark, sf_dir, "supplier")
    return ferry.preview(spark, {"sql": "SELECT * FROM supplier ORDER BY s_suppkey", "format": "csv"}, rows=20)


METADATA = "o_orderkey BIGINT,o_custkey INTEGER,o_orderstatus VARCHAR,o_totalprice NUMERIC,o_orderdate DATE,o_orderpriority JSONB"


METADATA_SQL = """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
                         concat('"', o_orderpriority, '"') AS o_orderpriority FROM orders"""


@_query(_measures(f"({METADATA_SQL}) t", METADATA))
def column_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Canonical types travel with the file: what a reader of the landed table measures shows them."""
    _views(spark, sf_dir, "orders")
    folder = work_folder(spark)
    overrides = [{"name": n, "type": t, "precision": 15, "scale": 2} if t == "NUMERIC" else {"name": n, "type": t}
                 for n, t in (c.split() for c in METADATA.split(","))]
    ferry.move(spark, {"sql": METADATA_SQL, "columns": overrides, "format": "parquet", "filename": "orders{{ext}}"}, folder)
    return ferry.measure_columns(spark.read.parquet(f"{folder}/orders.parquet"))


@_query("SELECT * FROM lineitem")
def sink_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(_landed(spark, sf_dir, "lineitem", format="parquet"))


@_query("SELECT * FROM lineitem")
def sink_arrow(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _landed(spark, sf_dir, "lineitem", format="arrow")
    arrow.register(spark)
    return spark.read.format("ferry_arrow").load(path)


@_query("SELECT CASE WHEN doc_id % 5 = 0 THEN NULL WHEN doc_id % 5 = 1 THEN '' ELSE text END AS text FROM documents")
def sink_csv_one_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blank and NULL rows of a single column have lines."""
    _views(spark, sf_dir, "documents")
    folder = work_folder(spark)
    spec = {"sql": "SELECT CASE WHEN doc_id % 5 = 0 THEN NULL WHEN doc_id % 5 = 1 THEN '' ELSE text END AS text FROM documents",
            "format": "csv", "filename": "texts{{ext}}"}
    report = ferry.move(spark, spec, folder).first()
    back = spark.read.schema("text string").csv(
        f"{folder}/texts.csv", header=True, multiLine=True, escape='"', nullValue="NULL", emptyValue="",
        ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    if back.count() != report.rows:
        raise AssertionError(f"{report.rows} rows reported, {back.count()} landed")
    return back


@_query("SELECT * FROM orders")
def sink_compression(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _landed(spark, sf_dir, "orders", format="csv", compression="gzip")
    return _read_back(spark, path, _table(spark, sf_dir, "orders"), "csv")


@_query("SELECT * FROM orders")
def sink_chunking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(_landed(spark, sf_dir, "orders", format="parquet", batch_size=5000))


@_query("SELECT * FROM customer WHERE c_custkey < 0")
def sink_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    _views(spark, sf_dir, "customer")
    folder = work_folder(spark)
    spec = {"sql": "SELECT * FROM customer WHERE c_custkey < $1", "params": {"P1": {"value": "0", "type": "INT8"}},
            "format": "csv", "filename": "none{{ext}}"}
    ferry.move(spark, spec, folder)
    return _read_back(spark, f"{folder}/none.csv", _table(spark, sf_dir, "customer"), "csv")


@_query("SELECT * FROM supplier")
def sink_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = work_folder(spark)
    for table in ("customer", "supplier"):
        spec = {"stream_name": table, "format": "parquet", "filename": "same{{ext}}"}
        ferry.move(spark, spec, folder, f"parquet:{sf_dir}")
    return spark.read.parquet(f"{folder}/same.parquet")


@_query(" UNION ALL ".join(
    f"SELECT '{fmt}' AS format, o_orderkey, o_custkey, o_orderstatus FROM orders" for fmt in ("csv", "jsonl", "parquet", "arrow")
))
def sink_overwrite_failed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a folder of each format holds after a second move to it that fails at its last rows."""
    _views(spark, sf_dir, "orders")
    folder, rows = work_folder(spark), None
    for fmt in ("csv", "jsonl", "parquet", "arrow"):
        spec = {"sql": "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders", "format": fmt, "filename": "same{{ext}}"}
        ferry.move(spark, spec, folder)
        last = "(SELECT max(o_orderkey) FROM orders)"
        bad = f"SELECT o_orderkey, o_custkey, IF(o_orderkey = {last}, 'one', '1') AS o_orderstatus FROM orders"
        try:
            ferry.move(spark, spec | {"sql": bad, "columns": [{"name": "o_orderstatus", "type": "INTEGER"}]}, folder)
            raise AssertionError("the second move did not fail")
        except ferry.MoveError:
            pass
        back = ferry.read_landed(spark, f"{folder}/same.{fmt}", fmt, "o_orderkey long, o_custkey long, o_orderstatus string")
        back = back.select(F.lit(fmt).alias("format"), "o_orderkey", "o_custkey", "o_orderstatus")
        rows = back if rows is None else rows.unionAll(back)
    return rows


@_query("SELECT * FROM events")
def sink_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _landed(spark, sf_dir, "events", format="parquet", partition_by=["event_type"])
    return spark.read.parquet(path)


@_query("SELECT * FROM events")
def sink_arrow_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _landed(spark, sf_dir, "events", format="arrow", partition_by=["event_type"])
    return ferry.read_landed(spark, path, "arrow").select(*_table(spark, sf_dir, "events").columns)


@_query("""SELECT o_orderkey, o_totalprice, o_orderstatus, o_orderpriority FROM orders
           WHERE o_orderstatus IN ('F', 'P') AND o_orderpriority >= '2' AND NOT o_orderpriority LIKE '3%'""")
def sink_arrow_partition_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of some partitions, whose files alone are opened."""
    path = _landed(spark, sf_dir, "orders", format="arrow", partition_by=["o_orderstatus", "o_orderpriority"])
    rows = ferry.read_landed(spark, path, "arrow").select("o_orderkey", "o_totalprice", "o_orderstatus", "o_orderpriority")
    return rows.filter("o_orderstatus IN ('F', 'P') AND o_orderpriority >= '2' AND NOT o_orderpriority LIKE '3%'")


@_query("SELECT event_type, value FROM events")
def sink_partitioned_jsonl(spark: SparkSession, sf_dir: str) -> DataFrame:
    _views(spark, sf_dir, "events")
    folder = work_folder(spark)
    spec = {"sql": "SELECT event_type, value FROM events", "format": "jsonl", "partition_by": ["EVENT_TYPE"], "filename": "events{{ext}}"}
    ferry.move(spark, spec, folder)
    return spark.read.schema("value double, event_type string").json(f"{folder}/events.jsonl").select("event_type", "value")


# Settings, paths and formats of moves

@_query("SELECT 'parquet' AS scheme, * FROM supplier UNION ALL SELECT 'table' AS scheme, * FROM supplier")
def source_by_scheme(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same table through a folder's address and through the catalog."""
    _views(spark, sf_dir, "supplier")
    plans = [(scheme, ferry.plan(spark, {"stream_name": "supplier"}, url)) for scheme, url in (("parquet", f"parquet:{sf_dir}"), ("table", "table:"))]
    parts = [df.select(F.lit(scheme).alias("scheme"), "*") for scheme, df in plans]
    return parts[0].unionByName(parts[1])


@_query("""SELECT o_orderkey, CAST(o_custkey AS BIGINT) AS o_custkey, CAST(CAST(o_totalprice AS VARCHAR) AS DECIMAL(15,2)) AS o_totalprice FROM orders""")
def parse_column_specs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Overrides as YAML text and as JSON text."""
    df = _table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    df = ferry.override(df, ferry.parse_column_specs("- {name: O_CUSTKEY, type: INT8}"))
    return ferry.override(df, ferry.parse_column_specs('[{"name": "o_totalprice", "type": "NUMERIC", "precision": 15, "scale": 2}]'))


@_query("SELECT o_orderkey AS key, o_orderpriority AS priority, o_totalprice AS price FROM orders")
def field_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A landed table read by the ids of its columns, under other names."""
    path = _landed(spark, sf_dir, "orders", format="parquet")
    landed = spark.read.parquet(path).schema
    ids = {f.name: i for i, f in enumerate(_table(spark, sf_dir, "orders").schema.fields)}
    wanted = StructType([
        StructField(name, landed[c].dataType, True, {"parquet.field.id": ids[c]})
        for name, c in (("key", "o_orderkey"), ("priority", "o_orderpriority"), ("price", "o_totalprice"))
    ])
    setting, copy = "spark.sql.parquet.fieldId.read.enabled", work_folder(spark)
    before = spark.conf.get(setting)
    spark.conf.set(setting, "true")
    try:
        spark.read.schema(wanted).parquet(path).write.parquet(copy)
    finally:
        spark.conf.set(setting, before)
    return spark.read.parquet(copy)


@_query("""SELECT o_orderkey, CAST(CAST(o_totalprice AS VARCHAR) AS DECIMAL(9,2)) AS small,
                  CAST(CAST(o_totalprice AS VARCHAR) AS DECIMAL(18,4)) AS middle, CAST(CAST(o_totalprice AS VARCHAR) AS DECIMAL(38,10)) AS large FROM orders""")
def decimal_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decimals that Parquet stores in 4, 8 and 16 bytes."""
    _views(spark, sf_dir, "orders")
    folder = work_folder(spark)
    spec = {
        "sql": "SELECT o_orderkey, o_totalprice AS small, o_totalprice AS middle, o_totalprice AS large FROM orders", "format": "parquet", "filename": "d{{ext}}",
        "columns": [{"name": "small", "type": "NUMERIC(9,2)"}, {"name": "middle", "type": "NUMERIC(18,4)"}, {"name": "large", "type": "NUMERIC(38,10)"}],
    }
    ferry.move(spark, spec, folder)
    return spark.read.parquet(f"{folder}/d.parquet")


LONG_DIGITS = "concat(lpad(cast(l_orderkey AS {0}), 12, '7'), lpad(cast(l_partkey AS {0}), 13, '3'), lpad(cast(l_suppkey AS {0}), 13, '9'))"


@_query(f"""SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber % 2 = 1
                THEN translate(lpad(hex(u - 1), 32, '0'), '0123456789ABCDEF', 'FEDCBA9876543210') ELSE lpad(hex(u), 32, '0') END AS large,
                CASE WHEN l_linenumber % 3 = 0 THEN right(translate(lpad(hex(l_orderkey * 100 - 1), 16, '0'), '0123456789ABCDEF', 'FEDCBA9876543210'), 14)
                     ELSE lpad(hex(l_orderkey * 100), 14, '0') END AS small
            FROM (SELECT *, CAST({LONG_DIGITS.format("VARCHAR")} AS HUGEINT) AS u FROM lineitem)""")
def decimal_bytes_hex(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decimals of 38 and of 15 digits, some negative, as the bytes that columnar files store."""
    digits, large, small = LONG_DIGITS.format("string"), DecimalType(38, 10), DecimalType(15, 2)
    signed = F.expr(f"concat(if(l_linenumber % 2 = 1, '-', ''), left({digits}, 28), '.', right({digits}, 10))")
    other = F.expr("if(l_linenumber % 3 = 0, -l_orderkey, l_orderkey)")
    return _table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.hex(fn.decimal_bytes(signed.cast(large), large)).alias("large"),
        F.hex(fn.decimal_bytes(other.cast(small), small)).alias("small"),
    )


@_query(f"""SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber % 2 = 1 THEN '-' ELSE '' END || (high + low // full_) || left(whole, 20) || '.' || right(whole, 2) AS price
            FROM (SELECT *, lpad(CAST(low % full_ AS VARCHAR), 22, '0') AS whole
                  FROM (SELECT *, CAST('1' || repeat('0', 22) AS HUGEINT) AS full_, CAST('9' || left(d, 29) AS HUGEINT) AS high,
                            (CAST(right(d, 9) || lpad(CAST(l_orderkey AS VARCHAR), 11, '9') || lpad(CAST(l_partkey % 10000 AS VARCHAR), 4, '9') AS HUGEINT) + 50) // 100 AS low
                        FROM (SELECT *, {LONG_DIGITS.format("VARCHAR")} AS d FROM lineitem)))""")
def to_numeric_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts of 50 digits before the point and four behind, as NUMERIC(52,2)."""
    digits = LONG_DIGITS.format("string")
    text = f"""concat(if(l_linenumber % 2 = 1, '-', if(l_linenumber % 4 = 0, '+', '')), if(l_linenumber % 3 = 0, '00', ''), '9', {digits}, lpad(cast(l_orderkey AS string), 11, '9'),
        '.', lpad(cast(l_partkey % 10000 AS string), 4, '9'), if(l_linenumber % 5 = 0, 'e0', ''))"""
    df = _table(spark, sf_dir, "lineitem").selectExpr("l_orderkey", "l_linenumber", f"{text} AS price")
    return ferry.override(df, [{"name": "price", "type": "NUMERIC(52,2)"}])


MEASURED = {"lineitem": "l_orderkey l_quantity l_extendedprice l_discount l_tax l_returnflag", "orders": "o_orderkey o_custkey o_totalprice o_orderpriority"}


def _sizes(table: str, column: str) -> str:
    return f"""SELECT '{column}' AS name, count(*) FILTER (n) AS numbers, CASE WHEN count(*) FILTER (n) > 0 THEN greatest(max(w) + max(f), 1) END AS "precision",
                      CASE WHEN count(*) FILTER (n) > 0 THEN max(f) END AS scale
               FROM (SELECT regexp_full_match(t, '-?[0-9]+([.][0-9]*)?') AS n, CASE WHEN n THEN length(ltrim(split_part(ltrim(t, '-'), '.', 1), '0')) ELSE 0 END AS w,
                            CASE WHEN n THEN length(rtrim(split_part(t, '.', 2), '0')) ELSE 0 END AS f FROM (SELECT CAST({column} AS VARCHAR) AS t FROM {table}))"""


@_query(" UNION ALL ".join(_sizes(t, c) for t, columns in MEASURED.items() for c in columns.split()))
def describe_precision(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The smallest NUMERIC that holds a column's values."""
    found = [ferry.measure_columns(_table(spark, sf_dir, t).select(columns.split()), numbers=True) for t, columns in MEASURED.items()]
    return reduce(DataFrame.unionAll, found).select("name", "numbers", "precision", "scale")


@_query("""SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber % 2 = 1 THEN '-' ELSE '' END || CASE
               WHEN e < 0 THEN '0.' || repeat('0', -e - 1) || d WHEN length(d) <= e + 1 THEN rpad(d, e + 1, '0') ELSE left(d, e + 1) || '.' || substr(d, e + 2) END AS value
           FROM (SELECT *, CAST((l_orderkey * 7 + l_partkey * 5 + l_linenumber) % 615 AS INTEGER) - 307 AS e,
                     rtrim((1 + l_partkey % 9) || lpad(CAST(l_orderkey AS VARCHAR), 9, '0') || lpad(CAST(l_suppkey % 99991 AS VARCHAR), 5, '0'), '0') AS d FROM lineitem)""")
def render_float_extreme(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers of 15 digits between 1e-307 and 1e308, as doubles and back as text."""
    digits = "concat(1 + l_partkey % 9, '.', lpad(cast(l_orderkey AS string), 9, '0'), lpad(cast(l_suppkey % 99991 AS string), 5, '0'))"
    number = f"concat(if(l_linenumber % 2 = 1, '-', ''), {digits}, 'E', (l_orderkey * 7 + l_partkey * 5 + l_linenumber) % 615 - 307)"
    df = _table(spark, sf_dir, "lineitem").selectExpr("l_orderkey", "l_linenumber", f"cast({number} AS double) AS x")
    return df.select("l_orderkey", "l_linenumber", F.expr(fn.render_float("x", DoubleType(), exact=True)).alias("value"))


@_query(" UNION ALL ".join(f"SELECT '{f}' AS landed_as, s_suppkey, s_name FROM supplier" for f in ("arrow", "csv", "jsonl", "parquet")))
def format_dispatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One table landed in each format, whatever the case of its name."""
    _views(spark, sf_dir, "supplier")
    folder, like = work_folder(spark), _table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    arrow.register(spark)
    found = []
    for fmt in ("Arrow", "CSV", "JsonL", "PARQUET"):
        spec = {"sql": "SELECT s_suppkey, s_name FROM supplier", "format": fmt, "filename": "supplier{{ext}}"}
        ferry.move(spark, spec, folder)
        path = f"{folder}/supplier{extension(fmt, '')}"
        if fmt in ("CSV", "JsonL"):
            back = _read_back(spark, path, like, fmt.lower())
        else:
            back = spark.read.format("ferry_arrow" if fmt == "Arrow" else "parquet").load(path)
        found.append(back.select(F.lit(fmt.lower()).alias("landed_as"), "s_suppkey", "s_name"))
    return found[0].unionByName(found[1]).unionByName(found[2]).unionByName(found[3])


@_query("SELECT * FROM customer")
def output_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A name made of tokens, below a destination that ends with a slash."""
    folder = work_folder(spark)
    spec = {"stream_name": "customer", "format": "csv", "compression": "gzip", "filename": "/{{format}}/{{ compression }}/{{stream_name}}{{ext}}"}
    ferry.move(spark, spec, f"{folder}/", f"parquet:{sf_dir}")
    return _read_back(spark, f"{folder}/csv/gzip/customer.csv.gz", _table(spark, sf_dir, "customer"), "csv")


@_query("SELECT l_orderkey, l_quantity >= 24 AS many, 'from the environment' AS note FROM lineitem")
def spec_params(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values of parameters, and a parameter, that come from the environment."""
    _views(spark, sf_dir, "lineitem")
    spec = ferry.make_spec({"sql": "SELECT l_orderkey, l_quantity >= $1 AS many, $2 AS note FROM lineitem", "params": {"P1": {"value": "0", "type": "INT4"}}})
    return ferry.plan(spark, with_environment(spec, {"FERRY_PARAM_P1": "24", "FERRY_PARAM_P2": "from the environment"}))


# Jobs

@_query("""SELECT t.stream, count(*) AS rows, count(*) AS zeros_or_failed FROM (
               SELECT 'lenient' AS stream FROM events UNION ALL SELECT 'strict' AS stream FROM events) t GROUP BY t.stream""")
def move_many_resets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Root settings, and a table that states their defaults again: text that is no number lands as zero, or fails the move."""
    _views(spark, sf_dir, "events")
    job = {
        "on_error": "zero", "null_value": "-", "format": "csv", "filename": "{{stream_name}}{{ext}}",
        "columns": [{"name": "event_type", "type": "INT4"}],
        "tables": [
            {"stream_name": "lenient", "sql": "SELECT event_type, CAST(NULL AS STRING) AS n FROM events"},
            {"stream_name": "strict", "sql": "SELECT event_type, CAST(NULL AS STRING) AS n FROM events", "null_value": "NULL", "columns": []},
            {"stream_name": "failing", "sql": "SELECT event_type FROM events", "on_error": "fail"},
        ],
    }
    folder = work_folder(spark)
    ferry.move_many(spark, job, folder, select="lenient,strict")
    try:
        ferry.move_many(spark, job, folder, select="failing")
    except ferry.MoveError:
        pass
    else:
        raise AssertionError("on_error: fail did not win over the root's zero")
    lenient = spark.read.schema("event_type int, n string").csv(f"{folder}/lenient.csv", header=True, nullValue="NULL")
    strict = spark.read.schema("event_type string, n string").csv(f"{folder}/strict.csv", header=True, nullValue="-")
    return lenient.groupBy(F.lit("lenient").alias("stream")).agg(
        F.count("*").alias("rows"), F.count_if((F.col("event_type") == 0) & (F.col("n") == "-")).alias("zeros_or_failed"),
    ).union(strict.groupBy(F.lit("strict").alias("stream")).agg(F.count("*"), F.count_if((F.col("event_type") != "0") & (F.col("n") == "NULL"))))


@_query("""SELECT 'SELECT * FROM lineitem' AS sql, count(*) AS rows, true AS success, true AS has_bytes, '' AS error
           FROM lineitem""")
def move(spark: SparkSession, sf_dir: str) -> DataFrame:
    _views(spark, sf_dir, "lineitem")
    spec = {"stream_name": "lineitem", "format": "jsonl", "compression": "gzip", "filename": "{{ YYYY }}/{{stream_name}}{{ext}}"}
    report = ferry.move(spark, spec, work_folder(spark))
    return report.select("sql", "rows", "success", (F.col("bytes") > 0).alias("has_bytes"), "error")


@_query("""SELECT count(*) AS rows, 'SELECT doc_id FROM labels' AS sql, true AS success, '' AS error,
                  true AS timed, 'labels.parquet' AS file FROM labels""")
def run_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    _views(spark, sf_dir, "labels")
    spec = {"sql": "SELECT doc_id FROM labels", "format": "parquet", "filename": "labels{{ext}}"}
    report = ferry.move(spark, spec, work_folder(spark))
    file = F.substring_index("path", "/", -1).alias("file")
    return report.select("rows", "sql", "success", "error", (F.col("elapsed_ms") > 0).alias("timed"), file)


MANY = """
format: arrow
compression: snappy
filename: "{{stream_name}}/day={{ DD }}{{ext}}"
tables:
  - stream_name: conversations
  - stream_name: documents
    format: csv
  - stream_name: labels
  - stream_name: embeddings
    columns:
      - {name: embedding, type: JSONB}
"""


@_query(" UNION ALL ".join(
    f"SELECT '{t}' AS stream, count(*) AS rows, true AS success FROM {t}" for t in ("conversations", "documents", "embeddings")
))
def move_many(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = ferry.move_many(
        spark, MANY, work_folder(spark), f"parquet:{sf_dir}", select="Embeddings, documents,conversations", concurrency=2
    )
    return report.select(F.regexp_extract("path", r"([^/]+)/day=\d\d[.a-z]*$", 1).alias("stream"), "rows", "success")


FLAGSHIP = {
    "stream_name": "events",
    "sql": "SELECT event_id, ts, user_id, event_type, value, props FROM events WHERE ts < $1",
    "params": {"P1": {"value": "2024-01-20T00:00:00", "type": "TIMESTAMP"}},
    "columns": [{"name": "props", "type": "JSONB"}],
    "format": "jsonl",
    "filename": "{{stream_name}}{{ext}}",
}


@_query("""SELECT event_id, ts, user_id, event_type, value, CAST(json(props) AS VARCHAR) AS props FROM events
           WHERE ts < TIMESTAMP '2024-01-20 00:00:00'""")
def move_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    _views(spark, sf_dir, "events")
    folder = work_folder(spark)
    ferry.move(spark, FLAGSHIP, folder)
    return _read_back(spark, f"{folder}/events.jsonl", spark.table("events"), "jsonl")


def entry(spark: SparkSession) -> DataFrame:
    """Move the events of a period to JSON lines and read them back."""
    return queries()["move_events"](spark, DATA)


def _training_data(attribute: str) -> dict:
    """What the training-data subpackage and its pipeline register, where they are installed."""
    found: dict = {}
    for package, module in (("ferry.llm", "ferry.llm.queries"), ("corpus_pipeline", "corpus_pipeline")):
        spec = importlib.util.find_spec(package)
        if not (spec and spec.origin):  # a folder without code has no origin
            break  # the pipeline is made of the subpackage's operators
        found.update(getattr(importlib.import_module(module), attribute))
    return found


def queries() -> dict[str, Query]:
    return _QUERIES | _training_data("QUERIES")


def oracle_sql() -> dict[str, str]:
    return _ORACLE | _training_data("ORACLES")
