import importlib
import subprocess
import sys
import time
from dataclasses import replace
from datetime import date
from decimal import Decimal
from pathlib import Path

import pytest

import ferry
from conftest import DATA
from ferry.plans import MoveError, MoveSpec, make_spec, make_specs, merge, preview, redact, select_tables
from ferry.plans.report import redact_text
from ferry.plans.spec import with_environment
from ferry.sinks import extension, hadoop_path, output_path, render_name
from ferry.sources import inline_params, keeps_uuid_order, make_param, read_source
from ferry.sources.jdbc import jdbc_options, read_jdbc, split_predicates
from ferry.sources.params import Param, jdbc_literal, typed_value
from ferry.sources.splits import cut_points, depth_predicates, split_sizes

MULTI = """
format: arrow
compression: snappy
filename: "{{ YYYY }}/{{stream_name}}{{ext}}"
tables:
  - stream_name: public.users
  - stream_name: public.numbers
    format: csv
    compression: gzip
  - stream_name: public.strings
    columns:
      - {name: json_value, type: JSONB}
      - {name: array_value, type: JSONB}
"""


def test_many_specs():
    users, numbers, strings = make_specs(MULTI)
    assert (users.format, users.compression, numbers.format, numbers.compression) == ("arrow", "snappy", "csv", "gzip")
    assert [c.type for c in strings.columns] == ["JSONB", "JSONB"]
    flagged = make_specs(MULTI, {"format": "jsonl", "filename": "f{{ext}}"})
    assert [s.format for s in flagged] == ["jsonl", "csv", "jsonl"] and flagged[0].filename == "f{{ext}}"
    rooted = make_specs({"sql": "SELECT 1", "tables": [{"stream_name": "a"}, {}, {"stream_name": "b", "sql": "SELECT 2"}]})
    assert [s.query() for s in rooted] == ["SELECT * FROM a", "SELECT 1", "SELECT 2"]


def test_merge():
    base = make_spec({"stream_name": "a", "format": "csv", "batch_size": 5, "batch_count": 2, "params": {"k": "v"}})
    over = make_spec({"format": "jsonl", "batch_count": 7})
    out = merge(base, over)
    assert (out.stream_name, out.format, out.batch_size, out.batch_count, out.params) == ("a", "jsonl", 5, 7, {"k": Param("v")})
    assert merge(base, MoveSpec()) == base


def test_validation():
    assert make_spec({"stream_name": "t"}).query() == "SELECT * FROM t"
    for bad in ({}, {"stream_name": "t", "uuid_as": "x"}):
        with pytest.raises(ValueError):
            make_spec(bad).query()
    with pytest.raises(ValueError, match="unknown settings: colour"):
        make_spec({"colour": 1})


@pytest.mark.parametrize("selection, names", [
    ("", ["Table1", "table2"]), ("table1", ["Table1"]), ("TABLE2, table1", ["Table1", "table2"]), ("table3", []),
])
def test_select(selection, names):
    assert [s.stream_name for s in select_tables([MoveSpec("Table1"), MoveSpec("table2")], selection)] == names


def test_params_from_environment():
    spec = make_spec({"stream_name": "t", "params": {"$1": {"value": "first"}, "P5": {"value": "1", "type": "INT4"}}})
    env = {"FERRY_PARAM_$2": "x", "FERRY_PARAM_P5": "7", "OTHER": "y", "FERRY_PARAM_": "z"}
    assert with_environment(spec, env).params == {"$1": Param("first"), "$2": Param("x"), "P5": Param("7", "INT4")}


@pytest.mark.parametrize("value, kind, wanted", [
    ("a", "", "a"), ("7", "INT2", 7), ("-9", "INT8", -9), (True, "BOOLEAN", True), ("f", "BOOL", False),
    ("1.50", "NUMERIC(9,2)", Decimal("1.50")), ("2.5", "FLOAT8", 2.5), ("2024-01-02", "DATE", date(2024, 1, 2)),
])
def test_typed_values(value, kind, wanted):
    assert typed_value(make_param({"value": value, "type": kind})) == wanted


@pytest.mark.parametrize("value, kind", [
    ("x", "INT4"), ("40000", "INT2"), ("maybe", "BOOLEAN"), ("1", "INTERVAL"), ("1.x", "NUMERIC"),
    ("2024-01-02T00:00:00Z", "TIMESTAMP"), ("2024-01-02T00:00:00", "TIMESTAMPTZ"),
])
def test_bad_values(value, kind):
    with pytest.raises(ValueError):
        typed_value(Param(value, kind))


def test_bound_markers(spark):
    params = {k: make_param(v) for k, v in {
        "p1": {"value": "it's \\ :p2 ?", "type": "TEXT"}, "p2": {"value": "3", "type": "INT4"},
        "p3": {"value": "2024-01-02T03:04:05", "type": "TIMESTAMP"}, "p4": {"value": "2024-01-02", "type": "DATE"},
        "p5": {"value": "2024-01-02T03:04:05+02:00", "type": "TIMESTAMPTZ"}, "p6": {"value": "1.5", "type": "NUMERIC"},
        "p7": {"value": "true", "type": "BOOLEAN"},
    }.items()}
    sql = r"""SELECT $1 a, @p2 b, :p3 c, $4 d, :p5 e, @p6 f, $7 g, '$1 ? :p2 it''s \' @p2' h, 1::string i -- $9 ?
              FROM range(10) /* $8 */ WHERE id < $2 LIMIT $2"""
    df = ferry.run_sql(spark, sql, params)
    assert df.count() == 3
    row = df.selectExpr("*", "cast(e AS string) AS utc").first()
    assert (row.a, row.b, str(row.c), str(row.d), row.f, row.g) == ("it's \\ :p2 ?", 3, "2024-01-02 03:04:05", "2024-01-02", Decimal("1.5"), True)
    assert row.utc == "2024-01-02 01:04:05" and row.h.startswith("$1 ? :p2")
    assert dict(df.dtypes)["c"] == "timestamp_ntz" and dict(df.dtypes)["e"] == "timestamp"
    assert ferry.run_sql(spark, "SELECT ? a, ? b", {"b": Param("2"), "a": Param("1")}).first() == ("1", "2")
    # Keys are sorted as text.
    assert ferry.run_sql(spark, "SELECT $1 a, $2 b", {"P2": Param("two"), "P10": Param("ten")}).first() == ("ten", "two")
    with pytest.raises(ValueError, match="no parameter"):
        ferry.run_sql(spark, "SELECT $2", {"P1": Param("x")})


def test_inlined_params():
    params = {"p1": Param("o'neil\\"), "p2": Param("5", "INT4"), "p3": Param("true", "BOOLEAN"), "p4": Param("2024-01-02", "DATE")}
    assert inline_params("SELECT $1, $2, $3, $4, '$1', a ? b, $q$ $1 $q$", params, "postgres") == (
        "SELECT 'o''neil\\', 5, TRUE, '2024-01-02', '$1', a ? b, $q$ $1 $q$"
    )
    assert inline_params("SELECT @p1, @p3, @@version, @other, 'c:\\', @p2", params, "sqlserver") == (
        "SELECT N'o''neil\\', 1, @@version, @other, 'c:\\', 5"
    )
    assert inline_params("SELECT ?, ?, ?, v:p2, 'it\\'s ?'", params, "snowflake").startswith("SELECT 'o''neil\\\\', 5, TRUE,")
    with pytest.raises(ValueError, match="NUL"):
        inline_params("$1", {"a": Param("\x00")}, "postgres")
    with pytest.raises(ValueError, match="finite"):
        inline_params("$1", {"a": Param("nan", "FLOAT8")}, "postgres")


def test_jdbc_options():
    pg = jdbc_options("postgres://us%40er:p%2Fw@db.example.com:5432/shop?sslmode=require")
    assert pg["url"] == "jdbc:postgresql://db.example.com:5432/shop?sslmode=require"
    assert (pg["user"], pg["password"], pg["driver"], pg["fetchsize"]) == ("us@er", "p/w", "org.postgresql.Driver", "10000")
    ms = jdbc_options("sqlserver://sa:secret@host:1433/inst?database=shop&encrypt=true&KeepOriginalUUID=true", 50)
    assert ms["url"] == "jdbc:sqlserver://host:1433;encrypt=true;instanceName=inst;databaseName=shop" and ms["fetchsize"] == "50"
    assert keeps_uuid_order("sqlserver://h?KeepOriginalUUID=true") and not keeps_uuid_order("sqlserver://h")
    sf = jdbc_options("snowflake://u:p@acct/DB/SC?warehouse=W&timezone=UTC")
    assert sf["url"] == "jdbc:snowflake://acct.snowflakecomputing.com/?warehouse=W&timezone=UTC&db=DB&schema=SC"
    with pytest.raises(ValueError, match="unsupported source"):
        jdbc_options("mysql://h/db")


class FakeReader:
    """Records what a read would ask of the JDBC source."""

    def __init__(self, log, ends):
        self.log, self.ends, self.settings = log, ends, {}

    def format(self, name):
        return FakeReader(self.log, self.ends)

    def options(self, **settings):
        self.settings.update(settings)
        return self

    def option(self, key, value):
        self.settings[key] = value
        return self

    def load(self):
        self.log.append(("load", self.settings["query"]))
        return self

    def first(self):
        return self.ends

    def jdbc(self, url, table, predicates, properties):
        self.log.append(("jdbc", url, table, predicates, sorted(properties)))
        return self


def test_partitioned_read():
    log = []
    spark = type("Session", (), {"read": FakeReader(log, (0, 100))})()
    read_jdbc(spark, "postgres://u:p@h/db", "SELECT * FROM t WHERE a = $1;", {"P1": Param("x")}, "id", 4)
    source = "(SELECT * FROM t WHERE a = 'x'\n) ferry_source"
    assert log[0] == ("load", f"SELECT MIN(id) AS low, MAX(id) AS high FROM {source}")
    assert log[1][2:4] == (source, ["id < 25 OR id IS NULL", "id >= 25 AND id < 50", "id >= 50 AND id < 75", "id >= 75"])
    assert "password" in log[1][4] and "url" not in log[1][4]
    log.clear()
    read_jdbc(spark, "postgres://u:p@h/db", "SELECT 1")
    assert log == [("load", "SELECT 1\n")]


def test_read_by_depth():
    for url, dialect in (("postgres://u:p@h/db", "postgres"), ("snowflake://a/DB", "snowflake"), ("sqlserver://h?database=d", "sqlserver")):
        log = []
        spark = type("Session", (), {"read": FakeReader(log, ("b'c", "m", "m"))})()
        read_jdbc(spark, url, "SELECT * FROM t", {}, "name", 4, "depth")
        table, quote = "(SELECT * FROM t\n) ferry_source", "N'" if dialect == "sqlserver" else "'"
        one = "PERCENTILE_DISC({}) WITHIN GROUP (ORDER BY name)" + (" OVER ()" if dialect == "sqlserver" else "") + " AS c{}"
        distinct = "DISTINCT " if dialect == "sqlserver" else ""
        assert log[0] == ("load", f"SELECT {distinct}{one.format(0.25, 1)}, {one.format(0.5, 2)}, {one.format(0.75, 3)} FROM {table}")
        b, m = f"{quote}b''c'", f"{quote}m'"
        assert log[1][3] == [f"name < {b} OR name IS NULL", f"name >= {b} AND name < {m}", f"name >= {m} AND name <= {m}", f"name > {m}"]


@pytest.mark.parametrize("column, kind", [("a", "skewed"), ("b", "one value"), ("c", "text"), ("d", "time"), ("e", "nulls"), ("f", "long"), ("g", "nan")])
def test_parts_of_equal_depth(spark, column, kind):
    df = spark.sql("""SELECT cast(exp(id / 300D) AS bigint) a, if(id % 3 < 2, 7, id % 50) b,
        if(id % 4 = 0, concat('it''s \\\\ ', id), concat('Customer#0000', lpad(id * id, 9, '0'))) c,
        TIMESTAMP_NTZ'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, id * id) d, if(id % 2 = 0, null, id) e,
        concat(repeat('x', 400), id) f, if(id % 5 = 0, double('NaN'), id * 0.1D) g FROM range(0, 8000, 1, 4)""")
    predicates = depth_predicates(column, cut_points(df, column, 8), lambda v: jdbc_literal(v, "spark"))
    sizes = [r.rows for r in split_sizes(df, predicates).collect()]
    assert sum(sizes) == 8000
    if kind == "one value":  # it has a part of its own, and the others are not larger than a share
        assert sorted(sizes)[-1] >= 8000 * 2 // 3 and sorted(sizes)[-2] <= 1200
    elif kind == "long":  # cut where cut points end
        assert len(sizes) == 2 and max(sizes) == 8000
    elif kind == "nulls":
        assert max(sizes[1:]) < 650 and sizes[0] < 4700
    elif kind == "nan":
        assert max(sizes) <= 2100  # all that are no number come last
    else:
        assert max(sizes) < 1200 and len(sizes) == 8


def test_depth_of_little():
    assert depth_predicates("k", []) == depth_predicates("k", [None, float("nan")]) == ["1 = 1"]
    assert depth_predicates("k", [3, 3]) == ["k < 3 OR k IS NULL", "k >= 3 AND k <= 3", "k > 3"]


@pytest.mark.parametrize("url, driver", [
    ("postgres://u:p@nowhere/db", "org.postgresql.Driver"),
    ("sqlserver://u:p@nowhere?database=db", "com.microsoft.sqlserver.jdbc.SQLServerDriver"),
    ("snowflake://u:p@nowhere/db/sc", "net.snowflake.client.jdbc.SnowflakeDriver"),
])
def test_a_move_asks_for_the_driver(spark, tmp_path, url, driver):
    """The JDBC jars are not here, so a move gets as far as naming its driver, without its password."""
    with pytest.raises(MoveError, match=driver) as failed:
        ferry.move(spark, {"stream_name": "t", "format": "csv", "filename": "x"}, str(tmp_path), url)
    assert "u:p" not in failed.value.reports[0].source


def test_nothing_selected(spark, tmp_path):
    assert ferry.move_many(spark, MULTI, str(tmp_path), f"parquet:{DATA}", select="none").count() == 0


def test_splits(spark):
    df = spark.sql("SELECT if(id % 10 = 0, null, id - 50) AS k, DATE'2024-01-01' + cast(id AS int) AS d, id * 1.5D AS x, "
                   "TIMESTAMP_NTZ'2024-01-01 00:00:00' + make_dt_interval(0, id) AS t FROM range(100)")
    for column in ("k", "d", "x", "t"):
        from ferry.sources.splits import bounds

        low, high = bounds(df, column)
        for parts in (1, 3, 60):
            predicates = split_predicates("postgres", column, low, high, parts)
            rows = split_sizes(df, predicates)
            assert rows.agg({"rows": "sum"}).first()[0] == 100 and len(predicates) <= parts
    modulo = split_predicates("postgres", "k", None, None, 4, "modulo")
    assert sorted(r.rows for r in split_sizes(df, modulo).collect())[0] > 10
    assert split_sizes(df, modulo).agg({"rows": "sum"}).first()[0] == 100
    assert split_predicates("sqlserver", "d", date(2024, 1, 1), date(2024, 1, 11), 2)[1] == "d >= '2024-01-06'"
    assert split_predicates("postgres", "d", None, None, 5) == ["1 = 1"]
    assert split_predicates("sqlserver", "k", None, None, 2, "modulo") == ["ABS((k % 2)) = 0 OR k IS NULL", "ABS((k % 2)) = 1"]
    with pytest.raises(ValueError, match="modulo"):
        split_predicates("postgres", "name", "a", "z", 4)


@pytest.mark.parametrize("fmt, compression, ending", [
    ("csv", "", ".csv"), ("csv", "gzip", ".csv.gz"), ("jsonl", "", ".jsonl"), ("parquet", "", ".parquet"),
    ("ARROW", "snappy", ".snappy.arrow"), ("other", "", ""),
])
def test_extension(fmt, compression, ending):
    assert extension(fmt, compression) == ending


def test_names():
    today = date(2024, 3, 9)
    name = render_name("{{ YYYY }}/{{MM}}/{{ DD }}/{{stream_name}}-{{format}}-{{compression}}{{ext}}", "s.t", "csv", "gzip", today)
    assert name == "2024/03/09/s.t-csv-gzip.csv.gz"
    with pytest.raises(ValueError, match="unknown token"):
        render_name("{{ now | unixEpoch }}", "", "csv", "")
    assert output_path("file:///data/", "a/b.csv") == "file:///data/a/b.csv"
    assert output_path("azure://acct/box?sv=1", "x.csv") == "azure://acct/box/x.csv?sv=1"
    for blank in ("", "  "):
        with pytest.raises(ValueError, match="filename"):
            output_path("/data", blank)


def test_azure():
    path = "abfss://box@devacct.dfs.core.windows.net/p/year/test.parquet"
    assert hadoop_path("https://devacct.blob.core.windows.net/box/p/year/test.parquet") == (path, {})
    assert hadoop_path("azure://devacct/box/p/year/test.parquet") == (path, {})
    with_token = hadoop_path("azure://:sv%3D1%26sig%3Dx@devacct/box/p/year/test.parquet")
    assert with_token[0] == path and with_token[1]["fs.azure.sas.fixed.token.devacct.dfs.core.windows.net"] == "sv=1&sig=x"
    local = hadoop_path("azurite://:tok@127.0.0.1:10000/devstore/box/x.csv")
    assert local[0] == "wasb://box@devstore.blob.core.windows.net/x.csv"
    assert local[1]["fs.azure.sas.box.devstore.blob.core.windows.net"] == "tok"
    assert hadoop_path("/data/x.csv") == ("/data/x.csv", {})
    for bad in ("https://example.com/box/x", "azure://acct/box"):
        with pytest.raises(ValueError):
            hadoop_path(bad)


def test_redact():
    assert redact("snowflake://me:hidden@acct/shop/main?warehouse=w&token=t") == "snowflake://acct/shop/main"
    assert redact("/plain/path") == "/plain/path"
    text = "cannot reach 'jdbc:postgresql://u:pw@h/db?password=x' or jdbc:sqlserver://h:1;user=u;password=p, sorry"
    assert redact_text(text) == "cannot reach 'jdbc:postgresql://h/db' or jdbc:sqlserver://h:1 sorry"
    braced = redact_text("jdbc:sqlserver://h:1;user=me;password={a b;c}} d};encrypt=true failed; Token = 'x y' and PWD=z")
    assert not any(x in braced for x in ("me;", "a b", "c}", "x y", "=z")) and "failed" in braced


def test_a_url_in_an_error_is_redacted(spark, tmp_path, monkeypatch):
    module = importlib.import_module("ferry.plans.move")

    def fail(*args):
        raise RuntimeError("no route to jdbc:postgresql://u:hidden@h/db?sslkey=hidden")

    monkeypatch.setattr(module, "read_source", fail)
    with pytest.raises(MoveError) as failed:
        ferry.move(spark, {"stream_name": "t", "format": "csv", "filename": "x"}, str(tmp_path))
    assert "hidden" not in failed.value.reports[0].error + str(failed.value)


def test_a_listing_gets_the_options_and_may_fail(spark, tmp_path, monkeypatch):
    module = importlib.import_module("ferry.plans.move")
    seen = []

    def listing(df, path, options=None, names=None):
        seen.append((path, options))
        raise RuntimeError("no credentials for abfss://box@acct.dfs.core.windows.net/x?sig=hidden")

    monkeypatch.setattr(module, "written_bytes", listing)
    monkeypatch.setattr(module, "hadoop_path", lambda url: (url, {"fs.azure.sas.fixed.token.acct": "tok"}))
    report = ferry.move(spark, {"sql": "SELECT 1 a", "format": "csv", "filename": "x"}, str(tmp_path)).first()
    assert report.success and report.rows == 1 and report.bytes is None and "hidden" not in report.error
    assert seen[0][1] == {"fs.azure.sas.fixed.token.acct": "tok"}


def test_stated_defaults_win():
    defaults = MoveSpec()
    others = {
        "stream_name": "s", "sql": "SELECT 1", "filename": "f", "format": "csv", "compression": "gzip", "batch_size": 3, "batch_count": 4, "writers": 5, "on_error": "zero",
        "strict_scale": True, "null_value": "-", "uuid_as": "bytes", "partition_by": ["k"], "partition_column": "id", "partitions": 6, "split": "modulo", "fetch_size": 7,
        "columns": [{"name": "a", "type": "INT4"}], "params": {"P1": "v"},
    }
    for name, value in others.items():
        default = getattr(defaults, name)
        stated = make_spec({name: list(default) if name in ("columns", "partition_by") else default})
        root = make_spec({name: value})
        assert getattr(merge(root, stated), name) == default, name
        assert merge(root, make_spec({})) == root == merge(root, make_spec({name: None}))
        assert getattr(merge(stated, root), name) == getattr(root, name)
    (table,) = make_specs({"on_error": "zero", "partitions": 8, "tables": [{"stream_name": "t", "on_error": "fail", "partitions": 1}]})
    assert (table.on_error, table.partitions) == ("fail", 1)


def test_tokens_in_the_whole_job(spark, monkeypatch):
    from ferry.plans.spec import with_tokens

    monkeypatch.setenv("FERRY_VAR_REGION", "EU")
    spec = make_spec({
        "stream_name": "t_{{ .REGION }}", "format": "csv", "sql": "SELECT '{{ YYYY }}-{{MM}}-{{ DD }}' AS day, $1 AS v, '{{stream_name}}' AS s",
        "params": {"P1": "{{ .REGION }}' OR 1=1 --"},
    })
    made = with_tokens(spec, today=date(2024, 3, 9))
    assert made.sql == "SELECT '2024-03-09' AS day, $1 AS v, 't_EU' AS s" and made.params["P1"].value == "EU' OR 1=1 --"
    assert ferry.plan(spark, spec).first()[1:] == ("EU' OR 1=1 --", "t_EU")
    with pytest.raises(ValueError, match="unknown token"):
        with_tokens(make_spec({"sql": "SELECT {{ .MISSING }}"}))


def test_flags_over_a_single_job(spark, tmp_path):
    spec = {"sql": "SELECT 1 a", "format": "csv", "filename": "x{{ext}}"}
    report = ferry.move(spark, spec, str(tmp_path), flags={"format": "jsonl"}).first()
    assert report.path.endswith("x.jsonl")


def test_preview_sees_the_environment(spark, monkeypatch):
    monkeypatch.setenv("FERRY_PARAM_P1", "from outside")
    assert preview(spark, {"sql": "SELECT $1 a", "format": "csv", "params": {"P1": "x"}}).first().value == "from outside"


def test_one_exchange_when_rows_are_dealt_by_value(spark):
    from ferry.plans import plan

    spark.range(10).selectExpr("id % 3 AS k", "id").createOrReplaceTempView("dealt")
    spec = {"sql": "SELECT * FROM dealt", "format": "jsonl", "partition_by": "K", "writers": 4}
    df = plan(spark, spec).hint("rebalance", "k")
    assert df._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1


@pytest.mark.parametrize("fmt", ["csv", "jsonl", "parquet"])
def test_partition_names_in_any_case(spark, tmp_path, fmt):
    spec = {"sql": "SELECT id % 3 AS k, 'x' AS v FROM range(10)", "format": fmt, "partition_by": ["K"], "filename": "p"}
    assert ferry.move(spark, spec, str(tmp_path)).first().rows == 10
    assert len(list((tmp_path / "p").glob("k=*"))) == 3


def test_one_csv_column_keeps_its_rows(spark, tmp_path):
    rows = "VALUES ('a', 1), ('', 1), ('b', 2), (NULL, 2) AS t(v, k)"
    for name, columns, by in (("one", "v", []), ("split", "v, k", ["k"])):
        spec = {"sql": f"SELECT {columns} FROM {rows}", "format": "csv", "filename": name, "partition_by": by}
        assert ferry.move(spark, spec, str(tmp_path)).first().rows == 4
        back = spark.read.csv(str(tmp_path / name), header=True, escape='"', nullValue="NULL", emptyValue="")
        assert sorted(r.v or "" if r.v is not None else "null" for r in back.collect()) == ["", "a", "b", "null"]
        with pytest.raises(MoveError, match="null_value"):
            ferry.move(spark, {**spec, "null_value": ""}, str(tmp_path))


def test_queries_inside_of_queries():
    from ferry.sources.jdbc import limits_rows, split_with

    assert split_with("SELECT 1") == ("", "SELECT 1")
    before, rest = split_with("WITH a AS (SELECT 'SELECT )' x), b AS (SELECT 2 y) -- SELECT\nSELECT * FROM a, b")
    assert before.startswith("WITH a") and before.endswith("-- SELECT") and rest == "SELECT * FROM a, b"
    assert all(map(limits_rows, ("SELECT * FROM t LIMIT 5", "select top 5 * from t", "SELECT 1 FETCH FIRST 2 ROWS ONLY", "SELECT 1 OFFSET 3")))
    assert all(map(limits_rows, (
        "SELECT * FROM (SELECT a, ROW_NUMBER() OVER (ORDER BY a) n FROM t) x WHERE n < 10", "SELECT sum(a) over w FROM t WINDOW w AS (ORDER BY b)",
        "SELECT * FROM t WHERE random() < 0.1", "SELECT NEWID() k, a FROM t", "SELECT * FROM t QUALIFY x = 1", "SELECT DISTINCT ON (a) a, b FROM t",
        "SELECT nextval('s') FROM t", "SELECT count(*) FILTER (WHERE a > 1)\n OVER () FROM t")))
    assert not any(map(limits_rows, ("SELECT over, random FROM t", "SELECT a AS over FROM t", "SELECT f(a) overall FROM t", "SELECT brand(a) FROM t")))
    assert not any(map(limits_rows, ("SELECT 'LIMIT' FROM t -- limit 3", 'SELECT "top" FROM t', "SELECT stopped FROM t")))
    log = []
    spark = type("Session", (), {"read": FakeReader(log, (0, 9))})()
    with pytest.raises(ValueError, match="limits its rows"):
        read_jdbc(spark, "postgres://h/db", "SELECT * FROM t LIMIT 5", partition_column="id", partitions=2)
    reader = FakeReader(log, (0, 9))
    read_jdbc(type("Session", (), {"read": reader})(), "sqlserver://h?database=d", "WITH a AS (SELECT 1 x) SELECT x FROM a -- end")
    assert log[-1] == ("load", "SELECT x FROM a -- end\n")


def test_hash_and_float_splits(spark):
    assert split_predicates("postgres", "k", None, None, 2, "hash")[1] == "(CASE WHEN k IS NULL THEN 0 ELSE MOD(ABS(CAST(HASHTEXT(CAST(k AS TEXT)) AS BIGINT)), 2) END) = 1"
    assert split_predicates("sqlserver", "k", None, None, 2, "hash")[0].endswith("(ABS(CAST(CHECKSUM(k) AS BIGINT)) % 2) END) = 0")
    assert "HASH(k)" in split_predicates("snowflake", "k", None, None, 2, "hash")[0]
    df = spark.sql("SELECT if(id % 9 = 0, null, concat('key ', id)) AS s, if(id % 50 = 0, double('NaN'), id / 1000) AS x FROM range(900)")
    sizes = [r.rows for r in split_sizes(df, split_predicates("spark", "s", None, None, 8, "hash")).collect()]
    assert sum(sizes) == 900 and min(sizes) > 50
    for high in (0.9, float("nan"), float("inf")):
        predicates = split_predicates("postgres", "x", 0.0, high, 16)
        assert sum(r.rows for r in split_sizes(df, predicates).collect()) == 900
    assert len(split_predicates("postgres", "x", 0.0, 0.9, 16)) == 16
    assert split_predicates("postgres", "x", float("nan"), float("nan"), 4) == ["1 = 1"]
    assert len(split_predicates("postgres", "x", -1.7e308, 1.7e308, 4)) == 4
    assert len(split_predicates("postgres", "x", Decimal("0.00"), Decimal("0.10"), 16)) == 16


def test_move_reports(spark, tmp_path):
    spec = {"stream_name": "orders", "format": "csv", "filename": "{{stream_name}}{{ext}}"}
    report = ferry.move(spark, spec, f"file://{tmp_path}", f"parquet:{DATA}").first()
    assert report.source == f"parquet:{DATA}" and report.sql == "SELECT * FROM orders" and report.path.endswith("/orders.csv")
    assert report.rows == spark.read.parquet(f"{DATA}/orders.parquet").count() and report.bytes > 1000
    assert report.success and report.error == "" and report.elapsed_ms > 0 and report.duration.endswith("s")


@pytest.mark.parametrize("spec, message", [
    ({"stream_name": "nowhere", "format": "csv", "filename": "x"}, "nowhere"),
    ({"sql": "SELECT 1 a, 2 a", "format": "csv", "filename": "x"}, "duplicate"),
    ({"sql": "SELECT 1 a", "format": "avro", "filename": "x"}, "unsupported format"),
    ({"sql": "SELECT 1 a", "format": "csv", "filename": ""}, "filename"),
    ({"format": "csv", "filename": "x"}, "stream_name or sql"),
    ({"sql": "SELECT 'q' a", "format": "csv", "filename": "x", "columns": [{"name": "a", "type": "INT4"}]}, "cast"),
])
def test_failed_moves(spark, tmp_path, spec, message):
    with pytest.raises(MoveError, match=message) as failed:
        ferry.move(spark, spec, str(tmp_path))
    (report,) = failed.value.reports
    assert not report.success and message in report.error


def test_no_destination(spark):
    with pytest.raises(ValueError, match="destination"):
        ferry.move(spark, {"sql": "SELECT 1 a", "format": "csv", "filename": "x"})


def test_unknown_source(spark, tmp_path):
    with pytest.raises(MoveError, match="unsupported source"):
        ferry.move(spark, {"sql": "SELECT 1 a", "format": "csv", "filename": "x"}, str(tmp_path), "mysql://h/db")


@pytest.mark.parametrize("concurrency", [1, 3])
def test_move_many(spark, tmp_path, concurrency):
    job = MULTI.replace("public.users", "nation").replace("public.numbers", "region").replace("public.strings", "events")
    out = ferry.move_many(spark, job, str(tmp_path), f"parquet:{DATA}", select="Events,nation", concurrency=concurrency)
    assert [r.path.rsplit("/", 1)[1] for r in out.collect()] == ["nation.snappy.arrow", "events.snappy.arrow"]


def test_many_stops_at_a_failure(spark, tmp_path):
    job = [MoveSpec(n, format="csv", filename="{{stream_name}}") for n in ("nation", "missing", "region")]
    with pytest.raises(MoveError) as failed:
        ferry.move_many(spark, job, str(tmp_path), f"parquet:{DATA}")
    assert [r.success for r in failed.value.reports] == [True, False] and not (tmp_path / "region").exists()


def test_rows_are_counted_once_after_shuffles(spark, tmp_path):
    spark.range(1000).createOrReplaceTempView("many_ids")
    spec = {"sql": "SELECT id % 7 AS k, count(*) AS n FROM many_ids GROUP BY 1", "format": "jsonl", "filename": "g", "writers": 3}
    report = ferry.move(spark, spec, str(tmp_path)).first()
    assert report.rows == 7 and len(list((tmp_path / "g").glob("part-*"))) == 3


def test_rows_of_a_partitioned_move(spark, tmp_path):
    spec = {"stream_name": "events", "format": "parquet", "filename": "e", "partition_by": "event_type"}
    report = ferry.move(spark, spec, str(tmp_path), f"parquet:{DATA}").first()
    assert report.rows == spark.read.parquet(str(tmp_path / "e")).count() > 0


def test_preview(spark):
    spec = make_spec({"sql": "SELECT id, 'a,b' AS t FROM range(100)", "format": "csv"})
    assert [r.value for r in preview(spark, spec, rows=2).collect()] == ['0,"a,b"', '1,"a,b"']
    assert preview(spark, replace(spec, format="jsonl"), rows=5).count() == 5
    with pytest.raises(ValueError):
        preview(spark, replace(spec, format="arrow"))


def test_parquet_source_takes_tables_only(spark):
    with pytest.raises(ValueError, match="whole tables"):
        read_source(spark, f"parquet:{DATA}", MoveSpec(sql="SELECT 1"))


def test_exec(spark):
    ferry.exec_sql(spark, "CREATE OR REPLACE TEMPORARY VIEW exec_made AS SELECT 1 AS one")
    assert spark.table("exec_made").count() == 1
    with pytest.raises(Exception, match="PARSE|syntax"):
        ferry.exec_sql(spark, "CREATE NONSENSE")


def test_fail_mode_needs_ansi(spark, tmp_path):
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        with pytest.raises(MoveError, match="ansi"):
            ferry.move(spark, {"sql": "SELECT 1 a", "format": "csv", "filename": "x"}, str(tmp_path))
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")


def slow(spark, name, tasks, seconds):
    """A table whose every task takes so long."""
    def wait(batches):
        for batch in batches:
            time.sleep(seconds)
            yield batch

    spark.range(0, tasks, 1, tasks).mapInArrow(wait, "id long").createOrReplaceTempView(name)


def test_a_failure_ends_the_tables_that_run(spark, tmp_path):
    slow(spark, "slow_table", 3, 9)
    spark.range(100).createOrReplaceTempView("quick_table")
    tables = [{"stream_name": "quick_table"}, {"stream_name": "slow_table"}, {"stream_name": "bad", "sql": "SELECT raise_error('broken') AS x FROM range(1, 9, 1, 1) WHERE id > 0"},
              {"stream_name": "never_begun"}]
    begun = time.monotonic()
    with pytest.raises(MoveError, match="broken") as failed:
        ferry.move_many(spark, {"format": "csv", "filename": "{{stream_name}}", "tables": tables}, str(tmp_path), concurrency=3)
    assert time.monotonic() - begun < 8  # the slow table alone takes longer
    reports = {r.sql.rsplit(" ", 1)[1] if r.sql.startswith("SELECT *") else "bad": r for r in failed.value.reports}
    assert reports["quick_table"].success and not reports["slow_table"].success and set(reports) <= {"quick_table", "slow_table", "bad", "never_begun"}
    assert reports["slow_table"].error.startswith("ended, as another table failed") and "broken" in reports["bad"].error
    assert not list((tmp_path / "slow_table").glob("part-*"))
    deadline = time.monotonic() + 20
    while spark.sparkContext.statusTracker().getActiveJobsIds() and time.monotonic() < deadline:
        time.sleep(0.1)
    assert not spark.sparkContext.statusTracker().getActiveJobsIds()
    assert spark.sparkContext.getLocalProperty("spark.scheduler.pool") is None
    # later jobs are not cancelled
    assert ferry.move_many(spark, {"format": "csv", "filename": "q", "tables": tables[:1]}, str(tmp_path)).first().success


FAIR = """
import sys, time, tempfile
sys.path[:0] = sys.argv[1:]
from pyspark.sql import SparkSession
import ferry
from test_jobs import slow
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.driver.host", "127.0.0.1")
         .config("spark.driver.bindAddress", "127.0.0.1").config("spark.scheduler.mode", "FAIR").getOrCreate())
slow(spark, "large", 40, 0.25)
spark.range(0, 4, 1, 4).createOrReplaceTempView("small")
job = {"format": "csv", "filename": "{{stream_name}}", "tables": [{"stream_name": "large"}, {"stream_name": "small"}]}
rows = ferry.move_many(spark, job, tempfile.mkdtemp(prefix="run-"), concurrency=2).collect()
print("times", *(r.elapsed_ms for r in rows))
"""


def test_tables_share_the_executors_evenly():
    """On two cores a small table is done long before a large one that began first."""
    here = Path(__file__).resolve().parent
    out = subprocess.run([sys.executable, "-c", FAIR, str(here), str(here.parent)], capture_output=True, text=True, timeout=120)
    large, small = map(int, out.stdout.split("times")[1].split())
    assert large > 4500 and small < 0.7 * large, out.stdout
