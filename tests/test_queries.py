"""Every registered query against its SQL in DuckDB, and the plans that carry the large ones."""

import re
import shutil
import subprocess
import sys
from pathlib import Path

import pytest

import __spark_entry__ as entry
import ferry
from conftest import DATA
from oracle import compare, connect


@pytest.fixture(scope="module")
def con():
    return connect(DATA)


@pytest.mark.parametrize("name", sorted(entry._QUERIES))
def test_query(spark, con, name):
    assert compare(spark, con, name, entry.queries()[name], entry.oracle_sql()[name], DATA) == ""


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_keys_agree():
    assert set(entry._QUERIES) == set(entry._ORACLE)
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("left_over", [False, True])
def test_queries_without_the_training_data(tmp_path, left_over):
    """With the subpackage for training data deleted, or its folder empty, the others are registered."""
    top = Path(entry.__file__).parent
    shutil.copytree(top / "ferry", tmp_path / "ferry", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    for name in ("__spark_entry__.py", "corpus_pipeline.py"):
        if (top / name).exists():
            shutil.copy(top / name, tmp_path)
    if left_over:
        (tmp_path / "ferry" / "llm").mkdir()
    code = "import __spark_entry__ as e; print(sorted(e.queries()) == sorted(e.oracle_sql()) == sorted(e._QUERIES), len(e.queries()))"
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True)
    assert out.stdout.split() == ["True", str(len(entry._QUERIES))], out.stderr[-500:]


def plan_text(df):
    return df._jdf.queryExecution().explainString(df._sc._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


def test_filters_and_columns_reach_the_scan(spark):
    text = plan_text(entry.queries()["scan_sql_params"](spark, DATA))
    assert "GreaterThan(l_quantity" in text and "EqualTo(l_returnflag,R)" in text and "LessThan(l_shipdate" in text
    (schema,) = re.findall(r"ReadSchema: struct<([^>]*)>", text)
    assert [c.split(":")[0] for c in schema.split(",")] == ["l_orderkey", "l_linenumber", "l_quantity", "l_returnflag", "l_shipdate"]


@pytest.mark.parametrize("name", ["type_alias", "csv_lines", "jsonl_lines", "override_columns", "render_float", "to_json_text"])
def test_conversions_neither_shuffle_nor_leave_the_jvm(spark, name):
    text = plan_text(entry.queries()[name](spark, DATA))
    assert "Exchange" not in text and "Python" not in text and "ArrowEval" not in text


def test_wide_tables_compile(spark, tmp_path):
    """200 floating-point columns are converted by generated code of a size that Java accepts."""
    df = spark.range(100).selectExpr(*(f"id / {i + 2} AS c{i}" for i in range(200)))
    lines = ferry.jsonl_lines(df)
    assert lines.selectExpr("sum(length(value)) AS n").first().n > 100 * 200 * 6
