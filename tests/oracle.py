"""Compare queries with their SQL: `python tests/oracle.py [sf_dir] [name ...]`."""

import sys
import time
from decimal import Decimal
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def rows_of(table):
    """Rows as sorted text, columns in name order."""
    names = sorted(table.column_names)
    columns = [table.column(n).to_pylist() for n in names]
    return names, sorted(repr([_plain(v) for v in row]) for row in zip(*columns))


def _plain(v):
    if isinstance(v, Decimal):
        return f"d{v}"
    return v.replace(tzinfo=None).isoformat() if hasattr(v, "isoformat") and hasattr(v, "tzinfo") else v


def compare(spark, con, name, query, sql, sf_dir):
    ours = rows_of(query(spark, sf_dir).toArrow())
    theirs = rows_of(con.sql(sql).to_arrow_table())
    if ours[0] != theirs[0]:
        return f"columns differ: {ours[0]} / {theirs[0]}"
    if ours[1] != theirs[1]:
        only = set(ours[1]) - set(theirs[1]), set(theirs[1]) - set(ours[1])
        return f"{len(ours[1])} / {len(theirs[1])} rows, e.g. {[sorted(o)[:2] for o in only]}"
    return ""


if __name__ == "__main__":
    import __spark_entry__ as entry
    from pyspark.sql import SparkSession

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, oracle = connect(sf_dir), entry.oracle_sql()
    wrong = 0
    for name, query in entry.queries().items():
        if sys.argv[2:] and name not in sys.argv[2:] or name not in oracle:
            continue
        start = time.time()
        try:
            problem = compare(spark, con, name, query, oracle[name], sf_dir)
        except Exception as e:
            problem = f"{type(e).__name__}: {str(e)[:600]}"
        wrong += bool(problem)
        print(f"{'FAIL' if problem else 'ok':5}{name:24}{time.time() - start:6.2f}s {problem[:900]}", flush=True)
    print("wrong:", wrong)
    spark.stop()
