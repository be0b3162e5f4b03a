"""Where rows come from: the Spark catalog, Parquet folders, or a database."""

from __future__ import annotations

from collections.abc import Iterable
from urllib.parse import urlsplit

from pyspark.sql import DataFrame, SparkSession

from ferry.sources.jdbc import DRIVERS, keeps_uuid_order, read_jdbc
from ferry.sources.params import Param, inline_params, make_param, overlay_params, run_sql


def table_path(base: str, name: str) -> str:
    return f"{base.rstrip('/')}/{name}.parquet"


def register_tables(spark: SparkSession, base: str, names: Iterable[str]) -> None:
    """Views over `<base>/<name>.parquet`."""
    for name in names:
        spark.read.parquet(table_path(base, name)).createOrReplaceTempView(name)


def read_source(spark: SparkSession, url: str, spec) -> DataFrame:
    """DataFrame of a spec's query on the source its URL names.

    `table:` is the session's catalog, `parquet:<folder>` a folder of `<name>.parquet` tables,
    `postgres://`, `sqlserver://` and `snowflake://` are databases.
    """
    scheme = urlsplit(url).scheme
    if scheme == "table":
        return run_sql(spark, spec.query(), spec.params)
    if scheme == "parquet":
        base = url.split(":", 1)[1]
        if spec.sql:
            raise ValueError("a parquet: source reads whole tables; register them as views and use table: for SQL")
        return spark.read.parquet(table_path(base, spec.stream_name))
    if scheme in DRIVERS:
        return read_jdbc(
            spark, url, spec.query(), spec.params, spec.partition_column, spec.partitions, spec.split, spec.fetch_size
        )
    raise ValueError(f"unsupported source: {scheme!r}")


def dialect_of(url: str) -> str | None:
    scheme = urlsplit(url).scheme
    return scheme if scheme in DRIVERS else None


def exec_sql(spark: SparkSession, statement: str) -> DataFrame:
    """Run one catalog statement and return the rows Spark reports for it."""
    return spark.sql(statement)


__all__ = [
    "Param", "dialect_of", "exec_sql", "inline_params", "keeps_uuid_order", "make_param", "overlay_params", "read_jdbc",
    "read_source", "register_tables", "run_sql",
]
