"""What several of the operators share: the words of a text, tables in the shared folder, streams of Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ferry.session import work_folder
from ferry.sinks.arrow import address_filesystem
from ferry.sources import table_path

#: White space and words, as byte ranges that mean the same in Java, RE2 and Python.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def whole(text: Column | str) -> Column:
    """The text, an empty one for null."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def quoted(name: str) -> Column:
    """A column by its plain name, whatever characters that has."""
    return F.col(f"`{name.replace('`', '``')}`")


def stored(df: DataFrame, folder: str | None = None) -> DataFrame:
    """The rows, written to the folder that all executors share and read from there: this cuts the lineage and
    survives lost executors. Only rows of committed tasks are read."""
    spark = df.sparkSession
    path = folder or work_folder(spark)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def binary(column: pa.Array) -> list:
    """UTF-8 bytes of a text column, empty for null."""
    return [b or b"" for b in column.cast(pa.binary()).to_pylist()]


def pieces(batch: pa.RecordBatch, most: int = 512) -> Iterator[pa.RecordBatch]:
    """The batch in slices of at most so many rows, so that what is made from each stays small."""
    for start in range(0, batch.num_rows, most):
        yield batch.slice(start, most)


def shared_folder(spark: SparkSession) -> str:
    """A new folder of the shared storage as a whole address: a path without a scheme is on Spark's default filesystem, for the
    tasks that open files themselves too."""
    path = spark._jvm.org.apache.hadoop.fs.Path(work_folder(spark))
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString()


def filesystem(folder: str) -> tuple[pafs.FileSystem, str]:
    """Where tasks open a folder of the shared storage, given by its address: local and mounted files, HDFS, S3, GCS and Azure;
    an error for what pyarrow cannot reach."""
    return address_filesystem(folder)
