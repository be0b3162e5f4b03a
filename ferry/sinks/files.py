"""CSV, JSON lines, Parquet and Arrow output of a conformed DataFrame."""

from __future__ import annotations

import json
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, DataFrameWriter, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ferry.functions.jsontext import html_safe, json_text, quoted_name
from ferry.functions.uuids import uuid_bytes
from ferry.operators.lines import jsonl_lines, rendered, typed_columns
from ferry.session import configure
from ferry.sinks import arrow
from ferry.sinks.landing import Folder, job_files, job_options, literal_path, new_job
from ferry.types import JSON_TYPES, is_nested

TEXT_CODECS = ("none", "gzip", "snappy", "bzip2", "lz4", "deflate")
PARQUET_CODECS = ("none", "gzip", "snappy", "lz4_raw", "zstd")


@dataclass(frozen=True)
class Target:
    """Where and how to land rows."""

    path: str
    compression: str = ""
    rows_per_file: int = 0
    # Most rows of a Parquet row group, what readers take as a whole; a file of few rows has groups of no more.
    rows_per_group: int = 0
    null_value: str = "NULL"
    uuid_as: str = "text"
    partition_by: tuple[str, ...] = ()
    options: dict = field(default_factory=dict)


def _writer(df: DataFrame, target: Target, codecs: tuple[str, ...], default: str) -> DataFrameWriter:
    codec = target.compression.lower() or default
    if codec not in codecs:
        raise ValueError(f"unsupported compression {codec!r}: one of {', '.join(codecs)}")
    writer = df.write.mode("append").options(**target.options).option("compression", codec)
    if target.rows_per_file:
        writer = writer.option("maxRecordsPerFile", target.rows_per_file)
    return writer.partitionBy(*target.partition_by) if target.partition_by else writer


def write_csv(df: DataFrame, target: Target) -> None:
    """CSV with a header in every file; NULL is the word `NULL`.

    With one data column an empty text is written as `""`: Spark's writer leaves out lines without a character.
    """
    single = len(df.columns) - len(target.partition_by) == 1
    if single and not target.null_value:
        raise ValueError("a single column needs a null_value: rows that are NULL would have no line")
    _writer(rendered(df, target.partition_by), target, TEXT_CODECS, "none").csv(
        target.path,
        header=True,
        nullValue=target.null_value,
        emptyValue='""' if single else "",
        escape='"',
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
    )


def write_jsonl(df: DataFrame, target: Target) -> None:
    _writer(jsonl_lines(df, target.partition_by), target, TEXT_CODECS, "none").text(target.path)


def write_parquet(df: DataFrame, target: Target) -> None:
    configure(df.sparkSession)
    writer = _writer(columnar(df, target.uuid_as == "bytes"), target, PARQUET_CODECS, "snappy")
    if target.rows_per_group:
        writer = writer.option("parquet.block.row.count.limit", target.rows_per_group)
    writer.parquet(target.path)


def write_arrow(df: DataFrame, target: Target) -> None:
    """Arrow IPC streams. `snappy` is accepted and leaves the stream plain: the format has no such codec."""
    if target.compression.lower() not in arrow.COMPRESSIONS:
        raise ValueError(f"unsupported compression {target.compression!r} for arrow")
    arrow.register(df.sparkSession)
    notes = [{"name": name, "type": logical, "length": (f.metadata or {}).get("length", 0)}
             for f, (_, _, logical, name) in zip(df.schema.fields, typed_columns(df))]
    df = columnar(df, uuid_as_bytes=True)
    if target.partition_by:  # rows of one value in a row: a task has few files open, and few files
        df = df.sortWithinPartitions(*map(quoted_name, target.partition_by))
    writer = df.write.format("ferry_arrow").mode("overwrite").options(**target.options)
    if target.rows_per_file:
        writer = writer.option("maxRecordsPerFile", target.rows_per_file)
    if target.partition_by:
        writer = writer.option("partitionby", json.dumps(target.partition_by))
    writer.option("compression", target.compression.lower()).option("fields", json.dumps(notes)).save(target.path)


def columnar(df: DataFrame, uuid_as_bytes: bool = False) -> DataFrame:
    """Columns as Parquet and Arrow store them: nested values as JSON text, JSON text verbatim."""
    stored, noted = [], []
    for f, (c, dtype, logical, name) in zip(df.schema.fields, typed_columns(df)):
        stored.append(_stored(c, dtype, logical, uuid_as_bytes).alias(name))
        safe = F.expr(html_safe(c)) if is_nested(dtype) else F.col(c)
        noted.append(safe.alias(name, metadata=f.metadata))
    return df.select(*stored).select(*noted)


def _stored(c: str, dtype: T.DataType, logical: str, uuid_as_bytes: bool) -> Column:
    if is_nested(dtype):
        return F.expr(json_text(c, dtype))
    if logical == "UUID" and uuid_as_bytes and isinstance(dtype, T.StringType):
        return uuid_bytes(F.col(c))
    if isinstance(dtype, T.BinaryType) and logical not in (*JSON_TYPES, "UUID"):
        return F.col(c).cast("string")
    return F.col(c)


WRITERS = {"arrow": write_arrow, "csv": write_csv, "jsonl": write_jsonl, "parquet": write_parquet}


def write(df: DataFrame, fmt: str, target: Target, seen: Observation | None = None) -> str | None:
    """Land the rows in place of those that are there, which stay until the new ones are complete. `seen` observes their
    number in the tasks that write them, where each row counts once. Returns the pattern of the new files' names, if
    they have one."""
    if fmt.lower() not in WRITERS:
        raise ValueError(f"unsupported format: {fmt!r}")
    if target.partition_by:
        target = replace(target, partition_by=tuple(_named(df, c) for c in target.partition_by))
        # Rows of one value go together, and Spark cuts a value that is far larger than the others.
        df = df.hint("rebalance", *map(quoted_name, target.partition_by))
    if seen is not None:
        df = df.observe(seen, F.count(F.lit(1)).alias("rows"))
    if fmt.lower() == "arrow":  # has its own manifest
        write_arrow(df, target)
        return None
    folder, job = Folder(df.sparkSession, target.path, target.options), new_job()
    try:
        WRITERS[fmt.lower()](df, replace(target, options=target.options | job_options(job)))
    except BaseException:
        folder.abort(job)
        raise
    folder.commit(job)
    return job_files(job)


def _named(df: DataFrame, name: str) -> str:
    """A column's own spelling of a name given in any case, as Spark resolves it."""
    if name in df.columns:
        return name
    found = [c for c in df.columns if c.lower() == name.lower()]
    if len(found) != 1:
        raise ValueError(f"partition_by names no column: {name!r}")
    return found[0]


def written_bytes(df: DataFrame, path: str, options: dict | None = None, names: str | None = None) -> int:
    """Size of the landed files, from their listing: contents are not read. `options` carry the credentials of the target,
    `names` is the pattern of their names."""
    reader = df.sparkSession.read.format("binaryFile").options(**(options or {})).option("recursiveFileLookup", "true")
    files = (reader.option("pathGlobFilter", names) if names else reader).load(literal_path(path))
    return files.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]
