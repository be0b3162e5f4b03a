"""Arrow IPC stream files as a Spark data source: one stream per task, batch after batch.

Register with `register(spark)`, then `df.write.format("ferry_arrow")` and
`spark.read.format("ferry_arrow")`. The module needs only pyarrow and pyspark on the executors.

With the option `partitionby` (JSON: names of columns) rows go to folders `name=value`, which other readers know too; the
manifest holds each file's values, and a filter on them opens only the files it lets through.
"""

from __future__ import annotations

import base64
import json
import os
import re
import sys
import threading
import time
import uuid
import weakref
from collections.abc import Iterator
from dataclasses import dataclass
from datetime import date
from decimal import Decimal
from urllib.parse import urlsplit

import pyarrow as pa
import pyarrow.fs
from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceReader, EqualNullSafe, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition,
    IsNotNull, IsNull, LessThan, LessThanOrEqual, Not, StringContains, StringEndsWith, StringStartsWith, WriterCommitMessage,
)

MANIFEST = "_manifest"
COMPRESSIONS = ("", "none", "snappy", "gzip", "lz4", "zstd")
#: Where Spark puts paths without a scheme; `register` sets it.
DEFAULT = "file:///"

#: Streams that a task of a partitioned write has open at once, and seconds after which files no manifest lists are left over.
MOST_OPEN, LEFT_OVER = 16, 24 * 3600
#: Hive's folder for a value that is null, and the characters it writes as %XX in folder names.
NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"
ESCAPED = re.compile(r"""[\x00-\x1F"#%'*/:=?\\\x7F{\[\]^]""")

_SCHEME = re.compile(r"^([A-Za-z][A-Za-z0-9+.-]*):")
_OWN = re.compile(r"^part-\d{5}-([0-9a-f]{32})-")


def address_filesystem(path: str, options: dict | None = None) -> tuple[pa.fs.FileSystem, str]:
    """Filesystem and path of an address. A plain path is on the filesystem that Spark takes for one; credentials come from
    the options that Spark's own connectors read. A scheme that pyarrow cannot reach is an error."""
    options = {k.lower(): v for k, v in (options or {}).items()}
    scheme = _SCHEME.match(path)
    if not scheme:
        if DEFAULT.startswith("file:"):
            return pa.fs.LocalFileSystem(), os.path.abspath(path)
        if not path.startswith("/"):
            raise ValueError(f"a path without a scheme must be absolute: {path!r}")
        return address_filesystem(DEFAULT.rstrip("/") + path, options)
    kind, parts = scheme[1].lower(), urlsplit(path)
    if kind == "file":
        return pa.fs.LocalFileSystem(), os.path.abspath(parts.path)
    if kind in ("hdfs", "gs"):
        return pa.fs.FileSystem.from_uri(path)
    if kind in ("s3", "s3a", "s3n"):
        names = {"access_key": "access.key", "secret_key": "secret.key", "session_token": "session.token",
                 "endpoint_override": "endpoint", "region": "endpoint.region"}
        settings = {k: options[f"fs.s3a.{n}"] for k, n in names.items() if f"fs.s3a.{n}" in options}
        return pa.fs.S3FileSystem(**settings), parts.netloc + parts.path
    if kind in ("abfs", "abfss"):
        container, _, host = parts.netloc.partition("@")
        token, key = (options.get(f"fs.azure.{n}.{host}".lower()) for n in ("sas.fixed.token", "account.key"))
        settings = {"sas_token": token} if token else {"account_key": key} if key else {}
        return pa.fs.AzureFileSystem(host.partition(".")[0], **settings), container + parts.path
    raise ValueError(f"Arrow files cannot be written to or read from {scheme[0]} addresses")


def _names(fs: pa.fs.FileSystem, root: str, recursive: bool = False) -> list[str]:
    return sorted(_ages(fs, root, recursive))


def _ages(fs: pa.fs.FileSystem, root: str, recursive: bool = True) -> dict[str, float]:
    """The files below a folder, by their path from there, with the seconds since they were written."""
    found = fs.get_file_info(pa.fs.FileSelector(root, recursive=recursive, allow_not_found=True))
    now = time.time()
    return {f.path[len(root) :].lstrip("/"): now - (f.mtime_ns or now * 1e9) / 1e9 for f in found if f.is_file}


@dataclass
class Landed:
    """The files of the last write that was finished: paths from the folder; the partition columns, each `(name, type)`;
    and the values of each file, as texts."""

    files: list
    columns: list
    values: dict
    schema: str = ""


def _landed(fs: pa.fs.FileSystem, root: str) -> Landed:
    """By the manifest; in a folder without one, the files that are not left over from an unfinished write."""
    names = _names(fs, root)
    manifest = _manifest(fs, root, names)
    if manifest is None:
        return Landed([n for n in names if not n.startswith(("_", ".")) and not _OWN.match(n)], [], {})
    return Landed(sorted(manifest["files"]), manifest.get("columns", []), manifest.get("values", {}), manifest.get("schema", ""))


def _manifest(fs: pa.fs.FileSystem, root: str, names: list[str]) -> dict | None:
    for name in sorted((n for n in names if n.startswith(MANIFEST)), reverse=True):
        with fs.open_input_stream(f"{root}/{name}") as f:
            try:
                found = json.loads(f.read())
                found["files"]
                return found
            except (ValueError, KeyError, TypeError):
                continue  # cut off while it was written: the one before counts
    return None


def folder_name(name: str, value: str | None) -> str:
    """`name=value` as Hive and Spark write it."""
    value = NULL_FOLDER if value is None or value == "" else ESCAPED.sub(lambda m: f"%{ord(m[0]):02X}", value)
    return f"{ESCAPED.sub(lambda m: f'%{ord(m[0]):02X}', name)}={value}"


def _distinct(keys: list[pa.Array]) -> Iterator[tuple[list, pa.Array]]:
    """The values of partition columns that rows have, as texts, and the places of each one's rows."""
    rows = pa.table([*keys, pa.array(range(len(keys[0])))], names=[*(f"k{i}" for i in range(len(keys))), "row"])
    groups = rows.group_by([f"k{i}" for i in range(len(keys))], use_threads=False).aggregate([("row", "list")])
    for group in groups.to_pylist():
        yield [group[f"k{i}"] for i in range(len(keys))], pa.array(group["row_list"], pa.int64())


@dataclass
class Written(WriterCommitMessage):
    files: list
    values: dict | None = None


class ArrowSink(DataSourceArrowWriter):
    def __init__(self, options: dict, schema: pa.Schema, overwrite: bool):
        self.path, self.options = options["path"], options
        self.schema = schema
        self.overwrite = overwrite
        self.compression = options.get("compression", "").lower()
        self.max_rows = int(options.get("maxrecordsperfile", 0))
        self.batch_rows = int(options.get("batchrows", 0)) or None
        self.by = json.loads(options.get("partitionby", "") or "[]")
        self.inside = pa.schema([f for f in schema if f.name not in self.by])
        self.job = uuid.uuid4().hex

    def write(self, batches: Iterator[pa.RecordBatch]) -> Written:
        """Files of one task attempt, under names of its own. They count once a manifest lists them.

        A partitioned write keeps one stream open for each value it meets, up to a bound; then the one that was not
        written to for longest is closed, and more rows of its value go to another file.
        """
        from pyspark import TaskContext

        fs, root = address_filesystem(self.path, self.options)
        context = TaskContext.get()
        stem = f"part-{context.partitionId():05d}-{self.job}-{context.taskAttemptId()}"
        fs.create_dir(root, recursive=True)
        files: list[str] = []
        values: dict[str, list] = {}
        streams: dict[tuple, _Stream] = {}
        try:
            for batch in batches:
                batch = self._typed(batch)
                for key, rows in self._dealt(batch):
                    at = 0
                    while at < rows.num_rows:
                        stream = streams.pop(tuple(key), None)
                        if stream is None:
                            if len(streams) >= MOST_OPEN:
                                streams.pop(next(iter(streams))).close()
                            folder = "/".join(folder_name(n, v) for n, v in zip(self.by, key))
                            stream = self._open(fs, root, folder, f"{stem}-{len(files):03d}", files)
                            values[files[-1]] = key
                        streams[tuple(key)] = stream  # the last one written to comes last
                        take = min(rows.num_rows - at, self.max_rows - stream.rows) if self.max_rows else rows.num_rows - at
                        stream.write(rows.slice(at, take), self.batch_rows)
                        at += take
                        if stream.rows == self.max_rows:
                            streams.pop(tuple(key)).close()
            if not files and not self.by and context.partitionId() == 0:
                streams[()] = self._open(fs, root, "", f"{stem}-000", files)
        except BaseException:
            self._delete(fs, root, files)
            raise
        finally:
            for stream in streams.values():
                stream.close()
        return Written(files, values if self.by else None)

    def _dealt(self, batch: pa.RecordBatch) -> Iterator[tuple[list, pa.RecordBatch]]:
        """The rows of a batch by their values of the partition columns, without these columns."""
        if not self.by:
            yield [], batch
            return
        inside = batch.select(self.inside.names)
        keys = [_text(batch.column(n)) for n in self.by]
        for key, rows in _distinct(keys):
            yield key, inside if len(rows) == len(batch) else inside.take(rows)

    def _open(self, fs: pa.fs.FileSystem, root: str, folder: str, stem: str, files: list) -> _Stream:
        name = stem + ".arrow" + (".gz" if self.compression == "gzip" else "")
        if folder:
            fs.create_dir(f"{root}/{folder}", recursive=True)
            name = f"{folder}/{name}"
        files.append(name)
        return _Stream(fs.open_output_stream(f"{root}/{name}", compression=None), self.inside, self.compression)

    def _typed(self, batch: pa.RecordBatch) -> pa.RecordBatch:
        columns = [c if c.type == f.type else c.cast(f.type) for c, f in zip(batch.columns, self.schema)]
        return pa.RecordBatch.from_arrays(columns, schema=self.schema)

    def commit(self, messages: list) -> None:
        """List the files of the attempts that counted in a new manifest; nothing is moved. Until it is complete the
        old one holds, and its files are only deleted after that. Files that no manifest lists are of jobs that died: an
        append, which other jobs may go on beside, deletes those that are old."""
        fs, root = address_filesystem(self.path, self.options)
        fs.create_dir(root, recursive=True)
        ages = _ages(fs, root)
        landed = Landed([], [], {}) if self.overwrite else _landed(fs, root)
        columns = [[n, _ddl(self.schema.field(n).type)] for n in self.by]
        if landed.files and landed.columns != columns:
            raise ValueError(f"rows partitioned by {columns} cannot be added to a folder partitioned by {landed.columns}")
        files = landed.files + [name for message in messages if message for name in message.files]
        listed: dict = {"files": files}
        if self.by:
            values = {k: v for message in messages if message for k, v in (message.values or {}).items()}
            listed |= {"columns": columns, "values": landed.values | values}
        listed["schema"] = base64.b64encode(self.inside.serialize().to_pybytes()).decode()
        manifest = f"{MANIFEST}-{time.time_ns():020d}-{self.job}"
        with fs.open_output_stream(f"{root}/{manifest}") as f:
            f.write(json.dumps(listed).encode())
        live = {*files, manifest}

        def goes(name: str, age: float) -> bool:
            last = name.rsplit("/", 1)[-1]
            return self.overwrite or last.startswith(MANIFEST) or self.job in last or bool(_OWN.match(last)) and age > LEFT_OVER

        self._delete(fs, root, [n for n, age in ages.items() if n not in live and goes(n, age)])
        with fs.open_output_stream(f"{root}/_SUCCESS"):
            pass

    def abort(self, messages: list) -> None:
        fs, root = address_filesystem(self.path, self.options)
        self._delete(fs, root, [n for n in _names(fs, root, recursive=True) if self.job in n])

    @staticmethod
    def _delete(fs: pa.fs.FileSystem, root: str, names: list[str]) -> None:
        """Delete files, then folders of values that this leaves empty. What cannot be deleted stays and does not count."""
        for name in names:
            try:
                fs.delete_file(f"{root}/{name}")
            except OSError:
                pass
        folders = {n.rsplit("/", 1)[0] for n in names if "/" in n}
        while folders:
            for folder in folders:
                try:
                    if not fs.get_file_info(pa.fs.FileSelector(f"{root}/{folder}")):
                        fs.delete_dir(f"{root}/{folder}")
                except OSError:
                    pass
            folders = {f.rsplit("/", 1)[0] for f in folders if "/" in f}


class _Stream:
    def __init__(self, file: pa.NativeFile, schema: pa.Schema, compression: str):
        self.file = file
        self.out = pa.CompressedOutputStream(file, "gzip") if compression == "gzip" else file
        body = compression if compression in ("lz4", "zstd") else None
        self.ipc = pa.ipc.new_stream(self.out, schema, options=pa.ipc.IpcWriteOptions(compression=body))
        self.rows = 0

    def write(self, batch: pa.RecordBatch, batch_rows: int | None) -> None:
        self.ipc.write_table(pa.Table.from_batches([batch]), max_chunksize=batch_rows)
        self.rows += batch.num_rows

    def close(self) -> None:
        self.ipc.close()
        if self.out is not self.file:
            self.out.close()
        self.file.close()


def _text(column: pa.Array) -> pa.Array:
    """Values as the manifest and folder names have them."""
    if pa.types.is_string(column.type):
        return column
    if pa.types.is_boolean(column.type) or pa.types.is_integer(column.type) or pa.types.is_date(column.type) or pa.types.is_decimal(column.type):
        return column.cast(pa.string())
    raise ValueError(f"Arrow files cannot be partitioned by values of type {column.type}")


def _ddl(kind: pa.DataType) -> str:
    from pyspark.sql.pandas.types import from_arrow_type

    return from_arrow_type(kind).simpleString()


def _value(text: str | None, kind: str):
    """A value of a partition column, as filters have it."""
    if text is None or kind == "string":
        return text
    if kind == "boolean":
        return text == "true"
    if kind == "date":
        return date.fromisoformat(text)
    return Decimal(text) if kind.startswith("decimal") else int(text)


#: Whether a value that is not null meets a filter.
_MEETS = {
    EqualTo: lambda f, v: v == f.value, EqualNullSafe: lambda f, v: v == f.value, In: lambda f, v: v in f.value,
    GreaterThan: lambda f, v: v > f.value, GreaterThanOrEqual: lambda f, v: v >= f.value, LessThan: lambda f, v: v < f.value,
    LessThanOrEqual: lambda f, v: v <= f.value, IsNotNull: lambda f, v: True, IsNull: lambda f, v: False,
    StringStartsWith: lambda f, v: v.startswith(f.value), StringEndsWith: lambda f, v: v.endswith(f.value),
    StringContains: lambda f, v: f.value in v,
}


def _column(f: Filter) -> str | None:
    """The column a filter is about, if it is one that is known here."""
    inner = f.child if isinstance(f, Not) else f
    return inner.attribute[0] if type(inner) in _MEETS and len(inner.attribute) == 1 else None


def lets_through(f: Filter, value) -> bool:
    """Whether rows with this value can meet the filter: where that is not certain they can."""
    inner = f.child if isinstance(f, Not) else f
    wanted = getattr(inner, "value", None)
    if value is None:
        if isinstance(f, Not):
            return type(inner) in (IsNotNull, EqualNullSafe) and not (type(inner) is EqualNullSafe and wanted is None)
        return type(inner) is IsNull or type(inner) is EqualNullSafe and wanted is None
    try:
        met = _MEETS[type(inner)](inner, value)
    except TypeError:
        return True
    if isinstance(f, Not) and isinstance(inner, In) and None in inner.value:
        return False  # neither true nor false for any value
    return met != isinstance(f, Not)


@dataclass
class StreamFile(InputPartition):
    path: str
    values: list


class ArrowFiles(DataSourceReader):
    def __init__(self, options: dict, schema):
        self.path, self.options = options["path"], options
        self.names, self.filters = schema.names, []

    def pushFilters(self, filters: list[Filter]) -> list[Filter]:
        """Filters on partition columns choose the files to open. Spark applies all of them to the rows as well."""
        self.filters = [f for f in filters if _column(f) is not None]
        return filters

    def partitions(self) -> list[StreamFile]:
        fs, root = address_filesystem(self.path, self.options)
        landed = _landed(fs, root)
        place = {name: i for i, (name, _) in enumerate(landed.columns)}
        kept = []
        for name in landed.files:
            values = landed.values.get(name, [])
            known = [(f, place[_column(f)]) for f in self.filters if _column(f) in place]
            if all(lets_through(f, _value(values[i], landed.columns[i][1])) for f, i in known):
                kept.append(StreamFile(f"{root}/{name}", [[c, k, v] for (c, k), v in zip(landed.columns, values)]))
        return kept or [StreamFile("", [])]

    def read(self, partition: StreamFile) -> Iterator[pa.RecordBatch]:
        if not partition.path:
            return
        fs, _ = address_filesystem(self.path, self.options)
        fixed = {name: pa.scalar(_value(text, kind), _arrow_type(kind)) for name, kind, text in partition.values}
        with _open_stream(fs, partition.path) as stream:
            for batch in stream:
                columns = [pa.repeat(fixed[n], batch.num_rows) if n in fixed else _plain(batch.column(n)) for n in self.names]
                yield pa.RecordBatch.from_arrays(columns, names=self.names)


def _arrow_type(kind: str) -> pa.DataType:
    """The Arrow type of a partition column."""
    if kind.startswith("decimal"):
        return pa.decimal128(*map(int, re.findall(r"\d+", kind)))
    return {
        "string": pa.string(), "boolean": pa.bool_(), "date": pa.date32(), "tinyint": pa.int8(), "smallint": pa.int16(), "int": pa.int32(),
        "bigint": pa.int64(),
    }[kind]


def _open_stream(fs: pa.fs.FileSystem, path: str) -> pa.ipc.RecordBatchStreamReader:
    return pa.ipc.open_stream(fs.open_input_stream(path, compression="gzip" if path.endswith(".gz") else None))


def _plain(column: pa.Array) -> pa.Array:
    return column.cast(pa.binary()) if pa.types.is_fixed_size_binary(column.type) else column


class ArrowStreams(DataSource):
    """Folder of Arrow IPC stream files."""

    @classmethod
    def name(cls) -> str:
        return "ferry_arrow"

    def schema(self):
        from pyspark.sql.pandas.types import from_arrow_schema

        fs, root = address_filesystem(self.options["path"], dict(self.options))
        landed = _landed(fs, root)
        if landed.files:
            with _open_stream(fs, f"{root}/{landed.files[0]}") as stream:
                inside = stream.schema
        elif landed.schema:  # a partitioned write without rows has no files
            inside = pa.ipc.read_schema(pa.py_buffer(base64.b64decode(landed.schema)))
        else:
            raise FileNotFoundError(f"no Arrow streams in {self.options['path']}")
        return from_arrow_schema(pa.schema([*inside, *(pa.field(n, _arrow_type(k)) for n, k in landed.columns)]))

    def reader(self, schema) -> ArrowFiles:
        return ArrowFiles(dict(self.options), schema)

    def writer(self, schema, overwrite: bool) -> ArrowSink:
        options = dict(self.options)
        if options.get("compression", "").lower() not in COMPRESSIONS:
            raise ValueError(f"unsupported Arrow compression: {options['compression']}")
        made = arrow_schema(schema, options.get("fields", ""))
        for name in json.loads(options.get("partitionby", "") or "[]"):
            _text(pa.array([], made.field(name).type))  # an error for types that have no plain text
        return ArrowSink(options, made, overwrite)


def arrow_schema(schema, fields: str = "") -> pa.Schema:
    """Arrow schema of a Spark schema: nullable fields, UUIDs as 16 bytes, timestamps in UTC.

    `fields` is JSON text with one {name, type, length} per column, stored as field metadata.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    notes = {n["name"]: n for n in json.loads(fields or "[]")}
    out = []
    for field in to_arrow_schema(schema):
        note = notes.get(field.name, {})
        kind = field.type
        if note.get("type") == "UUID" and pa.types.is_binary(kind):
            kind = pa.binary(16)
        meta = {k: str(note[k]) for k in ("name", "type", "length") if k in note}
        out.append(pa.field(field.name, kind, True, meta or None))
    return pa.schema(out)


_registered = weakref.WeakSet()
_registering = threading.Lock()


def register(spark) -> None:
    """Make the format known to a session, once: doing it again would hide it from other threads for a moment.

    The classes travel by value, so executors need not have this package.
    """
    from pyspark import cloudpickle

    global DEFAULT
    with _registering:
        if spark not in _registered:
            DEFAULT = spark._jsc.hadoopConfiguration().get("fs.defaultFS", "file:///")
            cloudpickle.register_pickle_by_value(sys.modules[__name__])
            spark.dataSource.register(ArrowStreams)
            # Without it filters on partition columns would be applied after all files were read.
            spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
            _registered.add(spark)
