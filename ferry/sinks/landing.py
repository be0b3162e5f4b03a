"""A folder whose rows are replaced as a whole: the old ones stay until the new ones are complete.

The files of a write carry the name of its job. They are added beside the old ones, then a small file that names the job
is written, then the old files are deleted. A write that fails or dies before the small file is whole changes nothing
for readers that follow it (`read_landed`); one that dies after it leaves files that these readers pass over and the
next write deletes. Nothing is moved or listed by name, so a table may have any number of files.
"""

from __future__ import annotations

import re
import time
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import types as T

from ferry.sinks import arrow

MARK = "_landed-"
#: How the data files of a job begin; Spark's own begin `part-` and a digit.
JOB = re.compile(r"^part-(j[0-9a-f]{32})-")
#: Names that begin otherwise: what counts in a folder where no job of ours has ended.
OTHERS = "{" + ",".join(f"{'part-'[:k]}[!{c}]*" for k, c in enumerate("part-j")) + "}"


class Folder:
    """A folder on any filesystem that Spark has, with the credentials of its target."""

    def __init__(self, spark: SparkSession, path: str, options: dict | None = None):
        self.spark, self.name, self.options, self.hadoop = spark, path, dict(options or {}), spark._jvm.org.apache.hadoop.fs
        conf = spark._jsparkSession.sessionState().newHadoopConf()
        for key, value in self.options.items():
            conf.set(key, str(value))
        self.path = self.hadoop.Path(path)
        self.fs = self.path.getFileSystem(conf)

    def marks(self) -> list:
        """The files that name jobs, the newest first."""
        found = self.fs.globStatus(self.hadoop.Path(literal_path(self.name), f"{MARK}*")) or []
        return sorted((f.getPath() for f in found), key=lambda p: p.getName(), reverse=True)

    def job(self) -> str | None:
        """The job whose rows count. A mark that was cut off while it was written is passed over."""
        for mark in self.marks():
            stream = self.fs.open(mark)
            try:
                text = bytes(stream.readAllBytes()).decode()
            finally:
                stream.close()
            if re.fullmatch(r"j[0-9a-f]{32}\n", text):
                return text.strip()
        return None

    def files(self) -> list[str]:
        """Addresses of all data files, those of unfinished and past jobs too."""
        if not self.fs.exists(self.path):
            return []
        listing = self.spark.read.format("binaryFile").options(**self.options).option("recursiveFileLookup", "true")
        return list(listing.load(literal_path(self.name)).inputFiles())

    def commit(self, job: str) -> None:
        """From here on the rows of this job count; then what is not of it goes."""
        old = self.marks()
        mark = self.hadoop.Path(self.path, f"{MARK}{time.time_ns():020d}-{job}")
        stream = self.fs.create(mark, True)
        try:
            stream.write(f"{job}\n".encode())
        finally:
            stream.close()
        try:
            self._delete([f for f in self.files() if _job_of(f) != job])
            for path in old:
                self.fs.delete(path, False)
        except Exception:  # what cannot be listed or deleted stays and does not count
            pass

    def abort(self, job: str) -> None:
        """Delete what a failed job has left, if it can be reached."""
        try:
            self._delete([f for f in self.files() if _job_of(f) == job])
        except Exception:
            pass

    def _delete(self, files: list[str]) -> None:
        """Delete files, then the folders of partition values that this leaves empty."""
        paths = [self.hadoop.Path(self.spark._jvm.java.net.URI(f)) for f in files]

        def delete(path) -> None:
            try:
                self.fs.delete(path, False)
            except Exception:
                pass

        with ThreadPoolExecutor(8) as pool:
            list(pool.map(delete, paths))
        top = self.fs.makeQualified(self.path).toString()
        folders = {p.getParent().toString(): p.getParent() for p in paths}
        while folders := {k: p for k, p in folders.items() if k.startswith(f"{top}/")}:
            for path in folders.values():
                if self.fs.exists(path) and not self.fs.listStatus(path):
                    self.fs.delete(path, False)
            folders = {p.getParent().toString(): p.getParent() for p in folders.values()}


def _job_of(file: str) -> str | None:
    found = JOB.match(file.rsplit("/", 1)[1])
    return found[1] if found else None


def literal_path(path: str) -> str:
    """A path whose characters stand for themselves, not for a pattern."""
    return re.sub(r"([\\*?\[\]{}])", r"\\\1", path)


def new_job() -> str:
    return f"j{uuid.uuid4().hex}"


def job_options(job: str) -> dict[str, str]:
    """Options of a Spark write that names its files after the job and shows none before all tasks are done."""
    return {"mapreduce.output.basename": f"part-{job}", "mapreduce.fileoutputcommitter.algorithm.version": "1"}


def job_files(job: str) -> str:
    return f"part-{job}-*"


def landed(spark: SparkSession, path: str, options: dict | None = None) -> DataFrameReader:
    """A reader of the files whose rows count, in a folder of csv, jsonl or parquet files."""
    folder = Folder(spark, path, options)
    job = folder.job()
    return spark.read.options(**folder.options).option("pathGlobFilter", job_files(job) if job else OTHERS)


def read_landed(
    spark: SparkSession, path: str, fmt: str, schema: T.StructType | str | None = None, null_value: str = "NULL", options: dict | None = None
) -> DataFrame:
    """The rows of the last move to a folder that was completed. `schema` is that of csv and jsonl rows; without it csv
    columns are text and jsonl ones are inferred."""
    if fmt.lower() == "arrow":
        arrow.register(spark)
        return spark.read.format("ferry_arrow").options(**(options or {})).load(path)
    reader = landed(spark, path, options)
    if schema is not None:
        reader = reader.schema(schema)
    path = literal_path(path)
    if fmt.lower() == "csv":
        return reader.csv(
            path, header=True, multiLine=True, escape='"', nullValue=null_value, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
        )
    if fmt.lower() == "jsonl":
        return reader.json(path)
    if fmt.lower() == "parquet":
        return reader.parquet(path)
    raise ValueError(f"unsupported format: {fmt!r}")
