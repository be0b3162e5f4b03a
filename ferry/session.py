"""Session settings that a move relies on."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession


SETTINGS = {
    # The default INT96 loses the logical type of Parquet timestamps.
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    # JSON objects may repeat a key; the last one counts.
    "spark.sql.variant.allowDuplicateKeys": "true",
}


def configure(spark: SparkSession) -> None:
    for key, value in SETTINGS.items():
        if spark.conf.get(key) != value:
            spark.conf.set(key, value)


def work_folder(spark: SparkSession) -> str:
    """A new folder that every executor can reach: below `spark.checkpoint.dir`, or a local one in local mode."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return f"{shared.rstrip('/')}/ferry-{uuid.uuid4().hex}"
    if not re.match(r"local(\[|$)", spark.conf.get("spark.master", "")):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return tempfile.mkdtemp(prefix="ferry-")
