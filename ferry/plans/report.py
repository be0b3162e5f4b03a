"""One row per move: where from, where to, how much, how long, how it ended."""

from __future__ import annotations

import re
import time
from dataclasses import astuple, dataclass

from pyspark.sql import DataFrame, SparkSession

SCHEMA = (
    "source string, sql string, path string, rows bigint, bytes bigint, elapsed_ms bigint, "
    "duration string, success boolean, error string"
)


# Names of settings whose values are not shown, and the forms a value takes.
_SECRET = re.compile(
    r"""\b(password|passwd|pwd|user|username|uid|token|sig|secret|private_key|account\.?key|access_?key|secret_?key)\s*=\s*(?:\{(?:[^}]|\}\})*\}|"[^"]*"|'[^']*'|[^\s;&,'"<>]+)""",
    re.I,
)


def redact(url: str) -> str:
    """URL without user information and query."""
    url = re.sub(r"^([a-zA-Z][a-zA-Z0-9+.-]*://)[^/?#]*@", r"\1", url)
    return re.sub(r"[?][^#]*", "", url)


def redact_text(text: str) -> str:
    """Text in which every URL has lost its user information, query and `;` settings, and settings that name a secret, braced
    ones too, their values."""
    text = _SECRET.sub(r"\1=***", text)
    return re.sub(r"[a-zA-Z][a-zA-Z0-9+.-]*://[^\s'\"<>]+", lambda m: redact(m[0]).split(";")[0], text)


@dataclass
class MoveReport:
    source: str
    sql: str
    path: str = ""
    rows: int = 0
    bytes: int | None = 0
    elapsed_ms: int = 0
    duration: str = ""
    success: bool = False
    error: str = ""

    def __post_init__(self):
        self.source, self.path = redact(self.source), redact(self.path)
        self._start = time.monotonic()

    def finish(self, success: bool, error: str = "") -> MoveReport:
        seconds = time.monotonic() - self._start
        self.elapsed_ms, self.duration = int(seconds * 1000), f"{seconds:.3f}s"
        self.success, self.error = success, redact_text(error)
        return self


class MoveError(RuntimeError):
    """A move failed; `reports` holds its report after those of the moves before it."""

    def __init__(self, message: str, reports: list[MoveReport]):
        super().__init__(message)
        self.reports = reports


def report_frame(spark: SparkSession, reports: list[MoveReport]) -> DataFrame:
    return spark.createDataFrame([astuple(r) for r in reports], SCHEMA)

