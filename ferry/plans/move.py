"""Moves: read a source, convert its columns, land them, report."""

from __future__ import annotations

import os
import threading
import uuid
from collections.abc import Mapping
from concurrent.futures import Future, ThreadPoolExecutor, wait

from pyspark.sql import DataFrame, Observation, SparkSession

from ferry.operators.columns import columns_of, conform, override_columns
from ferry.operators.lines import csv_lines, jsonl_lines
from ferry.plans.report import MoveError, MoveReport, redact_text, report_frame
from ferry.plans.spec import (
    MoveSpec, make_spec, make_specs, merge, select_tables, user_variables, with_environment, with_tokens,
)
from ferry.session import configure
from ferry.sinks import Target, hadoop_path, output_path, render_name, write, written_bytes
from ferry.sources import dialect_of, keeps_uuid_order, read_source


def plan(spark: SparkSession, spec: MoveSpec | Mapping | str, source: str = "table:") -> DataFrame:
    """The rows of a move in their output types, not yet written."""
    spec = with_tokens(make_spec(spec).check())
    configure(spark)
    df = read_source(spark, source, spec)
    if spec.writers and not spec.partition_by:  # rows are dealt by partition_by anyway
        df = df.repartition(spec.writers)
    dialect = dialect_of(source)
    columns = columns_of(df, dialect)
    fix = dialect == "sqlserver" and not keeps_uuid_order(source)
    wanted = override_columns(columns, spec.columns)
    return conform(df, wanted, columns, spec.on_error, spec.strict_scale, fix)


def preview(spark: SparkSession, spec: MoveSpec | Mapping | str, source: str = "table:", rows: int = 20) -> DataFrame:
    """The first rendered lines of a csv or jsonl move."""
    spec = with_environment(make_spec(spec))
    if spec.format.lower() not in ("csv", "jsonl"):
        raise ValueError("preview is for csv and jsonl")
    df = plan(spark, spec, source).limit(rows)
    return csv_lines(df, spec.null_value) if spec.format.lower() == "csv" else jsonl_lines(df)


def _run(spark: SparkSession, spec: MoveSpec, source: str, dest: str) -> MoveReport:
    report = MoveReport(source, spec.sql or f"SELECT * FROM {spec.stream_name}")
    try:
        spec = with_tokens(spec.check())
        report.sql = spec.query()
        name = render_name(spec.filename, spec.stream_name, spec.format, spec.compression, variables=user_variables())
        path, options = hadoop_path(output_path(dest, name))
        report = MoveReport(source, report.sql, path)
        if spec.on_error == "fail" and spark.conf.get("spark.sql.ansi.enabled") != "true":
            raise ValueError("on_error='fail' needs spark.sql.ansi.enabled=true")
        seen = Observation()
        df = plan(spark, spec, source)
        target = Target(
            path, spec.compression, spec.batch_size, spec.row_group_rows, spec.null_value, spec.uuid_as, spec.partition_by, options
        )
        names = write(df, spec.format, target, seen)
        report.rows = seen.get.get("rows", 0)
    except Exception as e:
        report.finish(False, str(e))
        raise MoveError(f"move of {spec.stream_name or 'query'} failed: {report.error}", [report]) from e
    try:
        report.bytes = written_bytes(df, path, options, names)
    except Exception as e:  # the rows have landed
        report.bytes = None
        return report.finish(True, f"size unknown: {e}")
    return report.finish(True)


def _ends(source: str, dest: str) -> tuple[str, str]:
    source = source or os.environ.get("FERRY_SOURCE", "") or "table:"
    dest = dest or os.environ.get("FERRY_DEST", "")
    if not dest:
        raise ValueError("a destination is required")
    return source, dest


def move(
    spark: SparkSession, spec: MoveSpec | Mapping | str, dest: str = "", source: str = "", flags: MoveSpec | Mapping | None = None
) -> DataFrame:
    """Run one move, with the settings of `flags` over its own; the returned row is its report. A failed move raises MoveError."""
    source, dest = _ends(source, dest)
    spec = merge(make_spec(spec), make_spec(flags or {}))
    return report_frame(spark, [_run(spark, with_environment(spec), source, dest)])


def move_many(
    spark: SparkSession,
    job: Mapping | str | list[MoveSpec],
    dest: str = "",
    source: str = "",
    select: str = "",
    flags: MoveSpec | Mapping | None = None,
    concurrency: int = 1,
) -> DataFrame:
    """Run the selected tables of a job, `concurrency` at a time; the first failure ends those that run and stops those not
    begun.

    Each table has a scheduler pool of its own, named after its stream, so that with `spark.scheduler.mode=FAIR` tables
    that run side by side share the executors evenly, whatever their sizes; with FIFO the one that began first takes what it
    can use. All jobs of a call carry one tag, by which they are cancelled. The reports of the tables that were ended are
    with those of the failed one and the finished ones in the MoveError, that of the failed one first after these.
    """
    source, dest = _ends(source, dest)
    specs = job if isinstance(job, list) else make_specs(job, flags)
    specs = [with_environment(s) for s in select_tables(specs, select)]
    context, tag = spark.sparkContext, f"ferry-{uuid.uuid4().hex}"
    stop, first, lock = threading.Event(), [], threading.Lock()

    def run(spec: MoveSpec, number: int) -> MoveReport | None:
        if stop.is_set():
            return None
        # This also makes the session the active one of the pool's thread, which looking up a format needs.
        spark.createDataFrame([], "unused int")
        context.addJobTag(tag)
        context.setLocalProperty("spark.scheduler.pool", f"ferry-{number}-{spec.stream_name}")
        try:
            return _run(spark, spec, source, dest)
        except MoveError as e:
            with lock:
                if stop.is_set():  # ended because another table had failed
                    for report in e.reports:
                        report.error = redact_text(f"ended, as another table failed: {report.error}")
                else:
                    first.append(e)
                    stop.set()
            raise
        finally:
            context.setLocalProperty("spark.scheduler.pool", None)
            context.removeJobTag(tag)

    with ThreadPoolExecutor(max(1, concurrency)) as pool:
        runs = [pool.submit(run, s, i) for i, s in enumerate(specs)]
        _wait(context, tag, stop, runs)
    ended = [r.exception() for r in runs if r.exception()]
    reports = [r.result() for r in runs if not r.exception() and r.result()]
    if ended:
        failed = first[0] if first else ended[0]
        others = [e for e in ended if e is not failed]
        raise MoveError(str(failed), reports + [r for e in (failed, *others) for r in getattr(e, "reports", [])]) from failed
    return report_frame(spark, reports)


def _wait(context, tag: str, stop: threading.Event, runs: list[Future]) -> None:
    """Until all tables have ended. Once one has failed the jobs of the others are cancelled, again and again: a table that was
    between two jobs begins its next one first."""
    while wait(runs, timeout=0.2).not_done:
        if stop.is_set():
            context.cancelJobsWithTag(tag)
