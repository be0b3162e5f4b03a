"""Table mover on Spark: read, convert to canonical types, land as CSV, JSON lines, Parquet or Arrow."""

from ferry.operators import (
    columns_of, conform, csv_lines, describe, jsonl_lines, measure_columns, normalise, override, override_columns,
    parse_column_specs, redact_url,
)
from ferry.plans import MoveError, MoveSpec, make_spec, make_specs, move, move_many, plan, preview, select_tables
from ferry.sinks import landed, read_landed
from ferry.sources import Param, exec_sql, register_tables, run_sql
from ferry.types import Column

__all__ = [
    "Column", "MoveError", "MoveSpec", "Param", "columns_of", "conform", "csv_lines", "describe", "exec_sql",
    "jsonl_lines", "landed", "make_spec", "make_specs", "measure_columns", "move", "move_many", "normalise", "override",
    "override_columns", "parse_column_specs", "plan", "preview", "read_landed", "redact_url", "register_tables", "run_sql",
    "select_tables",
]
