from ferry.operators.columns import (
    columns_of, conform, describe, normalise, override, override_columns, parse_column_specs,
)
from ferry.operators.lines import csv_lines, jsonl_lines, redact_url
from ferry.operators.profile import measure_columns

__all__ = [
    "columns_of", "conform", "csv_lines", "describe", "jsonl_lines", "measure_columns", "normalise", "override",
    "override_columns", "parse_column_specs", "redact_url",
]
