"""What to move: the settings of one job or of a list of tables."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass, field, fields, replace
from datetime import date

import yaml

from ferry.operators.columns import column_spec
from ferry.sinks.paths import render_tokens, token_values
from ferry.sources.params import Param, make_param, overlay_params
from ferry.types import Column

PARAM_PREFIX = "FERRY_PARAM_"
VARIABLE_PREFIX = "FERRY_VAR_"


@dataclass(frozen=True)
class MoveSpec:
    """One move. `batch_size` bounds the rows of an output file; 0 leaves file sizes to the scan."""

    stream_name: str = ""
    sql: str = ""
    filename: str = ""
    format: str = ""
    compression: str = ""
    columns: tuple[Column, ...] = ()
    params: dict[str, Param] = field(default_factory=dict)
    batch_size: int = 0
    batch_count: int = 0
    # Most rows of a Parquet row group; 0 leaves it to the writer, whose groups go by size.
    row_group_rows: int = 0
    # Tasks that convert and write; 0 leaves it to the scan, more costs a shuffle of the rows.
    writers: int = 0
    # Settings beyond one cursor and one file.
    on_error: str = "fail"
    strict_scale: bool = False
    null_value: str = "NULL"
    uuid_as: str = "text"
    partition_by: tuple[str, ...] = ()
    partition_column: str = ""
    partitions: int = 1
    split: str = "range"
    fetch_size: int = 10000
    # Names of the settings that were stated, also where they equal the default; None: those that differ from it.
    given: frozenset[str] | None = field(default=None, compare=False, repr=False)

    def stated(self) -> frozenset[str]:
        if self.given is not None:
            return self.given
        default = MoveSpec(given=frozenset())
        return frozenset(n for n in SETTINGS if getattr(self, n) != getattr(default, n))

    def query(self) -> str:
        self.check()
        return self.sql or f"SELECT * FROM {self.stream_name}"

    def check(self) -> MoveSpec:
        if not self.stream_name and not self.sql:
            raise ValueError("stream_name or sql must be given")
        if self.uuid_as not in ("text", "bytes"):
            raise ValueError(f"uuid_as must be text or bytes: {self.uuid_as!r}")
        return self


SETTINGS = frozenset(f.name for f in fields(MoveSpec)) - {"given"}


def make_spec(item: MoveSpec | Mapping | str) -> MoveSpec:
    """Spec from a mapping or YAML text."""
    if isinstance(item, MoveSpec):
        return item
    settings = dict(yaml.safe_load(item) or {}) if isinstance(item, str) else dict(item)
    unknown = set(settings) - SETTINGS
    if unknown:
        raise ValueError(f"unknown settings: {', '.join(sorted(unknown))}")
    settings = {k: v for k, v in settings.items() if v is not None}
    if "columns" in settings:
        settings["columns"] = tuple(column_spec(c) for c in settings["columns"])
    if "params" in settings:
        settings["params"] = {str(k): make_param(v) for k, v in settings["params"].items()}
    if "partition_by" in settings:
        by = settings["partition_by"]
        settings["partition_by"] = (by,) if isinstance(by, str) else tuple(by)
    return MoveSpec(**settings, given=frozenset(settings))


def merge(base: MoveSpec, over: MoveSpec) -> MoveSpec:
    """Settings that `over` states win, whatever their value; an empty one (`null` in YAML) states nothing."""
    changes = {name: getattr(over, name) for name in over.stated()}
    return replace(base, **changes, given=base.stated() | over.stated())


def merge_table(root: MoveSpec, table: MoveSpec) -> MoveSpec:
    """Table settings over root settings; a root query is not for tables that name themselves."""
    if table.stream_name and not table.sql:
        root = replace(root, sql="")
    return merge(root, table)


def with_environment(spec: MoveSpec, env: Mapping[str, str] | None = None) -> MoveSpec:
    return replace(spec, params=overlay_params(spec.params, os.environ if env is None else env, PARAM_PREFIX))


def user_variables(env: Mapping[str, str] | None = None) -> dict[str, str]:
    """Variables for `{{ .NAME }}`, from the environment."""
    env = os.environ if env is None else env
    return {k[len(VARIABLE_PREFIX):]: v for k, v in env.items() if k.startswith(VARIABLE_PREFIX) and len(k) > len(VARIABLE_PREFIX)}


def with_tokens(spec: MoveSpec, env: Mapping[str, str] | None = None, today: date | None = None) -> MoveSpec:
    """Tokens in the stream name, the query and the values of parameters replaced. A parameter is bound after that, as one value
    of its type, so what is put into it never becomes SQL; what is put into the query does."""
    variables = user_variables(env)
    values = token_values("", spec.format, spec.compression, today, variables)
    stream = render_tokens(spec.stream_name, {k: v for k, v in values.items() if k != "stream_name"})
    values["stream_name"] = stream
    params = {k: replace(p, value=render_tokens(p.value, values)) for k, p in spec.params.items()}
    return replace(spec, stream_name=stream, sql=render_tokens(spec.sql, values), params=params)


def make_specs(item: Mapping | str, flags: MoveSpec | Mapping | None = None) -> list[MoveSpec]:
    """Specs of a many-table job: each table over the flags over the root."""
    settings = dict(yaml.safe_load(item) or {}) if isinstance(item, str) else dict(item)
    tables = settings.pop("tables", None) or []
    root = merge(make_spec(settings), make_spec(flags or {}))
    return [merge_table(root, make_spec(t)) for t in tables]


def select_tables(specs: list[MoveSpec], selection: str = "") -> list[MoveSpec]:
    """Specs whose stream name is in a comma-separated list; all of them without one."""
    if not selection:
        return list(specs)
    wanted = {name.strip().lower() for name in selection.split(",")}
    return [s for s in specs if s.stream_name.lower() in wanted]
