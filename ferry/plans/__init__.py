from ferry.plans.move import move, move_many, plan, preview
from ferry.plans.report import MoveError, MoveReport, redact
from ferry.plans.spec import MoveSpec, make_spec, make_specs, merge, select_tables

__all__ = [
    "MoveError", "MoveReport", "MoveSpec", "make_spec", "make_specs", "merge", "move", "move_many", "plan", "preview",
    "redact", "select_tables",
]
