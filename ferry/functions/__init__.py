from ferry.functions.casts import cast_expr, plain_cast
from ferry.functions.decimals import decimal_bytes, decimal_size, decimal_unscaled, to_numeric, unscaled_bytes
from ferry.functions.jsontext import compact_json, html_safe, json_object, json_value
from ferry.functions.render import csv_field, render_float, render_text, render_timestamp, render_timestamptz
from ferry.functions.uuids import fix_sqlserver_uuid, to_uuid, uuid_bytes
from ferry.functions.wide import number_parts, to_wide_numeric

__all__ = [
    "cast_expr", "compact_json", "csv_field", "decimal_bytes", "decimal_size", "decimal_unscaled", "fix_sqlserver_uuid", "html_safe",
    "json_object", "json_value", "number_parts", "plain_cast", "render_float", "render_text", "render_timestamp", "render_timestamptz",
    "to_numeric", "to_uuid", "to_wide_numeric", "unscaled_bytes", "uuid_bytes",
]
