"""Chat formatting: link tool calls with their results, order them, validate arguments, and write canonical JSON."""

from __future__ import annotations

import json
import math
import re
import sys
from collections import defaultdict
from collections.abc import Iterator
from decimal import Decimal, InvalidOperation

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ferry.llm.common import pieces, stored

#: The keywords of the JSON schema language that say nothing about a value.
NOTES = frozenset(
    "$schema $id $comment $defs definitions title description default examples deprecated readOnly writeOnly format".split()
)
#: Keywords that hold schemas: one, a list of them, or some by name.
ONE, MANY, NAMED = ("not", "if", "then", "else", "items", "contains", "additionalProperties", "propertyNames"), ("allOf", "anyOf", "oneOf", "prefixItems"), (
    "properties", "patternProperties", "$defs", "definitions")
#: Those of them that look at the same value, not at one inside it.
SAME = ("not", "if", "then", "else", "allOf", "anyOf", "oneOf")
_SURROGATE = re.compile("[\ud800-\udfff]")


class Number:
    """A number by its exact value: `digits` times ten to the `power`; digits do not end in a zero, and zero is (0, 0)."""

    def __init__(self, text: str | int | float):
        sign, digits, power = Decimal(str(text)).as_tuple()
        body = "".join(map(str, digits)).lstrip("0")
        kept = body.rstrip("0")
        self.minus, self.digits, self.power = bool(sign) and kept != "", kept or "0", power + len(body) - len(kept) if kept else 0

    def key(self) -> tuple:
        return self.minus, self.digits, self.power

    def whole(self) -> bool:
        return self.power >= 0

    def __lt__(self, other: Number) -> bool:
        if self.minus != other.minus:
            return self.minus
        zeros = [n.digits == "0" for n in (self, other)]
        if any(zeros):
            return (zeros[0] and not zeros[1]) != self.minus and self.key() != other.key()
        (a, x), (b, y) = ((len(n.digits) + n.power, n.digits) for n in (self, other))
        return self.key() != other.key() and ((a, x) < (b, y)) != self.minus

    def multiple_of(self, other: Number) -> bool:
        """Without writing powers of ten out, which may be as large as one likes."""
        with_digits(max(len(self.digits), len(other.digits)))
        a, b, far = int(self.digits), int(other.digits), self.power - other.power
        if far >= 0:
            return a * pow(10, far, b) % b == 0
        return a == 0 or -far < len(self.digits) + 1 and a % (b * 10**-far) == 0

    def text(self) -> str:
        """Digits and a point from 1e-6 up to 1e21, else with an exponent."""
        sign, n, point = "-" if self.minus else "", self.digits, len(self.digits) + self.power
        if self.digits == "0":
            return "0"
        if -6 < point <= 21:
            body = n + "0" * self.power if self.power >= 0 else n[:point] + "." + n[point:] if point > 0 else "0." + "0" * -point + n
        else:
            body = n[0] + ("." + n[1:] if len(n) > 1 else "") + f"e{point - 1:+d}"
        return sign + body


def with_digits(n: int) -> None:
    """Let whole numbers of so many digits be read: Python refuses very long ones unless told."""
    if 0 < sys.get_int_max_str_digits() < n:
        sys.set_int_max_str_digits(n)


_TYPES = {
    "object": lambda v: isinstance(v, dict), "array": lambda v: isinstance(v, list), "string": lambda v: isinstance(v, str),
    "boolean": lambda v: isinstance(v, bool), "null": lambda v: v is None, "number": lambda v: isinstance(v, Number),
    "integer": lambda v: isinstance(v, Number) and v.whole(),
}


def exact(value):
    """A value with its numbers as Numbers: what is parsed and what schemas hold are then alike."""
    if isinstance(value, bool) or value is None or isinstance(value, (str, Number)):
        return value
    if isinstance(value, (int, float)):
        return Number(value)
    return [exact(v) for v in value] if isinstance(value, list) else {k: exact(v) for k, v in value.items()}


def check_schema(schema, root=None, at: str = "#", within: tuple = (), done: set | None = None) -> None:
    """An error for a schema with keywords that are not known here, references that lead nowhere, or ones that come back to
    a schema without looking at anything inside the value. within: the references followed for one value."""
    root, done = schema if root is None else root, set() if done is None else done
    if isinstance(schema, bool):
        return
    if not isinstance(schema, dict):
        raise ValueError(f"{at}: not a schema")
    unknown = set(schema) - set(_CHECKS) - NOTES - {*ONE, *MANY, *NAMED, "$ref"}
    if unknown:
        raise ValueError(f"{at}: keywords not known: {', '.join(sorted(unknown))}")
    kinds = schema.get("type", [])
    if set([kinds] if isinstance(kinds, str) else kinds) - set(_TYPES):
        raise ValueError(f"{at}: types not known: {kinds}")
    for pattern in (schema.get("pattern", ""), *schema.get("patternProperties", ())):
        re.compile(pattern)
    if "multipleOf" in schema and not Number(0) < Number(schema["multipleOf"]):
        raise ValueError(f"{at}: multipleOf must be more than zero")
    ref = schema.get("$ref")
    if ref in within:
        raise ValueError(f"{at}: the reference {ref} leads back to itself")
    if ref is not None and ref not in done:
        done.add(ref)
        check_schema(referred(root, ref), root, ref, (*within, ref), done)
    for key in schema:
        parts: list = [("", schema[key])] if key in ONE else []
        if key in MANY or key in NAMED:
            parts = [(f"/{k}", part) for k, part in (schema[key].items() if isinstance(schema[key], dict) else enumerate(schema[key]))]
        for k, part in parts:
            check_schema(part, root, f"{at}/{key}{k}", within if key in SAME else (), done)


def referred(root, ref: str):
    """The schema that `#/a/b` names inside the root."""
    found = root
    for part in [] if ref in ("#", "") else ref.removeprefix("#/").split("/"):
        part = part.replace("~1", "/").replace("~0", "~")
        try:
            found = found[int(part)] if isinstance(found, list) else found[part]
        except (KeyError, ValueError, IndexError, TypeError):
            raise ValueError(f"the reference {ref!r} names no schema inside this one") from None
    return found


def same(a, b) -> bool:
    """Equal as JSON values: numbers by value, and never equal to booleans."""
    return canonical(a) == canonical(b)


def _bounds(least: str, most: str, kind: type):
    def check(value, schema: dict) -> str | None:
        if isinstance(value, kind) and not schema.get(least, 0) <= len(value) <= schema.get(most, math.inf):
            return f"length {len(value)} is out of bounds"
        return None

    return check


def _range(value, schema: dict) -> str | None:
    if not isinstance(value, Number):
        return None
    limits = {k: exact(schema[k]) for k in ("minimum", "maximum", "exclusiveMinimum", "exclusiveMaximum") if k in schema}
    out = "minimum" in limits and value < limits["minimum"] or "maximum" in limits and limits["maximum"] < value
    out = out or "exclusiveMinimum" in limits and not limits["exclusiveMinimum"] < value
    return "out of bounds" if out or "exclusiveMaximum" in limits and not value < limits["exclusiveMaximum"] else None


def _enum(value, schema: dict) -> str | None:
    wrong = "enum" in schema and not any(same(value, exact(v)) for v in schema["enum"]) or "const" in schema and not same(value, exact(schema["const"]))
    return "not one of the allowed values" if wrong else None


def _pattern(value, schema: dict) -> str | None:
    return "does not match the pattern" if isinstance(value, str) and "pattern" in schema and not re.search(schema["pattern"], value) else None


def _multiple(value, schema: dict) -> str | None:
    return "not a multiple" if isinstance(value, Number) and "multipleOf" in schema and not value.multiple_of(exact(schema["multipleOf"])) else None


def _unique(value, schema: dict) -> str | None:
    return "items repeat" if isinstance(value, list) and schema.get("uniqueItems") and len({canonical(v) for v in value}) < len(value) else None


#: By keyword what is checked of a value itself; one function is run once.
_CHECKS: dict = {
    "enum": _enum, "const": _enum, "minItems": _bounds("minItems", "maxItems", list), "minLength": _bounds("minLength", "maxLength", str),
    "minProperties": _bounds("minProperties", "maxProperties", dict), "minimum": _range, "pattern": _pattern, "multipleOf": _multiple, "uniqueItems": _unique,
}
for _key, _like in {"maxItems": "minItems", "maxLength": "minLength", "maxProperties": "minProperties", "maximum": "minimum", "exclusiveMinimum": "minimum", "exclusiveMaximum": "minimum"}.items():
    _CHECKS[_key] = _CHECKS[_like]
_CHECKS |= dict.fromkeys(("type", "required", "dependentRequired", "minContains", "maxContains"))


def faults(value, schema, at: str = "$", root=None) -> list[str]:
    """Where a value (see `exact`) departs from a JSON schema. All keywords that say something about values are known but
    `unevaluated...`, `dependentSchemas` and dynamic references, which `check_schema` refuses; `format` is a note. Patterns
    are Python's."""
    root = schema if root is None else root
    if isinstance(schema, bool):
        return [] if schema else [f"{at}: not allowed"]
    kinds = schema.get("type")
    kinds = [kinds] if isinstance(kinds, str) else kinds
    if kinds and not any(_TYPES[k](value) for k in kinds):
        return [f"{at}: not of type {'|'.join(kinds)}"]
    found = faults(value, referred(root, schema["$ref"]), at, root) if "$ref" in schema else []
    for check in dict.fromkeys(_CHECKS[k] for k in _CHECKS if k in schema and _CHECKS[k]):
        problem = check(value, schema)
        found += [f"{at}: {problem}"] if problem else []
    if isinstance(value, dict):
        found += _in_object(value, schema, at, root)
    if isinstance(value, list):
        found += _in_array(value, schema, at, root)
    for part in schema.get("allOf", ()):
        found += faults(value, part, at, root)
    if "anyOf" in schema and all(faults(value, part, at, root) for part in schema["anyOf"]):
        found.append(f"{at}: none of the alternatives")
    if "oneOf" in schema and (n := sum(not faults(value, part, at, root) for part in schema["oneOf"])) != 1:
        found.append(f"{at}: {n} of the alternatives, not one")
    if "not" in schema and not faults(value, schema["not"], at, root):
        found.append(f"{at}: is what it must not be")
    if "if" in schema:
        found += faults(value, schema.get("else" if faults(value, schema["if"], at, root) else "then", True), at, root)
    return found


def _in_object(value: dict, schema: dict, at: str, root) -> list[str]:
    known, patterns = schema.get("properties", {}), schema.get("patternProperties", {})
    found = [f"{at}.{k}: missing" for k in schema.get("required", ()) if k not in value]
    found += [f"{at}.{k}: missing" for one, others in schema.get("dependentRequired", {}).items() if one in value for k in others if k not in value]
    for k in sorted(value):
        by = [known[k]] if k in known else []
        by += [part for pattern, part in patterns.items() if re.search(pattern, k)]
        for part in by:
            found += faults(value[k], part, f"{at}.{k}", root)
        if not by and schema.get("additionalProperties") is False:
            found.append(f"{at}.{k}: not known")
        elif not by and "additionalProperties" in schema:
            found += faults(value[k], schema["additionalProperties"], f"{at}.{k}", root)
        if "propertyNames" in schema and faults(k, schema["propertyNames"], at, root):
            found.append(f"{at}.{k}: not a name that is allowed")
    return found


def _in_array(value: list, schema: dict, at: str, root) -> list[str]:
    first, found = schema.get("prefixItems", ()), []
    for i, v in enumerate(value):
        if i < len(first):
            found += faults(v, first[i], f"{at}[{i}]", root)
        elif "items" in schema:
            found += faults(v, schema["items"], f"{at}[{i}]", root)
    if "contains" in schema:
        n = sum(not faults(v, schema["contains"], at, root) for v in value)
        if not schema.get("minContains", 1) <= n <= schema.get("maxContains", math.inf):
            found.append(f"{at}: {n} items are of the kind it must contain")
    return found


def _constant(text: str):
    raise ValueError(f"not JSON: {text}")


def escaped(text: str) -> str:
    """A text that UTF-8 can hold: half a pair of surrogates, which JSON may have, is written as its escape."""
    return _SURROGATE.sub(lambda m: f"\\u{ord(m[0]):04x}", text)


def canonical(value) -> str:
    """Keys in code point order, no blanks, characters as themselves, numbers by their value: `1e22` and
    `10000000000000000000000` are the same text, and so are `2.0` and `2`."""
    if isinstance(value, dict):
        return "{" + ",".join(f"{canonical(k)}:{canonical(value[k])}" for k in sorted(value)) + "}"
    if isinstance(value, list):
        return "[" + ",".join(map(canonical, value)) + "]"
    if isinstance(value, (int, float)) and not isinstance(value, bool):
        return Number(value).text()
    return value.text() if isinstance(value, Number) else escaped(json.dumps(value, ensure_ascii=False))


def checked(name: str | None, arguments: str | None, schemas: dict[str, dict]) -> tuple[str, list[str]]:
    """The arguments as canonical JSON ("null" if they are no JSON, or nested deeper than Python follows), and their
    faults."""
    try:
        value = json.loads(arguments or "", parse_float=Number, parse_int=Number, parse_constant=_constant)
        text = canonical(value)
        if name not in schemas:
            return text, [f"$: no tool is called {canonical(name)}"]
        return text, [escaped(f) for f in faults(value, schemas[name])]
    except (ValueError, InvalidOperation):
        return "null", ["$: not JSON"]
    except RecursionError:
        return "null", ["$: nested too deep"]


#: Depth of what is in a cycle or behind one, and calls with names of others that one task orders at most.
ENDLESS, TOGETHER = 1 << 40, 50_000


def _ordered(schema: pa.Schema):
    """The calls of one conversation, one after another as those before them are done; what is never done is in a cycle."""
    def run(table: pa.Table) -> pa.Table:
        names, after = table.column("call_id").to_pylist(), table.column("after").to_pylist()
        depth, waits, behind = dict.fromkeys(names, 0), {}, defaultdict(list)
        for name, before in zip(names, after):
            before = {b for b in before or () if b in depth}
            waits[name] = len(before)
            for b in before:
                behind[b].append(name)
        ready = [name for name, n in waits.items() if not n]
        for name in ready:  # grows on the way
            for b in behind[name]:
                depth[b] = max(depth[b], depth[name] + 1)
                waits[b] -= 1
                if not waits[b]:
                    ready.append(b)
        found = [depth[name] if not waits[name] else None for name in names]
        return pa.table([table.column("conv_id"), table.column("call_id"), pa.array(found, pa.int64())], schema=schema)

    return run


def depths(calls: DataFrame, together: int = TOGETHER) -> DataFrame:
    """`conv_id, call_id, depth`: the longest chain of calls that must come before each one, for `after` with the names of
    those right before it (an array, or one name); null for calls in a cycle or behind one. Names of no call count as none.

    A conversation of no more than `together` calls and names of calls is ordered by one task. A larger one is worked on by
    all of them, by `_depths_in_rounds`, with the same result.
    """
    if isinstance(calls.schema["after"].dataType, T.StringType):
        calls = calls.withColumn("after", F.array("after"))
    sizes = calls.groupBy("conv_id").agg(F.sum(1 + F.greatest(F.size("after"), F.lit(0))).alias("size"))
    rows = stored(calls.join(sizes, "conv_id").select("conv_id", "call_id", "after", (F.col("size") <= together).alias("small")))
    schema = f"conv_id {dict(rows.dtypes)['conv_id']}, call_id string, depth long"
    arrow = to_arrow_schema(T.StructType.fromDDL(schema))
    small = rows.filter("small").groupBy("conv_id").applyInArrow(_ordered(arrow), schema)
    return small.unionByName(_depths_in_rounds(rows.filter("NOT small").drop("small")))


def _depths_in_rounds(calls: DataFrame) -> DataFrame:
    """The depths of calls of conversations that may be of any size.

    A call waits for others by edges with lengths, and has a depth of at least something. In each round an edge to a call
    that waits for none becomes such a least depth, and one to a call that waits for one other leads on to that: chains
    shrink to half in a round, and a conversation that holds a third of all calls is worked on by all tasks, as rows
    are keyed by call. An edge longer than its conversation has calls is a cycle's; so is all that is left when nothing
    changes. Rounds grow with the logarithm of chains, and with the number of joins in a row that wait for several.
    """
    key = ["conv_id", "call_id"]
    there = calls.select("conv_id", F.col("call_id").alias("to"))
    sizes = calls.groupBy("conv_id").agg(F.count("*").alias("most"))
    wanted = calls.select(*key, F.explode(F.array_distinct("after")).alias("to")).join(there, ["conv_id", "to"])
    edges = stored(wanted.join(sizes, "conv_id").select(*key, "to", F.lit(1).cast("long").alias("far"), "most"))
    state = stored(calls.select(*key, F.lit(0).cast("long").alias("depth")))
    while not edges.isEmpty():
        waits = edges.groupBy(*key).agg(F.count("*").alias("n"), F.min(F.struct("to", "far")).alias("one"))
        of = state.join(waits, key, "left").select(
            "conv_id", F.col("call_id").alias("to"), F.col("depth").alias("its"), F.coalesce("n", F.lit(0)).alias("n"), "one"
        )
        seen = stored(edges.join(of, ["conv_id", "to"]))
        through = F.col("n") <= 1
        lasting = (F.col("to") == F.col("call_id")) | (F.col("far") >= F.col("most"))
        gained = seen.filter(through | lasting).select(
            *key, F.when(lasting, F.lit(ENDLESS)).otherwise(F.least(F.col("its") + F.col("far"), F.lit(ENDLESS))).alias("depth")
        )
        if gained.isEmpty():  # all that still waits does so in cycles, or behind them
            gained, rest = edges.select(*key, F.lit(ENDLESS).alias("depth")), None
        else:
            on = F.when(F.col("n") == 1, F.struct(F.col("one.to").alias("to"), (F.col("far") + F.col("one.far")).alias("far"))).otherwise(F.struct("to", "far"))
            rest = seen.filter("n > 0").select(*key, on.alias("on"), "most").groupBy(*key, "on.to", "most").agg(F.max("on.far").alias("far"))
        state = stored(state.unionByName(gained).groupBy(*key).agg(F.max("depth").alias("depth")))
        if rest is None:
            break
        # what is known to be in a cycle waits no more
        edges = stored(rest.join(state.filter(F.col("depth") >= ENDLESS).select(*key), key, "left_anti").select(*key, "to", "far", "most"))
    return state.select(*key, F.when(F.col("depth") < ENDLESS, F.col("depth")).alias("depth"))


def link(calls: DataFrame, results: DataFrame, schemas: dict[str, dict]) -> DataFrame:
    """Link calls with results and write each as one canonical JSON object.

    calls: `conv_id, call_id, after, position, name, arguments` (JSON text); `after` names the calls of the same
    conversation that must come first: an array, or one.
    results: `conv_id, call_id, position, content`.

    Returns a row for each distinct (conv_id, call_id), sorted so that a conversation's calls follow those they come
    after: `conv_id, call_id, position, depth, n_calls, n_results, valid, faults, message`. Of calls that repeat an
    identifier the first by position (then name, arguments) counts, of results likewise; their numbers are reported.
    Results whose call is not there are left out (see `orphans`). A call is valid if its arguments fit its tool's
    schema, it is not in or behind a cycle, and no other has its identifier. Rows without conversation or call
    identifier cannot be linked and are left out. Null arguments are no JSON. A schema with keywords that are not known is
    an error (see `check_schema`).
    """
    for name in schemas:
        check_schema(schemas[name])
    key = ["conv_id", "call_id"]
    one = calls.filter(F.col("conv_id").isNotNull() & F.col("call_id").isNotNull()).groupBy(*key).agg(
        F.min(F.struct("position", "name", "arguments", "after")).alias("call"), F.count("*").alias("n_calls"))
    one = stored(one.select(*key, "call.*", "n_calls"))
    answers = results.groupBy(*key).agg(
        F.min(F.struct("position", "content")).alias("answer"), F.count("*").alias("n_results")
    )
    joined = one.join(depths(one), key).join(answers.hint("shuffle_hash"), key, "left")
    rows = joined.select(
        *key, "position", "depth", "n_calls", F.coalesce("n_results", F.lit(0)).alias("n_results"), "name", "arguments",
        F.col("answer.content").alias("content"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch):
                valid, problems, messages = [], [], []
                for call_id, depth, n_calls, name, arguments, content in zip(
                    *(part.column(c).to_pylist() for c in ("call_id", "depth", "n_calls", "name", "arguments", "content"))
                ):
                    text, found = checked(name, arguments, schemas)
                    found += ["in or behind a cycle"] * (depth is None) + ["repeated identifier"] * (n_calls > 1)
                    valid.append(not found)
                    problems.append("; ".join(found))
                    messages.append(
                        f'{{"arguments":{text},"id":{canonical(call_id)},"name":{canonical(name)},"result":{canonical(content)}}}'
                    )
                yield pa.RecordBatch.from_arrays(
                    [
                        *(part.column(c) for c in ("conv_id", "call_id", "position", "depth", "n_calls", "n_results")),
                        pa.array(valid, pa.bool_()), pa.array(problems, pa.string()), pa.array(messages, pa.string()),
                    ],
                    ["conv_id", "call_id", "position", "depth", "n_calls", "n_results", "valid", "faults", "message"])

    schema = (
        f"conv_id {dict(rows.dtypes)['conv_id']}, call_id string, position long, depth long, n_calls long, "
        "n_results long, valid boolean, faults string, message string"
    )
    ordered = ["conv_id", F.col("depth").asc_nulls_last(), "position", "call_id"]
    return rows.repartitionByRange(*ordered).sortWithinPartitions(*ordered).mapInArrow(run, schema)


def orphans(calls: DataFrame, results: DataFrame) -> DataFrame:
    """Results whose call is not there."""
    return results.join(calls.select("conv_id", "call_id"), ["conv_id", "call_id"], "left_anti")


#: The tools of the conversations: a turn that is not the assistant's asks for a reply.
SCHEMAS = {
    role: {
        "type": "object", "required": ["text", "turn"], "additionalProperties": False,
        "properties": {
            "text": {"type": "string", "minLength": 1, "maxLength": 1000, "pattern": "[aeiou][.]$"},
            "turn": {"type": "integer", "minimum": 0, "exclusiveMaximum": 6},
        },
    } for role in ("user", "system")
}


def as_calls(messages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations as calls and results. A turn that is not the assistant's calls the tool of its role, after the calls
    two and four turns before it; the assistant's turn is the result of the call one turn before it."""
    def named(back: int):
        return F.concat_ws(":", F.col("conv_id").cast("string"), (F.col("turn") - back).cast("string"))

    asks = messages.filter(~F.col("role").eqNullSafe("assistant"))
    calls = asks.select(
        "conv_id", F.when(F.col("turn").isNotNull(), named(0)).alias("call_id"), F.array(named(2), named(4)).alias("after"), F.col("turn").cast("long").alias("position"),
        F.col("role").alias("name"), F.to_json(F.struct(F.coalesce("text", F.lit("")).alias("text"), "turn")).alias("arguments"))
    results = messages.filter("role = 'assistant'").select(
        "conv_id", F.when(F.col("turn").isNotNull(), named(1)).alias("call_id"),
        F.col("turn").cast("long").alias("position"), F.col("text").alias("content"),
    )
    return calls, results


def linked_conversations(messages: DataFrame) -> DataFrame:
    """The conversations' turns as calls and results, linked: a row for each turn that is not the assistant's. Null texts are
    empty ones, which no schema here takes; rows without conv_id or turn are left out; of rows that repeat a turn the least
    by role and text counts, and `n_calls` tells. Other columns are not read."""
    return link(*as_calls(messages), SCHEMAS)


SQL = """
WITH asks AS (SELECT *, coalesce(turn - lag(turn) OVER w > 4, false) AS apart FROM conversations WHERE role <> 'assistant'
              WINDOW w AS (PARTITION BY conv_id, turn % 2 ORDER BY turn)),
     calls AS (SELECT conv_id, turn, role, text, count(*) FILTER (apart) OVER (PARTITION BY conv_id, turn % 2 ORDER BY turn) AS chain,
                   concat_ws('; ', CASE WHEN length(text) NOT BETWEEN 1 AND 1000 THEN '$.text: length ' || length(text) || ' is out of bounds' END,
                       CASE WHEN NOT regexp_matches(text, '[aeiou][.]\n?$') THEN '$.text: does not match the pattern' END,
                       CASE WHEN turn < 0 OR turn >= 6 THEN '$.turn: out of bounds' END) AS faults FROM asks),
     results AS (SELECT conv_id, turn, text FROM conversations WHERE role = 'assistant')
SELECT c.conv_id, c.conv_id || ':' || c.turn AS call_id, c.turn AS position,
       row_number() OVER (PARTITION BY c.conv_id, c.turn % 2, c.chain ORDER BY c.turn) - 1 AS depth, 1 AS n_calls,
       CASE WHEN r.turn IS NULL THEN 0 ELSE 1 END AS n_results, faults = '' AS valid, faults,
       '{"arguments":{"text":' || CAST(to_json(c.text) AS VARCHAR) || ',"turn":' || c.turn || '},"id":"' || c.conv_id || ':' || c.turn || '","name":"'
           || c.role || '","result":' || coalesce(CAST(to_json(r.text) AS VARCHAR), 'null') || '}' AS message
FROM calls c LEFT JOIN results r ON r.conv_id = c.conv_id AND r.turn = c.turn + 1"""
