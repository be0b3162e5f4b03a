import json
import math
import random
import re

import pytest

from conftest import DATA
from ferry.llm import queries, toolcalls

CALLS = "conv_id long, call_id string, after string, position long, name string, arguments string"
RESULTS = "conv_id long, call_id string, position long, content string"
SCHEMAS = {"add": {"type": "object", "required": ["x"], "properties": {"x": {"type": "integer", "minimum": 0}, "tags": {"type": "array", "items": {"enum": ["a", "b"]}, "maxItems": 2}}, "additionalProperties": False}}


def linked(spark, calls, results=()):
    rows = toolcalls.link(spark.createDataFrame(list(calls), CALLS), spark.createDataFrame(list(results), RESULTS), SCHEMAS).collect()
    return {(r.conv_id, r.call_id): r for r in rows}, rows


def test_links_order_and_canonical_text(spark):
    calls = [(1, "c", "b", 0, "add", '{"x": 3}'), (1, "b", "a", 5, "add", '{ "tags" : ["b"], "x":2.0 }'), (1, "a", "gone", 9, "add", '{"x":1e0}'), (2, "a", None, 0, "add", '{"x":7}')]
    found, rows = linked(spark, calls, [(1, "b", 8, "später\n\"x\""), (1, "b", 2, "first"), (3, "a", 0, "orphan")])
    assert {k: r.depth for k, r in found.items()} == {(1, "a"): 0, (1, "b"): 1, (1, "c"): 2, (2, "a"): 0}
    assert [r.call_id for r in sorted(rows, key=lambda r: (r.conv_id, r.depth)) if r.conv_id == 1] == ["a", "b", "c"]
    assert found[1, "b"].n_results == 2 and found[1, "b"].message == '{"arguments":{"tags":["b"],"x":2},"id":"b","name":"add","result":"first"}'
    assert found[1, "a"].message.endswith('"result":null}') and all(r.valid for r in rows)
    orphans = toolcalls.orphans(spark.createDataFrame(calls, CALLS), spark.createDataFrame([(3, "a", 0, "orphan"), (1, "b", 1, "x")], RESULTS)).collect()
    assert [r.content for r in orphans] == ["orphan"]


def test_cycles_repeats_nulls_and_faults(spark):
    calls = [(1, "a", "b", 0, "add", '{"x":1}'), (1, "b", "a", 1, "add", '{"x":1}'), (1, "c", "b", 2, "add", '{"x":1}'), (1, "d", "d", 2, "add", '{"x":1}'),
             (2, "e", None, 4, "add", '{"x":5}'), (2, "e", None, 3, "add", '{"x":4}'), (None, "f", None, 0, "add", "{}"), (2, None, None, 0, "add", "{}"),
             (3, "g", None, 0, None, None), (3, "h", None, None, "other", "{}"), (3, "i", None, 0, "add", '{"x":-1,"tags":["a","c","b"],"y":0}'), (3, "j", None, 0, "add", "[NaN"), (3, "k", None, 0, "add", '{"x":"1"}')]
    found, rows = linked(spark, calls)
    assert all(found[1, c].depth is None and not found[1, c].valid for c in "abcd")
    assert found[2, "e"].n_calls == 2 and '"x":4' in found[2, "e"].message and found[2, "e"].faults == "repeated identifier"
    assert len(rows) == 10 and found[3, "g"].faults == "$: not JSON" and found[3, "h"].faults == '$: no tool is called "other"'
    assert found[3, "i"].faults == "$.tags: length 3 is out of bounds; $.tags[1]: not one of the allowed values; $.x: out of bounds; $.y: not known"
    assert found[3, "j"].faults == "$: not JSON" and found[3, "k"].faults == "$.x: not of type integer"
    for r in rows:
        json.loads(r.message)
    assert linked(spark, [])[1] == []


def test_a_conversation_with_very_many_calls(spark):
    calls = [(1, f"c{i}", f"c{i - 1}" if i else None, i, "add", '{"x":1}') for i in range(700)]
    found, _ = linked(spark, calls)
    assert all(found[1, f"c{i}"].depth == i for i in range(700))
    frame = spark.createDataFrame(calls, CALLS)
    rows = toolcalls.depths(frame, 0).collect()  # chains shrink to half in a round
    assert {r.call_id: r.depth for r in rows} == {f"c{i}": i for i in range(700)}


def test_half_pairs_of_surrogates(spark):
    calls = [(1, "a", None, 0, "add", '{"x":1,"\\ud800":"\\udfff\\ud83d\\ude00"}'), (1, "b", None, 0, "add", '"\\ud800"')]
    found, _ = linked(spark, calls, [(1, "a", 1, "fine")])
    assert found[1, "a"].message == '{"arguments":{"x":1,"\\ud800":"\\udfff😀"},"id":"a","name":"add","result":"fine"}'
    assert found[1, "a"].faults == "$.\\ud800: not known" and found[1, "b"].faults == "$: not of type object"


NUMBERS = ["1e22", "10000000000000000000000", "100e20", "2.0", "2", "0.20e1", "-0", "0", "0.0e7", "1e-7", "0.0000001", "123.4500", "-12345e-2", "1e400", "1" + "0" * 5000, "9" * 5000, "1e999999999", "0.1", "1.0000000000000000000001"]


def test_numbers_by_their_value():
    from decimal import Decimal

    texts = {n: toolcalls.canonical(toolcalls.Number(n)) for n in NUMBERS}
    assert texts["1e22"] == texts["10000000000000000000000"] == texts["100e20"] == "1e+22" and texts["2.0"] == texts["2"] == "2"
    assert texts["-0"] == texts["0.0e7"] == "0" and texts["1e-7"] == texts["0.0000001"] == "1e-7" and texts["-12345e-2"] == "-123.45"
    for a in NUMBERS:
        assert toolcalls.Number(texts[a]).key() == toolcalls.Number(a).key()
        for b in NUMBERS:
            x, y = Decimal(a), Decimal(b)
            assert (toolcalls.Number(a) < toolcalls.Number(b)) == (x < y) and (texts[a] == texts[b]) == (x == y)
    for a, b, is_multiple in (("1e400", "7", False), ("21", "7", True), ("0.3", "0.1", True), ("0.35", "0.1", False), ("1e999999999", "0.5", True), ("0", "3", True), ("1e-999999999", "1", False), ("-4", "2", True)):
        assert toolcalls.Number(a).multiple_of(toolcalls.Number(b)) == is_multiple


LINKED = {"$defs": {"node": {"type": "object", "properties": {"next": {"$ref": "#/$defs/node"}, "v": {"type": "integer"}}, "required": ["v"]}}, "$ref": "#/$defs/node"}
CASES = [  # schema, values that fit, values that do not
    ({"enum": [1, "a", None]}, ["1", "1.0", '"a"', "null"], ["true", "2", '"1"', "[1]"]),
    ({"const": True}, ["true"], ["1", '"true"', "false"]),
    ({"const": {"a": [1, 2]}}, ['{"a":[1.0,2e0]}'], ['{"a":[2,1]}', '{"a":[1,2],"b":0}']),
    ({"pattern": "^a$"}, ['"a"', "1"], ['"x"', '""']),
    ({"exclusiveMaximum": 5, "exclusiveMinimum": 1}, ["4.999999999999999999999", "2", '"9"'], ["5", "1", "5.0", "1e2"]),
    ({"minimum": 0.1, "maximum": 1e3}, ["0.1", "1000"], ["0.0999999999999999999999", "1000.0000000000000000001"]),
    ({"multipleOf": 0.01}, ["0.07", "3"], ["0.075"]),
    ({"anyOf": [{"type": "string"}, {"minimum": 4}]}, ['"x"', "4"], ["3"]),
    ({"oneOf": [{"type": "number"}, {"type": "integer"}]}, ["1.5"], ["1", '"x"']),
    ({"allOf": [{"minimum": 1}, {"maximum": 2}]}, ["1"], ["0", "3"]),
    ({"not": {"type": "null"}}, ["0", "false"], ["null"]),
    ({"if": {"minimum": 10}, "then": {"multipleOf": 10}, "else": {"maximum": 5}}, ["20", "3"], ["15", "7"]),
    ({"uniqueItems": True, "minItems": 1}, ["[1,2]", "[1,true]"], ["[1,1.0]", "[]", '[{"a":1,"b":2},{"b":2,"a":1}]']),
    ({"prefixItems": [{"type": "string"}], "items": {"type": "integer"}}, ['["a",1,2]', "[]"], ["[1]", '["a","b"]']),
    ({"contains": {"const": 1}, "maxContains": 2}, ["[1]", "[1,2,1]"], ["[]", "[1,1,1]"]),
    ({"patternProperties": {"^n": {"type": "number"}}, "additionalProperties": {"type": "string"}}, ['{"n1":1,"x":"y"}'], ['{"n1":"1"}', '{"x":1}']),
    ({"propertyNames": {"maxLength": 2}, "maxProperties": 2}, ['{"ab":1}'], ['{"abc":1}', '{"a":1,"b":1,"c":1}']),
    ({"dependentRequired": {"a": ["b"]}}, ['{"a":1,"b":2}', '{"b":1}'], ['{"a":1}']),
    ({"type": ["integer", "null"]}, ["1e2", "null", "10.0"], ["1.5", "true"]),
    (LINKED, ['{"v":1,"next":{"v":2,"next":{"v":3}}}'], ['{"v":1,"next":{"v":2,"next":{}}}', '{"next":{"v":1}}']),
    (True, ["1"], []), (False, [], ["1"]),
]


def test_schema_keywords():
    for schema, good, bad in CASES:
        toolcalls.check_schema(schema)
        for text in good:
            assert toolcalls.checked("t", text, {"t": schema})[1] == [], (schema, text)
        for text in bad:
            assert toolcalls.checked("t", text, {"t": schema})[1], (schema, text)
    assert toolcalls.checked("t", "[" * 100_000, {"t": True})[0] == "null"
    for wrong in ({"minimun": 1}, {"properties": {"a": {"typ": "string"}}}, {"type": "text"}, {"$ref": "#/none"}, {"$ref": "#"}, {"pattern": "("},
                  {"$defs": {"a": {"allOf": [{"$ref": "#/$defs/b"}]}, "b": {"$ref": "#/$defs/a"}}, "$ref": "#/$defs/a"}, {"multipleOf": 0}, {"unevaluatedItems": False}):
        with pytest.raises((ValueError, re.error)):
            toolcalls.check_schema(wrong)


def longest(calls):
    """Depths of one conversation by following all chains; None for cycles and what is behind them."""
    after = {c: [a for a in before or () if a in dict(calls)] for c, before in calls}
    known = {}

    def depth(c, trail):
        if c in trail:
            return math.inf
        if c not in known:
            found = max((depth(a, trail | {c}) + 1 for a in after[c]), default=0)
            if trail and found == math.inf:
                return found  # it may be the trail's own cycle
            known[c] = found
        return known[c]

    return {c: None if (d := depth(c, frozenset())) == math.inf else d for c in after}


def test_several_prerequisites(spark):
    rng, rows, truth = random.Random(4), [], {}
    for conv in range(25):
        n = rng.randrange(1, 14)
        back = rng.random() < 0.4
        calls = [(f"c{i}", rng.choice([None, []]) if rng.random() < 0.2 else [f"c{rng.randrange(n if back else i) if (n if back else i) else 99}" for _ in range(rng.randrange(1, 4))]) for i in range(n)]
        truth |= {(conv, c): d for c, d in longest(calls).items()}
        rows += [(conv, c, after) for c, after in calls]
    chain = [(99, f"c{i}", [f"c{i - 1}", f"c{i - 2}"] if i % 50 == 7 else [f"c{i - 1}"]) for i in range(300)]
    frame = spark.createDataFrame(rows + chain, "conv_id long, call_id string, after array<string>")
    for together in (50_000, 12, 0):  # by one task for each conversation, mixed, and in rounds by all
        found = {(r.conv_id, r.call_id): r.depth for r in toolcalls.depths(frame, together).collect()}
        assert found == truth | {(99, f"c{i}"): i for i in range(300)}


def test_invalid_calls_are_in_the_query(spark):
    rows = queries.op8_tool_calls(spark, DATA).collect()
    assert {r.valid for r in rows} == {True, False} and len({f.split(":")[0] for r in rows for f in r.faults.split("; ") if f}) > 1
