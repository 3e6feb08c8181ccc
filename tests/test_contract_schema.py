"""Contracts from JSON-Schema documents: branches, arrays, self-references, details."""

import time

import pytest
from pyspark.sql import functions as F

from curato.functions.contract import Contract
from curato.operators import validate
from curato.sources import edge_lines as E


def answers(spark, schema, lines, **kw):
    rows = [(i, None if t is None else t.replace("@", "7")) for i, (t, _) in enumerate(lines)]
    raw = spark.createDataFrame(rows, "n int, value string")
    return validate.check_contract(raw, Contract.from_json_schema(schema), **kw)


@pytest.mark.parametrize("schema, lines", [
    (E.COMBINED_SCHEMA, E.COMBINED_LINES), (E.ARRAY_SCHEMA, E.ARRAY_LINES), (E.TREE_SCHEMA, E.TREE_LINES),
    (E.EDGE_SCHEMA, E.EDGE_LINES)], ids=["combined", "array", "tree", "edge"])
@pytest.mark.parametrize("detail", [False, True])
def test_every_line_gives_its_answer(spark, schema, lines, detail):
    got = {r.n: list(r.violations) for r in answers(spark, schema, lines, detail=detail).collect()}
    want = {i: [x for x in a.split(";") if x] for i, (_, a) in enumerate(lines) if a is not None}
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}


def test_details_say_where_and_why(spark):
    schema = {"type": "object", "additionalProperties": False, "required": ["id"], "properties": {
        "id": {"type": "integer", "minimum": 3},
        "tags": {"type": "array", "items": {"type": "object", "properties": {"p": {"maximum": 1}}}}}}
    lines = [('{"id":1,"tags":[{"p":0},{"p":2},5,{"p":3}],"x":0,"y":1}', "")]
    checked = answers(spark, schema, lines, detail=True)
    got = {tuple(r) for r in validate.violation_report(checked, "n").collect()}
    assert got == {
        (0, "id", "minimum", "at least 3", "1", "id: expected at least 3, found 1"),
        (0, "tags[1].p", "maximum", "at most 1", "2", "tags[1].p: expected at most 1, found 2"),
        (0, "tags[2]", "type", "object", "5", "tags[2]: expected object, found 5"),
        (0, "tags[3].p", "maximum", "at most 1", "3", "tags[3].p: expected at most 1, found 3"),
        (0, "$", "additional", "no undeclared keys", "x, y", "$: expected no undeclared keys, found x, y")}
    assert validate.violation_report(answers(spark, schema, [("{", "")], detail=True), "n").first()["found"] == "{"


def test_a_tree_is_walked_in_the_jvm_and_its_tables_are_named(spark):
    tables = []
    checked = answers(spark, E.TREE_SCHEMA, E.TREE_LINES, tables=tables)
    plan = checked._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and len(tables) >= 9       # one for the records and one a level


def test_faults_below_are_not_broadcast_to_their_lines(spark):
    plan = answers(spark, E.TREE_SCHEMA, E.TREE_LINES)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan      # they are as many as the lines


def test_repeated_keys(spark):
    schema = {"type": "object", "properties": {"a": {"type": "integer"}, "b": {"type": "object", "properties": {"c": {"type": "string"}}}}}
    lines = [('{"a":"x","a":1}', ""), ('{"a":1,"a":"x"}', ""), ('{"b":{"c":1,"c":"y"}}', ""), ('{"a":1', "")]
    strict = {r.n: list(r.violations) for r in answers(spark, schema, lines).collect()}
    last = {r.n: list(r.violations) for r in answers(spark, schema, lines, repeated="last").collect()}
    assert strict == {i: ["$:malformed"] for i in range(4)}
    assert last == {0: [], 1: ["a:type"], 2: [], 3: ["$:malformed"]}
    assert {r.n: list(r.violations) for r in answers(spark, schema, lines).collect()} == strict    # no setting stays


def test_long_arrays_take_linear_time(spark):
    schema = Contract.from_json_schema({"type": "object", "properties": {"a": {
        "type": "array", "uniqueItems": True, "items": {"type": "integer", "minimum": 0}, "contains": {"const": 5}}}})

    def seconds(n):
        raw = spark.range(1).select(F.concat(F.lit('{"a":['), F.array_join(F.sequence(F.lit(0), F.lit(n - 1)), ","), F.lit("]}")).alias("value"))
        began = time.perf_counter()
        assert validate.check_contract(raw, schema).select("violations").first()[0] == []
        return time.perf_counter() - began

    seconds(1000)
    assert seconds(200_000) < 12 * max(0.5, seconds(50_000))


def test_an_enumerated_one_is_not_true(spark):
    schema = {"type": "object", "properties": {"a": {"anyOf": [{"const": 1}, {"const": "x"}]}, "b": {"not": {"const": True}}},
              "oneOf": [{"properties": {"a": {"const": 1}}}, {"properties": {"a": {"const": True}}}]}
    lines = [('{"a":1,"b":1}', ""), ('{"a":true}', ""), ('{"a":"x","b":true}', "")]
    got = {r.n: list(r.violations) for r in answers(spark, schema, lines).collect()}
    assert got == {0: [], 1: ["a:any_of"], 2: ["b:not", "$:one_of"]}


def test_references_and_boolean_schemas(spark):
    schema = {"definitions": {"a/b": {"type": "string"}}, "type": "object",
              "properties": {"x": {"$ref": "#/definitions/a~1b", "minLength": 2}, "y": False, "z": True,
                             "w": {"format": "date", "type": "string"}}}
    lines = [('{"x":"ab","z":[]}', ""), ('{"x":"a"}', ""), ('{"x":1,"y":1}', ""), ('{"w":"not a date"}', "")]
    got = {r.n: sorted(r.violations) for r in answers(spark, schema, lines).collect()}
    assert got == {0: [], 1: ["x:min_length"], 2: ["x:type", "y:never"], 3: []}


@pytest.mark.parametrize("line", ['{"a":1}}', '{"a":1} {"a":2}', '{"a":1},{"a":2}', '{"a":1}]', '{"a":1}] }', '{"a":1} x', "", "{}{", "1 2"])
def test_text_after_the_record_is_malformed(spark, line):
    schema = Contract.from_json_schema({"type": "object"})
    raw = spark.createDataFrame([(line,), (' {"a":1}\t\r',)], "value string")
    got = {r.value: list(r.violations) for r in validate.check_contract(raw, schema).collect()}
    assert got.pop(' {"a":1}\t\r') == [] and (got == {line: ["$:malformed"]} or line == "")
