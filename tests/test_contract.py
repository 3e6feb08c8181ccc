import os

import pytest

from curato.functions.contract import Contract, Rule
from curato.operators import shape, validate
from curato.sources import sinks
from curato.sources.feeds import IMAGES_SCHEMA, NESTED_TAGS_SCHEMA, read_lines, read_typed

IMAGE_CONTRACT = Contract(rules=(
    Rule("image_id", type="string", required=True, min_length=1),
    Rule("hotel_id", type="integer", required=True, minimum=0),
    Rule("cdn_url", type="string", pattern="^https://"),
    Rule("width", type="integer", minimum=0),
    Rule("height", type="integer", minimum=0),
    Rule("created_at", type="string"),
    Rule("is_active", type="boolean", nullable=True),
    Rule("hash", type="string"),
    Rule("tags", type="array", items=Rule("tag", type="object", additional=False, properties=(
        Rule("tag", type="string", required=True),
        Rule("version", type="string"),
        Rule("probability", type="number", minimum=0, maximum=1),
    ))),
), additional=False)

LINES = {
    "ok": '{"image_id":"i1","hotel_id":7,"cdn_url":"https://c/i1","width":1920,"height":1080,'
          '"created_at":"2023-07-01","is_active":true}',
    "malformed": '{"image_id": "i2", "hotel_id": ',
    "missing_id": '{"hotel_id":7}',
    "id_number": '{"image_id":5,"hotel_id":7}',
    "width_text": '{"image_id":"i3","hotel_id":7,"width":"12"}',
    "width_fraction": '{"image_id":"i4","hotel_id":7,"width":1.5}',
    "width_whole_decimal": '{"image_id":"i5","hotel_id":7,"width":12.0}',
    "active_null": '{"image_id":"i6","hotel_id":7,"is_active":null}',
    "active_absent": '{"image_id":"i7","hotel_id":7}',
    "empty_tags": '{"image_id":"i8","hotel_id":7,"tags":[]}',
    "prob_out": '{"image_id":"i9","hotel_id":7,"tags":[{"tag":"a","probability":1.5}]}',
    "tag_extra": '{"image_id":"i10","hotel_id":7,"tags":[{"tag":"a","x":1}]}',
    "extra_field": '{"image_id":"i11","hotel_id":7,"color":"red"}',
    "tags_not_array": '{"image_id":"i12","hotel_id":7,"tags":"no"}',
    "bad_url": '{"image_id":"i13","hotel_id":7,"cdn_url":"ftp://x"}',
    "not_object": '[1,2]',
    "null_id": '{"image_id":null,"hotel_id":7}',
    "null_line": None,
    "repeated_key": '{"image_id":"i14","hotel_id":7,"hotel_id":8}',
}

EXPECTED = {
    "ok": [], "malformed": ["$:malformed"], "missing_id": ["image_id:required"],
    "id_number": ["image_id:type"], "width_text": ["width:type"], "width_fraction": ["width:type"],
    "width_whole_decimal": [], "active_null": [], "active_absent": [], "empty_tags": [],
    "prob_out": ["tags[].probability:maximum"], "tag_extra": ["tags[]:additional"],
    "extra_field": ["$:additional"], "tags_not_array": ["tags:type"], "bad_url": ["cdn_url:pattern"],
    "not_object": ["$:type"], "null_id": ["image_id:null"],
    "null_line": ["$:malformed"], "repeated_key": ["$:malformed"],
}


def checked_frame(spark):
    rows = [(k, v) for k, v in LINES.items()] + [("blank", "   "), ("tab", "\t\n"), ("empty", "")]
    raw = spark.createDataFrame(rows, "name string, value string")
    return validate.check_contract(raw, IMAGE_CONTRACT)


def test_each_edge_case(spark):
    got = {r.name: list(r.violations) for r in checked_frame(spark).collect()}
    assert not {"blank", "tab", "empty"} & set(got)    # blank lines are skipped, not errors; a null line is one
    assert got == EXPECTED


def test_valid_plus_rejected_is_input(spark):
    checked = checked_frame(spark)
    valid, rejected = validate.split_valid(checked)
    assert valid.count() + rejected.count() == len(LINES)
    assert {r.name for r in valid.collect()} == {k for k, v in EXPECTED.items() if not v}
    summary = {r.rule: r.n for r in validate.violation_summary(checked).collect()}
    assert summary["width:type"] == 2 and summary["$:malformed"] == 3


def test_plan_has_no_python(spark):
    plan = checked_frame(spark)._jdf.queryExecution().executedPlan().toString()
    assert "EvalPython" not in plan and "PythonUDF" not in plan


def test_jsonl_files_round_trip(spark, tmp_dir):
    src = os.path.join(tmp_dir, "feed")
    os.makedirs(src)
    with open(os.path.join(src, "part-a.jsonl"), "w") as f:
        f.write("\n".join(v for v in LINES.values() if v is not None) + "\n\n \t\n")
    with open(os.path.join(src, "ignored.txt"), "w") as f:
        f.write('{"image_id":"zz","hotel_id":1}\n')
    raw = read_lines(spark, src, glob="*.jsonl")
    checked = validate.check_contract(raw, IMAGE_CONTRACT)
    lines = sum(1 for v in LINES.values() if v is not None)
    assert checked.count() == lines
    halves = sinks.write_split(checked, os.path.join(tmp_dir, "split"))
    valid = spark.read.json(halves["valid"]).select("value")
    again = validate.check_contract(valid, IMAGE_CONTRACT)
    assert again.filter("size(violations) > 0").count() == 0
    rejected = spark.read.json(halves["rejected"])
    assert valid.count() + rejected.count() == lines
    assert rejected.filter("reasons is null").count() == 0
    plain = os.path.join(tmp_dir, "plain")
    valid.write.text(plain)
    typed = shape.images(read_typed(spark, plain, IMAGES_SCHEMA))
    assert dict(typed.dtypes)["width"] == "bigint"


def test_nested_feeds_flatten(spark, tmp_dir):
    path = os.path.join(tmp_dir, "tags.jsonl")
    with open(path, "w") as f:
        f.write('{"image_id":"i1","tags":[{"tag":"pool","version":"1","probability":0.91},'
                '{"tag":"lobby","version":"1","probability":0.08}]}\n')
        f.write('{"image_id":"i2","tags":[]}\n')
    flat = shape.flatten_tags(read_typed(spark, path, NESTED_TAGS_SCHEMA)).collect()
    assert sorted((r.image_id, r.tag) for r in flat) == [("i1", "lobby"), ("i1", "pool")]


def test_key_value_writer_omits_nulls(spark, tmp_dir):
    picks = spark.createDataFrame([(1, "a", "u"), (2, None, None)], "hotel_id long, image_id string, cdn_url string")
    out = os.path.join(tmp_dir, "kv")
    sinks.write_key_value(picks, out)
    text = sorted(r.value for r in spark.read.text(out).collect())
    assert text == ['{"key":{"hotel_id":1},"value":{"image_id":"a","cdn_url":"u"}}',
                    '{"key":{"hotel_id":2},"value":{}}']
    back = shape.flatten_picks(read_typed(spark, out, sinks.key_value(picks).schema))
    assert sorted([tuple(r) for r in back.collect()], key=str) == sorted([(1, "a", "u"), (2, None, None)], key=str)


def test_enum_compares_json_values(spark):
    contract = Contract(rules=(
        Rule("b", enum=(True,)), Rule("n", enum=(1.0, 2)), Rule("t", enum=("1",)),
        Rule("z", enum=("a", None))), additional=False)
    lines = {'{"b":true}': [], '{"b":1}': ["b:enum"], '{"b":"true"}': ["b:enum"], '{"n":1}': [], '{"n":2.0}': [],
             '{"n":"1"}': ["n:enum"], '{"n":true}': ["n:enum"], '{"t":"1"}': [], '{"t":1}': ["t:enum"],
             '{"z":null}': [], '{"z":"a"}': [], '{"z":"b"}': ["z:enum"], '{"n":null}': ["n:null"], '{"n":[1]}': ["n:enum"]}
    raw = spark.createDataFrame([(k,) for k in lines], "value string")
    assert {r.value: list(r.violations) for r in validate.check_contract(raw, contract).collect()} == lines


def test_contract_from_a_json_schema(spark):
    schema = {"type": "object", "required": ["id", "free"], "title": "t", "properties": {
        "id": {"type": "integer", "minimum": 1}, "kind": {"const": "x"}, "when": {"type": ["string", "null"]},
        "at": {"type": "object", "properties": {"k": {"type": "integer"}}, "required": ["k"]}}}
    lines = {'{"id":1,"free":null}': [], '{"id":0,"free":1}': ["id:minimum"], '{"id":2}': ["free:required"],
             '{"id":2,"free":1,"kind":"y"}': ["kind:enum"], '{"id":2,"free":1,"when":null,"more":1}': [],
             '{"id":2,"free":1,"when":3}': ["when:type"], '{"id":2,"free":1,"at":{}}': ["at.k:required"]}
    raw = spark.createDataFrame([(k,) for k in lines], "value string")
    got = validate.check_contract(raw, Contract.from_json_schema(schema))
    assert {r.value: list(r.violations) for r in got.collect()} == lines


@pytest.mark.parametrize("schema", [
    {"type": "array"}, {"properties": {"a": {"oneOf": []}}}, {"properties": {"a": {"type": "date"}}},
    {"properties": {"a": {"unevaluatedItems": False}}}, {"$ref": "#/x"}, {"$ref": "other.json"},
    {"properties": {"a": {"minimum": 1, "exclusiveMinimum": True}}}, {"properties": {"a": {"enum": [[1]]}}},
    {"properties": {"a": {"anyOf": [{"type": "null"}, {"$ref": "#"}]}}}, {"properties": {"a": 3}},
    {"required": ["a"], "additionalProperties": False}])
def test_what_a_contract_cannot_check_raises(schema):
    with pytest.raises(ValueError):
        Contract.from_json_schema(schema)
