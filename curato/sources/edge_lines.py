"""Lines that meet every rule of a record contract, and what each must give.

``EDGE_SCHEMA`` is a JSON-Schema document as a user would write it.  The lines
are templates: ``@`` stands for the event's id, so lines derived from the event
table differ row by row.  Each comes with the violations it must give, in rule
order; ``None`` as text is a null line, and ``None`` as the answer means that the
line is blank and skipped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curato.sources.tables import table

EDGE_SCHEMA = {
    "$schema": "https://json-schema.org/draft/2020-12/schema", "title": "edge", "type": "object",
    "additionalProperties": False, "required": ["id"],
    "properties": {
        "id": {"type": "integer"},
        "kind": {"enum": ["a", 1, True, None]},
        "size": {"type": "number", "minimum": 0, "maximum": 10},
        "name": {"type": "string", "minLength": 2, "maxLength": 5, "pattern": "^[a-z]+$"},
        "flag": {"type": "boolean"},
        "tags": {"type": "array", "items": {"type": "string", "minLength": 1}},
        "at": {"type": "object", "additionalProperties": False, "required": ["k"],
               "properties": {"k": {"type": ["integer", "null"]}}},
        "mixed": {"type": ["string", "integer"]},
    },
}

EDGE_LINES: tuple[tuple[str | None, str | None], ...] = (
    ('{"id":@,"kind":"a","size":1.5,"name":"abc","flag":true,"tags":["x"],"at":{"k":1},"mixed":"m"}', ""),
    ('{"id":@,"kind":1.0,"size":10,"mixed":3,"at":{"k":null}}', ""),
    ('{"id":@,"kind":null,"tags":[]}', ""),
    ('{"id":@.0,"kind":true}', ""),
    ('{"kind":"a"}', "id:required"),
    ('{"id":"@"}', "id:type"),
    ('{"id":null}', "id:null"),
    ('{"id":@.5}', "id:type"),
    ('{"id":@,"kind":"1"}', "kind:enum"),
    ('{"id":@,"kind":false}', "kind:enum"),
    ('{"id":@,"kind":2}', "kind:enum"),
    ('{"id":@,"size":-1}', "size:minimum"),
    ('{"id":@,"size":11}', "size:maximum"),
    ('{"id":@,"size":"5"}', "size:type"),
    ('{"id":@,"name":"a"}', "name:min_length"),
    ('{"id":@,"name":"abcdef"}', "name:max_length"),
    ('{"id":@,"name":"AB"}', "name:pattern"),
    ('{"id":@,"flag":"true"}', "flag:type"),
    ('{"id":@,"tags":["x",""]}', "tags[]:min_length"),
    ('{"id":@,"tags":["x",2]}', "tags[]:type"),
    ('{"id":@,"tags":"x"}', "tags:type"),
    ('{"id":@,"at":{}}', "at.k:required"),
    ('{"id":@,"at":{"k":1,"z":2}}', "at:additional"),
    ('{"id":@,"extra":1}', "$:additional"),
    ('{"id":@,"mixed":1.5}', "mixed:type"),
    ('{"id":@,"size":null,"name":"a","flag":null}', "size:null;name:min_length;flag:null"),
    ('{"id":@', "$:malformed"),
    ("no json @", "$:malformed"),
    ("[@]", "$:type"),
    (None, "$:malformed"),
    ("   ", None),
    ("\t", None),
)


# Branches: allOf, anyOf, oneOf, not, if/then/else, references, at the record and below it.
COMBINED_SCHEMA = {
    "$defs": {"code": {"type": "string", "pattern": "^[A-Z]{2}$"}, "money": {"type": "number", "exclusiveMinimum": 0}},
    "type": "object", "required": ["id"],
    "properties": {
        "id": {"type": "integer"},
        "price": {"allOf": [{"$ref": "#/$defs/money"}, {"exclusiveMaximum": 100}, {"multipleOf": 0.5}]},
        "place": {"anyOf": [{"$ref": "#/$defs/code"}, {"type": "object", "required": ["lat"],
                                                      "properties": {"lat": {"type": "number", "maximum": 90}}}]},
        "size": {"oneOf": [{"type": "integer", "multipleOf": 3}, {"type": "integer", "multipleOf": 5}]},
        "word": {"type": "string", "not": {"enum": ["no", "never"]}},
        "list": {"type": "array", "items": {"anyOf": [{"type": "null"}, {"$ref": "#/$defs/code"}]}},
    },
    "if": {"properties": {"kind": {"const": "card"}}, "required": ["kind"]},
    "then": {"required": ["number"], "properties": {"number": {"type": "string", "minLength": 4}}},
    "else": {"properties": {"cash": {"type": "boolean"}}},
    "allOf": [{"anyOf": [{"required": ["price"]}, {"required": ["free"]}]}],
    "not": {"required": ["secret"]},
}

COMBINED_LINES: tuple[tuple[str | None, str | None], ...] = (
    ('{"id":@,"price":1.5,"place":"DE","size":9,"word":"yes","list":["AB",null]}', ""),
    ('{"id":@,"free":1,"place":{"lat":90},"size":10,"kind":"card","number":"1234"}', ""),
    ('{"id":@,"free":null,"kind":"cash","cash":true}', ""),
    ('{"id":@,"price":0}', "price:exclusive_minimum"),
    ('{"id":@,"price":100}', "price:exclusive_maximum"),
    ('{"id":@,"price":1.25}', "price:multiple_of"),
    ('{"id":@,"price":"1"}', "price:type"),
    ('{"id":@,"price":-0.25}', "price:exclusive_minimum;price:multiple_of"),
    ('{"id":@,"price":1,"place":"de"}', "place:any_of"),
    ('{"id":@,"price":1,"place":{"lat":91}}', "place:any_of"),
    ('{"id":@,"price":1,"place":{}}', "place:any_of"),
    ('{"id":@,"price":1,"size":15}', "size:one_of"),
    ('{"id":@,"price":1,"size":7}', "size:one_of"),
    ('{"id":@,"price":1,"word":"never"}', "word:not"),
    ('{"id":@,"price":1,"word":5}', "word:type"),
    ('{"id":@,"price":1,"list":["AB","x"]}', "list[]:any_of"),
    ('{"id":@,"price":1,"kind":"card"}', "number:required"),
    ('{"id":@,"price":1,"kind":"card","number":"1"}', "number:min_length"),
    ('{"id":@,"price":1,"kind":"card","cash":1,"number":"12345"}', ""),
    ('{"id":@,"price":1,"cash":1}', "cash:type"),
    ('{"id":@}', "$:any_of"),
    ('{"id":@,"free":0,"secret":null}', "$:not"),
    ('{"id":"@","size":30,"secret":1,"cash":"x"}', "id:type;size:one_of;$:any_of;$:not;cash:type"),
    ("[1]", "$:type"),
    ('{"id":@,', "$:malformed"),
    ("  ", None),
)

# Arrays as wholes, keys by pattern, and rules between fields.
ARRAY_SCHEMA = {
    "type": "object", "required": ["id"],
    "properties": {
        "id": {"type": "integer"},
        "few": {"type": "array", "minItems": 1, "maxItems": 3},
        "set": {"type": "array", "uniqueItems": True},
        "has": {"contains": {"type": "integer", "minimum": 10}},
        "some": {"contains": {"const": "x"}, "minContains": 2, "maxContains": 3},
        "pair": {"prefixItems": [{"type": "string"}, {"type": "integer"}], "items": {"type": "boolean"}},
        "rows": {"type": "array", "items": {"type": "array", "uniqueItems": True, "items": {"type": "number", "minimum": 0}}},
        "open": {"type": "object", "patternProperties": {"^n_": {"type": "number"}, "^t_": {"type": "string"}},
                 "additionalProperties": {"type": "boolean"}},
        "shut": {"type": "object", "properties": {"a": {}}, "patternProperties": {"^x": {}}, "additionalProperties": False},
        "named": {"type": "object", "propertyNames": {"pattern": "^[a-z]+$", "maxLength": 3}, "minProperties": 1, "maxProperties": 2},
        "card": {"type": "string"}, "zip": {"type": "string"}, "city": {"type": "string"},
    },
    "dependentRequired": {"card": ["zip", "city"]},
    "dependentSchemas": {"city": {"properties": {"zip": {"minLength": 5}}}},
}

ARRAY_LINES: tuple[tuple[str | None, str | None], ...] = (
    ('{"id":@,"few":[1],"set":[1,2,"1",true,[1],{"a":1}],"has":[1,1@,10],"some":["x","y","x"],"pair":["a",1,true]}', ""),
    ('{"id":@,"few":[]}', "few:min_items"),
    ('{"id":@,"few":[1,2,3,4]}', "few:max_items"),
    ('{"id":@,"few":"abcd"}', "few:type"),
    ('{"id":@,"set":[1,2,1.0]}', "set:unique_items"),
    ('{"id":@,"set":[{"a":1,"b":[2]},{"b":[2.0],"a":1e0}]}', "set:unique_items"),
    ('{"id":@,"set":["1.0","1"]}', ""),
    ('{"id":@,"has":[1,"20",9.5]}', "has:contains"),
    ('{"id":@,"has":[]}', "has:contains"),
    ('{"id":@,"has":7}', ""),
    ('{"id":@,"some":["x"]}', "some:contains"),
    ('{"id":@,"some":["x","x","x","x"]}', "some:contains"),
    ('{"id":@,"pair":["a"]}', ""),
    ('{"id":@,"pair":[1,"a",true,0]}', "pair[]:type"),
    ('{"id":@,"rows":[[1,2],[],[3,3]]}', "rows[]:unique_items"),
    ('{"id":@,"rows":[[1,-2],[-3],5,["a"]]}', "rows[]:type;rows[][]:type;rows[][]:minimum"),
    ('{"id":@,"open":{"n_a":1,"t_b":"x","c":true}}', ""),
    ('{"id":@,"open":{"n_a":"1","t_b":2,"c":3}}', "open.*:type"),
    ('{"id":@,"shut":{"a":1,"x1":2}}', ""),
    ('{"id":@,"shut":{"a":1,"y":2}}', "shut:additional"),
    ('{"id":@,"named":{}}', "named:min_properties"),
    ('{"id":@,"named":{"a":1,"b":2,"c":3}}', "named:max_properties"),
    ('{"id":@,"named":{"abcd":1}}', "named:property_names"),
    ('{"id":@,"card":"c"}', "$:dependent_required"),
    ('{"id":@,"card":"c","zip":"12345"}', "$:dependent_required"),
    ('{"id":@,"card":"c","zip":"123","city":"x"}', "zip:min_length"),
    ('{"id":@,"zip":"123"}', ""),
    ("\t", None),
)

# A record that contains records of its own kind, directly, in lists and under any key.
TREE_SCHEMA = {
    "$defs": {"leaf": {"type": "object", "required": ["w"], "additionalProperties": False,
                       "properties": {"w": {"type": "integer", "minimum": 0}, "next": {"$ref": "#/$defs/leaf"}}}},
    "type": "object", "required": ["name"], "additionalProperties": False,
    "properties": {
        "name": {"type": "string"},
        "kids": {"type": "array", "maxItems": 3, "items": {"$ref": "#"}},
        "twin": {"$ref": "#"},
        "map": {"type": "object", "additionalProperties": {"$ref": "#"}},
        "chain": {"$ref": "#/$defs/leaf"},
    },
}


def _deep(depth: int, last: str) -> str:
    return '{"name":"n@","kids":[' * depth + last + "]}" * depth


TREE_LINES: tuple[tuple[str | None, str | None], ...] = (
    ('{"name":"n@"}', ""),
    ('{"name":"n@","kids":[{"name":"a"},{"name":"b","kids":[{"name":"c"}]}],"twin":{"name":"t"}}', ""),
    ('{"name":"n@","kids":[{"name":"a"},{"name":1}]}', "kids[].name:type"),
    ('{"name":"n@","kids":[{}]}', "kids[].name:required"),
    ('{"name":"n@","kids":["x",null]}', "kids[]:null;kids[]:type"),
    ('{"name":"n@","twin":{"name":"t","z":1}}', "twin:additional"),
    ('{"name":"n@","twin":{"name":"t","twin":{"twin":{"name":"t"}}}}', "twin.twin.name:required"),
    ('{"name":"n@","map":{"k":{"name":"t"},"l":{"name":null}}}', "map.*.name:null"),
    ('{"name":"n@","kids":[{"name":"a","kids":[{"name":"b"},{"name":"c"},{"name":"d"},{"name":2}]}]}',
     "kids[].kids:max_items;kids[].kids[].name:type"),
    ('{"name":"n@","chain":{"w":1,"next":{"w":2,"next":{"w":3}}}}', ""),
    ('{"name":"n@","chain":{"w":1,"next":{"w":-2,"next":{"v":3}}}}',
     "chain.next.next.w:required;chain.next.next:additional;chain.next.w:minimum"),
    (_deep(8, '{"name":"x"}'), ""),
    (_deep(8, '{"nome":"x"}'), "kids[]." * 7 + "kids[].name:required;" + "kids[]." * 7 + "kids[]:additional"),
    ('{"kids":[{"kids":[{"name":3}]}]}', "kids[].kids[].name:type;kids[].name:required;name:required"),
    ('{"name":"n@","kids":{}}', "kids:type"),
    ("7", "$:type"),
    ('{"name":"n@"', "$:malformed"),
    ("", None),
)


def template_lines(spark: SparkSession, sf_dir: str, lines: tuple[tuple[str | None, str | None], ...]) -> DataFrame:
    """(event_id, value): for each event the line its id's remainder picks."""
    k = F.col("event_id")
    line = None
    for i, (text, _) in enumerate(lines):
        value = F.lit(None).cast("string") if text is None else F.replace(F.lit(text), F.lit("@"), k.cast("string"))
        here = k % len(lines) == i
        line = F.when(here, value) if line is None else line.when(here, value)
    return table(spark, sf_dir, "events").select("event_id", line.alias("value"))


def edge_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return template_lines(spark, sf_dir, EDGE_LINES)
