"""A declarative record contract compiled to Column predicates.

The original job checks each JSON line with a JSON-Schema validator in the
driver.  Here a contract is data (``Contract`` / ``Rule``) and compiles once,
on the driver, into Columns that the executors evaluate over a VARIANT parse of
each line: no Python runs per row.

A rule speaks of one *place*, a value inside the record.  It compiles to parts:
single checks, and lists of violations found by one pass over an array's items
or an object's entries.  The parts of a rule make its set of violations; a
combinator joins the sets of its branches (``all_of``: their union; ``any_of``,
``one_of`` and ``none_of``: from how many are empty; ``if_``: which of two sets
counts).  Fields on fixed paths and the outcome of each branch are columns of their
own, so a value is extracted once however many rules speak of it.

Violation strings are ``<path>:<rule>``, e.g. ``props.k:maximum``; items of an
array share the path ``tags[]``, undeclared keys of an object ``open.*``.  In detail a
violation is a struct (path with positions and keys, rule, expected, found, and the
violation string as its label).

A definition that refers to itself (a tree) is not unfolded: a place that it
governs becomes a link, and ``operators.validate`` follows links level by level.

A line that repeats a key in one object is malformed unless the caller loads it with
``repeated="last"`` (see ``operators.validate``).
"""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass, field, replace

from pyspark.sql import Column
from pyspark.sql import functions as F

from curato.functions import paths

_INTEGRAL = ["TINYINT", "SMALLINT", "INT", "BIGINT"]
_FLOATING = ["FLOAT", "DOUBLE"]

TYPES = ("string", "integer", "number", "boolean", "object", "array", "null")

# JSON-Schema keywords that constrain nothing.  A format is a note too: the
# validator of the original asserts none unless told to.
_NOTES = frozenset(["$schema", "$id", "$comment", "title", "description", "default", "examples", "format",
                    "$defs", "definitions", "deprecated", "readOnly", "writeOnly"])
_KEYWORDS = frozenset([
    "type", "enum", "const", "minimum", "maximum", "exclusiveMinimum", "exclusiveMaximum", "multipleOf",
    "minLength", "maxLength", "pattern", "items", "prefixItems", "additionalItems", "minItems", "maxItems",
    "uniqueItems", "contains", "minContains", "maxContains", "properties", "required", "additionalProperties",
    "patternProperties", "propertyNames", "minProperties", "maxProperties", "dependentRequired",
    "dependentSchemas", "allOf", "anyOf", "oneOf", "not", "if", "then", "else", "$ref"])

DETAIL = "array<struct<path:string,rule:string,expected:string,found:string,label:string>>"
LINKS = "array<struct<definition:string,path:string,label:string,value:variant>>"


@dataclass(frozen=True)
class Rule:
    """What one value must meet.  Every field left at its default checks nothing,
    but that a value may be null only where ``nullable`` says so."""

    name: str = ""
    type: str | tuple[str, ...] | None = None   # several: any of them
    required: bool = False
    nullable: bool = False
    enum: tuple | None = None
    minimum: float | None = None
    maximum: float | None = None
    min_length: int | None = None
    max_length: int | None = None
    pattern: str | None = None
    items: Rule | None = None                   # every item (after prefix_items)
    properties: tuple[Rule, ...] = ()
    additional: bool | Rule = True              # of keys that are not declared
    exclusive_minimum: float | None = None
    exclusive_maximum: float | None = None
    multiple_of: float | None = None
    prefix_items: tuple[Rule, ...] = ()
    min_items: int | None = None
    max_items: int | None = None
    unique_items: bool = False
    contains: Rule | None = None
    min_contains: int = 1
    max_contains: int | None = None
    pattern_properties: tuple[tuple[str, Rule], ...] = ()
    property_names: Rule | None = None
    min_properties: int | None = None
    max_properties: int | None = None
    dependent_required: tuple[tuple[str, tuple[str, ...]], ...] = ()
    dependent_rules: tuple[tuple[str, Rule], ...] = ()
    all_of: tuple[Rule, ...] = ()
    any_of: tuple[Rule, ...] = ()
    one_of: tuple[Rule, ...] = ()
    none_of: Rule | None = None
    if_: Rule | None = None
    then: Rule | None = None
    otherwise: Rule | None = None
    ref: str | None = None                      # a definition that refers to itself
    never: bool = False                         # no value is right


@dataclass(frozen=True)
class Contract:
    rules: tuple[Rule, ...] = ()
    additional: bool | Rule = False
    name: str = "record"
    record: Rule | None = None                  # what the record as a whole must meet, besides
    definitions: tuple[tuple[str, Rule], ...] = ()

    @property
    def root(self) -> Rule:
        return self.record or Rule(self.name, type="object", properties=self.rules, additional=self.additional)

    @classmethod
    def from_json_schema(cls, schema: Mapping, name: str = "record") -> Contract:
        """The contract that a JSON-Schema document states.

        Every keyword that could constrain a record is checked or raises
        ``ValueError`` (references to other documents, ``unevaluated...``,
        enumerated arrays or objects, and a self-reference inside a
        branch, see ``_Reader``), so a contract never checks less than its
        document.  ``name`` labels it."""
        if not isinstance(schema, Mapping):
            raise ValueError("$: a record's schema must be an object")
        if schema.get("type", "object") != "object":
            raise ValueError("a record's schema must be of type object")
        reader = _Reader(schema)
        root = replace(reader.read_root(), name=name)
        return cls(rules=root.properties, additional=root.additional, name=name, record=root,
                   definitions=tuple(reader.recursive.items()))


# -- JSON-Schema documents ---------------------------------------------------------------

class _Reader:
    """Schemas -> rules.  A reference is replaced by what it refers to; one that
    leads back to itself becomes a link to a named definition.  A link's outcome
    is known only when its level has been walked, so links may not stand where a rule
    must be decided at once (any_of, one_of, not, if, contains, names, dependent)."""

    def __init__(self, document: Mapping):
        self.document = document
        self.open: list[str] = []
        self.recursive: dict[str, Rule] = {}
        self.deciding = 0

    def read_root(self) -> Rule:
        return self.referred("#", "$")

    def referred(self, ref: str, path: str) -> Rule:
        if ref in self.open:
            if self.deciding:
                raise ValueError(f"{path}: a self-reference {ref} cannot stand inside a branch that is decided at once")
            self.recursive.setdefault(ref, Rule())
            return Rule(ref=ref, nullable=True)
        self.open.append(ref)
        rule = self.read(self.target(ref, path), path)
        self.open.pop()
        if ref in self.recursive:
            self.recursive[ref] = rule
        return rule

    def target(self, ref: str, path: str):
        if not isinstance(ref, str) or not ref.startswith("#"):
            raise ValueError(f"{path}: only references inside the document are supported: {ref!r}")
        at = self.document
        for step in [s for s in ref[1:].split("/") if s]:
            step = step.replace("~1", "/").replace("~0", "~")
            if isinstance(at, list) and step.isdigit() and int(step) < len(at):
                at = at[int(step)]
            elif isinstance(at, Mapping) and step in at:
                at = at[step]
            else:
                raise ValueError(f"{path}: {ref} refers to nothing")
        return at

    def several(self, schemas, path: str, deciding: bool) -> tuple[Rule, ...]:
        if not isinstance(schemas, (list, tuple)) or not schemas:
            raise ValueError(f"{path}: a list of schemas is expected")
        return tuple(self.read(s, f"{path}/{i}", deciding=deciding) for i, s in enumerate(schemas))

    def read(self, schema, path: str, name: str = "", required: bool = False, deciding: bool = False) -> Rule:
        self.deciding += deciding
        try:
            return replace(self._read(schema, path), name=name, required=required)
        finally:
            self.deciding -= deciding

    def _read(self, schema, path: str) -> Rule:
        if isinstance(schema, bool):
            return Rule(nullable=True) if schema else Rule(nullable=True, never=True)
        if not isinstance(schema, Mapping):
            raise ValueError(f"{path}: not a schema: {schema!r}")
        unknown = sorted(set(schema) - _KEYWORDS - _NOTES)
        if unknown:
            raise ValueError(f"{path}: unsupported keywords {', '.join(unknown)}")
        if "$ref" in schema:
            rule = self.referred(schema["$ref"], path)
            others = {k: v for k, v in schema.items() if k != "$ref" and k not in _NOTES}
            return replace(self._read(others, path), all_of=(rule, *self._read(others, path).all_of)) if others else rule
        stated = schema.get("type")
        types = [stated] if isinstance(stated, str) else list(stated or [])
        for t in types:
            if t not in TYPES:
                raise ValueError(f"{path}: unknown type {t!r}")
        enum = tuple(schema["enum"]) if "enum" in schema else None
        if "const" in schema:
            enum = (schema["const"],) if enum is None else tuple(e for e in enum if _same_value(e, schema["const"]))
        for e in enum or ():
            if not (e is None or isinstance(e, (str, bool, int, float))):
                raise ValueError(f"{path}: only scalar values can be enumerated")
        live = tuple(t for t in types if t != "null")
        one = {new: self.read(schema[old], f"{path}/{old}", deciding=deciding) for old, new, deciding in (
            ("contains", "contains", True), ("propertyNames", "property_names", True), ("not", "none_of", True),
            ("if", "if_", True)) if old in schema}
        if "if" in schema:
            one |= {new: self.read(schema[old], f"{path}/{old}", deciding=True)
                    for old, new in (("then", "then"), ("else", "otherwise")) if old in schema}
        many = {new: self.several(schema[old], f"{path}/{old}", deciding) for old, new, deciding in (
            ("allOf", "all_of", False), ("anyOf", "any_of", True), ("oneOf", "one_of", True)) if old in schema}
        plain = {new: schema[old] for old, new in (
            ("minimum", "minimum"), ("maximum", "maximum"), ("exclusiveMinimum", "exclusive_minimum"),
            ("exclusiveMaximum", "exclusive_maximum"), ("multipleOf", "multiple_of"), ("minLength", "min_length"),
            ("maxLength", "max_length"), ("pattern", "pattern"), ("minItems", "min_items"), ("maxItems", "max_items"),
            ("uniqueItems", "unique_items"), ("minContains", "min_contains"), ("maxContains", "max_contains"),
            ("minProperties", "min_properties"), ("maxProperties", "max_properties")) if old in schema}
        if any(isinstance(plain.get(k), bool) for k in ("exclusive_minimum", "exclusive_maximum")):
            raise ValueError(f"{path}: an exclusive bound must be a number")
        return Rule(type=(live[0] if len(live) == 1 else live) if live else "null" if types else None,
                    nullable=(not types or "null" in types) and (enum is None or None in enum), enum=enum,
                    **plain, **one, **many, **self._items(schema, path), **self._members(schema, path))

    def _items(self, schema: Mapping, path: str) -> dict:
        items, prefix = schema.get("items"), schema.get("prefixItems")
        if isinstance(items, (list, tuple)):     # the older form of prefixItems
            prefix, items = items, schema.get("additionalItems")
        return ({"items": self.read(items, f"{path}[]")} if items is not None else {}) | (
            {"prefix_items": self.several(prefix, path, False)} if prefix else {})

    def _members(self, schema: Mapping, path: str) -> dict:
        fields, must = dict(schema.get("properties", {})), list(schema.get("required", ()))
        extra, patterns = schema.get("additionalProperties", True), dict(schema.get("patternProperties", {}))
        rules = [self.read(sub, f"{path}.{n}", n, n in must) for n, sub in fields.items()]
        rules += [Rule(n, required=True, nullable=True) for n in must if n not in fields]
        if extra is False and not patterns and len(rules) > len(fields):
            raise ValueError(f"{path}: required names that are not properties can never be present")
        for p in patterns:
            if not isinstance(p, str):
                raise ValueError(f"{path}: not a pattern: {p!r}")
        return {
            "properties": tuple(rules), "additional": extra if isinstance(extra, bool) else self.read(extra, f"{path}.*"),
            "pattern_properties": tuple((p, self.read(s, f"{path}./{p}/")) for p, s in patterns.items()),
            "dependent_required": tuple((k, tuple(v)) for k, v in schema.get("dependentRequired", {}).items()),
            "dependent_rules": tuple((k, self.read(s, f"{path}/{k}", deciding=True))
                                     for k, s in schema.get("dependentSchemas", {}).items())}


def _same_value(a, b) -> bool:
    """Equal as JSON values: true is not 1, 1 is 1.0."""
    return isinstance(a, bool) == isinstance(b, bool) and a == b


# -- values ------------------------------------------------------------------------------

def _kind(v: Column) -> Column:
    return F.schema_of_variant(v)


def _is_number(kind: Column) -> Column:
    return kind.isin(*_INTEGRAL) | kind.startswith("DECIMAL") | kind.isin(*_FLOATING)


def _number(v: Column, kind: Column) -> Column:
    return F.when(_is_number(kind), F.try_variant_get(v, "$", "double"))


def _is_integer(v: Column, kind: Column) -> Column:
    as_double = F.try_variant_get(v, "$", "double")
    whole = as_double == F.floor(as_double)
    return kind.isin(*_INTEGRAL) | ((kind.startswith("DECIMAL") | kind.isin(*_FLOATING)) & whole)


def _type_ok(v: Column, kind: Column, t: str | tuple[str, ...]) -> Column:
    if not isinstance(t, str):
        fits = F.lit(False)
        for one in t:
            fits = fits | _type_ok(v, kind, one)
        return fits
    if t == "string":
        return kind == "STRING"
    if t == "integer":
        return _is_integer(v, kind)
    if t == "number":
        return _is_number(kind)
    if t == "boolean":
        return kind == "BOOLEAN"
    if t == "object":
        return kind.startswith("OBJECT")
    if t == "array":
        return kind.startswith("ARRAY")
    if t == "null":
        return kind == "VOID"
    raise ValueError(f"unknown contract type {t!r}")


def _one_of(v: Column, kind: Column, values: tuple) -> Column:
    """The value is one of ``values``, compared as JSON values: text with text,
    numbers with numbers (1 is 1.0), true and false with themselves."""
    numbers = [float(e) for e in values if isinstance(e, (int, float)) and not isinstance(e, bool)]
    found = F.lit(False)
    for is_kind, spark_type, own in (
            (kind == "STRING", "string", [e for e in values if isinstance(e, str)]),
            (kind == "BOOLEAN", "boolean", [e for e in values if isinstance(e, bool)]),
            (_is_number(kind), "double", numbers)):
        if own:
            found = found | (is_kind & F.coalesce(F.try_variant_get(v, "$", spark_type).isin(*own), F.lit(False)))
    return found


def _canonical(v: Column) -> Column:
    """Equal texts for equal JSON values: keys are in order, and a whole number has
    no fraction (outside of strings)."""
    return F.regexp_replace(F.to_json(v), r'("(?:[^"\\]|\\.)*")|(-?\d+)\.0(?![\dE])', "$1$2")


def _entries(v: Column) -> Column:
    """An object's (key, value) pairs; null for any other value."""
    return F.map_entries(F.try_variant_get(v, "$", "map<string,variant>"))


def _matches(*patterns: str):
    """Whether an entry's key matches any of the patterns."""
    def test(e: Column) -> Column:
        hit = F.lit(False)
        for p in patterns:
            hit = hit | e["key"].rlike(p)
        return hit
    return test


def _undeclared(rule: Rule):
    """Whether an entry's key is neither declared nor matched by a pattern."""
    names, matched = [r.name for r in rule.properties], _matches(*[p for p, _ in rule.pattern_properties])
    return lambda e: ~matched(e) & ~e["key"].isin(*names) if names else ~matched(e)


def _keys(v: Column) -> Column:
    return F.map_keys(F.try_variant_get(v, "$", "map<string,variant>"))


def _texts(values) -> Column:
    return F.array(*[F.lit(x) for x in values]) if values else F.array().cast("array<string>")


# -- compiling -----------------------------------------------------------------------------

@dataclass(frozen=True)
class _Place:
    """A value inside the record: how to read it, and what to call it."""

    v: Column
    kind: Column
    label: str                    # without positions, for violation strings
    shown: Column                 # with positions, in detail
    present: Column | None = None
    path: str | None = None       # JSON path of a fixed place; null inside an array or map

    def sub(self, name: str) -> str:
        return f"{self.label}.{name}" if self.label else name


@dataclass(frozen=True)
class _Check:
    cond: Column
    label: str
    shown: Column
    expected: str
    found: Column


@dataclass(frozen=True)
class _Many:
    """Violations found by one pass over items or entries."""

    found: Column
    labels: tuple[str, ...]


@dataclass(frozen=True)
class Compiled:
    """Helper columns to add layer by layer, and what to read from them."""

    layers: list[dict[str, Column]]
    violations: Column
    links: Column | None


@dataclass
class _Compiler:
    detail: bool
    prefix: str = "__c"
    root_path: Column | None = None
    root_label: Column | None = None
    values: dict[str, int] = field(default_factory=dict)
    flags: list[dict[str, Column]] = field(default_factory=list)
    known: dict[tuple[str, str, int], str] = field(default_factory=dict)
    level: int = 0

    # places

    def child(self, place: _Place, name: str) -> _Place:
        is_object = place.kind.startswith("OBJECT")
        shown = F.concat(place.shown, F.lit(f".{name}")) if place.label else F.lit(name)
        if self.root_path is not None:
            shown = F.concat(place.shown, F.lit(f".{name}"))
        if place.path is None:
            v = F.when(is_object, F.try_variant_get(place.v, f"${paths.field(name)}", "variant"))
            return _Place(v, _kind(v), place.sub(name), shown, is_object & v.isNotNull())
        path = place.path + paths.field(name)
        i = self.values.setdefault(path, len(self.values))
        v = F.col(f"{self.prefix}v{i}")
        return _Place(v, F.col(f"{self.prefix}k{i}"), place.sub(name), shown, is_object & v.isNotNull(), path)

    # parts

    def parts(self, rule: Rule, place: _Place) -> list[_Check | _Many]:
        """The violations of a present value."""
        found = self.scalars(rule, place) + self.arrays(rule, place) + self.members(rule, place)
        return found + self.combined(rule, place)

    def check(self, place: _Place, cond: Column, rule: str, expected: str, found: Column | None = None,
              label: str | None = None, shown: Column | None = None) -> _Check:
        here = (place.label or "$") if label is None else label
        at = (place.shown if place.label or self.root_path is not None else F.lit("$")) if shown is None else shown
        return _Check(F.coalesce(cond, F.lit(False)), f"{here}:{rule}", at, expected,
                      F.to_json(place.v) if found is None else found)

    def scalars(self, rule: Rule, place: _Place) -> list[_Check]:
        v, kind, out = place.v, place.kind, []
        is_null = kind == "VOID"

        def add(cond: Column, name: str, expected: str) -> None:
            out.append(self.check(place, cond, name, expected))

        if rule.never:
            add(F.lit(True), "never", "no value")
        if not rule.nullable and rule.type != "null" and None not in (rule.enum or ()):
            add(is_null, "null", "a value that is not null")
        if rule.type:
            add(~is_null & ~_type_ok(v, kind, rule.type), "type", rule.type if isinstance(rule.type, str) else " or ".join(rule.type))
        if rule.enum is not None:
            add(~is_null & ~_one_of(v, kind, rule.enum), "enum", f"one of {json.dumps(list(rule.enum))}")
        num, text = _number(v, kind), F.when(kind == "STRING", F.try_variant_get(v, "$", "string"))
        for bound, fails, name, words in (
                (rule.minimum, lambda b: num < b, "minimum", "at least"),
                (rule.maximum, lambda b: num > b, "maximum", "at most"),
                (rule.exclusive_minimum, lambda b: num <= b, "exclusive_minimum", "more than"),
                (rule.exclusive_maximum, lambda b: num >= b, "exclusive_maximum", "less than"),
                (rule.multiple_of, lambda b: num / b != F.floor(num / b), "multiple_of", "a multiple of")):
            if bound is not None:
                add(fails(F.lit(float(bound))), name, f"{words} {bound}")
        if rule.min_length is not None:
            add(F.char_length(text) < rule.min_length, "min_length", f"at least {rule.min_length} characters")
        if rule.max_length is not None:
            add(F.char_length(text) > rule.max_length, "max_length", f"at most {rule.max_length} characters")
        if rule.pattern is not None:
            add(~text.rlike(rule.pattern), "pattern", f"text that matches {rule.pattern}")
        return out

    def arrays(self, rule: Rule, place: _Place) -> list[_Check | _Many]:
        if not (rule.items or rule.prefix_items or rule.contains or rule.unique_items
                or rule.min_items is not None or rule.max_items is not None):
            return []
        arr = F.try_variant_get(place.v, "$", "array<variant>")
        size, out = F.size(arr), []
        is_array = place.kind.startswith("ARRAY")
        for bound, fails, name, words in ((rule.min_items, lambda b: size < b, "min_items", "at least"),
                                          (rule.max_items, lambda b: size > b, "max_items", "at most")):
            if bound is not None:
                out.append(self.check(place, is_array & fails(bound), name, f"{words} {bound} items", size.cast("string")))
        if rule.unique_items:
            # One pass with a set of canonical texts.
            out.append(self.check(place, is_array & (F.size(F.array_distinct(F.transform(arr, _canonical))) < size),
                                  "unique_items", "no two equal items"))
        if rule.contains is not None:
            n = F.size(F.filter(arr, lambda e: self.inside(rule.contains, self.item(place, e, F.lit(0)))))
            enough = n >= rule.min_contains
            if rule.max_contains is not None:
                enough = enough & (n <= rule.max_contains)
            most = "" if rule.max_contains is None else f" and at most {rule.max_contains}"
            out.append(self.check(place, is_array & ~enough, "contains",
                                  f"at least {rule.min_contains}{most} items of a kind", n.cast("string")))
        for i, sub in enumerate(rule.prefix_items):
            v = F.get(arr, F.lit(i))
            here = replace(self.item(place, v, F.lit(i)), present=v.isNotNull())
            out += self.guarded(sub, here)
        if rule.items is not None:
            skip = len(rule.prefix_items)
            rest = F.slice(arr, skip + 1, F.greatest(size - skip, F.lit(0))) if skip else arr
            probe = self.item(place, F.lit(None).cast("variant"), F.lit(0))
            out += self.each(rest, lambda e, i: self.item(place, e, i + skip), rule.items, probe)
        return out

    def item(self, place: _Place, e: Column, i: Column) -> _Place:
        return _Place(e, _kind(e), f"{place.label or '$'}[]",
                      F.concat(place.shown if place.label or self.root_path is not None else F.lit("$"),
                               F.lit("["), i.cast("string"), F.lit("]")))

    def members(self, rule: Rule, place: _Place) -> list[_Check | _Many]:
        is_object, out = place.kind.startswith("OBJECT"), []
        for r in rule.properties:
            sub = self.child(place, r.name)
            if r.required:
                out.append(self.check(sub, is_object & sub.v.isNull(), "required", "a value", F.lit(None).cast("string")))
            out += self.guarded(r, sub)
        declared = [r.name for r in rule.properties]
        if rule.additional is False and not rule.pattern_properties:
            extra = F.array_except(_keys(place.v), _texts(declared))
            out.append(self.check(place, is_object & (F.size(extra) > 0), "additional", "no undeclared keys", F.array_join(extra, ", ")))
        elif rule.additional is not True or rule.pattern_properties:
            out += self.open_members(rule, place)
        for bound, fails, name, words in (
                (rule.min_properties, lambda n, b: n < b, "min_properties", "at least"),
                (rule.max_properties, lambda n, b: n > b, "max_properties", "at most")):
            if bound is not None:
                n = F.size(_keys(place.v))
                out.append(self.check(place, is_object & fails(n, bound), name, f"{words} {bound} keys", n.cast("string")))
        if rule.property_names is not None:
            wrong = F.filter(_keys(place.v), lambda k: ~self.inside(rule.property_names, self.item(place, k.cast("variant"), F.lit(0))))
            out.append(self.check(place, is_object & (F.size(wrong) > 0), "property_names", "keys of a kind", F.array_join(wrong, ", ")))
        for key, needed in rule.dependent_required:
            keys = _keys(place.v)
            missing = F.array_except(_texts(needed), keys)
            out.append(self.check(place, is_object & F.array_contains(keys, key) & (F.size(missing) > 0), "dependent_required",
                                  f"{', '.join(needed)} beside {key}", F.concat(F.lit("without "), F.array_join(missing, ", "))))
        for key, sub in rule.dependent_rules:
            out += self.under(is_object & F.array_contains(_keys(place.v), key), sub, place)
        return out

    def open_members(self, rule: Rule, place: _Place) -> list[_Check | _Many]:
        """Keys judged by pattern, or by a rule for all that are not declared."""
        out, entries = [], _entries(place.v)

        def entry(e: Column, i: Column) -> _Place:
            at = place.shown if place.label or self.root_path is not None else F.lit("$")
            return _Place(e["value"], _kind(e["value"]), place.sub("*"), F.concat(at, F.lit("."), e["key"]))

        probe = entry(F.lit(None).cast("struct<key:string,value:variant>"), F.lit(0))
        for pattern, sub in rule.pattern_properties:
            out += self.each(F.filter(entries, _matches(pattern)), entry, sub, probe)
        if rule.additional is True:
            return out
        free = F.filter(entries, _undeclared(rule))
        if rule.additional is False:
            out.append(self.check(place, F.size(free) > 0, "additional", "no undeclared keys",
                                  F.array_join(F.transform(free, lambda e: e["key"]), ", ")))
        else:
            out += self.each(free, entry, rule.additional, probe)
        return out

    def combined(self, rule: Rule, place: _Place) -> list[_Check | _Many]:
        out: list[_Check | _Many] = []
        for sub in rule.all_of:
            out += self.parts(sub, place)
        if rule.any_of:
            some = F.lit(False)
            for sub in rule.any_of:
                some = some | self.holds(sub, place)
            out.append(self.check(place, ~some, "any_of", f"one or more of {len(rule.any_of)} kinds"))
        if rule.one_of:
            n = F.lit(0)
            for sub in rule.one_of:
                n = n + self.holds(sub, place).cast("int")
            out.append(self.check(place, n != 1, "one_of", f"exactly one of {len(rule.one_of)} kinds"))
        if rule.none_of is not None:
            out.append(self.check(place, self.holds(rule.none_of, place), "not", "another kind"))
        if rule.if_ is not None:
            fits = self.holds(rule.if_, place)
            for cond, sub in ((fits, rule.then), (~fits, rule.otherwise)):
                if sub is not None:
                    out += self.under(cond, sub, place)
        return out

    # sets of violations

    def guarded(self, rule: Rule, place: _Place) -> list[_Check | _Many]:
        """The violations of a value that may be absent."""
        return self._where(place.present, self.parts(rule, place)) if place.present is not None else self.parts(rule, place)

    def under(self, cond: Column, rule: Rule, place: _Place) -> list[_Check | _Many]:
        return self._where(cond, self.parts(rule, place))

    def _where(self, cond: Column, parts: list) -> list[_Check | _Many]:
        return [replace(p, cond=F.coalesce(cond, F.lit(False)) & p.cond) if isinstance(p, _Check) else
                replace(p, found=F.when(cond, p.found).otherwise(self.none())) for p in parts]

    def none(self) -> Column:
        return F.array().cast(DETAIL if self.detail else "array<string>")

    def inside(self, rule: Rule, place: _Place) -> Column:
        """Whether the value meets the rule, computed in place."""
        good = F.lit(True)
        for p in self.parts(rule, place):
            good = good & (~p.cond if isinstance(p, _Check) else F.size(p.found) == 0)
        return good

    def holds(self, rule: Rule, place: _Place) -> Column:
        """The same as a column of its own at a fixed place, once however often it is asked."""
        if place.path is None:
            return self.inside(rule, place)
        key = (repr(rule), place.path, self.level)   # repr: an enumerated 1 is not true
        if key not in self.known:
            while len(self.flags) <= self.level:      # deeper branches come in earlier layers
                self.flags.append({})
            self.level += 1
            good = self.inside(rule, place)
            self.level -= 1
            self.known[key] = f"{self.prefix}b{len(self.known)}"
            self.flags[self.level][self.known[key]] = good
        return F.col(self.known[key])

    def each(self, arr: Column, at, rule: Rule, probe: _Place) -> list[_Many]:
        """The violations of all items, by one pass; ``probe`` stands for an item
        where only the names of its checks are asked."""
        labels = tuple(self.labels(self.parts(rule, probe)))
        if not labels:
            return []
        found = F.flatten(F.transform(arr, lambda e, i: self.collect(self.parts(rule, at(e, i)))))
        return [_Many(F.coalesce(found if self.detail else F.array_distinct(found), self.none()), labels)]

    @staticmethod
    def labels(parts: list) -> list[str]:
        out: list[str] = []
        for p in parts:
            out += [x for x in ([p.label] if isinstance(p, _Check) else p.labels) if x not in out]
        return out

    def full(self, label: str) -> Column:
        """A label below the value that is checked, as one below the record."""
        if self.root_label is None:
            return F.lit(label)
        return F.concat(self.root_label, F.lit(label[1:] if label[:2] in ("$:", "$[") else f".{label}"))

    def collect(self, parts: list) -> Column:
        """The parts as one array, in rule order.  Nulls are removed with
        ``array_except`` (code-generated; labels are unique, so its set
        semantics change nothing) rather than a lambda filter, which would take
        the whole projection out of whole-stage codegen."""
        if not parts:
            return self.none()
        if self.detail:
            one = [F.when(p.cond, F.struct(
                p.shown.alias("path"), F.lit(p.label.rsplit(":", 1)[1]).alias("rule"), F.lit(p.expected).alias("expected"),
                p.found.alias("found"), self.full(p.label).alias("label"))) for p in parts if isinstance(p, _Check)]
            many = [p.found for p in parts if isinstance(p, _Many)]
            own = F.array_except(F.array(*one), F.array(F.lit(None))).cast(DETAIL) if one else self.none()
            return F.array_distinct(F.concat(own, *many)) if many else own
        own = [F.when(p.cond, F.lit(p.label)) for p in parts if isinstance(p, _Check)]
        many = [p.found for p in parts if isinstance(p, _Many)]
        flat = F.array_except(F.array(*own), F.array(F.lit(None).cast("string"))) if own else self.none()
        return F.array_intersect(_texts(self.labels(parts)), F.concat(flat, *many)) if many else flat

    # links

    def links(self, rule: Rule, place: _Place) -> list[Column]:
        """Arrays of the places that a self-referring definition governs."""
        out: list[Column] = []
        if rule.ref is not None and place.path == "$":
            raise ValueError(f"{rule.ref} refers to itself without going down a level")
        if rule.ref is not None:
            here = F.array(F.struct(F.lit(rule.ref).alias("definition"), place.shown.alias("path"),
                                    self.full(place.label or "$:").alias("label"), place.v.alias("value")))
            out.append(F.when(place.v.isNotNull(), here).otherwise(F.array().cast(LINKS)))
        for r in rule.properties:
            out += self.links(r, self.child(place, r.name)) if _has_links(r) else []
        for sub in rule.all_of:
            out += self.links(sub, place)
        if any(_has_links(r) for r in (*rule.prefix_items, *([rule.items] if rule.items else []))):
            arr = F.try_variant_get(place.v, "$", "array<variant>")
            for i, sub in enumerate(rule.prefix_items):
                out += self.links(sub, self.item(place, F.get(arr, F.lit(i)), F.lit(i)))
            if rule.items is not None and _has_links(rule.items):
                skip = len(rule.prefix_items)
                rest = F.slice(arr, skip + 1, F.greatest(F.size(arr) - skip, F.lit(0))) if skip else arr
                out.append(self._all_links(rest, lambda e, i: self.links(rule.items, self.item(place, e, i + skip))))
        open_ = [(_matches(p), sub) for p, sub in rule.pattern_properties if _has_links(sub)]
        if isinstance(rule.additional, Rule) and _has_links(rule.additional):
            open_.append((_undeclared(rule), rule.additional))
        at = place.shown if place.label or self.root_path is not None else F.lit("$")
        for wanted, sub in open_:
            out.append(self._entry_links(F.filter(_entries(place.v), wanted), sub, place, at))
        return out

    def _entry_links(self, entries: Column, sub: Rule, place: _Place, at: Column) -> Column:
        return self._all_links(entries, lambda e, _: self.links(sub, _Place(
            e["value"], _kind(e["value"]), place.sub("*"), F.concat(at, F.lit("."), e["key"]))))

    @staticmethod
    def _all_links(arr: Column, each) -> Column:
        return F.coalesce(F.flatten(F.transform(arr, lambda e, i: F.concat(*each(e, i)))), F.array().cast(LINKS))


def _has_links(rule: Rule) -> bool:
    subs = [*rule.properties, *rule.all_of, *rule.prefix_items, *(s for _, s in rule.pattern_properties)]
    subs += [r for r in (rule.items, rule.additional) if isinstance(r, Rule)]
    return rule.ref is not None or any(_has_links(s) for s in subs)


def compile_rule(rule: Rule, value: str, kind: Column, detail: bool, path: Column | None = None,
                 label: Column | None = None) -> Compiled:
    """The checks of one value (a VARIANT column) as layers of helper columns
    and two arrays that read them.  ``path`` and ``label`` name the value where it is
    not the record."""
    c = _Compiler(detail, root_path=path, root_label=label)
    place = _Place(F.col(value), F.col("__ckr"), "", F.lit("$") if path is None else path, path="$")
    violations = c.collect(c.parts(rule, place))
    links = c.links(rule, place) if _has_links(rule) else []
    extracted = {f"__cv{i}": F.try_variant_get(F.col(value), p, "variant") for p, i in c.values.items()}
    kinds = {"__ckr": kind, **{f"__ck{i}": _kind(F.col(f"__cv{i}")) for i in c.values.values()}}
    return Compiled([extracted, kinds, *reversed(c.flags)], violations,
                    (F.concat(*links) if len(links) > 1 else links[0]) if links else None)


def compile_contract(contract: Contract, record: str = "record", text: str | None = "value", detail: bool = False) -> Compiled:
    """The checks of a whole record.  With the raw ``text`` at hand, "the line is an
    object" is read off its first character instead of typing the whole record."""
    kind = (F.when(F.col(text).rlike(r"^\s*\{"), F.lit("OBJECT")).otherwise(F.lit("OTHER"))
            if text else _kind(F.col(record)))
    # The record's own type comes first; its nulls and type are no further violation.
    root = replace(contract.root, type=None, nullable=True)
    compiled = compile_rule(root, record, kind, detail)
    is_object = F.col("__ckr").startswith("OBJECT")
    found = F.col(text) if text else F.to_json(F.col(record))

    def only(rule: str, expected: str) -> Column:
        if not detail:
            return F.array(F.lit(f"$:{rule}"))
        return F.array(F.struct(F.lit("$").alias("path"), F.lit(rule).alias("rule"), F.lit(expected).alias("expected"),
                                found.alias("found"), F.lit(f"$:{rule}").alias("label"))).cast(DETAIL)

    out = (F.when(F.col(record).isNull(), only("malformed", "a JSON object without repeated keys"))
           .when(~is_object, only("type", "object")).otherwise(compiled.violations))
    links = compiled.links
    if links is not None:
        links = F.when(is_object & F.col(record).isNotNull(), links).otherwise(F.array().cast(LINKS))
    return replace(compiled, violations=out, links=links)
