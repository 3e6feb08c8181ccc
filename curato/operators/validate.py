"""Record contract checks over raw JSON lines.

``check_contract`` parses each line once into a VARIANT and adds a
``violations`` array; valid rows are the ones with an empty array.  Blank lines
are skipped; every other line, a null one too, lands in exactly one of valid /
rejected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curato.functions.contract import DETAIL, LINKS, Contract, compile_contract, compile_rule
from curato.session import stage

_LINE = "__line"
_ALLOW = "spark.sql.variant.allowDuplicateKeys"
_END = "end of line"


def is_blank(text_col: str = "value") -> Column:
    """White space only; a null line is not blank."""
    return F.coalesce(~F.col(text_col).rlike(r"\S"), F.lit(False))


def parse_records(raw: DataFrame, text_col: str = "value", repeated: str = "reject", keep_blank: bool = False) -> DataFrame:
    """Drop blank lines (white space only; unless ``keep_blank``) and parse the rest
    into a VARIANT column ``record``, null when the line is null or not JSON.

    An object that repeats a key makes its line malformed (``repeated="reject"``)
    or keeps the key's last value (``"last"``), at any depth and in the same parse.
    The parser stops at the end of a value, so the line is read as the first of two
    items, of which the second is known: text after the record makes it malformed."""
    if repeated not in ("reject", "last"):
        raise ValueError("repeated must be 'reject' or 'last'")
    text, spark = F.col(text_col), raw.sparkSession
    lines = raw if keep_blank else raw.filter(~is_blank(text_col))
    before = spark.conf.get(_ALLOW)
    spark.conf.set(_ALLOW, str(repeated == "last").lower())
    try:   # the parser takes the setting when the column is resolved, here
        pair = lines.withColumn("__pair", F.try_parse_json(F.concat(F.lit("["), text, F.lit(f',"{_END}"]'))))
        alone = ((F.try_variant_get("__pair", "$[1]", "string") == _END)
                 & F.try_variant_get("__pair", "$[2]", "variant").isNull())
        return pair.withColumn("record", F.when(alone, F.try_variant_get("__pair", "$[0]", "variant"))).drop("__pair")
    finally:
        spark.conf.set(_ALLOW, before)


def _fenced(df: DataFrame, keep: list[str], **computed: Column) -> DataFrame:
    """``keep`` and the computed columns, handed on by a generator (``inline`` of a
    one-element array), so a later filter on them cannot be pushed below and
    inline the whole check a second time: each line is checked once."""
    return df.select(*keep, F.inline(F.array(F.struct(*[c.alias(n) for n, c in computed.items()]))))


def check_contract(raw: DataFrame, contract: Contract, text_col: str = "value", detail: bool = False,
                   repeated: str = "reject", tables: list[str] | None = None, keep_blank: bool = False) -> DataFrame:
    """Raw rows + ``record`` (VARIANT) + ``violations`` (array<string>), and with
    ``detail`` also ``details``, one (path, rule, expected, found, label) per
    violation, from the same projections and the same parse.

    Each field is extracted and typed once and the violation array built in
    plain (code-generated) projections.  A contract with self-referring
    definitions is checked level by level, see ``_walk_links``; the paths of
    their staged tables go to ``tables``."""
    parsed = parse_records(raw, text_col, repeated, keep_blank)
    recursive = bool(contract.definitions)
    compiled = compile_contract(contract, "record", text_col, detail or recursive)
    df = parsed
    for layer in compiled.layers:
        df = df.withColumns(layer)
    if recursive:
        links = compiled.links if compiled.links is not None else F.array().cast(LINKS)
        first = _fenced(df, parsed.columns, details=compiled.violations, __links=links)
        whole = _walk_links(first, contract, parsed.columns, tables)
    elif detail:
        whole = _fenced(df, parsed.columns, details=compiled.violations)
    else:
        return _fenced(df, parsed.columns, violations=compiled.violations)
    out = _fenced(whole, [*parsed.columns, "details"], violations=F.array_distinct(F.transform("details", lambda d: d["label"])))
    return out if detail else out.drop("details")


def _walk_links(first: DataFrame, contract: Contract, keep: list[str], tables: list[str] | None) -> DataFrame:
    """Follow the links of self-referring definitions, one level of nesting a round.

    The frontier holds (line, definition, path, value) for every value that a
    definition governs; a round checks its values and makes the links below them.
    Its rounds are bounded by the deepest record, its rows by the nested values; a
    round is staged, so none is computed again."""
    base = stage(first.withColumn(_LINE, F.monotonically_increasing_id()), "records", tables)
    frontier = base.filter(F.size("__links") > 0).select(_LINE, F.inline("__links"))
    found = None
    while True:
        rounds = []
        for name, rule in contract.definitions:
            at = frontier.filter(F.col("definition") == name)
            c = compile_rule(rule, "value", F.schema_of_variant("value"), True,
                             F.col("path"), F.col("label"))
            for layer in c.layers:
                at = at.withColumns(layer)
            rounds.append(_fenced(at, [_LINE, "path"], details=c.violations,
                                  __links=c.links if c.links is not None else F.array().cast(LINKS)))
        level = rounds[0]
        for r in rounds[1:]:
            level = level.unionByName(r)
        level = stage(level, "links", tables)
        bad = level.filter(F.size("details") > 0).select(_LINE, "path", "details")
        found = bad if found is None else found.unionByName(bad)
        if level.filter(F.size("__links") > 0).isEmpty():
            break
        frontier = level.filter(F.size("__links") > 0).select(_LINE, F.inline("__links"))
    below = found.groupBy(_LINE).agg(F.sort_array(F.collect_list(F.struct("path", "details"))).alias("__found"))
    more = F.coalesce(F.flatten(F.transform("__found", lambda f: f["details"])), F.array().cast(DETAIL))
    # As many rows as lines with a fault: the small files that they are read from say little of
    # their size in memory, so they are never broadcast.
    joined = base.join(below.hint("merge"), _LINE, "left")
    return joined.select(*keep, F.array_distinct(F.concat("details", more)).alias("details"))


def split_valid(checked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid rows, rejected rows with a ``reasons`` string)."""
    ok = F.size(F.col("violations")) == 0
    valid = checked.filter(ok)
    rejected = checked.filter(~ok).withColumn("reasons", F.array_join(F.col("violations"), ";"))
    return valid, rejected


def violation_summary(checked: DataFrame) -> DataFrame:
    """Rows rejected per rule (a row breaking two rules counts twice)."""
    return (checked.select(F.explode(F.col("violations")).alias("rule"))
            .groupBy("rule").agg(F.count(F.lit(1)).cast("long").alias("n")))


def violation_report(checked: DataFrame, *keys: str) -> DataFrame:
    """One row per violation of rows checked with ``detail``: the key columns (for
    numbered lines their file and record number), path, rule, expected, found
    and a message."""
    each = checked.select(*keys, F.inline("details")).drop("label")
    found = F.coalesce(F.concat(F.lit(", found "), "found"), F.lit(""))
    return each.withColumn("message", F.concat("path", F.lit(": expected "), "expected", found))
