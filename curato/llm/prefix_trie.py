"""The prefix trie of conversations by the Euler-tour technique.

Each distinct sequence of first d turns (role, text) of the conversations is a
node of depth d; its members are the conversations that start with it.  For every
node the operator counts members, children and leaves, sums the bytes that
sharing its turns saves over its subtree, and digests the conversations that end in it.

Method.  A turn's digest takes its position, and the exclusive-or of a conversation's
first d digests names its prefix (120 bits).  Members of one depth belong to one
node, so (depth, smallest member) names a node too.  The tour has an enter and an
exit arc per node; an arc's successor follows from the node's first child, next
sibling or parent.  The list of arcs is ranked by contraction: in every round each
arc draws a coin, an arc with tails whose predecessor has heads is taken into that
predecessor (a quarter of the list), until at most ``LAST`` arcs are left, which
one task ranks; the arcs taken out get their positions in the reverse order of
rounds.  No two neighbours go in one round, so the rounds together move a few
times the list.  A subtree is the stretch between its two arcs, so its leaves and
savings are differences of two prefix sums over the positions.

Scale.  A long conversation is numbered by range partitions (``rank_in_group``)
and its prefixes are formed in slices of about the square root of its length, so
no task holds all its turns.  Children of one parent are numbered in the same way,
and the tour is summed in slices of about the square root of its length.  Members of
a node are counted before the shuffle; the ids that end in a node are sorted over
range partitions, joined to texts of bounded length where they lie, and one stream
reads these texts in order into the digest.

Defined cases.  Turns are ordered by number (null first), then role, then text.  A
null role or text is empty.  Rows with a null conv_id take no part.  A rebuilt
conversation without turns is a member of the root alone.  An empty table has no
conversation and no node, not even a root.  Repeated rows are turns of their own.
Extra columns are not read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from curato.llm.common import freed, staged, table
from curato.operators.ranking import rank_in_group

# Fixed values of the contract: families of conversations and the most turns they share.
FAMILY, SHARED = 5, 9
LAST = 65_536            # arcs that one task may rank
SLICE = 1024             # least length of a slice of a conversation
PIECE = 1 << 20          # characters of a joined text of ids


# -- conversations -> prefixes --------------------------------------------------------

def numbered_turns(conversations: DataFrame) -> DataFrame:
    """(conv, k, n, digest, bytes): turn k (from 1) of n, its digest and the bytes of its text."""
    rows = conversations.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("bigint").alias("conv"), "turn",
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    ranked = rank_in_group(rows, ["conv"], [F.col("turn").asc_nulls_first(), F.col("role").asc(), F.col("text").asc()],
                           rank_col="k", size_col="n")
    size = F.octet_length("role").cast("string")
    return staged(ranked.select("conv", "k", "n", F.sha2(F.concat(size, F.lit(":"), "role", "text").cast("binary"), 256).alias("digest"),
                                F.octet_length("text").cast("bigint").alias("bytes")), "turns")


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rebuilt conversations: (conv, length) and their turns (conv, d, digest, bytes, length)."""
    own = turns.groupBy("conv").agg(F.max("n").alias("n"))
    key = F.col("conv").cast("string").cast("binary")
    own = own.select("conv", "n", (F.col("conv") - F.col("conv") % FAMILY).alias("base"), (F.crc32(key) % SHARED).alias("h"))
    bases = own.select(F.col("conv").alias("base"), F.col("n").alias("base_n"))
    members = own.join(bases, "base", "left").withColumn("taken", F.least("h", F.coalesce("base_n", F.lit(0)))).select(
        "conv", "base", "h", "taken", (F.col("taken") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("length"))
    members = staged(members, "members")
    # At most eight turns of a base go to at most nine conversations.
    start = turns.filter(F.col("k") < SHARED).select(F.col("conv").alias("base"), F.col("k").alias("d"), "digest", "bytes")
    first = (members.join(start, "base").filter(F.col("d") <= F.col("h"))
             .select("conv", "d", "digest", "bytes", "length"))
    rest = (turns.join(members.select("conv", "h", "taken", "length"), "conv").filter(F.col("k") > F.col("h"))
            .select("conv", (F.col("taken") + F.col("k") - F.col("h")).alias("d"), "digest", "bytes", "length"))
    return members.select("conv", "length"), first.unionByName(rest)


def prefixes(turns: DataFrame) -> DataFrame:
    """(conv, d, x, y, px, py, bytes, length): the names (x, y) of the prefix of d
    turns and (px, py) of the one before."""
    # Two numbers of 60 bits from a digest of the turn and its position.
    salted = F.md5(F.concat(F.col("d").cast("string"), F.lit(":"), "digest").cast("binary"))
    part = [F.conv(F.substring(salted, at, 15), 16, 10).cast("bigint") for at in (1, 17)]
    slice_ = F.greatest(F.lit(SLICE), F.ceil(F.sqrt("length"))).cast("bigint")
    rows = staged(turns.select("conv", "d", "bytes", "length", part[0].alias("a"), part[1].alias("b"),
                               ((F.col("d") - 1) - (F.col("d") - 1) % slice_).alias("slice")), "salted")
    # Before a slice: the exclusive-or of the conversation's earlier slices, of which most have none.
    totals = rows.groupBy("conv", "slice").agg(F.bit_xor("a").alias("ta"), F.bit_xor("b").alias("tb"))
    earlier = Window.partitionBy("conv").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = (totals.select("conv", "slice", F.bit_xor("ta").over(earlier).alias("ca"), F.bit_xor("tb").over(earlier).alias("cb"))
               .filter("slice > 0"))
    inside = Window.partitionBy("conv", "slice").orderBy("d").rowsBetween(Window.unboundedPreceding, 0)
    local = rows.withColumns({"x": F.bit_xor("a").over(inside), "y": F.bit_xor("b").over(inside)})
    whole = local.join(carried, ["conv", "slice"], "left").withColumns(
        {"x": F.col("x").bitwiseXOR(F.coalesce("ca", F.lit(0))), "y": F.col("y").bitwiseXOR(F.coalesce("cb", F.lit(0)))})
    return staged(whole.select("conv", "d", "x", "y", F.col("x").bitwiseXOR(F.col("a")).alias("px"),
                               F.col("y").bitwiseXOR(F.col("b")).alias("py"), "bytes", "length"), "prefixes")


# -- the trie --------------------------------------------------------------------------

def trie_nodes(members: DataFrame, rows: DataFrame) -> DataFrame:
    """One row per node: depth, x, y, conv (smallest member), parent (its conv),
    n_convs, bytes, n_children, first_child (its conv)."""
    below = rows.groupBy(F.col("d").alias("depth"), "x", "y").agg(
        F.min("conv").alias("conv"), F.count(F.lit(1)).alias("n_convs"), F.max("bytes").alias("bytes"),
        F.min("px").alias("px"), F.min("py").alias("py"))
    zero = F.lit(0).cast("bigint")
    root = members.agg(F.min("conv").alias("conv"), F.count(F.lit(1)).alias("n_convs")).filter("n_convs > 0").select(
        zero.alias("depth"), zero.alias("x"), zero.alias("y"), "conv", "n_convs", zero.alias("bytes"),
        F.lit(None).cast("bigint").alias("px"), F.lit(None).cast("bigint").alias("py"))
    named = staged(below.unionByName(root), "named")
    key = ["depth", "x", "y"]
    children = named.filter("depth > 0").groupBy(
        (F.col("depth") - 1).alias("depth"), F.col("px").alias("x"), F.col("py").alias("y")).agg(
        F.count(F.lit(1)).alias("n_children"), F.min("conv").alias("first_child"))
    parents = named.select((F.col("depth") + 1).alias("depth"), F.col("x").alias("px"), F.col("y").alias("py"),
                           F.col("conv").alias("parent"))
    return staged(named.join(children, key, "left").join(parents, ["depth", "px", "py"], "left").select(
        *key, "conv", "parent", "n_convs", "bytes", F.coalesce("n_children", F.lit(0)).alias("n_children"), "first_child"), "nodes")


def tour(nodes: DataFrame) -> DataFrame:
    """The arcs (node, arc) with their successors (next_node, next_arc): a node is named
    by its conv, an arc by twice its depth (enter), or one more (exit).  The
    root's exit has no successor."""
    ranked = rank_in_group(nodes.filter("depth > 0").select("depth", "parent", "conv"), ["depth", "parent"],
                           [F.col("conv").asc()], rank_col="at")
    ranked = staged(ranked, "siblings")
    after = ranked.select("depth", "parent", (F.col("at") - 1).alias("at"), F.col("conv").alias("sibling"))
    siblings = ranked.join(after, ["depth", "parent", "at"], "left").select("depth", "conv", "sibling")
    full = nodes.join(siblings, ["depth", "conv"], "left")
    leaf, last, down = F.col("n_children") == 0, F.col("sibling").isNull(), 2 * F.col("depth")
    enter = F.struct(down.alias("arc"), F.when(leaf, F.col("conv")).otherwise(F.col("first_child")).alias("next_node"),
                     F.when(leaf, down + 1).otherwise(down + 2).alias("next_arc"))
    leave = F.struct((down + 1).alias("arc"), F.when(last, F.col("parent")).otherwise(F.col("sibling")).alias("next_node"),
                     F.when(F.col("depth") == 0, F.lit(None)).when(last, down - 1).otherwise(down).alias("next_arc"))
    return full.select(F.col("conv").alias("node"), F.inline(F.array(enter, leave)))


# -- list ranking ------------------------------------------------------------------------

_POSITION = "node bigint, arc bigint, position bigint"


def _rank_last(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Positions along the whole (short) list."""
    follow, entered = {}, set()
    for b in batches:
        for node, arc, to, to_arc, step in zip(*(b[c].to_pylist() for c in ("node", "arc", "next_node", "next_arc", "step")), strict=True):
            follow[node, arc] = (to, to_arc), step
            entered.add((to, to_arc))
    at, position, out = next((k for k in follow if k not in entered), None), 0, []
    while at in follow:
        out.append((*at, position))
        at, step = follow[at]
        position += step
    if out:
        yield pa.record_batch([list(c) for c in zip(*out, strict=True)], names=["node", "arc", "position"])


def rank_list(arcs: DataFrame, last: int = LAST) -> DataFrame:
    """(node, arc, position): the place, from 0, of every arc in its list."""
    alive = staged(arcs.withColumn("step", F.lit(1).cast("bigint")), "arcs")
    taken: list[DataFrame] = []
    while alive.count() > last:
        draw = len(taken)

        def heads(node: str, arc: str, draw: int = draw) -> Column:
            return F.xxhash64(F.lit(draw), node, arc) % 2 == 0

        # The root's exit has no successor, so its "next" never shows tails.
        takes = heads("node", "arc") & ~heads("next_node", "next_arc") & F.col("next_node").isNotNull()
        takers = alive.filter(takes).select(
            F.col("node").alias("o_node"), F.col("arc").alias("o_arc"), F.col("next_node").alias("node"),
            F.col("next_arc").alias("arc"), F.col("step").alias("o_step"))
        met = alive.filter(~heads("node", "arc")).join(takers, ["node", "arc"], "left")
        gone = F.col("o_node").isNotNull()
        stays = F.struct(F.lit(True).alias("alive"), F.when(gone, F.col("o_node")).otherwise(F.col("node")).alias("node"),
                         F.when(gone, F.col("o_arc")).otherwise(F.col("arc")).alias("arc"), "next_node", "next_arc",
                         F.when(gone, F.col("step") + F.col("o_step")).otherwise(F.col("step")).alias("step"))
        # An arc taken out lies ``step`` after the arc that took it.
        out = F.struct(F.lit(False).alias("alive"), "node", "arc", F.col("o_node").alias("next_node"),
                       F.col("o_arc").alias("next_arc"), F.col("o_step").alias("step"))
        rest = alive.filter(heads("node", "arc") & ~takes).select(F.lit(True).alias("alive"), *alive.columns)
        round_ = staged(met.select(F.inline(F.when(gone, F.array(stays, out)).otherwise(F.array(stays)))).unionByName(rest), "round")
        alive = round_.filter("alive").drop("alive")
        taken.append(round_.filter(~F.col("alive")).drop("alive"))
    placed = staged(alive.repartition(1).mapInArrow(_rank_last, _POSITION), "placed")   # ``last`` rows at most
    for out in reversed(taken):
        takers = placed.select(F.col("node").alias("next_node"), F.col("arc").alias("next_arc"), "position")
        found = out.join(takers, ["next_node", "next_arc"]).select("node", "arc", (F.col("position") + F.col("step")).alias("position"))
        placed = staged(placed.unionByName(found), "placed")
    return placed


def prefix_sums(rows: DataFrame, total: int, *values: str) -> DataFrame:
    """``rows`` (position 0 .. total - 1) with the sum of each value up to and with its row."""
    width = max(1, math.isqrt(total))
    rows = rows.withColumn("slice", F.expr(f"position div {width}"))
    sums = rows.groupBy("slice").agg(*[F.sum(v).alias(v) for v in values])       # about the root of the rows
    before = Window.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = sums.select("slice", *[F.coalesce(F.sum(v).over(before), F.lit(0)).alias(f"__{v}") for v in values])
    inside = Window.partitionBy("slice").orderBy("position").rowsBetween(Window.unboundedPreceding, 0)
    local = rows.withColumns({f"to_{v}": F.sum(v).over(inside) for v in values})
    return local.join(carried, "slice").withColumns({f"to_{v}": F.col(f"to_{v}") + F.col(f"__{v}") for v in values}).drop(
        "slice", *[f"__{v}" for v in values])


# -- digests of the members that end in a node ----------------------------------------------

def _join_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (depth, x, y, conv) -> texts of neighbouring ids of one node."""
    names = ["depth", "x", "y", "conv", "ids"]
    key, first, parts, size = None, None, [], 0

    def piece() -> pa.RecordBatch:
        return pa.record_batch([[v] for v in (*key, first, ",".join(parts))], names=names)

    for b in batches:
        for row in zip(*(b[c].to_pylist() for c in names[:4]), strict=True):
            if row[:3] != key or size >= PIECE:
                if parts:
                    yield piece()
                key, first, parts, size = row[:3], row[3], [], 0
            parts.append(str(row[3]))
            size += len(parts[-1]) + 1
    if parts:
        yield piece()


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted texts -> one SHA-256 per node, fed text by text."""
    key, state = None, None

    def rows(done: list[tuple]) -> pa.RecordBatch:
        return pa.record_batch([list(c) for c in zip(*done, strict=True)], names=["depth", "x", "y", "ends_sha256"])

    for b in batches:
        done = []
        for *at, ids in zip(*(b[c].to_pylist() for c in ("depth", "x", "y", "ids")), strict=True):
            if at != key:
                if state is not None:
                    done.append((*key, state.hexdigest()))
                key, state = at, hashlib.sha256()
            else:
                state.update(b",")
            state.update(ids.encode())
        if done:
            yield rows(done)
    if state is not None:
        yield rows([(*key, state.hexdigest())])


def end_digests(members: DataFrame, rows: DataFrame) -> DataFrame:
    """(depth, x, y, ends_sha256) of the nodes in which a conversation ends."""
    zero = F.lit(0).cast("bigint")
    ends = rows.filter(F.col("d") == F.col("length")).select(F.col("d").alias("depth"), "x", "y", "conv").unionByName(
        members.filter("length = 0").select(zero.alias("depth"), zero.alias("x"), zero.alias("y"), "conv"))
    key = ["depth", "x", "y"]
    parts = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    texts = (ends.repartitionByRange(parts, *key, "conv").sortWithinPartitions(*key, "conv")
             .mapInArrow(lambda b: freed(_join_ids(b)), "depth bigint, x bigint, y bigint, conv bigint, ids string"))
    return texts.repartition(*key).sortWithinPartitions(*key, "conv").mapInArrow(
        lambda b: freed(_digest(b)), "depth bigint, x bigint, y bigint, ends_sha256 string")


# -- the operator ------------------------------------------------------------------------

def prefix_trie(conversations: DataFrame, last: int = LAST) -> DataFrame:
    """One row per node of the trie of the rebuilt conversations."""
    members, turns = rebuilt(numbered_turns(conversations))
    rows = prefixes(turns)
    nodes = trie_nodes(members, rows)
    placed = rank_list(tour(nodes), last)
    own = nodes.select(F.col("conv").alias("node"), (2 * F.col("depth")).alias("arc"),
                       (F.col("n_children") == 0).cast("bigint").alias("leaf"),
                       ((F.col("n_convs") - 1) * F.col("bytes")).alias("saved"))
    weighed = placed.join(own, ["node", "arc"], "left").fillna(0, ["leaf", "saved"])
    summed = prefix_sums(weighed, placed.count(), "leaf", "saved")
    # Up to the exit, less what came before the enter arc.
    leaving = F.col("arc") % 2 == 1
    inside = summed.groupBy(F.col("node").alias("conv"), F.expr("arc div 2").alias("depth")).agg(
        F.sum(F.when(leaving, F.col("to_leaf")).otherwise(F.col("leaf") - F.col("to_leaf"))).alias("n_leaves"),
        F.sum(F.when(leaving, F.col("to_saved")).otherwise(F.col("saved") - F.col("to_saved"))).alias("saved_tokens"))
    return (nodes.join(inside, ["conv", "depth"]).join(end_digests(members, rows), ["depth", "x", "y"], "left")
            .select(F.col("conv").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), "n_convs", "n_children",
                    "n_leaves", "saved_tokens",
                    F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256")))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(table(spark, sf_dir, "conversations"))


# A byte's step of crc32, eight times; polynomial and start are the fixed values of crc32.
ORACLE = """
WITH t AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS k
  FROM conversations WHERE conv_id IS NOT NULL),
c AS (
  SELECT conv_id AS c, n, conv_id - conv_id % 5 AS base,
         xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), [CAST(ord(z) AS BIGINT) FOR z IN string_split(CAST(conv_id AS VARCHAR), '')]),
           lambda acc, byte: list_reduce(list_prepend(xor(acc, byte), [CAST(i AS BIGINT) FOR i IN range(8)]),
             lambda a, i: xor(a >> 1, 3988292384 * (a & 1)))), 4294967295) % 9 AS h
  FROM (SELECT conv_id, count(*) AS n FROM t GROUP BY conv_id)),
turns AS (
  SELECT c, k AS d, role, text FROM c JOIN t ON t.conv_id = base AND k <= h
  UNION ALL
  SELECT a.c, least(a.h, coalesce(b.n, 0)) + k - a.h, role, text
  FROM c a JOIN t ON t.conv_id = a.c AND k > a.h LEFT JOIN c b ON b.c = a.base),
path AS (
  SELECT c, d, octet_length(encode(text)) AS bytes,
         sha256(string_agg(sha256(role) || sha256(text), ',') OVER (PARTITION BY c ORDER BY d)) AS node
  FROM turns UNION ALL SELECT c, 0, 0, '' FROM c),
nodes AS (
  SELECT d, node, min(c) AS conv, count(*) AS n, max(bytes) AS bytes FROM path GROUP BY d, node),
ends AS (
  SELECT d, node, string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) AS ids
  FROM path JOIN (SELECT c, max(d) AS d FROM path GROUP BY c) USING (c, d) GROUP BY d, node),
up AS (  -- every node with each node at or above it
  SELECT n.d AS low_d, n.conv AS low, a.d, a.node FROM nodes n JOIN path a ON a.c = n.conv AND a.d <= n.d),
kids AS (
  SELECT d - 1 AS d, node, count(*) AS n_children
  FROM (SELECT n.d, a.node FROM nodes n JOIN path a ON a.c = n.conv AND a.d = n.d - 1) GROUP BY 1, 2),
sums AS (
  SELECT up.d, up.node, sum((n.n - 1) * n.bytes) AS saved, count(*) FILTER (WHERE k.n_children IS NULL) AS leaves
  FROM up JOIN nodes n ON n.d = low_d AND n.conv = low LEFT JOIN kids k ON k.d = n.d AND k.node = n.node
  GROUP BY up.d, up.node)
SELECT n.conv AS conv_id, CAST(n.d AS BIGINT) AS depth, p.conv AS parent_conv_id, n.n AS n_convs,
       coalesce(k.n_children, 0) AS n_children, s.leaves AS n_leaves, CAST(s.saved AS BIGINT) AS saved_tokens,
       sha256(coalesce(e.ids, '')) AS ends_sha256
FROM nodes n JOIN sums s USING (d, node) LEFT JOIN kids k USING (d, node) LEFT JOIN ends e USING (d, node)
LEFT JOIN path a ON a.c = n.conv AND a.d = n.d - 1 LEFT JOIN nodes p ON p.d = a.d AND p.node = a.node
"""
