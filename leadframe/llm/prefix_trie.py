"""Prefix tree of conversations with subtree totals (operator 12).

Equal beginnings are one node.  Totals come from parallel tree contraction: each
round compresses all chains of only children by pointer doubling and rakes all
leaves, until the root is left; then the compressed nodes are expanded again.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.joins import lookup
from ..session import materialize
from .common import only, shipped, tidy_shuffles

GROUP = 100  # conversations that borrow the beginning of the group's first one
BORROWED = 6  # they borrow fewer turns than this
STRETCH = 4_096  # places of one conversation that are summed in one window
CHUNK_BITS = 16  # conversations 65,536 apart go to different chunks of a list of ids


def ordered(conversations: DataFrame) -> DataFrame:
    """conv_id, place (from 1), k1, k2 (hash of role and text), chars of every turn.

    Turns are in order of ``turn``, null first, equal ones by role, then by the
    MD5 of the text.  Rows are dealt to ranges of that order, so that even one
    conversation with most of the rows is spread; a place is the place within the
    range plus the rows of the conversation in earlier ranges.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    order = [F.col("turn").asc_nulls_first(), "role", "tie"]
    rows = only(conversations.where("conv_id IS NOT NULL"), "conv_id", "turn", "role", "text").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", role.alias("role"), F.md5(text.cast("binary")).alias("tie"),
        F.xxhash64(role, text).alias("k1"), F.xxhash64(F.lit(12), text, role).alias("k2"), F.length(text).cast("long").alias("chars"))
    dealt = materialize(rows.repartitionByRange(F.col("conv_id"), *order).withColumn("part", F.spark_partition_id()), "turns")
    by_conv = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    begun = dealt.groupBy("conv_id", "part").agg(F.count("*").alias("n")).withColumn("ahead", F.sum("n").over(by_conv)) \
        .where("ahead > 0").select("conv_id", "part", "ahead")
    local = F.row_number().over(Window.partitionBy("conv_id", "part").orderBy(*order))
    # only the first conversation of a range can have begun before it, so there is at most one row for each range
    return dealt.withColumn("local", local).join(F.broadcast(begun), ["conv_id", "part"], "left") \
        .select("conv_id", (F.col("local") + F.coalesce("ahead", F.lit(0))).alias("place"), "k1", "k2", "chars")


def rebuilt(turns: DataFrame, group: int = GROUP, borrowed: int = BORROWED) -> tuple[DataFrame, DataFrame]:
    """Conversations (conv_id, length) and their turns (conv_id, length, place, k1, k2, chars) after borrowing.

    The first h turns of ``conv_id`` c are those of conversation c - c % group, or
    as many as that one has; c's own turns after its first h follow.  h is the
    unsigned CRC-32 of the decimal c, modulo ``borrowed``.
    """
    turns = materialize(turns, "places")
    heads = turns.where((F.col("conv_id") % group == 0) & (F.col("place") < borrowed)).groupBy(F.col("conv_id").alias("base")) \
        .agg(F.sort_array(F.collect_list(F.struct("place", "k1", "k2", "chars"))).alias("head"))  # fewer than ``borrowed``
    share = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % borrowed).cast("int")
    convs = turns.groupBy("conv_id").agg(F.count("*").alias("n")) \
        .select("conv_id", "n", share.alias("h"), (F.col("conv_id") - F.col("conv_id") % group).alias("base")) \
        .join(heads, "base", "left").withColumn("head", F.slice(F.coalesce("head", F.array().cast(heads.schema["head"].dataType)),
                                                                F.lit(1), F.col("h")))
    convs = convs.withColumn("own", F.greatest(F.col("n") - F.col("h"), F.lit(0))) \
        .withColumn("length", F.size("head") + F.col("own"))
    convs = materialize(convs, "conversations")
    first = convs.select("conv_id", "length", F.inline("head"))
    own = turns.join(convs.where("own > 0").select("conv_id", "length", "h", F.size("head").alias("shared")), "conv_id").where("place > h") \
        .select("conv_id", "length", (F.col("place") - F.col("h") + F.col("shared")).alias("place"), "k1", "k2", "chars")
    return convs.select("conv_id", "length"), first.unionByName(own)


def _paths(turns: DataFrame) -> DataFrame:
    """conv_id, length, place, chars, id and up of every turn: the hash of the beginning up to it, with and without it.

    A beginning's hash is the exclusive or of hashes of (place, turn), summed in
    stretches of bounded length and then over the stretches.
    """
    rows = turns.select("conv_id", "length", "place", "chars", F.xxhash64(F.lit(1), "place", "k1", "k2").alias("g1"),
                        F.xxhash64(F.lit(2), "place", "k2", "k1").alias("g2"), F.floor(F.col("place") / STRETCH).alias("part"))
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = rows.where(F.col("length") >= STRETCH).groupBy("conv_id", "part").agg(F.bit_xor("g1").alias("g1"), F.bit_xor("g2").alias("g2"))
    ahead = parts.select("conv_id", "part", F.bit_xor("g1").over(earlier).alias("a1"), F.bit_xor("g2").over(earlier).alias("a2"))
    here = Window.partitionBy("conv_id", "part").orderBy("place").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    zero = F.lit(0).cast("long")
    summed = rows.select("*", F.bit_xor("g1").over(here).alias("h1"), F.bit_xor("g2").over(here).alias("h2")) \
        .join(ahead, ["conv_id", "part"], "left")
    for i in "12":
        summed = summed.withColumn(f"p{i}", F.col(f"h{i}").bitwiseXOR(F.coalesce(f"a{i}", zero))) \
            .withColumn(f"u{i}", F.col(f"p{i}").bitwiseXOR(F.col(f"g{i}")))
    return summed.select("conv_id", "length", "place", "chars", _id("place", "p1", "p2").alias("id"),
                         _id(F.col("place") - 1, "u1", "u2").alias("up"))


def _id(depth, h1, h2) -> Column:
    return F.concat_ws(":", F.col(depth).cast("string") if isinstance(depth, str) else depth.cast("string"),
                       F.lower(F.hex(h1)), F.lower(F.hex(h2)))


ROOT = "0:0:0"


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the chunks of each id, which come in order; only the running digest is kept."""
    now, digest = None, None
    for batch in batches:
        ids, told = [], []
        for key, chunk in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if key == now:
                digest.update(b"," + chunk.encode())
                continue
            if now is not None:
                ids.append(now)
                told.append(digest.hexdigest())
            now, digest = key, hashlib.sha256(chunk.encode())
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.string()), pa.array(told, pa.string())], ["id", "ends_sha256"])
    if now is not None:
        yield pa.RecordBatch.from_arrays([pa.array([now]), pa.array([digest.hexdigest()])], ["id", "ends_sha256"])


def _ends(ends: DataFrame) -> DataFrame:
    """id, ends_sha256 of (id, conv_id): ids are joined in bounded chunks first, and only the chunks meet in one task."""
    chunks = ends.groupBy("id", F.shiftright("conv_id", CHUNK_BITS).alias("chunk")) \
        .agg(F.array_join(F.sort_array(F.collect_list("conv_id")).cast("array<string>"), ",").alias("told"))
    return chunks.repartition("id").sortWithinPartitions("id", "chunk").select("id", "told").mapInArrow(_digests, "id string, ends_sha256 string")


# --- contraction -----------------------------------------------------------------------------------------------

SUMS = ("leaves", "saved")


def _chains(unary: DataFrame) -> DataFrame:
    """node, end and the sums from a node to the last of its chain: pointers double until all have left the chain.

    ``unary`` are nodes (node, to, sums) with one child ``to``.  No two nodes of a
    chain point to the same node inside it, so no key of these joins is hot.
    """
    inside = unary.select(F.col("node").alias("to"), F.lit(True).alias("inside"))
    links = materialize(unary.select("node", "to", *SUMS).join(inside, "to", "left")
                        .select("node", "to", *SUMS, F.col("inside").isNotNull().alias("open")), "chains")
    while not links.where("open").isEmpty():
        other = links.select(F.col("node").alias("to"), F.col("to").alias("_to"), *[F.col(s).alias(f"_{s}") for s in SUMS], F.col("open").alias("_open"))
        doubled = links.where("open").join(other, "to").select(
            "node", F.col("_to").alias("to"), *[(F.col(s) + F.col(f"_{s}")).alias(s) for s in SUMS], F.col("_open").alias("open"))
        links = materialize(links.where("NOT open").unionByName(doubled), "chains")
    return links.select("node", F.col("to").alias("end"), *SUMS)


def subtree_totals(tree: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Totals over each node's subtree, and children counts, of a tree (node, parent, leaves, saved).

    ``node`` and ``parent`` are structs that start with a depth which grows from parent to child;
    the root's parent is null.  ``leaves`` counts childless nodes (its input value
    is not read), ``saved`` is summed.  A round halves the childless nodes at
    least, and doubling halves a chain at each step, so the number of jobs
    grows with the logarithm of the tree, whatever its shape.
    """
    alive, counted, raked, compressed = tree, None, [], []
    while True:
        below = alive.where("parent IS NOT NULL").groupBy(F.col("parent").alias("node")) \
            .agg(F.count("*").alias("kids"), F.max("node").alias("to"))
        state = alive.join(below, "node", "left").withColumn("kids", F.coalesce("kids", F.lit(0)))
        if counted is None:
            state = counted = materialize(state.withColumn("leaves", (F.col("kids") == 0).cast("long")), "tree")
        else:
            state = materialize(state, "tree")
        unary = state.where("kids = 1 AND parent IS NOT NULL")
        chains = _chains(unary)
        # the top of a chain hands its sums and its place below the parent to the chain's end
        tops = chains.join(unary.select("node", "parent"), "node").groupBy("end") \
            .agg(F.min(F.struct("node", "parent", *SUMS)).alias("top")).select(F.col("end").alias("node"), "top.parent", *[f"top.{s}" for s in SUMS])
        rest = state.where("kids <> 1 OR parent IS NULL") \
            .join(tops.select("node", F.col("parent").alias("lifted")), "node", "left").withColumn("parent", F.coalesce("lifted", "parent"))
        sent = tops.select(F.col("parent").alias("node"), *SUMS) \
            .unionByName(rest.where("kids = 0 AND parent IS NOT NULL").select(F.col("parent").alias("node"), *SUMS)) \
            .groupBy("node").agg(*[F.sum(s).alias(f"_{s}") for s in SUMS])
        after = materialize(rest.join(sent, "node", "left").select(
            "node", "parent", "kids", *[(F.col(s) + F.coalesce(f"_{s}", F.lit(0))).alias(s) for s in SUMS]), "tree")
        compressed.append(chains)
        raked.append(after.where("kids = 0 AND parent IS NOT NULL").select("node", *SUMS))
        alive = after.where("kids > 0 OR parent IS NULL").select("node", "parent", *SUMS)
        if alive.where("parent IS NOT NULL").isEmpty():
            break
    known = alive.select("node", *SUMS)
    for part in raked:
        known = known.unionByName(part)
    # a chain's end outlives the chain, so the rounds are expanded from the last to the first
    for chains in reversed(compressed):
        if not chains.isEmpty():
            ends = known.select(F.col("node").alias("end"), *[F.col(s).alias(f"_{s}") for s in SUMS])
            known = known.unionByName(materialize(chains.join(ends, "end").select(
                "node", *[(F.col(s) + F.col(f"_{s}")).alias(s) for s in SUMS]), "expanded"))
    return known, counted.select("node", "kids")


def nodes(convs: DataFrame, turns: DataFrame) -> DataFrame:
    """One row for each distinct beginning of the conversations (conv_id, length) with turns as :func:`rebuilt` gives them.

    Returns conv_id (the smallest member), depth, parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens, ends_sha256.
    """
    with tidy_shuffles(convs.sparkSession):
        paths = materialize(_paths(turns), "paths")
        found = paths.groupBy("id").agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.min("place").cast("long").alias("depth"),
                                        F.min("chars").alias("chars"), F.min("up").alias("up"))
        root = convs.agg(F.count("*").alias("n_convs"), F.min("conv_id").alias("conv_id")).where("n_convs > 0") \
            .select(F.lit(ROOT).alias("id"), "conv_id", "n_convs", F.lit(0).cast("long").alias("depth"),
                    F.lit(0).cast("long").alias("chars"), F.lit(None).cast("string").alias("up"))
        found = materialize(found.unionByName(root), "beginnings")
        linked = lookup(found, found.select("id", F.col("conv_id").alias("parent_conv_id")), F.col("up"), "id", ["parent_conv_id"], "id")
        linked = materialize(linked, "linked")
        # the smallest member and the depth name a node as well as the hash does
        node = F.struct("depth", "conv_id")
        parent = F.when(F.col("up").isNotNull(), F.struct((F.col("depth") - 1).alias("depth"), F.col("parent_conv_id").alias("conv_id")))
        totals, children = subtree_totals(linked.select(
            node.alias("node"), parent.alias("parent"), F.lit(0).cast("long").alias("leaves"),
            ((F.col("n_convs") - 1) * F.col("chars")).alias("saved")))
        ended = paths.where("place = length").select("id", "conv_id") \
            .unionByName(convs.where("length = 0").select(F.lit(ROOT).alias("id"), "conv_id"))
        none = hashlib.sha256(b"").hexdigest()
        return linked.withColumn("node", node).join(totals, "node").join(children, "node").join(_ends(ended), "id", "left").select(
            "conv_id", "depth", "parent_conv_id", "n_convs", F.col("kids").cast("long").alias("n_children"),
            F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"),
            F.coalesce("ends_sha256", F.lit(none)).alias("ends_sha256"))


def trie(conversations: DataFrame, group: int = GROUP, borrowed: int = BORROWED) -> DataFrame:
    """The prefix tree of conversations (conv_id, turn, role, text) after :func:`rebuilt`; see :func:`nodes`.

    Null role or text counts as empty.  Rows with equal ``turn`` come in order
    of role, then of the MD5 of the text; repeated rows are turns of their own.
    Rows without a ``conv_id`` belong to no conversation and are left out.  A
    conversation without turns ends at the root.  An empty table has no node,
    not even a root.  Other columns are ignored.
    """
    with tidy_shuffles(conversations.sparkSession):
        return nodes(*rebuilt(ordered(conversations), group, borrowed))


ORACLE = r"""
WITH t AS (SELECT conv_id AS c, coalesce(role, '') AS r, coalesce(text, '') AS x, row_number() OVER (
             PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), md5(coalesce(text, ''))) AS p
           FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT c, c - c % 100 AS base, CAST(xor(4294967295::UBIGINT, list_reduce(
             list_prepend(4294967295::UBIGINT, list_transform(string_split(CAST(c AS VARCHAR), ''), lambda s: ord(s)::UBIGINT)),
             lambda a, b: list_reduce(list_prepend(xor(a, b), [0, 0, 0, 0, 0, 0, 0, 0]::UBIGINT[]),
                                   lambda v, z: xor(v >> 1, CASE WHEN (v & 1) = 1 THEN 3988292384::UBIGINT ELSE 0::UBIGINT END)))) % 6 AS BIGINT) AS h
      FROM (SELECT DISTINCT c FROM t)),
b AS (SELECT c.c, c.h, count(t.p) AS shared FROM c LEFT JOIN t ON t.c = c.base AND t.p <= c.h GROUP BY c.c, c.h),
s AS (SELECT c.c, t.p AS i, t.r, t.x FROM c JOIN t ON t.c = c.base AND t.p <= c.h
      UNION ALL SELECT b.c, t.p - b.h + b.shared, t.r, t.x FROM b JOIN t ON t.c = b.c AND t.p > b.h),
path AS (SELECT c, i, length(x) AS chars, md5(string_agg(md5(r) || md5(x), '') OVER (PARTITION BY c ORDER BY i)) AS k FROM s
         UNION ALL SELECT c, 0, 0, '' FROM c),
len AS (SELECT c, max(i) AS n FROM path GROUP BY c),
node AS (SELECT i, k, min(c) AS c, count(*) AS n, min(chars) AS chars FROM path GROUP BY i, k),
-- a node's ancestors are the beginnings of its smallest member
above AS (SELECT n.i, n.k, n.n, n.chars, p.i AS ai, p.k AS ak FROM node n JOIN path p ON p.c = n.c AND p.i <= n.i),
kids AS (SELECT ai, ak, count(*) FILTER (WHERE i = ai + 1) AS n_children, sum((n - 1) * chars) AS saved FROM above GROUP BY ai, ak),
leaves AS (SELECT a.ai, a.ak, count(*) AS n_leaves FROM above a JOIN kids k ON k.ai = a.i AND k.ak = a.k AND k.n_children = 0 GROUP BY a.ai, a.ak),
ends AS (SELECT p.i, p.k, string_agg(CAST(p.c AS VARCHAR), ',' ORDER BY p.c) AS told
         FROM path p JOIN len l ON l.c = p.c AND l.n = p.i GROUP BY p.i, p.k)
SELECT node.c AS conv_id, node.i AS depth, up.c AS parent_conv_id, node.n AS n_convs, kids.n_children, leaves.n_leaves,
       CAST(kids.saved AS BIGINT) AS saved_tokens, sha256(coalesce(ends.told, '')) AS ends_sha256
FROM node JOIN kids ON kids.ai = node.i AND kids.ak = node.k JOIN leaves ON leaves.ai = node.i AND leaves.ak = node.k
LEFT JOIN ends ON ends.i = node.i AND ends.k = node.k
LEFT JOIN (SELECT a.i, a.k, n.c FROM above a JOIN node n ON n.i = a.ai AND n.k = a.ak WHERE a.ai = a.i - 1) up ON up.i = node.i AND up.k = node.k
"""

shipped(__name__)
