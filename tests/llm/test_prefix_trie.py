import hashlib
import random
import zlib

import pytest

from leadframe.llm import prefix_trie
from pyspark.sql import functions as F

ROWS = "conv_id bigint, turn bigint, role string, text string"


def plain(rows, group=100, borrowed=6):
    """The tree by dictionaries of whole beginnings, of rows (conv_id, turn, role, text)."""
    turns = {}
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            turns.setdefault(c, []).append(((turn is not None, turn or 0), role, hashlib.md5(text.encode()).hexdigest(), text))
    turns = {c: [(t[1], t[3]) for t in sorted(own)] for c, own in turns.items()}
    rebuilt = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % borrowed
        base = int(c / group) * group  # towards zero
        rebuilt[c] = turns.get(base, [])[:h] + own[h:]
    members, ends, children = {}, {}, {}
    for c, own in rebuilt.items():
        for d in range(len(own) + 1):
            key = tuple(own[:d])
            members.setdefault(key, []).append(c)
            if d:
                children.setdefault(key[:-1], set()).add(key)
        ends.setdefault(tuple(own), []).append(c)
    leaves, saved = {}, {}
    for key in sorted(members, key=len, reverse=True):
        below = children.get(key, ())
        leaves[key] = sum(leaves[k] for k in below) or 1
        saved[key] = sum(saved[k] for k in below) + ((len(members[key]) - 1) * len(key[-1][1]) if key else 0)
    return sorted(((min(m), len(k), min(members[k[:-1]]) if k else None, len(m), len(children.get(k, ())), leaves[k], saved[k],
                    hashlib.sha256(",".join(map(str, sorted(ends.get(k, ())))).encode()).hexdigest()) for k, m in members.items()), key=str)


def agree(conversations, **kw):
    got = sorted(map(tuple, prefix_trie.trie(conversations, **kw).collect()), key=str)
    assert got == plain([tuple(r) for r in conversations.select("conv_id", "turn", "role", "text").collect()], **kw)
    return got


def test_conversations(spark, sf_dir):
    agree(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


def test_shapes(spark, monkeypatch):
    """A long chain, a comb that ends a conversation at each depth, a bush and many copies, over stretches of 8 turns."""
    monkeypatch.setattr(prefix_trie, "STRETCH", 8)
    rows = [(1000, t, "user", f"long {t}") for t in range(150)]
    rows += [(2000 + n, t, "user", f"comb {t}") for n in range(20) for t in range(20 - n)]
    draw = random.Random(5)
    rows += [(3000 + n, t, draw.choice("ab"), draw.choice(["x", "yy"])) for n in range(60) for t in range(draw.randrange(1, 6))]
    rows += [(70_000 * n, t, "user", "same") for n in range(1, 40) for t in range(3)]
    docs = spark.createDataFrame(rows, ROWS).repartition(6)
    agree(docs)
    agree(docs, group=1)
    agree(docs, group=10_000_000, borrowed=3)


def test_odd_rows(spark):
    rows = [(None, 1, "user", "no conversation"), (5, None, None, None), (5, None, "", ""), (5, 2, "user", None), (5, 2, "user", "tie"),
            (5, 2, "user", "tie"), (5, 2, None, "tie"), (7, 1, "ab", "c"), (8, 1, "a", "bc"), (-3, 1, "user", "negative"),
            (-103, 1, "user", "negative"), (-100, 3, "user", "first of its group"), (200, 1, "user", "w" * 100_000), (203, 9, "u", "\U0001f600"),
            (301, 1, "user", "its group has no first"), (302, 1, "user", "nor has this"), (None, None, None, None)]
    docs = spark.createDataFrame([(*r, 1, "p", 2, 3) for r in rows], f"{ROWS}, place int, id string, node int, depth int")
    got = agree(docs)
    assert any(r[1] == 0 and r[7] != hashlib.sha256(b"").hexdigest() for r in got)  # some have no turns left
    agree(docs.unionByName(docs))
    assert agree(docs.limit(0)) == [] and agree(docs.where("conv_id IS NULL")) == []


def test_totals_of_any_tree(spark):
    draw = random.Random(11)
    up = {0: None} | {i: draw.choice([i - 1, i - 1, i - 1, draw.randrange(i)]) for i in range(1, 400)}
    depth = {0: 0}
    for i in range(1, 400):
        depth[i] = depth[up[i]] + 1
    tree = spark.createDataFrame([((depth[i], i), None if up[i] is None else (depth[up[i]], up[i]), 0, i) for i in up],
                                 "node struct<depth:bigint,conv_id:bigint>, parent struct<depth:bigint,conv_id:bigint>, leaves bigint, saved bigint")
    totals, kids = prefix_trie.subtree_totals(tree)
    got = {r.node.conv_id: (r.leaves, r.saved) for r in totals.collect()}
    below, saved = dict.fromkeys(up, 0), {i: i for i in up}
    for i in range(399, -1, -1):
        below[i] = below[i] or 1
        if up[i] is not None:
            below[up[i]] += below[i]
            saved[up[i]] += saved[i]
    assert got == {i: (below[i], saved[i]) for i in up}
    assert sum(r.kids for r in kids.collect()) == 399


def test_digest_of_many_chunks(spark):
    ids = [n * 40_000 for n in range(-30, 30)]
    rows = spark.createDataFrame([("a", i) for i in ids] + [("b", 5)], "id string, conv_id bigint")
    got = {r.id: r.ends_sha256 for r in prefix_trie._ends(rows).collect()}
    assert got == {"a": hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), "b": hashlib.sha256(b"5").hexdigest()}
