import re
from collections import Counter

import pytest

from leadframe.llm import divergence
from pyspark.sql import functions as F

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def plain(rows, min_docs=30, ranks=50):
    """Every difference of every kept term, group by group, of rows (text, lang, source)."""
    rows = [(TERM.findall((t or "").translate(LOWER)), lang or "", source or "") for t, lang, source in rows]
    out = []
    for lang in {r[1] for r in rows}:
        own = [(terms, source) for terms, l, source in rows if l == lang]
        docs = Counter(t for terms, _ in own for t in set(terms))
        kept = {t for t, n in docs.items() if n >= min_docs}
        counts = {s: Counter(t for terms, source in own if source == s for t in terms if t in kept) for s in {s for _, s in own}}
        whole = sum(counts.values(), Counter())

        def shares(c):
            total = sum(c.values()) + 5 * len(kept)
            return {t: 1 + (10**9 * (c[t] + 5)) // total for t in kept}

        p, q = {s: shares(c) for s, c in counts.items()}, shares(whole)
        for s, c in counts.items():
            far = [(o, sum(abs(p[s][t] - p[o][t]) for t in kept)) for o in counts if o != s]
            more = [(t, p[s][t] - q[t]) for t in kept if c[t] and p[s][t] > q[t]]
            for part, items, top in (("pair", far, None), ("term", more, ranks)):
                ranked = sorted(items, key=lambda i: (-i[1], i[0].encode()))[:top]
                out += [(lang, s, part, item, value, rank) for rank, (item, value) in enumerate(ranked, 1)]
    return sorted(out)


def agree(docs, **kw):
    got = sorted(map(tuple, divergence.audit(docs, **kw).collect()))
    assert got == plain([tuple(r) for r in docs.select("text", "lang", "source").collect()], **kw)
    return got


@pytest.mark.parametrize("kw", [{}, {"min_docs": 1, "ranks": 7}, {"min_docs": 4, "ranks": 1}])
def test_documents(documents, kw):
    assert agree(documents, **kw)


def test_ties_cross_cells_and_follow_utf8(spark):
    texts = [("b a é ﬀ \U0001f600 z", "x", "s1"), ("a b z z é \U0001f600 ﬀ Ŀ", "x", "s2"), ("ß É é", "x", "s3"), ("", "x", "s4"), (None, "x", None),
             ("A_B-a1b", None, "s1"), ("!!", "y", "s1"), (None, "y", "s2")] * 2
    docs = spark.createDataFrame(texts, "text string, lang string, source string")
    for ranks in (1, 2, 3, 50):
        got = agree(docs, min_docs=2, ranks=ranks)
    assert {r[4] for r in got if r[0] == "y"} == {0}


def test_odd_rows(odd, empty):
    agree(odd)
    agree(odd.unionByName(odd), min_docs=2)
    assert agree(empty) == []
    assert agree(odd.withColumn("text", F.lit(None).cast("string")).select("text", "lang", "source", F.lit(1).alias("n"), F.lit(2).alias("term")))


def test_pieces_and_flushes(documents, monkeypatch):
    text = ("word other Ünd " * 50 + "x" * 300).encode()
    monkeypatch.setattr(divergence, "PIECE", 16)
    pattern = re.compile(divergence.TERM)
    assert [t for piece in divergence._pieces(text, pattern) for t in piece] == pattern.findall(text)
    run = divergence._counted(divergence.TERM)
    monkeypatch.setattr(divergence, "HELD", 50)
    batches = documents.select("text", "lang", "source").toArrow().to_batches(max_chunksize=20)
    parts = list(run(iter(batches)))
    assert len(parts) > 2
    total, docs = Counter(), Counter()
    for part in parts:
        for r in part.to_pylist():
            total[r["term"]] += r["n"]
            docs[r["term"]] += r["docs"]
    rows = [TERM.findall((r.text or "").translate(LOWER)) for r in documents.collect()]
    assert +total == Counter(t for terms in rows for t in terms) and +docs == Counter(t for terms in rows for t in set(terms))


def test_large_counts_are_exact(spark):
    rows = spark.createDataFrame([(9_000_000_000_000_000, 9_000_000_000_000_001, 3)], "c bigint, n bigint, v bigint")
    assert rows.select(divergence._share(F.col("c"), F.col("n"), F.col("v"))).head()[0] == \
        1 + (10**9 * (9_000_000_000_000_000 + 5)) // (9_000_000_000_000_001 + 15)
