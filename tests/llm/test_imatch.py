import hashlib
import math
from collections import Counter

import xxhash

from leadframe.llm import imatch
from leadframe.llm.imatch import fingerprints


def signed(n):
    return n - (1 << 64) if n >> 63 else n


def words(text):
    return {w for w in text.encode().lower().split()}


def brute(rows):
    """{position: (edited sha, kept term hashes by subset)} from plain Python."""
    order = sorted(rows, key=lambda r: r[0], reverse=True)
    total = len(rows)
    df = Counter(w for _, t in rows for w in words(t))
    out = {}
    for at, (doc, text) in enumerate(order):
        other = order[(at + 1) % len(order)][1]
        cut = len(text) // 3
        changed = text[:len(text) - cut] + other[:cut]
        kept = []
        for t in (text, changed):
            subsets = {}
            for w in words(t):
                h = signed(xxhash.xxh64_intdigest(w, seed=42))
                if h % imatch.SPARSE < imatch.SUBSETS and total ** 0.2 <= df[w] <= total ** 0.8 and \
                        0.2 - 1e-12 <= math.log(total / df[w]) / math.log(total) <= 0.8 + 1e-12:
                    subsets.setdefault(h % imatch.SPARSE, set()).add(h)
            kept.append(subsets)
        out[doc] = (hashlib.sha256(changed.encode()).hexdigest(), *kept)
    return out


def near(a, b, equal):
    if not a or not b:
        return 1.0 if equal else 0.0
    told = a.keys() | b.keys()
    return sum(a.get(k) == b.get(k) for k in told) / len(told)


def test_against_plain_python(documents, texts):
    expected = brute([(d, t or "") for d, t in texts.items()])
    rows = fingerprints(documents).collect()
    prints = {}
    assert len(rows) == len(texts)
    ids = sorted(texts, reverse=True)
    following = dict(zip(ids, ids[1:] + ids[:1]))
    for r in rows:
        text, other = texts[r.doc_id] or "", texts[following[r.doc_id]] or ""
        sha, own, changed = expected[r.doc_id]
        assert (r.n_chars, r.edited_sha256) == (len(text), sha)
        assert r.near_edited == near(own, changed, hashlib.sha256(text.encode()).hexdigest() == sha)
        assert r.near_next == near(own, expected[following[r.doc_id]][1], text == other)
        assert prints.setdefault(text, r.fingerprint) == r.fingerprint
    assert sum(r.near_edited for r in rows) > 10 * sum(r.near_next for r in rows)


def test_next_over_many_ranges(documents, texts):
    ids = sorted(texts, reverse=True)
    found = imatch.next_texts(documents.repartition(5), bucket_rows=7).collect()
    assert {r.doc_id: r.next_text for r in found} == {a: texts[b] or "" for a, b in zip(ids, ids[1:] + ids[:1])}
    assert len(found) == len(texts)


def test_odd_rows(odd, empty, spark):
    rows = fingerprints(odd).collect()
    assert len(rows) == odd.count()
    texts = {r.doc_id: r.text or "" for r in odd.collect()}
    for r in rows:
        assert r.n_chars == len(texts[r.doc_id]) and 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        if len(texts[r.doc_id]) < 3:
            assert r.near_edited == 1
    assert len({r.fingerprint for r in rows if r.doc_id in (4, 5)}) == 1
    assert fingerprints(empty).collect() == []
    alone = fingerprints(spark.createDataFrame([(3, "abc")], "doc_id bigint, text string")).head()
    assert (alone.near_next, alone.edited_sha256) == (1.0, hashlib.sha256(b"aba").hexdigest())


def test_every_term_of_the_band_counts(spark):
    # the words of each text are in four texts out of 64: all in the band
    sets = [[f"t{i}n{j}" for j in range(1 + i % 5)] for i in range(16)]
    rows = [(4 * i + more, " ".join(s[::-1] + s[:more])) for i, s in enumerate(sets) for more in range(4)]
    found = {r.doc_id: r.fingerprint for r in fingerprints(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert not any(p.startswith("text:") for p in found.values())
    assert all(found[4 * i] == found[4 * i + more] for i in range(16) for more in range(4)) and len(set(found.values())) == 16


def test_lexicon_too_large_to_send(documents, monkeypatch):
    columns = ["doc_id", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    sent = sorted(fingerprints(documents).select(*columns).collect())
    monkeypatch.setattr(imatch, "BROADCAST_TERMS", 0)
    assert sorted(fingerprints(documents).select(*columns).collect()) == sent
