import hashlib
import re

import numpy as np
import pytest

from leadframe.llm import line_index
from pyspark.sql import functions as F

STRIP = re.compile(r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows, min_docs=3, min_chars=20):
    """(doc_id, n_lines, n_dropped, kept) of rows (doc_id, text), by dictionaries of whole lines."""
    key = lambda line: STRIP.sub("", line).translate(UPPER)
    rank = lambda doc_id: (doc_id is not None, doc_id or 0)
    holders = {}
    for doc_id, text in rows:
        for k in {key(line) for line in (text or "").split("\n")}:
            if len(k) >= min_chars:
                holders.setdefault(k, []).append(rank(doc_id))
    last = {k: max(ids) for k, ids in holders.items() if len(ids) >= min_docs}
    out = []
    for doc_id, text in rows:
        lines = (text or "").split("\n")
        kept = [line for line in lines if last.get(key(line), rank(doc_id)) == rank(doc_id)]
        out.append((doc_id, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


def agree(docs, **kw):
    got = sorted(map(tuple, line_index.dedup(docs, **kw).collect()), key=str)
    assert got == plain([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()],
                        **{k: v for k, v in kw.items() if k != "broadcast_bytes"})
    return got


SHARED = "A line that is shared by several documents"


@pytest.fixture(scope="module")
def made(spark):
    rows = [(i, f"own line number {i} of this one document\n  {SHARED.upper() if i % 2 else SHARED}\t\nshort") for i in range(40)]
    rows += [(50, f"{SHARED}\n{SHARED}\nlast"), (51, "two documents hold this line only\r"), (52, "two documents hold this line only"),
             (53, "ÀÉ über zwanzig Zeichen lang\x0b"), (54, " ÀÉ über zwanzig Zeichen lang"), (55, "ÀÉ ÜBER zwanzig Zeichen lang"),
             (56, "àé über zwanzig Zeichen lang"), (57, "ÀÉ über ZWANZIG zeichen lang\n"), (None, SHARED), (None, SHARED), (58, "\n\n"),
             (-4, "n" * 19), (-5, "n" * 19), (-6, "n" * 19), (-7, "m" * 20), (-8, "m" * 20), (-9, "m" * 20), (-7, "m" * 20)]
    return spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5).cache()


@pytest.mark.parametrize("sent", [line_index.BROADCAST_BYTES, 0])
def test_lines(made, sent):
    got = {r[0]: r for r in agree(made, broadcast_bytes=sent)}
    assert got[50][2] == 0 and got[3][3] == "own line number 3 of this one document\nshort"
    assert got[None][3] == "" and got[51][2] == 0 and got[53][2] == 1 and got[57][2] == 0 and got[-8][2] == 1 and got[-7][2] == 0


@pytest.mark.parametrize("kw", [{}, {"broadcast_bytes": 0}, {"min_docs": 2, "min_chars": 1}])
def test_documents(documents, kw):
    agree(documents, **kw)


@pytest.mark.parametrize("sent", [line_index.BROADCAST_BYTES, 0])
def test_odd_rows(odd, empty, sent):
    agree(odd.unionByName(odd), broadcast_bytes=sent)
    agree(odd.unionByName(odd), broadcast_bytes=sent, min_docs=2, min_chars=0)
    assert agree(empty, broadcast_bytes=sent) == []
    assert agree(odd.withColumn("text", F.lit(None).cast("string")), broadcast_bytes=sent)


def test_hot_keys_stay_and_cold_ones_travel(made, monkeypatch):
    monkeypatch.setattr(line_index, "HOT_KEYS", 2)  # only the line of 40 documents is hot
    agree(made, broadcast_bytes=0, min_docs=2, min_chars=3)


def test_every_key_has_its_own_place():
    rng = np.random.default_rng(3)
    hi, lo = rng.integers(-2**63, 2**63 - 1, (2, 20_000))
    lo[:500], hi[500:900] = 7, 9  # equal halves
    sizes, words, places = line_index.build(hi, lo)
    assert sorted(places) == list(range(20_000)) and words.nbytes < 20_000
    order = np.argsort(places)
    row = {"levels": sizes, "bits": words.tobytes(), "prints": lo[order].tobytes(), "width": 4,
           "counts": np.arange(1, 20_001, dtype="u4")[order].tobytes(), "lasts": hi[order].tobytes()}
    counts, lasts = line_index.Arrays(row).find(hi, lo)
    assert (counts == np.arange(1, 20_001)).all() and (lasts == hi).all()
    strange = rng.integers(-2**63, 2**63 - 1, (2, 20_000))
    assert not line_index.Arrays(row).find(*strange)[0].any()


def test_query_digest(spark, sf_dir, documents):
    from leadframe.llm.queries import op11_line_dedup
    want = {(d, n, g, hashlib.sha256(t.encode()).hexdigest())
            for d, n, g, t in plain([(r.doc_id, r.text) for r in documents.collect()])}
    assert {tuple(r) for r in op11_line_dedup(spark, sf_dir).collect()} == want
