import pickle
import random
import re
from collections import Counter
from types import SimpleNamespace

import numpy as np
import pytest

from leadframe.llm import ngram_join
from leadframe.llm.ngram_join import first_of_each, join


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(words) < 5:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(tuple(words[i:i + 5]) for i in range(len(words) - 4))


def brute(rows):
    sets = [(d, shingles(t)) for d, t in rows]
    root = {d: d for d, _ in sets}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            if x and y and 100 * len(x & y) >= 75 * len(x | y):
                p, q = sorted((find(a), find(b)))
                root[q] = p
    return sorted((d, len(s), find(d)) for d, s in sets)


def check(spark, rows, parts=5):
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(parts)
    assert sorted(tuple(r) for r in join(df).collect()) == brute(rows)


def test_shingle_sets(texts, monkeypatch):
    rng = random.Random(2)
    odd = ["", " ", "a", "A b", "a\tB\x0bc\x0cd", "x " * 5, "é É ß \x1c \u2003 ŁÓ", "w" * 5_000, "\n" * 300 + "q", "one two three four five six" * 40]
    made = [" ".join("".join(rng.choices("abAB é", k=rng.randrange(1, 5))) for _ in range(rng.randrange(60))) for _ in range(200)]
    every = [None, *odd, *made, *texts.values()]
    plain = [frozenset(shingles(t)) for t in every]
    code: dict = {}
    for piece in (1 << 19, 64, 1):
        monkeypatch.setattr(ngram_join, "PIECE_BYTES", piece)
        got = [s.tolist() for s in ngram_join.shingle_sets(None if t is None else t.encode() for t in every)]
        assert [len(s) for s in got] == [len(s) for s in plain] and all(s == sorted(set(s)) for s in got)
        numbers: dict = {}
        for hashed, named in zip(got, plain):
            for h in hashed:
                numbers.setdefault(h, set()).add(named)
        for h, where in numbers.items():  # a hash stands for one shingle, whatever the pieces
            assert frozenset.intersection(*where)
        assert code.setdefault("sets", got) == got


def test_given_documents(spark, texts):
    check(spark, sorted(texts.items()))


def test_edited_copies(spark):
    rng = random.Random(5)
    vocabulary = [f"W{i}" for i in range(60)]
    rows = []
    for base in range(12):
        words = [rng.choice(vocabulary) for _ in range(rng.choice((3, 6, 9, 20, 60, 150)))]
        for _ in range(25):  # edits add up, so that far ends are linked through the middle only
            words = list(words)
            words[rng.randrange(len(words))] = rng.choice(vocabulary)
            rows.append((len(rows), " ".join(words) + rng.choice(("", "\n", " extra"))))
    rng.shuffle(rows)
    check(spark, rows)


def test_large_group_and_common_passage(spark, monkeypatch):
    """Lists beyond all length classes, hubs and the rest."""
    monkeypatch.setattr(ngram_join, "LENGTHS", (1, 3, 6, 12))
    rng = random.Random(6)
    passage = " ".join(f"p{i}" for i in range(30))
    base = [f"b{i}" for i in range(90)]
    rows = []
    for i in range(260):
        if i % 2:
            words = list(base)
            for _ in range(rng.randrange(4)):
                words[rng.randrange(90)] = f"e{rng.randrange(10 ** 6)}"
            rows.append((i, " ".join(words)))
        else:
            own = " ".join(f"u{rng.randrange(10 ** 6)}" for _ in range(rng.choice((4, 8, 12, 60))))
            rows.append((i, f"{own} {passage}"))
    rng.shuffle(rows)
    check(spark, rows)


def test_list_lengths_are_packed(spark, monkeypatch):
    """Before, the driver held and sent the whole table of 32 MB, whatever the input."""
    monkeypatch.setattr(ngram_join, "LENGTHS", (1, 3, 6, 12))
    rows = [(i, " ".join(f"w{j}" for j in range(20)) + f" own{i}" + " a b c d e" * (i < 5)) for i in range(9)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    held = SimpleNamespace(value=ngram_join._list_lengths(docs))
    assert len(pickle.dumps(held.value)) < 1_000_000
    counts = Counter(h for own in ngram_join.shingle_sets(t.encode() for _, t in rows) for h in own.tolist() if h < 1 << 63)
    table = ngram_join._table(held)
    assert table.shape == (4, ngram_join.TABLE_BITS // 64) and ngram_join._table(held) is table
    want = {(i, h % ngram_join.TABLE_BITS) for h, n in counts.items() for i, least in enumerate((1, 3, 6, 12)) if n > least}
    got = {(int(i), int(w) * 64 + b) for i, w in zip(*np.nonzero(table)) for b in range(64) if int(table[i, w]) >> b & 1}
    assert got == want and {i for i, _ in got} == {0, 1, 2}
    assert not ngram_join._table(SimpleNamespace(value=ngram_join._list_lengths(docs.limit(0)))).any()


def test_odd_rows(odd, empty):
    rows = sorted((tuple(r) for r in join(odd).collect()), key=str)
    got = {(r[0], r[2]) for r in rows}
    assert got == {(1, 1), (2, 2), (3, 3), (None, None), (4, 4), (5, 4), (6, 6), (7, 7), (8, 8), (9, 9), (10, 10)}
    assert len(rows) == odd.count()
    kept = first_of_each(odd)
    assert kept.columns == odd.columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted([1, 2, 3, None, 4, 6, 7, 8, 9, 10], key=str)
    assert join(empty).collect() == [] and first_of_each(empty).collect() == []


def test_one_id_with_two_texts(spark):
    a, b = "one two three four five six", "seven eight nine ten eleven twelve"
    df = spark.createDataFrame([(3, a), (5, a), (5, b), (9, b), (9, None)], "doc_id bigint, text string")
    assert {tuple(r) for r in join(df).collect()} == {(3, 2, 3), (5, 2, 3), (9, 2, 3), (9, 0, 3)} or \
        {(r.doc_id, r.component_id) for r in join(df).collect() if r.n_shingles} == {(3, 3), (5, 3), (9, 3)}


def test_first_of_each_tells_texts_apart(spark):
    a, b, c = "one two three four five six", "seven eight nine ten eleven twelve", "to be or not to be that is"
    rows = [(3, a), (5, a), (5, b), (9, b.upper()), (None, c), (None, c), (None, "c only here but null too"), (8, c), (7, ""), (7, ""), (6, None)]
    df = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], "doc_id bigint, text string, _key int")
    df = df.withColumnRenamed("_key", "n")
    kept = sorted(((r.doc_id, r.text) for r in first_of_each(df).collect()), key=str)
    assert kept == sorted([(3, a), (5, b), (8, c), (None, "c only here but null too"), (7, ""), (7, ""), (6, None)], key=str)


@pytest.mark.parametrize("edges", [[(1, 2), (2, 3), (3, 4), (9, 8), (8, 7), (7, 4), (20, 30)], [(5, 5)]])
def test_components(spark, edges):
    labels = {r.rep: r.comp for r in ngram_join.components(spark.createDataFrame(edges, "rep_a bigint, rep_b bigint")).collect()}
    chain = {n: 1 for n in (1, 2, 3, 4, 7, 8, 9)} | {20: 20, 30: 20}
    assert labels == (chain if len(edges) > 1 else {5: 5})
