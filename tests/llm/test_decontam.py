import random

import numpy as np

from leadframe.llm import decontam
from leadframe.llm.decontam import BlockIndex, hop, leaks, tokens, width_of, without_leaks


def test_index_finds_everything_within_the_radius():
    rng = np.random.default_rng(1)
    for radius in (0, 3, 7):
        prints = rng.integers(0, 1 << 63, 200, dtype=np.uint64)
        queries = prints[rng.integers(0, 200, 300)].copy()
        for i in range(300):
            for bit in rng.choice(64, int(rng.integers(0, radius + 3)), replace=False):
                queries[i] ^= np.uint64(1 << int(bit))
        found = {tuple(p) for p in zip(*(x.tolist() for x in BlockIndex(prints, radius).search(queries)))}
        near = np.bitwise_count(queries[:, None] ^ prints[None, :]) <= radius
        assert found == {tuple(p) for p in np.argwhere(near).tolist()}


def test_running_sums_are_packed_and_right():
    rng = np.random.default_rng(4)
    hashes = rng.integers(0, 1 << 64, 70_000, dtype=np.uint64)
    hashes[30_000:] |= np.uint64(0xFF000000000000FF)  # bits of every word, so that counters of all sizes overflow
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1)
    for width, size in ((1, 64), (8, 64), (255, 64), (256, 128), (24_576, 128)):
        sums = decontam.bit_sums(hashes, decontam.counter(width))
        assert sums[1:].nbytes == size * len(hashes)
        starts = np.unique(np.concatenate([rng.integers(0, len(hashes) - width, 40), [0, len(hashes) - width]]))
        counted = np.array([bits[s:s + width].sum(axis=0, dtype=np.int64) for s in starts])
        expected = np.packbits(counted > width // 2, axis=1).view("<u8").ravel()
        assert decontam.fingerprints(hashes, starts, width, sums).tolist() == expected.tolist()
        assert decontam.fingerprints(hashes, starts, width).tolist() == expected.tolist()


def test_narrow_and_wide_windows_side_by_side(spark):
    own = lambda item, n: [f"i{item}x{j}" for j in range(n)]
    sizes = (9, 60, 330, 700)  # windows of one-byte and of two-byte counters
    items = [(n, " ".join(own(n, n))) for n in sizes]
    docs = [(n, " ".join(own("a", 333) + own(n, n) + own("b", 100))) for n in sizes] + [(0, " ".join(own("a", 2_000)))]
    assert {decontam.counter(w) for w in decontam.Benchmark(items, 7).windows} == {np.uint8, np.uint16}
    found = leaks(spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string"))
    assert sorted((r.doc_id, r.item_id, r.similarity, r.place) for r in found.collect()) == [(n, n, 1.0, 333) for n in sizes]


def test_some_window_lies_inside_any_passage():
    for size in range(1, 300):
        w = width_of(size)
        assert all(any(at <= s and s + w <= at + size for s in range(0, at + size, hop(w))) for at in range(30))


def brute(docs, items, threshold=0.75):
    class Own(decontam.Benchmark):
        pass

    index = Own(items, 7)
    out = {}
    for doc_id, text in docs:
        words = tokens(text)
        for number, (item, own) in enumerate(index.items):
            best = max((index.similarity(number, words[s:s + len(own)])
                        for s in range(max(1, len(words) - len(own) + 1))), default=0.0) if words else 0.0
            if best >= threshold:
                out[doc_id, item] = round(best, 9)
    return out


def test_against_all_windows(spark):
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(300)]
    text = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(i, text(n)) for i, n in enumerate((1, 3, 5, 9, 14, 20, 33, 45, 60, 120))]
    docs = []
    for d in range(150):
        _, passage = items[rng.randrange(len(items))]
        words = passage.split()
        if d % 3 == 1 and len(words) > 30:
            words[rng.randrange(8, len(words) - 8)] = "changed"
        if d % 5 == 2:
            words = words[:len(words) // 2]
        docs.append((d, f"{text(rng.randrange(60))} {' '.join(words).upper()}, {text(rng.randrange(200))}"))
    found = {(r.doc_id, r.item_id): round(r.similarity, 9) for r in
             leaks(spark.createDataFrame(docs, "doc_id bigint, text string").repartition(4),
                   spark.createDataFrame(items, "item_id bigint, text string")).collect()}
    expected = brute(docs, items)
    assert set(found) <= set(expected)
    assert {k for k, v in expected.items() if v == 1.0} <= set(found)
    assert len(found) >= 0.97 * len(expected)


def test_blocks_of_the_benchmark_agree(documents, spark, sf_dir):
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    whole = {tuple(r) for r in leaks(documents, items).collect()}
    assert whole and whole == {tuple(r) for r in leaks(documents, items, block_items=7).collect()}
    bad = {r[0] for r in whole}
    assert {r.doc_id for r in without_leaks(documents, items, block_items=15).collect()} == \
        {r.doc_id for r in documents.collect()} - bad


def test_weights_count_over_all_blocks(spark):
    shared = " ".join(f"s{i}" for i in range(20))
    items = spark.createDataFrame([(i, f"{shared} " + " ".join(f"own{i}x{j}" for j in range(20))) for i in range(9)], "item_id bigint, text string")
    docs = spark.createDataFrame([(i, f"{shared} " + " ".join(f"own{i % 9}x{j}" for j in range(12 + i // 9))) for i in range(72)],
                                 "doc_id bigint, text string")
    whole = {tuple(r) for r in leaks(docs, items).collect()}
    assert 0 < len(whole) < 72 * 9 and whole == {tuple(r) for r in leaks(docs, items, block_items=1).collect()}


def test_passage_deep_in_a_long_text(spark):
    filler = " ".join(f"f{i}" for i in range(65_530))
    docs = spark.createDataFrame([(1, f"{filler} {' '.join(f'p{i}' for i in range(40))} {filler}"), (2, filler)], "doc_id bigint, text string")
    items = spark.createDataFrame([(5, " ".join(f"P{i}" for i in range(40)))], "item_id bigint, text string")
    assert [(r.doc_id, r.item_id, r.place) for r in leaks(docs, items).collect()] == [(1, 5, 65_530)]


def test_odd_rows(odd, empty, spark):
    schema = "item_id bigint, text string, doc_id int"
    items = spark.createDataFrame([(1, None, 0), (2, "", 0), (3, "...", 0), (None, "same words again and again in one", 0),
                                   (4, "One", 0), (4, "One", 0)], schema)
    rows = [(r.doc_id, r.item_id) for r in leaks(odd, items).collect()]
    assert rows.count((7, None)) == 2 and (4, 4) in rows and (5, 4) in rows
    assert {r[0] for r in rows} == {4, 5, 6, 7} - ({6} if (6, 4) not in rows else set())
    assert without_leaks(odd, items).columns == odd.columns
    assert leaks(empty, items).collect() == [] and leaks(odd, spark.createDataFrame([], schema)).collect() == []
    assert without_leaks(odd, spark.createDataFrame([], schema)).count() == odd.count()


def test_cut_passages_at_both_ends_and_alone(spark):
    rng = random.Random(8)
    vocabulary = [f"w{i}" for i in range(5_000)]
    text = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    shared = text(20)
    items = [(i, text(n)) for i, n in enumerate((6, 9, 13, 24, 49, 74, 112))] + [(20 + i, text(30) + shared) for i in range(2)]
    docs = []  # a passage cut at either end: alone, at the end and at the start of a text
    for _, words in items:
        n = len(words)
        for keep in range(n * 7 // 10, n + 1, max(1, n // 30)):
            for part in (words[:keep], words[n - keep:]):
                docs += [part, text(rng.randrange(1, 60)) + part, part + text(rng.randrange(1, 60))]
    index = decontam.Benchmark([(i, " ".join(w)) for i, w in items], 7)
    expected = {}
    for d, words in enumerate(docs):
        for number, (item, own) in enumerate(index.items):
            lies = {p - o for p in range(len(words)) for o in range(len(own)) if words[p:p + 5] == own[o:o + 5]}
            if lies:
                best = max(index.similarity(number, words[max(0, s):max(0, s + len(own))])
                           for s in {p + more for p in lies for more in range(-2, 3)} if s + len(own) > 0)
                if best >= 0.75:
                    expected[d, item] = round(best, 9)
    found = leaks(spark.createDataFrame([(d, " ".join(w)) for d, w in enumerate(docs)], "doc_id bigint, text string").repartition(4),
                  spark.createDataFrame([(i, " ".join(w)) for i, w in items], "item_id bigint, text string")).collect()
    found = {(r.doc_id, r.item_id): round(r.similarity, 9) for r in found}
    assert len(expected) > 300 and {k for k, v in expected.items() if found.get(k, 0) < v} == set()
    assert all(set(docs[d]) & set(dict(items)[i]) for d, i in found)
