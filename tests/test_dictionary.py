import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from leadframe.functions import dictionaries as d
from leadframe.functions import rules
from leadframe.operators import dictionary
from leadframe.operators.dictionary import dictionary_hits
from leadframe.sources import files

SCHEMA = "`group` string, name string, pattern string"


def hits(rows, entries, **kw):
    return {tuple(r) for r in dictionary_hits(rows, "k", "t", entries, **kw).collect()}


@pytest.mark.parametrize("chars", [2_000_000, 40])
def test_same_entries_as_the_literal_dictionary(spark, sf_dir, chars):
    groups = {"strong": d.SHOP_STRONG, "soft": d.SHOP_SOFT, "provider": d.PROVIDER_STRONG}
    entries = spark.createDataFrame([(g, n, p) for g, names in groups.items() for n, p in names.items()], SCHEMA)
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "html")
    phrase = F.element_at(F.array(*[F.lit(x) for x in ("Add to CART for € 20", "rest API sdk", "sdks", "bestseller, lagerhaltung", "")]), (F.col("page_id") % 5 + 1).cast("int"))
    rows = pages.select(F.col("page_id").alias("k"), F.concat("html", phrase).alias("t"))
    want = set()
    for g, names in groups.items():
        listed = rows.select("k", F.explode(rules.matched_names(F.lower("t"), names)).alias("n")).collect()
        want |= {(r.k, g, r.n) for r in listed}
    assert want and hits(rows, entries, block_chars=chars) == want


def test_whole_words(spark):
    entries = spark.createDataFrame([("g", "a", "Red Car"), ("g", "b", "car"), ("h", "c", "é"), ("h", "d", " "), ("h", "e", None), ("g", "b", "auto")], SCHEMA)
    rows = spark.createDataFrame([(1, "a red car."), (2, "cars red_car scar"), (3, "CAR,car;Auto"), (4, None), (5, ""), (6, "é"), (7, "été")], "k int, t string")
    assert hits(rows, entries, whole_words=True) == {(1, "g", "a"), (1, "g", "b"), (3, "g", "b"), (6, "h", "c")}
    assert hits(rows, entries.limit(0)) == set()


def test_more_than_ten_thousand_entries(spark):
    draw = random.Random(4)
    words = {"".join(draw.choices("abcdeé", k=draw.randrange(3, 8))) for _ in range(30_000)}
    entries = spark.createDataFrame([(w[0], w, w) for w in sorted(words)], SCHEMA)
    texts = {i: " ".join("".join(draw.choices("abcdeé", k=draw.randrange(3, 8))) for _ in range(50)) for i in range(100)}
    rows = spark.createDataFrame(list(texts.items()), "k int, t string").repartition(4)
    want = {(k, w[0], w) for k, t in texts.items() for w in re.findall(r"\w+", t) if w in words}
    assert len(words) > 10_000 and hits(rows, entries, whole_words=True) == want == hits(rows, entries, whole_words=True, block_chars=20_000)


ODD_WORDS = [("g", "a", "Red Car"), ("g", "b", "car"), ("g", "b", "auto"), ("g", "b", "CAR"), (None, "n", "c++"), ("h", None, ".net"), ("h", "p", "--"), ("h", "q", "a - b c"),
             ("h", "r", "é"), ("h", "s", " x"), ("h", "t", "x_1"), ("h", "u", " - "), ("h", "v", "\t"), ("h", "d", " "), ("h", "e", None), ("k", "b", "car")]


@pytest.mark.parametrize("held", [0, 5, 200_000])
def test_whole_words_joined(spark, monkeypatch, held):
    """Phrases, signs at the edges and rows that repeat a key give the same hits whether the dictionary is held or joined."""
    monkeypatch.setattr(dictionary, "HELD_CHARS", held)
    draw = random.Random(8)
    parts = ["red", "car", "Auto", "c", "++", "+", ".", "net", " ", " ", "-", "--", "a", "b", "é", "x", "x_1", "\t", "\n", "٣"]
    texts = [None, "", "c++", "--", "a - b c", "car car", " x", "-", "a -- b", "a--b", "\t", *["".join(draw.choices(parts, k=draw.randrange(1, 14))) for _ in range(400)]]
    keys = [None if i % 50 == 7 else i // 3 for i in range(len(texts))]

    def places(text, pattern):
        at, text, pattern = -1, text.lower(), pattern.lower()
        while (at := text.find(pattern, at + 1)) >= 0:
            yield re.fullmatch(r"\w", text[at - 1:at] if at else "") is None and re.match(r"\w", text[at + len(pattern):]) is None

    want = Counter((k, g, n) for k, t in zip(keys, texts)
                   for g, n in {(g, n) for g, n, p in ODD_WORDS if t and p and p != " " and any(places(t, p))})
    rows = spark.createDataFrame(list(zip(keys, texts)), "k int, t string").repartition(3)
    for entries in (ODD_WORDS, [e for e in ODD_WORDS if e[:2] != ("g", "b")]):
        got = Counter(tuple(r) for r in dictionary_hits(rows, "k", "t", spark.createDataFrame(entries, SCHEMA), whole_words=True).collect())
        assert got and got == {x: n for x, n in want.items() if x[1:] in {e[:2] for e in entries}}


def test_large_dictionary_stays_off_the_driver(spark, monkeypatch):
    """Before, a dictionary of whole words was compiled on the driver, however large."""
    def compiled(*_):
        raise AssertionError("compiled on the driver")

    monkeypatch.setattr(dictionary, "_compiled", compiled)
    entries = spark.range(60_000).selectExpr("'g' AS `group`", "concat('w', id) AS name", "concat('w', id) AS pattern")
    rows = spark.createDataFrame([(1, "w1 W59999, w60000 xw2"), (2, None), (3, "w1")], "k int, t string")
    assert hits(rows, entries, whole_words=True) == {(1, "g", "w1"), (1, "g", "w59999"), (3, "g", "w1")}


def test_read_dictionary(spark, tmp_path):
    (tmp_path / "one.json").write_text('{"maybe": {"a": "x\\\\s?y",\n "b": "z"}}', encoding="utf-8")
    (tmp_path / "two.json").write_text('{"no": {"a": "q"}}', encoding="utf-8")
    assert {tuple(r) for r in files.read_dictionary(spark, str(tmp_path)).collect()} == {("maybe", "a", r"x\s?y"), ("maybe", "b", "z"), ("no", "a", "q")}
    assert files.load_dictionary(spark, str(tmp_path / "two.json")) == {"no": {"a": "q"}}
