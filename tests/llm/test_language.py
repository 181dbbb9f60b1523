from pyspark.sql import functions as F

from leadframe.llm import cross_parse
from leadframe.llm.cross_parse import Model, known, predict, train


def greedy(text, sample):
    """Phrases of the longest matches, by plain substring search."""
    count = at = 0
    while at < len(text):
        size = 1
        while at + size < len(text) and text[at:at + size + 1] in sample:
            size += 1
        count, at = count + 1, at + size
    return count


def test_phrases_are_longest_matches():
    samples = {"x": ["abracadabra abba cab"], "y": ["banana bandana cabana"]}
    model = Model(samples, 1000, 60)
    texts = ["abracadabra", "banana cab", "zzz", "nab", "a bandana abba"]
    stretches = [cross_parse._symbols(t, model.classes()) for t in texts]
    found = model.phrases(stretches)
    assert found.tolist() == [[greedy(t, samples[lang][0]) for lang in "xy"] for t in texts]


def test_letters_beyond_the_alphabet():
    """Every letter is told apart, however few have symbols of their own."""
    code = {c: chr(0x4E00 + 7 * i) for i, c in enumerate("abcdefghijklmnopqrstuvwxyz")} | {" ": " "}
    samples = {"x": ["abracadabra abba cab"], "y": ["banana bandana cabana"]}
    rare = {lang: ["".join(code[c] for c in t) for t in parts] for lang, parts in samples.items()}
    model = Model(rare, 10_000, 2)
    classes = model.classes()
    spelled = {lang: cross_parse._symbols(rare[lang][0], classes) for lang in rare}
    texts = ["".join(code[c] for c in t) for t in ("abracadabra", "banana cab", "zzz", "nab", "a bandana abba")]
    texts.append("\U0010ffff\U00020000 " + texts[0])
    stretches = [cross_parse._symbols(t, classes) for t in texts]
    assert model.phrases(stretches).tolist() == [
        [greedy(s.tobytes(), spelled[lang].tobytes()) for lang in "xy"] for s in stretches]
    langs, _ = cross_parse._judge(texts[:2], model, classes)
    assert langs == ["x", "y"]
    one, other = (cross_parse._symbols(chr(c), classes).tolist() for c in (0x4E00 + 7 * 3, 0x4E00 + 7 * 17))
    assert one != other and len(one) == len(other) == 1 + cross_parse.DIGITS
    assert cross_parse._symbols("\u5001\u5002", classes).tolist() == [cross_parse.OTHER] * 2


def test_scripts_of_many_letters(spark):
    """Languages that share a script and differ only in its rare letters."""
    import random

    draw = random.Random(7)
    scripts = {"p": [chr(0x4E00 + 2 * i) for i in range(400)], "q": [chr(0x4E01 + 2 * i) for i in range(400)]}
    often = [chr(0x3041 + i) for i in range(60)]
    rows = [(i, " ".join("".join(draw.choice(often if draw.random() < 0.8 else scripts[lang]) for _ in range(3))
                         for _ in range(80)), lang)
            for i, lang in enumerate(["p", "q"] * 60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    found = {r.doc_id: r.lang_pred for r in predict(docs).where("held_out").collect()}
    assert len(found) > 20 and all(found[i] == lang for i, _, lang in rows if i in found)


def test_held_out_accuracy(documents):
    rows = predict(documents).join(documents.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert len(rows) > 30
    assert sum(r.lang == r.lang_pred for r in rows) >= 0.95 * len(rows)
    assert all(0 <= r.score <= 1 for r in rows)


def test_folds(documents):
    import zlib

    rows = predict(documents).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)


def test_odd_rows(odd, empty):
    rows = predict(odd).collect()
    assert len(rows) == odd.count()
    for r in rows:
        assert (r.lang_pred == "und") == (r.doc_id in (1, 2, 3, 8)), r
        assert r.lang_pred in ("und", "en", "fr")
    kept = known(odd)
    assert kept.columns == odd.columns and kept.count() == odd.count() - 4
    assert predict(empty).collect() == [] and known(empty).collect() == []
    nameless = odd.withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in predict(nameless).collect()} == {"und"}
    assert train(empty).langs == []
