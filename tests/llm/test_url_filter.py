import math

import pytest
import xxhash

from leadframe.llm import url_filter
from leadframe.llm.url_filter import judge, labelled, train


@pytest.fixture(scope="module")
def model(spark):
    return train(labelled(spark))


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = rest
    for mark in "/?#":
        host = host.split(mark)[0]
    path = rest[len(host):].split("?")[0].split("#")[0]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


def rule(host, path):
    best = (None, None)
    for verdict, text in url_filter.RULES:
        domain, start = text.split("/", 1)
        if (host == domain or host.endswith("." + domain)) and path.startswith("/" + start):
            if best[1] is None or len(text) > len(best[1]):
                best = (verdict, text)
    return best


def score(host, path, model):
    weights, total = model
    for mark, part in (("h", host), ("p", path)):
        letters = "^" + part + "$"
        for n in url_filter.GRAMS:
            for i in range(max(0, len(letters) - n) + 1):
                digest = xxhash.xxh64_intdigest((mark + letters[i:i + n]).encode(), seed=42)
                total += weights[(digest - (1 << 64) if digest >> 63 else digest) % len(weights)]
    return 1 / (1 + math.exp(-total))


def agree(rows, urls, model):
    assert len(rows) == len(urls)
    for r in rows:
        host, path = parts(urls[r.page_id])
        assert (r.host, r.path) == (host, path)
        verdict, text = rule(host, path)
        assert r.rule == text and r.score == pytest.approx(score(host, path, model))
        assert r.verdict == (verdict or ("block" if r.score >= 0.5 else "allow"))


def test_given_pages(spark, sf_dir, model):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    agree(judge(pages, model=model).collect(), {r.page_id: r.url for r in pages.collect()}, model)


def test_odd_urls(spark, model):
    urls = [None, "", "no scheme", "http://", "HTTP://A.Example.NET/en/x", "https://net", "https://net/", "x://y.net?q/z", "a://b://c/d",
            "http://example.com/de/", "http://notexample.com/de/", "http://sub.example.com/de", "http://é.ORG/fr/ü#ä?ö", "://org/fr/",
            "http://host/" + "long" * 40_000, "http://x.org/fr/?a", "http://x.net/EN/", "http://example.net/en", "http://a\nb/c\nd"]
    pages = spark.createDataFrame([(i, u, "p", 1.0, "h") for i, u in enumerate(urls)], "page_id bigint, url string, path string, score double, host string")
    agree(judge(pages, model=model).collect(), dict(enumerate(urls)), model)
    assert judge(pages.limit(0), model=model).collect() == []
    twice = judge(pages.unionByName(pages), model=model).collect()
    assert len(twice) == 2 * len(urls) and len(set(twice)) == len(urls)
    assert judge(spark.createDataFrame([(None, "http://q.io/")], "page_id bigint, url string"), model=model).head().page_id is None


def test_training_table(spark, model):
    table = labelled(spark)
    right = [(score(*parts(r.url), model) >= 0.5) == (r.unwanted == 1) for r in table.collect()]
    assert sum(right) >= 0.95 * len(right)


def test_held_out_rows(spark):
    """Every row judged by a model that has not seen it: at least nine of ten are right (0.96 when written)."""
    import random

    draw = random.Random(1)
    table = [(r.url, r.unwanted, draw.randrange(4)) for r in labelled(spark).collect()]
    right = 0
    for fold in range(4):
        model = url_filter.train(spark.createDataFrame([r[:2] for r in table if r[2] != fold], "url string, unwanted double"))
        right += sum((score(*parts(url), model) >= 0.5) == (unwanted == 1) for url, unwanted, own in table if own == fold)
    assert right >= 0.9 * len(table)
