"""URL verdicts: host rules, else logistic regression on hashed n-grams (operator 6).

Column expressions and Spark's own logistic regression only.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import lower_ascii

#: (verdict, rule): a host, a slash and the start of a path.
RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))
GRAMS = (3, 4)
BUCKETS = 4096

#: The small labelled table the model is trained from, 1 = unwanted.
UNWANTED = (
    "cheap-pills.example/buy", "pills-online.example/order?now", "buy-meds-now.example/shop", "spam-farm.example/p/1",
    "link-farm.example/out", "seo-spam.example/en/1", "casino-royal.example/play", "best-casino.example/bonus",
    "free-money.example/win", "win-prizes.example/claim", "hot-singles.example/chat", "adult-cams.example/live",
    "xxx-videos.example/watch", "fast-loans.example/apply", "payday-loan.example/now", "replica-watches.example/sale",
    "crack-keygen.example/download", "torrent-warez.example/get", "click-bait.example/shock", "free-gift-card.example/go",
    "cheap-replica.example/bags", "viagra-store.example/buy", "slots-jackpot.example/spin", "bitcoin-doubler.example/x2",
    "spam-links.example/a/b", "cheap-tickets-scam.example/buy", "phish-login.example/verify", "malware-drop.example/exe",
)
WANTED = (
    "www.example/en/1", "blog.example/post/12", "news.example/world/today", "docs.example/guide/start.html",
    "en.wiki.example/page/Tree", "m.example/fr/25", "shop.example/de/home", "library.example/books/88",
    "school.example/math/algebra", "museum.example/es/visit", "city.example/council/minutes", "forum.example/thread/93",
    "recipes.example/soup/leek", "travel.example/fr/lyon", "science.example/papers/7", "weather.example/en/414",
    "university.example/courses", "garden.example/plants/rose", "music.example/artists/3", "sports.example/results",
    "history.example/articles/rome", "health.example/advice/sleep", "code.example/project/readme", "photo.example/gallery",
    "therin.example/en/770", "stories.example/es/797", "kitchen.example/671.html", "river.example/blog/533",
)
#: Further rows are made from words: what unwanted addresses advertise, and what others are about.
SOLD = ("pills viagra meds casino poker slots jackpot betting roulette bonus loan payday credit bitcoin crypto replica watches torrent "
        "warez crack keygen xxx adult cams singles escort prizes lottery giftcard malware phishing spam adserver banner tracker popup").split()
LURES = "cheap free best fast hot win buy get online now deal cash".split()
TOPICS = ("garden history science museum library school weather recipes travel music sports health news forum photo art river "
          "forest city council books language physics cooking letters theatre geography astronomy village farming bridge harbour "
          "poetry chess railway orchard").split()
SECTIONS = "en de fr es article page blog post guide item".split()
FRONTS = ("", "www.", "m.", "shop.")
ENDINGS = ("com", "org", "net", "example.com", "example.org", "de", "co.uk", "example.net")


def _made() -> Iterator[tuple[str, float]]:
    """Three addresses of each kind for every word, in changing company; fronts, endings and sections tell nothing."""
    for i, (sold, topic) in enumerate(zip(SOLD, TOPICS)):
        for j in range(3):
            n = 5 * i + 7 * j
            front, end, section = FRONTS[n % 4], ENDINGS[(n // 2) % 8], SECTIONS[(3 * i + j) % 10]
            lure, other = LURES[n % 12], TOPICS[(7 * i + 11 * j + 2) % len(TOPICS)]
            yield f"{front}{lure}-{sold}.{end}/{section}/{37 * n}", 1.0
            yield f"{front}{topic}-{other}.{end}/{section}/{37 * n}" if j else f"{front}{topic}.{end}/{section}/{37 * n}", 0.0


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host between the first ``://`` and ``/``, ``?``, ``#`` or the end, A-Z in lower case; path up to ``?`` or ``#``."""
    at = F.locate("://", F.coalesce(url, F.lit("")))
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    return lower_ascii(host), F.regexp_extract(rest, r"^[^/?#]*+([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(verdict, rule) of the longest rule that fits the host or a parent domain and the start of the path."""
    found, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for answer, rule in sorted(rules, key=lambda r: len(r[1])):
        domain, _, start = rule.partition("/")
        fits = ((host == domain) | host.endswith("." + domain)) & path.startswith("/" + start)
        found, verdict = F.when(fits, F.lit(rule)).otherwise(found), F.when(fits, F.lit(answer)).otherwise(verdict)
    return verdict, found


def grams(host: Column, path: Column, sizes=GRAMS, buckets: int = BUCKETS) -> Column:
    """Buckets of the character n-grams of host and path; the two ends of each count as characters.

    Characters are taken from an array, so long addresses stay linear.
    """
    def gram(letters: Column, mark: str, n: int):
        def at(i: Column) -> Column:
            part = [F.coalesce(F.get(letters, i + k), F.lit("")) for k in range(n)]
            return F.pmod(F.xxhash64(F.concat(F.lit(mark), *part)), F.lit(buckets)).cast("int")
        return at

    def of(mark: str, part: Column) -> Column:
        letters = F.array(F.split(F.concat(F.lit("^"), part, F.lit("$")), ""))
        return F.flatten(F.transform(letters, lambda own: F.concat(*[  # bound here, so split once
            F.transform(F.sequence(F.lit(0), F.greatest(F.size(own) - n, F.lit(0))), gram(own, mark, n)) for n in sizes])))

    return F.concat(of("h", host), of("p", path))


def labelled(spark: SparkSession) -> DataFrame:
    """The labelled table (url, unwanted)."""
    rows = [*[(u, 1.0) for u in UNWANTED], *[(u, 0.0) for u in WANTED], *_made()]
    return spark.createDataFrame([(f"https://{u}", label) for u, label in rows], "url string, unwanted double")


def train(table: DataFrame, buckets: int = BUCKETS, penalty: float = 0.001, rounds: int = 25,
          most_rows: int = 10_000) -> tuple[list[float], float]:
    """Weights of the buckets and the intercept from a small labelled table (url, unwanted).

    At most ``most_rows`` labelled rows are used; there the counts of the
    n-grams go through the driver into one small table of sparse vectors.
    """
    host, path = host_and_path(F.col("url"))
    rows = table.where("url IS NOT NULL AND unwanted IS NOT NULL") \
        .select("unwanted", grams(host, path, buckets=buckets).alias("grams")).limit(most_rows).collect()
    counted = [(r.unwanted, Vectors.sparse(buckets, sorted(Counter(r.grams).items()))) for r in rows]
    ready = table.sparkSession.createDataFrame(counted, ["unwanted", "features"]).coalesce(1)
    model = LogisticRegression(labelCol="unwanted", regParam=penalty, maxIter=rounds, standardization=False).fit(ready)
    return [float(w) for w in model.coefficients], float(model.intercept)


def judge(pages: DataFrame, rules=RULES, model: tuple[list[float], float] | None = None,
          threshold: float = 0.5) -> DataFrame:
    """page_id, host, path, rule, verdict, score for every row of ``pages``.

    ``score`` is the model's probability that the address is unwanted; from
    ``threshold`` on it blocks, unless a rule decides.  A null address or one
    without ``://`` has empty host and path and is judged by the model on these.
    Rows are independent: repeated rows are judged alike, an empty table gives
    an empty result, other columns are ignored.
    """
    weights, intercept = model or train(labelled(pages.sparkSession))
    host, path = host_and_path(F.col("url"))
    rows = pages.select("page_id", host.alias("host"), path.alias("path"))
    # one literal text, folded into one constant array; thousands of literals would slow down planning
    weight = F.split(F.lit(",".join(map(repr, weights))), ",").cast("array<double>")
    sum_of = F.aggregate(grams(F.col("host"), F.col("path"), buckets=len(weights)), F.lit(intercept),
                         lambda s, g: s + F.get(weight, g))
    verdict, rule = rule_of(F.col("host"), F.col("path"), rules)
    return rows.withColumn("score", 1 / (1 + F.exp(-sum_of))) \
        .select("page_id", "host", "path", rule.alias("rule"),
                F.coalesce(verdict, F.when(F.col("score") >= threshold, "block").otherwise("allow")).alias("verdict"),
                "score")
