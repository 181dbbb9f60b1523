"""Personal data in texts: weak labelers, reliabilities by EM, a span classifier (operator 8).

Column expressions only.  What is collected are counts over fixed, small sets of
vote patterns and feature values.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize

#: Kinds in order, and the base pattern of each.  Possessive, and
#: entered at the start of a run or where the last match ended, they find what
#: the plain patterns find, but stay linear on long runs.
KINDS = ("email", "ip", "card", "phone")
BASE = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Spellings that the base patterns leave out.
LOOSE = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++\x20?(?:\(at\)|\[at\])\x20?[A-Za-z0-9-]++"
             r"(?:\x20?(?:\.|\(dot\)|\[dot\])\x20?[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]{1,3}+(?:(?:\[\.\]|\(\.\)|\[dot\]|\(dot\))[0-9]{1,3}+){3}(?![0-9])",
    "card": r"(?<![0-9])(?:[0-9]{4}(?:[./_][0-9]{4}){3}|3[47][0-9]{2}[\x20-]?[0-9]{6}[\x20-]?[0-9]{5})(?![0-9])",
    "phone": r"(?<![0-9+.])(?:\([0-9]{2,4}\)|[0-9]{2,4})[\x20.-][0-9]{3,4}[\x20.-][0-9]{3,4}(?![0-9]|[.-][0-9])",
}
#: What a text must have for a pattern to be worth a scan.
NEEDS = {"email": "@", "ip": ".", "card": None, "phone": "+"}
OCTET = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"

#: Gazetteers: words before a span that speak for or against it, and values that do.
CUES = {
    "email": ("e-?mail|mail|contact|write|courriel|correo", "version|commit"),
    "ip": ("ip|host|server|address|adresse|client", "version|release|section|chapter|build"),
    "card": ("card|visa|mastercard|amex|credit|karte|carte|tarjeta", "order|invoice|isbn|serial|sku|tracking"),
    "phone": ("tel|phone|call|fax|mobile|telefon|t[eé]l[eé]phone|tel[eé]fono", "order|invoice|isbn|serial|version|page"),
}
VALUES = {
    "email": r"(?i)\.(?:com|org|net|edu|gov|info|io|de|fr|es|uk|eu|us|ca|it|nl|ch|at)$",
    "ip": r"^(?!0+\D|255\D|127\D)", "card": r"^[3-6]", "phone": r"^\(?\+?[1-9]",
}
LABELERS = 5
#: Features of a span and how many values each has: shape, neighbours, length, and the votes that don't ask for the base.
BLOCKS = (64, 5, 5, 16, 3, 3, 3, 3)
OFFSETS = tuple(sum(BLOCKS[:i]) for i in range(len(BLOCKS)))
WIDTH = sum(BLOCKS)

_SPAN = "array<struct<kind:int,s:int,e:int,t:string,before:string,after:string,base:boolean>>"


def _places(text: Column, pattern: str, kind: int, base: bool) -> Column:
    """Matches with their code points and surroundings: what lies between them is what a split leaves.

    What is read more than once is bound by a one-element transform, so that it
    is computed once.  Starts are summed in blocks of about as many matches as
    there are blocks, so that no growing array is copied for every match.
    """
    def running(lengths: Column) -> Column:
        """Sum of the lengths before each of them, and of all."""
        begin = F.struct(F.lit(0).alias("sum"), F.array().cast("array<int>").alias("at"))
        return F.aggregate(lengths, begin, lambda done, n: F.struct(
            (done.sum + n).alias("sum"), F.concat(done.at, F.array(done.sum)).alias("at")))

    def starts_of(cut: Column) -> Column:
        step = F.ceil(F.sqrt(F.size(cut.found))).cast("int")
        lengths = lambda first: F.transform(F.sequence(first, F.least(first + step, F.size(cut.found)) - 1),
                                            lambda i: F.length(F.get(cut.gaps, i)) + F.length(F.get(cut.found, i)))
        blocks = F.transform(F.sequence(F.lit(0), F.size(cut.found) - 1, step), lambda first: running(lengths(first)))

        def joined(own: Column) -> Column:
            before = running(F.transform(own, lambda block: block.sum)).at
            moved = lambda ahead: F.transform(own, lambda block, b: F.transform(block.at, lambda at: at + F.get(ahead, b)))
            ends_of_last = F.flatten(F.transform(F.array(before), lambda ahead: F.flatten(moved(ahead))))
            return F.transform(ends_of_last, lambda end, i: end + F.length(F.get(cut.gaps, i)))
        return F.flatten(F.transform(F.array(blocks), joined))

    def spans(cut: Column, starts: Column) -> Column:
        def span(found: Column, i: Column) -> Column:
            gap, start = F.get(cut.gaps, i), F.get(starts, i)
            return F.struct(F.lit(kind).alias("kind"), start.alias("s"), (start + F.length(found)).alias("e"), found.alias("t"),
                            F.substr(gap, F.greatest(F.length(gap) - 29, F.lit(1)), F.lit(30)).alias("before"),
                            F.substr(F.get(cut.gaps, i + 1), F.lit(1), F.lit(1)).alias("after"), F.lit(base).alias("base"))
        return F.transform(cut.found, span)

    def placed(cut: Column) -> Column:
        return F.flatten(F.transform(F.array(starts_of(cut)), lambda own: spans(cut, own)))

    cuts = F.array(F.struct(F.split(text, pattern, -1).alias("gaps"),
                            F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("found")))
    return F.flatten(F.transform(F.filter(cuts, lambda cut: F.size(cut.found) > 0), placed))


def luhn(digits: Column) -> Column:
    """Whether up to 19 digits pass the check sum."""
    padded = F.lpad(digits, 19, "0")
    total = F.lit(0)
    for i in range(1, 20):
        d = F.substring(padded, i, 1).cast("int")
        total = total + (d if i % 2 else F.when(d > 4, 2 * d - 9).otherwise(2 * d))
    return total % 10 == 0


def passes(kind: int, found: Column) -> Column:
    """The check of a kind on a base match."""
    digits = F.regexp_replace(found, "[^0-9]", "")
    return (F.lit(True), found.rlike(rf"^{OCTET}(?:\.{OCTET}){{3}}$"),
            F.length(digits).between(16, 19) & F.when(F.length(digits) <= 19, luhn(digits)).otherwise(F.lit(False)),
            F.length(digits).between(8, 15))[kind]


def base_spans(text: Column) -> Column:
    """Leftmost, non-overlapping matches of each kind that pass its check, by kind and start."""
    def of(kind: int, name: str) -> Column:
        worth = text.contains(NEEDS[name]) if NEEDS[name] else text.rlike("[0-9]")
        found = F.filter(_places(text, BASE[name], kind, True), lambda m: passes(kind, m.t))
        return F.when(worth, found).otherwise(F.array().cast(_SPAN))

    return F.concat(*[of(kind, name) for kind, name in enumerate(KINDS)])


def loose_spans(text: Column, base: Column) -> Column:
    """Matches of the looser patterns that no base span touches."""
    marks = {"email": text.rlike(r"[(\[]at[)\]]"), "ip": text.rlike(r"[0-9][(\[](?:\.|dot)[)\]][0-9]"),
             "card": text.rlike("[0-9]{4}"), "phone": text.rlike(r"[0-9][\x20.-][0-9]{3}")}
    parts = [F.when(marks[name], _places(text, LOOSE[name], kind, False)).otherwise(F.array().cast(_SPAN))
             for kind, name in enumerate(KINDS)]
    return F.filter(F.concat(*parts), lambda m: ~F.exists(base, lambda b: (b.s < m.e) & (m.s < b.e)))


def _by_kind(kind: Column, values) -> Column:
    out = F.lit(None)
    for number, value in enumerate(values):
        out = F.when(kind == number, value).otherwise(out)
    return out


def _vote(yes: Column, no: Column) -> Column:
    return F.when(yes, 2).when(no, 0).otherwise(1)


def _digits_fit(m: Column) -> Column:
    digits = F.regexp_replace(m.t, "[^0-9]", "")
    plain = F.regexp_replace(m.t, r"[\[\](){}]|dot", "")
    return _by_kind(m.kind, [F.length(m.t) <= 254, F.regexp_replace(plain, r"\.+", ".").rlike(rf"^{OCTET}(?:\.?{OCTET}){{3}}$"),
                             F.length(digits).between(13, 19) & luhn(F.substring(digits, 1, 19)),
                             F.length(digits).between(8, 15)])


def ballots(m: Column) -> list[Column]:
    """What each labeler says of a span: 0 no, 1 nothing, 2 yes."""
    cue = [F.lower(m.before).rlike(rf"\b(?:{CUES[k][0]})\b\W*(?:\w+\W+)?$") for k in KINDS]
    anti = [F.lower(m.before).rlike(rf"\b(?:{CUES[k][1]})\b\W*(?:\w+\W+)?$") for k in KINDS]
    fit, value = _digits_fit(m), _by_kind(m.kind, [m.t.rlike(VALUES[k]) for k in KINDS])
    free = ~m.before.rlike(r"[\w/#=@-]$") & ~m.after.rlike(r"[\w/#=@]")
    return [_vote(m.base, F.lit(False)), _vote(fit, ~fit), _vote(_by_kind(m.kind, cue), _by_kind(m.kind, anti)),
            _vote(free, ~free), _vote(value, ~value)]


def votes(m: Column) -> Column:
    """Number of the vote pattern of a span."""
    out = F.lit(0)
    for one in ballots(m):
        out = out * 3 + one
    return out


def features(m: Column) -> list[Column]:
    """Feature numbers of a span, each within a range of its own below WIDTH."""
    shape = F.regexp_replace(F.regexp_replace(m.t, "[A-Za-z]+", "a"), "[0-9]+", "9")
    end = lambda c: F.when(c == "", 0).when(c.rlike(r"\s"), 1).when(c.rlike("[0-9]"), 2).when(c.rlike(r"\w"), 3).otherwise(4)
    values = [F.pmod(F.xxhash64(shape), F.lit(BLOCKS[0])).cast("int"), end(F.right(m.before, F.lit(1))), end(m.after),
              F.least(F.floor(F.length(m.t) / 4), F.lit(BLOCKS[3] - 1)).cast("int"), *ballots(m)[1:]]
    return [offset + value for offset, value in zip(OFFSETS, values)]


def reliabilities(counts: dict[int, int], rounds: int = 50) -> dict[int, float]:
    """Probability that a span with a vote pattern is right, by expectation-maximisation over pattern counts.

    Labelers are independent given the truth.  Each starts out believed when it
    votes and keeps the weight of ten such votes, so classes cannot swap.
    """
    prior = ((6.0, 3.0, 1.0), (1.0, 3.0, 6.0))  # no, nothing, yes: of wrong spans, of right spans
    share, table = 0.5, [[[p / 10 for p in prior[y]] for _ in range(LABELERS)] for y in (0, 1)]
    digits = {p: [p // 3 ** (LABELERS - 1 - j) % 3 for j in range(LABELERS)] for p in range(3 ** LABELERS)}

    def right(pattern: int) -> float:
        odds = math.log(share / (1 - share))
        for j, v in enumerate(digits[pattern]):
            odds += math.log(table[1][j][v] / table[0][j][v])
        return 1 / (1 + math.exp(-max(-500.0, min(500.0, odds))))

    for _ in range(rounds):
        belief = {p: right(p) for p in counts}
        total = sum(counts.values())
        share = (sum(counts[p] * belief[p] for p in counts) + 1) / (total + 2)
        for y in (0, 1):
            for j in range(LABELERS):
                cells = list(prior[y])
                for p, n in counts.items():
                    cells[digits[p][j]] += n * (belief[p] if y else 1 - belief[p])
                table[y][j] = [c / sum(cells) for c in cells]
    return {p: right(p) for p in range(3 ** LABELERS)}


def train(candidates: DataFrame) -> list[float]:
    """Log odds of every kind's prior and feature values, from (kind, votes, features) of all candidates."""
    kept = materialize(candidates, "spans")
    counted = kept.groupBy("kind", "votes").agg(F.count("*").alias("n")).collect()  # at most 4 × 3^5 rows
    belief = []
    for kind in range(len(KINDS)):
        right = reliabilities({r.votes: r.n for r in counted if r.kind == kind})
        belief += [right[p] for p in range(3 ** LABELERS)]
    known = F.split(F.lit(",".join(map(repr, belief))), ",").cast("array<double>")
    rated = kept.withColumn("p", F.get(known, F.col("kind") * 3 ** LABELERS + F.col("votes")))
    sums = rated.select("kind", "p", F.explode(F.concat("features", F.array(F.lit(WIDTH)))).alias("f")) \
        .groupBy("kind", "f").agg(F.sum("p").alias("yes"), F.sum(1 - F.col("p")).alias("no")).collect()
    found = {(r.kind, r.f): (r.yes, r.no) for r in sums}  # at most 4 × (WIDTH + 1) rows
    odds = []
    for kind in range(len(KINDS)):
        all_yes, all_no = found.get((kind, WIDTH), (0.0, 0.0))
        for block in range(len(BLOCKS)):
            few = 0.1 * BLOCKS[block]
            for f in range(OFFSETS[block], OFFSETS[block] + BLOCKS[block]):
                yes, no = found.get((kind, f), (0.0, 0.0))
                odds.append(math.log((yes + 0.1) / (all_yes + few)) - math.log((no + 0.1) / (all_no + few)))
        odds.append(math.log((all_yes + 1) / (all_no + 1)))
    return odds


def _score(m: Column, odds: Column) -> Column:
    at = m.kind * (WIDTH + 1)
    total = F.get(odds, at + WIDTH)
    for f in features(m):
        total = total + F.get(odds, at + f)
    return 1 / (1 + F.exp(-total))


def _listed(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.concat_ws(",", F.transform(spans, lambda m: F.concat_ws(
        ":", F.get(names, m.kind), m.s.cast("string"), m.e.cast("string"))))


def find(docs: DataFrame, threshold: float = 0.9) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans for every document.

    The counts and ``base_sha256`` are of the base spans; ``spans`` lists these
    and the added ones as kind:start:end in code points, by kind, then start.
    Candidates for addition come from looser patterns.  Five labelers vote on all
    candidates of the corpus (base pattern, digits and check sums, cue words
    before the span, its neighbours, gazetteers of values); EM estimates how far
    to trust each, and its probabilities train a naive Bayes classifier on the
    span's shape, neighbours, length and votes, which adds from ``threshold`` on.

    Null and empty text have no spans.  Repeated rows are judged alike, an empty
    table gives an empty result, other columns are ignored.
    """
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", text.alias("_text")).withColumn("_base", base_spans(F.col("_text"))) \
        .withColumn("_loose", loose_spans(F.col("_text"), F.col("_base"))).drop("_text")
    spans = rows.where((F.size("_base") > 0) | (F.size("_loose") > 0)) \
        .select(F.explode(F.concat("_base", "_loose")).alias("m"))
    odds = train(spans.select(F.col("m.kind"), votes(F.col("m")).alias("votes"),
                              F.array(*features(F.col("m"))).alias("features")))
    known = F.split(F.lit(",".join(map(repr, odds))), ",").cast("array<double>")
    added = F.filter("_loose", lambda m: _score(m, known) >= threshold)
    every = F.array_sort(F.concat("_base", "_added"),
                         lambda a, b: F.when(a.kind != b.kind, a.kind - b.kind).otherwise(a.s - b.s))

    def count(kind: int) -> Column:
        return F.size(F.filter("_base", lambda m: m.kind == kind)).cast("long").alias(f"n_{KINDS[kind]}")

    counts = [count(kind) for kind in range(len(KINDS))]
    return rows.withColumn("_added", added).select(
        "doc_id", *counts, F.sha2(_listed(F.col("_base")).cast("binary"), 256).alias("base_sha256"),
        _listed(F.when(F.size("_added") > 0, every).otherwise(F.col("_base"))).alias("spans"))
