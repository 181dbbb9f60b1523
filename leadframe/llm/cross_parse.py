"""Language of texts by cross-parsing entropy (operator 2).

A suffix automaton of labelled text per language cuts a text into the longest
phrases that occur in the labelled text; the language that needs the fewest
phrases, normalised by the length of its labelled text, wins.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Sent, column, only, shipped

UNKNOWN = "und"
#: Symbol numbers: between words, a letter of no sample, and the mark of a letter beyond the alphabet, which six digits
#: of its code point follow; then the digits, the letters of the alphabet, and filler after a text's end.
GAP, OTHER, RARE, DIGIT = 0, 1, 2, 3
BASE, DIGITS = 11, 6
FIRST = DIGIT + BASE
STRETCH = 2048
LANES = 1024


def suffix_automaton(symbols: list[int]) -> list[dict[int, int]]:
    """Transitions of the states; state 0 is the root, every path from it spells a substring."""
    nexts: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for symbol in symbols:
        now = len(nexts)
        nexts.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and symbol not in nexts[p]:
            nexts[p][symbol] = now
            p = link[p]
        if p >= 0:
            q = nexts[p][symbol]
            if length[p] + 1 == length[q]:
                link[now] = q
            else:
                clone = len(nexts)
                nexts.append(dict(nexts[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and nexts[p].get(symbol) == q:
                    nexts[p][symbol] = clone
                    p = link[p]
                link[q] = link[now] = clone
        last = now
    return nexts


def letters_only(text: str) -> str:
    return "".join(c if c.isalpha() else " " for c in text.lower())


class Model:
    """The automata of all languages in one table: state and symbol → next state and whether a phrase begins."""

    def __init__(self, samples: dict[str, list[str]], chars: int, alphabet: int):
        texts = {lang: " ".join(" ".join(letters_only(t).split()) for t in parts)[:chars]
                 for lang, parts in sorted(samples.items())}
        seen = Counter(c for t in texts.values() for c in t if c != " ")
        known = sorted(seen, key=lambda c: (-seen[c], c))[:alphabet]
        self.symbol = dict.fromkeys(seen, RARE) | {c: i + FIRST for i, c in enumerate(known)} | {" ": GAP}
        self.filler = len(known) + FIRST
        self.langs = list(texts)
        spelled = [_spelled(np.array([self.symbol[c] for c in t], np.uint8),
                            np.array([ord(c) for c in t], np.uint32))[:chars].tolist() for t in texts.values()]
        self.cost = np.array([math.log2(len(t) + 1) for t in spelled])
        tables, self.roots, offset = [], [], 0
        for text in spelled:
            nexts = suffix_automaton(text)
            root = np.zeros(self.filler + 1, np.int32)
            for symbol, state in nexts[0].items():
                root[symbol] = state
            table = np.tile((root + offset) * 2 + 1, (len(nexts), 1))  # no such path: a phrase begins here
            for state, paths in enumerate(nexts[1:], 1):
                for symbol, to in paths.items():
                    table[state, symbol] = (to + offset) * 2
            table[:, self.filler] = (np.arange(len(nexts)) + offset) * 2
            self.roots.append(offset)
            offset += len(nexts)
            tables.append(table.astype(np.int32))
        self.table = np.concatenate(tables) if tables else np.zeros((0, self.filler + 1), np.int32)

    def classes(self) -> np.ndarray:
        """Symbol of every code point; 255 marks what stands between words."""
        of = np.full(0x110000, 255, np.uint8)
        for c in range(0x110000):
            if chr(c).isalpha():
                of[c] = OTHER
        for c, symbol in self.symbol.items():
            if c != " ":
                of[ord(c)] = symbol
        of[of == 255] = GAP
        return of

    def phrases(self, stretches: list[np.ndarray]) -> np.ndarray:
        """Phrases of each stretch in each language; all stretches advance together, symbol by symbol."""
        out = np.zeros((len(stretches), len(self.langs)), np.int64)
        order = np.argsort([len(s) for s in stretches], kind="stable")
        width, flat = self.filler + 1, self.table.ravel()
        for at in range(0, len(order), LANES):
            some = order[at:at + LANES]
            longest = len(stretches[some[-1]])
            symbols = np.full((longest, len(some)), self.filler, np.int32)
            for lane, i in enumerate(some):
                symbols[:len(stretches[i]), lane] = stretches[i]
            state = np.repeat(np.array(self.roots, np.int32)[:, None], len(some), axis=1)
            count = np.zeros(state.shape, np.int32)
            for row in symbols:
                found = flat.take(state * width + row)
                count += found & 1
                state = found >> 1
            out[some] = count.T
        return out


def _spelled(found: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """Symbols in which the digits of its code point follow every letter beyond the alphabet."""
    rare = np.flatnonzero(found == RARE)
    if not len(rare):
        return found
    sizes = np.ones(len(found), np.int64)
    sizes[rare] += DIGITS
    out, at, left = np.repeat(found, sizes), np.cumsum(sizes)[rare] - DIGITS, codes[rare]
    for i in reversed(range(DIGITS)):
        out[at + i] = DIGIT + left % BASE
        left = left // BASE
    return out


def _symbols(text: str, classes: np.ndarray) -> np.ndarray:
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4")
    found = classes[codes]
    keep = found != GAP
    keep[1:] |= found[:-1] != GAP  # one gap between words, whatever stands there
    return _spelled(found[keep], codes[keep])


def held_out(doc_id: Column, folds: int = 3, fold: int = 1) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == fold, F.lit(False))


def train(docs: DataFrame, docs_per_language: int = 150, excerpt: int = 300, total_chars: int = 200_000,
          most_chars: int = 40_000, alphabet: int = 60) -> Model:
    """The model of all languages named in ``lang``, from the rows that are not held out.

    Bounds: about ``docs_per_language`` rows of each language, drawn by hash;
    ``excerpt`` characters of each from a place drawn by hash; ``most_chars`` symbols
    per language and ``total_chars`` together.  The ``alphabet`` most frequent
    letters are one symbol each, every other letter of the samples is spelled as
    seven; a letter of no sample is a phrase of its own in every language.
    """
    rows = only(docs, "doc_id", "text", "lang").where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}")) \
        .where(~held_out(F.col("doc_id")))
    draw = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30))
    counts = {r.lang: r.n for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    limit = F.lit(None).cast("double")
    for lang, n in counts.items():
        limit = F.when(F.col("lang") == lang, min(1.0, 2 * docs_per_language / n)).otherwise(limit)
    start = 1 + F.pmod(F.xxhash64("text"), F.greatest(F.length("text") - excerpt, F.lit(0)) + 1)
    drawn = rows.withColumn("draw", draw).where(F.col("draw") < limit * (1 << 30)) \
        .select("lang", "draw", F.substr("text", start.cast("int"), F.lit(excerpt)).alias("part")).collect()
    samples: dict[str, list[str]] = {}
    for r in sorted(drawn, key=lambda r: (r.draw, r.part)):
        if len(samples.setdefault(r.lang, [])) < docs_per_language:
            samples[r.lang].append(r.part)
    return Model(samples, min(most_chars, total_chars // max(1, len(samples))), alphabet)


def _judge(texts: list, model: Model, classes: np.ndarray) -> tuple[list[str], list[float]]:
    parts = [_symbols(t, classes) if t else np.zeros(0, np.uint8) for t in texts]
    owners, stretches = [], []
    for i, part in enumerate(parts):
        if len(part) and part.any():
            for at in range(0, len(part), STRETCH):
                owners.append(i)
                stretches.append(part[at:at + STRETCH])
    langs, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
    if not stretches or not model.langs:
        return langs, scores
    needed = np.zeros((len(texts), len(model.langs)))
    np.add.at(needed, np.array(owners), model.phrases(stretches))
    needed *= model.cost
    for i in sorted(set(owners)):
        order = np.argsort(needed[i], kind="stable")
        langs[i] = model.langs[order[0]]
        scores[i] = float(1 - needed[i][order[0]] / needed[i][order[1]]) if len(order) > 1 else 1.0
    return langs, scores


def _predicting(docs: DataFrame, model: Model):
    held, classes = Sent(docs.sparkSession, model), Sent(docs.sparkSession, model.classes())
    return lambda batch: _judge(column(batch, "text"), held.value, classes.value)


def predict(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """doc_id, held_out, lang_pred, score for every document.

    ``lang_pred`` is one of the learned languages, ``und`` for null text and text
    without a letter (and for all, if no row has a language).  ``score`` is how
    much less the best language needs than the second best, 0 to 1; 1 if only one
    is learned.  Whole texts are parsed, in stretches of 2,048 symbols; anything
    between letters counts as one gap.  Ties go to the first name.  Repeated rows
    are judged alike, an empty table gives an empty result, a null ``doc_id`` is
    never held out.  Other columns are ignored.
    """
    judge = _predicting(docs, model or train(docs))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, scores = judge(batch)
            held = [batch.column(batch.schema.get_field_index(n)) for n in ("doc_id", "held_out")]
            yield pa.RecordBatch.from_arrays([*held, pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                                             names=["doc_id", "held_out", "lang_pred", "score"])

    rows = only(docs, "doc_id", "text").select(
        F.col("doc_id").cast("long").alias("doc_id"), "text", held_out(F.col("doc_id")).alias("held_out"))
    return rows.mapInArrow(run, "doc_id bigint, held_out boolean, lang_pred string, score double")


def known(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """The documents with a language, all columns as they are; ``und`` goes."""
    judge = _predicting(docs, model or train(docs))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, _ = judge(batch)
            yield batch.filter(pa.array([lang != UNKNOWN for lang in langs], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


shipped(__name__)
