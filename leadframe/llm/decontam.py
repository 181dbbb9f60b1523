"""Benchmark passages in documents (operator 3).

SimHash fingerprints of item-sized windows, looked up in a multi-index of
Hamming blocks, then an exact similarity of weighted shingles.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import Sent, column, only, shipped

BLOCKS, BITS = 4, 16
SLICE = 65_536
#: Words of which running sums are held at once, few enough for a core's own cache; longer parts come one by one.
TOGETHER = 16_384
_words = re.compile(r"[^\W_]+").findall


def tokens(text: str | None) -> list[str]:
    """Runs of letters and digits in lower case; punctuation doesn't hide a passage."""
    return _words(text.lower()) if text else []


class Hashes(dict):
    """Word → 64-bit hash, remembered."""

    def __missing__(self, word: str) -> int:
        if len(self) > 500_000:
            self.clear()
        self[word] = found = xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass"))
        return found


def hop(width: int) -> int:
    return max(1, width // 4)


def width_of(size: int) -> int:
    """Largest window such that one of every ``hop`` windows of a text lies inside any passage of ``size`` words."""
    widths = [*range(1, 9)]
    while widths[-1] < min(size, SLICE // 4):
        widths.append(widths[-1] * 3 // 2)
    return max(w for w in widths if w + hop(w) - 1 <= size)


def fingerprints(hashes: np.ndarray, starts: np.ndarray, width: int, sums: np.ndarray | None = None) -> np.ndarray:
    """SimHash of the windows of ``width`` words at ``starts``: each bit by the majority of the words' bits."""
    sums = bit_sums(hashes, counter(width)) if sums is None else sums
    ones = (sums[starts + width] - sums[starts]).view(counter(width))
    return np.packbits(ones > width // 2).view("<u8")


def counter(width: int) -> type:
    """The smallest type that can count the words of a window."""
    return np.uint8 if width < 1 << 8 else np.uint16


#: By type of counter: the bits of every byte as such counters, 64 bits of them to a number.
SPREAD = {kind: np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(kind).view("<u8") for kind in (np.uint8, np.uint16)}


def bit_sums(hashes: np.ndarray, kind: type) -> np.ndarray:
    """Running count of each bit, as many counters of ``kind`` added at once as 64 bits hold.

    A full counter carries into the next one, and all wrap at 2 ** 64.  A
    difference takes this back: it is the sum of the words between modulo
    2 ** 64, in which no counter is full if ``kind`` can count these words.
    """
    spread = SPREAD[kind]
    sums = np.zeros((len(hashes) + 1, 8 * spread.shape[1]), "<u8")
    own = sums[1:].reshape(-1, 8, spread.shape[1])
    np.take(spread, hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=0, out=own, mode="clip")
    return np.add.accumulate(sums, axis=0, out=sums)


class BlockIndex:
    """All fingerprints within ``radius`` of a query.

    Two fingerprints that differ in at most 4k + 3 bits differ in at most k bits
    in one of the four blocks; so every fingerprint is filed under all values
    within k bits of each of its blocks, and a query reads its own four values.
    """

    def __init__(self, prints: np.ndarray, radius: int):
        self.prints, self.radius = prints, radius
        near = np.array([0], np.uint32)
        for _ in range(radius // BLOCKS):
            near = np.unique(np.concatenate([near, *[near ^ np.uint32(1 << b) for b in range(BITS)]]))
        self.lists = []
        for block in range(BLOCKS):
            own = ((prints >> np.uint64(BITS * block)) & np.uint64(0xFFFF)).astype(np.uint32)
            keys = (own[:, None] ^ near[None, :]).ravel()
            order = np.argsort(keys, kind="stable")
            bounds = np.searchsorted(keys[order], np.arange((1 << BITS) + 1))
            self.lists.append((bounds, np.repeat(np.arange(len(prints)), len(near))[order]))

    def search(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(query number, fingerprint number) of all pairs within the radius; a pair may come up more than once."""
        left, right = [], []
        for block, (bounds, filed) in enumerate(self.lists):
            keys = ((queries >> np.uint64(BITS * block)) & np.uint64(0xFFFF)).astype(np.int64)
            first, counts = bounds[keys], bounds[keys + 1] - bounds[keys]
            hit = np.flatnonzero(counts)
            for some in np.array_split(hit, max(1, int(counts[hit].sum()) // 2_000_000 + 1)):
                n = counts[some]
                query = np.repeat(some, n)
                place = np.arange(len(query)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first[some], n)
                entry = filed[place]
                near = np.bitwise_count(queries[query] ^ self.prints[entry]) <= self.radius
                left.append(query[near])
                right.append(entry[near])
        return np.concatenate(left), np.concatenate(right)


def shingles(words: list[str], size: int = 5) -> Counter:
    if not words:
        return Counter()
    if len(words) < size:
        return Counter([tuple(words)])
    return Counter(zip(*[words[i:] for i in range(size)]))


def shortest(words: list[str], weight: dict, threshold: float, size: int = 5) -> int:
    """Words of the shortest passage whose shingles alone reach ``threshold`` of the weight of all."""
    own = np.array([weight[s] for s in zip(*[words[i:] for i in range(size)])])
    if not len(own):
        return len(words)  # one shingle, the whole sequence
    sums = np.concatenate([[0.0], np.cumsum(own)])
    ends = np.searchsorted(sums, sums[:-1] + threshold * sums[-1] - 1e-9)
    return int((ends - np.arange(len(own)))[ends < len(sums)].clip(1).min()) + size - 1


class Benchmark:
    """Items, their windows by width, and the weights of their shingles."""

    def __init__(self, items: list[tuple[int, str | None]], radius: int, threshold: float = 0.75, counts: dict | None = None):
        hashes = Hashes()
        self.items = [(item, words) for item, text in items if (words := tokens(text))]
        self.longest = max((len(w) for _, w in self.items), default=0)
        self.shingles = [shingles(w) for _, w in self.items]
        seen = Counter(s for c in self.shingles for s in c) if counts is None else counts
        self.weight = {s: 1 / n for s, n in seen.items()}  # what many items share says little
        by_width: dict[int, list] = {}
        for number, (_, words) in enumerate(self.items):
            own = np.array([hashes[w] for w in words], np.uint64)
            width = width_of(shortest(words, self.weight, threshold))
            starts = np.arange(len(words) - width + 1)
            for start, print_ in zip(starts, fingerprints(own, starts, width)):
                by_width.setdefault(width, []).append((number, start, print_))
        self.windows = {
            width: (np.array([r[0] for r in rows]), np.array([r[1] for r in rows]),
                    BlockIndex(np.array([r[2] for r in rows], np.uint64), radius))
            for width, rows in sorted(by_width.items())}

    def similarity(self, number: int, words: list[str]) -> float:
        """Weighted Jaccard similarity of shingle counts; a shingle that no item has weighs 1."""
        mine, theirs = self.shingles[number], shingles(words)
        both = either = 0.0
        for s in mine.keys() | theirs.keys():
            w = self.weight.get(s, 1.0)
            both += w * min(mine[s], theirs[s])
            either += w * max(mine[s], theirs[s])
        return both / either

    def matches(self, texts: list, threshold: float, hashes: Hashes) -> Iterator[tuple[int, dict]]:
        """(text number, {item_id: (similarity, place)}) for every text with a passage."""
        waiting, size = [], 0
        for number, text in enumerate(texts):
            words = tokens(text)
            step = SLICE - self.longest if self.longest < SLICE // 2 else SLICE
            for at in range(0, max(1, len(words) - self.longest + 1), step):
                part = words[at:at + step + self.longest]
                waiting.append((number, at, part, words))
                size += len(part)
                if size >= TOGETHER:
                    yield from self._matches(waiting, threshold, hashes)
                    waiting, size = [], 0
        if waiting:
            yield from self._matches(waiting, threshold, hashes)

    def _matches(self, parts: list, threshold: float, hashes: Hashes) -> Iterator[tuple[int, dict]]:
        sizes = np.array([len(p[2]) for p in parts])
        first = np.cumsum(sizes) - sizes
        own = np.fromiter(map(hashes.__getitem__, chain.from_iterable(p[2] for p in parts)), np.uint64, int(sizes.sum()))
        kind = sums = None
        candidates = set()
        for width, (items, offsets, index) in self.windows.items():
            if kind is not counter(width):  # widths rise, so the sums of one kind are held at a time
                kind = counter(width)
                sums = bit_sums(own, kind)
            n = np.maximum(0, (sizes - width) // hop(width) + 1) * (sizes >= width)
            part = np.repeat(np.arange(len(parts)), n)
            place = (np.arange(len(part)) - np.repeat(np.cumsum(n) - n, n)) * hop(width)
            if not len(part):
                continue
            query, entry = index.search(fingerprints(own, first[part] + place, width, sums))
            candidates.update(zip(part[query].tolist(), items[entry].tolist(), (place[query] - offsets[entry]).tolist()))
        found: dict[int, dict] = {}
        tested: dict[tuple, float] = {}
        for i, item, place in candidates:
            number, at, _, words = parts[i]
            item_id, size = self.items[item][0], len(self.items[item][1])
            here = words[max(0, at + place):max(0, at + place + size)]
            if size > 8 and self.shingles[item].keys().isdisjoint(shingles(here)):
                continue  # two words aside no more than two shingles could be shared, too few
            for start in range(at + place - 2, at + place + 3):  # a word more or less before the window
                key = (number, item, start)
                if key not in tested:
                    tested[key] = self.similarity(item, words[max(0, start):max(0, start + size)])
                if tested[key] >= threshold:
                    best = found.setdefault(number, {})
                    best[item_id] = max(best.get(item_id, (0.0, 0)), (tested[key], -max(0, start)))
        yield from found.items()


def _shingled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """block and shingle (its words joined) of every item, each shingle once for each item."""
    for batch in batches:
        told = [(block, " ".join(s)) for block, text in zip(column(batch, "block"), column(batch, "text")) for s in shingles(tokens(text))]
        yield pa.RecordBatch.from_arrays([pa.array([t[0] for t in told], pa.int64()), pa.array([t[1] for t in told], pa.string())],
                                         ["block", "shingle"])


def _benchmarks(benchmark: DataFrame, threshold: float, radius: int, block_items: int) -> Iterator:
    """The benchmark in blocks of about ``block_items`` items, each broadcast on its own.

    Of several blocks, each is weighted by how many items of the whole
    benchmark share its shingles, so that the size of a block changes nothing.
    """
    items = only(benchmark, "item_id", "text").where("text IS NOT NULL")
    blocks = max(1, -(-items.count() // block_items))
    items = items.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)).cast("long"))
    counts = None
    if blocks > 1:
        told = items.select("block", "text").mapInArrow(_shingled, "block bigint, shingle string")
        every = told.groupBy("shingle").agg(F.count("*").alias("n"))
        counts = materialize(told.distinct().join(every, "shingle"), "shingles")
    for b in range(blocks):
        own = [(r.item_id, r.text) for r in items.where(F.col("block") == b).collect()]
        seen = None if counts is None else {tuple(r.shingle.split(" ")): r.n for r in counts.where(F.col("block") == b).collect()}
        yield Sent(benchmark.sparkSession, Benchmark(own, radius, threshold, seen))


def leaks(docs: DataFrame, benchmark: DataFrame, threshold: float = 0.75, radius: int = 7,
          block_items: int = 5_000) -> DataFrame:
    """doc_id, item_id, similarity, place: every document with a passage that is a benchmark item or nearly so.

    Windows slide over each whole document and over each item, so narrow that
    one lies inside any unchanged part of an item that can reach the threshold,
    also at either end of a document or alone.  A pair of windows whose 64-bit SimHashes differ in at most
    ``radius`` bits is a candidate.  Where the item would then lie in the
    document, give or take two words, the weighted Jaccard similarity of
    five-word shingles (the whole sequence, if shorter) must reach
    ``threshold``.  ``place`` is the word number of the best place.

    The benchmark is a stated query set: it is sent to the tasks in blocks of
    about ``block_items`` items, one pass over the documents each.  Null or
    empty texts and items without a word match nothing; empty tables give an
    empty result; repeated rows and items match each by each; a null ``doc_id``
    stays null.  Other columns are ignored.
    """
    out = None
    for held in _benchmarks(benchmark, threshold, radius, block_items):
        def run(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            hashes = Hashes()
            for batch in batches:
                ids, best = column(batch, "doc_id"), {}
                for number, found in held.value.matches(column(batch, "text"), threshold, hashes):
                    for item, what in found.items():
                        best[number, item] = max(best.get((number, item), (0.0, 0)), what)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([ids[n] for n, _ in best], pa.int64()), pa.array([i for _, i in best], pa.int64()),
                     pa.array([v[0] for v in best.values()], pa.float64()),
                     pa.array([-v[1] for v in best.values()], pa.int32())],
                    names=["doc_id", "item_id", "similarity", "place"])

        rows = only(docs, "doc_id", "text").mapInArrow(
            run, "doc_id bigint, item_id bigint, similarity double, place int")
        out = rows if out is None else out.unionByName(rows)
    return out


def without_leaks(docs: DataFrame, benchmark: DataFrame, threshold: float = 0.75, radius: int = 7,
                  block_items: int = 5_000) -> DataFrame:
    """The documents in which :func:`leaks` finds no passage, with all their columns; nothing is shuffled."""
    for held in _benchmarks(benchmark, threshold, radius, block_items):
        def run(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            hashes = Hashes()
            for batch in batches:
                bad = {n for n, _ in held.value.matches(column(batch, "text"), threshold, hashes)}
                yield batch.filter(pa.array([i not in bad for i in range(batch.num_rows)], pa.bool_()))

        docs = docs.mapInArrow(run, docs.schema)
    return docs


shipped(__name__)
