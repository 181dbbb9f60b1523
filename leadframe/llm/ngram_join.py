"""Join of documents by the Jaccard similarity of their word n-grams (operator 9).

A T-occurrence search: a document with n shingles must share T of them with any
partner.  The rarest n - T + 1 of its shingles are its short lists; the other
T - 1 lists are set aside (DivideSkip), because a partner absent from all short
lists cannot reach T.  A partner at least as large asks for a larger T, so of
the smaller document of a pair even fewer lists count.  Merging the short lists
gives the candidates; their remaining shingles are then probed by binary search.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import column, only, setting, shipped, tidy_shuffles

SIZE = 5
#: A list is longer the more of these document counts it exceeds.
LENGTHS = (1, 16, 256, 4096)
#: Bits of the table that tells list lengths; 8 MB for each of the counts above.
TABLE_BITS = 1 << 26
#: Hubs of a list in a round, and the share of their pairs that must be links for another round.
HUBS, HUBS_PAY = 4, 0.1
#: The table is put together from pieces of so many 64-bit words.
PIECE = 1 << 13
#: 64-bit words of a document's shingle sketch.
SKETCH = 16
#: Bytes of text that are cut into words in one step.
PIECE_BYTES = 1 << 17
#: Rows that go to a Python worker at once; some carry two whole texts.
BATCH_ROWS = 1_000


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_SPACES = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
_VALUES = _mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_BASE = 0xD1342543DE82EF95
_powers: dict[str, np.ndarray] = {}


def _power_tables(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64."""
    if len(_powers.get("up", ())) < size:
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[name] = np.multiply.accumulate(steps)
    return _powers["up"], _powers["down"]


def _word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Start and 64-bit hash of each word of a buffer: differences of one running sum, moved to power zero."""
    raw = np.frombuffer(data, np.uint8)
    up, down = _power_tables(max(len(raw), PIECE_BYTES) + 1)
    space = np.ones(len(raw) + 2, bool)
    space[1:-1] = _SPACES[raw]
    turns = np.flatnonzero(space[1:] != space[:-1])
    starts, ends = turns[::2], turns[1::2]
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_VALUES[raw] * up[:len(raw)], out=sums[1:])
    return starts, _mixed((sums[ends] - sums[starts]) * down[starts])


def _long_word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The same piece by piece; a piece ends at a blank, so that no word is cut."""
    if len(data) <= 2 * PIECE_BYTES:
        return _word_hashes(data)
    parts, at = [], 0
    blank = re.compile(rb"[\x20\x09-\x0D]")
    while at < len(data):
        found = blank.search(data, at + PIECE_BYTES)
        end = found.end() if found else len(data)
        starts, hashes = _word_hashes(data[at:end])
        parts.append((starts + at, hashes))
        at = end
    return tuple(np.concatenate(p) for p in zip(*parts))


def _sets(texts: list[bytes], size: int) -> Iterator[np.ndarray]:
    lengths = np.array([len(t) + 1 for t in texts])
    starts, own = _long_word_hashes(b"\n".join(texts).lower())  # of bytes, so only A-Z change
    bounds = np.searchsorted(starts, np.concatenate([[0], np.cumsum(lengths)]))
    mixed = {}
    for n in range(1, size + 1):  # all runs of n words, also across texts; those are not looked at
        if len(own) >= n and (n == size or (np.diff(bounds) == n).any()):
            out = np.full(len(own) - n + 1, n, np.uint64)
            for i in range(n):
                out = out * np.uint64(0x9E3779B97F4A7C15) + own[i:len(own) - n + 1 + i]
            mixed[n] = _mixed(out)
    for first, last in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        n = min(size, last - first)
        found = np.sort(mixed[n][first:last - n + 1]) if n else np.zeros(0, np.uint64)
        yield found[np.concatenate([[True], found[1:] != found[:-1]])] if n else found


def shingle_sets(texts: Iterable[bytes | None], size: int = SIZE) -> Iterator[np.ndarray]:
    """Sorted 64-bit hashes of the distinct shingles of each UTF-8 text, whole texts at a time.

    Words are runs without blanks, A-Z lower-cased; a text of fewer words than
    ``size`` is one shingle.
    """
    waiting, held = [], 0
    for text in texts:
        waiting.append(text or b"")
        held += len(waiting[-1])
        if held >= PIECE_BYTES:
            yield from _sets(waiting, size)
            waiting, held = [], 0
    if waiting:
        yield from _sets(waiting, size)


def _texts_of(batch: pa.RecordBatch, name: str = "text") -> list[bytes | None]:
    return batch.column(batch.schema.get_field_index(name)).cast(pa.large_binary()).to_pylist()


def least_overlap(n, percent: int):
    """Shingles that a set of n shares with any partner."""
    return -(-percent * n // 100)


def least_overlap_with_larger(n, percent: int):
    """Shingles that a set of n shares with any partner of n or more."""
    return -(-2 * percent * n // (100 + percent))


def _half(sets: np.ndarray) -> np.ndarray:
    """Shingles whose lists are measured; the other half ranks between short and long."""
    return sets < np.uint64(1 << 63)


def _list_lengths(docs: DataFrame) -> dict:
    """Packed pieces of a bit table, for :func:`_table`: which of the counts a shingle's list exceeds.

    All documents are counted.  The table has a fixed size; shingles that share
    a bit are all taken for the longest, which changes the order of the lists and
    so the work, never the result.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            toks = np.concatenate([own[_half(own)] for own in shingle_sets(_texts_of(batch))] or [np.zeros(0, np.uint64)])
            yield pa.RecordBatch.from_arrays([pa.array(toks.view(np.int64))], names=["tok"])

    def piece(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: dict[int, np.ndarray] = {}
        for batch in batches:
            words = batch.column(0).to_numpy()
            for number in np.unique(words // PIECE):
                own = words // PIECE == number
                part = parts.setdefault(int(number), np.zeros((len(LENGTHS), PIECE), np.int64))
                for i in range(len(LENGTHS)):
                    part[i, words[own] % PIECE] = batch.column(1 + i).to_numpy()[own]
        yield pa.RecordBatch.from_arrays([pa.array(list(parts), pa.int64()), pa.array(
            [zlib.compress(p.tobytes(), 1) for p in parts.values()], pa.binary())], names=["piece", "bits"])

    counts = only(docs, "text").mapInArrow(run, "tok bigint").groupBy("tok").agg(F.count("*").alias("n"))
    place = F.col("tok").bitwiseAND(F.lit(TABLE_BITS - 1))
    bit = F.expr("shiftleft(1L, CAST(place & 63 AS INT))")
    words = counts.where(F.col("n") > LENGTHS[0]).select(place.alias("place"), "n") \
        .groupBy(F.shiftright("place", 6).alias("word")) \
        .agg(*[F.bit_or(F.when(F.col("n") > least, bit).otherwise(F.lit(0).cast("long"))).alias(f"b{i}")
               for i, least in enumerate(LENGTHS)])
    pieces = words.repartition(F.shiftright("word", PIECE.bit_length() - 1)).mapInArrow(piece, "piece bigint, bits binary")
    # 32 MB in all, far less while most of it is zero; the driver never unpacks it
    return {"pieces": {row.piece: bytes(row.bits) for row in materialize(pieces, "list-lengths").toLocalIterator()}}


def _table(held) -> np.ndarray:
    """The bit table (len(LENGTHS), TABLE_BITS / 64); a worker unpacks it once and keeps it with the broadcast."""
    kept = held.value
    if "table" not in kept:
        table = np.zeros((len(LENGTHS), TABLE_BITS // 64), np.uint64)
        for number, bits in kept["pieces"].items():
            table[:, number * PIECE:(number + 1) * PIECE] = np.frombuffer(zlib.decompress(bits), np.uint64).reshape(len(LENGTHS), PIECE)
        kept["table"] = table
        del kept["pieces"]
    return kept["table"]


def _ranks(own: np.ndarray, table: np.ndarray) -> np.ndarray:
    """0 for lists of one document, then longer and longer; a function of the shingle alone."""
    place = own & np.uint64(TABLE_BITS - 1)
    word, bit = (place >> np.uint64(6)).astype(np.int64), place & np.uint64(63)
    over = sum(((t[word] >> bit) & np.uint64(1)).astype(np.int8) for t in table)
    return np.where(_half(own), over + (over > 1), 2)


def _short_lists(docs: DataFrame, held, percent: int) -> DataFrame:
    """doc_id, n, sig, toks, k, bits: set size, identity of the set, shingles whose lists are to be merged.

    The first ``k`` of ``toks`` are enough for larger partners.  ``bits`` has a bit
    for every shingle: two sets differ in at least as many shingles as sketches in bits.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, sigs, toks, firsts, bits = [], [], [], [], []
            for own in shingle_sets(_texts_of(batch)):
                n, ranks = len(own), _ranks(own, _table(held))
                first = np.argsort(ranks, kind="stable")[:n - least_overlap(n, percent) + 1]  # own is sorted
                told = ranks[first] > 0  # the list of a rank 0 shingle is the document alone
                sizes.append(n)
                sigs.append(xxhash.xxh3_128_digest(own.tobytes()))
                toks.append(own[first][told].view(np.int64))
                sketch = np.zeros(64 * SKETCH, np.uint8)
                sketch[(own & np.uint64(64 * SKETCH - 1)).astype(np.int64)] = 1
                bits.append(np.packbits(sketch).view(np.int64))
                firsts.append(int(told[:n - least_overlap_with_larger(n, percent) + 1].sum()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(batch.schema.get_field_index("doc_id")), pa.array(sizes, pa.int64()),
                 pa.array(sigs, pa.binary()), pa.array(toks, pa.list_(pa.int64())), pa.array(firsts, pa.int32()),
                 pa.array(bits, pa.list_(pa.int64()))], names=["doc_id", "n", "sig", "toks", "k", "bits"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(run, "doc_id bigint, n bigint, sig binary, toks array<bigint>, k int, bits array<bigint>")


def overlap(a: np.ndarray, b: np.ndarray, ranks: np.ndarray, needed: int) -> int:
    """Shingles of a in b, or fewer than ``needed`` as soon as that is certain.

    Short lists of a are merged with b; long ones are probed by binary search,
    and only if they can still fill up what is missing.
    """
    long = ranks > 1
    count = len(np.intersect1d(a[~long], b, assume_unique=True))
    probes = a[long]
    if count + len(probes) < needed or not len(probes):
        return count
    place = np.minimum(np.searchsorted(b, probes), len(b) - 1)
    return count + int((b[place] == probes).sum())


def _linked(pairs: DataFrame, texts: DataFrame, held, percent: int) -> DataFrame:
    """The pairs (a, b, rep_a, rep_b) whose sets are similar enough, tested whole."""
    left = texts.select(F.col("sig").alias("a"), F.col("rep").alias("rep_a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("sig").alias("b"), F.col("rep").alias("rep_b"), F.col("text").alias("text_b"))

    def links(batch: pa.RecordBatch, kept: dict) -> list[bool]:
        """Rows that are links; ``kept`` holds the sets of the last rows."""
        sides = [(column(batch, sig), _texts_of(batch, text)) for sig, text in (("a", "text_a"), ("b", "text_b"))]
        new = {sig: text for sigs, texts in sides for sig, text in zip(sigs, texts) if sig not in kept}
        here = {sig: kept[sig] for sigs, _ in sides for sig in sigs if sig in kept} | dict(zip(new, shingle_sets(new.values())))
        kept.clear()
        kept.update(here)
        out = []
        for pair in zip(*[sigs for sigs, _ in sides]):
            small, large = sorted((here[sig] for sig in pair), key=len)
            both = len(small) + len(large)
            shared = overlap(small, large, _ranks(small, _table(held)), -(-percent * both // (100 + percent)))
            out.append(100 * shared >= percent * (both - shared))
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[bytes, np.ndarray] = {}
        for batch in batches:
            keep = [link for at in range(0, batch.num_rows, 32) for link in links(batch.slice(at, 32), kept)]
            rows = batch.filter(pa.array(keep, pa.bool_()))
            yield pa.RecordBatch.from_arrays([rows.column(rows.schema.get_field_index(c))
                                              for c in ("rep_a", "rep_b")], names=["rep_a", "rep_b"])

    rows = pairs.join(left, "a").join(right, "b")
    return rows.select("a", "b", "rep_a", "rep_b", "text_a", "text_b").mapInArrow(run, "rep_a bigint, rep_b bigint")


def components(links: DataFrame) -> DataFrame:
    """rep, comp: the least node that each node of the links reaches.

    Each round a node takes the least label among its own, its neighbours' and
    that label's own label; rounds are written out, so lineage stays short.
    """
    both = links.select(F.col("rep_a").alias("v"), F.col("rep_b").alias("w")) \
        .unionByName(links.select(F.col("rep_b").alias("v"), F.col("rep_a").alias("w"))).distinct()
    both = materialize(both, "links")
    labels = materialize(both.groupBy("v").agg(F.least(F.min("w"), F.first("v")).alias("comp")), "labels")
    while True:
        near = both.join(labels.withColumnRenamed("v", "w"), "w").groupBy("v").agg(F.min("comp").alias("near"))
        lower = labels.join(near, "v").select("v", F.col("comp").alias("old"), F.least("comp", "near").alias("comp"))
        jump = labels.select(F.col("v").alias("comp"), F.col("comp").alias("next"))
        moved = materialize(lower.join(jump, "comp", "left")
                            .select("v", "old", F.least("comp", F.coalesce("next", "comp")).alias("comp")), "labels")
        if moved.where("comp <> old").isEmpty():
            return moved.select(F.col("v").alias("rep"), "comp")
        labels = moved.select("v", "comp")


def _labelled(lists: DataFrame, labels: DataFrame | None) -> DataFrame:
    if labels is None:
        return lists.withColumn("comp", F.col("rep"))
    return lists.join(labels, "rep", "left").withColumn("comp", F.coalesce("comp", "rep"))


def _fits(percent: int):
    """Different components, sizes that allow a link, and the smaller set by a list of its first."""
    sizes = 100 * F.least("n", "n_o") >= percent * F.greatest("n", "n_o")
    first = F.when(F.col("n") < F.col("n_o"), F.col("first")).when(F.col("n") > F.col("n_o"), F.col("first_o")) \
        .otherwise(F.col("first") | F.col("first_o"))
    return sizes & (F.col("comp") != F.col("comp_o")) & first


def _pairs(rows: DataFrame) -> DataFrame:
    return rows.select(F.least("sig", "sig_o").alias("a"), F.greatest("sig", "sig_o").alias("b")).distinct()


def _hub_pairs(lists: DataFrame, percent: int, seed: int) -> DataFrame:
    """Each list's hubs with its other members; hubs are drawn by hash, so that near copies draw the same."""
    row = F.struct("sig", "n", "comp", "first")
    drawn = [F.min_by(row, F.xxhash64(F.lit(HUBS * seed + i), "sig")) for i in range(HUBS)]
    hubs = lists.groupBy("tok").agg(F.min("comp").alias("low"), F.max("comp").alias("high"),
                                    F.array(*drawn).alias("hubs")).where("low <> high") \
        .select("tok", F.explode(F.array_distinct("hubs")).alias("hub")) \
        .select("tok", *[F.col(f"hub.{c}").alias(f"{c}_o") for c in ("sig", "n", "comp", "first")])
    return _pairs(lists.join(hubs, "tok").where(_fits(percent)))


def _rest_pairs(lists: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """All pairs of a list's members that are not yet connected: members outside its largest component with all others.

    A pair comes out of one list only, that of its first common shingle, and only
    if the sketches leave room for the overlap that a link needs.
    """
    groups = lists.groupBy("tok", "comp").agg(F.count("*").alias("g"))
    main = groups.groupBy("tok").agg(F.max_by("comp", F.struct("g", "comp")).alias("main"), F.count("*").alias("parts")) \
        .where("parts > 1").select("tok", "main")
    words = [f"b{i}" for i in range(SKETCH)]
    more = nodes.select("sig", "toks", *[F.get("bits", F.lit(i)).alias(w) for i, w in enumerate(words)])
    there = lists.join(main, "tok").join(more, "sig").withColumn("toks", F.slice("toks", F.lit(1), F.col("pos") + 1))
    kept = ("tok", "sig", "n", "comp", "first", "toks", *words)
    outside = there.where("comp <> main").select(*[F.col(c).alias(f"{c}_o") for c in kept])
    differ = sum((F.bit_count(F.col(w).bitwiseXOR(F.col(f"{w}_o"))) for w in words), F.lit(0))
    both = F.col("n") + F.col("n_o")
    room = (both - differ) * (100 + percent) >= 2 * percent * both
    once = F.get(F.array_intersect("toks", "toks_o"), F.lit(0)) == F.col("tok")
    return _pairs(there.join(outside, (F.col("tok") == F.col("tok_o")) & _fits(percent) & room & once))


def join(docs: DataFrame, percent: int = 75) -> DataFrame:
    """doc_id, n_shingles, component_id for every document.

    Two documents are linked when their sets of five-word shingles (lower-cased
    A-Z; with fewer words the whole sequence) have a Jaccard similarity of at
    least ``percent`` / 100.  ``component_id`` is the least ``doc_id`` reachable
    by links.  Documents with equal sets are one node from the start.

    Candidates are members of one short list.  In a group of copies every member
    is in the same lists, so a list is first compared with a few hubs, and what
    these connect need not be compared again.  When hubs hardly connect anything
    more, every remaining pair of a list is tested; no link
    between different components is missed and no group is paired with itself.

    Null, empty and blank text: 0 shingles, linked with nothing, own component.
    A row with null ``doc_id`` has null ``component_id`` and links nothing.  Rows
    that repeat a ``doc_id`` are one document with several texts, one output row
    each.  An empty table gives an empty result; other columns are ignored.
    """
    spark = docs.sparkSession
    with tidy_shuffles(spark), setting(spark, "spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS):
        return _join(docs, percent)


def _join(docs: DataFrame, percent: int) -> DataFrame:
    spark = docs.sparkSession
    held = spark.sparkContext.broadcast(_list_lengths(docs))
    rows = materialize(_short_lists(docs, held, percent), "short-lists")
    nodes = materialize(rows.where("n > 0 AND doc_id IS NOT NULL").groupBy("sig").agg(
        F.min("doc_id").alias("rep"), F.first("n").alias("n"), F.first("toks").alias("toks"),
        F.first("k").alias("k"), F.first("bits").alias("bits")), "nodes")
    members = nodes.select("sig", "rep", "n", "k", F.posexplode("toks").alias("pos", "tok")) \
        .select("sig", "rep", "n", "tok", "pos", (F.col("pos") < F.col("k")).alias("first"))
    shared = members.groupBy("tok").agg(F.count("*").alias("_g"), F.max("first").alias("_f")).where("_g > 1 AND _f") \
        .select("tok")
    lists = materialize(members.join(shared, "tok", "left_semi"), "lists")
    links = [materialize(_repeated_ids(rows, nodes), "linked")]
    labels = None if links[0].isEmpty() else components(links[0])
    if not lists.isEmpty():
        wanted = lists.select("sig", "rep").distinct()
        texts = materialize(_texts(docs, wanted), "texts")
        seed, last = 0, False
        while True:
            here = _labelled(lists, labels)
            pairs = materialize(_rest_pairs(here, nodes, percent) if last else _hub_pairs(here, percent, seed), "pairs")
            links.append(materialize(_linked(pairs, texts, held, percent), "linked"))
            found = links[-1].count()
            if found:
                labels = components(reduce(DataFrame.unionByName, links))
            if last:
                break
            seed, last = seed + 1, found < HUBS_PAY * pairs.count()
    held.destroy()  # all that needs it is written
    return _answer(rows, nodes, labels)


def _repeated_ids(rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """Links that hold together the sets of a ``doc_id`` that occurs with several texts."""
    several = rows.where("n > 0").groupBy("doc_id").agg(F.min("sig").alias("x"), F.max("sig").alias("y")) \
        .where("x <> y").select("doc_id")
    return rows.join(several, "doc_id").join(nodes.select("sig", "rep"), "sig") \
        .select(F.col("doc_id").alias("rep_a"), F.col("rep").alias("rep_b"))


def _texts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """sig, rep, text of the wanted sets, each from the document that represents it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [xxhash.xxh3_128_digest(s.tobytes()) for s in shingle_sets(_texts_of(batch))]
            yield batch.filter(pa.array([a == b for a, b in zip(own, column(batch, "sig"))], pa.bool_()))

    found = docs.select(F.col("doc_id").cast("long").alias("rep"), "text").join(wanted, "rep") \
        .select("sig", "rep", "text").mapInArrow(run, "sig binary, rep bigint, text string")
    return found.dropDuplicates(["sig"])


def _answer(rows: DataFrame, nodes: DataFrame, labels: DataFrame | None) -> DataFrame:
    named = nodes.select("sig", "rep")
    named = named.withColumn("comp", F.col("rep")) if labels is None else _labelled(named, labels)
    out = rows.select("doc_id", "n", "sig").join(named.select("sig", "comp"), "sig", "left")
    own = F.when(F.col("doc_id").isNotNull(), F.coalesce("comp", "doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), own.alias("component_id"))


def first_of_each(docs: DataFrame, percent: int = 75) -> DataFrame:
    """One document of each component, with all its columns: the one with the least ``doc_id``, null last.

    Rows are told apart by ``doc_id`` and text: of equal rows one stays, of rows
    that repeat a ``doc_id`` with different texts every text that is no copy, and
    rows without a ``doc_id`` are copies like all others.  Texts without words stay.
    """
    key = F.xxhash64("doc_id", "text")
    found = materialize(join(docs.select(key.alias("doc_id"), "text"), percent), "components").where("n_shingles > 0")
    named = docs.select(key.alias("key"), F.col("doc_id").cast("long").alias("name")).distinct()
    first = F.min(F.struct(F.col("name").isNull(), F.col("name"), F.col("key")))["key"]
    copies = found.join(named, found["doc_id"] == named["key"]).groupBy("component_id").agg(first.alias("kept"))
    gone = found.join(copies, "component_id").where("doc_id <> kept").select(F.col("doc_id").alias("_gone")).distinct()
    whole = docs.select(key.alias("key"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    left = whole.join(gone, F.col("key") == F.col("_gone"), "left_anti")
    repeated = found.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").select(F.col("doc_id").alias("_repeated"))
    if repeated.isEmpty():
        return left.select("row.*")
    marked = left.join(repeated, F.col("key") == F.col("_repeated"), "left")
    once = marked.where("_repeated IS NOT NULL").dropDuplicates(["key"])
    return marked.where("_repeated IS NULL").unionByName(once).select("row.*")


shipped(__name__)
