"""Lines that many documents share, found by probing a sharded perfect hash (operator 11).

Lines are counted by a 128-bit hash.  The hashes counted often enough are dealt
to shards, and each shard becomes a minimal perfect hash function with three
arrays behind it: fingerprint, number of documents, last document.  Documents
probe the arrays; their lines are never joined.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import column, only, shipped, tidy_shuffles

STRIPPED = " \t\n\x0b\x0c\r"
NO_ID = -(1 << 63)  # stands for a null doc_id
SHARD_KEYS = 200_000
LEAST_SHARDS = 64  # a small index too is built by many tasks
#: Arrays of this size at most are sent to the tasks; beyond it the probes travel to the arrays.
BROADCAST_BYTES = 64 << 20
KEY_BYTES = 28  # fingerprint, last document, count and the bits of the hash function, at most
#: A key with more than one in so many of all counted occurrences is hot; so there are fewer than this.
HOT_KEYS = 1_000_000
GAMMA = 2.0  # bits a key on each level of the hash function

SHARD = "shard bigint, levels array<bigint>, bits binary, prints binary, counts binary, width int, lasts binary"
ANSWER = "doc_id bigint, n_lines bigint, n_dropped bigint, kept string"


# --- the hash function -----------------------------------------------------------------------------------------

def _mixed(hi: np.ndarray, lo: np.ndarray, level: int) -> np.ndarray:
    """A fresh 64-bit hash of 128-bit keys for each level."""
    x = hi.view(np.uint64) + (lo.view(np.uint64) ^ np.uint64(0x9E3779B97F4A7C15 * (2 * level + 1) % (1 << 64)))
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    x ^= x >> np.uint64(31)
    y = (x ^ lo.view(np.uint64)) * np.uint64(0xD6E8FEB86659FD93)
    return y ^ (y >> np.uint64(32))


def build(hi: np.ndarray, lo: np.ndarray) -> tuple[list[int], np.ndarray, np.ndarray]:
    """Bits of each level, the bits of all levels as 64-bit words, and the place (0 … n - 1) of each key.

    On each level a key that no other key meets gets a bit; the others go on to
    the next level.  A key's place is the number of bits before its own.
    """
    places, rest, sizes, words, before, level = np.empty(len(hi), np.int64), np.arange(len(hi)), [], [], 0, 0
    while rest.size:
        size = (int(GAMMA * rest.size) // 64 + 1) * 64
        at = (_mixed(hi[rest], lo[rest], level) % np.uint64(size)).astype(np.int64)
        alone = np.bincount(at, minlength=size) == 1
        mine = alone[at]
        places[rest[mine]] = before + (np.cumsum(alone) - 1)[at[mine]]
        before += int(mine.sum())
        sizes.append(size)
        words.append(np.packbits(alone, bitorder="little").view(np.uint64))
        rest, level = rest[~mine], level + 1
    return sizes, np.concatenate(words) if words else np.empty(0, np.uint64), places


class Arrays:
    """One shard, ready to be probed."""

    def __init__(self, row: dict):
        self.sizes, self.words = row["levels"], np.frombuffer(row["bits"], np.uint64)
        self.ranks = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)])
        self.prints, self.lasts = np.frombuffer(row["prints"], np.int64), np.frombuffer(row["lasts"], np.int64)
        self.counts = np.frombuffer(row["counts"], np.dtype(f"u{row['width']}"))

    def find(self, hi: np.ndarray, lo: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of documents and last document of each key; 0 documents for a key that is not indexed."""
        counts, lasts = np.zeros(len(hi), np.int64), np.zeros(len(hi), np.int64)
        rest, first = np.arange(len(hi)), 0
        for level, size in enumerate(self.sizes):
            at = (_mixed(hi[rest], lo[rest], level) % np.uint64(size)).astype(np.int64)
            word, bit = self.words[first + (at >> 6)], (at & 63).astype(np.uint64)
            hit = (word >> bit) & np.uint64(1) == 1
            below = np.bitwise_count(word[hit] & ((np.uint64(1) << bit[hit]) - np.uint64(1)))
            places, keys = self.ranks[first + (at[hit] >> 6)] + below, rest[hit]
            same = self.prints[places] == lo[keys]
            counts[keys[same]], lasts[keys[same]] = self.counts[places[same]], self.lasts[places[same]]
            rest, first = rest[~hit], first + size // 64
            if not rest.size:
                break
        return counts, lasts


def _shard(table: pa.Table) -> pa.Table:
    """All keys of one shard as one row."""
    hi, lo, n, last = (table.column(c).to_numpy() for c in ("hi", "lo", "n", "last"))
    sizes, words, places = build(hi, lo)
    order = np.argsort(places)
    width = np.min_scalar_type(int(n.max())).itemsize
    row = {"shard": table.column("shard")[0].as_py(), "levels": sizes, "bits": words.tobytes(), "prints": lo[order].tobytes(),
           "counts": n[order].astype(np.dtype(f"u{width}")).tobytes(), "width": width, "lasts": last[order].tobytes()}
    return pa.Table.from_pylist([row], schema=_SHARD_ARROW)


_SHARD_ARROW = pa.schema([("shard", pa.int64()), ("levels", pa.list_(pa.int64())), ("bits", pa.binary()), ("prints", pa.binary()),
                          ("counts", pa.binary()), ("width", pa.int32()), ("lasts", pa.binary())])


# --- lines of documents ----------------------------------------------------------------------------------------

def _lines(texts: pa.Array, min_chars: int) -> tuple[pa.ListArray, np.ndarray, np.ndarray, np.ndarray]:
    """Lines of each text; of the long enough keys among all lines: their number, and both halves of their hash."""
    lists = pc.split_pattern(texts, "\n")
    keys = pc.ascii_lower(pc.utf8_trim(lists.flatten(), characters=STRIPPED))
    long = np.flatnonzero(pc.greater_equal(pc.utf8_length(keys), min_chars).to_numpy(zero_copy_only=False))
    told = keys.take(pa.array(long)).cast(pa.large_binary()).to_pylist()
    halves = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, told)), np.int64).reshape(-1, 2)
    return lists, long, np.ascontiguousarray(halves[:, 0]), np.ascontiguousarray(halves[:, 1])


def _read(batch: pa.RecordBatch) -> tuple[pa.Array, np.ndarray]:
    """Texts without nulls, and ids."""
    texts = pc.fill_null(batch.column(batch.schema.get_field_index("text")).cast(pa.large_string()), "")
    return texts, pc.fill_null(batch.column(batch.schema.get_field_index("doc_id")), NO_ID).to_numpy()


def _owners(lists: pa.ListArray, long: np.ndarray) -> np.ndarray:
    """Number of the text that each of the chosen lines belongs to."""
    return np.searchsorted(lists.offsets.to_numpy(), long, side="right") - 1


def _distinct(owners: np.ndarray, hi: np.ndarray, lo: np.ndarray) -> np.ndarray:
    """Rows (text, hi, lo), each key once for each text."""
    order = np.lexsort((lo, hi, owners))
    told = np.stack([owners, hi, lo], axis=1)[order]
    new = np.ones(len(told), bool)
    new[1:] = (told[1:] != told[:-1]).any(axis=1)
    return told[new]


def _counted(min_chars: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, ids = _read(batch)
            lists, long, hi, lo = _lines(texts, min_chars)
            own = _distinct(_owners(lists, long), hi, lo)
            yield pa.RecordBatch.from_arrays([pa.array(own[:, 1]), pa.array(own[:, 2]), pa.array(ids[own[:, 0]])], ["hi", "lo", "id"])
    return run


def _found(arrays: dict[int, Arrays], shards: int, hi: np.ndarray, lo: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Counts and last documents of keys, each probed in its shard; -1 documents where the shard is not here."""
    counts, lasts = np.full(len(hi), -1), np.zeros(len(hi), np.int64)
    mine = np.mod(hi, shards)
    for shard in np.unique(mine):
        if shard in arrays:
            at = np.flatnonzero(mine == shard)
            counts[at], lasts[at] = arrays[shard].find(hi[at], lo[at])
    return counts, lasts


def _without(lists: pa.ListArray, texts: pa.Array, ids: pa.Array, dropped: np.ndarray) -> pa.RecordBatch:
    """The answer for one batch; ``dropped`` are the numbers of the lines that go."""
    ends = lists.offsets.to_numpy()
    owner = np.searchsorted(ends, dropped, side="right") - 1
    kept = texts.to_pylist()
    gone = set(dropped.tolist())
    for i in np.unique(owner).tolist():
        kept[i] = "\n".join(line for j, line in enumerate(lists[i].as_py(), int(ends[i])) if j not in gone)
    return pa.RecordBatch.from_arrays(
        [ids, pa.array(np.diff(ends).astype(np.int64)), pa.array(np.bincount(owner, minlength=len(kept)).astype(np.int64)),
         pa.array(kept, pa.string())], ["doc_id", "n_lines", "n_dropped", "kept"])


def _doc_ids(batch: pa.RecordBatch) -> pa.Array:
    return batch.column(batch.schema.get_field_index("doc_id"))


# --- the index -------------------------------------------------------------------------------------------------

def line_counts(docs: DataFrame, min_docs: int, min_chars: int) -> DataFrame:
    """hi, lo, n, last: lines found in at least ``min_docs`` documents, with the largest ``doc_id`` that holds them."""
    lines = only(docs, "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long")) \
        .mapInArrow(_counted(min_chars), "hi bigint, lo bigint, id bigint")
    return lines.groupBy("hi", "lo").agg(F.count("*").alias("n"), F.max("id").alias("last")).where(F.col("n") >= min_docs)


def index(counts: DataFrame, shards: int) -> DataFrame:
    """One row for each shard that has a key: the hash function and its arrays."""
    return counts.withColumn("shard", F.pmod("hi", F.lit(shards)).cast("long")).groupBy("shard").applyInArrow(_shard, SHARD)


# --- documents probe -------------------------------------------------------------------------------------------

def _answered(arrays, shards: int, min_docs: int, min_chars: int) -> Callable:
    """Texts without the lines that the arrays at hand or the answers from elsewhere (``gone``) take out."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here = {k: Arrays(row) for k, row in arrays.value.items()}
        for batch in batches:
            texts, ids = _read(batch)
            lists, long, hi, lo = _lines(texts, min_chars)
            owners = _owners(lists, long)
            counts, lasts = _found(here, shards, hi, lo)
            gone = (counts >= min_docs) & (lasts != ids[owners])
            if "gone" in batch.schema.names:
                told = [{(g["hi"], g["lo"]) for g in row or ()} for row in column(batch, "gone")]
                gone |= np.fromiter(((h, l) in told[i] for h, l, i in zip(hi.tolist(), lo.tolist(), owners.tolist())), bool, len(hi))
            yield _without(lists, texts, _doc_ids(batch), long[gone])
    return run


def _sent(arrays, shards: int, min_chars: int) -> Callable:
    """Distinct probes of each text that the arrays at hand do not answer, addressed by id and hash of the text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here = {k: Arrays(row) for k, row in arrays.value.items()}
        for batch in batches:
            texts, ids = _read(batch)
            lists, long, hi, lo = _lines(texts, min_chars)
            own = _distinct(_owners(lists, long), hi, lo)
            own = own[_found(here, shards, own[:, 1].copy(), own[:, 2].copy())[0] <= 0]
            yield pa.RecordBatch.from_arrays([pa.array(own[:, 1]), pa.array(own[:, 2]), pa.array(ids[own[:, 0]]),
                                              _marks(texts).take(pa.array(own[:, 0]))], ["hi", "lo", "id", "mark"])
    return run


def _marks(texts: pa.Array) -> pa.Array:
    return pa.array([xxhash.xxh3_128_digest(t) for t in texts.to_pylist()], pa.binary())


def _marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts, ids = _read(batch)
        yield pa.RecordBatch.from_arrays([_doc_ids(batch), texts.cast(pa.string()), pa.array(ids), _marks(texts)],
                                         ["doc_id", "text", "id", "mark"])


def _routed(min_docs: int) -> Callable:
    """Probes that follow the arrays of their shard: those whose line goes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, arrays = None, None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            for row in table.filter(pc.is_valid(table.column("bits"))).select(_SHARD_ARROW.names).to_pylist():
                # shards come one after the other, each with its arrays first
                yield from _probe(table, arrays, shard, min_docs)
                shard, arrays = row["shard"], Arrays(row)
            yield from _probe(table, arrays, shard, min_docs)
    return run


def _probe(table: pa.Table, arrays: Arrays | None, shard: int | None, min_docs: int) -> Iterator[pa.RecordBatch]:
    if arrays is None:
        return
    mine = table.filter(pc.and_(pc.is_null(table.column("bits")), pc.equal(table.column("shard"), shard)))
    hi, lo, ids = (mine.column(c).to_numpy() for c in ("hi", "lo", "id"))
    counts, lasts = arrays.find(hi, lo)
    yield from mine.select(["id", "mark", "hi", "lo"]).filter(pa.array((counts >= min_docs) & (lasts != ids))).to_batches()


def dedup(docs: DataFrame, min_docs: int = 3, min_chars: int = 20, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """doc_id, n_lines, n_dropped, kept: each text without the lines that ``min_docs`` or more documents hold.

    A text is split at newlines; a line's key is the line without blanks at its
    ends, A-Z lower-cased.  Keys of at least ``min_chars`` code points found in
    ``min_docs`` documents lose all their lines but those in the largest
    ``doc_id`` that holds the key.  What is left is joined by newlines; if
    nothing is left, the text is empty.

    Arrays of at most ``broadcast_bytes`` are sent to every task.  Of larger
    ones only the hot keys are (at most ``HOT_KEYS``, whatever the corpus);
    the other probes are shuffled to the task of their shard, behind its arrays,
    and the lines that go are joined back by document.  Both ways give the same
    result.

    Null or empty text is one empty line.  Every row is a document of its own,
    also where ids repeat: equal rows with the largest id all keep their lines.
    Null ids count as smaller than all others.  An empty table gives an empty
    result; columns other than ``doc_id`` (an integer) and ``text`` are ignored.
    """
    spark = docs.sparkSession
    docs = only(docs, "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long"))
    with tidy_shuffles(spark):
        counts = materialize(line_counts(docs, min_docs, min_chars), "line_counts")
        found = counts.agg(F.count("*").alias("keys"), F.sum("n").alias("rows")).head()
        here = counts
        if found.keys * KEY_BYTES > broadcast_bytes:
            here = counts.where(F.col("n") > found.rows // HOT_KEYS)
        near, far = (LEAST_SHARDS + n // SHARD_KEYS for n in (min(found.keys, HOT_KEYS), found.keys))
        arrays = spark.sparkContext.broadcast({r.shard: r.asDict() for r in index(here, near).collect()})
        if here is counts:
            return docs.mapInArrow(_answered(arrays, near, min_docs, min_chars), ANSWER)
        shards = materialize(index(counts.where(F.col("n") <= found.rows // HOT_KEYS), far), "line_shards")
    probes = docs.mapInArrow(_sent(arrays, near, min_chars), "hi bigint, lo bigint, id bigint, mark binary") \
        .withColumn("shard", F.pmod("hi", F.lit(far)).cast("long"))
    dealt = shards.unionByName(probes, allowMissingColumns=True).repartition("shard") \
        .sortWithinPartitions("shard", F.col("bits").isNull())
    gone = dealt.mapInArrow(_routed(min_docs), "id bigint, mark binary, hi bigint, lo bigint") \
        .groupBy("id", "mark").agg(F.collect_set(F.struct("hi", "lo")).alias("gone"))  # at most the lines of one text
    marked = docs.mapInArrow(_marked, "doc_id bigint, text string, id bigint, mark binary")
    return marked.join(gone, ["id", "mark"], "left").select("doc_id", "text", "gone") \
        .mapInArrow(_answered(arrays, near, min_docs, min_chars), ANSWER)


ORACLE = r"""
WITH lines AS (SELECT doc_id, r, line, i,
                      translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
               FROM (SELECT doc_id, r, unnest(ls) AS line, generate_subscripts(ls, 1) AS i
                     FROM (SELECT doc_id, row_number() OVER () AS r, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents))),
shared AS (SELECT key, coalesce(max(doc_id), -9223372036854775808) AS last FROM lines WHERE length(key) >= 20
           GROUP BY key HAVING count(DISTINCT r) >= 3),
told AS (SELECT l.*, s.key IS NOT NULL AND s.last <> coalesce(l.doc_id, -9223372036854775808) AS gone
         FROM lines l LEFT JOIN shared s ON l.key = s.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM told GROUP BY doc_id, r
"""

shipped(__name__)
