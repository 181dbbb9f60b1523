"""Token ids packed into rows of fixed width (operator 1).

Each task tokenises its documents, splits what is longer than a row and packs
the pieces best-fit-decreasing, buffer by buffer.  Nothing is shuffled: a lost
task is repeated from its input alone and gives the same rows.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from .common import column, only, shipped

SCHEMA = ("shard int, block int, row int, input_ids binary, n_tokens int, cu_seqlens array<int>, "
          "position_resets array<int>, doc_ids array<bigint>, pieces array<int>")
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value: the split pattern that belongs to the vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Blanks before a run without blanks.  The split pattern never joins characters
#: over the end of such a stretch, so stretches may be encoded one by one.
STRETCH = r"[^\S\x1c-\x1f]*[\S\x1c-\x1f]+|[^\S\x1c-\x1f]+"


class Encoder(dict):
    """Stretch of text → its token ids as bytes, remembered up to ``limit`` stretches."""

    def __init__(self, vocabulary: bytes, limit: int = 300_000):
        import re

        import tiktoken

        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, vocabulary.splitlines())}
        self.coder = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.end = len(ranks)
        self.kind = np.dtype("<u2" if len(ranks) < 65535 else "<u4")
        self.limit, self.stretches = limit, re.compile(STRETCH).findall

    def __missing__(self, stretch: str) -> bytes:
        ids = np.array(self.coder.encode_ordinary(stretch), self.kind).tobytes()
        if len(stretch) <= 64:
            if len(self) >= self.limit:
                self.clear()
            self[stretch] = ids
        return ids

    def encode(self, text: str) -> np.ndarray:
        return np.frombuffer(b"".join(map(self.__getitem__, self.stretches(text))), self.kind)

    def decode(self, ids: np.ndarray) -> str:
        return self.coder.decode_bytes([int(i) for i in ids if i != self.end]).decode()


class Capacities:
    """Open rows by the room they have left: a segment tree over 0 … width.

    A leaf counts the rows with exactly that room, an inner node the rows below
    it; the tightest row that still takes a piece is found in log2(width) steps.
    """

    def __init__(self, width: int):
        self.leaves = 1 << width.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.rows: list[list[int]] = [[] for _ in range(width + 1)]

    def _add(self, room: int, change: int) -> None:
        node = room + self.leaves
        while node:
            self.count[node] += change
            node >>= 1

    def put(self, room: int, row: int) -> None:
        self.rows[room].append(row)
        self._add(room, 1)

    def take(self, need: int) -> tuple[int, int] | None:
        """(room, row) with the least room of at least ``need``."""
        node = need + self.leaves
        if not self.count[node]:
            while node > 1 and (node & 1 or not self.count[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.leaves:
                node = 2 * node if self.count[2 * node] else 2 * node + 1
        room = node - self.leaves
        self._add(room, -1)
        return room, self.rows[room].pop()


def best_fit_decreasing(lengths: list[int], width: int) -> list[list[int]]:
    """Piece numbers of each row; ties go by piece number."""
    rows: list[list[int]] = []
    open_rows = Capacities(width)
    for piece in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        found = open_rows.take(lengths[piece])
        room, row = found if found else (width, len(rows))
        if not found:
            rows.append([])
        rows[row].append(piece)
        if room > lengths[piece]:
            open_rows.put(room - lengths[piece], row)
    return rows


def _packed(pieces: list, width: int, end: int, kind: np.dtype, shard: int, block: int) -> pa.RecordBatch:
    """pieces: (doc_id, piece number, ids)"""
    out: dict[str, list] = {name.split()[0]: [] for name in SCHEMA.split(", ")}
    for number, row in enumerate(best_fit_decreasing([len(p[2]) for p in pieces], width)):
        ids = np.full(width, end, kind)
        bounds = [0]
        for i in row:
            ids[bounds[-1]:bounds[-1] + len(pieces[i][2])] = pieces[i][2]
            bounds.append(bounds[-1] + len(pieces[i][2]))
        for name, value in zip(out, (shard, block, number, ids.tobytes(), bounds[-1], bounds, bounds[:-1],
                                     [pieces[i][0] for i in row], [pieces[i][1] for i in row])):
            out[name].append(value)
    i32 = pa.int32()
    kinds = (i32, i32, i32, pa.binary(), i32, pa.list_(i32), pa.list_(i32), pa.list_(pa.int64()), pa.list_(i32))
    return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out.values(), kinds)], names=list(out))


def pack(docs: DataFrame, vocabulary: str = VOCABULARY, width: int = 2048,
         buffer_tokens: int = 4_000_000) -> DataFrame:
    """One row per packed sequence of exactly ``width`` ids.

    ``input_ids`` holds the ids as little-endian unsigned integers (two bytes,
    four for vocabularies beyond 65,534), padded with the end-of-text id; so
    consecutive rows are the id matrix.  ``cu_seqlens`` are the cumulative
    segment lengths from 0 to ``n_tokens``, ``position_resets`` the places where
    positions start at 0 again, ``doc_ids`` and ``pieces`` say what each segment
    is.  Every text is followed by the end-of-text id; texts longer than a row
    become pieces 0, 1, …, so that joining a document's pieces in order gives all
    its ids back.  Rows are packed within buffers of about ``buffer_tokens`` ids,
    which bounds the memory of a task.

    Null text has no row; empty text is the end-of-text id alone.  A null
    ``doc_id`` stays null; repeated rows are packed as often as they occur.
    Columns other than ``doc_id`` and ``text`` are ignored.  ``vocabulary`` is a
    file on the driver; its bytes (under a megabyte) are broadcast.
    """
    if width < 1:
        raise ValueError("width must be positive")
    with open(vocabulary, "rb") as file:
        held = docs.sparkSession.sparkContext.broadcast(file.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, shard = Encoder(held.value), TaskContext.get().partitionId()
        end = np.array([coder.end], coder.kind)
        pieces: list = []
        waiting = block = 0
        for batch in batches:
            for doc_id, text in zip(column(batch, "doc_id"), column(batch, "text")):
                if text is None:
                    continue
                ids = np.concatenate([coder.encode(text), end])
                for number, at in enumerate(range(0, len(ids), width)):
                    pieces.append((doc_id, number, ids[at:at + width]))
                waiting += len(ids)
                if waiting >= buffer_tokens:
                    yield _packed(pieces, width, coder.end, coder.kind, shard, block)
                    pieces, waiting, block = [], 0, block + 1
        if pieces:
            yield _packed(pieces, width, coder.end, coder.kind, shard, block)

    return only(docs, "doc_id", "text").mapInArrow(run, SCHEMA)


def write_packed(packed: DataFrame, path: str) -> None:
    """Rows in matrix order, one or more files per shard."""
    packed.sortWithinPartitions("shard", "block", "row").write.parquet(path)


def matrix(rows: list, kind: str = "<u2") -> np.ndarray:
    """The id matrix of some packed rows."""
    return np.stack([np.frombuffer(r.input_ids, kind) for r in rows])


shipped(__name__)
