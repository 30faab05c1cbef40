"""Byte-level BPE encoding and decoding as a monoid tree reduction.

Each match of the vocabulary's pattern is encoded by itself: halves are encoded
recursively and joined. A join re-encodes a window around the boundary, growing
it until the tokens outside provably stay as they are: a token sequence is the
encoding of its bytes exactly if every two neighbours are the encoding of
theirs, so it is enough that the window's outer tokens agree with the tokens
next to it. Joins depend on few tokens, so their results are kept and looked
up. Joining is associative, hence any split of the bytes gives the same tokens.
Decoding concatenates the tokens' bytes up the same tree.

Defined cases: a null or empty text has no tokens (an empty ``ids``). Strings
of special tokens are ordinary text. Documents are independent rows: there is
no shuffle, repeated rows give repeated results, and the vocabulary file is
read on each executor from ``path`` (a parameter).
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dealspark.llm.chunks import ChunkCache

#: Bytes up to which a half is encoded by merging directly.
LEAF = 4
#: Kept halves and joins are dropped when there are so many.
MEMO = 200_000

SCHEMA = "doc_id long, n_tokens long, ids string, decoded binary"


class Encoder:
    """Encodes bytes to token ids by tree reduction; ``ranks`` maps token bytes to ids."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import regex
        self.ranks = ranks
        self.find = regex.compile(pattern).findall
        self.bytes_of = {v: k for k, v in ranks.items()}
        self.halves: dict[bytes, tuple[int, ...]] = {}
        self.joins: dict[tuple, tuple[int, ...]] = {}

    def merge(self, piece: bytes) -> tuple[int, ...]:
        """Merge neighbours, lowest rank and then leftmost first, until none merge."""
        ranks, n = self.ranks, len(piece)
        if n > 48:
            return self._merge_long(piece)
        parts = [piece[i:i + 1] for i in range(n)]
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                r = ranks.get(parts[i] + parts[i + 1])
                if r is not None and (best is None or r < best):
                    best, at = r, i
            if best is None:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return tuple(ranks[p] for p in parts)

    def _merge_long(self, piece: bytes) -> tuple[int, ...]:
        """The same with a heap over a linked list of parts, O(n log n)."""
        ranks, n = self.ranks, len(piece)
        end, before = list(range(1, n + 1)), list(range(-1, n))  # of the part that starts at i

        def push(i: int) -> None:
            j = end[i]
            if i >= 0 and j < n and (r := ranks.get(piece[i:end[j]])) is not None:
                heapq.heappush(heap, (r, i, j, end[j]))

        heap: list[tuple[int, int, int, int]] = []
        alive = [True] * n
        for i in range(n - 1):
            push(i)
        while heap:
            _, i, j, stop = heapq.heappop(heap)
            if not (alive[i] and end[i] == j and j < n and alive[j] and end[j] == stop):
                continue
            end[i], alive[j] = stop, False
            if stop < n:
                before[stop] = i
                push(i)
            if before[i] >= 0:
                push(before[i])
        return tuple(ranks[piece[i:end[i]]] for i in range(n) if alive[i])

    def _window(self, left: tuple[int, ...], right: tuple[int, ...]) -> tuple[int, ...]:
        """Encoding of the bytes of ``left + right``."""
        key = (left, right)
        got = self.joins.get(key)
        if got is None:
            if len(self.joins) > MEMO:
                self.joins.clear()
            got = self.merge(b"".join(self.bytes_of[t] for t in left + right))
            if len(left) + len(right) <= 8:
                self.joins[key] = got
        return got

    def join(self, left: tuple[int, ...], right: tuple[int, ...]) -> tuple[int, ...]:
        if not left or not right:
            return left or right
        i = j = 1
        while True:
            inner = self._window(left[-i:], right[:j])
            grow_left = i < len(left) and self._window(left[-i - 1:-i], inner[:1]) != (left[-i - 1], inner[0])
            grow_right = j < len(right) and self._window(inner[-1:], right[j:j + 1]) != (inner[-1], right[j])
            if not (grow_left or grow_right):
                return left[:-i] + inner + right[j:]
            i = min(len(left), 2 * i) if grow_left else i
            j = min(len(right), 2 * j) if grow_right else j

    def encode_piece(self, piece: bytes) -> tuple[int, ...]:
        got = self.halves.get(piece)
        if got is None:
            n = len(piece)
            got = self.merge(piece) if n <= LEAF else self.join(
                self.encode_piece(piece[:n // 2]), self.encode_piece(piece[n // 2:]))
            if n <= 24:
                if len(self.halves) > MEMO:
                    self.halves.clear()
                self.halves[piece] = got
        return got

    def encode(self, text: str) -> list[int]:
        return [t for piece in self.find(text) for t in self.encode_piece(piece.encode())]

    def decode(self, ids) -> bytes:
        """The tokens' bytes, concatenated pair by pair up the tree."""
        parts = [self.bytes_of[t] for t in ids]
        while len(parts) > 1:
            odd = parts[-1:] if len(parts) % 2 else []
            parts = [a + b for a, b in zip(parts[::2], parts[1::2])] + odd
        return parts[0] if parts else b""


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


_loaded: dict[tuple[str, str], tuple[Encoder, ChunkCache]] = {}


def encoder(path: str, pattern: str) -> tuple[Encoder, ChunkCache]:
    """One per Python worker. Cache entries are (decimal ids joined by spaces, decoded bytes)."""
    if (path, pattern) not in _loaded:
        enc = Encoder(load_ranks(path), pattern)

        def entries(chunks: list[str]) -> list[tuple[bytes, bytes]]:
            made = map(enc.encode, chunks)
            return [(" ".join(map(str, ids)).encode(), enc.decode(ids)) for ids in made]

        _loaded[path, pattern] = enc, ChunkCache(entries)
    return _loaded[path, pattern]


def encode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids (decimal, joined by one space) and decoded (the
    bytes that the ids decode to) of each row of ``docs`` (doc_id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, cache = encoder(path, pattern)
        for batch in batches:
            for a in range(0, batch.num_rows, 256):
                part = batch.slice(a, 256)
                ids, decoded, counts = [], [], []
                for entries in cache.of_texts([text or "" for text in part.column(1).to_pylist()]):
                    line = b" ".join([e[0] for e in entries])
                    ids.append(line.decode())
                    decoded.append(b"".join([e[1] for e in entries]))
                    counts.append(line.count(b" ") + 1 if line else 0)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(counts, pa.int64()), pa.array(ids, pa.string()),
                     pa.array(decoded, pa.binary())], ["doc_id", "n_tokens", "ids", "decoded"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, SCHEMA)


def decode(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id and decoded bytes of rows (doc_id, ids) as ``encode`` gives them; null ids decode to nothing."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, _ = encoder(path, pattern)
        for batch in batches:
            out = [enc.decode(map(int, line.split())) if line else b"" for line in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], ["doc_id", "decoded"])

    return encoded.select(F.col("doc_id").cast("long"), "ids").mapInArrow(run, "doc_id long, decoded binary")
