"""Suffix-array dedup: remove every byte under a string of ``length`` bytes that
occurs more than once in the corpus.

1. Equal whole texts are found by digest; one of them stands for all, and texts
   of at least ``length`` bytes that have a copy are removed whole.
2. Closed syncmers of ``ANCHOR`` bytes (chosen by their own bytes alone; any
   string of ``length`` bytes holds one) are counted over the corpus. A start
   can only repeat if every anchor in its string repeats, which leaves little
   more than the repeated text.
3. Each block builds the suffix array of what is left by induced sorting, with
   permuted common prefixes. Starts whose suffixes share ``length`` bytes or
   more form a class. Shards add up the classes of all blocks (a class is one
   entry per block, however often it occurs), and blocks mark the starts of
   classes that occur twice or more.

Each step sends a note with its requests that tells which answer belongs to
which place, so the next step neither searches nor hashes the text again.
Anchors only choose what is sorted, so short hashes do for them.

Classes travel as 64 bits of their string's hash, checked against 15 more.

Defined cases: a null text is empty; a text shorter than ``length`` keeps all
its bytes. Overlapping occurrences count. Rows repeated under one doc_id are
copies of each other. Matches never cross documents.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from dealspark.llm import exchange
from dealspark.llm.common import NULL_ID, answered, blocks, stored, unpack
from dealspark.llm.rolling import Windows, closed_syncmers, short_hashes, sparse_hashes
from dealspark.llm.suffix_array import common_prefixes, suffix_array

LENGTH = 200
#: Bytes of an anchor (half of ``length``) and of its inner windows.
INNER = 16

TEXT_VAL = np.dtype([("second", np.uint64), ("rows", np.uint32)])
SECOND_BASE = 0xC2B2AE3D27D4EB4F


def _texts(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(keys, vals, which, first): the block's distinct texts by digest, which of
    them each document has, and the first document with each."""
    _, offsets, raw = unpack(row)
    data = memoryview(raw)
    digests = np.frombuffer(b"".join(
        hashlib.blake2b(data[a:b], digest_size=16).digest() for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())),
        np.dtype([("first", np.uint64), ("second", np.uint64)]))
    kinds, first, which, rows = np.unique(digests, return_index=True, return_inverse=True, return_counts=True)
    vals = np.zeros(len(kinds), TEXT_VAL)
    vals["second"], vals["rows"] = kinds["second"], np.minimum(rows, 1 << 30)
    return kinds["first"].copy(), vals, which, first


def _decide_texts(keys: np.ndarray, vals: np.ndarray, blocks: np.ndarray) -> np.ndarray:
    """1: the text has copies; 2: the block's first document with it stands for all."""
    order = np.lexsort((blocks, vals["second"], keys))
    k, s = keys[order], vals["second"][order]
    new = np.ones(len(order), bool)
    new[1:] = (k[1:] != k[:-1]) | (s[1:] != s[:-1])
    group = np.cumsum(new) - 1
    copies = np.bincount(group, weights=vals["rows"][order]) > 1
    out = np.empty(len(order), np.uint8)
    out[order] = copies[group] + 2 * new
    return out


def _text_requests(row: dict, shards: int) -> Iterator[dict]:
    keys, vals, which, _ = _texts(row)
    yield from exchange.requests(row["block"], keys, vals, shards)
    yield exchange.note(row["block"], exchange.slots(exchange.shard_of(keys, shards))[which])


class Part:
    """The documents of a block that stand for their texts, one after another."""

    def __init__(self, row: dict):
        self.ids, self.offsets, self.raw = unpack(row)
        got, (slot,) = exchange.joined(row["texts"], np.uint8), exchange.noted(row["texts"], 1)
        self.copied = (got & 1)[slot].astype(bool)  # per document
        _, first = np.unique(slot, return_index=True)  # of each distinct text
        self.chosen = np.sort(first[got >= 2])
        lens = np.diff(self.offsets)[self.chosen]
        self.bounds = np.concatenate([[0], np.cumsum(lens)])
        inside = np.zeros(len(self.raw) + 1, np.int8)
        np.add.at(inside, self.offsets[self.chosen], 1)
        np.add.at(inside, self.offsets[self.chosen + 1], -1)
        self.data = self.raw[np.cumsum(inside[:-1], dtype=np.int8).view(bool)]

    def fits(self, length: int) -> np.ndarray:
        """Whether ``length`` bytes from each position stay in its document."""
        first, last = self.bounds[:-1], self.bounds[1:] - length + 1
        room = last > first
        edge = np.zeros(len(self.data) + 1, np.int8)
        edge[first[room]], edge[last[room]] = 1, -1
        return np.cumsum(edge[:max(len(self.data) - length + 1, 0)], dtype=np.int8).view(bool)

    def anchors(self, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Positions of the closed syncmers of half of ``length``, and their hashes."""
        size = length // 2
        inner = min(INNER, max(1, size // 4))
        fits = self.fits(size)
        at = np.flatnonzero(closed_syncmers(short_hashes(self.data, inner), size - inner + 1)[:len(fits)] & fits)
        return at, sparse_hashes(self.data, at, size)


def _anchor_requests(row: dict, length: int, shards: int) -> Iterator[dict]:
    at, hashes = Part(row).anchors(length)
    keys, which, n = np.unique(hashes, return_inverse=True, return_counts=True)
    yield from exchange.requests(row["block"], keys, np.minimum(n, 2).astype(np.uint8), shards)
    yield exchange.note(row["block"], np.diff(at, prepend=0), exchange.slots(exchange.shard_of(keys, shards))[which])


def _twice(keys: np.ndarray, vals: np.ndarray, blocks: np.ndarray) -> np.ndarray:
    _, group = np.unique(keys, return_inverse=True)
    return (np.bincount(group, weights=vals) > 1)[group].astype(np.uint8)


def _candidates(part: Part, row: dict, length: int) -> np.ndarray:
    """Whether all anchors in the string that starts at each position repeat."""
    gaps, slot = exchange.noted(row["anchors"], 2)
    at = np.cumsum(gaps, dtype=np.int64)
    good = exchange.joined(row["anchors"], np.uint8)[slot].astype(bool)
    bad = np.zeros(len(part.data) + 1, np.int32)
    bad[at[~good] + 1] = 1
    np.cumsum(bad, out=bad)  # anchors before each position that do not repeat
    fits = part.fits(length)
    n = len(fits)
    reach = length - length // 2 + 1
    return fits & (bad[reach:reach + n] == bad[:n])


def _runs(marked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each run of True."""
    edge = np.diff(np.concatenate([[0], marked.astype(np.int8), [0]]))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def _classes(data: np.ndarray, first: np.ndarray, last: np.ndarray,
             length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The classes of equal strings among the candidate starts, which are the runs
    [first, last), from the suffix array of the text they cover: that text, the
    first position in it and the number of positions of each class (ascending by
    position), and the class of each start."""
    size = last - first + length - 1  # text of a run of starts
    begin = np.concatenate([[0], np.cumsum(size + 1)])  # a separator byte after each run
    n = int(begin[-1])
    origin = np.repeat(first - begin[:-1], size + 1) + np.arange(n)
    text = data[np.minimum(origin, len(data) - 1)]
    text[begin[1:] - 1] = 0
    valid = np.zeros(n + 1, np.int8)
    valid[begin[:-1]] = 1
    valid[begin[:-1] + (last - first)] = -1
    valid = np.cumsum(valid[:n], dtype=np.int8).view(bool)
    order = suffix_array(text)
    shared = common_prefixes(text, order)
    kind = np.cumsum(shared[order] < length)
    listed = valid[order]
    order, kind = order[listed], kind[listed]
    new = np.ones(len(order), bool)
    new[1:] = kind[1:] != kind[:-1]
    heads = np.flatnonzero(new)
    at = np.minimum.reduceat(order, heads)
    by_place = np.argsort(at)
    number = np.empty(len(at), np.int32)
    number[by_place] = np.arange(len(at), dtype=np.int32)
    of = np.empty(n, np.int32)
    of[order] = number[np.cumsum(new) - 1]
    return text, at[by_place], np.diff(np.append(heads, len(order)))[by_place], of[valid]


def _class_requests(row: dict, length: int, shards: int) -> Iterator[dict]:
    part = Part(row)
    first, last = _runs(_candidates(part, row, length))
    if not len(first):
        yield exchange.note(row["block"], *[first] * 5)
        return
    text, at, n, of = _classes(part.data, first, last, length)
    keys = Windows(text).at(at, at + length)
    check = Windows(text, SECOND_BASE).at(at, at + length).astype(np.uint16) & np.uint16(0x7FFF)
    yield from exchange.requests(row["block"], keys, check | (n > 1).astype(np.uint16) << np.uint16(15), shards)
    # the classes of starts that follow each other mostly do so too: a jump is where they do not
    jumps = np.flatnonzero(np.diff(of, prepend=np.int32(-2)) != 1)
    yield exchange.note(row["block"], first, last - first, np.diff(jumps, append=len(of)), of[jumps],
                        exchange.shard_of(keys, shards))


def _repeated_starts(row: dict) -> np.ndarray:
    """The starts whose classes occur twice or more, from the block's note and its answers."""
    first, size, stretch, base, shard = exchange.noted(row["classes"], 5)
    repeated = exchange.joined(row["classes"], np.uint8).astype(bool)[exchange.slots(shard)]
    starts = _ranges(first.astype(np.int64), size.astype(np.int64))
    return starts[repeated[_ranges(base.astype(np.int64), stretch.astype(np.int64))]]


def _ranges(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """first[0], first[0] + 1, ... (size[0] numbers), first[1], ..."""
    return np.repeat(first - (np.cumsum(size) - size), size) + np.arange(size.sum())


def _repeated(keys: np.ndarray, vals: np.ndarray, blocks: np.ndarray) -> np.ndarray:
    order = np.lexsort((vals & np.uint16(0x7FFF), keys))
    k, v = keys[order], vals[order]
    check, many = v & np.uint16(0x7FFF), (v >> np.uint16(15)).astype(bool)
    new = np.ones(len(order), bool)
    new[1:] = (k[1:] != k[:-1]) | (check[1:] != check[:-1])
    group = np.cumsum(new) - 1
    out = np.empty(len(order), np.uint8)
    out[order] = (np.bincount(group, weights=1 + many) > 1)[group]
    return out


def _widened(data: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Whether each byte of the UTF-8 text ``data`` lies in one of the ranges
    [first, last) or in a character that one of them cuts."""
    gone = np.zeros(len(data), bool)
    goes_on = lambda at: at < len(data) and data[at] & 0xC0 == 0x80
    for a, b in zip(first.tolist(), last.tolist()):
        for _ in range(3):  # a character has three more bytes at most
            a, b = a - (a > 0 and goes_on(a)), b + goes_on(b)
        gone[a:b] = True
    return gone


RESULT = ("doc_id long, n_bytes long, n_removed long, spans array<struct<start:long,end:long>>, kept binary, "
          "extra string")
RESULT_ARROW = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()),
                          ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                          ("kept", pa.binary()), ("extra", pa.string())])


def _results(row: dict, length: int, characters: bool) -> Iterator[dict]:
    part = Part(row)
    at = _repeated_starts(row)
    depth = np.zeros(len(part.data) + 1, np.int32)
    depth[at] += 1
    depth[at + length] -= 1
    gone = np.cumsum(depth[:-1], dtype=np.int32) > 0
    place = dict(zip(part.chosen.tolist(), range(len(part.chosen))))
    whole = memoryview(part.raw)
    for k, doc_id in enumerate(part.ids.tolist()):
        a, b = int(part.offsets[k]), int(part.offsets[k + 1])
        out = {"doc_id": None if doc_id == NULL_ID else doc_id, "n_bytes": b - a,
               "extra": row["extra"][k] if row["extra"] else None}
        if part.copied[k] and b - a >= length:
            out |= {"n_removed": b - a, "spans": [{"start": 0, "end": b - a}], "kept": b""}
        elif k in place and gone[(lo := part.bounds[place[k]]):(hi := part.bounds[place[k] + 1])].any():
            mask = gone[lo:hi]
            first, last = _runs(mask)
            data = part.data[lo:hi]
            cut = _widened(data, first, last) if characters else mask
            out |= {"n_removed": int(mask.sum()), "kept": data[~cut].tobytes(),
                    "spans": [{"start": x, "end": y} for x, y in zip(first.tolist(), last.tolist())]}
        else:
            out |= {"n_removed": 0, "spans": [], "kept": bytes(whole[a:b])}
        yield out


def remove_repeats(docs: DataFrame, length: int = LENGTH, extra: str | None = None,
                   characters: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, spans (removed byte ranges), kept (the other
    bytes, concatenated; with ``characters`` without those of characters that a
    span cuts) and extra (the string column of that name, carried along) of each
    row of ``docs`` (doc_id, text)."""
    if length < 8:
        raise ValueError("length must be 8 bytes or more")
    packed = blocks(docs, "suffix_blocks", extra=(extra,) if extra else ())
    text_shards = exchange.shard_count(packed, 0.001)
    anchor_shards = exchange.shard_count(packed, 4 / length)
    shards = exchange.shard_count(packed, 0.2)

    def ask(df: DataFrame, run) -> DataFrame:
        return exchange.map_blocks(df.drop("extra"), run, exchange.REQUEST, exchange.REQUEST_ARROW)

    def reply(df: DataFrame, decide, kind, name: str) -> DataFrame:
        return stored(exchange.answer(df, decide, kind).withColumnRenamed("answers", name), f"suffix_{name}")

    known = answered(packed, reply(ask(packed, lambda r: _text_requests(r, text_shards)), _decide_texts, TEXT_VAL, "texts"))
    anchors = reply(ask(known, lambda r: _anchor_requests(r, length, anchor_shards)), _twice, np.uint8, "anchors")
    classes = reply(ask(answered(known, anchors), lambda r: _class_requests(r, length, shards)),
                    _repeated, np.uint16, "classes")
    return exchange.map_blocks(answered(known, classes), lambda r: _results(r, length, characters), RESULT, RESULT_ARROW)


def clean_documents(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``docs`` with repeated strings cut out of ``text`` (null: empty) and
    ``n_chars``, if it is there, counted anew. Where a cut goes through a
    character, the rest of its bytes go too; all other characters stay as they are.
    Every row stays, also if nothing is left of its text; its other columns travel along as JSON."""
    others = [c for c in docs.columns if c not in ("doc_id", "text", "n_chars")]
    exact = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}
    row = F.to_json(F.struct(*[F.col(f"`{c}`") for c in others]), exact) if others else F.lit(None).cast("string")
    done = remove_repeats(docs.select("doc_id", "text", row.alias("extra")), length, "extra", characters=True)
    text = F.col("kept").cast("string")
    back = {"doc_id": F.col("doc_id").cast(docs.schema["doc_id"].dataType), "text": text}
    if "n_chars" in docs.columns:
        back["n_chars"] = F.length(text).cast(docs.schema["n_chars"].dataType)
    if others:
        kinds = StructType([docs.schema[c] for c in others])
        fields = F.from_json("extra", kinds, exact)
        back |= {c: fields[c] for c in others}
    return done.select(*[back[c].alias(c) for c in docs.columns])
