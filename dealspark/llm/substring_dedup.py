"""Substring dedup by level-wise doubling of repeated word windows.

A window of ``WINDOW`` words that occurs in a smaller document can only do so
if all its shorter windows repeat. So windows of a quarter of its length are
counted first, at anchors (closed syncmers of word pairs, chosen by their own
words, of which every window holds some); where all anchors in a window repeat
across documents, the anchors are extended to twice the length and counted
again; starts that still survive are extended to the full window. The last
level finds the smallest document of each surviving window, and the words of
windows that a smaller document has go.

A block sends each distinct window once, with what its own documents say about
it, so frequent passages cost one entry per block. Windows travel as one hash of
their bytes modulo 2**61 - 1, on the last level with a second one at another base.

Defined cases: words are maximal runs outside ``\\x20\\x09-\\x0D``; a null, empty
or blank text has none, and a text of fewer words than a window keeps them all.
Rows repeated under one doc_id are one document: their common windows do not
count against each other. A null doc_id is smaller than any other.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from dealspark.llm import exchange
from dealspark.llm.common import NULL_ID, answered, blocks, stored, unpack
from dealspark.llm.near_dedup import words_of
from dealspark.llm.rolling import Windows, closed_syncmers

WINDOW = 50
SECOND_BASE = 0xC2B2AE3D27D4EB4F
LAST_VAL = np.dtype([("second", np.uint64), ("low", np.int64)])


def levels(window: int) -> tuple[int, int]:
    """The two shorter lengths: doubling reaches ``window`` in two steps."""
    first = max(2, -(-window // 4))
    return first, min(2 * first, window)


class Part:
    """The words of a block: their hashes, documents, and where each document ends."""

    def __init__(self, row: dict):
        self.ids, self.offsets, self.raw = unpack(row)
        self.starts, self.ends, self.bounds, self.data = words_of(self.raw, self.offsets, lower=False)
        self.words = Windows(self.data).at(self.starts, self.ends)
        self.runs = Windows(self.words)
        sizes = np.diff(self.bounds)
        self.doc = np.repeat(np.arange(len(self.ids)), sizes)
        self.stop = np.repeat(self.bounds[1:], sizes)

    def fits(self, starts: np.ndarray, length: int) -> np.ndarray:
        return starts[starts + length <= self.stop[starts]]

    def anchors(self, window: int) -> np.ndarray:
        """Starts of anchors in documents that hold a window."""
        first, _ = levels(window)
        at = np.flatnonzero(closed_syncmers(self.runs.all(2), first - 1))
        at = self.fits(at, first)
        return at[np.diff(self.bounds)[self.doc[at]] >= window]

    def counted(self, starts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(keys, documents up to 2, which key each start has) of the windows at ``starts``."""
        keys, which = np.unique(self.runs.at(starts, starts + length), return_inverse=True)
        ids = self.ids[self.doc[starts]]
        low = np.full(len(keys), np.iinfo(np.int64).max)
        high = np.full(len(keys), np.iinfo(np.int64).min)
        np.minimum.at(low, which, ids)
        np.maximum.at(high, which, ids)
        return keys, (1 + (low < high)).astype(np.uint8), which

    def survivors(self, window: int, row: dict, shards: int) -> tuple[np.ndarray, np.ndarray]:
        """(anchors to count on the next level, starts of windows still alive) after the levels that ``row`` answers."""
        at = self.anchors(window)
        starts = self.fits(np.arange(max(len(self.words) - window + 1, 0)), window)
        lengths = (*levels(window), window)
        for k, column in enumerate(("first", "second")):
            if column not in row:
                break
            keys, _, which = self.counted(at, lengths[k])
            good = exchange.answers_of(row[column], keys, shards, np.uint8)[which].astype(bool)
            bad = np.zeros(len(self.words) + 1, np.int32)
            bad[at[~good] + 1] = 1
            bad = np.cumsum(bad)
            starts = starts[bad[starts + window - lengths[k] + 1] == bad[starts]]
            at = self._inside(self.fits(at[good], lengths[k + 1]), starts, window - lengths[k + 1])
        return at, starts

    def _inside(self, at: np.ndarray, starts: np.ndarray, slack: int) -> np.ndarray:
        """Those of ``at`` that stand at most ``slack`` words after one of ``starts``."""
        reach = np.zeros(len(self.words) + 2 + slack, np.int32)
        reach[starts] += 1
        np.subtract.at(reach, starts + slack + 1, 1)
        return at[np.cumsum(reach)[at] > 0]


def _in_two(keys: np.ndarray, vals: np.ndarray, blocks: np.ndarray) -> np.ndarray:
    """Whether two documents have the window (one document may lie in two blocks as repeated rows)."""
    _, group = np.unique(keys, return_inverse=True)
    return (np.bincount(group, weights=vals) > 1)[group].astype(np.uint8)


def _level_requests(row: dict, window: int, level: int, shards: int) -> Iterator[dict]:
    part = Part(row)
    length = levels(window)[level]
    at, _ = part.survivors(window, row, shards)
    keys, vals, _ = part.counted(at, length)
    yield from exchange.requests(row["block"], keys, vals, shards)


def _windows(part: Part, starts: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(keys, vals, which window each start has) on the last level; vals hold the smallest doc_id of the block."""
    both = np.empty(len(starts), [("key", np.uint64), ("second", np.uint64)])
    both["key"] = part.runs.at(starts, starts + window)
    # a second hash of the bytes, from which the words' second hashes come
    again = Windows(part.data, SECOND_BASE).at(part.starts, part.ends)
    both["second"] = Windows(again, SECOND_BASE).at(starts, starts + window)
    order = np.lexsort((both["second"], both["key"]))
    ordered = both[order]
    new = np.ones(len(order), bool)
    new[1:] = ordered[1:] != ordered[:-1]
    which = np.empty(len(order), np.int64)
    which[order] = np.cumsum(new) - 1
    kinds = ordered[new]
    vals = np.zeros(len(kinds), LAST_VAL)
    vals["second"], vals["low"] = kinds["second"], np.iinfo(np.int64).max
    np.minimum.at(vals["low"], which, part.ids[part.doc[starts]])
    return kinds["key"].copy(), vals, which


def _last_requests(row: dict, window: int, level_shards: int, shards: int) -> Iterator[dict]:
    part = Part(row)
    _, starts = part.survivors(window, row, level_shards)
    keys, vals, _ = _windows(part, starts, window)
    yield from exchange.requests(row["block"], keys, vals, shards)


def _is_smaller_elsewhere(keys: np.ndarray, vals: np.ndarray, blocks: np.ndarray) -> np.ndarray:
    order = np.lexsort((vals["low"], vals["second"], keys))
    k, s = keys[order], vals["second"][order]
    new = np.ones(len(order), bool)
    new[1:] = (k[1:] != k[:-1]) | (s[1:] != s[:-1])
    low = vals["low"][order]
    out = np.empty(len(order), np.uint8)
    out[order] = low[new][np.cumsum(new) - 1] < low
    return out


RESULT = "doc_id long, n_words long, n_removed long, kept binary"
RESULT_ARROW = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()),
                          ("kept", pa.binary())])


def _results(row: dict, window: int, level_shards: int, shards: int) -> Iterator[dict]:
    part = Part(row)
    _, starts = part.survivors(window, row, level_shards)
    keys, vals, which = _windows(part, starts, window)
    elsewhere = exchange.answers_of(row["third"], keys, shards, np.uint8).astype(bool)
    gone = starts[elsewhere[which] | (vals["low"][which] < part.ids[part.doc[starts]])]
    depth = np.zeros(len(part.words) + 1, np.int32)
    depth[gone] += 1
    np.subtract.at(depth, gone + window, 1)
    left = np.cumsum(depth[:-1]) == 0
    whole = part.raw.tobytes()
    for k, doc_id in enumerate(part.ids.tolist()):
        a, b = int(part.bounds[k]), int(part.bounds[k + 1])
        words = whole[part.offsets[k]:part.offsets[k + 1]].split()
        mask = left[a:b]
        removed = b - a - int(np.count_nonzero(mask))
        yield {"doc_id": None if doc_id == NULL_ID else doc_id, "n_words": b - a, "n_removed": removed,
               "kept": b" ".join(compress(words, mask.tolist()) if removed else words)}


def remove_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_removed and kept (UTF-8: the words that stay, joined
    by one space) of each row of ``docs`` (doc_id, text)."""
    if window < 8:
        raise ValueError("window must be 8 words or more")
    packed = blocks(docs, "substring_blocks").drop("extra")
    level_shards = exchange.shard_count(packed, 0.03)
    shards = exchange.shard_count(packed, 0.05)

    def reply(df: DataFrame, run, decide, kind, name: str) -> DataFrame:
        asked = exchange.map_blocks(df, run, exchange.REQUEST, exchange.REQUEST_ARROW)
        return stored(exchange.answer(asked, decide, kind).withColumnRenamed("answers", name), f"substring_{name}")

    known = packed
    for level, name in enumerate(("first", "second")):
        known = answered(known, reply(known, lambda r, level=level: _level_requests(r, window, level, level_shards),
                                      _in_two, np.uint8, name))
    known = answered(known, reply(known, lambda r: _last_requests(r, window, level_shards, shards),
                                  _is_smaller_elsewhere, LAST_VAL, "third"))
    return exchange.map_blocks(known, lambda r: _results(r, window, level_shards, shards), RESULT, RESULT_ARROW)
