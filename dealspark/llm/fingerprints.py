"""Document fingerprints from closed syncmers.

A window of ``K`` characters is an anchor if the smallest of its inner windows
of ``S`` characters (by hash) lies at its start or its end. The choice depends
on the window alone, so shared passages share their anchors wherever they
stand, and any ``K - S`` successive windows hold one: anchors overlap and cover
shared text without gaps. A fingerprint lists anchors in text order as
(position, 40-bit hash), so matches are positional: the likeness of two
fingerprints is, of the characters under their anchors, the share under
anchors whose hash the other one has too. Equal texts have a likeness of 1.

Defined cases: a null or empty text has the fingerprint of an empty text; two
empty texts are alike (1.0). A text shorter than ``K`` has one anchor, itself.
Long texts are processed whole. Repeated rows and ties of ``doc_id`` are ordered
by doc_id and then text (nulls first); the next row of the last one is the first.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dealspark.llm.common import NULL_ID, partitions
from dealspark.llm.rolling import Windows, closed_syncmers

K, S = 32, 12
HASH_BITS = 40


class Fingerprint:
    """Anchors of one text; ``str`` gives the fingerprint, ``parse`` reads it back."""

    def __init__(self, n_chars: int, starts: np.ndarray, hashes: np.ndarray):
        self.n_chars, self.starts, self.hashes = n_chars, starts, hashes

    def __str__(self) -> str:
        """``n_chars:`` and base64 of 4-byte positions, then of 5-byte hashes."""
        body = (self.starts.astype("<u4").tobytes()
                + self.hashes.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :HASH_BITS // 8].tobytes())
        return f"{self.n_chars}:{base64.b64encode(body).decode()}"

    @classmethod
    def parse(cls, text: str) -> Fingerprint:
        n, body = text.split(":")
        raw = np.frombuffer(base64.b64decode(body), np.uint8)
        m = len(raw) // 9
        wide = np.zeros((m, 8), np.uint8)
        wide[:, :5] = raw[4 * m:].reshape(m, 5)
        return cls(int(n), raw[:4 * m].view("<u4").astype(np.int64), wide.reshape(-1).view("<u8"))

    def covered(self, shared: np.ndarray) -> int:
        """Characters under the anchors that ``shared`` marks."""
        starts = self.starts[shared]
        if not len(starts):
            return 0
        length = min(K, self.n_chars)
        return int(np.minimum(np.diff(starts), length).sum()) + length

    def likeness(self, other: Fingerprint) -> float:
        total = sum(f.covered(np.ones(len(f.hashes), bool)) for f in (self, other))
        if not total:
            return 1.0
        both = np.intersect1d(self.hashes, other.hashes)
        return (self.covered(np.isin(self.hashes, both)) + other.covered(np.isin(other.hashes, both))) / total


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), "<u4")


def fingerprint(chars: np.ndarray) -> Fingerprint:
    n, mask = len(chars), np.uint64((1 << HASH_BITS) - 1)
    windows = Windows(chars)
    if n < K:
        starts = np.zeros(min(n, 1), np.int64)
        return Fingerprint(n, starts, windows.at(starts, starts + n) & mask)
    starts = np.flatnonzero(closed_syncmers(windows.all(S), K - S + 1))
    return Fingerprint(n, starts, windows.at(starts, starts + K) & mask)


def edited(text: str, following: str) -> str:
    """``text`` with its last quarter replaced by as many first characters of the next text."""
    n = len(text) // 4
    return text[:len(text) - n] + following[:n]


def with_next(docs: DataFrame) -> DataFrame:
    """(slot, border, doc_id, text) dealt so that each slot holds a range of
    doc_ids and, as its border row, the first document of the next slot.

    Slots are cut at quantiles of the ids (one pass over ids); texts move once.
    The borders are one id per slot, and the slots as many as partitions.
    """
    spark = docs.sparkSession
    n = partitions(spark)
    own = F.col("doc_id").cast("long")
    reserved = F.raise_error(F.lit(f"the id {NULL_ID} stands for null ids; rows must not use it")).cast("long")
    rows = docs.select(F.when(own == NULL_ID, reserved).otherwise(F.coalesce(own, F.lit(NULL_ID))).alias("doc_id"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    share = [k / n for k in range(1, n)]
    cuts = F.expr(f"percentile_approx(doc_id, array({','.join(map(str, share))}), 10000)") if share else F.lit(None)
    cuts = sorted(set(rows.agg(cuts.alias("c")).first()["c"] or []))
    slot = F.size(F.filter(_longs(cuts), lambda c: c < F.col("doc_id"))) if cuts else F.lit(0)
    rows = rows.select(slot.alias("slot"), "doc_id", "text")
    first = rows.groupBy("slot").agg(F.min("doc_id").alias("doc_id"))  # a row per slot
    firsts = [tuple(r) for r in first.agg(F.sort_array(F.collect_list(F.struct("slot", "doc_id"))).alias("f")).first()["f"]]
    if not firsts:
        return rows.select("slot", F.lit(0).alias("border"), "doc_id", "text")
    at = F.array_position(_longs([first for _, first in firsts]), F.col("doc_id")).cast("int")
    before = _longs([firsts[k - 1][0] for k in range(len(firsts))])
    also = F.when(at > 0, F.element_at(before, at).cast("int"))
    copies = F.array_compact(F.array(F.struct(F.col("slot"), F.lit(0).alias("border")),
                                     F.when(also.isNotNull(), F.struct(also.alias("slot"), F.lit(1).alias("border")))))
    return (rows.select(F.explode(copies).alias("at"), "doc_id", "text")
            .select("at.slot", "at.border", "doc_id", "text"))


def _longs(values: list[int]) -> Column:
    """An array of numbers as one literal, so that a plan does not grow with the slots."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>")


SCHEMA = ("doc_id long, n_chars long, edited_text string, fingerprint string, edited_fingerprint string, "
          "near_edited double, near_next double")


def compare(docs: DataFrame) -> DataFrame:
    """Fingerprints of each row of ``docs`` (doc_id, text) and of its edited
    text, and the likeness of its fingerprint to that and to the next row's."""
    dealt = with_next(docs)
    n = partitions(docs.sparkSession)
    ordered = dealt.repartitionByRange(n, "slot").sortWithinPartitions("slot", "border", "doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the row that waits for its next one: (slot, doc_id, text, fingerprint)
        for batch in batches:
            out = [[] for _ in range(7)]
            size = 0
            slots, borders = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            ids, texts = batch.column(2).to_pylist(), batch.column(3)
            for slot, border, doc_id, text in zip(slots, borders, ids, texts):
                text = text.as_py()
                if border and (held is None or held[0] != slot):
                    continue  # further rows of the border id; the first one closed the slot
                own = fingerprint(code_points(text))
                if held is not None and held[0] == slot:
                    made = edited(held[2], text)
                    after = fingerprint(code_points(made))
                    row = (held[1], len(held[2]), made, str(held[3]), str(after),
                           held[3].likeness(after), held[3].likeness(own))
                    for column, value in zip(out, row):
                        column.append(value)
                    size += len(made)
                held = None if border else (slot, doc_id, text, own)
                if size > 4 << 20:
                    yield _batch(out)
                    out, size = [[] for _ in range(7)], 0
            if out[0]:
                yield _batch(out)

    return ordered.mapInArrow(run, SCHEMA)


def _batch(out: list[list]) -> pa.RecordBatch:
    ids = np.array(out[0], np.int64)
    return pa.RecordBatch.from_arrays(
        [pa.array(ids, mask=ids == NULL_ID), pa.array(out[1], pa.int64()), *[pa.array(c, pa.string()) for c in out[2:5]],
         pa.array(out[5], pa.float64()), pa.array(out[6], pa.float64())],
        ["doc_id", "n_chars", "edited_text", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])
