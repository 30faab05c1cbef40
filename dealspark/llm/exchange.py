"""Packed exchange: blocks ask questions about keys, shards answer them.

A block sends, per shard of the key space, one row with its distinct keys (and a
value for each) packed in binary columns. A shard sees each block's keys once,
however often they occur in it, so a key that a third of all documents hold
costs a shard one entry per block. The answers go back as one row per block and
shard, aligned with the keys, and meet the block where it lies.

A block may send a note to itself along with its requests. It comes back beside
the answers, so the next step need not derive again where each answer belongs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dealspark.llm.common import partitions

REQUEST = "shard int, block long, keys binary, vals binary"
REQUEST_ARROW = pa.schema([("shard", pa.int32()), ("block", pa.int64()), ("keys", pa.binary()), ("vals", pa.binary())])
ANSWER = "block long, shard int, answer binary"

#: Keys in a shard, about.
SHARD_KEYS = 1_000_000


def shard_count(packed: DataFrame, keys_per_byte: float) -> int:
    """So many shards that one holds about ``SHARD_KEYS`` keys, from the blocks' sizes."""
    total = packed.agg(F.sum("n_bytes").alias("n")).first()["n"] or 0
    return max(partitions(packed.sparkSession), int(total * keys_per_byte / SHARD_KEYS))


def shard_of(keys: np.ndarray, shards: int) -> np.ndarray:
    """Shard of each uint64 key: the key space cut evenly after mixing."""
    mixed = (keys * np.uint64(0x9FB21C651E98DF25)) >> np.uint64(32)
    return ((mixed * np.uint64(shards)) >> np.uint64(32)).astype(np.int32)


def sharded(keys: np.ndarray, shards: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order, numbers, bounds): ``keys[order]`` grouped by shard; shard ``numbers[i]`` has [bounds[i], bounds[i+1])."""
    of = shard_of(keys, shards)
    order = np.argsort(of, kind="stable")
    numbers, first = np.unique(of[order], return_index=True)
    return order, numbers, np.append(first, len(keys))


def requests(block: int, keys: np.ndarray, vals: np.ndarray | None, shards: int) -> Iterator[dict]:
    """Rows that send a block's distinct ``keys`` (uint64) with ``vals`` (any fixed width)."""
    order, numbers, bounds = sharded(keys, shards)
    keys = keys[order]
    vals = None if vals is None else vals[order]
    for k, shard in enumerate(numbers.tolist()):
        a, b = bounds[k], bounds[k + 1]
        yield {"shard": shard, "block": block, "keys": keys[a:b].tobytes(),
               "vals": b"" if vals is None else vals[a:b].tobytes()}


def note(block: int, *arrays: np.ndarray) -> dict:
    """A row that carries ``arrays`` (of whole numbers from 0) back to the block; its shard is below zero."""
    parts = [np.ascontiguousarray(a, np.min_scalar_type(int(a.max(initial=0)))) for a in arrays]
    head = np.array([v for a in parts for v in (len(a), a.itemsize)], np.int64)
    return {"shard": -1 - ((block >> 32) * 8191 + block & 0x3FFFFFFF), "block": block,
            "keys": b"".join([head.tobytes(), *[a.tobytes() for a in parts]]), "vals": b""}


def noted(row: list[dict], count: int) -> list[np.ndarray]:
    """The ``count`` arrays of the block's note among its answers."""
    data = next(r["answer"] for r in row if r["shard"] < 0)
    head, at, out = np.frombuffer(data, np.int64, 2 * count), 16 * count, []
    for size, width in head.reshape(-1, 2).tolist():
        out.append(np.frombuffer(data, f"u{width}", size, at))
        at += size * width
    return out


def joined(row: list[dict], dtype) -> np.ndarray:
    """A block's answers, joined by ascending shard: in the order of ``slots``."""
    got = sorted((r["shard"], r["answer"]) for r in row if r["shard"] >= 0)
    return np.frombuffer(b"".join(a for _, a in got), dtype)


def slots(of: np.ndarray) -> np.ndarray:
    """Where the answer to each key, by its shard, lies among the block's joined answers."""
    out = np.empty(len(of), np.int64)
    out[np.argsort(of, kind="stable")] = np.arange(len(of))
    return out


def answers_of(row: list[dict] | None, keys: np.ndarray, shards: int, dtype) -> np.ndarray:
    """The answers to ``keys``, in their order; ``row`` has the (shard, answer) of a block."""
    order, numbers, bounds = sharded(keys, shards)
    got = {r["shard"]: r["answer"] for r in row or ()}
    out = np.empty(len(keys), dtype)
    for k, shard in enumerate(numbers.tolist()):
        out[order[bounds[k]:bounds[k + 1]]] = np.frombuffer(got[shard], dtype)
    return out


def answer(requested: DataFrame, decide: Callable[[np.ndarray, np.ndarray, np.ndarray], np.ndarray],
           val_type, ) -> DataFrame:
    """One row (block, answers) per block: ``decide(keys, vals, blocks)`` gives an
    answer to each entry of a shard; entries come ordered by block. Notes come back as they are."""

    def run(group: pa.Table) -> pa.Table:
        if group.column("shard")[0].as_py() < 0:
            return pa.table({"block": group.column("block"), "shard": group.column("shard"), "answer": group.column("keys")})
        group = group.sort_by("block")
        keys = [np.frombuffer(k, np.uint64) for k in group.column("keys").to_pylist()]
        vals = [np.frombuffer(v, val_type) for v in group.column("vals").to_pylist()] if val_type else None
        sizes = [len(k) for k in keys]
        blocks = np.repeat(group.column("block").to_numpy(), sizes)
        got = decide(np.concatenate(keys), np.concatenate(vals) if vals else None, blocks)
        parts = np.split(got, np.cumsum(sizes)[:-1])
        return pa.table({"block": group.column("block"), "shard": group.column("shard"),
                         "answer": pa.array([p.tobytes() for p in parts], pa.binary())})

    return by_block(requested.groupBy("shard").applyInArrow(run, ANSWER))


def by_block(answers: DataFrame) -> DataFrame:
    return answers.groupBy("block").agg(F.collect_list(F.struct("shard", "answer")).alias("answers"))


def with_shard(keyed: DataFrame, shards: int) -> DataFrame:
    """``keyed`` (key: long, and others) with the shard of each key before it."""
    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            of = shard_of(batch.column(0).to_numpy().view(np.uint64), shards)
            yield pa.RecordBatch.from_arrays([pa.array(of), *batch.columns], ["shard", *batch.schema.names])

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in keyed.schema)
    return keyed.mapInArrow(number, f"shard int, {fields}")


def map_blocks(packed: DataFrame, run: Callable[[dict], Iterator[dict]], schema: str, arrow: pa.Schema,
               limit: int = 4 << 20) -> DataFrame:
    """``run`` over each block's row; yields batches of about ``limit`` bytes."""
    names = packed.columns

    def batches(incoming: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in incoming:
            for k in range(batch.num_rows):
                rows, size = [], 0
                for row in run({n: batch.column(i)[k].as_py() for i, n in enumerate(names)}):
                    rows.append(row)
                    size += sum(len(v) for v in row.values() if isinstance(v, (bytes, str))) + 64
                    if size > limit:
                        yield pa.RecordBatch.from_pylist(rows, arrow)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, arrow)

    return packed.mapInArrow(batches, schema)
