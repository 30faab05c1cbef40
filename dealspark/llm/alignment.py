"""Cross-tokenizer alignment of distinct texts.

Rows are shuffled by their full text, so each distinct text is tokenised and
aligned once, however many documents hold it; copies of a text that a third of
all rows share are counted in each map task first. Both tokenizers cut the same
bytes (a space, then the text). Offsets where a token of either ends cut the
tokens into groups; the tokens that end a group are a link. Links of an id pair
are counted over the corpus, each text's weighted by its multiplicity. Blocks of
texts ask the shards for the counts of their distinct pairs, and the measures
so gained are joined to the doc_ids by the text's SHA-256.

Defined cases: a null or empty text, or one that a tokenizer does not give back
byte for byte, has no tokens: zeros, and an empty ``groups``. Rows of one doc_id
are documents of their own, repeated rows too; a null doc_id stays null. An
empty table gives no rows. Texts are tokenised whole, whatever their length.
"""

from __future__ import annotations

import hashlib
import json
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dealspark.llm import exchange
from dealspark.llm.codec import expand, expand_sorted, squeeze, squeeze_sorted
from dealspark.llm.common import answered, bucketed, stored
from dealspark.llm.packing import token_ids

#: Text bytes that are aligned in one step (one text at least).
BLOCK = 2 << 20

MEASURES = "n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"

_tables: dict[tuple[str, str], tuple[list[bytes], object]] = {}


def byte_level_table(path: str) -> list[bytes]:
    """The bytes of each id of a byte-level ``tokenizers`` file."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]  # the byte-level alphabet (fixed): these stand for themselves
    letters = {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(sorted(set(range(256)) - set(own)))}
    with open(path, encoding="utf-8") as f:
        vocab = json.load(f)["model"]["vocab"]
    out = [b""] * (max(vocab.values()) + 1)
    for token, i in vocab.items():
        out[i] = bytes(letters[c] for c in token)
    return out


def piece_table(model) -> list[bytes]:
    """The bytes of each id of a sentencepiece model."""
    return [bytes([int(model.id_to_piece(i)[3:-1], 16)]) if model.is_byte(i)
            else model.id_to_piece(i).replace("▁", " ").encode() for i in range(model.get_piece_size())]


class Aligner:
    """Tokenises and aligns texts; ``a_path`` is a byte-level ``tokenizers`` file, ``b_path`` a sentencepiece model."""

    def __init__(self, a_path: str, b_path: str):
        import sentencepiece
        self.encode_a = token_ids(a_path)
        self.model = sentencepiece.SentencePieceProcessor(model_file=b_path)
        self.bytes_a, self.bytes_b = byte_level_table(a_path), piece_table(self.model)
        self.length_a, self.length_b = (np.array([len(t) for t in table]) for table in (self.bytes_a, self.bytes_b))
        # decimal ids with what follows them: an A id inside its group or at its end, then the same of B
        self.written = np.array([f"{i}{end}".encode() for table, ends in ((self.bytes_a, ",|"), (self.bytes_b, ",;"))
                                 for i in range(len(table)) for end in ends], object)

    def tokens(self, text: str) -> tuple[np.ndarray, list[int]] | None:
        """A's and B's ids, or None where one does not give the bytes back."""
        whole = b" " + text.encode()
        a, b = np.frombuffer(self.encode_a(" " + text), "<u4"), self.model.encode(text, num_threads=1)
        if whole == b"".join(map(self.bytes_a.__getitem__, a.tolist())) == b"".join(map(self.bytes_b.__getitem__, b)):
            return a, b
        return None

    def align(self, texts: list[str]) -> dict[str, np.ndarray | list]:
        """Per text n_a, n_b, n_groups and groups (bytes); per link a, b and the text's number."""
        found = [self.tokens(t) if t else None for t in texts]
        n_a, n_b = (np.array([len(f[k]) if f else 0 for f in found], np.int64) for k in (0, 1))
        a = np.concatenate([np.zeros(0, np.int64), *[f[0] for f in found if f]]).astype(np.int64)
        b = np.array([i for f in found if f for i in f[1]], np.int64)
        ends_a, ends_b = np.cumsum(self.length_a[a]), np.cumsum(self.length_b[b])
        last_a, last_b = np.isin(ends_a, ends_b, assume_unique=True), np.isin(ends_b, ends_a, assume_unique=True)
        at_a, at_b = np.flatnonzero(last_a), np.flatnonzero(last_b)
        text = np.searchsorted(np.cumsum(n_a), at_a, "right")
        # the written order: a group's A tokens, then its B tokens
        code = np.empty(len(a) + len(b), np.int64)
        code[np.arange(len(a)) + np.append(0, at_b + 1)[np.cumsum(last_a) - last_a]] = 2 * a + last_a
        code[np.arange(len(b)) + (at_a + 1)[np.cumsum(last_b) - last_b]] = 2 * (len(self.bytes_a) + b) + last_b
        cuts = np.append(0, np.cumsum(n_a + n_b))
        groups = [b"".join(self.written[code[x:y]].tolist())[:-1] for x, y in zip(cuts[:-1].tolist(), cuts[1:].tolist())]
        return {"n_a": n_a, "n_b": n_b, "n_groups": np.bincount(text, minlength=len(texts)), "groups": groups,
                "a": a[at_a], "b": b[at_b], "text": text}


def _aligner(paths: tuple[str, str]) -> Aligner:
    if paths not in _tables:
        _tables[paths] = Aligner(*paths)
    return _tables[paths]


ALIGNED = "block long, n_bytes long, texts binary, sizes binary, pairs binary, weights binary, held binary, number binary, times binary"
ALIGNED_ARROW = pa.schema([("block", pa.int64()), ("n_bytes", pa.int64()), *[
    (n, pa.binary()) for n in ("texts", "sizes", "pairs", "weights", "held", "number", "times")]])
#: What a block keeps of each text: the digests of its text and groups, and n_a, n_b, n_groups.
KEPT = "<32s32sqqq"


def _aligned(distinct: DataFrame, paths: tuple[str, str]) -> DataFrame:
    """Distinct texts (text, copies) in blocks: their measures and, for each, its distinct pairs and how often it holds them."""
    def block(number: int, texts: list[str], copies: np.ndarray) -> dict:
        got = _aligner(paths).align(texts)
        pairs, pair = np.unique((got["a"] << 32) | got["b"], return_inverse=True)
        held, times = np.unique(got["text"] * max(len(pairs), 1) + pair, return_counts=True)
        text, pair = np.divmod(held, max(len(pairs), 1))
        weights = np.zeros(len(pairs), np.int64)
        np.add.at(weights, pair, times * copies[text])
        kept = [struct.pack(KEPT, hashlib.sha256(t.encode()).digest(), hashlib.sha256(g).digest(), *n)
                for t, g, *n in zip(texts, got["groups"], *(got[c].tolist() for c in ("n_a", "n_b", "n_groups")))]
        return {"block": number, "n_bytes": sum(len(t) for t in texts), "texts": b"".join(kept), "sizes": squeeze(copies),
                "pairs": squeeze_sorted(pairs), "weights": squeeze(weights),
                "held": squeeze(np.bincount(text, minlength=len(texts)).astype(np.int64)),
                "number": squeeze(np.diff(pair, prepend=0).astype(np.int32)), "times": squeeze(times.astype(np.uint32))}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        number = TaskContext.get().partitionId() << 32
        texts, copies, size = [], [], 0
        for batch in batches:
            for text, n in zip(batch.column(0), batch.column(1).to_pylist()):
                texts.append(text.as_py())
                copies.append(n)
                size += len(texts[-1])
                if size >= BLOCK:
                    yield pa.RecordBatch.from_pylist([block(number, texts, np.array(copies))], ALIGNED_ARROW)
                    texts, copies, size, number = [], [], 0, number + 1
        if texts:
            yield pa.RecordBatch.from_pylist([block(number, texts, np.array(copies))], ALIGNED_ARROW)

    return distinct.mapInArrow(run, ALIGNED)


def _pair_counts(blocks: DataFrame) -> DataFrame:
    """(pair, n: its links in the corpus, best: whether no pair of its B id has more)."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for pairs, weights in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                yield pa.RecordBatch.from_arrays([pa.array(expand_sorted(pairs)), pa.array(expand(weights, np.int64))], ["pair", "n"])

    counts = blocks.select("pairs", "weights").mapInArrow(rows, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    # a B id pairs with no more A ids than tokenizer A has, so a window is bounded by the vocabulary
    same_b = Window.partitionBy(F.col("pair").bitwiseAND(F.lit((1 << 32) - 1)))
    return counts.select("pair", "n", (F.col("n") == F.max("n").over(same_b)).alias("best"))


def _asked(blocks: DataFrame, shards: int) -> DataFrame:
    def run(row: dict) -> Iterator[dict]:
        yield from exchange.requests(row["block"], expand_sorted(row["pairs"]).astype(np.uint64), None, shards)

    return exchange.map_blocks(blocks.select("block", "pairs"), run, exchange.REQUEST, exchange.REQUEST_ARROW)


ANSWER = np.dtype([("n", np.int64), ("best", np.bool_)])


def _replies(asked: DataFrame, counts: DataFrame, shards: int) -> DataFrame:
    """Each block's answers: count and best of its pairs."""
    def look_up(left: pa.Table, right: pa.Table) -> pa.Table:
        pairs = right.column("key").to_numpy()
        order = np.argsort(pairs)
        known = np.empty(len(order), ANSWER)
        known["n"], known["best"] = (right.column(c).to_numpy()[order] for c in ANSWER.names)
        found = [known[np.searchsorted(pairs[order], np.frombuffer(k, np.int64))].tobytes() for k in left.column("keys").to_pylist()]
        return pa.table({"block": left.column("block"), "shard": left.column("shard"), "answer": pa.array(found, pa.binary())})

    by_shard = exchange.with_shard(counts.select(F.col("pair").alias("key"), "n", "best"), shards)
    return exchange.by_block(asked.groupBy("shard").cogroup(by_shard.groupBy("shard")).applyInArrow(look_up, exchange.ANSWER))


MEASURED_ARROW = pa.schema([("key", pa.string()), *[
    (n, pa.int64()) for n in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")], ("groups_sha256", pa.string())])


def _measured(answered_blocks: DataFrame, shards: int) -> DataFrame:
    """One row per distinct text: its SHA-256 (hex) and its measures."""
    def run(row: dict) -> Iterator[dict]:
        held, number, times = expand(row["held"], np.int64), np.cumsum(expand(row["number"], np.int32)), expand(row["times"], np.uint32)
        got = exchange.answers_of(row["answers"], expand_sorted(row["pairs"]).astype(np.uint64), shards, ANSWER)
        text = np.repeat(np.arange(len(held)), held)
        sums = []
        for value in (times * got["best"][number], times * got["n"][number]):
            total = np.zeros(len(held), np.int64)
            np.add.at(total, text, value.astype(np.int64))
            sums.append(total.tolist())
        for (key, groups, n_a, n_b, n), best, count in zip(struct.iter_unpack(KEPT, row["texts"]), *sums):
            yield {"key": key.hex(), "n_a": n_a, "n_b": n_b, "n_groups": n, "n_links": n, "n_best": best, "count_sum": count,
                   "groups_sha256": groups.hex() if n_a else ""}

    return exchange.map_blocks(answered_blocks, run, "key string, " + MEASURES, MEASURED_ARROW)


def align(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256
    of each row of ``docs`` (doc_id, text)."""
    picked = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    distinct = picked.where("text <> ''").groupBy("text").agg(F.count("*").alias("copies"))
    blocks = bucketed(_aligned(distinct, (a_path, b_path)), "align_blocks")
    counts = stored(_pair_counts(blocks), "align_counts")
    shards = exchange.shard_count(blocks, 0.05)
    replies = _replies(_asked(blocks, shards), counts, shards)
    ready = answered(blocks.select("block", "texts", "pairs", "held", "number", "times"), replies)
    # a stored table beside the doc_ids: Spark may split the rows of a text that very many documents hold
    measures = stored(_measured(ready, shards), "align_measures")
    rows = picked.select("doc_id", F.when(F.col("text") != "", F.sha2(F.encode("text", "UTF-8"), 256)).alias("key"))
    zero = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")]
    # null keys match nothing; a key of their own spreads them over the tasks
    spread = rows.withColumn("key", F.coalesce("key", F.concat(F.lit("-"), F.monotonically_increasing_id())))
    return spread.join(measures, "key", "left").select("doc_id", *zero, F.coalesce("groups_sha256", F.lit("")).alias("groups_sha256"))
