"""Quality classifier: an interpolated modified Kneser-Ney n-gram model.

The model counts ``ORDER``-grams of UTF-8 bytes in all trusted text. Bytes need
no vocabulary and cover every language and script. Documents are packed into
blocks; a block sends each distinct n-gram once to the shard that counts it, so
what moves grows with the distinct n-grams of blocks and not with the text.
n-grams with the same context meet in one shard and travel as compressed differences.
Counts, continuation counts, contexts and discounts are tables; joins along the
orders give each n-gram of the corpus its interpolated probability, and the
shards send those back to the blocks that asked. A document's perplexity per
byte is compared with its language's threshold: a quantile of the trusted
documents' held-out perplexities. For these the trusted documents are dealt to two
folds by their doc_id, and each is scored by the model of the other fold.

Defined cases: a document with fewer than ``ORDER - 1`` bytes, or a null or
empty text, has no n-gram and a null perplexity; it alone is kept unjudged. A
text of fewer than ``LONG`` n-grams is held against trusted texts of like length
(within a factor of two), as few n-grams make perplexities spread. A null
language is a language of its own. Where a language has no trusted document of
that length, those of all languages give the threshold, then those of all
lengths in the language, then all; without any trusted document there is no
threshold and every document is kept. Repeated rows are scored alike; a doc_id
that is trusted marks all its rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dealspark.llm import exchange
from dealspark.llm.codec import expand, expand_sorted, squeeze, squeeze_sorted
from dealspark.llm.common import NULL_ID, answered, blocks, bucketed, stored, unpack

ORDER = 5
#: Of the trusted documents' perplexities in a language, this quantile ...
QUANTILE = 0.99
#: ... times this gives the threshold. Held-out perplexities need no margin.
MARGIN = 1.0

#: Texts of so many n-grams are of like length; shorter ones are told apart by powers of two.
LONG = 64

#: Text bytes of a block: the larger, the fewer blocks ask for the same n-gram.
BLOCK = 4 << 20
#: Largest dense table that numbers the n-grams of a block.
DENSE = 1 << 23


def ngrams(data: np.ndarray, order: int = ORDER) -> tuple[np.ndarray, np.ndarray]:
    """(values, number): the distinct byte n-grams of ``data`` as big-endian
    integers, ascending, and the number of the n-gram that starts at each position.

    n-grams are numbered level by level: a number and the next byte give a slot
    in a dense table, so no sort of all positions is needed.
    """
    n = len(data) - order + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    letters = np.flatnonzero(np.bincount(data, minlength=256))
    codes = np.searchsorted(letters, np.arange(256)).astype(np.int32)[data]
    values, number = letters, codes
    for k in range(1, order):
        slot = number[:len(number) - 1].astype(np.int64) * len(letters) + codes[k:]
        size = len(values) * len(letters)
        if size <= DENSE:
            seen = np.zeros(size, bool)
            seen[slot] = True
            used = np.flatnonzero(seen)
            place = np.empty(size, np.int32)
            place[used] = np.arange(len(used), dtype=np.int32)
            number = place[slot]
        else:
            used, number = np.unique(slot, return_inverse=True)
        values = (values[used // len(letters)] << 8) | letters[used % len(letters)]
    return values, number


def block_ngrams(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """ids, n-gram values, n-gram number at each position, and bounds of each
    document's positions. A line end stands before each document; n-grams never cross documents."""
    ids, offsets, raw = unpack(row)
    n = len(ids)
    starts = offsets[:-1] + np.arange(n)
    data = np.full(len(raw) + n, 10, np.uint8)
    inside = np.ones(len(data), bool)
    inside[starts] = False
    data[inside] = raw
    values, number = ngrams(data)
    ends = np.maximum(starts, offsets[1:] + np.arange(1, n + 1) - ORDER + 1)
    return ids, values, number, np.stack([starts, ends])


#: A block's counts of an n-gram in the trusted documents of each fold.
FOLDS = np.dtype([("n0", np.uint32), ("n1", np.uint32)])
#: All trusted text, and each fold's.
COUNTED = ("n", "n0", "n1")


def fold_of(ids: np.ndarray) -> np.ndarray:
    """The fold (0 or 1) of each doc_id."""
    return exchange.shard_of(ids.astype(np.int64).view(np.uint64), 2)


def _fold_counts(number: np.ndarray, bounds: np.ndarray, ids: np.ndarray, marked: list[int] | None, size: int) -> np.ndarray:
    """How often each of ``size`` n-grams stands in the trusted documents of each fold."""
    fold, out = fold_of(ids), np.zeros(size, FOLDS)
    for j, name in enumerate(FOLDS.names):
        parts = [number[bounds[0, k]:bounds[1, k]] for k in marked or () if fold[k] == j]
        if parts:
            out[name] = np.bincount(np.concatenate(parts), minlength=size)
    return out


def _all_positions(number: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    mark = np.zeros(len(number) + 1, np.int32)
    np.add.at(mark, bounds[0][bounds[0] < len(number)], 1)
    ends = bounds[1][bounds[0] < len(number)]
    np.add.at(mark, np.minimum(ends, len(number)), -1)
    return number[np.cumsum(mark[:-1], dtype=np.int32) > 0]


def _shard_of(grams: np.ndarray, shards: int) -> np.ndarray:
    """Shard of each n-gram, by its context: neighbours differ little inside a shard."""
    return exchange.shard_of(grams.astype(np.uint64) >> np.uint64(8), shards)


def _by_shard(grams: np.ndarray, shards: int) -> Iterator[tuple[int, np.ndarray]]:
    """(shard, positions of its n-grams, in their order) of ascending ``grams``."""
    of = _shard_of(grams, shards)
    order = np.argsort(of, kind="stable")
    numbers, first = np.unique(of[order], return_index=True)
    yield from zip(numbers.tolist(), np.split(order, first[1:]))


def _asked(packed: DataFrame, shards: int) -> DataFrame:
    """Each block's distinct n-grams, with their counts in its trusted documents."""
    def run(row: dict) -> Iterator[dict]:
        ids, values, number, bounds = block_ngrams(row)
        counts = _fold_counts(number, bounds, ids, row["trusted"], len(values))
        here = np.bincount(_all_positions(number, bounds), minlength=len(values)) > 0
        values, counts = values[here], counts[here]
        for shard, at in _by_shard(values, shards):
            yield {"shard": shard, "block": row["block"], "keys": squeeze_sorted(values[at]), "vals": squeeze(counts[at])}

    return exchange.map_blocks(packed, run, exchange.REQUEST, exchange.REQUEST_ARROW)


def _trusted_by_block(packed: DataFrame, trusted: DataFrame) -> DataFrame:
    """(block, trusted: positions of its trusted documents). Only ids move."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = np.frombuffer(raw, np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(ids), block)), pa.array(np.arange(len(ids), dtype=np.int32)),
                     pa.array(ids, mask=ids == NULL_ID)], ["block", "at", "doc_id"])

    places = packed.select("block", "ids").mapInArrow(rows, "block long, at int, doc_id long")
    marked = places.join(trusted.select("doc_id").distinct(), "doc_id", "left_semi")
    return marked.groupBy("block").agg(F.collect_list("at").alias("trusted"))


def _counts(asked: DataFrame) -> DataFrame:
    """(gram, n, n0, n1) of the trusted text and its folds."""
    def add(group: pa.Table) -> pa.Table:
        keys = np.concatenate([expand_sorted(k) for k in group.column("keys").to_pylist()])
        vals = np.concatenate([expand(v, FOLDS) for v in group.column("vals").to_pylist()])
        grams, number = np.unique(keys, return_inverse=True)
        n0, n1 = (np.bincount(number, weights=vals[name]).astype(np.int64) for name in FOLDS.names)
        return pa.table({"gram": grams, "n": n0 + n1, "n0": n0, "n1": n1})

    return asked.groupBy("shard").applyInArrow(add, "gram long, n long, n0 long, n1 long")


def _discounts(counts: DataFrame, names: tuple[str, ...]) -> list[tuple[float, float, float]]:
    """Modified Kneser-Ney discounts for counts of 1, 2 and more, from the counts
    of counts, for each of the columns ``names``."""
    got = counts.agg(*[F.count_if(F.col(c) == k).alias(f"{c}_{k}") for c in names for k in range(1, 5)]).first()
    out = []
    for c in names:
        n1, n2, n3, n4 = (got[f"{c}_{k}"] for k in range(1, 5))
        if not (n1 and n2 and n3):
            out.append((0.5, 0.75, 0.9))  # too little text to estimate them
            continue
        y = n1 / (n1 + 2 * n2)
        raw = 1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3
        out.append(tuple(min(max(d, 0.05), k + 0.95) for k, d in enumerate(raw)))
    return out


def probabilities(counts: DataFrame, wanted: DataFrame, names: tuple[str, ...] = COUNTED, order: int = ORDER) -> DataFrame:
    """(gram, log_…) for each ``wanted`` gram, given the highest order's ``counts``
    (gram, and one column of counts for each of the models ``names``)."""
    tables, top = {order: counts}, counts
    for k in range(order - 1, 0, -1):  # continuation counts: distinct left neighbours
        top = stored(top.groupBy((F.col("gram").bitwiseAND(F.lit((1 << 8 * k) - 1))).alias("gram"))
                     .agg(*[F.count_if(F.col(c) > 0).alias(c) for c in names]), f"kn{k}")
        tables[k] = top
    asked = {order: wanted}
    for k in range(order - 1, 0, -1):
        asked[k] = stored(asked[k + 1].select(
            F.col("gram").bitwiseAND(F.lit((1 << 8 * k) - 1)).alias("gram")).distinct(), f"asked{k}")
    below = None
    for k in range(1, order + 1):
        seen = tables[k].withColumn("context", F.shiftright("gram", 8))
        discount = {c: F.when(F.col(c) == 0, 0.0).when(F.col(c) == 1, d1).when(F.col(c) == 2, d2).otherwise(d3)
                    for c, (d1, d2, d3) in zip(names, _discounts(tables[k], names))}
        contexts = seen.groupBy("context").agg(
            *[F.sum(c).alias(f"total_{c}") for c in names], *[F.sum(discount[c]).alias(f"spare_{c}") for c in names])
        part = (asked[k].withColumn("context", F.shiftright("gram", 8))
                .join(seen.select("gram", *names), "gram", "left").join(contexts, "context", "left"))
        if below is not None:
            part = part.withColumn("suffix", F.col("gram").bitwiseAND(F.lit((1 << 8 * (k - 1)) - 1))).join(
                below.select(F.col("gram").alias("suffix"), *[F.col(f"p_{c}").alias(f"below_{c}") for c in names]), "suffix")
        p = []
        for c in names:
            known = F.col(f"total_{c}") > 0
            own = F.coalesce(F.when(known, (F.col(c) - discount[c]) / F.col(f"total_{c}")), F.lit(0.0))
            share = F.coalesce(F.when(known, F.col(f"spare_{c}") / F.col(f"total_{c}")), F.lit(1.0))
            lower = F.lit(1 / 256) if below is None else F.col(f"below_{c}")
            p.append((own + share * lower).alias(f"p_{c}"))
        below = stored(part.select("gram", *p), f"p{k}")
    return below.select("gram", *[F.log(f"p_{c}").alias(f"log_{c}") for c in names])


def _returned(asked: DataFrame, logs: DataFrame, shards: int) -> DataFrame:
    """The log probabilities (float32) of each block's n-grams, then those under
    fold 1 of n-grams in its trusted documents of fold 0, then the other way round; by block."""
    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            of = _shard_of(batch.column(0).to_numpy(), shards)
            yield pa.RecordBatch.from_arrays([pa.array(of), *batch.columns], ["shard", *batch.schema.names])

    def look_up(left: pa.Table, right: pa.Table) -> pa.Table:
        grams = right.column("gram").to_numpy()
        order = np.argsort(grams)
        grams = grams[order]
        every, by0, by1 = (right.column(f"log_{c}").to_numpy()[order].astype(np.float32) for c in COUNTED)
        found = []
        for keys, vals in zip(left.column("keys").to_pylist(), left.column("vals").to_pylist()):
            at, n = np.searchsorted(grams, expand_sorted(keys)), expand(vals, FOLDS)
            found.append(squeeze(np.concatenate([every[at], by1[at[n["n0"] > 0]], by0[at[n["n1"] > 0]]])))
        return pa.table({"block": left.column("block"), "shard": left.column("shard"),
                         "answer": pa.array(found, pa.binary())})

    by_shard = logs.mapInArrow(number, "shard int, gram long, " + ", ".join(f"log_{c} double" for c in COUNTED))
    return exchange.by_block(asked.groupBy("shard").cogroup(by_shard.groupBy("shard"))
                             .applyInArrow(look_up, exchange.ANSWER))


SCORED = "doc_id long, lang string, n_scored long, perplexity double, trusted boolean, held_out double"
SCORED_ARROW = pa.schema([("doc_id", pa.int64()), ("lang", pa.string()), ("n_scored", pa.int64()),
                          ("perplexity", pa.float64()), ("trusted", pa.bool_()), ("held_out", pa.float64())])


def score(docs: DataFrame, trusted: DataFrame) -> DataFrame:
    """doc_id, lang, n_scored (n-grams), perplexity (per byte) and trusted of each
    row of ``docs`` (doc_id, text, lang), under the model of the rows whose
    doc_id ``trusted`` (doc_id) has; held_out, for these, is the perplexity under
    the model of the other fold."""
    packed = blocks(docs, "lm_blocks", BLOCK, extra=("lang",))
    marked = answered(packed, stored(_trusted_by_block(packed, trusted), "lm_trusted"))
    shards = exchange.shard_count(packed, 0.04)
    # the only exchange of the requests: both steps that read them find a shard's in one bucket
    asked = bucketed(_asked(marked.select("block", "ids", "lens", "blob", "trusted"), shards).repartition("shard"), "lm_asked", "shard")
    every = stored(_counts(asked), "lm_counts")
    logs = probabilities(every.where("n > 0"), every.select("gram"))
    replies = _returned(asked, logs, shards)

    def run(row: dict) -> Iterator[dict]:
        ids, values, number, bounds = block_ngrams(row)
        here = np.bincount(_all_positions(number, bounds), minlength=len(values)) > 0
        counts = _fold_counts(number, bounds, ids, row["trusted"], len(values))
        logp, held = np.zeros(len(values)), np.zeros((2, len(values)), np.float32)
        asked_for, got = np.flatnonzero(here), {r["shard"]: r["answer"] for r in row["answers"] or ()}
        for shard, at in _by_shard(values[here], shards):
            at, answer = asked_for[at], expand(got[shard], np.float32)
            in0, in1 = (at[counts[name][at] > 0] for name in FOLDS.names)
            logp[at], held[0, in0], held[1, in1] = np.split(answer, [len(at), len(at) + len(in0)])
        sums = np.concatenate([[0.0], np.cumsum(logp[number])])
        last = len(sums) - 1
        a, b = np.minimum(bounds[0], last), np.minimum(bounds[1], last)
        totals, n = sums[b] - sums[a], b - a
        known, fold = set(row["trusted"] or ()), fold_of(ids)
        for k, doc_id in enumerate(ids.tolist()):
            yield {"doc_id": None if doc_id == NULL_ID else doc_id, "lang": row["extra"][k], "n_scored": int(n[k]),
                   "perplexity": math.exp(-totals[k] / n[k]) if n[k] else None, "trusted": k in known,
                   "held_out": math.exp(-held[fold[k], number[a[k]:b[k]]].mean(dtype=float))
                   if k in known and n[k] else None}

    ready = answered(marked, replies).select("block", "ids", "lens", "blob", "extra", "trusted", "answers")
    return exchange.map_blocks(ready, run, SCORED, SCORED_ARROW)


def judge(scored: DataFrame, quantile: float = QUANTILE, margin: float = MARGIN) -> DataFrame:
    """``scored`` plus threshold and kept (true where there is no n-gram or no threshold)."""
    size = F.when(F.col("n_scored") >= LONG, F.lit(math.log2(LONG))).otherwise(F.log2("n_scored")).cast("int")
    sized = scored.withColumn("size", size)
    at = F.percentile_approx("held_out", F.lit(quantile), F.lit(10_000)) * margin
    # one pass for (language, length), (language), (length) and all: a row for each
    found = stored(sized.where("trusted and held_out is not null").cube("lang", "size").agg(
        at.alias("t"), F.grouping_id().alias("over")).withColumnsRenamed({"lang": "_lang", "size": "_size"}), "lm_thresholds")
    kinds = [found.where(f"over = {k}").withColumnRenamed("t", name) for k, name in enumerate(("own", "by_lang", "by_size"))]
    overall = found.where("over = 3").agg(F.first("t")).first()[0]
    same_lang, same_size = F.col("lang").eqNullSafe(F.col("_lang")), F.col("size") == F.col("_size")
    joined = sized
    for table, on in zip(kinds, (same_lang & same_size, same_lang, same_size)):
        joined = joined.join(table, on, "left").drop("_lang", "_size", "over")
    threshold = F.coalesce("own", "by_size", "by_lang", F.lit(overall).cast("double"))
    return joined.withColumn("threshold", threshold).select(
        *[c for c in scored.columns if c != "held_out"], "threshold",
        F.coalesce(F.col("perplexity") <= F.col("threshold"), F.lit(True)).alias("kept"))


def trusted_ids(labels: DataFrame) -> DataFrame:
    """doc_ids labelled good and not toxic."""
    return labels.where("quality = 1 and coalesce(toxic, 0) = 0").select(F.col("doc_id").cast("long").alias("doc_id"))


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, lang, n_scored, perplexity, trusted, threshold, kept of each row of ``docs``."""
    return judge(stored(score(docs, trusted_ids(labels)), "lm_scored"))


def filter_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that the classifier keeps, with all their columns."""
    rejected = classify(docs, labels).where("not kept").select("doc_id").distinct()
    return docs.join(stored(rejected, "lm_rejected"), "doc_id", "left_anti").select(*docs.columns)
