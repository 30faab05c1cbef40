"""MinHash near-dedup: a multi-index Hamming join over b-bit signatures.

A document's set is the distinct ``size``-word shingles of its lower-cased
words. Its signature has ``SYMBOLS`` MinHash values of ``BITS`` bits; the
distance of two signatures is the number of symbols in which they differ. The
signature is split into ``CHUNKS``; by pigeonhole, two signatures at distance
``MAX_DISTANCE`` or less differ in at most ``ERRORS`` symbols of some chunk, so
enumerating each chunk with every ``ERRORS`` symbols left out makes all such
pairs meet under an equal key. A pair of 85 % similarity is farther apart with
a probability of 9.5e-5, one of 80 % with 5.1e-3.

Documents with equal sets are one representative, known by the set's hashes.
The representatives under a key meet its smallest one, never each other;
components of these meetings are candidate groups. The full sets decide every
link (100 * intersection >= percent * union). In a group that fills more than a
part, members are first held against the smallest set they meet and then one of
each class so linked against the others; only classes that are still apart are
compared member by member, dealt to parts of bounded size of which every two
meet in one task. Tasks return a spanning forest of their links, so what is sent
and emitted grows with the members, and not with the pairs, of a group.

Defined cases: a null, empty or blank text has an empty set and is linked with
nothing; a text of fewer words than a shingle has its whole word sequence as
its only shingle. All rows under one doc_id are one document: whatever one of
its texts links with, it is linked with; all rows of a kept doc_id are kept. A null doc_id is a document of
its own kind: all null ids count as one id, smaller than any other.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dealspark.llm import exchange
from dealspark.llm.common import NULL_ID, answered, blocks, stored, unpack
from dealspark.llm.components import components, parents
from dealspark.llm.rolling import Windows, mix

SYMBOLS, BITS, CHUNKS, MAX_DISTANCE = 64, 16, 11, 21
ERRORS = MAX_DISTANCE // CHUNKS

#: A part of a candidate group: documents and shingles at most, on average.
PART_DOCS, PART_SHINGLES = 192, 150_000

_rng = np.random.default_rng(20240229)
FACTORS = (_rng.integers(0, 1 << 63, SYMBOLS, dtype=np.uint64) << np.uint64(1)) | np.uint64(1)
SALTS = _rng.integers(0, 1 << 63, SYMBOLS, dtype=np.uint64)


def key_masks() -> list[tuple[int, ...]]:
    """The symbols that make up each key: a chunk without ``ERRORS`` of its symbols."""
    cuts = [SYMBOLS * k // CHUNKS for k in range(CHUNKS + 1)]
    return [kept for a, b in zip(cuts, cuts[1:]) for kept in combinations(range(a, b), b - a - ERRORS)]


def words_of(raw: np.ndarray, offsets: np.ndarray, lower: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each word in a padded copy of the block's bytes, the
    first word of each document (and the number of words), and the copy."""
    n = len(offsets) - 1
    data = np.full(len(raw) + n + 1, 10, np.uint8)
    inside = np.ones(len(data), bool)
    firsts = offsets[:-1] + np.arange(n)
    inside[firsts] = False
    inside[-1] = False
    data[inside] = raw
    if lower:
        data = np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)
    space = (data == 32) | ((data >= 9) & (data <= 13))
    turn = np.flatnonzero(space[1:] != space[:-1]) + 1
    starts, ends = turn[::2], turn[1::2]
    bounds = np.append(np.searchsorted(starts, firsts), len(starts))
    return starts, ends, bounds, data


def shingle_sets(raw: np.ndarray, offsets: np.ndarray, size: int) -> list[np.ndarray]:
    """Each document's shingles as distinct 64-bit hashes, ascending."""
    starts, ends, bounds, data = words_of(raw, offsets, lower=True)
    words = Windows(data).at(starts, ends)
    runs = Windows(words, base=0xD1342543DE82EF95).all(size)
    return [_set(words, runs, a, b, size) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]


def _set(words: np.ndarray, runs: np.ndarray, a: int, b: int, size: int) -> np.ndarray:
    if b - a >= size:
        return np.unique(runs[a:b - size + 1])
    if b == a:
        return words[:0]
    return Windows(words[a:b], base=0xA24BAED4963EE407).all(b - a)


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """(documents, SYMBOLS) uint16; rows of empty sets are unspecified."""
    out = np.zeros((len(sets), SYMBOLS), np.uint16)
    full = [k for k, s in enumerate(sets) if len(s)]
    if full:
        every = np.concatenate([sets[k] for k in full])
        starts = np.concatenate([[0], np.cumsum([len(sets[k]) for k in full])[:-1]])
        for j in range(SYMBOLS):
            values = ((every ^ SALTS[j]) * FACTORS[j]) >> np.uint64(24)
            out[full, j] = (np.minimum.reduceat(values, starts) & np.uint64((1 << BITS) - 1)).astype(np.uint16)
    return out


def keys_of(signature: np.ndarray) -> np.ndarray:
    """(documents, keys) uint64."""
    made = []
    for number, kept in enumerate(key_masks()):
        h = np.full(len(signature), number + 1, np.uint64)
        for k in kept:
            h = (h ^ signature[:, k].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
        made.append(mix(h))
    return np.stack(made, axis=1) if len(signature) else np.zeros((0, len(key_masks())), np.uint64)


SKETCH = "block long, n_bytes long, ids binary, sizes binary, first binary, second binary, signatures binary"
SKETCH_ARROW = pa.schema([("block", pa.int64()), ("n_bytes", pa.int64()), *[
    (n, pa.binary()) for n in ("ids", "sizes", "first", "second", "signatures")]])


def _sketch(packed: DataFrame, size: int) -> DataFrame:
    """Per block: set sizes, two hashes of each set, and signatures."""
    def run(row: dict) -> Iterator[dict]:
        ids, offsets, raw = unpack(row)
        sets = shingle_sets(raw, offsets, size)
        first = np.array([s.sum(dtype=np.uint64) for s in sets], np.uint64)
        second = np.array([mix(s ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64) for s in sets], np.uint64)
        yield {"block": row["block"], "n_bytes": row["n_bytes"], "ids": ids.tobytes(),
               "sizes": np.array([len(s) for s in sets], np.int64).tobytes(), "first": mix(first).tobytes(),
               "second": second.tobytes(), "signatures": signatures(sets).tobytes()}

    return exchange.map_blocks(packed.select("block", "n_bytes", "ids", "lens", "blob"), run, SKETCH, SKETCH_ARROW)


def _arrays(row: dict) -> tuple[np.ndarray, ...]:
    return (np.frombuffer(row["ids"], np.int64), np.frombuffer(row["sizes"], np.int64),
            np.frombuffer(row["first"], np.uint64), np.frombuffer(row["second"], np.uint64),
            np.frombuffer(row["signatures"], np.uint16).reshape(-1, SYMBOLS))


SET_ANSWER = np.dtype([("name", np.int64), ("here", np.bool_)])


def _own_sets(row: dict) -> tuple[np.ndarray, np.ndarray]:
    """(keys, vals): the two hashes of each distinct non-empty set of the block."""
    _, sizes, first, second, _ = _arrays(row)
    k = np.flatnonzero(sizes > 0)
    k = k[np.lexsort((second[k], first[k]))]
    new = np.ones(len(k), bool)
    new[1:] = (first[k][1:] != first[k][:-1]) | (second[k][1:] != second[k][:-1])
    return first[k][new], second[k][new]


def _name_sets(keys: np.ndarray, vals: np.ndarray, blocks: np.ndarray) -> np.ndarray:
    """A name for each set, by its hashes alone, and whether this block's document stands for it."""
    order = np.lexsort((blocks, vals, keys))
    k, s = keys[order], vals[order]
    other_key = np.ones(len(order), bool)
    other_key[1:] = k[1:] != k[:-1]
    new = other_key.copy()
    new[1:] |= s[1:] != s[:-1]
    heads = np.flatnonzero(new)
    first_of_key = other_key[heads]  # a set whose first hash another one has too is named by its second hash
    names = np.where(first_of_key, k[heads], mix(s[heads] ^ np.uint64(0x9FB21C651E98DF25))).view(np.int64)
    out = np.empty(len(order), SET_ANSWER)
    out["name"][order] = names[np.cumsum(new) - 1]
    out["here"][order] = new
    return out


def _named(row: dict, shards: int) -> tuple[np.ndarray, np.ndarray]:
    """(name of each document's set, whether the document stands for it): one
    document of all that have a set does; empty sets have no name (0)."""
    ids, sizes, first, second, _ = _arrays(row)
    keys, vals = _own_sets(row)
    got = exchange.answers_of(row["answers"], keys, shards, SET_ANSWER)
    both = np.zeros(len(keys), [("f", np.uint64), ("s", np.uint64)])
    both["f"], both["s"] = keys, vals
    want = np.zeros(len(ids), both.dtype)
    want["f"], want["s"] = first, second
    full = np.flatnonzero(sizes > 0)
    at = np.searchsorted(both, want[full])
    names, stands = np.zeros(len(ids), np.int64), np.zeros(len(ids), bool)
    names[full] = got["name"][at]
    _, once = np.unique(at, return_index=True)
    stands[full[once]] = got["here"][at[once]]
    return names, stands


DOCS = "block long, at int, doc_id long, n_shingles long, name long, stands boolean"
DOCS_ARROW = pa.schema([("block", pa.int64()), ("at", pa.int32()), ("doc_id", pa.int64()),
                        ("n_shingles", pa.int64()), ("name", pa.int64()), ("stands", pa.bool_())])


def _document_rows(known: DataFrame, shards: int) -> DataFrame:
    def batches(incoming: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in incoming:
            for row in batch.to_pylist():
                ids, sizes, *_ = _arrays(row)
                names, stands = _named(row, shards)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(ids), row["block"])), pa.array(np.arange(len(ids), dtype=np.int32)),
                     pa.array(ids), pa.array(sizes), pa.array(names), pa.array(stands)], schema=DOCS_ARROW)

    return known.mapInArrow(batches, DOCS)


def _leading(row: dict, shards: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(names, key number of each of their keys, distinct keys): of the sets that the block's documents stand for."""
    *_, signature = _arrays(row)
    names, stands = _named(row, shards)
    own = np.flatnonzero(stands)
    keys, number = np.unique(keys_of(signature[own]), return_inverse=True)
    return names[own], number.reshape(len(own), len(key_masks())), keys


def _key_requests(known: DataFrame, shards: int, key_shards: int) -> DataFrame:
    """A block's distinct keys, each with the smallest representative that has it."""
    def run(row: dict) -> Iterator[dict]:
        ids, number, keys = _leading(row, shards)
        low = np.full(len(keys), np.iinfo(np.int64).max)
        np.minimum.at(low, number.ravel(), np.repeat(ids, number.shape[1]))
        yield from exchange.requests(row["block"], keys, low, key_shards)

    return exchange.map_blocks(known, run, exchange.REQUEST, exchange.REQUEST_ARROW)


def _smallest_of_key(keys: np.ndarray, vals: np.ndarray, blocks: np.ndarray) -> np.ndarray:
    _, number = np.unique(keys, return_inverse=True)
    low = np.full(int(number.max()) + 1, np.iinfo(np.int64).max)
    np.minimum.at(low, number, vals)
    return low[number]


MEETINGS_ARROW = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _meetings(known: DataFrame, shards: int, key_shards: int) -> DataFrame:
    """(a, b): each representative with the smallest one under each of its keys."""
    def batches(incoming: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in incoming:
            for row in batch.to_pylist():
                ids, number, keys = _leading(row, shards)
                low = exchange.answers_of(row["leaders"], keys, key_shards, np.int64)
                pairs = np.unique(np.stack([low[number].ravel(), np.repeat(ids, number.shape[1])], axis=1), axis=0)
                pairs = pairs[pairs[:, 0] != pairs[:, 1]]
                yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], schema=MEETINGS_ARROW)

    return known.mapInArrow(batches, "a long, b long")


def _large(members: DataFrame) -> DataFrame:
    """(pool): those whose members do not fit in one part."""
    sizes = members.groupBy("pool").agg(F.count("*").alias("n"), F.sum("n_shingles").alias("s"))
    return sizes.where((F.col("n") > PART_DOCS) | (F.col("s") > PART_SHINGLES)).select("pool")


def _dealt(members: DataFrame) -> DataFrame:
    """(block, at, id, pool, part, parts, own_from, own_to): ``members`` (id,
    pool, class, ...) dealt to parts of bounded size. A class that fills a part
    has parts of its own, [own_from, own_to), which need not meet each other;
    smaller classes share parts. Pools of one class are done."""
    fill = F.greatest(F.ceil(F.sum("n") / PART_DOCS), F.ceil(F.sum("s") / PART_SHINGLES)).cast("int")
    classes = stored(members.groupBy("pool", "class").agg(F.count("*").alias("n"), F.sum("n_shingles").alias("s")), "near_classes")
    big = (F.col("n") > PART_DOCS) | (F.col("s") > PART_SHINGLES)
    pools = classes.groupBy("pool").agg(F.count("*").alias("classes")).where("classes > 1").drop("classes")
    shared = classes.where(~big).groupBy("pool").agg(fill.alias("shared"))
    own = classes.where(big).groupBy("pool", "class").agg(fill.alias("own"))
    upto = Window.partitionBy("pool").orderBy("class").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = own.join(shared, "pool", "left").withColumn("own_to", (F.sum("own").over(upto) + F.coalesce("shared", F.lit(0))).cast("int"))
    total = placed.groupBy("pool").agg(F.max("own_to").alias("all"))
    pools = stored(pools.join(shared, "pool", "left").join(total, "pool", "left").select(
        "pool", F.coalesce("shared", F.lit(0)).alias("shared"), F.coalesce("all", "shared").alias("parts")), "near_pools")
    placed = stored(placed.select("pool", "class", (F.col("own_to") - F.col("own")).alias("own_from"), "own_to"), "near_placed")
    spread = lambda n: F.pmod(F.xxhash64("id"), n).cast("int")
    part = F.coalesce(F.col("own_from") + spread(F.col("own_to") - F.col("own_from")), spread(F.col("shared")))
    none = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return members.join(pools, "pool").join(placed, ["pool", "class"], "left").select(
        "block", "at", "id", "pool", part.alias("part"), "parts", none("own_from"), none("own_to"))


MEMBERS = "pool long, left_part int, right_part int, part int, id long, members binary"
MEMBERS_ARROW = pa.schema([("pool", pa.int64()), ("left_part", pa.int32()), ("right_part", pa.int32()),
                           ("part", pa.int32()), ("id", pa.int64()), ("members", pa.binary())])


def _member_sets(packed: DataFrame, dealt: DataFrame, size: int) -> DataFrame:
    """The set of each dealt member, once for every pair of parts that holds its part and can link it."""
    at_block = dealt.groupBy("block").agg(
        F.collect_list(F.struct("at", "id", "pool", "part", "parts", "own_from", "own_to")).alias("wanted"))

    def run(row: dict) -> Iterator[dict]:
        wanted = row["wanted"]
        if not wanted:
            return
        _, offsets, raw = unpack(row)
        chosen, which = np.unique([w["at"] for w in wanted], return_inverse=True)
        pieces = [raw[offsets[k]:offsets[k + 1]] for k in chosen.tolist()]
        sets = shingle_sets(np.concatenate(pieces), np.concatenate([[0], np.cumsum([len(p) for p in pieces])]), size)
        for w, k in zip(wanted, which.tolist()):
            data = sets[k].tobytes()
            for other in range(w["parts"]):
                if not w["own_from"] <= other < w["own_to"]:
                    yield {"pool": w["pool"], "left_part": min(w["part"], other), "right_part": max(w["part"], other),
                           "part": w["part"], "id": w["id"], "members": data}

    ready = answered(packed, stored(at_block, "near_wanted")).where("wanted is not null")
    return exchange.map_blocks(ready.select("block", "ids", "lens", "blob", "wanted"), run, MEMBERS, MEMBERS_ARROW)


def _stars(members: DataFrame, met: DataFrame) -> DataFrame:
    """As ``_dealt``: each member beside the smallest set that it meets, in
    parts of bounded size. A pool here is that leader's name; the leader goes to all its parts."""
    leader = met.groupBy(F.col("b").alias("id")).agg(F.min("a").alias("leader"))
    led = stored(members.join(leader, "id"), "near_led")
    sizes = stored(led.groupBy("leader").agg(F.greatest(F.ceil(F.count("*") / PART_DOCS), F.ceil(F.sum("n_shingles") / PART_SHINGLES)).cast("int").alias("n")),
                   "near_stars")
    # part k meets part k alone: all parts but its own are marked as done
    row = lambda df, part: df.select("block", "at", "id", "leader", part.alias("part"))
    own = row(led.join(sizes, "leader"), F.pmod(F.xxhash64("id"), F.col("n")).cast("int"))
    heads = members.join(sizes.withColumnRenamed("leader", "id"), "id").withColumn("leader", F.col("id"))
    both = own.union(row(heads.withColumn("k", F.explode(F.sequence(F.lit(0), F.col("n") - 1))), F.col("k")))
    return both.select("block", "at", "id", F.col("leader").alias("pool"), "part", (F.col("part") + 1).alias("parts"),
                       F.lit(0).alias("own_from"), F.col("part").alias("own_to"))


def overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """Intersection sizes of all pairs of a bounded number of sets, by matrix products over slices of their shingles."""
    sizes = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(len(sets)), sizes)
    shingles, column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = count > 1  # a shingle of one set adds to no intersection of two
    place = np.cumsum(shared) - 1
    inside = shared[column]
    owner, column = owner[inside], place[column[inside]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    out = np.zeros((len(sets), len(sets)), np.int64)
    width = 8192
    for a in range(0, int(shared.sum()), width):
        lo, hi = np.searchsorted(column, [a, a + width])
        slab = np.zeros((len(sets), width), np.float32)
        slab[owner[lo:hi], column[lo:hi] - a] = 1
        out += np.rint(slab @ slab.T).astype(np.int64)
    out[np.arange(len(sets)), np.arange(len(sets))] = sizes
    return out


def forest(linked: np.ndarray) -> list[tuple[int, int]]:
    """A spanning forest of the graph with this boolean matrix, by breadth-first search."""
    seen, out = np.zeros(len(linked), bool), []
    for root in range(len(linked)):
        if seen[root]:
            continue
        seen[root] = True
        queue = [root]
        while queue:
            u = queue.pop()
            new = np.flatnonzero(linked[u] & ~seen)
            seen[new] = True
            out += [(u, v) for v in new.tolist()]
            queue += new.tolist()
    return out


def _verified(sets: DataFrame, percent: int) -> DataFrame:
    """(a, b): links that hold on the full sets, a spanning forest for each pair of parts."""
    def run(group: pa.Table) -> pa.Table:
        ids, members = group.column("id").to_numpy(), group.column("members").to_pylist()
        order = np.argsort(ids, kind="stable")
        ids = ids[order]
        held = [np.frombuffer(members[k], np.uint64) for k in order.tolist()]
        both = overlaps(held)
        sizes = np.diag(both)
        union = sizes[:, None] + sizes[None, :] - both
        links = forest((100 * both >= percent * union) & ~np.eye(len(ids), dtype=bool))
        a, b = (np.array([x[k] for x in links], np.int64) for k in (0, 1))
        return pa.table({"a": pa.array(ids[a], pa.int64()), "b": pa.array(ids[b], pa.int64())})

    return sets.groupBy("pool", "left_part", "right_part").applyInArrow(run, "a long, b long")


def _linked_to_leader(sets: DataFrame, percent: int) -> DataFrame:
    """(a, b): the leader of each star part with those of its members that link with it."""
    def run(group: pa.Table) -> pa.Table:
        leader = group.column("pool")[0].as_py()
        ids, members = group.column("id").to_numpy(), [np.frombuffer(m, np.uint64) for m in group.column("members").to_pylist()]
        head = members[int(np.flatnonzero(ids == leader)[0])]
        found = []
        for name, own in zip(ids.tolist(), members):
            both = int((head[np.minimum(np.searchsorted(head, own), len(head) - 1)] == own).sum())
            if name != leader and 100 * both >= percent * (len(head) + len(own) - both):
                found.append(name)
        return pa.table({"a": pa.array([leader] * len(found), pa.int64()), "b": pa.array(found, pa.int64())})

    return sets.groupBy("pool", "left_part", "right_part").applyInArrow(run, "a long, b long")


def _links(packed: DataFrame, members: DataFrame, met: DataFrame, size: int, percent: int) -> DataFrame:
    """(a, b): links of the same components as all pairs of a pool's ``members``
    (id, pool, block, at, n_shingles) that hold on the full sets.

    The members of a large pool are first held against the smallest set they
    meet, then one of each class so found against one of every other; only
    members of classes that are still apart are compared with each other. So
    the sets sent grow with the members and with what stays unlinked.
    """
    def compared(some: DataFrame) -> DataFrame:
        dealt = stored(_dealt(some), "near_dealt")
        return stored(_verified(_member_sets(packed, dealt, size), percent), "near_links")

    def classed(links: DataFrame) -> DataFrame:
        found = parents(links).select(F.col("node").alias("id"), F.col("component").alias("class"))
        return stored(many.join(found, "id", "left").withColumn("class", F.coalesce("class", "id")), "near_classed")

    large = stored(_large(members), "near_large")
    alone = members.withColumn("class", F.col("id"))
    if large.isEmpty():
        return compared(alone)
    many = stored(members.join(large, "pool", "left_semi"), "near_many")
    links = stored(_linked_to_leader(_member_sets(packed, _stars(many, met), size), percent), "near_stars")
    one_each = classed(links).where("id = class")
    links = links.union(compared(one_each))
    rest = classed(links).select("id", "pool", "block", "at", "n_shingles", "class").unionByName(
        alone.join(large, "pool", "left_anti").select("id", "pool", "block", "at", "n_shingles", "class"))
    return links.union(compared(rest))


def _same_id(rows: DataFrame) -> DataFrame | None:
    """(a, b): links between the different sets of one doc_id."""
    full = rows.where("n_shingles > 0").select("doc_id", "name")
    several = stored(full.groupBy("doc_id").agg(F.min("name").alias("a"), F.max("name").alias("z")).where("a <> z"), "near_shared_ids")
    return None if several.isEmpty() else full.join(several, "doc_id").select("a", F.col("name").alias("b"))


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id reachable over links)
    and kept (it is its component's smallest) of each row of ``docs`` (doc_id, text)."""
    packed = blocks(docs, "near_blocks")
    sketch = stored(_sketch(packed, size), "near_sketch")
    shards = exchange.shard_count(packed, 0.001)

    def own_sets(row: dict) -> Iterator[dict]:
        keys, vals = _own_sets(row)
        # entries whose first hashes are equal stay in order: the sort by shard is stable
        yield from exchange.requests(row["block"], keys, vals, shards)

    asked = exchange.map_blocks(sketch, own_sets, exchange.REQUEST, exchange.REQUEST_ARROW)
    known = stored(sketch.join(exchange.answer(asked, _name_sets, np.uint64), "block", "left"), "near_known")
    rows = stored(_document_rows(known, shards), "near_documents")

    key_shards = exchange.shard_count(packed, 0.02)
    leaders = exchange.answer(_key_requests(known, shards, key_shards), _smallest_of_key, np.int64)
    led = known.join(leaders.withColumnRenamed("answers", "leaders"), "block", "left")
    met = stored(_meetings(led, shards, key_shards), "near_met")
    pools = stored(components(met), "near_pools")

    members = stored(rows.where("stands").join(pools, rows.name == pools.node).select(
        F.col("name").alias("id"), F.col("component").alias("pool"), "block", "at", "n_shingles"), "near_members")
    links = _links(packed, members, met, size, percent)
    same = _same_id(rows)
    found = parents(links if same is None else links.union(same))

    full = rows.where("n_shingles > 0")
    sets = full.groupBy("name").agg(F.min("doc_id").alias("low"))
    placed = stored(sets.join(found, sets.name == found.node, "left").select(
        "name", "low", F.coalesce("component", "name").alias("root")), "near_placed_sets")
    smallest = placed.groupBy("root").agg(F.min("low").alias("component"))
    # a stored table beside the rows: Spark may split the rows of a set that very many documents have
    known_sets = stored(placed.join(smallest, "root").select("name", "component"), "near_known_sets")
    joined = full.join(known_sets, "name").select("doc_id", "n_shingles", "component").unionByName(
        rows.where("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component")))
    real = lambda c: F.when(c != NULL_ID, c)
    return joined.select(real(F.col("doc_id")).alias("doc_id"), "n_shingles", real(F.col("component")).alias("component_id"),
                         (F.col("doc_id") == F.col("component")).alias("kept"))


def filter_documents(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """One document of each group of near duplicates, with all its columns.
    Rows that repeat its doc_id stay with it, and so do rows without a doc_id."""
    dropped = near_duplicates(docs, size, percent).where("not kept").select("doc_id").distinct()
    return docs.join(stored(dropped, "near_dropped"), "doc_id", "left_anti").select(*docs.columns)
