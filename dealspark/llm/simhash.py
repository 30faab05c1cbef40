"""SimHash near-dedup: an exact Hamming join by vantage-point trees.

A document's fingerprint is the SimHash of its word shingles under XXH64. Equal
fingerprints are one point. A tree over a bounded sample of the points cuts the
space: a node has a vantage point and a radius, the points within it go inside
and the others outside. Every point is a member of one leaf; by the triangle
inequality a point may link into a leaf beyond a boundary only if it lies
within ``DISTANCE`` of that boundary, so such points visit the leaf as well.
Only the outer side of a member boundary visits the inner one, so that each pair
meets once. A leaf is joined in one task by a vantage-point tree of its own.

Where many points lie within ``DISTANCE`` of the vantage point, they are linked
with it at once and never compared with each other; tasks return spanning
forests. So a ball of near copies costs links in proportion to its members.

Defined cases: a text that is null, empty or blank has fingerprint zero, linked
like any other; a text of fewer words than a shingle is one shingle. Rows that
repeat a doc_id are documents of their own. A null doc_id stays null; it is no
component's smallest unless the component has no other. An empty table gives no
rows. Texts are read whole, a piece at a time.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dealspark.llm import grid
from dealspark.llm.common import stored
from dealspark.llm.components import components

DISTANCE = 3
SEED = 42
#: Points that the shared tree is fitted on, at most; every point is then routed through it.
SAMPLE = 16_384
#: Points in a leaf of the shared tree, about.
LEAF = 32_768
#: Points that are compared directly.
DIRECT = 96
#: Bytes of a text whose words are held at a time.
PIECE = 1 << 20

LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
SPACE = re.compile(rb"[\x20\x09-\x0D]")


def _words(data: bytes) -> Iterator[list[bytes]]:
    """The words of a text, in lists of bounded size."""
    start = 0
    while start < len(data):
        cut = SPACE.search(data, start + PIECE)
        end = cut.start() if cut else len(data)
        yield data[start:end].split()
        start = end


def fingerprint(data: bytes, size: int) -> int:
    """SimHash of the ``size``-word shingles (repeats included) of the lower-cased words."""
    from xxhash import xxh64_intdigest
    ones, n, held = np.zeros(64, np.int64), 0, []

    def add(hashes: list[int]) -> None:
        nonlocal ones, n
        ones += np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
        n += len(hashes)

    for words in _words(data.translate(LOWER)):
        words = held + words
        if len(words) >= size:
            joined = b" ".join(words)
            starts = np.cumsum([0, *[len(w) + 1 for w in words]])
            ends = (starts[size:] - 1).tolist()
            add([xxh64_intdigest(joined[a:b], SEED) for a, b in zip(starts.tolist(), ends)])
        held = words[max(0, len(words) - size + 1):]
    if not n and held:
        add([xxh64_intdigest(b" ".join(held), SEED)])
    return sum(1 << k for k in np.flatnonzero(2 * ones > n).tolist())


def fingerprints(docs: DataFrame, size: int = 3) -> DataFrame:
    """(doc_id, fingerprint: long) of each row of ``docs`` (doc_id, text)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = np.array([fingerprint(t.as_py(), size) if t.is_valid else 0 for t in batch.column(1)], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made.view(np.int64))], ["doc_id", "fingerprint"])

    picked = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string").cast("binary"))
    return picked.mapInArrow(run, "doc_id long, fingerprint long")


@dataclass
class Node:
    """Points within ``radius`` of ``vantage`` go inside, the others outside; a
    ``ball`` has all inner points linked with the vantage point itself."""
    vantage: int
    radius: int
    ball: bool
    inside: Node | int
    outside: Node | int


def _distances(points: np.ndarray, vantage: int) -> np.ndarray:
    return np.bitwise_count(points ^ np.uint64(vantage)).astype(np.int16)


def _split(points: np.ndarray, distance: int, balls: bool = True, tries: int = 8) -> tuple[int, int, bool] | None:
    """(vantage, radius, ball) with few points at the boundary; None where nothing splits."""
    best = None
    for k in np.unique(np.linspace(0, len(points) - 1, tries).astype(int)).tolist():
        vantage = int(points[k])
        d = _distances(points, vantage)
        near = int((d <= distance).sum())
        if balls and near >= 16 and 8 * near >= len(points):
            return vantage, distance, True
        radius = int(np.median(d))
        if (d <= radius).all():
            radius = int(d.max()) - 1
        inner = int((d <= radius).sum())
        edge = int(((d > radius - distance) & (d <= radius + distance)).sum())
        if 0.03 <= inner / len(points) <= 0.97:
            cost = edge + abs(2 * inner - len(points))
            best = min(best or (cost, vantage, radius), (cost, vantage, radius))
    return None if best is None else (best[1], best[2], False)


def shared_tree(sample: np.ndarray, leaf: int, distance: int) -> tuple[Node | int, list[bool]]:
    """A tree over ``sample`` with ``leaf`` sample points in a leaf, about; and whether each leaf is a ball."""
    balls: list[bool] = []

    def grow(points: np.ndarray, ball: bool) -> Node | int:
        cut = _split(points, distance) if len(points) > leaf and not ball else None
        if cut is None:
            balls.append(ball)
            return len(balls) - 1
        vantage, radius, is_ball = cut
        inside = _distances(points, vantage) <= radius
        return Node(vantage, radius, is_ball, grow(points[inside], is_ball), grow(points[~inside], False))

    return grow(sample, False), balls


def route(node: Node | int, points: np.ndarray, member: np.ndarray, distance: int) -> Iterator[tuple]:
    """(leaf, points, member) and, for balls, (None, inner points, vantage)."""
    if not len(points):
        return
    if isinstance(node, int):
        yield node, points, member
        return
    d = _distances(points, node.vantage)
    inner = d <= node.radius
    if node.ball:
        yield None, points[inner & member], node.vantage
    goes_in = d <= node.radius + distance
    goes_out = ~inner | (~member & (d > node.radius - distance))
    yield from route(node.inside, points[goes_in], (member & inner)[goes_in], distance)
    yield from route(node.outside, points[goes_out], member[goes_out], distance)


class Links:
    """Links found so far, kept as a forest once they are many."""

    def __init__(self):
        self.a, self.b, self.size = [], [], 0

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        self.a.append(a)
        self.b.append(b)
        self.size += len(a)
        if self.size > 1 << 20:
            self.a, self.b = ([x] for x in self.forest())
            self.size = len(self.a[0])

    def forest(self) -> tuple[np.ndarray, np.ndarray]:
        none = np.zeros(0, np.uint64)
        return grid.links_of(np.concatenate([none, *self.a]), np.concatenate([none, *self.b]))


def _direct(members: np.ndarray, visitors: np.ndarray, distance: int, links: Links, itself: bool) -> None:
    if itself:
        near = np.bitwise_count(members[:, None] ^ members[None, :]) <= distance
        x, y = np.nonzero(np.triu(near, 1))
        links.add(members[x], members[y])
    step = max(1, (1 << 21) // max(1, len(members)))
    for k in range(0, len(visitors), step):
        part = visitors[k:k + step]
        x, y = np.nonzero(np.bitwise_count(part[:, None] ^ members[None, :]) <= distance)
        links.add(part[x], members[y])


def join(members: np.ndarray, visitors: np.ndarray, distance: int, links: Links, itself: bool = True) -> None:
    """Link all members with each other (if ``itself``) and all visitors with
    members, at ``distance`` or less, up to what links already imply."""
    if not len(members) or (len(members) < 2 and not len(visitors)):
        return
    cut = _split(members, distance, itself) if len(members) > DIRECT else None
    if cut is None:
        return _in_slabs(members, visitors, distance, links, itself)
    vantage, radius, ball = cut
    d, e = _distances(members, vantage), _distances(visitors, vantage)
    inner = d <= radius
    crossing = members[~inner & (d <= radius + distance)]
    inside = visitors[e <= radius + distance]
    if itself:  # members that only meet visitors need not visit each other
        inside = np.concatenate([inside, crossing])
    if ball:
        links.add(members[inner], np.full(int(inner.sum()), vantage, np.uint64))
    join(members[inner], inside, distance, links, itself and not ball)
    join(members[~inner], visitors[e > radius - distance], distance, links, itself)


def _in_slabs(members: np.ndarray, visitors: np.ndarray, distance: int, links: Links, itself: bool) -> None:
    for k in range(0, len(members), 2048):
        part = members[k:k + 2048]
        _direct(part, visitors, distance, links, itself)
        if itself and k:
            _direct(part, members[:k], distance, links, False)


LINKS_ARROW = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def near_links(points: DataFrame, distance: int = DISTANCE, leaf: int = LEAF) -> DataFrame:
    """(a, b): links with the same components as all pairs of distinct
    ``points`` (fingerprint: long) at ``distance`` or less."""
    n = points.count()
    chosen = points.orderBy(F.xxhash64("fingerprint"), "fingerprint").limit(SAMPLE).agg(F.collect_list("fingerprint")).first()[0]
    sample = np.sort(np.array(chosen, np.int64)).view(np.uint64)
    tree, balls = shared_tree(sample, max(16, leaf * len(sample) // max(n, 1)), distance)

    def find_leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            these = batch.column(0).to_numpy().view(np.uint64)
            for place, held, mark in route(tree, these, np.ones(len(these), bool), distance):
                mark = np.full(len(held), mark, np.uint64) if place is None else mark.astype(np.uint64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(held), -1 if place is None else place, np.int32)), pa.array(held.view(np.int64)),
                     pa.array(mark.view(np.int64))], ["leaf", "fingerprint", "mark"])

    routed = stored(points.mapInArrow(find_leaves, "leaf int, fingerprint long, mark long"), "vantage_routed")
    cells = grid.dealt(routed.where("leaf >= 0").select("leaf", "fingerprint", (F.col("mark") == 1).alias("member")), ["leaf"], "fingerprint")

    def in_cell(group: pa.Table) -> pa.Table:
        held, role = group.column("fingerprint").to_numpy().view(np.uint64), group.column("role").to_numpy()
        ball, found = balls[group.column("leaf")[0].as_py()], Links()
        members, again = held[role == grid.FIRST], held[role == grid.AGAIN]
        visitors = held[role == grid.VISIT]
        join(members, visitors, distance, found, not ball)
        join(again, visitors, distance, found, False)
        a, b = found.forest()
        return pa.table([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], schema=LINKS_ARROW)

    inside = cells.groupBy("leaf", "member_part", "visitor_part").applyInArrow(in_cell, "a long, b long")
    return inside.union(routed.where("leaf < 0").select(F.col("fingerprint").alias("a"), F.col("mark").alias("b")))


def near_duplicates(docs: DataFrame, size: int = 3, distance: int = DISTANCE) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id (the smallest doc_id
    reachable over links) of each row of ``docs`` (doc_id, text)."""
    rows = stored(fingerprints(docs, size), "simhash_documents")
    points = stored(rows.groupBy("fingerprint").agg(F.min("doc_id").alias("doc_id")), "simhash_points")
    root = stored(components(near_links(points.select("fingerprint"), distance)), "simhash_components")
    placed = points.join(root, points.fingerprint == root.node, "left").select(
        "fingerprint", "doc_id", F.coalesce("component", "fingerprint").alias("root"))
    smallest = stored(placed.groupBy("root").agg(F.min("doc_id").alias("component_id")), "simhash_smallest")
    # stored, so that Spark may split the rows of a fingerprint that very many documents share
    known = stored(placed.join(smallest, "root").select("fingerprint", "component_id"), "simhash_known")
    return rows.join(known, "fingerprint").select(
        "doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")
