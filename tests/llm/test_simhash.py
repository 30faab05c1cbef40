"""SimHash near-dedup against all pairs of fingerprints."""

from __future__ import annotations

import re

import numpy as np
import pytest
import xxhash

from dealspark.llm import grid, simhash


def fingerprint(text, size=3):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    shingles = [" ".join(words[k:k + size]) for k in range(len(words) - size + 1)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def groups(points, distance=3):
    """The smallest point of each point's component, from all pairs."""
    held = np.array(points, np.uint64)
    low = np.arange(len(held))
    links = np.bitwise_count(held[:, None] ^ held[None, :]) <= distance
    while True:
        new = np.array([low[row].min() for row in links])
        if (new == low).all():
            return low
        low = new


def brute(rows):
    made = [fingerprint(t) for _, t in rows]
    low = groups(made)
    first = {}
    for (i, _), c in zip(rows, low.tolist()):
        if i is not None:
            first[c] = min(first.get(c, i), i)
    return sorted(((i, f"{f:016x}", first.get(c)) for (i, _), f, c in zip(rows, made, low.tolist())), key=str)


def got(df):
    assert df.columns == ["doc_id", "fingerprint", "component_id"]
    return sorted(map(tuple, df.collect()), key=str)


def test_table(docs, texts):
    assert got(simhash.near_duplicates(docs)) == brute(texts)


def test_edges(make, monkeypatch):
    text = " ".join(f"w{k % 977}" for k in range(4000))
    rows = [(5, None), (4, ""), (None, " \n"), (6, "one"), (7, "ONE"), (7, "one"), (8, "one two"), (9, "a b c"), (None, "a  b\tC"),
            (10, text), (11, text.upper()), (12, text + " tail"), (13, "É é x"), (None, "alone and without an id"), (14, "a b c d")]
    assert got(simhash.near_duplicates(make(rows))) == brute(rows)
    assert got(simhash.near_duplicates(make([]))) == []
    monkeypatch.setattr(simhash, "PIECE", 11)
    assert simhash.fingerprint(text.encode(), 3) == fingerprint(text)


def near(rng, center, n, flips):
    out = []
    for _ in range(n):
        x = int(center)
        for k in rng.integers(0, 64, int(rng.integers(0, flips + 1))):
            x ^= 1 << int(k)
        out.append(x)
    return out


@pytest.fixture(scope="module")
def crowd():
    """Points alone, in small groups, and a third of all in one dense ball."""
    rng = np.random.default_rng(7)
    alone = rng.integers(0, 2 ** 64, 900, dtype=np.uint64)
    points = [*map(int, alone), *(x for c in alone[:50] for x in near(rng, c, 12, 6)), *near(rng, alone[0], 700, 5)]
    return np.unique(np.array(points, np.uint64))


def joined(points, links):
    """The smallest point of each point's component, from links."""
    parent = {int(x): int(x) for x in points}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        x, y = sorted((find(a), find(b)))
        parent[y] = x
    return [find(int(x)) for x in points]


@pytest.mark.parametrize("direct", [4, 96])
def test_join_of_a_leaf(crowd, monkeypatch, direct):
    monkeypatch.setattr(simhash, "DIRECT", direct)
    links = simhash.Links()
    simhash.join(np.random.default_rng(1).permutation(crowd), crowd[:0], 3, links)
    assert joined(crowd, zip(*(x.tolist() for x in links.forest()))) == [int(crowd[k]) for k in groups(crowd)]
    members, visitors, links = crowd[::2], crowd[1::2], simhash.Links()
    simhash.join(members, visitors, 3, links, itself=False)
    near = {int(v) for v in visitors if (np.bitwise_count(members ^ v) <= 3).any()}
    linked = {x for pair in zip(*(x.tolist() for x in links.forest())) for x in pair}
    assert near == linked & set(visitors.tolist())


@pytest.mark.parametrize("leaf,members,visitors", [(32_768, 65_536, 1 << 20), (100, 30, 40)])
def test_points(spark, crowd, monkeypatch, leaf, members, visitors):
    """Also with small leaves, and with leaves cut into cells."""
    monkeypatch.setattr(grid, "MEMBERS", members)
    monkeypatch.setattr(grid, "VISITORS", visitors)
    points = spark.createDataFrame([(int(x),) for x in crowd.view(np.int64)], "fingerprint long").repartition(3)
    links = [(r.a % 2 ** 64, r.b % 2 ** 64) for r in simhash.near_links(points, 3, leaf).collect()]
    assert len(links) < 4 * len(crowd)  # forests, not all pairs
    assert joined(crowd, links) == [int(crowd[k]) for k in groups(crowd)]
