from __future__ import annotations

import re
from itertools import combinations

import numpy as np
import pytest

from dealspark.llm import components as cp
from dealspark.llm import near_dedup as nd
from dealspark.llm.components import components

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def shingles(text, size):
    words = WORD.findall((text or "").encode().translate(LOWER))
    if len(words) < size:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[k:k + size]) for k in range(len(words) - size + 1))


def brute(rows, size, percent):
    value = lambda i: -2 ** 63 if i is None else i
    sets = [(value(i), shingles(t, size)) for i, t in rows]
    parent = {i: i for i, _ in sets}

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for (i, a), (j, b) in combinations(sets, 2):
        both = len(a & b)
        if a and b and 100 * both >= percent * (len(a) + len(b) - both):
            x, y = sorted((find(i), find(j)))
            parent[y] = x
    return sorted((value(i), len(shingles(t, size)), find(value(i)), find(value(i)) == value(i)) for i, t in rows)


def got(df):
    value = lambda i: -2 ** 63 if i is None else i
    return sorted((value(r.doc_id), r.n_shingles, value(r.component_id), r.kept) for r in df.collect())


def test_table(docs, texts):
    assert got(nd.near_duplicates(docs, 3, 85)) == brute(texts, 3, 85)


def test_edges(make):
    rows = [(1, None), (None, "a b c d e"), (2, "A  b c D e"), (2, "A  b c D e"), (3, ""), (4, " \n"), (5, "x y"), (6, "X Y"),
            (7, "x"), (8, "z " * 3000), (9, "É b c d"), (10, "é b c d")]
    assert got(nd.near_duplicates(make(rows), 3, 85)) == brute(rows, 3, 85)
    assert nd.near_duplicates(make([]), 3, 85).count() == 0


def test_chains_of_edits_in_many_parts(make, monkeypatch):
    """A group larger than a part, where many members link only through others."""
    monkeypatch.setattr(nd, "PART_DOCS", 16)
    rng = np.random.default_rng(4)
    base = [f"w{k}" for k in range(120)]
    rows = []
    for doc_id in range(150):
        words = list(base)
        for at in rng.integers(0, 120, rng.integers(0, 7)):
            words[at] = f"e{doc_id}_{at}"
        rows.append((doc_id, " ".join(words)))
    assert got(nd.near_duplicates(make(rows), 3, 85)) == brute(rows, 3, 85)


def test_all_pairs_under_the_distance_share_a_key():
    rng = np.random.default_rng(2)
    for _ in range(200):
        a = rng.integers(0, 1 << nd.BITS, nd.SYMBOLS).astype(np.uint16)
        b = a.copy()
        at = rng.choice(nd.SYMBOLS, nd.MAX_DISTANCE, replace=False)
        b[at] ^= 1
        keys = nd.keys_of(np.stack([a, b]))
        assert (keys[0] == keys[1]).any()


def test_overlaps_and_forest():
    rng = np.random.default_rng(3)
    sets = [np.unique(rng.integers(0, 40, n)).astype(np.uint64) for n in (1, 5, 20, 30, 30)]
    both = nd.overlaps(sets)
    for i, a in enumerate(sets):
        for j, b in enumerate(sets):
            assert both[i, j] == len(np.intersect1d(a, b))
    linked = rng.random((12, 12)) < 0.15
    linked |= linked.T
    assert len(nd.forest(linked)) <= 11


@pytest.mark.parametrize("links", [[], [(1, 2)], [(k, k + 1) for k in range(60)], [(0, k) for k in range(1, 50)],
                                   [(5, 5), (7, 9), (9, 7), (8, 7), (3, 1), (2, 3)]])
def test_components(spark, links):
    df = spark.createDataFrame(links, "a long, b long")
    out = {r.node: r.component for r in components(df).collect()}
    parent = {}
    for a, b in links:
        if a != b:
            parent.setdefault(a, a), parent.setdefault(b, b)
    changed = True
    while changed:
        changed = False
        for a, b in links:
            if a != b and parent[a] != parent[b]:
                parent[a] = parent[b] = min(parent[a], parent[b])
                changed = True
    assert out == parent


def smallest_reachable(links):
    low = {n: n for link in links for n in link}
    while any(low[a] != low[b] for a, b in links):
        for a, b in links:
            low[a] = low[b] = min(low[a], low[b])
    return low


def test_contract():
    rng = np.random.default_rng(5)
    for n, m in ((1, 1), (2, 5), (30, 20), (400, 380), (400, 2000)):
        links = rng.integers(-n, n, (m, 2))
        links = np.concatenate([links, [[-2 ** 63, 2 ** 63 - 1]]])
        nodes, roots = cp.contract(links[:, 0], links[:, 1])
        assert dict(zip(nodes.tolist(), roots.tolist())) == {k: v for k, v in smallest_reachable(links.tolist()).items() if k != v}


@pytest.mark.parametrize("apart", [False, True])
def test_components_take_few_turns(spark, monkeypatch, apart):
    """One table is written a turn. Before, the tables of a turn were four, 33 in
    all for these chains, rings and a hub. ``apart``: each shard is a task of its own, so little is done within tasks."""
    written = []
    monkeypatch.setattr(cp, "stored", lambda df, name, real=cp.stored: written.append(name) or real(df, name))
    own = {"spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.coalescePartitions.enabled": "false",
           "spark.sql.files.maxPartitionBytes": "64k", "spark.sql.files.openCostInBytes": "64k"} if apart else {}
    before = {k: spark.conf.get(k) for k in own}
    rng = np.random.default_rng(6)
    name = rng.permutation(2000).tolist()
    links = [(name[k], name[k + 1]) for k in range(399)]  # a chain
    links += [(name[400 + k], name[400 + (k + 1) % 300]) for k in range(300)]  # a ring
    links += [(name[700], name[k]) for k in range(701, 1500)]  # a hub
    links += [(name[a], name[b]) for a, b in rng.integers(1500, 2000, (420, 2)).tolist()]
    try:
        for k, v in own.items():
            spark.conf.set(k, v)
        out = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long").repartition(40)).collect()}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    linked = {n for a, b in links if a != b for n in (a, b)}
    assert out == {k: v for k, v in smallest_reachable(links).items() if k in linked}
    assert len(written) <= 12


def test_filter_keeps_one_of_each_group(docs, texts):
    out = nd.filter_documents(docs)
    assert out.schema == docs.schema
    assert sorted(r.doc_id for r in out.collect()) == sorted(r[0] for r in brute(texts, 5, 80) if r[3])


@pytest.mark.parametrize("n", [512, 1024])
def test_words_that_fool_hashes_modulo_powers_of_two(make, n):
    a, b = ("".join(letters[k.bit_count() % 2] for k in range(n)) for letters in ("ab", "ba"))
    rows = [(1, f"{a} a b c d"), (2, f"{b} a b c d"), (3, f"{b} a b c d")]
    assert got(nd.near_duplicates(make(rows), 3, 85)) == brute(rows, 3, 85)


def test_different_texts_under_one_id(make):
    ta, tb = (" ".join(f"{c}{k}" for k in range(40)) for c in "ab")
    rows = [(1, ta), (1, tb), (2, tb + " word"), (3, ta + " word"), (4, "z y x w"), (None, ta + " other"), (None, "n o n e"), (5, "n o n e")]
    assert got(nd.near_duplicates(make(rows), 3, 85)) == brute(rows, 3, 85)


def test_a_large_group_costs_its_members(spark, monkeypatch):
    """Sets sent for a group of distinct near copies, and for one that falls into classes that stay apart."""
    monkeypatch.setattr(nd, "PART_DOCS", 16)
    words = [f"w{k}" for k in range(120)]
    rows = [(k, " ".join(words[:-1] + [f"tail{k}"])) for k in range(600)]  # near copies of each other
    other = [f"v{k}" for k in range(60)] + words[:60]
    rows += [(1000 + k, " ".join(other[:-1] + [f"last{k}"])) for k in range(20)]
    sent = []
    real = nd._member_sets
    monkeypatch.setattr(nd, "_member_sets", lambda *a: sent.append(nd.stored(real(*a), "sent")) or sent[-1])
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert got(nd.near_duplicates(df, 3, 85)) == brute(rows, 3, 85)
    assert sum(s.count() for s in sent) < 4 * len(rows)  # in pairs of parts it was 600 * 38


def test_the_reserved_id_is_refused(make):
    with pytest.raises(Exception, match="stands for null ids"):
        nd.near_duplicates(make([(-2 ** 63, "a b c"), (1, "a b c")]), 3, 85).collect()
