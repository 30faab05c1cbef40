from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers as P
import pytest
from tokenizers import Tokenizer

from dealspark.llm import packing

PATH = P.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def tokenizer():
    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    return t


def check(rows, out, tokenizer, capacity=2048):
    want = defaultdict(int)
    for doc_id, text in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
        first = (len(ids) - 1) % capacity + 1
        cuts = [0, *range(first, len(ids) + 1, capacity)]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
            want[doc_id, k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())] += 1
    got, places = defaultdict(int), defaultdict(list)
    for r in out.collect():
        got[r.doc_id, r.piece, r.start, r.length, r.ids_crc32] += 1
        places[r.sequence_id].append((r.offset, r.length))
    assert got == want
    for parts in places.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(places), sum(k[3] * n for k, n in want.items())


def test_documents(docs, texts, make, tokenizer):
    made, total = check(texts, packing.pack_documents(docs, PATH), tokenizer)
    assert -(-total // 2048) <= made <= 1.02 * total / 2048 + 1
    rows = [(1, None), (None, ""), (2, "word " * 5000), (2, "word " * 5000), (3, "<|endoftext|> x"), (4, " \n é")]
    check(rows, packing.pack_documents(make(rows), PATH), tokenizer)
    assert packing.pack_documents(make([]), PATH).count() == 0


def test_fast_ids_equal_the_library(tokenizer):
    fast = packing.token_ids(PATH)
    for text in ("", "a  b\n\n c ", "don't 123 ٣", "漢字 é\x1c\x85x", "<|endoftext|>", "=" * 300):
        assert np.frombuffer(fast(text), "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_other_tokenizers_run_as_they_are():
    path = P.path("word_bpe_49k.json")
    assert packing._ranks(path) is None
    assert np.frombuffer(packing.token_ids(path)("Hello there"), "<u4").tolist() == Tokenizer.from_file(path).encode(
        "Hello there", add_special_tokens=False).ids


@pytest.mark.parametrize("low, high", [(1, 101), (30, 41), (50, 61), (34, 52)])
def test_groups_exchange_pieces(spark, low, high):
    sizes = np.random.default_rng(low).integers(low, high, 3000)
    items = spark.createDataFrame([(k, 0, int(n)) for k, n in enumerate(sizes)], "row long, piece int, length long")
    placed = packing.pack(items, capacity=100, group=500)
    rows = placed.join(items, ["row", "piece"]).collect()
    assert len(rows) == 3000
    fill = defaultdict(int)
    for r in rows:
        fill[r.sequence_id] += r.length
    assert max(fill.values()) <= 100
    values, counts = np.unique(sizes, return_counts=True)
    bound = packing.lower_bound(values, counts, 100)
    alone = packing.best_fit_decreasing(sizes, 100).max() + 1
    assert bound <= len(fill) <= 1.02 * alone


def test_groups_are_certified_one_by_one(spark):
    """A group of its own bound keeps its sequences; only the others are dealt anew."""
    rng = np.random.default_rng(5)
    sizes = rng.integers(30, 41, 3000)
    items = spark.createDataFrame([(k, 0, int(n)) for k, n in enumerate(sizes)], "row long, piece int, length long")
    groups = defaultdict(list)
    for r in packing._pack_groups(items, 6, 0, 100).collect():
        groups[r.sequence_id >> 24].append(r)
    assert len(groups) == 6
    for rows in groups.values():
        values, counts = np.unique([r.length for r in rows], return_counts=True)
        made = len({r.sequence_id for r in rows})
        bound = packing.lower_bound(values, counts, 100)
        fill = defaultdict(int)
        for r in rows:
            fill[r.sequence_id] += r.length
        assert made >= bound
        assert all(r.final == (made == bound or fill[r.sequence_id] == 100) for r in rows)
    equal = spark.range(900).selectExpr("id AS row", "0 AS piece", "60L AS length")  # one each: certified at once
    assert packing._pack_groups(equal, 4, 0, 100).where("not final").count() == 0
    assert packing.pack(equal, capacity=100, group=100).select("sequence_id").distinct().count() == 900


def test_lower_bound_is_one():
    """Never over the best packing, found by search, and over the plain quotient where halves matter."""
    rng = np.random.default_rng(3)

    def best(sizes):
        sizes, found = sorted(sizes, reverse=True), [len(sizes)]

        def place(k, bins):
            if len(bins) >= found[0]:
                return
            if k == len(sizes):
                found[0] = len(bins)
                return
            for i in {b: j for j, b in enumerate(bins) if b + sizes[k] <= 10}.values():
                place(k + 1, [*bins[:i], bins[i] + sizes[k], *bins[i + 1:]])
            place(k + 1, [*bins, sizes[k]])

        place(0, [])
        return found[0]

    for _ in range(150):
        sizes = rng.integers(1, 11, rng.integers(1, 8))
        values, counts = np.unique(sizes, return_counts=True)
        assert packing.lower_bound(values, counts, 10) <= best(sizes.tolist())
    assert packing.lower_bound(np.array([6]), np.array([9]), 10) == 9
