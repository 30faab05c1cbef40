"""The steps of suffix-array dedup: notes, hashes for anchors, ranks of LMS substrings, and the work they save."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest

from dealspark.llm import exchange, suffix_dedup
from dealspark.llm import suffix_array as sa
from dealspark.llm.rolling import short_hashes, sparse_hashes
from tests.llm.test_repeats import bytes_left, found


def test_one_induction_a_level(monkeypatch):
    """LMS substrings are ranked by their letters, so each level induces once, from sorted LMS suffixes."""
    levels, induced = [], []
    sort, induce = sa._sort, sa._induce
    monkeypatch.setattr(sa, "_sort", lambda s: levels.append(len(s)) or sort(s))
    monkeypatch.setattr(sa, "_induce", lambda *a: induced.append(1) or induce(*a))
    data = np.random.default_rng(3).integers(97, 100, 5000).astype(np.uint8).tobytes() * 2
    order = sa.suffix_array(np.frombuffer(data, np.uint8))
    assert order.tolist() == sorted(range(len(data)), key=lambda i: data[i:])
    assert 2 < len(levels) and len(induced) <= len(levels)


@pytest.mark.parametrize("ties", [0, 64])
def test_long_lms_substrings(monkeypatch, ties):
    """LMS substrings of many words of letters that differ late or not at all, or in the type of their last letter."""
    monkeypatch.setattr(sa, "TIES", ties)
    rng = np.random.default_rng(4)
    ramp = lambda n, last: bytes(sorted(rng.integers(1, 255, n).tolist())) + bytes([255] * last)
    same = [ramp(40, 1), ramp(60, 3)]
    for k in range(60):
        parts = [*same, b"a" * 30, b"a" * 31 + b"b", bytes([9, 8, 8, 8, 7]), bytes([9, 8, 8, 8, 9]), ramp(int(rng.integers(1, 50)), k % 3)]
        data = b"".join(parts[j] for j in rng.integers(0, len(parts), 40))
        order = sa.suffix_array(np.frombuffer(data, np.uint8))
        assert order.tolist() == sorted(range(len(data)), key=lambda i: data[i:])


def test_hashes_for_anchors():
    """They depend on the window's bytes alone, and on all of them."""
    data = np.random.default_rng(5).integers(0, 256, 400).astype(np.uint8)
    twice = np.concatenate([data, [7], data])
    for n in range(1, 17):
        h = short_hashes(twice, n)
        assert len(h) == len(twice) - n + 1 and (h[:400 - n + 1] == h[401:]).all()
        for k in range(n):
            other = data[:n].copy()
            other[k] ^= 1
            assert short_hashes(other, n)[0] != h[0]
    for n in (4, 5, 7, 100, 101):
        at = np.array([0, 1, 250])
        h = sparse_hashes(twice, at, n)
        assert (h == sparse_hashes(twice, at + 401, n)).all() and len(set(h.tolist())) == 3
        for k in range(n):
            other = data[:n].copy()
            other[k] ^= 1
            assert sparse_hashes(other, np.array([0]), n)[0] != h[0]
    assert len(short_hashes(data[:0], 16)) == len(sparse_hashes(data[:0], np.zeros(0, np.int64), 100)) == 0


def test_notes_come_back(spark):
    """Notes reach their own block as they were sent, also where blocks' notes share a shard."""
    blocks = [0, 1, (5 << 32) + 2, 1 << 30]
    keys = np.arange(1, 40, dtype=np.uint64)
    sent = {b: [np.arange(b % 7 + 3), np.zeros(0, np.int64), np.array([70_000, 3])] for b in blocks}
    rows = [r for b in blocks for r in [*exchange.requests(b, keys, keys.astype(np.uint8), 5), exchange.note(b, *sent[b])]]
    asked = spark.createDataFrame(pa.Table.from_pylist(rows, exchange.REQUEST_ARROW).to_pandas(), exchange.REQUEST)
    got = exchange.answer(asked, lambda k, v, b: (v + np.uint8(1)), np.uint8).collect()
    assert sorted(r["block"] for r in got) == sorted(blocks)
    for r in got:
        answers = [a.asDict() for a in r["answers"]]
        assert [a.tolist() for a in exchange.noted(answers, 3)] == [a.tolist() for a in sent[r["block"]]]
        slot = exchange.slots(exchange.shard_of(keys, 5))
        assert exchange.joined(answers, np.uint8)[slot].tolist() == (keys + np.uint64(1)).tolist()


def answered(sent, decide, kind):
    """What the shards answer to the rows that blocks send, per block."""
    out = {}
    for shard in {r["shard"] for r in sent}:
        group = sorted((r for r in sent if r["shard"] == shard), key=lambda r: r["block"])
        keys = [np.frombuffer(r["keys"], np.uint64) for r in group] if shard >= 0 else []
        got = decide(np.concatenate(keys), np.concatenate([np.frombuffer(r["vals"], kind) for r in group]),
                     np.repeat([r["block"] for r in group], [len(k) for k in keys])) if keys else None
        at = np.cumsum([0, *[len(k) for k in keys]])
        for k, r in enumerate(group):
            out.setdefault(r["block"], []).append(
                {"shard": shard, "answer": r["keys"] if shard < 0 else got[at[k]:at[k + 1]].tobytes()})
    return out


def test_texts_are_not_hashed_again_and_again(monkeypatch):
    """Windows are hashed of the candidates' text only, not of whole blocks once or twice in every step."""
    hashed = []
    windows = suffix_dedup.Windows
    monkeypatch.setattr(suffix_dedup, "Windows", lambda values, *a: hashed.append(len(values)) or windows(values, *a))
    rng = np.random.default_rng(6)
    text = lambda n: bytes(rng.integers(97, 123, n).astype(np.uint8))
    passage = text(300)
    texts = [[text(9000) + passage + text(100), text(3000), b""], [text(5000), passage[20:], text(5000) + passage], [b"short"]]
    rows = [{"block": k, "ids": np.arange(len(t)).tobytes(), "lens": np.array([len(x) for x in t], np.int64).tobytes(),
             "blob": b"".join(t), "extra": None} for k, t in enumerate(texts)]
    for name, ask, decide, kind in (
            ("texts", lambda r: suffix_dedup._text_requests(r, 3), suffix_dedup._decide_texts, suffix_dedup.TEXT_VAL),
            ("anchors", lambda r: suffix_dedup._anchor_requests(r, 200, 3), suffix_dedup._twice, np.uint8),
            ("classes", lambda r: suffix_dedup._class_requests(r, 200, 3), suffix_dedup._repeated, np.uint16)):
        answers = answered([s for r in rows for s in ask(r)], decide, kind)
        rows = [r | {name: answers[r["block"]]} for r in rows]
    out = [x for r in rows for x in suffix_dedup._results(r, 200, False)]
    assert [x["n_removed"] for x in out] == [300, 0, 0, 0, 280, 300, 0]
    assert 0 < sum(hashed) < 3000 < sum(len(x) for t in texts for x in t) / 7


def test_other_lengths(make):
    rng = np.random.default_rng(7)
    rows = [(k, "".join(rng.choice(list("abc"), int(rng.integers(0, 60))))) for k in range(60)]
    long = "".join(rng.choice(list("abcdefgh"), 400))
    rows += [(60 + k, "x" * k + long[30 * k:30 * k + 240] + "é" * k) for k in range(5)]
    for length in (8, 131):
        assert found(suffix_dedup.remove_repeats(make(rows), length)) == bytes_left(rows, length)
