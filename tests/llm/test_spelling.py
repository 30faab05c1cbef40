"""Spelling variants against all pairs of words."""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pytest

from dealspark.llm import spelling


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if abs(len(a) - len(b)) != 1:
        return False
    a, b = sorted((a, b), key=len)
    return any(b[:k] + b[k + 1:] == a for k in range(len(b)))


def counted(rows):
    n = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 97 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            n[run] += 1
    return {w: k for w, k in n.items() if len(w) >= 5 and k >= 3}


def brute(n):
    words = sorted(n)
    by_length = {}
    for w in words:
        by_length.setdefault(len(w), []).append(w)
    close = {w: [v for k in (-1, 0, 1) for v in by_length.get(len(w) + k, ()) if near(w, v)] for w in words}
    form = {}
    for w in words:
        best = min(close[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best and n[best] >= 2 * n[w] else None
    out = []
    for w in words:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n[w], len(close[w]), n.get(form[w])))
    return out


def got(df):
    assert df.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    return sorted(map(tuple, df.collect()))


def test_table(docs, texts):
    n = counted(texts)
    assert len(n) > 200
    assert got(spelling.variants(docs)) == brute(n)


@pytest.fixture(scope="module")
def crowd():
    """Words that crowd together: few letters, anagrams, neighbouring lengths, accents."""
    rng = np.random.default_rng(3)
    letters = list("abcé")
    words = {"".join(rng.choice(letters, int(rng.integers(5, 8)))) for _ in range(900)}
    words |= {"".join(rng.permutation(list("listenàz"))) for _ in range(120)} | {"q" * k for k in range(5, 12)}
    return [(k, " ".join([w] * int(rng.integers(3, 40)))) for k, w in enumerate(sorted(words))]


@pytest.mark.parametrize("leaf,members,visitors", [(4096, 32_768, 200_000), (40, 16, 24)])
def test_crowded_words(make, crowd, monkeypatch, leaf, members, visitors):
    """Also with small leaves, and with leaves cut into cells."""
    for name, value in (("MEMBERS", members), ("VISITORS", visitors)):
        monkeypatch.setattr(spelling, name, value)
    words = make(crowd)
    want = brute(counted(crowd))
    assert sum(r[1] is not None for r in want) > 100 and any(r[2] not in (r[0], r[1]) for r in want)
    monkeypatch.setattr(spelling.near_words, "__defaults__", (leaf,))
    assert got(spelling.variants(words)) == want


@pytest.mark.parametrize("direct", [3, 48])
def test_pairs_of_a_leaf(crowd, monkeypatch, direct):
    """Each pair once: among members, with visitors of their length, and with shorter ones."""
    monkeypatch.setattr(spelling, "DIRECT", direct)
    words = [t.split()[0] for _, t in crowd]
    six = [w for w in words if len(w) == 6]
    members, visitors, shorter = six[::2], six[1::2], [w for w in words if len(w) == 5]
    found = list(spelling.pairs_in(*map(spelling.letters, (members, visitors, shorter)), True))
    for kind, other in enumerate((members, visitors, shorter)):
        pairs = [tuple(sorted((members[a], other[b]))) for k, x, y in found if k == kind for a, b in zip(x.tolist(), y.tolist())]
        want = {tuple(sorted((a, b))) for a in members for b in other if near(a, b)}
        assert len(pairs) == len(set(pairs)) and set(pairs) == want and want


def test_edges(make):
    rows = [(1, None), (None, "Maison maison MAISON maisonx maisonx maisonx"), (2, ""), (3, " \n"), (4, "é" * 400 + " " + "é" * 400 + " " + "é" * 400),
            (4, "é" * 399 + " " + "é" * 399 + " " + ("é" * 399)), (5, "ÉCOLE école École " * 3), (6, "a-b c_d e1f " * 9), (7, "wordy " * 5000),
            (7, "wordz " * 5000), (8, "÷÷÷÷× " * 7)]
    assert got(spelling.variants(make(rows))) == brute(counted(rows))
    assert got(spelling.variants(make([]))) == []


def test_long_texts_are_read_in_pieces(make, monkeypatch):
    rows = [(k, "alpha beta-gamma delta epsilon " * 300) for k in range(4)]
    monkeypatch.setattr(spelling, "PIECE", 7)
    assert [w for runs in spelling._runs(rows[0][1].encode()) for w in runs] == re.findall("[a-z]+", rows[0][1])
