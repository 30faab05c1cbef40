"""Suffix-array dedup and substring dedup against brute force."""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pytest

from dealspark.llm import substring_dedup, suffix_dedup
from dealspark.llm import suffix_array as sa

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LETTERS = "abcdefghij"
BYTE_ROWS = [(1, None), (None, LETTERS * 4), (2, "xx" + LETTERS * 4), (2, "xx" + LETTERS * 4), (3, ""), (4, "q" * 30),
             (5, "éàü" * 9 + "0123456789ab"), (6, "zzz0123456789abé"), (7, "r" * 5000 + "s"), (8, "unique text, not long")]
WORDS = "a b c d e f g h i j k l m n o p".split()
WORD_ROWS = [(1, None), (None, " ".join(WORDS)), (2, "x " + " ".join(WORDS)), (2, "x " + " ".join(WORDS)), (3, ""),
             (4, "q " * 30), (5, "é \n" + "\t".join(WORDS[3:14]) + " z"), (6, "a b"), (7, "q " * 12 + "r"), (8, "v " * 9000)]


def bytes_left(rows, length):
    data = [(t or "").encode() for _, t in rows]
    seen = {}
    for b in data:
        for k in range(len(b) - length + 1):
            seen[b[k:k + length]] = seen.get(b[k:k + length], 0) + 1
    out = []
    for (i, _), b in zip(rows, data):
        gone = np.zeros(len(b), bool)
        for k in range(len(b) - length + 1):
            if seen[b[k:k + length]] > 1:
                gone[k:k + length] = True
        edges = np.diff(np.concatenate([[0], gone.astype(int), [0]]))
        spans = list(zip(np.flatnonzero(edges == 1).tolist(), np.flatnonzero(edges == -1).tolist()))
        out.append(((i is None, i or 0), len(b), int(gone.sum()), spans, np.frombuffer(b, np.uint8)[~gone].tobytes()))
    return sorted(out)


def found(df):
    return sorted(((r.doc_id is None, r.doc_id or 0), r.n_bytes, r.n_removed, [(s.start, s.end) for s in r.spans],
                   bytes(r.kept)) for r in df.collect())


def test_bytes(docs, texts, make):
    assert found(suffix_dedup.remove_repeats(docs, 200)) == bytes_left(texts, 200)
    assert found(suffix_dedup.remove_repeats(make(BYTE_ROWS), 12)) == bytes_left(BYTE_ROWS, 12)
    assert suffix_dedup.remove_repeats(make([]), 12).count() == 0


def test_cut_documents(docs, texts, make):
    out = suffix_dedup.clean_documents(docs, 200)
    assert out.schema == docs.schema
    left = {k[1]: b.decode("utf-8", "ignore") for k, _, _, _, b in bytes_left(texts, 200)}
    rows = {r.doc_id: r for r in docs.collect()}
    for r in out.collect():
        assert r.text == left[r.doc_id] and r.n_chars == len(r.text)
        assert (r.lang, r.source) == (rows[r.doc_id].lang, rows[r.doc_id].source)
    odd = make(BYTE_ROWS)
    assert suffix_dedup.clean_documents(odd, 12).schema == odd.schema
    assert suffix_dedup.clean_documents(odd, 12).count() == len(BYTE_ROWS)


def test_replacement_characters_stay(make):
    """Only the rest of cut characters goes: a genuine U+FFFD stays, in cut texts too, and ends of two cut characters do not join."""
    same = "0123456789abcdef"
    rows = [(1, "a \ufffd b"), (2, "\ufffd" + same + "\ufffd!"), (3, "q" + same + "w"), (4, "\ufffd" * 3),
            (5, "1\u00e9" + "ABCDEFGHIJKL" + "\u00e92"), (6, "3\u0129" + "ABCDEFGHIJKL" + "\u00ea4")]
    # the last two share a byte (a9) before the letters and one (c3) after them: both cut characters go
    want = {1: rows[0][1], 2: "\ufffd\ufffd!", 3: "qw", 4: rows[3][1], 5: "12", 6: "34"}
    got = {r.doc_id: r.text for r in suffix_dedup.clean_documents(make(rows), 12).collect()}
    assert got == want


def words_left(rows, size):
    value = lambda i: -2 ** 63 if i is None else i
    words = [(value(i), WORD.findall(t or "")) for i, t in rows]
    low = {}
    for i, w in words:
        for k in range(len(w) - size + 1):
            low[tuple(w[k:k + size])] = min(low.get(tuple(w[k:k + size]), i), i)
    out = []
    for i, w in words:
        gone = [False] * len(w)
        for k in range(len(w) - size + 1):
            if low[tuple(w[k:k + size])] < i:
                gone[k:k + size] = [True] * size
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out.append((i, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out)


def test_words(docs, texts, make):
    def got(df):
        return sorted((-2 ** 63 if r.doc_id is None else r.doc_id, r.n_words, r.n_removed,
                       hashlib.sha256(r.kept).hexdigest()) for r in df.collect())

    assert got(substring_dedup.remove_repeats(docs, 50)) == words_left(texts, 50)
    for size in (8, 11):
        assert got(substring_dedup.remove_repeats(make(WORD_ROWS), size)) == words_left(WORD_ROWS, size)
    assert substring_dedup.remove_repeats(make([]), 8).count() == 0


@pytest.mark.parametrize("few", [0, 4, 32])
def test_suffix_arrays(monkeypatch, few):
    monkeypatch.setattr(sa, "FEW", few)
    rng = np.random.default_rng(1)
    for k in range(300):
        text = rng.integers(0, rng.integers(1, 6), rng.integers(0, 90)).astype(np.uint8) * int(rng.integers(1, 40))
        text = np.tile(text, 3) if k % 3 == 0 else text
        data = text.tobytes()
        order = sa.suffix_array(text)
        assert order.tolist() == sorted(range(len(data)), key=lambda i: data[i:])
        shared = sa.common_prefixes(text, order)
        for a, b in zip(order[:-1].tolist(), order[1:].tolist()):
            n = 0
            while b + n < len(data) and a + n < len(data) and data[a + n] == data[b + n]:
                n += 1
            assert shared[b] == n


@pytest.mark.parametrize("few", [0, 32])
def test_induction_at_every_level(monkeypatch, few):
    """Strings with thousands of names are sorted by the same induction, down to names that all differ."""
    monkeypatch.setattr(sa, "FEW", few)
    kinds, sort = [], sa._sort
    monkeypatch.setattr(sa, "_sort", lambda s: kinds.append(len(np.unique(s))) or sort(s))
    rng = np.random.default_rng(2)
    words = sorted({bytes(rng.integers(97, 123, rng.integers(2, 6)).astype(np.uint8)) for _ in range(3000)})
    shuffled = [words[k] for k in rng.permutation(len(words))]
    for data in (b" ".join(shuffled) * 2, b" ".join(words) * 2, b" ".join(shuffled[::-1] + words + shuffled)):
        kinds.clear()
        order = sa.suffix_array(np.frombuffer(data, np.uint8))
        assert order.tolist() == sorted(range(len(data)), key=lambda i: data[i:])
        assert len(kinds) > 2 and kinds[1] > 512


def thue_morse(n, letters):
    """A word of two letters that fools polynomial hashes modulo powers of two."""
    return "".join(letters[k.bit_count() % 2] for k in range(n))


@pytest.mark.parametrize("n", [512, 1024, 4096])
def test_words_that_fool_hashes_modulo_powers_of_two(make, n):
    a, b = thue_morse(n, "ab"), thue_morse(n, "ba")
    around = [f"w{k}" for k in range(30)], [f"v{k}" for k in range(30)]
    rows = [(k, " ".join([*around[0], w, *around[1]])) for k, w in ((1, a), (2, b))]
    assert [r.n_removed for r in substring_dedup.remove_repeats(make(rows)).orderBy("doc_id").collect()] == [0, 0]
    assert [r.n_removed for r in suffix_dedup.remove_repeats(make([(1, a), (2, b)]), min(n, 1024)).orderBy("doc_id").collect()] == \
        [sum(brute_bytes([a, b], min(n, 1024))[k]) for k in (0, 1)]


def brute_bytes(texts, length):
    """Per text and byte, whether a string of ``length`` that covers it also starts elsewhere."""
    count = {}
    for t in texts:
        for k in range(len(t) - length + 1):
            count[t[k:k + length]] = count.get(t[k:k + length], 0) + 1
    out = []
    for t in texts:
        gone = [False] * len(t)
        for k in range(len(t) - length + 1):
            if count[t[k:k + length]] > 1:
                gone[k:k + length] = [True] * length
        out.append(gone)
    return out
