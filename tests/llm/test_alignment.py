"""Token alignment against a brute-force version on single tokens."""

from __future__ import annotations

import hashlib
from collections import Counter

import public_tokenizers as P
import pytest

from dealspark.llm import alignment

A, B = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def tokenizers():
    import sentencepiece
    from tokenizers import Tokenizer
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=B)


def brute(rows, tokenizers):
    a, b = tokenizers
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(x): x for x in own}
    letters |= {chr(256 + k): x for k, x in enumerate(x for x in range(256) if x not in own)}

    def piece(i):
        return bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()

    def groups(text):
        left = [(i, bytes(letters[c] for c in a.id_to_token(i))) for i in a.encode(" " + text, add_special_tokens=False).ids]
        right = [(i, piece(i)) for i in b.encode(text)]
        if not text or {b"".join(t for _, t in left), b"".join(t for _, t in right)} != {(" " + text).encode()}:
            return []
        ends = [[sum(len(t) for _, t in side[:k + 1]) for k in range(len(side))] for side in (left, right)]
        out, start = [], 0
        for end in sorted(set(ends[0]) & set(ends[1])):
            out.append(tuple([i for (i, _), e in zip(side, es) if start < e <= end] for side, es in zip((left, right), ends)))
            start = end
        return out

    cut = [groups(t or "") for _, t in rows]
    count = Counter((g[0][-1], g[1][-1]) for gs in cut for g in gs)
    best = {}
    for (_, y), n in count.items():
        best[y] = max(best.get(y, 0), n)
    out = []
    for (i, _), gs in zip(rows, cut):
        links = [(g[0][-1], g[1][-1]) for g in gs]
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in gs)
        out.append((i, sum(len(x) for x, _ in gs), sum(len(y) for _, y in gs), len(gs), len(links), sum(count[p] == best[p[1]] for p in links),
                    sum(count[p] for p in links), hashlib.sha256(text.encode()).hexdigest() if gs else ""))
    return sorted(out, key=str)


def got(df):
    assert df.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    return sorted(map(tuple, df.collect()), key=str)


def test_table(docs, texts, tokenizers):
    short = [(i, t) for i, t in texts if len(t or "") < 3000]
    assert got(alignment.align(docs.where("text is null or length(text) < 3000"), A, B)) == brute(short, tokenizers)


def test_edges(make, tokenizers):
    rows = [(1, None), (None, "one and the same"), (None, "one and the same"), (2, ""), (3, " "), (4, "  two  spaces "), (5, "line\nbreak\ttab"),
            (6, "<|endoftext|> <s> </s> <0x41>"), (7, "日本語 \U0001F600 é é"), (8, "▁ is no space"), (9, "nul \x00 byte"),
            (10, "x" * 5000), (11, "unbelievable " * 400), (11, "other text of the same id"), (12, "ﬁ ligature  ")]
    assert got(alignment.align(make(rows), A, B)) == brute(rows, tokenizers)
    assert got(alignment.align(make([]), A, B)) == []


def test_copies_weigh_and_blocks_agree(make, tokenizers, monkeypatch):
    rows = [(k, "the same passage of text" if k % 3 else f"text number {k} of this passage, unlike all others") for k in range(90)]
    assert got(alignment.align(make(rows), A, B)) == brute(rows, tokenizers)
