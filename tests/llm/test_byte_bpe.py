from __future__ import annotations

import random

import public_tokenizers as P
import pytest
import tiktoken

from dealspark.llm import byte_bpe
from dealspark.llm.chunks import ChunkCache

PATH = P.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def reference():
    return tiktoken.Encoding("test", pat_str=P.PATTERN, mergeable_ranks=byte_bpe.load_ranks(PATH), special_tokens={})


@pytest.fixture(scope="module")
def own():
    return byte_bpe.Encoder(byte_bpe.load_ranks(PATH), P.PATTERN)


ALPHABET = ["a", "b", " ", "\n", "\t", "é", "ß", "中", "  ", "\x1c", "1", "٣", "!", "'s", "ll", " the", " of", "😀", "\x85",
            "　", "<|endoftext|>", "ing"]


def test_random_texts(reference, own):
    rnd = random.Random(1)
    for _ in range(3000):
        text = "".join(rnd.choices(ALPHABET, k=rnd.randint(0, 40)))
        ids = own.encode(text)
        assert ids == reference.encode_ordinary(text)
        assert own.decode(ids) == text.encode()


@pytest.mark.parametrize("text", ["a" * 5001, " " * 999, "ab" * 2000, "=-" * 900 + "=" * 901, "supercalifragilistic" * 100])
def test_long_pieces(reference, own, text):
    assert own.encode(text) == reference.encode_ordinary(text)


def test_join_is_associative(own):
    piece = "internationalization".encode()
    whole = own.encode_piece(piece)
    for cut in range(1, len(piece)):
        assert own.join(own.merge(piece[:cut]), own.merge(piece[cut:])) == whole


def test_cache_generations(own, reference):
    made = lambda chunks: [tuple(own.encode(c)) for c in chunks]
    cache = ChunkCache(made, size=5, longest=6)
    rnd = random.Random(2)
    for _ in range(200):
        texts = ["".join(rnd.choices(ALPHABET, k=12)) for _ in range(4)]
        for text, entries in zip(texts, cache.of_texts(texts)):
            assert [t for e in entries for t in e] == reference.encode_ordinary(text)


def test_operator(docs, texts, make, reference):
    rows = [(1, None), (None, ""), (2, "a  b\n c"), (2, "a  b\n c"), (3, "x" * 30_000)]
    for want, df in ((texts, docs), (rows, make(rows)), ([], make([]))):
        out = byte_bpe.encode(df, PATH, P.PATTERN)
        got = sorted((r.doc_id is None, r.doc_id or 0, r.n_tokens, r.ids, bytes(r.decoded)) for r in out.collect())
        ids = [(i, t or "", reference.encode_ordinary(t or "")) for i, t in want]
        assert got == sorted((i is None, i or 0, len(x), " ".join(map(str, x)), t.encode()) for i, t, x in ids)
        back = byte_bpe.decode(out, PATH, P.PATTERN)
        assert sorted(bytes(r.decoded) for r in back.collect()) == sorted(t.encode() for _, t, _ in ids)
