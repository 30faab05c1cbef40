from __future__ import annotations

import hashlib

import numpy as np
import pytest

from dealspark.llm import fingerprints as fp

SF = "/root/testdata/sf0.001"
ROWS = [(5, "hello " * 40), (1, None), (None, "x" * 500), (5, "hello " * 40), (2, ""), (9, "äöü 漢字 " * 90), (7, "short")]


def anchors(text):
    """Brute force: windows of K characters whose smallest inner window is first or last."""
    chars = fp.code_points(text)
    if len(text) < fp.K:
        return [0] * bool(text)
    inner = fp.Windows(chars).all(fp.S).tolist()
    out = []
    for i in range(len(text) - fp.K + 1):
        part = inner[i:i + fp.K - fp.S + 1]
        if min(part) in (part[0], part[-1]):
            out.append(i)
    return out


def check(rows, df):
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, (r[1] or "").encode()))
    got = [r for r in fp.compare(df).collect()]
    assert len(got) == len(rows)
    want = []
    for k, (i, text) in enumerate(order):
        text, following = text or "", order[(k + 1) % len(order)][1] or ""
        n = len(text) // 4
        made = text[:len(text) - n] + following[:n]
        a, b, c = (fp.fingerprint(fp.code_points(t)) for t in (text, made, following))
        want.append((i, len(text), made, str(a), str(b), a.likeness(b), a.likeness(c)))
    key = lambda r: (r[0] is None, r[0] or 0, r[2], r[6])
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)


def test_compare(docs, texts, make):
    check(texts, docs)
    check(ROWS, make(ROWS))
    check(ROWS[:1], make(ROWS[:1]))
    assert fp.compare(make([])).count() == 0


def test_anchors_and_round_trip(texts):
    for _, text in texts[:20]:
        own = fp.fingerprint(fp.code_points(text[:800]))
        assert own.starts.tolist() == anchors(text[:800])
        back = fp.Fingerprint.parse(str(own))
        assert np.array_equal(back.starts, own.starts) and np.array_equal(back.hashes, own.hashes)


def test_the_reserved_id_is_refused(make):
    with pytest.raises(Exception, match="stands for null ids"):
        fp.compare(make([(-(2 ** 63), "a"), (None, "b")])).collect()


def test_likeness_by_characters(texts):
    """Likeness restated over sets: of the characters under anchors, those under anchors whose passage the other text has as an anchor."""
    def marked(text, other):
        mine = anchors(text) if len(text) >= fp.K else [0]
        theirs = {other[a:a + fp.K] for a in (anchors(other) if len(other) >= fp.K else [0])}
        under = {c for a in mine for c in range(a, min(a + fp.K, len(text)))}
        shared = {c for a in mine if text[a:a + fp.K] in theirs for c in range(a, min(a + fp.K, len(text)))}
        return len(shared), len(under)

    some = [t[:900] for _, t in texts[:12] if len(t or "") > 200]
    pairs = [(a, a[:300] + b[:200] + a[300:]) for a, b in zip(some, some[1:])] + list(zip(some, some[1:])) + [("short", "short"), ("short", "other")]
    for a, b in pairs:
        (s, n), (t, m) = marked(a, b), marked(b, a)
        x, y = (fp.fingerprint(fp.code_points(v)) for v in (a, b))
        assert abs(x.likeness(y) - (s + t) / (n + m)) < 1e-12


def test_a_slot_costs_the_plan_nothing(spark, make):
    rows = [(k, f"text {k}") for k in range(300)]
    sizes = []
    old = spark.conf.get("spark.sql.shuffle.partitions")
    for n in ("4", "200"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        dealt = fp.with_next(make(rows))
        sizes.append(dealt._jdf.queryExecution().analyzed().expressions().size()
                     + dealt._jdf.queryExecution().analyzed().toString().count("element_at"))
        assert dealt.where("border = 1").count() <= int(n) and dealt.where("border = 0").count() == 300
    spark.conf.set("spark.sql.shuffle.partitions", old)
    assert sizes[0] == sizes[1]


def test_shared_passage_shares_anchors(texts):
    long = [t for _, t in texts if len(t) > 1500]
    a, b = long[0], long[1][:333] + long[0][100:1100] + long[1][400:900]
    x, y = (fp.fingerprint(fp.code_points(t)) for t in (a, b))
    assert y.covered(np.isin(y.hashes, x.hashes)) >= 1000 - 2 * fp.K
    assert x.likeness(x) == 1.0 and x.likeness(fp.fingerprint(fp.code_points(long[2]))) < 0.1


def test_query_columns(spark):
    from dealspark.llm.queries import op3_document_fingerprints
    df = op3_document_fingerprints(spark, SF)
    assert df.columns[:7] == ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    r = df.first()
    assert len(r.edited_sha256) == len(hashlib.sha256().hexdigest())
