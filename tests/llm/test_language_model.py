"""The language model against a dictionary version of interpolated modified Kneser-Ney."""

from __future__ import annotations

import math
from collections import Counter, defaultdict

import numpy as np
import pytest

from dealspark.llm import language_model as lm
from dealspark.llm.codec import expand_sorted, squeeze_sorted
from dealspark.llm.common import ship, table

SF = "/root/testdata/sf0.001"


def grams(text, n):
    data = b"\n" + (text or "").encode()
    return [data[k:k + n] for k in range(len(data) - n + 1)]


def brute(trusted, order):
    """A function that gives the probability of the last byte of a gram."""
    counts = {order: Counter(g for t in trusted for g in grams(t, order))}
    for k in range(order - 1, 0, -1):
        counts[k] = Counter(g[1:] for g in counts[k + 1])
    models = {}
    for k in range(1, order + 1):
        n = [sum(c == j for c in counts[k].values()) for j in range(1, 5)]
        if n[0] and n[1] and n[2]:
            y = n[0] / (n[0] + 2 * n[1])
            raw = 1 - 2 * y * n[1] / n[0], 2 - 3 * y * n[2] / n[1], 3 - 4 * y * n[3] / n[2]
            d = [min(max(x, 0.05), j + 0.95) for j, x in enumerate(raw)]
        else:
            d = [0.5, 0.75, 0.9]
        total, spare = defaultdict(int), defaultdict(float)
        for g, c in counts[k].items():
            total[g[:-1]] += c
            spare[g[:-1]] += d[min(c, 3) - 1]
        models[k] = d, total, spare

    def p(g):
        d, total, spare = models[len(g)]
        lower = p(g[1:]) if len(g) > 1 else 1 / 256
        c, n = counts[len(g)].get(g, 0), total.get(g[:-1], 0)
        if not n:
            return lower
        return (max(c - d[min(c, 3) - 1], 0) if c else 0) / n + spare[g[:-1]] / n * lower

    return p


def perplexity(p, text, order):
    logs = [math.log(p(g)) for g in grams(text, order)]
    return (len(logs), math.exp(-sum(logs) / len(logs)) if logs else None)


def check(df, rows, trusted, spark):
    ids = spark.createDataFrame([(i,) for i in trusted], "doc_id long")
    got = {(r.doc_id, r.n_scored): r for r in lm.score(df, ids).collect()}
    p = brute([t for i, t in rows if i in trusted], lm.ORDER)
    for i, text in rows:
        n, want = perplexity(p, text, lm.ORDER)
        r = got[i, n]
        assert r.trusted == (i in trusted)
        assert r.perplexity is None if want is None else r.perplexity == pytest.approx(want, rel=1e-4)


def test_scores(spark, docs, texts):
    labels = table(spark, SF, "labels")
    trusted = {r.doc_id for r in lm.trusted_ids(labels).collect()}
    some = [(i, t) for i, t in texts if len(t) < 3000][:60]
    wanted = {i for i, _ in some} & trusted
    check(docs.where(docs.doc_id.isin([i for i, _ in some])), some, wanted, spark)


def test_edges(spark):
    ship(spark)
    rows = [(1, None), (None, "ab"), (2, ""), (3, "abc" * 50), (3, "abc" * 50), (4, "é漢" * 9000), (5, "abd" * 20)]
    df = spark.createDataFrame([(*r, None, 0.5) for r in rows], "doc_id long, text string, lang string, perplexity double")
    check(df, rows, {3, 5}, spark)
    check(df, rows, set(), spark)
    assert lm.score(df.limit(0), df.select("doc_id")).count() == 0
    labels = spark.createDataFrame([(3, 1, 0), (5, 1, None), (4, 0, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    out = lm.filter_documents(df, labels)
    assert out.columns == df.columns and {r.doc_id for r in out.collect()} >= {1, None, 2, 3, 5}


def test_ngram_numbers():
    rng = np.random.default_rng(1)
    for dense in (lm.DENSE, 1):
        old, lm.DENSE = lm.DENSE, dense
        data = rng.integers(0, 256, 500).astype(np.uint8)
        values, number = lm.ngrams(data, 3)
        lm.DENSE = old
        want = [int.from_bytes(data[k:k + 3].tobytes(), "big") for k in range(498)]
        assert values[number].tolist() == want and values.tolist() == sorted(set(want))


def test_labels_are_held(spark, docs):
    labels = table(spark, SF, "labels")
    kept = {r.doc_id: r.kept for r in lm.classify(docs, labels).collect()}
    rows = {r.doc_id: r for r in labels.collect()}
    clean = [kept[i] for i, r in rows.items() if r.quality == 1 and r.toxic == 0]
    junk = [kept[i] for i, r in rows.items() if r.quality == 0]
    assert np.mean(clean) > 0.97 and np.mean(junk) < 0.6


def test_fifth_byte_counts(spark):
    """The last byte of a seen 5-gram is likelier than one seen only after its last three bytes."""
    ship(spark)
    rows = [(1, "xbcdy zbcdw " * 20), (2, "xbcdy"), (3, "xbcdw")]
    df = spark.createDataFrame([(*r, "en") for r in rows], "doc_id long, text string, lang string")
    got = {r.doc_id: r.perplexity for r in lm.score(df, df.where("doc_id = 1")).collect()}
    assert got[3] > 1.5 * got[2]


def test_squeezed_grams():
    grams = np.unique(np.random.default_rng(1).integers(0, 1 << 40, 5000))
    for shard, at in lm._by_shard(grams, 7):
        assert expand_sorted(squeeze_sorted(grams[at])).tolist() == grams[at].tolist()
        assert set(lm._shard_of(grams[at], 7).tolist()) == {shard}
    assert len(squeeze_sorted(grams)) < 8 * len(grams)


def test_held_out(spark, docs, texts):
    """Trusted documents are scored by the other fold alone."""
    some = [(i, t) for i, t in texts if 5 <= len(t) < 2000][:40]
    df = docs.where(docs.doc_id.isin([i for i, _ in some]))
    got = {r.doc_id: r for r in lm.score(df, df.where("doc_id % 3 > 0").select("doc_id")).collect()}
    fold = dict(zip([i for i, _ in some], lm.fold_of(np.array([i for i, _ in some])).tolist()))
    models = [brute([t for i, t in some if i % 3 and fold[i] == 1 - j], lm.ORDER) for j in (0, 1)]
    assert set(fold.values()) == {0, 1}
    for i, text in some:
        want = perplexity(models[fold[i]], text, lm.ORDER)[1] if i % 3 else None
        assert got[i].held_out is None if want is None else got[i].held_out == pytest.approx(want, rel=1e-4)


def test_junk_is_rejected(spark):
    """On the smallest tables with enough labels: 52 of the 58 junk documents go, clean ones of the half not trained on stay."""
    sf = "/root/testdata/sf0.01"
    ship(spark)
    labels = table(spark, sf, "labels")
    kept = {r.doc_id: r.kept for r in lm.classify(table(spark, sf, "documents"), labels.where("quality = 0 or doc_id % 2 = 0")).collect()}
    rows = labels.collect()
    junk = [kept[r.doc_id] for r in rows if r.quality == 0]
    clean = [kept[r.doc_id] for r in rows if r.quality == 1 and not r.toxic and r.doc_id % 2]
    assert sum(junk) <= 6 and np.mean(clean) > 0.97


def test_short_texts_are_judged_by_texts_of_like_length(spark):
    """Thresholds per language and length; what is missing comes from the length, the language, then all."""
    rows = [(k, "en", n, p, t, p if t else None) for k, (n, p, t) in enumerate(
        [(10, 8.0, True), (12, 9.0, True), (15, 9.5, False), (9, 7.0, False), (500, 3.0, True), (70, 2.5, True), (64, 4.0, False), (33, 3.5, False), (0, None, False)])]
    rows += [(20, "de", 11, 8.5, False, None), (21, "de", 40, 8.5, False, None), (22, None, 90, 3.0, False, None), (23, "en", 40, 99.0, False, None)]
    scored = spark.createDataFrame(rows, "doc_id long, lang string, n_scored long, perplexity double, trusted boolean, held_out double")
    got = {r.doc_id: (r.threshold, r.kept) for r in lm.judge(scored, 1.0).collect()}
    assert got == {0: (9.0, True), 1: (9.0, True), 2: (9.0, False), 3: (9.0, True), 4: (3.0, True), 5: (3.0, True), 6: (3.0, False),
                   7: (9.0, True), 8: (9.0, True), 20: (9.0, True), 21: (9.0, True), 22: (3.0, True), 23: (9.0, False)}
    assert all(r.kept for r in lm.judge(scored.withColumn("trusted", scored.trusted & False)).collect())
