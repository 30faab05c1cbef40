"""Boosted trees against a brute-force version, and their defined cases."""

from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from dealspark.operators import boosting as bt

SCHEMA = "id int, a double, b double, c double, d double, y int"


def brute(rows, rounds, depth, rate=0.1, lam=1.0, weight=1.0):
    """Margins by trying every split of every node on all rows; few distinct values, so every value is a cut."""
    n_features = len(rows[0]) - 2
    there = [[x if x is not None and not math.isnan(x) else None for x in r[1:-1]] for r in rows]
    cuts = [sorted({x[f] for x in there if x[f] is not None}) for f in range(n_features)]
    margins = [0.0] * len(rows)

    def unit(v):
        return round(v * bt.UNIT) / bt.UNIT

    for _ in range(rounds):
        ps = [1 / (1 + math.exp(-m)) for m in margins]
        g = [unit(p - r[-1]) for p, r in zip(ps, rows)]
        h = [unit(p * (1 - p)) for p in ps]

        def grow(members, left_levels):
            gs, hs = math.fsum(g[i] for i in members), math.fsum(h[i] for i in members)
            best = None
            for f in range(n_features if left_levels else 0):
                for cut in [*cuts[f], math.inf]:
                    for missing_left in (False, True):
                        if cut == math.inf and (missing_left or all(there[i][f] is not None for i in members)):
                            continue
                        went = [i for i in members if (missing_left if there[i][f] is None else there[i][f] < cut)]
                        stay = sorted(set(members) - set(went))
                        gl, hl = math.fsum(g[i] for i in went), math.fsum(h[i] for i in went)
                        gr, hr = gs - gl, hs - hl
                        if hl < weight or hr < weight:
                            continue
                        gain = gl * gl / (hl + lam) + gr * gr / (hr + lam) - gs * gs / (hs + lam)
                        if gain > bt.LEAST_GAIN and (best is None or gain > best[0]):
                            best = gain, went, stay
            if best is None:
                for i in members:
                    margins[i] += -rate * gs / (hs + lam)
            else:
                grow(best[1], left_levels - 1)
                grow(best[2], left_levels - 1)

        grow(list(range(len(rows))), depth)
    return margins


def sample(n=240, seed=3):
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        a, b = float(rnd.randrange(9)), float(rnd.randrange(-4, 5))
        c = rnd.choice([None, float("nan"), 1.0, 2.5])
        y = int(a + b * (2 if c is None else -1) + rnd.random() * 3 > 4)
        out.append((i, a, b, c, 7.0, y))
    return out


@pytest.mark.parametrize("rounds,depth", [(1, 5), (4, 3)])
def test_equals_brute_force(spark, rounds, depth):
    rows = sample()
    df = spark.createDataFrame(rows, SCHEMA)
    model = bt.fit(df, ["a", "b", "c", "d"], "y", rounds=rounds, depth=depth)
    got = {r.id: r.margin for r in bt.score(model, df, "id").collect()}
    want = brute(rows, rounds, depth)
    assert max(abs(got[i] - m) for i, m in enumerate(want)) < 1e-9
    assert len(model.trees) == rounds and not any(n.feature == 3 for t in model.trees for n in t.values())


def test_partitions_do_not_matter_and_models_reload(spark, tmp_path):
    df = spark.createDataFrame(sample(), SCHEMA)
    model = bt.fit(df, ["a", "b", "c"], "y", rounds=12, depth=2)  # margins are written once in between
    assert bt.fit(df.repartition(7, F.rand(5)), ["a", "b", "c"], "y", rounds=12, depth=2) == model
    bt.save(model, spark, str(tmp_path / "m"))
    assert bt.load(spark, str(tmp_path / "m")) == model
    scored = bt.score(model, df, "id", "y")
    most = max(r["count"] for r in df.groupBy("y").count().collect())
    assert scored.where("prediction = y").count() > most  # beats the constant answer
    assert scored.where("prediction != int(p_hot > 0.5) OR p_hot NOT BETWEEN 0 AND 1").count() == 0
    assert "Python" not in scored._jdf.queryExecution().toString()


def test_defined_cases(spark):
    empty = spark.createDataFrame([], SCHEMA)
    model = bt.fit(empty, ["a", "b"], "y", rounds=2)
    assert model.trees == []
    df = spark.createDataFrame([(1, 1.0, None, None, 0.0, 1), (2, 2.0, None, None, 0.0, 1), (3, 3.0, None, None, 0.0, None)], SCHEMA)
    assert [r.p_hot for r in bt.score(model, df, "id").collect()] == [0.5] * 3
    one = bt.fit(df, ["a", "b"], "y", rounds=3)  # one class, too little weight for any split
    assert [list(t) for t in one.trees] == [[0]] * 3
    scored = bt.score(one, df, "id").collect()
    assert len(scored) == 3 and len({r.margin for r in scored}) == 1 and scored[0].margin > 0


def test_cuts_are_exact_ranks_on_small_tables_and_close_on_large_ones(spark):
    df = spark.range(1, 1001).select((F.col("id") * F.col("id")).cast("double").alias("x"))
    cuts = bt.quantile_cuts(df, ["x"])[0]
    assert cuts == [float(math.ceil(1000 * k / 256) ** 2) for k in range(1, 256)]
    large = spark.range(1, 400_001, 1, 8).select(F.col("id").cast("double").alias("x"))
    for k, c in enumerate(bt.quantile_cuts(large, ["x"], bins=16)[0], 1):
        assert abs(c - 400_000 * k / 16) <= 400_000 / bt.ACCURACY + 1
