"""Property tests against brute-force Python restatements of the rules."""

from __future__ import annotations

import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from dealspark.functions.cleaning import parse_int
from dealspark.operators.dedupe import keep_first

SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))

rows = st.lists(st.tuples(st.sampled_from(["k1", "k2", "k3", None]),
                          st.one_of(st.none(), st.integers(-5, 5)),
                          st.sampled_from(["a", "b", "c"])), min_size=0, max_size=25)


@SETTINGS
@given(rows, st.integers(1, 5))
def test_keep_first_is_first_in_declared_order(spark, data, parts):
    df = spark.createDataFrame(data, "k string, v int, s string").repartition(parts)
    got = sorted(keep_first(df, "k").collect(), key=lambda r: str(r.k))
    want = {}
    for k, v, s in data:
        cand = (v is None, v if v is not None else 0, s)
        if k not in want or cand < want[k][0]:
            want[k] = (cand, (k, v, s))
    assert [tuple(r) for r in got] == sorted((w[1] for w in want.values()), key=lambda r: str(r[0]))


ints = st.one_of(
    st.from_regex(r"\A[+-]?[0-9]{1,6}(\.[0-9]{0,3})?\Z"),
    st.from_regex(r"\A[0-9a-z.eE+-]{0,6}\Z"),
)


def _expected(s: str | None):
    if s is None:
        return None
    m = re.fullmatch(r"\s*([+-]?\d+)(\.\d*)?\s*", s)
    return int(m.group(1)) if m else None


@SETTINGS
@given(st.lists(ints, min_size=1, max_size=20))
def test_parse_int_truncates_or_nulls(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    got = [r.v for r in df.select(parse_int("s").alias("v")).collect()]
    assert got == [_expected(t) for t in texts]


days = st.integers(0, 20)
leads_st = st.lists(st.tuples(st.sampled_from(["c1", "c2"]), days), min_size=1, max_size=12)
contacts_st = st.lists(st.tuples(st.sampled_from(["c1", "c2"]), st.sampled_from(["call", "email"]), days),
                       min_size=0, max_size=12)


@SETTINGS
@given(leads_st, contacts_st)
def test_response_time_matches_all_pairs(spark, leads, contacts):
    import datetime as dt
    from dealspark.operators.features import channel_response_time
    base = dt.datetime(2024, 1, 1)
    ldf = spark.createDataFrame([(c, base + dt.timedelta(days=d)) for c, d in leads],
                                "customer_id string, created_at timestamp_ntz")
    idf = spark.createDataFrame([(c, ch, base + dt.timedelta(days=d)) for c, ch, d in contacts],
                                "customer_id string, channel_standardized string, interaction_date timestamp_ntz")
    got = {r.channel_standardized: (r.leads_answered, r.avg_response_days)
           for r in channel_response_time(idf, ldf).collect()}
    want = {}
    for ch in ("call", "email"):
        waits = []
        for c, d in leads:
            later = [cd for cc, cch, cd in contacts if cc == c and cch == ch and cd >= d]
            if later:
                waits.append(min(later) - d)
        if waits:
            want[ch] = (len(waits), round(sum(waits) / len(waits), 4))
    assert got == want


vals = st.lists(st.one_of(st.none(), st.integers(-3, 3).map(float), st.floats(-1e3, 1e3, allow_nan=False)),
                min_size=0, max_size=30)


@SETTINGS
@given(vals, vals)
def test_exact_medians_match_numpy(spark, a, b):
    import numpy as np
    from dealspark.operators.profile import exact_medians
    n = max(len(a), len(b))
    a2, b2 = a + [None] * (n - len(a)), b + [None] * (n - len(b))
    df = spark.createDataFrame(list(zip(a2, b2)), "a double, b double")
    got = {r.column_name: r.median for r in exact_medians(df, ["a", "b"]).collect()}
    for name, xs in (("a", a2), ("b", b2)):
        xs = sorted(x for x in xs if x is not None)
        if not xs:
            assert got.get(name) is None
            continue
        k = len(xs)
        want = xs[k // 2] if k % 2 else 0.5 * xs[k // 2 - 1] + 0.5 * xs[k // 2]
        assert got[name] == want, (name, xs)
        assert abs(want - float(np.median(xs))) <= 1e-9 * max(1.0, abs(want))
