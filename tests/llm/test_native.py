"""Quality rules and URL filters against restatements in plain Python."""

from __future__ import annotations

import random
import re
from collections import Counter

from dealspark.llm import quality_rules, url_filters
from dealspark.llm.common import table

SF = "/root/testdata/sf0.001"

WORD = re.compile(r"[^\x20\x09-\x0D]+")
EDGES = [(1, None), (None, ""), (2, " \t\n"), (3, "a b c " * 40), (4, "one\ntwo\none\n\none "), (5, "w " * 20_000),
         (5, "w " * 20_000), (6, "é\u00a0x $$ <|> " * 30), (7, "a b")]


def counts(text):
    words = WORD.findall(text or "")
    seen = Counter(zip(words, words[1:], words[2:]))
    covered = set()
    for k in range(len(words) - 2):
        if seen[tuple(words[k:k + 3])] > 1:
            covered.update((k, k + 1, k + 2))
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    base = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")),
            len(lines) - len(set(lines)), len(covered), base)


def got(df):
    return sorted((r.doc_id is None, r.doc_id or 0, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines,
                   r.n_repeat_words, r.base_failed) for r in df.collect())


def test_quality_counts(docs, texts, make):
    for rows, df in ((texts, docs), (EDGES, make(EDGES)), ([], make([]))):
        want = sorted((i is None, i or 0, *counts(t)) for i, t in rows)
        assert got(quality_rules.judge(df, "doc_id")) == want


def test_quality_verdicts(docs, texts, spark):
    kept = {r.doc_id for r in quality_rules.judge(docs, "doc_id").where("kept").collect()}
    labels = {r.doc_id: r.quality for r in table(spark, SF, "labels").collect()}
    assert not any(labels.get(i) == 0 for i in kept)
    clean = [i for i, t in texts if labels.get(i) == 1 and not counts(t)[-1]]
    assert clean and all(i in kept for i in clean)


def test_quality_filter_keeps_all_columns(docs, make):
    out = quality_rules.filter_documents(docs)
    assert out.schema == docs.schema
    assert {r.doc_id for r in out.collect()} == {
        r.doc_id for r in quality_rules.judge(docs, "doc_id").where("kept").collect()}
    odd = make(EDGES)
    assert quality_rules.filter_documents(odd).columns == odd.columns


def test_stop_words_bind_the_languages_that_have_some(spark):
    text = " ".join(f"sana{k} kieli{k}" for k in range(60))  # no stop word of any list
    rows = [(1, text, "fi"), (2, text, "en"), (3, text, None), (4, text, "EN"), (5, "a b", "fi")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    kept = {r.doc_id: r.kept for r in quality_rules.judge(df, "doc_id").collect()}
    assert kept == {1: True, 2: False, 3: False, 4: False, 5: False}
    assert {r.doc_id for r in quality_rules.filter_documents(df).collect()} == {1}
    assert not any(r.kept for r in quality_rules.judge(df.drop("lang"), "doc_id").collect())


def test_quality_rules_are_native(docs):
    plan = quality_rules.judge(docs, "doc_id")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]


def ruled(url):
    at = (url or "").find("://")
    host = path = ""
    if at >= 0:
        m = re.match(r"([^/?#]*)([^?#]*)", url[at + 3:])
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in m[1])
        path = m[2]
    best = max([(len(h + p), h + p, v) for v, h, p in RULES
                if (host == h or host.endswith("." + h)) and path.startswith(p)], default=(0, None, None))
    return host, path, best[1], best[2]


URLS = [None, "", "example.net/en/", "a://b://c.net/", "http://EXAMPLE.net/en/x", "https://x.example.net/en", "x://net",
        "x://net/", "x://inet/", "x://a.example.com/de/?q", "x://a.example.com/DE/", "x://org/fr/#f", "x://myorg/fr/",
        "x://www.example.net:80/en/", "x://example.network/", "http://É.net/p?x#y", "x://a.net?x", "x://a/casino/1",
        "x://a/" + "y" * 5000 + "/login", "x://a/loginpage"]


def test_url_rules(spark):
    rows = [(k, u) for k, u in enumerate(URLS)] + [(None, "x://net/"), (3, URLS[3])]
    df = spark.createDataFrame(rows, "page_id long, url string").repartition(3)
    out = url_filters.judge(df).collect()
    assert len(out) == len(rows)
    by = {(r.page_id, r.host, r.path): r for r in out}
    for page_id, url in rows:
        host, path, rule, verdict = ruled(url)
        r = by[page_id, host, path]
        assert r.rule == rule and (verdict is None or r.verdict == verdict), url
        if rule is None:
            blocked = bool(re.search(r"casino|/login(/|$)", path))
            assert r.verdict == ("block" if blocked else "allow"), url
    assert url_filters.judge(df.limit(0)).count() == 0


def test_url_index_takes_the_rarest_token(spark):
    tokens = spark.createDataFrame([("com",)] * 9 + [("casino",)] * 2 + [("www",)] * 5, "token string")
    rules = url_filters.rule_table(spark, (url_filters.pattern_rule("block", "casino.*com", "com", "casino"),
                                           url_filters.pattern_rule("block", "^$")))
    found = {r.regex: r.token for r in url_filters.index(tokens, rules).collect()}
    assert found == {"casino.*com": "casino", "^$": ""}


def test_urls_are_native(spark):
    plan = url_filters.judge(table(spark, SF, "pages"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "NestedLoop" not in plan and "Cartesian" not in plan


def test_thousands_of_rules_equal_running_every_expression(spark):
    rng = random.Random(4)
    words = [f"w{k}" for k in range(400)]
    rules = [url_filters.host_rule(rng.choice(["allow", "block"]), f"{rng.choice(words)}.com", f"/{rng.choice(words)[:rng.randint(0, 4)]}")
             for _ in range(1500)]
    rules += [url_filters.pattern_rule(rng.choice(["allow", "block"]), rf"(^|[^a-z0-9]){a}/{b}([^a-z0-9]|$)", a, b)
              for a, b in (rng.sample(words, 2) for _ in range(1500))]
    rules.append(url_filters.pattern_rule("block", r"w1\d\dw"))  # without a token: tried on every URL
    rows = [(k, f"http://{rng.choice(['', 'a.', 'b.c.'])}{rng.choice(words)}.com/{rng.choice(words)}/{rng.choice(words)}{rng.choice(['', 'w', '?q'])}")
            for k in range(400)] + [(401, None), (402, "none")]
    got = {r.page_id: (r.verdict, r.rule or r.pattern) for r in url_filters.judge(
        spark.createDataFrame(rows, "page_id long, url string"), tuple(rules)).collect()}
    ordered = sorted(rules, key=lambda r: r.rank)
    hits = 0
    for page, url in rows:
        rest = (url or "").partition("://")[2]
        target = re.sub(r"[?#].*", "", rest)
        fits = [r for r in ordered if re.search(r.regex, target)]
        hits += bool(fits)
        assert got[page] == ((fits[-1].verdict, fits[-1].name) if fits else ("allow", None))
    assert 100 < hits < 402
