"""URL filters: pattern rules found through their rarest literal token.

A rule has a verdict, a regular expression over ``host + path`` and the literal
tokens that every matching URL contains. Each rule is indexed by the one of its
tokens that fewest URLs contain; a URL's tokens fetch candidate rules from the
index, and only those run their expressions. All of it is native Spark.

Two kinds of rules share this path: host rules (a host with its subdomains and
a path prefix; the longest wins) and patterns, which decide where no host rule
fits. Patterns without a literal token are candidates for every URL.

Defined cases: a null URL, or one without ``://``, has an empty host and path
and no tokens; it gets the default verdict unless a token-free pattern fits.
Tokens are maximal runs of ``[a-z0-9]`` (other characters separate). Repeated
rows are judged alike. Rules of equal length: the one with the longer host,
then block. The rule table and its index are broadcast; ``MAX_RULES`` bounds
them.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MAX_RULES = 100_000

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
TOKEN = r"[a-z0-9]+"


@dataclass(frozen=True)
class Rule:
    """``rank`` orders the rules that fit one URL; the greatest decides."""

    verdict: str
    name: str
    regex: str
    tokens: tuple[str, ...]
    rank: tuple[int, int, int, int] = field(default=(0, 0, 0, 0))


def host_rule(verdict: str, host: str, path: str) -> Rule:
    """Fits ``host`` and all its subdomains where the URL's path starts with ``path``."""
    host = host.translate(str.maketrans(UPPER, LOWER))
    # a path prefix may end inside a token of the URL, so its last token counts only if something closes it
    tokens = re.findall(TOKEN, host) + re.findall(rf"{TOKEN}(?=[^a-z0-9])", path.translate(str.maketrans(UPPER, LOWER)))
    return Rule(verdict, host + path, rf"(?s)^(?:[^/?#]*\.)?{_quoted(host)}(?=/|$){_quoted(path)}",
                tuple(tokens), (1, len(host + path), len(host), int(verdict == "block")))


def pattern_rule(verdict: str, regex: str, *tokens: str) -> Rule:
    """Fits where ``regex`` is found; ``tokens`` are whole tokens that each match contains."""
    return Rule(verdict, regex, regex, tokens, (0, 0, 0, int(verdict == "block")))


def _quoted(text: str) -> str:
    return re.sub(r"([^A-Za-z0-9/])", r"\\\1", text)


#: Path words and host labels of pages that a training corpus leaves out.
PATTERNS = tuple(
    pattern_rule("block", rf"(?i)(^|[^a-z0-9]){word}([^a-z0-9]|$)", word)
    for word in ("adult", "porn", "xxx", "casino", "gambling", "warez", "phishing", "malware")
) + tuple(
    pattern_rule("block", rf"(?i)/{word}(/|$)", word) for word in ("login", "signin", "logout", "cart", "checkout")
)

HOST_RULES = (
    host_rule("block", "net", "/"),
    host_rule("allow", "example.net", "/en/"),
    host_rule("block", "example.com", "/de/"),
    host_rule("allow", "org", "/fr/"),
)


def parts(url: Column) -> tuple[Column, Column]:
    """Host (after the first ``://`` up to ``/``, ``?``, ``#`` or the end; A-Z lower-cased) and path."""
    rest = F.regexp_extract(F.coalesce(url.cast("string"), F.lit("")), r"(?s)^.*?://(.*)$", 1)
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.translate(host, UPPER, LOWER), path


def rule_table(spark: SparkSession, rules: tuple[Rule, ...]) -> DataFrame:
    """Rules as rows, numbered so that of the rules that fit a URL the greatest number decides."""
    if len(rules) > MAX_RULES:
        raise ValueError(f"{len(rules)} rules; the broadcast is bounded at {MAX_RULES}")
    lower = str.maketrans(UPPER, LOWER)
    ordered = sorted(rules, key=lambda r: r.rank)
    return spark.createDataFrame(
        [(k, r.verdict, r.name, r.regex, r.rank[0] == 1, [t.translate(lower) for t in r.tokens])
         for k, r in enumerate(ordered)],
        "rule_no int, verdict string, name string, regex string, is_host boolean, words array<string>")


def index(tokens: DataFrame, table: DataFrame) -> DataFrame:
    """(token, rule_no, regex): each rule under the one of its literal tokens
    that the fewest rows of ``tokens`` (token: one row per URL and distinct
    token) hold; under the empty token if it has none."""
    words = table.select("rule_no", F.explode("words").alias("token"))
    wanted = words.select("token").distinct()
    counts = tokens.join(F.broadcast(wanted), "token", "left_semi").groupBy("token").agg(F.count("*").alias("n"))
    rarest = (words.join(F.broadcast(counts), "token", "left").groupBy("rule_no")
              .agg(F.min_by("token", F.struct(F.coalesce("n", F.lit(0)), "token")).alias("token")))
    return (table.select("rule_no", "regex").join(F.broadcast(rarest), "rule_no", "left")
            .select(F.coalesce("token", F.lit("")).alias("token"), "rule_no", "regex"))


def judge(pages: DataFrame, rules: tuple[Rule, ...] = HOST_RULES + PATTERNS, default: str = "allow") -> DataFrame:
    """page_id, host, path, rule (the deciding host rule, else null), verdict
    and pattern (the pattern that decided, else null), one row per row of
    ``pages`` (page_id, url).

    A URL's tokens explode in place, meet the broadcast index, and a partial
    maximum brings them back to one row per URL before the only shuffle.
    """
    table = rule_table(pages.sparkSession, rules)
    host, path = parts(F.col("url"))
    urls = pages.select("page_id", host.alias("host"), path.alias("path"))
    target = F.concat("host", "path")
    distinct = F.array_distinct(F.regexp_extract_all(F.translate(target, UPPER, LOWER), F.lit(TOKEN), F.lit(0)))
    found = index(urls.select(F.explode(distinct).alias("token")), table)
    rows = urls.withColumn("_row", F.monotonically_increasing_id())
    tried = (rows.select("*", F.explode(F.concat(distinct, F.array(F.lit("")))).alias("token"))
             .join(F.broadcast(found), "token", "left"))
    best = (tried.groupBy("_row", "page_id", "host", "path")
            .agg(F.max(F.when(F.rlike(target, F.col("regex")), F.col("rule_no"))).alias("rule_no")))
    named = table.select("rule_no", "verdict", "name", "is_host")
    return best.join(F.broadcast(named), "rule_no", "left").select(
        "page_id", "host", "path", F.when(F.col("is_host"), F.col("name")).alias("rule"),
        F.coalesce("verdict", F.lit(default)).alias("verdict"),
        F.when(~F.col("is_host"), F.col("name")).alias("pattern"))
