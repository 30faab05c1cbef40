"""Quality rules: a table of thresholds compiled into one native projection.

Each rule bounds one measure of a text (length, symbol, stop-word and line
ratios). Measures and verdicts are built-in Spark expressions; there is no
shuffle and no user function, so the work is one scan whatever the skew.

Defined cases: a null or empty text has no words, so all counts are 0 and the
length rule rejects it. A text in a language without stop words here is not
held to the stop-word rule. Words are maximal runs outside ``\\x20\\x09-\\x0D``.
Very long texts need no special case: the repeat count sorts packed hashes of a
text's 3-word windows, O(n log n). Repeated rows are judged alike.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]"
SYMBOLS = r"[#*$%&|<>]"

#: Frequent function words of the corpus languages.
STOP_WORDS = (
    "the of and to a in is that it for on was with be as this by at are from "      # en
    "der die und den von zu das mit sich auf des für ist im nicht dem ein eine als "  # de
    "de la le et les en un du une que est pour qui dans au sur par pas avec "        # fr
    "el y los se del las por con una no para su es al lo"                            # es
).split()


@dataclass(frozen=True)
class Rule:
    """Keep texts with ``low <= measure <= high``."""

    name: str
    measure: str
    low: float | None = None
    high: float | None = None
    #: Languages that the rule knows; texts in others are not held to it. None: all.
    langs: tuple[str, ...] | None = None


#: Measures that a rule may bound, as SQL over the counted columns.
MEASURES = {
    "words": "n_words",
    "mean_word_chars": "word_chars / n_words",
    "symbols_per_word": "n_symbols / n_words",
    "stop_words_per_word": "n_stop_words / n_words",
    "dup_line_ratio": "n_dup_lines / n_lines",
    "repeat_word_pct": "100 * n_repeat_words / n_words",
}

#: The two rules that the base verdict is made of.
BASE = (Rule("too short", "words", low=50), Rule("repetitive", "repeat_word_pct", high=50))

RULES = (
    Rule("word length", "mean_word_chars", low=2, high=12),
    Rule("symbols", "symbols_per_word", high=0.1),
    Rule("stop words", "stop_words_per_word", low=0.02, langs=("en", "de", "fr", "es")),
    Rule("repeated lines", "dup_line_ratio", high=0.5),
)


def _failed(rule: Rule) -> Column:
    value = F.expr(f"try_divide({MEASURES[rule.measure].replace(' / ', ', ')})"
                   if " / " in MEASURES[rule.measure] else MEASURES[rule.measure])
    tests = []
    if rule.low is not None:
        tests.append(value < rule.low)
    if rule.high is not None:
        tests.append(value > rule.high)
    bad = tests[0]
    for t in tests[1:]:
        bad = bad | t
    if rule.langs is not None:
        bad = bad & F.coalesce(F.col("_lang").isin(*rule.langs), F.lit(True))
    return F.coalesce(bad, F.lit(False))


def measures(docs: DataFrame, *keep: str) -> DataFrame:
    """``keep`` columns plus n_words, word_chars, n_symbols, n_lines,
    n_dup_lines, n_repeat_words, n_stop_words (long) of ``docs.text``.

    Repeated 3-word windows: each window's 64-bit hash gives its upper bits and
    its position the lower bits of one long; after sorting, equal windows are
    neighbours, and their words are compared too, so a hash collision does not
    count as a repeat.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    cut = docs.select(*keep, text.alias("_t"))
    cut = cut.select(
        *keep, "_t",
        F.filter(F.split("_t", SPACE), lambda w: w != "").alias("_w"),
        F.filter(F.split("_t", "\n"), lambda x: x.rlike(WORD)).alias("_l"),
    )
    cut = cut.select(
        *keep, "_w", "_l", F.size("_w").alias("_n"),
        (F.length("_t") - F.regexp_count("_t", F.lit(SPACE))).cast("long").alias("word_chars"),
        F.regexp_count("_t", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        F.length(F.bin(F.size("_w").cast("long"))).alias("_b"),
    )
    packed = F.transform(
        F.slice(F.col("_w"), F.lit(1), F.greatest(F.col("_n") - 2, F.lit(0))),
        _pack)
    cut = cut.select(
        *keep, "_w", "_n", "_b", "word_chars", "n_symbols",
        F.size("_l").cast("long").alias("n_lines"),
        (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long").alias("n_dup_lines"),
        F.size(F.filter("_w", lambda w: w.isin(*_stop_forms()))).cast("long").alias("n_stop_words"),
        F.sort_array(packed).alias("_p"),
    )
    cut = cut.withColumn("_s", F.sort_array(F.transform(
        F.filter("_p", lambda x, i: _same(x, F.get("_p", i + 1)) | _same(x, F.get("_p", i - 1))),
        _place)))
    covered = F.aggregate(
        F.transform("_s", lambda x, i: F.least(F.lit(3).cast("long"), x - F.coalesce(F.get("_s", i - 1), x - 3))),
        F.lit(0).cast("long"), lambda total, x: total + x)
    return cut.select(*keep, F.col("_n").cast("long").alias("n_words"), "word_chars", "n_symbols", "n_lines",
                      "n_dup_lines", covered.alias("n_repeat_words"), "n_stop_words")


def _stop_forms() -> list[str]:
    return sorted({f for w in STOP_WORDS for f in (w, w.capitalize())})


def _shift(x: Column) -> Column:
    return F.call_function("shiftright", x, F.col("_b"))


def _pack(w: Column, i: Column) -> Column:
    high = F.call_function("shiftleft", _shift(F.xxhash64(w, F.get("_w", i + 1), F.get("_w", i + 2))), F.col("_b"))
    return high.bitwiseOR(i.cast("long"))


def _place(x: Column) -> Column:
    return x - F.call_function("shiftleft", _shift(x), F.col("_b"))


def _same(x: Column, y: Column) -> Column:
    equal = _shift(x) == _shift(y)
    for k in range(3):
        equal = equal & (F.get("_w", (_place(x) + k).cast("int")) == F.get("_w", (_place(y) + k).cast("int")))
    return F.coalesce(equal, F.lit(False))


def judge(docs: DataFrame, *keep: str, base: tuple[Rule, ...] = BASE, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``keep`` columns, the measures, ``base_failed`` and ``kept``.

    A rule of some languages passes over texts whose ``lang`` is another one;
    where ``lang`` is null, or ``docs`` has no such column, every rule applies.
    """
    lang = F.lower(F.col("lang").cast("string")) if "lang" in docs.columns else F.lit(None).cast("string")
    df = measures(docs.withColumn("_lang", lang), *keep, "_lang")
    for name, table in (("base_failed", base), ("_rules_failed", rules)):
        failed = F.lit(False)
        for rule in table:
            failed = failed | _failed(rule)
        df = df.withColumn(name, failed)
    # The id test is always true. It makes the projection nondeterministic, so that a filter on ``kept``
    # is not pushed into the measures, where it would evaluate the word arrays anew for every element.
    here = F.monotonically_increasing_id() >= 0
    return df.withColumn("kept", ~(F.col("base_failed") | F.col("_rules_failed")) & here).drop("_rules_failed", "_lang")


def filter_documents(docs: DataFrame) -> DataFrame:
    """The documents that the rules keep, with all their columns."""
    kept = docs.withColumn("_row", F.struct(*[F.col(f"`{c}`") for c in docs.columns]))
    return judge(kept.select("_row", "text", *[c for c in docs.columns if c == "lang"]), "_row").where("kept").select("_row.*")
