"""Second-order boosted trees for a binary label (ML-9), grown level by level in Spark.

The objective is the regularised log loss of the original's boosted trees: a
split gains ``GL²/(HL+λ) + GR²/(HR+λ) − G²/(H+λ)`` from the sums of gradients
and hessians on its sides, a leaf answers ``−rate·G/(H+λ)``, and rows without a
value go to the side that gains more. Spark's own ``GBTClassifier`` fits
first-order residuals without these terms.

One job per level: every row gives (node, feature, bin) its gradient and
hessian, map tasks add them up, and windows over the bounded histogram choose
one split per node. Only these (at most ``2**depth`` rows) reach the driver.
Gradients are summed as integers, so the trees do not depend on how rows are
partitioned, as double sums would.

Defined cases: NULL and NaN features are missing. Rows with a NULL label do
not train; they are scored like others. A constant feature gives no split. One
class, or no split that gains enough, makes trees of a single leaf; no rows
make no trees, and every row gets the base score.
"""

from __future__ import annotations

import json
import math
from collections.abc import Sequence
from dataclasses import asdict, dataclass, field

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dealspark.sources.scratch import mark, release, stored

#: Candidate cuts per feature: its quantiles at multiples of 1 / BINS.
BINS = 256
#: Quantiles lie within 1 / ACCURACY of the rows of their exact rank.
ACCURACY = 20_000
#: Gradients and hessians are integers in this unit; their long sums hold for over 10**11 rows.
UNIT = float(1 << 26)
#: A split must gain more than this (fixed value).
LEAST_GAIN = 1e-6
#: Trees between two writings of the margins, which keeps plans short.
WRITE_EVERY = 10


@dataclass
class Node:
    """A leaf with ``value``, or a split: ``x < cut`` goes left (all present
    values where ``cut`` is None), missing ones left if ``missing_left``."""

    value: float
    feature: int | None = None
    cut: float | None = None
    bin: int | None = None
    missing_left: bool = False


@dataclass
class BoostedTrees:
    """Fitted trees: ``trees[k]`` maps node numbers (0, children 2n+1 and 2n+2) to nodes."""

    features: list[str]
    base_margin: float = 0.0
    trees: list[dict[int, Node]] = field(default_factory=list)

    def margin(self) -> str:
        """SQL of a row's margin (log odds)."""
        return _added(_number(self.base_margin), (
            _tree_sql(t, lambda n: _went_left(n, f"CAST(`{self.features[n.feature]}` AS DOUBLE)"), _leaf)
            for t in self.trees))


def _number(x: float) -> str:
    return f"CAST('{x!r}' AS DOUBLE)"


def _leaf(at: int, node: Node) -> str:
    return _number(node.value)


def _added(first: str, others) -> str:
    return " + ".join([first, *others])


def _went_left(node: Node, x: str) -> str:
    present = f"{x} < {_number(node.cut)}" if node.cut is not None else "true"
    return f"CASE WHEN {x} IS NULL OR isnan({x}) THEN {str(node.missing_left).lower()} ELSE {present} END"


def _bin_left(node: Node, missing: list[int]) -> str:
    b = f"bins[{node.feature}]"
    return f"CASE WHEN {b} = {missing[node.feature]} THEN {str(node.missing_left).lower()} ELSE {b} < {node.bin} END"


def _tree_sql(tree: dict[int, Node], left, answer, at: int = 0) -> str:
    node = tree[at]
    if node.feature is None:
        return answer(at, node)
    return (f"CASE WHEN {left(node)} THEN {_tree_sql(tree, left, answer, 2 * at + 1)} "
            f"ELSE {_tree_sql(tree, left, answer, 2 * at + 2)} END")


def quantile_cuts(df: DataFrame, features: Sequence[str], bins: int = BINS, accuracy: int = ACCURACY) -> list[list[float]]:
    """Ascending candidate cuts per feature, from mergeable quantile sketches of
    all rows in one aggregate; the result is one row of at most ``bins`` numbers a feature."""
    shares = [k / bins for k in range(1, bins)]
    present = [F.when(~F.isnan(F.col(f"`{c}`").cast("double")), F.col(f"`{c}`").cast("double")) for c in features]
    row = df.agg(*[F.percentile_approx(x, shares, accuracy).alias(f"c{k}") for k, x in enumerate(present)]).first()
    return [sorted(set(found or [0.0])) for found in row]


def _binned(df: DataFrame, features: Sequence[str], label: str, cuts: list[list[float]]) -> DataFrame:
    """label, and the array ``bins``: how many cuts of a feature are at most the value, or one over all for missing."""
    raw = df.where(F.col(label).isNotNull()).select(
        F.col(label).cast("double").alias("y"),
        *[F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(float("nan"))).alias(f"x{k}") for k, c in enumerate(features)])
    out = Bucketizer(
        splitsArray=[[-math.inf, *c, math.inf] for c in cuts], handleInvalid="keep",
        inputCols=[f"x{k}" for k in range(len(features))], outputCols=[f"b{k}" for k in range(len(features))],
    ).transform(raw)
    return out.select("y", F.array(*[F.col(f"b{k}").cast("short") for k in range(len(features))]).alias("bins"))


def _histogram(rows: DataFrame, node: str) -> DataFrame:
    """Sums of gradients and hessians per (node, feature, bin) of rows with y, bins and margin."""
    p = 1.0 / (1.0 + F.exp(-F.col("margin")))
    unit = F.lit(UNIT)
    graded = rows.select(
        F.expr(node).alias("node"), "bins", F.rint((p - F.col("y")) * unit).cast("long").alias("g"),
        F.rint(p * (1.0 - p) * unit).cast("long").alias("h")).where("node IS NOT NULL")
    cells = graded.select("node", F.posexplode("bins").alias("feature", "bin"), "g", "h")
    return cells.groupBy("node", "feature", "bin").agg(
        (F.sum("g") / unit).alias("g"), (F.sum("h") / unit).alias("h"))


def _splits(cells: DataFrame, missing: list[int], reg_lambda: float, min_child_weight: float) -> DataFrame:
    """Per node its totals and its best split, if any gains enough. Ties go to
    the first feature, then the lowest cut, then missing values right."""
    all_of = Window.partitionBy("node", "feature")
    before = all_of.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    lost = F.col("bin") == F.array(*[F.lit(m) for m in missing])[F.col("feature")]
    sums = cells.select(
        "node", "feature", "bin", lost.alias("lost"),
        *[x for s in ("g", "h") for x in (
            F.sum(s).over(all_of).alias(f"{s}_all"), F.coalesce(F.sum(s).over(before), F.lit(0.0)).alias(f"{s}_low"),
            F.sum(F.when(lost, F.col(s)).otherwise(0.0)).over(all_of).alias(f"{s}_lost"))])
    sides = sums.select("*", F.explode(F.array(F.lit(False), F.lit(True))).alias("missing_left")).where(
        "NOT (lost AND missing_left)")
    for s in ("g", "h"):
        sides = sides.withColumn(f"{s}l", F.col(f"{s}_low") + F.when(F.col("missing_left"), F.col(f"{s}_lost")).otherwise(0.0))
        sides = sides.withColumn(f"{s}r", F.col(f"{s}_all") - F.col(f"{s}l"))

    def score(g, h):
        return F.col(g) * F.col(g) / (F.col(h) + F.lit(reg_lambda))

    gain = score("gl", "hl") + score("gr", "hr") - score("g_all", "h_all")
    valid = (F.col("hl") >= min_child_weight) & (F.col("hr") >= min_child_weight) & (gain > LEAST_GAIN)
    key = F.struct(gain.alias("gain"), (-F.col("feature")).alias("f"), (-F.col("bin")).alias("b"), (~F.col("missing_left")).alias("m"))
    best = F.max_by(F.struct("feature", "bin", "lost", "missing_left", "gl", "hl", "gr", "hr"), F.when(valid, key))
    return sides.groupBy("node").agg(F.first("g_all").alias("g"), F.first("h_all").alias("h"), best.alias("s"))


def fit(df: DataFrame, features: Sequence[str], label: str, rounds: int = 100, depth: int = 5, rate: float = 0.1,
        reg_lambda: float = 1.0, min_child_weight: float = 1.0, base_score: float = 0.5,
        bins: int = BINS, accuracy: int = ACCURACY) -> BoostedTrees:
    """Fit ``rounds`` trees of at most ``depth`` levels to the 0/1 ``label``.

    The defaults are the original's settings (100 rounds, depth 5, rate 0.1)
    and its library's regularisation.
    """
    spark, since = df.sparkSession, mark(df.sparkSession)
    model = BoostedTrees(list(features), math.log(base_score / (1.0 - base_score)))
    cuts = quantile_cuts(df.where(F.col(label).isNotNull()), features, bins, accuracy)
    missing = [len(c) + 1 for c in cuts]
    written = stored(_binned(df, features, label, cuts).withColumn("margin", F.lit(model.base_margin)), "boosting")
    rows = written

    def left(node: Node) -> str:
        return _bin_left(node, missing)

    for k in range(rounds):
        tree: dict[int, Node] = {0: Node(0.0)}
        for level in range(depth):
            grown = range(2 ** level - 1, 2 ** (level + 1) - 1)
            at = _tree_sql(tree, left, lambda n, _: str(n) if n in grown else "CAST(NULL AS INT)")
            best = _splits(_histogram(rows, at), missing, reg_lambda, min_child_weight)
            found = best.agg(F.collect_list(F.struct("node", "g", "h", "s")).alias("f")).first()["f"]  # a struct per node
            for r in found:
                if level == 0:
                    tree[0].value = -rate * r.g / (r.h + reg_lambda)
                if r.s is None:
                    continue
                node, s = tree[r.node], r.s
                node.feature, node.bin, node.missing_left = s.feature, s.bin, s.missing_left
                node.cut = None if s.lost else cuts[s.feature][s.bin - 1]
                tree[2 * r.node + 1] = Node(-rate * s.gl / (s.hl + reg_lambda))
                tree[2 * r.node + 2] = Node(-rate * s.gr / (s.hr + reg_lambda))
            if not any(r.s for r in found):
                break
        if level == 0 and not found:
            break  # no rows
        model.trees.append(tree)
        rows = rows.withColumn("margin", F.expr("margin + " + _tree_sql(tree, left, _leaf)))
        if (k + 1) % WRITE_EVERY == 0 and k + 1 < rounds:
            rows = stored(rows, "boosting")
    release(spark, since)
    return model


def score(model: BoostedTrees, df: DataFrame, *keep: str) -> DataFrame:
    """``keep``, the margin, P(class 1) and the class of every row; built-in expressions only."""
    p = 1.0 / (1.0 + F.exp(-F.col("margin")))
    return df.select(*keep, F.expr(model.margin()).alias("margin")).withColumn("p_hot", p).withColumn(
        "prediction", (F.col("p_hot") > 0.5).cast("int"))


def save(model: BoostedTrees, spark: SparkSession, path: str) -> None:
    """One row per tree, and one (tree -1) for features and base margin."""
    head = {"features": model.features, "base_margin": model.base_margin}
    lines = [(-1, json.dumps(head)), *(
        (k, json.dumps({str(n): asdict(v) for n, v in t.items()})) for k, t in enumerate(model.trees))]
    spark.createDataFrame(lines, "tree int, nodes string").coalesce(1).write.mode("overwrite").parquet(path)


def load(spark: SparkSession, path: str) -> BoostedTrees:
    """A model written by ``save`` (a row per tree, so bounded by the rounds)."""
    row = spark.read.parquet(path).agg(F.collect_list(F.struct("tree", "nodes")).alias("t")).first()
    lines = dict(map(tuple, row["t"]))
    head = json.loads(lines.pop(-1))
    trees = [{int(n): Node(**v) for n, v in json.loads(lines[k]).items()} for k in sorted(lines)]
    return BoostedTrees(head["features"], head["base_margin"], trees)
