"""Lead-scoring model training and evaluation on Spark ML (ML-1..16).

The label is a function of the inputs (``lead_score`` is computed from
revenue, interactions, engagement and win rate), so accuracy measures how
well a model recovers the scoring formula, not a real prediction.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dealspark.operators.profile import exact_median
from dealspark.operators.scaling import PopulationScaler
from dealspark.operators.select import narrowed
from dealspark.sources.scratch import stored

# Candidate model inputs, label name and hot threshold.
FEATURES = (
    "total_interactions", "num_calls", "num_whatsapp", "num_emails",
    "num_positive_outcomes", "num_negative_outcomes", "engagement_score",
    "total_revenue", "num_closed_won", "num_closed_lost", "conversion_rate",
    "win_rate", "avg_deal_value", "employee_count", "annual_revenue",
)
LABEL = "is_hot_lead"
HOT_THRESHOLD = 80.0


def hot_lead_label(features: DataFrame, threshold: float = HOT_THRESHOLD) -> DataFrame:
    """ML-1: ``is_hot_lead`` = lead_score >= threshold, as int."""
    return features.withColumn(LABEL, (F.col("lead_score") >= F.lit(threshold)).cast("int"))


def median_label(features: DataFrame) -> DataFrame:
    """ML-2: fallback label — revenue above its median AND interactions above
    theirs. The medians are exact and come in as scalar subqueries."""
    rev = exact_median(features, "total_revenue").select("median").scalar()
    n = exact_median(features, "total_interactions").select("median").scalar()
    return features.withColumn(
        LABEL, ((F.col("total_revenue") > rev) & (F.col("total_interactions") > n)).cast("int"))


def make_label(features: DataFrame, threshold: float = HOT_THRESHOLD) -> DataFrame:
    """ML-1 when ``lead_score`` exists, else ML-2 (a schema check, no job)."""
    if "lead_score" in features.columns:
        return hot_lead_label(features, threshold)
    return median_label(features)


def available_features(df: DataFrame, candidates: Sequence[str] = FEATURES) -> list[str]:
    """ML-4: the candidate features present in the table, in candidate order."""
    return [c for c in candidates if c in df.columns]


def feature_matrix(df: DataFrame, id_col: str, features: Sequence[str],
                   label: str = LABEL) -> DataFrame:
    """ML-4: id, the features as doubles with NULL → 0, and the label."""
    return df.select(id_col, *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c)
                               for c in features], label)


def split_hash(id_col: str, seed: int) -> Column:
    """60-bit hash of ``id:seed`` (first 15 hex digits of its MD5)."""
    digest = F.md5(F.concat(F.col(id_col).cast("string"), F.lit(f":{seed}")))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint")


def stratified_split(df: DataFrame, id_col: str, label: str = LABEL,
                     test_fraction: float = 0.2, seed: int = 42) -> DataFrame:
    """ML-5: exact, reproducible stratified split; adds ``split`` ∈ {train, test}.

    Within each class the ``round(test_fraction × n_class)`` rows with the
    smallest ``(hash(id, seed), id)`` form the test set. Bucket counts of the
    hash narrow each class to a thin band (``select.narrowed``); rows below it
    are test, rows above it train, and only the band is ranked.
    """
    h = df.withColumn("__h", split_hash(id_col, seed)).withColumn("__place", F.col("__h").cast("double"))
    k = F.round(F.col("n") * F.lit(float(test_fraction))).cast("bigint")
    sought = F.greatest(k, F.lit(1))
    start, end = F.lit(0.0), F.lit(float(1 << 60))
    wide = narrowed(h, label, "__place", start, end, None, sought, sought)
    thin = narrowed(h, label, "__place", start, end, wide, sought, sought)
    limits = thin.select(label, k.alias("__k"), F.col("below").alias("__below"), F.col("lo").alias("__lo"),
                         F.col("hi").alias("__hi"))
    j = h.join(F.broadcast(limits), label, "left")
    in_band = F.coalesce((F.col("__place") >= F.col("__lo")) & (F.col("__place") <= F.col("__hi")), F.lit(False))
    outside = j.where(~in_band).withColumn("split", F.when(
        (F.col("__place") < F.col("__lo")) & (F.col("__k") > 0), F.lit("test")).otherwise(F.lit("train")))
    w = Window.partitionBy(label).orderBy("__h", id_col)
    inside = j.where(in_band).withColumn("split", F.when(
        F.row_number().over(w) + F.col("__below") <= F.col("__k"), F.lit("test")).otherwise(F.lit("train")))
    return outside.unionByName(inside).drop("__h", "__place", "__k", "__below", "__lo", "__hi")


def random_split(df: DataFrame, test_fraction: float = 0.2, seed: int = 42) -> DataFrame:
    """ML-6 (documented): plain random split, adds ``split``; Spark's
    ``randomSplit`` semantics (per-row Bernoulli, reproducible for a fixed
    seed and input partitioning)."""
    train, test = df.randomSplit([1.0 - test_fraction, test_fraction], seed)
    return train.withColumn("split", F.lit("train")).unionByName(test.withColumn("split", F.lit("test")))


def build_pipeline(features: Sequence[str], algorithm: str = "gbt", seed: int = 42,
                   label: str = LABEL) -> Pipeline:
    """ML-7..9: assembler, a fitted scaler by population moments (kept, as in
    the reference, but not fed to the model) and the classifier.

    ``rf``: 100 trees, depth 10. ``gbt``: 100 rounds, depth 5, step 0.1
    (Spark's boosted trees; a related algorithm, not XGBoost).
    """
    assembler = VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="keep")
    scaler = PopulationScaler(inputCol="features", outputCol="scaled_features")
    if algorithm == "rf":
        model = RandomForestClassifier(labelCol=label, featuresCol="features", numTrees=100,
                                       maxDepth=10, seed=seed)
    elif algorithm == "gbt":
        model = GBTClassifier(labelCol=label, featuresCol="features", maxIter=100, maxDepth=5,
                              stepSize=0.1, seed=seed, checkpointInterval=10)
    else:
        raise ValueError(f"unknown algorithm {algorithm!r}")
    return Pipeline(stages=[assembler, scaler, model])


def train(train_df: DataFrame, features: Sequence[str], algorithm: str = "gbt",
          seed: int = 42, label: str = LABEL) -> PipelineModel:
    """Fit one pipeline (an action: Spark ML trains distributed)."""
    return build_pipeline(features, algorithm, seed, label).fit(train_df)


def score(model: PipelineModel, df: DataFrame, id_col: str, label: str = LABEL) -> DataFrame:
    """ML-10: id, label, predicted class and P(class 1)."""
    out = model.transform(df)
    return out.select(id_col, F.col(label).cast("int").alias(label),
                      F.col("prediction").cast("int").alias("prediction"),
                      vector_to_array("probability")[1].alias("p_hot"))


def binary_metrics(pred: DataFrame, label: str = LABEL, prediction: str = "prediction") -> DataFrame:
    """ML-11 / ML-13: accuracy, precision, recall, F1 of class 1 (0/0 → 0) and
    the four confusion cells, in one aggregate (a one-class test set gives
    zeros, not an error)."""
    y, p = F.col(label), F.col(prediction)
    cells = pred.agg(
        F.count_if((y == 0) & (p == 0)).alias("tn"), F.count_if((y == 0) & (p == 1)).alias("fp"),
        F.count_if((y == 1) & (p == 0)).alias("fn"), F.count_if((y == 1) & (p == 1)).alias("tp"))
    tp, fp, fn, tn = (F.col(c).cast("double") for c in ("tp", "fp", "fn", "tn"))
    precision = F.coalesce(F.try_divide(tp, tp + fp), F.lit(0.0))
    recall = F.coalesce(F.try_divide(tp, tp + fn), F.lit(0.0))
    return cells.select(
        F.coalesce(F.try_divide(tp + tn, tp + tn + fp + fn), F.lit(0.0)).alias("accuracy"),
        precision.alias("precision"), recall.alias("recall"),
        F.coalesce(F.try_divide(F.lit(2.0) * precision * recall, precision + recall), F.lit(0.0)).alias("f1"),
        "tn", "fp", "fn", "tp")


def classification_report(pred: DataFrame, label: str = LABEL, prediction: str = "prediction") -> DataFrame:
    """ML-14: per-class precision / recall / F1 / support, then macro and
    weighted averages and accuracy (the sklearn report as a table)."""
    y, p = F.col(label), F.col(prediction)
    cells = pred.agg(
        F.count_if((y == 0) & (p == 0)).alias("tn"), F.count_if((y == 0) & (p == 1)).alias("fp"),
        F.count_if((y == 1) & (p == 0)).alias("fn"), F.count_if((y == 1) & (p == 1)).alias("tp"))

    def prf(tp: Column, fp: Column, fn: Column):
        pr = F.coalesce(F.try_divide(tp, tp + fp), F.lit(0.0))
        rc = F.coalesce(F.try_divide(tp, tp + fn), F.lit(0.0))
        f1 = F.coalesce(F.try_divide(F.lit(2.0) * pr * rc, pr + rc), F.lit(0.0))
        return pr, rc, f1

    tp, fp, fn, tn = (F.col(c).cast("double") for c in ("tp", "fp", "fn", "tn"))
    p1, r1, f1 = prf(tp, fp, fn)
    p0, r0, f0 = prf(tn, fn, fp)
    s1, s0 = tp + fn, tn + fp
    total = s0 + s1
    rows = [
        ("0", p0, r0, f0, s0), ("1", p1, r1, f1, s1),
        ("macro avg", (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, total),
        ("weighted avg",) + tuple(F.coalesce(F.try_divide(a * s0 + b * s1, total), F.lit(0.0))
                                  for a, b in ((p0, p1), (r0, r1), (f0, f1))) + (total,),
    ]
    acc = F.coalesce(F.try_divide(tp + tn, total), F.lit(0.0))
    structs = [F.struct(F.lit(n).alias("class_label"), a.alias("precision"), b.alias("recall"),
                        c.alias("f1"), d.cast("bigint").alias("support")) for n, a, b, c, d in rows]
    structs.append(F.struct(F.lit("accuracy").alias("class_label"), F.lit(None).cast("double").alias("precision"),
                            F.lit(None).cast("double").alias("recall"), acc.alias("f1"),
                            total.cast("bigint").alias("support")))
    return cells.select(F.explode(F.array(*structs)).alias("s")).select("s.*")


def roc_auc(pred: DataFrame, label: str = LABEL, score_col: str = "p_hot") -> DataFrame:
    """ML-12: one row ``roc_auc``, the exact area under the ROC curve (NULL if a class is absent).

    It is the chance that a positive scores above a negative, ties counting
    half: a rank sum over distinct scores. Distinct scores are dealt to ranges
    of even size, whatever their distribution, and stored with their range;
    scores are ranked within a range, and the ranges' totals are added up, so
    no window runs over all scores. The sums are integers.
    """
    y = F.col(label) == 1
    by_score = pred.where(F.col(score_col).isNotNull() & F.col(label).isNotNull()).groupBy(
        F.col(score_col).cast("double").alias("s")).agg(
        F.count_if(y).alias("pos"), F.count_if(~y).alias("neg"))
    scored = stored(by_score.repartitionByRange("s").withColumn("part", F.spark_partition_id()), "auc-scores")
    in_order = Window.partitionBy("part").orderBy("s").rowsBetween(Window.unboundedPreceding, -1)
    ranked = scored.withColumn("under", F.coalesce(F.sum("neg").over(in_order), F.lit(0)))
    parts = ranked.groupBy("part").agg(
        F.sum(F.col("pos") * (2 * F.col("under") + F.col("neg"))).cast("decimal(38,0)").alias("won"),
        F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    parts = parts.withColumn("under", F.coalesce(F.sum("neg").over(earlier), F.lit(0)).cast("decimal(38,0)"))
    total = parts.agg(F.sum(F.col("won") + 2 * F.col("pos") * F.col("under")).cast("double").alias("won"),
                      F.sum("pos").cast("double").alias("pos"), F.sum("neg").cast("double").alias("neg"))
    return total.select(F.try_divide(F.col("won"), 2.0 * F.col("pos") * F.col("neg")).alias("roc_auc"))


def consistent_predictions(pred: DataFrame, again: DataFrame, id_col: str, label: str = LABEL) -> DataFrame:
    """Scored rows checked against what must hold: the probability lies in
    [0, 1], the class is 1 exactly if it is over one half, and ``again`` (the
    reloaded model's scores) has the same class and probability."""
    other = again.select(id_col, F.col("prediction").alias("__class"), F.col("p_hot").alias("__p"))
    return pred.join(other, id_col, "left").select(
        id_col, label, F.col("p_hot").between(0.0, 1.0).alias("probability_in_range"),
        ((F.col("p_hot") > 0.5) == (F.col("prediction") == 1)).alias("class_agrees"),
        F.coalesce((F.col("__class") == F.col("prediction")) & (F.abs(F.col("__p") - F.col("p_hot")) < 1e-9),
                   F.lit(False)).alias("reload_agrees"))


def select_model(scores: Mapping[str, float], prefer: str = "gbt") -> str:
    """ML-15: best model by metric (a NULL metric is the least); ties and the reference default → ``prefer``."""
    known = {name: -1.0 if s is None else s for name, s in scores.items()}
    best = max(known.values())
    return prefer if known.get(prefer) == best else max(known, key=known.get)


def save_model(model: PipelineModel, path: str) -> None:
    """ML-16: persist the pipeline (assembler inputs = feature list, scaler, model)."""
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    """ML-16: reload a saved pipeline."""
    return PipelineModel.load(path)


def model_features(model: PipelineModel) -> list[str]:
    """The feature list stored in a saved pipeline."""
    return list(model.stages[0].getInputCols())
