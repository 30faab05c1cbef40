"""ML-7: a Spark ML stage that scales features by their population mean and deviation.

Spark's own ``StandardScaler`` divides by the sample deviation (n - 1); the
reference's scaler divides by the population deviation (n). Fitting is one
aggregate of mergeable moments; transforming is a native expression.
"""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasOutputCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class PopulationScalerModel(Model, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """(x - mean) / deviation per feature; a constant feature becomes 0."""

    mean = Param(Params._dummy(), "mean", "mean of each feature", TypeConverters.toListFloat)
    std = Param(Params._dummy(), "std", "population standard deviation of each feature", TypeConverters.toListFloat)

    def __init__(self, mean: list[float] | None = None, std: list[float] | None = None):
        super().__init__()
        if mean is not None:
            self._set(mean=mean, std=std)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        ends = F.array(*[F.struct(F.lit(m).alias("m"), F.lit(s).alias("s"))
                         for m, s in zip(self.getOrDefault("mean"), self.getOrDefault("std"))])
        scaled = F.zip_with(vector_to_array(self.getInputCol()), ends,
                            lambda x, e: F.when(e["s"] > 0, (x - e["m"]) / e["s"]).otherwise(F.lit(0.0)))
        return dataset.withColumn(self.getOutputCol(), array_to_vector(scaled))


class PopulationScaler(Estimator, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """Fits a ``PopulationScalerModel`` on a vector column; an empty table is an error."""

    @keyword_only
    def __init__(self, *, inputCol: str | None = None, outputCol: str | None = None):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, dataset: DataFrame) -> PopulationScalerModel:
        held = dataset.select(vector_to_array(self.getInputCol()).alias("x"))
        first = held.first()
        if first is None:
            raise ValueError("an empty table has no mean")
        places = range(1, len(first["x"]) + 1)
        found = held.agg(*[f(F.element_at("x", k)).alias(f"{name}{k}") for k in places
                           for name, f in (("m", F.avg), ("s", F.stddev_pop))]).first()
        model = PopulationScalerModel([found[f"m{k}"] for k in places], [found[f"s{k}"] for k in places])
        return model._set(inputCol=self.getInputCol(), outputCol=self.getOutputCol())
