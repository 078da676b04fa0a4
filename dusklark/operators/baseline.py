"""Expected demand from a Tweedie model with logarithmic link (MLlib); unseen categories share one level."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import Imputer, OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.regression import GeneralizedLinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _ready(df: DataFrame, numbers: list[str], labels: list[str]) -> DataFrame:
    out = df
    for c in numbers:
        x = F.col(c).cast("double")
        out = out.withColumn(f"{c}__x", F.when(~F.isnan(x), x)).withColumn(f"{c}__null", (x.isNull() | F.isnan(x)).cast("double"))
    for c in labels:
        out = out.withColumn(f"{c}__s", F.when(F.col(c) != "", F.col(c)).otherwise(F.lit("(none)")))
    return out


def fit_baseline(df: DataFrame, target: str, numbers: list[str], labels: list[str], power: float = 1.3, reg: float = 1e-3) -> PipelineModel:
    """Fit to the rows whose target is known and not negative. Missing numbers get the column's mean and a flag of their own."""
    rows = _ready(df.filter(F.col(target) >= 0).withColumn("label__", F.col(target).cast("double")), numbers, labels)
    stages = [Imputer(inputCols=[f"{c}__x" for c in numbers], outputCols=[f"{c}__i" for c in numbers])]
    stages.append(StringIndexer(inputCols=[f"{c}__s" for c in labels], outputCols=[f"{c}__n" for c in labels], handleInvalid="keep"))
    stages.append(OneHotEncoder(inputCols=[f"{c}__n" for c in labels], outputCols=[f"{c}__v" for c in labels], handleInvalid="keep"))
    stages.append(VectorAssembler(inputCols=[*[f"{c}__i" for c in numbers], *[f"{c}__null" for c in numbers], *[f"{c}__v" for c in labels]], outputCol="features__"))
    stages.append(GeneralizedLinearRegression(family="tweedie", variancePower=power, linkPower=0.0, featuresCol="features__", labelCol="label__", predictionCol="expected", regParam=reg, maxIter=25))
    return Pipeline(stages=stages).fit(rows)


def predict(model: PipelineModel, df: DataFrame, numbers: list[str], labels: list[str], floor: float = 0.01) -> DataFrame:
    """The rows with ``expected`` demand, never below ``floor``."""
    return model.transform(_ready(df, numbers, labels)).select(*df.columns, F.greatest(F.col("expected"), F.lit(floor)).alias("expected"))
