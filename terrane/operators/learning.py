"""Model training and scoring: median imputation, folded rare categories, one-hot and boosted trees."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import Imputer, OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def fold_rare(df: DataFrame, column: str, least: int, other: str = "(rare)") -> DataFrame:
    """Categories with fewer than ``least`` rows become one; null is a category of its own."""
    filled = df.withColumn(column, F.coalesce(F.col(column), F.lit("(null)")))
    common = filled.groupBy(column).agg(F.count("*").alias("_n")).where(F.col("_n") >= least).select(column, F.lit(1).alias("_common"))
    return filled.join(common, column, "left").withColumn(column, F.when(F.col("_common") == 1, F.col(column)).otherwise(other)).drop("_common")


def pipeline(numeric: list[str], categorical: list[str], label: str, weight: str | None = None, iterations: int = 20, depth: int = 4, seed: int = 7) -> Pipeline:
    stages: list = [Imputer(inputCols=numeric, outputCols=[f"{c}__f" for c in numeric], strategy="median")]
    for c in categorical:
        stages += [StringIndexer(inputCol=c, outputCol=f"{c}__i", handleInvalid="keep"), OneHotEncoder(inputCol=f"{c}__i", outputCol=f"{c}__v")]
    stages.append(VectorAssembler(inputCols=[f"{c}__f" for c in numeric] + [f"{c}__v" for c in categorical], outputCol="features", handleInvalid="keep"))
    gbt = GBTClassifier(labelCol=label, featuresCol="features", maxIter=iterations, maxDepth=depth, seed=seed)
    stages.append(gbt.setWeightCol(weight) if weight else gbt)
    return Pipeline(stages=stages)


def train(df: DataFrame, numeric: list[str], categorical: list[str], label: str, weight: str | None = None, **more: int) -> PipelineModel:
    ready = df.where(F.col(label).isNotNull()).withColumns({c: F.col(c).cast("double") for c in [*numeric, label]})
    return pipeline(numeric, categorical, label, weight, **more).fit(ready)


def score(model: PipelineModel, df: DataFrame, numeric: list[str], out: str) -> DataFrame:
    """Rows with the probability of class 1; missing numeric columns count as missing values."""
    ready = df.withColumns({c: F.col(c).cast("double") if c in df.columns else F.lit(None).cast("double") for c in numeric})
    scored = model.transform(ready).withColumn(out, vector_to_array("probability")[1])
    return scored.select(*df.columns, out)


def importances(model: PipelineModel, numeric: list[str]) -> list[tuple[str, float]]:
    """Importance of the numeric features, greatest first."""
    values = model.stages[-1].featureImportances.toArray()
    return sorted(zip(numeric, values[: len(numeric)], strict=True), key=lambda p: -p[1])
