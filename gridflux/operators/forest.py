"""Random forests of MLlib, one for each target.

MLlib keeps no out-of-bag predictions; residuals come from k folds instead.
"""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import RandomForestRegressionModel, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TREES, LEAF, SHARE, LEAST_ROWS = 500, 2, "0.33", 20


def assemble(df: DataFrame, features: list[str]) -> DataFrame:
    return VectorAssembler(inputCols=features, outputCol="features", handleInvalid="keep").transform(df)


def fit_forest(df: DataFrame, features: list[str], target: str, trees: int = TREES, seed: int = 0, depth: int = 12) -> RandomForestRegressionModel | None:
    """None with fewer than 20 observed rows."""
    rows = df.where(F.col(target).isNotNull())
    if rows.limit(LEAST_ROWS).count() < LEAST_ROWS:
        return None
    forest = RandomForestRegressor(
        featuresCol="features", labelCol=target, predictionCol=f"{target}_pred", numTrees=trees, minInstancesPerNode=LEAF,
        featureSubsetStrategy=SHARE, bootstrap=True, seed=seed, maxDepth=depth,
    )
    return forest.fit(assemble(rows, features))


def predict_forest(model: RandomForestRegressionModel | None, df: DataFrame, features: list[str], target: str) -> DataFrame:
    if model is None:
        return df.withColumn(f"{target}_pred", F.lit(None).cast("double"))
    return model.transform(assemble(df, features)).drop("features")


def fold_predictions(df: DataFrame, key: str, features: list[str], target: str, folds: int = 5, **params) -> DataFrame:
    """(key, obs, pred) where each row is predicted by a forest that hasn't seen it."""
    fold = F.pmod(F.xxhash64(key), F.lit(folds))
    out = None
    for k in range(folds):
        model = fit_forest(df.where(fold != k), features, target, **params)
        part = predict_forest(model, df.where((fold == k) & F.col(target).isNotNull()), features, target)
        part = part.select(key, F.col(target).alias(f"{target}_obs"), f"{target}_pred")
        out = part if out is None else out.unionByName(part)
    return out


def importances(model: RandomForestRegressionModel, features: list[str]) -> list[tuple[str, float]]:
    return sorted(zip(features, model.featureImportances.toArray().tolist(), strict=True), key=lambda x: -x[1])


def fit_all(df: DataFrame, features: list[str], targets: list[str], **params) -> dict[str, RandomForestRegressionModel | None]:
    """A forest for each target on the rows where all targets are observed."""
    complete = df.dropna(subset=targets)
    return {t: fit_forest(complete, features, t, **params) for t in targets}


def save_forest(model: RandomForestRegressionModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_forest(path: str) -> RandomForestRegressionModel:
    return RandomForestRegressionModel.load(path)
