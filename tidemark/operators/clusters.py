"""Clustering: k-means with elbow, Gaussian mixture; density clusters by a tree of boxes."""

from __future__ import annotations

import functools
import operator
from typing import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.clustering import GaussianMixture, KMeans
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.sql import Column, DataFrame, functions as F

from .density import dbscan as dbscan
from .models import CLUSTER_LABELS, knee


def cluster_fit(df: DataFrame, features: Sequence[str], k: int = 4, seed: int = 0, starts: int = 3, max_iter: int = 100) -> PipelineModel:
    """Standardise and k-means; the best of several starts by training cost. Rows with a
    gap (null or NaN) are not learned from.

    The plain features are kept, computed once for the scales and all starts. The vectors are not:
    k-means keeps what it is given uncached in its own form, so that a round does not decode every row again.
    """
    complete = df.select(*features).dropna().persist()
    prepared = Pipeline(
        stages=[
            VectorAssembler(inputCols=list(features), outputCol="raw__", handleInvalid="keep"),
            StandardScaler(inputCol="raw__", outputCol="scaled__", withMean=True, withStd=True),
        ]
    ).fit(complete)
    data = prepared.transform(complete).select("scaled__")
    best = None
    for s in range(starts):
        m = KMeans(k=k, seed=seed + s, featuresCol="scaled__", predictionCol="group", maxIter=max_iter).fit(data)
        if best is None or m.summary.trainingCost < best.summary.trainingCost:
            best = m
    complete.unpersist()
    return PipelineModel(stages=[*prepared.stages, best])


def _whole(features: Sequence[str]) -> Column:
    """No null or NaN among the features."""
    return functools.reduce(operator.and_, [~F.isnan(F.coalesce(F.col(c).cast("double"), F.lit(float("nan")))) for c in features])


def cluster_predict(df: DataFrame, model: PipelineModel) -> DataFrame:
    """Every row with its `group`; null where a feature has a gap."""
    known = _whole(model.stages[0].getInputCols())
    return model.transform(df).withColumn("group", F.when(known, F.col("group"))).drop("raw__", "scaled__")


def cluster_category(df: DataFrame, model: PipelineModel, name: str = "cluster_category") -> DataFrame:
    labels = F.array(*[F.lit(x) for x in CLUSTER_LABELS])
    return cluster_predict(df, model).withColumn(name, F.get(labels, F.col("group"))).drop("group")


def elbow(df: DataFrame, features: Sequence[str], ks: Sequence[int], seed: int = 0, max_iter: int = 50) -> tuple[DataFrame, int]:
    """Training cost per k and the k at its knee, over the rows without a gap."""
    data = VectorAssembler(inputCols=list(features), outputCol="v__").transform(df.dropna(subset=list(features))).select("v__").persist()
    rows = []
    for k in ks:
        m = KMeans(k=k, seed=seed, featuresCol="v__", maxIter=max_iter).fit(data)
        rows.append((int(k), float(m.summary.trainingCost)))
    data.unpersist()
    costs = df.sparkSession.createDataFrame(rows, "k int, cost double")
    at = knee(costs, [], "cost", "k").first()["knee"]
    return costs, sorted(ks)[at - 1]


def gmm(df: DataFrame, features: Sequence[str], k: int = 4, seed: int = 1, max_iter: int = 50) -> DataFrame:
    """Every row with its mixture component as `group`; null where a feature has a gap,
    and such rows are not learned from."""
    data = VectorAssembler(inputCols=list(features), outputCol="v__", handleInvalid="keep").transform(df)
    mixture = GaussianMixture(k=k, seed=seed, featuresCol="v__", predictionCol="group", probabilityCol="p__", maxIter=max_iter)
    model = mixture.fit(data.dropna(subset=list(features)))
    return model.transform(data).withColumn("group", F.when(_whole(features), F.col("group"))).drop("v__", "p__")
