"""Standardized features, principal components and k-means over swings."""

from __future__ import annotations

import math
from collections.abc import Iterable, Sequence
from multiprocessing.pool import ThreadPool

import numpy as np
from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import (
    PCA, ElementwiseProduct, SQLTransformer, StandardScaler, VectorAssembler,
)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from swinglake.operators.shaping import pose_columns

# fixed values of the analysis
KEY_FRAME = "BallContact"
COMPONENTS = 3
CLUSTERS = 4
SWEEP = range(1, 21)
SEED = 42


def swing_features(df: DataFrame, key_frame: str = KEY_FRAME) -> DataFrame:
    """One key frame per swing, its pose columns assembled to a ``features`` vector;
    a missing value is an error.  The event is kept to name the rows."""
    columns = pose_columns(df)
    chosen = df.where(F.col("KeyFrameNames") == key_frame).select("input_event", *columns)
    return assemble(chosen, columns)


def assemble(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return VectorAssembler(
        inputCols=list(columns), outputCol="features", handleInvalid="error").transform(df)


def _without(column: str) -> SQLTransformer:
    return SQLTransformer(statement=f"SELECT * EXCEPT ({column}) FROM __THIS__")


def fit_scaler(df: DataFrame, column: str = "features", out: str = "scaled") -> PipelineModel:
    """Zero mean and unit population deviation per feature; constants become 0.

    Only means and deviations, two numbers per feature, reach the driver.
    """
    scaler = StandardScaler(inputCol=column, outputCol="_unit", withMean=True, withStd=True).fit(df)
    n = df.count()
    # the scaler divides by the sample deviation
    factor = math.sqrt(n / (n - 1)) if n > 1 else 1.0
    rescale = ElementwiseProduct(
        scalingVec=Vectors.dense([factor] * len(scaler.mean)), inputCol="_unit", outputCol=out)
    return PipelineModel([scaler, rescale, _without("_unit")])


def standardize(df: DataFrame, column: str = "features", out: str = "scaled") -> DataFrame:
    """``df`` with its features scaled by their own means and deviations."""
    return fit_scaler(df, column, out).transform(df)


def fit_components(df: DataFrame, k: int = COMPONENTS, column: str = "scaled",
                   out: str = "scores") -> PipelineModel:
    """The first ``k`` principal components of a centred column.

    Each component is turned so that its largest loading is positive, which makes
    the scores comparable between runs.  The driver holds one matrix of the size
    features x features.
    """
    model = PCA(k=k, inputCol=column, outputCol="_raw").fit(df)
    loadings = model.pc.toArray()
    largest = np.abs(loadings).argmax(axis=0)
    signs = np.sign(loadings[largest, np.arange(loadings.shape[1])])
    turn = ElementwiseProduct(
        scalingVec=Vectors.dense(signs), inputCol="_raw", outputCol=out)
    return PipelineModel([model, turn, _without("_raw")])


def pca_scores(df: DataFrame, k: int = COMPONENTS, column: str = "scaled",
               out: str = "scores") -> DataFrame:
    """``df`` with its scores on its own principal components."""
    return fit_components(df, k, column, out).transform(df)


def fit_clusters(df: DataFrame, k: int = CLUSTERS, column: str = "scores",
                 seed: int = SEED) -> KMeansModel:
    return KMeans(k=k, seed=seed, featuresCol=column, predictionCol="prediction").fit(df)


def total_squares(df: DataFrame, column: str = "scores") -> float:
    """Squared distance of all rows to their mean: the one-cluster cost."""
    stats = df.select(Summarizer.metrics("variance", "count").summary(F.col(column)).alias("s"))
    variance, n = stats.select("s.variance", "s.count").first()
    return float(sum(variance)) * (n - 1)


def fit_sweep(df: DataFrame, ks: Iterable[int] = SWEEP, seed: int = SEED, column: str = "scores",
              parallelism: int = 8) -> dict[int, KMeansModel]:
    """A fit for every ``k`` above 1.

    The fits are independent and their jobs small (three numbers per swing), so
    ``parallelism`` of them are submitted at a time.
    """
    points, several = df.select(column).persist(StorageLevel.MEMORY_AND_DISK), [k for k in ks if k > 1]
    try:
        with ThreadPool(parallelism) as pool:
            models = pool.map(inheritable_thread_target(df.sparkSession)(
                lambda k: fit_clusters(points, k, column, seed)), several, 1)
    finally:
        points.unpersist()
    return dict(zip(several, models))


def kmeans_sweep(df: DataFrame, ks: Iterable[int] = SWEEP, seed: int = SEED,
                 column: str = "scores", parallelism: int = 8,
                 models: dict[int, KMeansModel] | None = None) -> DataFrame:
    """Within-cluster squares for every ``k``, as ``(k, wcss)``; of ``models``, where they are fitted already."""
    ks = list(ks)
    fitted = fit_sweep(df, ks, seed, column, parallelism) if models is None else models
    costs = [(k, float(fitted[k].summary.trainingCost) if k > 1 else total_squares(df, column)) for k in ks]
    return df.sparkSession.createDataFrame(costs, "k int, wcss double")


def elbow(sweep: DataFrame) -> DataFrame:
    """The sweep with the drop from each ``k`` to the next; the table is as long as
    the list of ``k``."""
    before = F.lag("wcss").over(Window.orderBy("k"))
    return sweep.select("k", "wcss", (before - F.col("wcss")).alias("drop"))


def label_clusters(df: DataFrame, model: KMeansModel) -> DataFrame:
    """Features with their latent coordinates, cluster number and cluster name; as many
    coordinates as the clusters were made from."""
    components = len(model.clusterCenters()[0])
    scores = vector_to_array("scores")
    labelled = model.transform(df)
    return labelled.select(
        *[c for c in df.columns if c not in ("features", "scaled", "scores")],
        *[scores[i].alias(f"LatentVector{i + 1}") for i in range(components)],
        F.col("prediction").alias("Cluster K-means PCA"),
        F.concat(F.lit("Cluster"), F.col("prediction") + 1).alias("Cluster"))


def cluster_points(labelled: DataFrame, *keep: str) -> DataFrame:
    """What a scatter plot of the clusters shows."""
    return labelled.select(*keep, "LatentVector2", "LatentVector1", "Cluster")


def silhouette(df: DataFrame, model: KMeansModel) -> float:
    return ClusteringEvaluator(featuresCol="scores").evaluate(model.transform(df))
