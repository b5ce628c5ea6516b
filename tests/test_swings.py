from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.clustering import KMeansModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from swinglake.plans.clusters import fit_swing_model, label_swings

from swinglake.operators.swings import (
    assemble, cluster_points, elbow, fit_clusters, kmeans_sweep, label_clusters, pca_scores,
    silhouette, standardize, total_squares,
)


@pytest.fixture(scope="module")
def matrix():
    rnd = np.random.default_rng(3)
    centres = rnd.normal(0, 8, (4, 6))
    x = centres[rnd.integers(0, 4, 120)] + rnd.normal(0, 1, (120, 6))
    x[:, 4] = 2.5  # a constant feature
    return x


@pytest.fixture(scope="module")
def features(spark, matrix):
    rows = [(f"e{i}", *map(float, r)) for i, r in enumerate(matrix)]
    columns = [f"f{i}" for i in range(6)]
    df = spark.createDataFrame(rows, "input_event string, " + ", ".join(f"{c} double" for c in columns))
    return assemble(df, columns).cache()


def as_matrix(df, column):
    rows = df.select("input_event", vector_to_array(column).alias("v")).collect()
    return np.array([r["v"] for r in sorted(rows, key=lambda r: int(r["input_event"][1:]))])


def zscores(x):
    dev = x.std(axis=0)
    return np.where(dev > 1e-12, (x - x.mean(axis=0)) / np.where(dev > 1e-12, dev, 1), 0)


def test_standardize_uses_the_population_deviation(features, matrix):
    np.testing.assert_allclose(as_matrix(standardize(features), "scaled"), zscores(matrix), atol=1e-9)


def test_components_are_the_eigenvectors(features, matrix):
    z = zscores(matrix)
    values, vectors = np.linalg.eigh(z.T @ z / len(z))
    top = vectors[:, ::-1][:, :3]
    top = top * np.sign(top[np.abs(top).argmax(axis=0), range(3)])
    scores = as_matrix(pca_scores(standardize(features)), "scores")
    np.testing.assert_allclose(scores, z @ top, atol=1e-8)
    np.testing.assert_allclose(scores.var(axis=0), values[::-1][:3], atol=1e-8)


def test_sweep_and_elbow(spark, features):
    points = pca_scores(standardize(features)).cache()
    scores = as_matrix(points, "scores")
    sweep = elbow(kmeans_sweep(points, range(1, 7))).orderBy("k").collect()
    costs = [r["wcss"] for r in sweep]
    assert [r["k"] for r in sweep] == [1, 2, 3, 4, 5, 6]
    assert costs[0] == pytest.approx(((scores - scores.mean(axis=0)) ** 2).sum())
    assert costs[0] == pytest.approx(total_squares(points))
    assert all(b <= a * 1.05 for a, b in zip(costs, costs[1:])) and costs[3] < costs[0] / 5
    assert sweep[0]["drop"] is None and sweep[1]["drop"] == pytest.approx(costs[0] - costs[1])


def test_labels(spark, features, tmp_path):
    points = pca_scores(standardize(features)).cache()
    model = fit_clusters(points)
    table = label_clusters(points, model)
    assert table.columns == ["input_event", *[f"f{i}" for i in range(6)], "LatentVector1",
                             "LatentVector2", "LatentVector3", "Cluster K-means PCA", "Cluster"]
    assert table.count() == 120
    wrong = table.where(F.col("Cluster") != F.concat(F.lit("Cluster"), F.col("Cluster K-means PCA") + 1))
    assert wrong.count() == 0
    assert {r[0] for r in table.select("Cluster").distinct().collect()} == {
        "Cluster1", "Cluster2", "Cluster3", "Cluster4"}
    assert cluster_points(table).columns == ["LatentVector2", "LatentVector1", "Cluster"]
    assert silhouette(points, model) > 0.5
    model.save(f"{tmp_path}/model")
    again = label_clusters(points, KMeansModel.load(f"{tmp_path}/model"))
    assert again.exceptAll(table).count() == 0


def test_later_swings_go_through_the_fitted_model(spark, features, matrix, tmp_path):
    model = fit_swing_model(features)
    model.save(f"{tmp_path}/model")
    few = features.where("input_event IN ('e3', 'e7', 'e11')")
    later = label_swings(few, PipelineModel.load(f"{tmp_path}/model"))
    assert later.count() == 3
    every = label_swings(features, model)
    assert later.exceptAll(every).count() == 0
    assert every.columns == label_clusters(pca_scores(standardize(features)), model.stages[-1]).columns


def test_missing_features_are_an_error(spark):
    df = spark.createDataFrame([(1.0, None)], "a double, b double")
    with pytest.raises(Exception, match="null|NULL"):
        assemble(df, ["a", "b"]).collect()
