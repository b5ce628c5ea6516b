"""Features, components and clusters."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from swinglake.catalog import fixtures as fx
from swinglake.catalog.motion import KEYED, key_frames
from swinglake.catalog.registry import query
from swinglake.joints import JOINTS, MEASURES, NON_BODY_JOINTS
from swinglake.operators.swings import (
    KEY_FRAME, cluster_points, elbow, fit_clusters, fit_sweep, kmeans_sweep, label_clusters, pca_scores, silhouette,
    standardize, swing_features,
)
from swinglake.plans.clusters import fit_swing_model, label_swings, scored, swing_clusters
from swinglake.session import scratch_dir, staged


def _embedded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.table(spark, sf_dir, "embeddings").select(
        "vec_id", array_to_vector(F.col("embedding").cast("array<double>")).alias("features"))


_BODY = [(j, m) for j in JOINTS if j not in NON_BODY_JOINTS for m in MEASURES if m[0] != "M"]
_FEATURES_SQL = ", ".join(fx.pose_sql(j, m) for j, m in _BODY)


@query("swing_features", f"""WITH {KEYED}, rows AS (
  SELECT m.input_event, [{_FEATURES_SQL}] AS features
  FROM keyed k JOIN timed m ON k.input_event = m.input_event AND m."TimestampRounded" = 80
  WHERE k.name = 'BallContact' AND k._rescued_data IS NULL AND m._rescued_data IS NULL)
SELECT input_event, unnest(range(len(features)))::INT AS feature, unnest(features) AS x FROM rows""")
def swing_feature_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    features = swing_features(key_frames(spark, sf_dir, KEY_FRAME))
    return features.select(
        "input_event", F.posexplode(vector_to_array("features")).alias("feature", "x"))


@query("standardize", """WITH v AS (
  SELECT vec_id, unnest(range(len(embedding)))::INT AS feature, unnest(embedding)::DOUBLE AS x
  FROM embeddings),
s AS (SELECT feature, avg(x) AS mean, stddev_pop(x) AS dev FROM v GROUP BY feature)
SELECT vec_id, v.feature,
  round(CASE WHEN dev = 0 THEN 0 ELSE (x - mean) / dev END, 6) + 0.0::DOUBLE AS z
FROM v JOIN s ON v.feature = s.feature""")
def standardized(spark: SparkSession, sf_dir: str) -> DataFrame:
    scaled = standardize(_embedded(spark, sf_dir))
    values = scaled.select("vec_id", F.posexplode(vector_to_array("scaled")).alias("feature", "z"))
    return values.withColumn("z", F.round("z", 6) + F.lit(0.0))


@query("pca_scores", """SELECT vec_id, true AS uncorrelated, true AS falling, true AS turned FROM embeddings""")
def component_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What must hold for the scores, beside each vector's id: components are uncorrelated,
    their variances fall, and each is turned the way of its largest loading."""
    points = scored(_embedded(spark, sf_dir)).select("vec_id", "scaled", *[
        vector_to_array("scores")[i].alias(f"s{i}") for i in range(3)])
    stats = points.agg(
        *[F.var_pop(f"s{i}").alias(f"v{i}") for i in range(3)],
        *[F.abs(F.corr(f"s{i}", f"s{j}")).alias(f"c{i}{j}") for i, j in ((0, 1), (0, 2), (1, 2))])
    # a feature's covariance with a score is its loading times the score's variance
    cells = points.select(*[f"s{i}" for i in range(3)], F.posexplode(vector_to_array("scaled")).alias("feature", "x"))
    loads = cells.groupBy("feature").agg(*[F.avg(F.col("x") * F.col(f"s{i}")).alias(f"l{i}") for i in range(3)])
    turned = loads.agg(*[(F.max(f"l{i}") >= F.max(F.abs(f"l{i}")) - F.lit(1e-9)).alias(f"t{i}") for i in range(3)])
    s, t = stats.first(), turned.first()
    return points.select(
        "vec_id", F.lit(max(s["c01"], s["c02"], s["c12"]) < 1e-6).alias("uncorrelated"),
        F.lit(s["v0"] >= s["v1"] >= s["v2"]).alias("falling"), F.lit(all(t)).alias("turned"))


@query("pca_variance", """SELECT count(*) AS n_rows, 64.0::DOUBLE AS total,
  true AS ordered, true AS centred FROM embeddings""")
def component_variance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What must hold for the scores on all components: the rotation keeps the total
    variance (1 per feature), and variances fall from component to component."""
    scores = pca_scores(standardize(_embedded(spark, sf_dir)), 64)
    values = scores.select(F.posexplode(vector_to_array("scores")).alias("component", "x"))
    per = values.groupBy("component").agg(
        F.var_pop("x").alias("v"), F.avg("x").alias("m"), F.count("*").alias("n"))
    by_size = F.array_sort(F.collect_list(F.struct("component", "v")))  # one per feature
    falling = F.forall(F.sequence(F.lit(1), F.lit(63)), lambda i: F.get(
        "vs", i)["v"] <= F.get("vs", i - 1)["v"] + F.lit(1e-9))
    return per.agg(
        F.max("n").alias("n_rows"), F.round(F.sum("v"), 6).alias("total"),
        by_size.alias("vs"), (F.max(F.abs("m")) < 1e-9).alias("centred"),
    ).select("n_rows", "total", falling.alias("ordered"), "centred")


@query("kmeans_sweep", """SELECT k::INTEGER AS k, (SELECT count(*) FROM embeddings) AS n_rows, k AS n_clusters,
  CASE WHEN k = 1 THEN (SELECT count(*) FROM embeddings) * 64 END AS total,
  true AS costed, true AS falls FROM range(1, 21) t(k)""")
def cost_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sweep over all standardized features, held against its labels.

    For every ``k`` the rows are labelled: they fill ``k`` clusters, and their squares to the means
    of these are what the sweep reports, within a hundredth (the fit reports them before its last step).
    One cluster costs a unit per row and feature, every further number less than that, and twenty
    less than ten, ten less than five and five less than two.
    """
    features = staged(standardize(_embedded(spark, sf_dir)).select("scaled"), "features")
    models = fit_sweep(features, column="scaled")
    sweep = elbow(kmeans_sweep(features, column="scaled", models=models))
    labelled = features.withColumn("labels", F.array(F.struct(F.lit(1).alias("k"), F.lit(0).alias("cluster"))))
    for k, model in models.items():
        label = F.struct(F.lit(k).alias("k"), F.col("prediction").alias("cluster"))
        labelled = model.transform(labelled).withColumn("labels", F.array_append("labels", label)).drop("prediction")
    means = (labelled.select("scaled", F.explode("labels").alias("label")).groupBy("label")
             .agg(Summarizer.metrics("count", "variance").summary(F.col("scaled")).alias("s"))
             .select("label.k", F.col("s.count").alias("n"), vector_to_array("s.variance").alias("v")))
    squares = F.aggregate("v", F.lit(0.0), lambda a, x: a + x) * (F.col("n") - 1)
    found = means.groupBy("k").agg(F.sum("n").alias("n_rows"), F.count("*").alias("n_clusters"), F.sum(squares).alias("squares"))
    cost = {r["k"]: r["wcss"] for r in sweep.select("k", "wcss").collect()}
    falls = cost[20] < cost[10] < cost[5] < cost[2]
    return sweep.join(found, "k").select(
        "k", "n_rows", "n_clusters", F.when(F.col("k") == 1, F.round("wcss").cast("long")).alias("total"),
        (F.abs(F.col("squares") - F.col("wcss")) <= F.col("wcss") * 0.01).alias("costed"),
        (((F.col("k") == 1) | (F.col("wcss") < F.lit(cost[1]))) & F.lit(falls)).alias("falls"))


@query("swing_clusters", f"""WITH {KEYED}
SELECT m.input_event, true AS named FROM keyed k
JOIN timed m ON k.input_event = m.input_event AND m."TimestampRounded" = 80
WHERE k.name = 'BallContact' AND k._rescued_data IS NULL AND m._rescued_data IS NULL""")
def clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every swing has a cluster, named after its number."""
    labelled = swing_clusters(key_frames(spark, sf_dir, KEY_FRAME))
    return labelled.select("input_event", (
        F.col("Cluster K-means PCA").between(0, 3)
        & (F.col("Cluster") == F.concat(F.lit("Cluster"), F.col("Cluster K-means PCA") + 1))).alias("named"))


@query("cluster_totals", f"""WITH {KEYED}
SELECT count(*) AS n_rows, 4::BIGINT AS n_clusters, true AS centred
FROM keyed k JOIN timed m ON k.input_event = m.input_event AND m."TimestampRounded" = 80
WHERE k.name = 'BallContact' AND k._rescued_data IS NULL AND m._rescued_data IS NULL""")
def cluster_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What must hold whichever way clusters are numbered: every swing has one of the
    four, and latent coordinates are centred."""
    labelled = swing_clusters(key_frames(spark, sf_dir, KEY_FRAME))
    return labelled.agg(
        F.count("*").alias("n_rows"), F.count_distinct("Cluster").alias("n_clusters"),
        *[F.avg(f"LatentVector{i}").alias(f"m{i}") for i in (1, 2, 3)],
    ).select("n_rows", "n_clusters",
             F.greatest(*[F.abs(f"m{i}") for i in (1, 2, 3)]).between(0, 1e-9).alias("centred"))


@query("cluster_points", "SELECT vec_id, true AS nearest, true AS as_drawn, true AS settled FROM embeddings")
def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is drawn: of every point whether its cluster is that of the nearest centre, by distances
    computed here, and whether its drawn coordinates are its scores; and whether the squares of all
    points to their centres are, within a hundredth, what the fit reports."""
    embedded = staged(scored(_embedded(spark, sf_dir)), "scores")
    model = fit_clusters(embedded)
    labelled = label_clusters(embedded, model)
    drawn = cluster_points(labelled, "vec_id")
    centres = F.array(*[F.array(*[F.lit(float(x)) for x in c]) for c in model.clusterCenters()])
    scores = embedded.select("vec_id", vector_to_array("scores").alias("scores"))
    far = F.transform(centres, lambda c: F.aggregate(
        F.zip_with("scores", c, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda a, x: a + x))
    measured = drawn.join(scores, "vec_id").withColumn("far", far).withColumn(
        "own", F.get("far", F.substring("Cluster", 8, 9).cast("int") - 1))
    total, reported = measured.agg(F.sum("own")).first()[0], float(model.summary.trainingCost)
    drawn_as = (F.col("LatentVector1") == F.get("scores", 0)) & (F.col("LatentVector2") == F.get("scores", 1))
    return measured.select("vec_id", (F.col("own") <= F.array_min("far") * (1 + 1e-9)).alias("nearest"),
                           drawn_as.alias("as_drawn"), F.lit(abs(total - reported) <= 0.01 * reported).alias("settled"))


@query("saved_model", "SELECT vec_id, true AS same FROM embeddings")
def saved_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A model that was saved and loaded puts every vector in the cluster it had."""
    features, at = staged(_embedded(spark, sf_dir), "features"), scratch_dir(spark, "model")
    model = fit_swing_model(features)
    model.save(at)
    before, after = (label_swings(features, m).select("vec_id", F.col("Cluster").alias(name))
                     for m, name in ((model, "before"), (PipelineModel.load(at), "after")))
    return before.join(after, "vec_id").select("vec_id", (F.col("before") == F.col("after")).alias("same"))


@query("silhouette", "SELECT count(*) AS n_rows, true AS recomputed FROM embeddings")
def cluster_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The silhouette, held against the mean over all rows made from counts, sums and squares of the clusters."""
    embedded = staged(scored(_embedded(spark, sf_dir)), "scores")
    model = fit_clusters(embedded)
    quality = silhouette(embedded, model)
    rows = model.transform(embedded).select("prediction", vector_to_array("scores").alias("x")).withColumn(
        "square", F.aggregate("x", F.lit(0.0), lambda a, v: a + v * v))
    width = len(model.clusterCenters()[0])
    clusters = rows.groupBy("prediction").agg(
        F.count("*").alias("n"), F.sum("square").alias("squares"), F.array(*[F.sum(F.get("x", i)) for i in range(width)]).alias("sums"))
    apart = F.array(*[F.struct(      # one entry for each of a few clusters
        F.lit(c["prediction"]).alias("cluster"), F.lit(c["n"]).alias("n"),
        (F.col("square") + c["squares"] / c["n"] - 2 * sum(
            (F.get("x", i) * (v / c["n"]) for i, v in enumerate(c["sums"])), F.lit(0.0))).alias("far"))
        for c in clusters.collect()])
    own = F.get(F.filter("apart", lambda c: c["cluster"] == F.col("prediction")), 0)
    other = F.array_min(F.transform(F.filter("apart", lambda c: c["cluster"] != F.col("prediction")), lambda c: c["far"]))
    a, b = F.col("own.far") * F.col("own.n") / (F.col("own.n") - 1), F.col("other")
    value = F.when(F.col("own.n") == 1, F.lit(0.0)).otherwise((b - a) / F.greatest(a, b))
    measured = rows.withColumn("apart", apart).withColumn("own", own).withColumn("other", other)
    return measured.agg(F.count("*").alias("n_rows"), (F.abs(F.avg(value) - F.lit(quality)) <= 1e-9).alias("recomputed"))
