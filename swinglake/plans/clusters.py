"""Swings grouped by similarity, from the key-frame table to cluster names."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame

from swinglake.operators.swings import (
    CLUSTERS, COMPONENTS, KEY_FRAME, SEED, fit_clusters, fit_components, fit_scaler,
    label_clusters, pca_scores, standardize, swing_features,
)
from swinglake.session import staged


def scored(features: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """Standardized features and their principal component scores.

    Scaling, components and clustering pass over the features dozens of times, and
    behind the features is the join that made the key frames; so they are staged.
    """
    return pca_scores(standardize(staged(features, "features")), components)


def fit_swing_model(features: DataFrame, components: int = COMPONENTS, k: int = CLUSTERS,
                    seed: int = SEED) -> PipelineModel:
    """Scaling, components and clusters of ``features`` as one model.  It can be saved, and
    puts swings that come later in the same space and the same clusters."""
    scaler = fit_scaler(features)
    scaled = scaler.transform(features)
    space = fit_components(scaled, components)
    return PipelineModel([scaler, space, fit_clusters(space.transform(scaled), k, seed=seed)])


def label_swings(features: DataFrame, model: PipelineModel) -> DataFrame:
    """Features with their place and cluster in a fitted model."""
    *space, clusters = model.stages
    return label_clusters(PipelineModel(space).transform(features), clusters)


def swing_clusters(key_frames: DataFrame, key_frame: str = KEY_FRAME, k: int = CLUSTERS,
                   seed: int = SEED) -> DataFrame:
    features = staged(swing_features(key_frames, key_frame), "features")
    return label_swings(features, fit_swing_model(features, k=k, seed=seed))
