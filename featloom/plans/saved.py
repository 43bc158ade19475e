"""Save a trained plan, and load it in another session to score new titles."""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import fields, is_dataclass

import numpy as np
from pyspark.ml import Model, PipelineModel
from pyspark.sql import DataFrame, SparkSession

from featloom.operators import boosting, categories, cleaning, model, network, sparse
from featloom.operators import text_features as text
from featloom.plans import feature_build
from featloom.plans.train_score import TrainedPlan

#: What a plan may consist of, beside tables, fitted pipelines, numbers, names, tuples and mappings.
PARTS = {
    c.__name__: c
    for c in (
        TrainedPlan, feature_build.FeatureModel, feature_build.FeatureBuild, feature_build.Expertise, cleaning.FillModel, model.Search,
        model.ScoringModel, model.CentredPCA, sparse.Components, text.TfidfVectors, text.WordVectors, text.HashedEmbedding, text.TextComponents,
        categories.CategoryVectors, categories.CategoryComponents, boosting.SecondOrderTrees, boosting.Tree, boosting.Split, network.Network,
    )
}


def save(plan: TrainedPlan, path: str) -> None:
    """Write everything the plan needs below ``path``, which must not exist: tables as Parquet, fitted stages in their own format."""
    spark, count = SparkSession.active(), iter(range(1 << 30))

    def put(value):
        if is_dataclass(value):
            return {"part": type(value).__name__, "fields": {f.name: put(getattr(value, f.name)) for f in fields(value)}}
        if isinstance(value, DataFrame):
            value.write.parquet(f"{path}/tables/{(n := next(count))}")
            return {"table": n}
        if isinstance(value, Model):
            single = not isinstance(value, PipelineModel)
            (PipelineModel([value]) if single else value).write().save(f"{path}/stages/{(n := next(count))}")
            return {"stage": n, "single": single}
        if isinstance(value, np.ndarray):
            return {"array": value.tolist()}
        if isinstance(value, Mapping):
            return {"map": {k: put(v) for k, v in value.items()}}
        if isinstance(value, (tuple, list)):
            return {"items": [put(v) for v in value]}
        return value

    spark.createDataFrame([(json.dumps(put(plan)),)], "meta string").coalesce(1).write.text(f"{path}/meta")


def load(spark: SparkSession, path: str) -> TrainedPlan:
    """The plan that ``save`` wrote."""

    def get(value):
        if not isinstance(value, dict):
            return value
        if "part" in value:
            return PARTS[value["part"]](**{k: get(v) for k, v in value["fields"].items()})
        if "table" in value:
            return spark.read.parquet(f"{path}/tables/{value['table']}")
        if "stage" in value:
            held = PipelineModel.load(f"{path}/stages/{value['stage']}")
            return held.stages[0] if value["single"] else held
        if "array" in value:
            return np.array(value["array"])
        if "map" in value:
            return {k: get(v) for k, v in value["map"].items()}
        return tuple(get(v) for v in value["items"])

    return get(json.loads(spark.read.text(f"{path}/meta").first()[0]))
