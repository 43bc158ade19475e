"""Train on one split, choose parameters by cross-validation, score the other splits."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from featloom.operators import model
from featloom.plans.feature_build import KEY, FeatureBuild, FeatureModel, MovieInputs, load_inputs
from featloom.session import materialize, owned_stages
from featloom.sources.readers import write_predictions


@dataclass(frozen=True)
class TrainedPlan:
    features: FeatureModel
    search: model.Search

    def score(self, inputs: MovieInputs, label: str | None = None) -> DataFrame:
        """(key, probability, prediction), one row per title."""
        return self.search.model.score(self.features.transform(inputs), KEY, label)

    def accuracy(self, inputs: MovieInputs, label: str = "label") -> float:
        scored = self.score(inputs, label)
        return model.accuracy(scored.dropna(subset=[label]), label, "prediction").first()["accuracy"]


def train(
    inputs: MovieInputs,
    build: FeatureBuild,
    model_type: str = "xgb",
    label: str = "label",
    trials: int = model.TRIALS,
    folds: int = model.FOLDS,
    **search,
) -> TrainedPlan:
    """Features, random search and refit. The feature table is written once for all fits."""
    fitted, table = build.fit_transform(inputs)
    ready = materialize(model.clean_label(table, label), "features")
    names = model.select_features(ready, label)
    found = model.tune(ready, names, model_type, label, KEY, trials, folds, **search)
    return TrainedPlan(fitted, found)


def run(
    spark: SparkSession,
    train_titles: str,
    splits: Mapping[str, str],
    output_dir: str,
    as_of_year: int,
    feature_method: str = "combined",
    model_type: str = "xgb",
    links: Mapping[str, str] | None = None,
    lexicon: DataFrame | None = None,
    build: FeatureBuild | None = None,
    **search,
) -> TrainedPlan:
    """From files to predictions.

    ``splits`` maps an output name to a CSV glob; each split gets its own folder
    below ``output_dir``. ``links`` names the optional files: ``directing_json``,
    ``writing_json``, ``movies_csv``, ``metadata_csv``, and ``links_layout`` of the two JSON files.
    """
    files = dict(links or {})
    build = build or FeatureBuild(as_of_year=as_of_year, feature_method=feature_method)
    plan = train(load_inputs(spark, train_titles, lexicon=lexicon, **files), build, model_type, **search)
    for name, pattern in splits.items():
        with owned_stages(spark):  # what scoring a split writes goes with it; the fitted tables stay with the plan
            scored = plan.score(load_inputs(spark, pattern, lexicon=lexicon, **files))
            write_predictions(scored, f"{output_dir.rstrip('/')}/{name}_predictions", KEY)
    return plan
