"""Feature selection, scaling, PCA, folds, training, tuning and scoring."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml import Estimator, Model, PipelineModel
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.feature import PCA, ElementwiseProduct, StandardScaler, StandardScalerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from featloom.functions import columns as fc
from featloom.operators.boosting import SecondOrderBooster, SecondOrderTrees
from featloom.operators.cleaning import first_per_key
from featloom.operators.network import Network, NeuralNetwork
from featloom.operators.search import search, space_of
from featloom.session import materialize

# Columns never used as features.
NON_FEATURES = (
    "label", "primaryTitle", "title_for_tfidf", "title_for_emb", "tconst", "director", "writer", "genres", "title",
    "overview", "tagline", "belongs_to_collection", "homepage", "imdb_id", "original_language", "poster_path",
    "production_companies", "production_countries", "spoken_languages", "status", "video", "id", "adult",
)

# Search ranges (low, high), or the choices of a layout.
FOREST_RANGES = {"n_trees": (50, 500), "depth": (4, 20), "min_split": (2, 20), "min_leaf": (1, 10)}
BOOST_RANGES = {"n_trees": (50, 500), "step": (0.01, 0.3), "depth": (3, 10), "subsample": (0.5, 1.0)}
SECOND_ORDER_RANGES = {
    "n_trees": (100, 1000), "step": (0.01, 0.3), "depth": (3, 10), "subsample": (0.5, 1.0), "columns": (0.5, 1.0),
    "reg_alpha": (0.0, 1.0), "reg_lambda": (0.0, 1.0),
}
NETWORK_RANGES = {
    "hidden": ((64,), (128,), (64, 32), (128, 64)), "activation": ("relu", "tanh", "logistic"),
    "alpha": (1e-5, 1e-2, "log"), "rate": (1e-4, 1e-2, "log"), "max_iter": (200, 500),
}
# Vector columns that are scaled without centring, so that they stay sparse.
SPARSE_FAMILIES = ("tfidf_vec",)
SEED = 42
TRIALS = 20
FOLDS = 5
SLICES = 256


# --- labels and features ---------------------------------------------------


def clean_label(df: DataFrame, label: str = "label") -> DataFrame:
    """Rows with a label, the label as boolean."""
    if label not in df.columns:
        raise ValueError(f"no label column: {label}")
    return df.dropna(subset=[label]).withColumn(label, F.col(label).cast("boolean"))


def select_features(df: DataFrame, label: str = "label", exclude: Sequence[str] = NON_FEATURES) -> list[str]:
    """Numeric, boolean and vector columns, without the excluded ones."""
    skip = {*exclude, label}
    numeric = set(fc.numeric_columns(df, skip))
    return [f.name for f in df.schema.fields if f.name in numeric or (f.name not in skip and _is_vector(df, f.name))]


def _is_vector(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, VectorUDT)


def _feature(df: DataFrame, column: str) -> Column:
    """The column as model input: vectors as they are, numbers as double, missing (or absent) ones as 0."""
    if column not in df.columns:
        return F.lit(0.0)
    return F.col(column) if _is_vector(df, column) else F.coalesce(F.col(column).cast("double"), F.lit(0.0))


def assemble(df: DataFrame, features: Sequence[str], out: str = "features") -> DataFrame:
    """One vector per row; missing values count as 0."""
    inputs = {f"_in_{i}": _feature(df, f) for i, f in enumerate(features)}
    assembler = VectorAssembler(inputCols=list(inputs), outputCol=out)
    return assembler.transform(df.withColumns(inputs)).drop(*inputs)


@dataclass(frozen=True)
class ColumnScaler:
    """Centre and population deviation per column, from the training rows."""

    centre: dict[str, float]
    spread: dict[str, float]

    def transform(self, df: DataFrame) -> DataFrame:
        def scaled(c: str) -> Column:
            value = F.coalesce(F.col(c).cast("double"), F.lit(0.0)) - F.lit(self.centre[c])
            return value / F.lit(self.spread[c] or 1.0)

        return df.withColumns({c: scaled(c) for c in self.centre})


def fit_column_scaler(df: DataFrame, columns: Sequence[str]) -> ColumnScaler:
    filled = {c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in columns}
    row = df.agg(
        *[F.avg(e).alias(f"m_{c}") for c, e in filled.items()],
        *[F.stddev_pop(e).alias(f"s_{c}") for c, e in filled.items()],
    ).first()
    return ColumnScaler({c: row[f"m_{c}"] or 0.0 for c in columns}, {c: row[f"s_{c}"] or 0.0 for c in columns})


def fit_vector_scaler(df: DataFrame, column: str, out: str, centre: bool = True) -> PipelineModel:
    """Vector form of the same scaling: the built-in sample deviation, corrected to the population one.

    Without ``centre`` only the deviation is scaled, so that sparse vectors stay sparse.
    """
    scaler = StandardScaler(inputCol=column, outputCol=f"_{out}", withMean=centre, withStd=True).fit(df)
    n = df.count()
    factor = math.sqrt(n / (n - 1)) if n > 1 else 1.0
    correct = ElementwiseProduct(
        scalingVec=Vectors.dense([factor] * len(scaler.mean)), inputCol=f"_{out}", outputCol=out
    )
    return PipelineModel([scaler, correct])


@dataclass(frozen=True)
class CentredPCA:
    out: str
    model: PipelineModel

    def transform(self, df: DataFrame) -> DataFrame:
        return self.model.transform(df).drop(f"_{self.out}")


def fit_pca(df: DataFrame, column: str, out: str, k: int) -> CentredPCA:
    """Principal components of centred vectors; ``k`` is lowered to the vector size where needed.

    The covariance of d features (d x d numbers) is solved on the driver, so
    the vector size, not the row count, bounds the memory.
    """
    centre = StandardScaler(inputCol=column, outputCol=f"_{out}", withMean=True, withStd=False).fit(df)
    k = min(k, len(centre.mean))
    pca = PCA(k=k, inputCol=f"_{out}", outputCol=out).fit(centre.transform(df))
    return CentredPCA(out, PipelineModel([centre, pca]))


def apply_pca_columns(df: DataFrame, prefix: str, n_components: int = 50) -> DataFrame:
    """PCA over all columns whose name starts with ``prefix``; components replace them as ``{prefix}pca_{i}``."""
    family = [c for c in df.columns if c.startswith(prefix)]
    if not family:
        return df
    vectors = assemble(df, family, "_family")
    fitted = fit_pca(vectors, "_family", "_components", n_components)
    k = min(n_components, len(family))
    parts = vector_to_array("_components")
    return fitted.transform(vectors).select(
        *[c for c in df.columns if c not in set(family)], *[parts[i].alias(f"{prefix}pca_{i}") for i in range(k)]
    )


def combine_vectors(df: DataFrame, columns: Sequence[str], out: str) -> DataFrame:
    return VectorAssembler(inputCols=list(columns), outputCol=out, handleInvalid="keep").transform(df)


# --- folds and metrics -----------------------------------------------------


def stratified_folds(
    df: DataFrame,
    key: str,
    label: str,
    folds: int = FOLDS,
    seed: int = SEED,
    out: str = "fold",
    slices: int = SLICES,
) -> DataFrame:
    """Shuffled folds of labelled rows whose sizes differ by at most one row per label.

    Rows are numbered in the order of a keyed hash. Numbering a whole label would
    put it in one task, so the hash range is cut into ``slices``: rows are numbered
    within their slice, and the slice's offset (a prefix sum over labels x slices
    counts) continues the numbering. The result does not depend on the number of slices.
    """
    hashed = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string")))
    cut = F.floor(F.conv(F.substring("_hash", 1, 8), 16, 10).cast("bigint") / 2.0**32 * slices).cast("bigint")
    keyed = df.where(F.col(label).isNotNull()).withColumn("_hash", hashed).withColumn("_slice", cut)
    rank = F.row_number().over(Window.partitionBy(label, "_slice").orderBy("_hash", key)) - 1
    counts = keyed.groupBy(label, "_slice").agg(F.count("*").alias("_n"))
    earlier = Window.partitionBy(label).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = materialize(counts.select(label, "_slice", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_offset")), "fold-offsets")
    numbered = keyed.join(offsets, [label, "_slice"]).withColumn("_rank", rank + F.col("_offset"))
    return numbered.select(*df.columns, (F.col("_rank") % folds).cast("int").alias(out))


def accuracy(df: DataFrame, label: str, prediction: str) -> DataFrame:
    return df.agg(F.avg((F.col(prediction) == F.col(label)).cast("double")).alias("accuracy"))


def threshold(probability: Column, limit: float = 0.5) -> Column:
    """Strictly above the limit."""
    return probability > F.lit(limit)


def positive_probability(column: str = "probability") -> Column:
    return vector_to_array(column)[1]


# --- classifiers -----------------------------------------------------------


def random_forest(n_trees: int = 100, depth: int = 10, min_leaf: int = 1, min_split: int = 2, seed: int = SEED) -> RandomForestClassifier:
    """No node of fewer than ``min_split`` rows is split: each side must hold half of them, or ``min_leaf`` rows."""
    return RandomForestClassifier(
        numTrees=n_trees, maxDepth=depth, minInstancesPerNode=max(min_leaf, -(-min_split // 2)), seed=seed, labelCol="_y", featuresCol="features"
    )


def boosted_trees(
    n_trees: int = 50, step: float = 0.1, depth: int = 5, subsample: float = 1.0, columns: float | None = None, seed: int = SEED
) -> GBTClassifier:
    """Gradient-boosted trees; ``columns`` samples a share of the features per split."""
    return GBTClassifier(
        maxIter=n_trees, stepSize=step, maxDepth=depth, subsamplingRate=subsample,
        featureSubsetStrategy="all" if columns is None else str(columns), seed=seed, labelCol="_y", featuresCol="features",
    )


@dataclass(frozen=True)
class ScoringModel:
    """Fitted features, scaling and classifier, with the column contract for new rows."""

    features: tuple[str, ...]
    scaler: PipelineModel
    classifier: Model | SecondOrderTrees | Network

    def prepare(self, df: DataFrame, key: str, label: str | None = None, order: Sequence[str] = ()) -> DataFrame:
        """One row per key with scaled features and, where present, the label."""
        keyed = df if key in df.columns else df.withColumn(key, F.monotonically_increasing_id())
        keep = [c for c in (label,) if c and c in keyed.columns]
        used = [c for c in self.features if c in keyed.columns and c != key]
        extra = [o for o in order if o not in {key, *keep, *used}]
        # The label is the last tie-breaker: which duplicate stays must not follow from it.
        one = first_per_key(keyed.select(key, *used, *extra, *keep), [key], order)
        labels = [F.col(c).cast("boolean").alias(c) for c in keep]
        vectors = _family_vectors(one, self.features)
        vectors = vectors.select(key, *labels, *[c for c in ("_raw", "_sparse") if c in vectors.columns])
        return self.scaler.transform(vectors).select(key, *keep, "features")

    def score(self, df: DataFrame, key: str, label: str | None = None, order: Sequence[str] = ()) -> DataFrame:
        """(key, probability, prediction) with one row per key."""
        scored = self.classifier.transform(self.prepare(df, key, label, order))
        p = positive_probability()
        keep = [c for c in (label,) if c and c in scored.columns]
        return scored.select(key, *keep, p.alias("probability"), threshold(p).alias("prediction"))


def training_vectors(df: DataFrame, features: Sequence[str], label: str) -> tuple[DataFrame, PipelineModel]:
    """Scaled feature vectors and the fitted scaler for labelled rows."""
    vectors = _family_vectors(clean_label(df, label), features).withColumn("_y", F.col(label).cast("double"))
    if "_sparse" not in vectors.columns:
        scaler = fit_vector_scaler(vectors, "_raw", "features")
    else:
        families = [c for c in ("_raw", "_sparse") if c in vectors.columns]
        scalers = [fit_vector_scaler(vectors, c, f"{c}_scaled", centre=c == "_raw") for c in families]
        joined = VectorAssembler(inputCols=[f"{c}_scaled" for c in families], outputCol="features")
        scaler = PipelineModel([*[s for m in scalers for s in m.stages], joined])
    return scaler.transform(vectors), scaler


def _family_vectors(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """``_raw`` of the dense features and, where there are any, ``_sparse`` of those that are never centred."""
    sparse = [f for f in features if f in SPARSE_FAMILIES]
    dense = [f for f in features if f not in SPARSE_FAMILIES]
    out = assemble(df, dense, "_raw") if dense or not sparse else df
    return assemble(out, sparse, "_sparse") if sparse else out


def vector_size(scaler: PipelineModel) -> int:
    """Width of the assembled vector: a vector column counts with all its numbers."""
    return sum(len(s.std) for s in scaler.stages if isinstance(s, StandardScalerModel))


Classifier = Estimator | SecondOrderBooster | NeuralNetwork


def train(df: DataFrame, features: Sequence[str], classifier: Classifier, label: str = "label") -> ScoringModel:
    ready, scaler = training_vectors(df, features, label)
    return ScoringModel(tuple(features), scaler, classifier.fit(ready.select("features", "_y")))


# --- search ----------------------------------------------------------------


def classifier_of(model_type: str, inputs: int, params: Mapping, seed: int = SEED) -> Classifier:
    """A classifier of a type: ``rf``, ``xgb`` (second order), ``gb`` or ``nn``."""
    builders = {
        "rf": random_forest, "gb": boosted_trees, "xgb": SecondOrderBooster,
        "nn": lambda hidden=(64,), **more: NeuralNetwork(inputs, tuple(hidden), **more),
    }
    return builders[model_type](**params, seed=seed)


@dataclass(frozen=True)
class Search:
    model: ScoringModel
    scores: tuple[float, ...]
    best: dict


def tune(
    df: DataFrame,
    features: Sequence[str],
    model_type: str = "xgb",
    label: str = "label",
    key: str = "tconst",
    trials: int = TRIALS,
    folds: int = FOLDS,
    seed: int = SEED,
    parallelism: int = 4,
    ranges: dict | None = None,
) -> Search:
    """Model-based search by mean accuracy over stratified folds, the best parameters refitted on all rows.

    Scaled vectors and folds are written once for all trials. Densities of the
    trials so far propose the next ones (``search``); the trials of a round run
    as concurrent Spark jobs. ``ranges`` replaces search ranges by name.
    """
    spaces = {"rf": FOREST_RANGES, "xgb": SECOND_ORDER_RANGES, "gb": BOOST_RANGES, "nn": NETWORK_RANGES}
    if model_type not in spaces:
        raise ValueError(f"unsupported model type: {model_type}")
    ready, scaler = training_vectors(df, features, label)
    folded = materialize(
        stratified_folds(ready.select(key, label, "features", "_y"), key, label, folds, seed).select("features", "_y", "fold"), "folds"
    )
    inputs = vector_size(scaler)

    def score(params: dict) -> float:
        classifier = classifier_of(model_type, inputs, params, seed)
        found = []
        for fold in range(folds):
            scored = classifier.fit(folded.where(F.col("fold") != fold)).transform(folded.where(F.col("fold") == fold))
            right = (threshold(positive_probability()) == (F.col("_y") > 0.5)).cast("double")
            found.append(scored.agg(F.avg(right)).first()[0])
        found = [f for f in found if f is not None]  # a fold without rows tells nothing
        return sum(found) / len(found) if found else 0.0

    done = search(space_of({**spaces[model_type], **(ranges or {})}), score, trials, seed, parallelism)
    best = max(done, key=lambda t: t[1])[0]
    fitted = classifier_of(model_type, inputs, best, seed).fit(folded)
    return Search(ScoringModel(tuple(features), scaler, fitted), tuple(s for _, s in done), best)
