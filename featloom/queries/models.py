"""Folds, metrics, training, tuning and scoring."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from featloom.functions import text as ft
from featloom.operators import model as op
from featloom.operators.network import shaped, start
from featloom.queries.registry import NUMBERS, Tables, query, r
from featloom.session import materialize, scratch_path
from featloom.sources.readers import read_csv, write_predictions

DOC_FEATURES = ("chars", "blanks", "words", "lines", "digits", "capitals", "punctuation", "non_ascii", "distinct_share")


def document_features(t: Tables):
    """Numeric features of every labelled text, with the quality label."""
    text = F.col("text")
    n = F.greatest(F.length(text), F.lit(1))
    tokens = ft.words(text, r"[\p{L}\p{N}_]+")
    count = lambda pattern: F.regexp_count(text, F.lit(pattern)) / n
    return t.documents.join(t.labels, "doc_id").select(
        F.col("doc_id").alias("tconst"), F.col("quality").alias("label"), n.alias("chars"), count(" ").alias("blanks"),
        F.size(tokens).alias("words"), count("\n").alias("lines"), count("[0-9]").alias("digits"),
        count(r"\p{Lu}").alias("capitals"), count(r"\p{P}").alias("punctuation"), count(r"[^\x00-\x7F]").alias("non_ascii"),
        (F.size(F.array_distinct(tokens)) / F.greatest(F.size(tokens), F.lit(1))).alias("distinct_share"),
    )


def training_table(t: Tables):
    """Features written once: training passes over them many times."""
    return materialize(document_features(t), "training")


@query("label_clean", "SELECT doc_id, CAST(nullif(quality, 0) AS BOOLEAN) AS label FROM labels WHERE nullif(quality, 0) IS NOT NULL")
def label_clean(t: Tables):
    return op.clean_label(t.labels.select("doc_id", F.nullif("quality", F.lit(0)).alias("label")))


FOLD_SQL = """SELECT tconst, label, CAST((row_number() OVER (PARTITION BY label ORDER BY md5('42:' || tconst), tconst) - 1) % 5 AS INTEGER) AS fold
    FROM {src}"""


@query("stratified_folds", FOLD_SQL.format(src=NUMBERS))
def stratified_folds(t: Tables):
    return op.stratified_folds(t.numbers.select("tconst", "label"), "tconst", "label", slices=64)


@query("accuracy", f"SELECT round(avg((label = (numVotes > 250000))::INTEGER), 6) AS accuracy FROM {NUMBERS}")
def accuracy(t: Tables):
    predicted = t.numbers.withColumn("prediction", F.col("numVotes") > 250000)
    return op.accuracy(predicted, "label", "prediction").select(r("accuracy").alias("accuracy"))


@query("threshold", "SELECT event_id, value / (value + 10) > 0.5 AS prediction FROM events")
def threshold(t: Tables):
    p = F.col("value") / (F.col("value") + 10)
    return t.events.select("event_id", op.threshold(p).alias("prediction"))


SCORED_SQL = """SELECT d.doc_id AS tconst, CAST(quality AS BOOLEAN) AS label, true AS in_range, true AS consistent, true AS beats_majority
    FROM documents d JOIN labels l ON d.doc_id = l.doc_id"""


def checks():
    return [F.col("probability").between(0, 1).alias("in_range"), (F.col("prediction") == (F.col("probability") > 0.5)).alias("consistent")]


def _fit(t: Tables, classifier):
    """Every labelled text with what must hold for its score, and for the accuracy over all of them."""
    rows = training_table(t)
    fitted = op.train(rows, op.select_features(rows), classifier)
    scored = materialize(fitted.score(rows, "tconst", "label"), "scored")
    share = F.avg(F.col("label").cast("int"))
    row = scored.agg(F.avg((F.col("prediction") == F.col("label")).cast("int")).alias("a"), F.greatest(share, 1 - share).alias("m")).first()
    return scored.select("tconst", "label", *checks(), F.lit(row["a"] is not None and row["a"] >= row["m"]).alias("beats_majority"))


@query("train_rf", SCORED_SQL)
def train_rf(t: Tables):
    return _fit(t, op.random_forest(n_trees=20, depth=5))


@query("train_gbt", SCORED_SQL)
def train_gbt(t: Tables):
    return _fit(t, op.boosted_trees(n_trees=10, step=0.2, depth=3, subsample=0.8, columns=0.7))


@query("train_gb", SCORED_SQL)
def train_gb(t: Tables):
    return _fit(t, op.boosted_trees(n_trees=10, step=0.2, depth=3, subsample=0.8))


@query("train_mlp", SCORED_SQL)
def train_mlp(t: Tables):
    return _fit(t, op.NeuralNetwork(len(DOC_FEATURES), (64, 32), rate=0.01, max_iter=30))


@query("tune_random", "SELECT CAST(range AS INTEGER) AS trial, true AS in_range, true AS beats_majority FROM range(20)")
def tune_random(t: Tables):
    """A search of 20 trials and 3 folds for small forests over all labelled rows; sizes are arguments."""
    rows = training_table(t)
    found = op.tune(
        rows, op.select_features(rows), "rf", folds=3, ranges={"n_trees": (5, 15), "depth": (3, 6)}
    )
    scores = [(i, float(s)) for i, s in enumerate(found.scores)]
    trials = rows.sparkSession.createDataFrame(scores, "trial int, mean_accuracy double")
    share = F.avg(F.col("label").cast("int"))
    row = found.model.score(rows, "tconst", "label").agg(
        F.avg((F.col("prediction") == F.col("label")).cast("int")).alias("a"), F.greatest(share, 1 - share).alias("m")
    ).first()
    return trials.select("trial", F.col("mean_accuracy").between(0, 1).alias("in_range"), F.lit(row["a"] >= row["m"]).alias("beats_majority"))


def _per_char(pattern: str) -> str:
    return f"len(regexp_extract_all(text, '{pattern}')) / length(text)"


DOC_SQL = rf"""(SELECT d.doc_id AS tconst, quality AS label, length(text)::DOUBLE AS chars, {_per_char(' ')} AS blanks,
    len(regexp_extract_all(text, '[\p{{L}}\p{{N}}_]+'))::DOUBLE AS words, {_per_char(chr(10))} AS lines,
    {_per_char('[0-9]')} AS digits FROM documents d JOIN labels l ON d.doc_id = l.doc_id)"""


@query(
    "prepare_eval",
    f"""WITH d AS {DOC_SQL} SELECT tconst, CAST(label AS BOOLEAN) AS label,
          {', '.join(f'round(({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER (), 4) AS {c}' for c in ('chars', 'blanks', 'words', 'lines'))},
          round((0 - avg(digits) OVER ()) / stddev_pop(digits) OVER (), 4) AS digits FROM d""",
)
def prepare_eval(t: Tables):
    """Evaluation rows twice over and without one feature: one row per key is kept, the feature counts as 0."""
    rows = training_table(t)
    features = op.select_features(rows)
    fitted = op.train(rows, features, op.random_forest(n_trees=5, depth=4))
    out = fitted.prepare(rows.unionByName(rows).drop("digits"), "tconst", "label", order=["chars"])
    v = vector_to_array("features")
    shown = ("chars", "blanks", "words", "lines", "digits")
    return out.select("tconst", "label", *[r(v[features.index(c)], 4).alias(c) for c in shown])


PLAIN_FEATURES = ("chars", "blanks", "words", "lines", "digits")
BOOSTER = op.SecondOrderBooster(n_trees=1, step=0.3, depth=3, reg_alpha=0.5, reg_lambda=1.0, bins=16)


def booster_sql(b: op.SecondOrderBooster) -> str:
    """The first tree by plain sums over bins, level by level: its splits and the weights of its leaves."""
    shrunk = lambda g: f"(sign({g}) * greatest(abs({g}) - {b.reg_alpha}, 0.0))"
    score = lambda g, h: f"({shrunk(g)} * {shrunk(g)} / ({h} + {b.reg_lambda}))"
    weight = lambda g, h: f"{b.step} * (-{shrunk(g)} / ({h} + {b.reg_lambda}))"
    parts = []
    for level in range(b.depth):
        n = f"n{level}"
        parts.append(f"""t{level} AS (SELECT node, sum(g) AS tg, sum(h) AS th FROM {n} GROUP BY node),
        s{level} AS (SELECT node, f, bin, sum(g) AS g, sum(h) AS h FROM {n} JOIN b USING (id) GROUP BY ALL),
        a{level} AS (SELECT node, f, bin, sum(g) AS g, sum(h) AS h FROM (SELECT * FROM s{level} UNION ALL
          SELECT node, f, any_value(zero), any_value(tg) - sum(g), any_value(th) - sum(h) FROM s{level} JOIN t{level} USING (node) JOIN e USING (f) GROUP BY node, f) GROUP BY ALL),
        c{level} AS (SELECT node, f, bin, sum(g) OVER w AS gl, sum(h) OVER w AS hl, tg, th, e[bin + 1] AS threshold
          FROM a{level} JOIN t{level} USING (node) JOIN e USING (f) WINDOW w AS (PARTITION BY node, f ORDER BY bin)),
        k{level} AS (SELECT *, ({score('gl', 'hl')} + {score('(tg - gl)', '(th - hl)')} - {score('tg', 'th')}) / 2 AS gain FROM c{level}
          WHERE hl >= {b.min_weight} AND th - hl >= {b.min_weight} AND threshold IS NOT NULL),
        best{level} AS (SELECT * FROM k{level} WHERE gain > 1e-12 QUALIFY row_number() OVER (PARTITION BY node ORDER BY gain DESC, f, bin) = 1),
        n{level + 1} AS (SELECT n.id, n.g, n.h, 2 * n.node + (v > threshold)::INT AS node FROM {n} n JOIN best{level} s ON n.node = s.node JOIN r ON r.id = n.id AND r.f = s.f)""")
    best = " UNION ALL ".join(f"SELECT * FROM best{level}" for level in range(b.depth))
    names = ", ".join(f"'{f}'" for f in PLAIN_FEATURES)
    grid = ", ".join(str(k / b.bins) for k in range(1, b.bins))
    return f"""WITH d AS {DOC_SQL}, r AS (SELECT tconst AS id, unnest(range({len(PLAIN_FEATURES)})) AS f, unnest([{', '.join(PLAIN_FEATURES)}]::DOUBLE[]) AS v FROM d),
        q AS (SELECT f, list_sort(list_distinct(list_append(quantile_disc(v, [{grid}]), 0.0))) AS e FROM r WHERE v <> 0 GROUP BY f),
        e AS (SELECT f, e, len(list_filter(e, lambda x: x < 0)) AS zero FROM q),
        b AS (SELECT id, f, len(list_filter(e, lambda x: x < v)) AS bin FROM r JOIN e USING (f) WHERE v <> 0),
        n0 AS (SELECT tconst AS id, 0.5::DOUBLE - label AS g, 0.25::DOUBLE AS h, 1 AS node FROM d),
        {', '.join(parts)},
        best AS ({best}),
        leaf AS (SELECT 2 * node AS node, gl AS g, hl AS h FROM best UNION ALL SELECT 2 * node + 1, tg - gl, th - hl FROM best)
        SELECT node::BIGINT AS node, [{names}][f + 1] AS feature, round(threshold, 6) AS threshold, round(gain, 6) AS gain, NULL::DOUBLE AS weight FROM best
        UNION ALL SELECT node::BIGINT, NULL, NULL, NULL, round({weight('g', 'h')}, 6) FROM leaf WHERE node NOT IN (SELECT node FROM best)"""


@query("train_xgb", booster_sql(BOOSTER))
def train_xgb(t: Tables):
    """The splits and leaves of the first tree over all labelled texts."""
    rows = training_table(t)
    ready = op.assemble(rows, PLAIN_FEATURES).withColumn("_y", F.col("label").cast("double"))
    [tree] = BOOSTER.fit(ready).trees
    found = [(s.node, PLAIN_FEATURES[s.feature], s.threshold, s.gain, None) for s in tree.splits] + [(n, None, None, None, w) for n, w in tree.weights]
    out = t.spark.createDataFrame(found, "node long, feature string, threshold double, gain double, weight double")
    return out.select("node", "feature", *[r(c).alias(c) for c in ("threshold", "gain", "weight")])


@query("train_xgb_scored", SCORED_SQL)
def train_xgb_scored(t: Tables):
    return _fit(t, op.SecondOrderBooster(n_trees=10, step=0.3, depth=3, subsample=0.8, columns=0.8, reg_alpha=0.1))


NETWORK = op.NeuralNetwork(len(PLAIN_FEATURES), (3,), activation="tanh", batches=1, validation=0.0)


def network_sql(n: op.NeuralNetwork) -> str:
    """Summed gradient of the network at its start, weight by weight in the order of the layers."""
    (w, b), (v, c) = shaped(start(n.sizes, n.activation, n.seed), n.sizes)
    number = lambda x: f"{float(x)!r}::DOUBLE"
    x = [f"x{i}" for i in range(n.inputs)]
    scaled = ", ".join(f"({f} - avg({f}) OVER ()) / stddev_pop({f}) OVER () AS {x[i]}" for i, f in enumerate(PLAIN_FEATURES))
    hidden = ", ".join("tanh(" + " + ".join([*(f"{x[i]} * {number(w[i, j])}" for i in range(n.inputs)), number(b[j])]) + f") AS a{j}" for j in range(3))
    top = " + ".join([*(f"a{j} * {number(v[j, 0])}" for j in range(3)), number(c[0])])
    back = [f"d * {number(v[j, 0])} * (1 - a{j} * a{j})" for j in range(3)]
    sums = [f"{x[i]} * {back[j]}" for i in range(n.inputs) for j in range(3)] + back + [f"d * a{j}" for j in range(3)] + ["d"]
    return f"""WITH d AS {DOC_SQL}, s AS (SELECT label, {scaled} FROM d), h AS (SELECT *, {hidden} FROM s),
        p AS (SELECT *, 1 / (1 + exp(-({top}))) - label AS d FROM h)
        SELECT CAST(unnest(range({len(sums)})) AS BIGINT) AS place, round(unnest([{', '.join(f'sum({e})' for e in sums)}]), 4) AS slope FROM p"""


@query("network_gradient", network_sql(NETWORK))
def network_gradient(t: Tables):
    """The gradient that all tasks add up for the first step of a small network."""
    rows = training_table(t).select("tconst", "label", *PLAIN_FEATURES)
    ready, _ = op.training_vectors(rows, PLAIN_FEATURES, "label")
    ready = ready.select(F.monotonically_increasing_id().alias("row"), "features", F.col("_y").alias("y"))
    slope, *_ = NETWORK.summed(materialize(ready, "network-rows"), start(NETWORK.sizes, NETWORK.activation, NETWORK.seed), 0, 0)
    out = t.spark.createDataFrame([(i, float(v)) for i, v in enumerate(slope)], "place long, slope double")
    return out.select("place", r("slope", 4).alias("slope"))


def _batch(t: Tables):
    rows = training_table(t)
    fitted = op.train(rows, op.select_features(rows), op.random_forest(n_trees=10, depth=5))
    return fitted.score(rows.drop("label", "lines"), "tconst")


@query("score_batch", "SELECT d.doc_id AS tconst, true AS in_range, true AS consistent FROM documents d JOIN labels l ON d.doc_id = l.doc_id")
def score_batch(t: Tables):
    """Scores of rows without a label and with one feature missing."""
    return _batch(t).select("tconst", *checks())


@query("score_write", "SELECT d.doc_id AS tconst, true AS same FROM documents d JOIN labels l ON d.doc_id = l.doc_id")
def score_write(t: Tables):
    """Predictions through the CSV sink and back: each key comes back with the prediction that was written."""
    path = scratch_path(t.spark, "predictions")
    scored = materialize(_batch(t), "scored")
    write_predictions(scored, path)
    back = read_csv(t.spark, path, "tconst bigint, prediction boolean")
    return back.join(scored.select("tconst", F.col("prediction").alias("written")), "tconst").select("tconst", (F.col("prediction") == F.col("written")).alias("same"))
