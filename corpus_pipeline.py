"""From raw documents to a training mixture: language, near-duplicates, benchmark passages, private data, mixing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from featloom.llm import decontaminate, language_id, mixing, pii, simhash
from featloom.llm.common import materialize, parted
from featloom.llm.queries import REGISTRY, query
from featloom.session import owned_stages, scratch_path

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


#: What tells rows apart without moving their texts; no mark is null, and documents without an id sort last.
MARKS = ["_none", "_id", "_text"]


def marked(docs: DataFrame) -> DataFrame:
    digest = F.sha2(F.coalesce("text", F.lit("")), 256)
    text = F.concat(F.when(F.col("text").isNull(), "0").otherwise("1"), digest)
    return docs.select(*COLUMNS, F.col("doc_id").isNull().alias("_none"), F.coalesce(F.col("doc_id").cast("long"), F.lit(0).cast("long")).alias("_id"), text.alias("_text"))


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents whose language can't be told: null texts and texts without a letter. Every other document stays as it is."""
    judged = language_id.predict(docs, language_id.fit(docs), into=("_lang", "_score"), keep=COLUMNS)
    return judged.where(F.col("_lang") != language_id.UNKNOWN).select(COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each SimHash group the document with the smallest id stays, and one of its rows if it is repeated.

    Fingerprints of 3-word shingles link at 3 or fewer differing bits, directly or over others. Documents
    without an id are compared as well; they go where their group has one with an id, else one of them stays.
    """
    rows = marked(docs)
    groups = simhash.near_duplicates(rows.select(F.struct(*MARKS).alias("mark"), "text"), "mark", "text")
    fate = groups.groupBy("mark").agg(F.count(F.lit(1)).alias("n"), F.first(F.col("mark") == F.col("component")).alias("stays"))
    fate = materialize(fate.where("n > 1 OR NOT stays").select("mark.*", "stays"), "fates")
    # Most documents are the only ones of their group; they are not in this table and stay where they are.
    touched, others = parted(rows, fate, MARKS)
    kept = touched.join(fate, MARKS, "left").where(F.coalesce("stays", F.lit(True))).dropDuplicates(MARKS)
    return others.select(COLUMNS).unionByName(kept.select(COLUMNS))


def remove_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a window of a benchmark item."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    rows = marked(docs)
    judged = decontaminate.contamination(rows, items, keep=tuple(MARKS))
    bad = materialize(judged.where("n_hit > 0").select(*MARKS).distinct(), "contaminated")
    touched, others = parted(rows, bad, MARKS)
    return others.select(COLUMNS).unionByName(touched.join(bad, MARKS, "left_anti").select(COLUMNS))


def redact_private_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace every span of personal data by its kind in brackets; ``n_chars`` is counted anew where a text changes."""
    found = pii.find(docs, keep=tuple(COLUMNS))
    spans = F.concat(pii.base_spans(), "added")
    out = found.withColumn("_spans", spans)
    changed = F.size("_spans") > 0
    out = out.withColumn("text", pii.redacted(F.col("text"), F.col("_spans")))
    return out.withColumn("n_chars", F.when(changed, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Draw the documents of the mixture, each with its raked weight and the probability it was drawn with."""
    drawn = mixing.sample(docs.select(COLUMNS))
    return drawn.where("sampled").select(*COLUMNS, "n_tokens", "topic", "weight", "probability")


STAGES = [
    ("language", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", remove_benchmarks),
    ("pii", redact_private_data),
    ("mixing", mix_sources),
]

#: Language prediction, fingerprints and span offsets have no SQL form; tests hold each stage against a plain version.
ORACLE_SQL = None


@query("pipeline", ORACLE_SQL)
def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``, each written and read again as the next one's input."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"stage-{name}")
        with owned_stages(spark):  # what the stage wrote for itself goes when its result is written
            stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs


__all__ = ["COLUMNS", "ORACLE_SQL", "REGISTRY", "STAGES", "run"]
