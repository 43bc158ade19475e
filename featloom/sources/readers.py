"""CSV, JSON and table readers, SQL views and the prediction sink."""

from __future__ import annotations

import csv
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from featloom.functions import columns as fc
from featloom.functions import text as ft

# Metadata columns coerced to numbers (junk and missing become 0) and normalised as text.
METADATA_NUMERIC = ("budget", "popularity", "revenue", "runtime", "vote_average", "vote_count")
METADATA_TEXT = ("original_title", "title", "overview", "tagline")

INDEX_COLUMNS = ("_c0", "Unnamed: 0")
HEADER_THREADS = 32


def read_csv(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: StructType | str | None = None,
    multi_line: bool = False,
    infer: bool = True,
    **options,
) -> DataFrame:
    """CSV files or globs with a header.

    With a ``schema`` (in file order) the files are read once; otherwise types
    are inferred by an extra pass, or kept as text with ``infer=False``. Large
    files are split unless ``multi_line`` is set for line breaks inside quotes.
    """
    opts = {"header": "true", "multiLine": str(multi_line).lower(), "quote": '"', "escape": '"', **options}
    reader = spark.read.options(**opts)
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", str(infer).lower())
    return reader.csv(list(path) if not isinstance(path, str) else path)


def union_by_name(frames: Sequence[DataFrame]) -> DataFrame:
    """Row-wise union by column name; a column missing in one part is NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def expand_glob(spark: SparkSession, pattern: str) -> list[str]:
    """Paths matching a Hadoop glob, sorted; an error when nothing matches."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(path)
    paths = sorted(status.getPath().toString() for status in (found or []))
    if not paths:
        raise FileNotFoundError(f"no files match {pattern}")
    return paths


def _header(spark: SparkSession, path: str) -> tuple[str, ...]:
    """Column names in the first line of one file, unpacked by the codec its name asks for; nothing else of it is read."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    target = jvm.org.apache.hadoop.fs.Path(path)
    store = target.getFileSystem(conf)
    if store.getFileStatus(target).isDirectory():
        return tuple(read_csv(spark, path, infer=False).columns)
    codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(target)
    stream = store.open(target)
    try:
        plain = codec.createInputStream(stream) if codec is not None else stream
        line = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(plain, "UTF-8")).readLine()
    finally:
        stream.close()
    names = next(csv.reader([line or ""]), [])
    return tuple(n if n else f"_c{i}" for i, n in enumerate(names))


def read_csv_shards(
    spark: SparkSession,
    pattern: str,
    schema: StructType | None = None,
    drop: Sequence[str] = INDEX_COLUMNS,
    **options,
) -> DataFrame:
    """All shards of a glob merged by column name, stray index columns dropped.

    Shards with the same header are read by one scan, so the union has one
    branch per distinct header, not per file. Headers are fetched many at a time;
    packed shards (``.csv.gz`` and the like) are unpacked. ``schema`` types
    columns by name; columns it does not name are read as text.
    """
    groups: dict[tuple[str, ...], list[str]] = {}
    paths = expand_glob(spark, pattern)
    with ThreadPoolExecutor(HEADER_THREADS) as pool:
        for path, names in zip(paths, pool.map(lambda p: _header(spark, p), paths)):
            groups.setdefault(names, []).append(path)
    frames = []
    for names, paths in groups.items():
        typed = None
        if schema is not None:
            known = {f.name: f for f in schema.fields}
            typed = StructType([known.get(n, StructField(n, StringType())) for n in names])
        frames.append(read_csv(spark, paths, typed, **options).drop(*drop))
    return union_by_name(frames)


def read_metadata(spark: SparkSession, path: str) -> DataFrame | None:
    """Metadata CSV, cleaned; None when there is no such file, so that callers can skip the merge."""
    try:
        raw = read_csv(spark, path, multi_line=True, infer=False)
    except AnalysisException as error:
        return _none_if_missing(error)
    return clean_metadata(raw)


def _none_if_missing(error: AnalysisException) -> None:
    if error.getCondition() != "PATH_NOT_FOUND":
        raise error


def clean_metadata(raw: DataFrame) -> DataFrame:
    numeric = {c: F.coalesce(fc.to_double(c), F.lit(0.0)) for c in METADATA_NUMERIC if c in raw.columns}
    text = {c: ft.normalize_text(c) for c in METADATA_TEXT if c in raw.columns}
    return raw.withColumns({**numeric, **text})


def read_catalogue(spark: SparkSession, path: str) -> DataFrame:
    """Catalogue CSV: year suffix removed from titles, titles and genres normalised."""
    return clean_catalogue(read_csv(spark, path, infer=False))


def clean_catalogue(raw: DataFrame, title: str = "title", genres: str = "genres") -> DataFrame:
    return raw.withColumns({
        title: ft.normalize_text(ft.strip_year_suffix(title)), genres: ft.normalize_text(genres)
    })


LAYOUTS = ("records", "array", "columns")


def read_links(
    spark: SparkSession, path: str, person: str, layout: str = "records", key: str = "movie", rename_to: str = "tconst"
) -> DataFrame | None:
    """(title, person) links from JSON; None when there is no such file, so that callers can skip the step.

    ``records``: one object per line, or lines that each hold an array of objects.
    ``array``: files that are one array over many lines.
    ``columns``: one object with a map from row label to value per column.
    A file in another layout than the one named fails when it is read.
    """
    if layout not in LAYOUTS:
        raise ValueError(f"unknown layout: {layout}")
    reader = spark.read.option("mode", "FAILFAST").option("multiLine", str(layout != "records").lower())
    try:
        if layout == "columns":
            shape = f"{key} map<string,string>, {person} map<string,string>"
            raw = explode_columns(reader.schema(shape).json(path), key, person)
        else:
            raw = reader.schema(f"{key} string, {person} string").json(path)
            wrong = F.col(key).rlike(r"^\s*\{")
            raw = raw.withColumn(key, F.when(wrong, F.raise_error(F.lit(f"{path} is not in layout {layout}"))).otherwise(F.col(key)))
    except AnalysisException as error:
        return _none_if_missing(error)
    return raw.withColumnRenamed(key, rename_to)


def explode_columns(raw: DataFrame, key: str, person: str) -> DataFrame:
    """Rows from column-oriented documents: the entries of both maps paired by their row label.

    Both maps of a table dump carry the same labels, so the sorted entries pair
    up by position; only documents whose labels differ are looked up one by one.
    """
    left, right = F.array_sort(F.map_entries(key)), F.array_sort(F.map_entries(person))
    labels = lambda entries: F.transform(entries, lambda e: e["key"])
    pair = lambda k, p: F.struct(k.alias(key), p.alias(person))
    pairs = F.when(
        labels(left) == labels(right), F.zip_with(left, right, lambda a, b: pair(a["value"], b["value"]))
    ).otherwise(F.transform(left, lambda a: pair(a["value"], F.col(person)[a["key"]])))
    return raw.select(F.explode(pairs).alias("_row")).select(f"_row.{key}", f"_row.{person}")


def register_views(frames: Mapping[str, DataFrame]) -> None:
    for name, frame in frames.items():
        frame.createOrReplaceTempView(name)


def run_sql(spark: SparkSession, statement: str, **frames: DataFrame) -> DataFrame:
    """A lazy SQL query over the given tables, referenced as ``{name}`` in the statement."""
    return spark.sql(statement, **frames)


def write_predictions(scored: DataFrame, path: str, key: str = "tconst", prediction: str = "prediction") -> None:
    """Predictions with their key; rows of a distributed table have no order to match them by."""
    scored.select(key, prediction).write.mode("errorifexists").csv(path, header=True)
