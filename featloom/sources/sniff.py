"""CSV files whose dialect and types are found from the files themselves."""

from __future__ import annotations

import csv
import io
import re
from collections import Counter
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from featloom.sources.readers import HEADER_THREADS, INDEX_COLUMNS, expand_glob, read_csv, union_by_name

DELIMITERS = (",", ";", "\t", "|")
QUOTES = ('"', "'")
SAMPLE = 1 << 16  # bytes of a file that its dialect is judged by
#: Words that stand for a missing value.
MISSING = ("", "NULL", "null", "NA", "NaN", "nan", "\\N")
#: What a type's text looks like; a column has the first type that all its values fit.
SHAPES = (
    ("boolean", r"(?i)^(true|false)$"),
    ("bigint", r"^[+-]?\d{1,18}$"),
    ("double", r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"),
    ("date", r"^\d{4}-\d{2}-\d{2}$"),
    ("timestamp", r"^\d{4}-\d{2}-\d{2}[ T]\d{2}:\d{2}(:\d{2}(\.\d+)?)?$"),
)
NAMES = [kind for kind, _ in SHAPES]
#: The least type that holds the values of two types; others meet as text.
WIDER = {("bigint", "double"): "double", ("date", "timestamp"): "timestamp"}


@dataclass(frozen=True)
class Dialect:
    delimiter: str
    quote: str
    header: bool
    columns: tuple[str, ...]


def _kind(cell: str) -> str | None:
    return next((kind for kind, shape in SHAPES if re.match(shape, cell.strip())), None)


def _rows(sample: str, delimiter: str, quote: str) -> list[list[str]]:
    return [row for row in csv.reader(io.StringIO(sample), delimiter=delimiter, quotechar=quote) if row]


def _consistency(rows: list[list[str]], sample: str, delimiter: str, quote: str) -> tuple:
    """How well a dialect explains a sample: the share of rows of the usual width, then how many columns and typed cells it makes."""
    if not rows:
        return (0.0, 0, 0.0, 0)
    width, same = Counter(map(len, rows)).most_common(1)[0]
    cells = [c for row in rows if len(row) == width for c in row]
    typed = sum(_kind(c) is not None for c in cells) / max(len(cells), 1)
    # A quote that opens and closes fields; one that stays inside them is text.
    edges = len(re.findall(rf"(?:^|{re.escape(delimiter)}){re.escape(quote)}|{re.escape(quote)}(?:{re.escape(delimiter)}|$)", sample, re.M))
    inside = sum(c.count(quote) for c in cells)
    return (width > 1, same / len(rows), typed, edges - 3 * inside, width)


def sniff(sample: str, whole: bool = True) -> Dialect:
    """The dialect of a sample; the last line is left out where the sample ends inside the file.

    Every delimiter and quote is tried. The one wins that makes more than one
    column, rows of equal width, and cells of a known type. The first row is a
    header where its cells are different names, none empty but a leading index's,
    none of a type, and some column below has a type or none of its values again.
    A file of one line is a header. An empty file has no columns.
    """
    sample = sample.removeprefix("\ufeff")
    if not whole and "\n" in sample:
        sample = sample[: sample.rindex("\n")]
    tried = {(d, q): _rows(sample, d, q) for d in DELIMITERS for q in QUOTES}
    best = max(tried, key=lambda k: (_consistency(tried[k], sample, *k), -DELIMITERS.index(k[0]), -QUOTES.index(k[1])))
    rows = tried[best]
    if not rows:
        return Dialect(*best, True, ())
    first, rest = [c.strip() for c in rows[0]], rows[1:]
    names = all(_kind(c) is None for c in first) and all(first[1:]) and len(set(first)) == len(first)
    below = [[row[i].strip() for row in rest if len(row) > i] for i in range(len(first))]
    apart = any(any(_kind(c) is not None for c in column) or first[i] not in column for i, column in enumerate(below))
    header = bool(names and (not rest or apart))
    columns = tuple(c or f"_c{i}" for i, c in enumerate(first)) if header else tuple(f"column{i}" for i in range(len(first)))
    return Dialect(*best, header, columns)


def _sample(spark: SparkSession, path: str) -> tuple[str, bool]:
    """The first ``SAMPLE`` bytes of a file, unpacked by the codec its name asks for, and whether that is all of it."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    target = jvm.org.apache.hadoop.fs.Path(path)
    codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(target)
    stream = target.getFileSystem(conf).open(target)
    try:
        plain = codec.createInputStream(stream) if codec is not None else stream
        data = bytes(plain.readNBytes(SAMPLE + 1))
    finally:
        stream.close()
    return data[:SAMPLE].decode("utf-8", "ignore"), len(data) <= SAMPLE


def merge(kinds: Sequence[str | None]) -> str:
    """The least type that holds values of all the given ones; text where there is none, or no value at all."""
    held = sorted({k for k in kinds if k is not None}, key=[*NAMES, "string"].index)
    if not held:
        return "string"
    out = held[0]
    for k in held[1:]:
        out = WIDER.get((out, k), "string")
    return out


def _fits(value: Column) -> Column:
    """The first type whose shape, and whose values, a text fits; null for a missing value."""
    text = F.trim(value)
    fits = F.when(text.isin(*MISSING) | value.isNull(), F.lit(None))
    for kind, shape in SHAPES:
        fits = fits.when(text.rlike(shape) & text.try_cast(kind).isNotNull(), kind)
    return fits.otherwise("string")


def infer_types(df: DataFrame) -> dict[str, str]:
    """The type of every text column by all its values: the types seen are counted in one pass, a few names a column reach the driver."""
    if not df.columns:
        return {}
    row = df.agg(*[F.collect_set(_fits(F.col(f"`{c}`"))).alias(f"_{i}") for i, c in enumerate(df.columns)]).first()
    return {c: merge(row[f"_{i}"]) for i, c in enumerate(df.columns)}


def typed(df: DataFrame, kinds: dict[str, str]) -> DataFrame:
    """``df`` with its text columns as the given types; missing values are null, also in text."""

    def cell(c: str) -> Column:
        value = F.col(f"`{c}`")
        text = F.trim(value)
        return F.when(~text.isin(*MISSING), (value if kinds[c] == "string" else text.cast(kinds[c]))).alias(c)

    return df.select(*[cell(c) for c in df.columns])


def read_csv_sniffed(spark: SparkSession, pattern: str, drop: Sequence[str] = INDEX_COLUMNS) -> DataFrame:
    """All files of a glob, each in its own dialect, merged by column name, with types that hold all their values.

    A bounded sample of every file tells delimiter, quote and header. Files of the
    same dialect and columns are one scan. Files without a header have the names
    of the others of their width, where these agree, else ``column0``, ``column1``, ...
    Types come from all values of all files, not from the samples; a column whose
    types do not meet is text. Empty files have no rows.
    """
    paths = expand_glob(spark, pattern)
    with ThreadPoolExecutor(HEADER_THREADS) as pool:
        found = dict(zip(paths, pool.map(lambda p: sniff(*_sample(spark, p)), paths)))
    named = {len(d.columns): {e.columns for e in found.values() if e.header and len(e.columns) == len(d.columns)} for d in found.values()}
    groups: dict[Dialect, list[str]] = {}
    for path, d in found.items():
        if not d.columns:
            continue
        known = named[len(d.columns)]
        columns = next(iter(known)) if not d.header and len(known) == 1 else d.columns
        groups.setdefault(Dialect(d.delimiter, d.quote, d.header, columns), []).append(path)
    frames = []
    for d, mine in groups.items():
        schema = T.StructType([T.StructField(c, T.StringType()) for c in d.columns])
        options = {"sep": d.delimiter, "quote": d.quote, "escape": d.quote, "header": str(d.header).lower(), "enforceSchema": "true"}
        frames.append(read_csv(spark, mine, schema, **options).drop(*drop))
    if not frames:
        raise ValueError(f"no columns in {pattern}")
    text = union_by_name(frames)
    return typed(text, infer_types(text))


__all__ = ["Dialect", "infer_types", "merge", "read_csv_sniffed", "sniff", "typed"]
