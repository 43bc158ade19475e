"""Text features: TF-IDF, embeddings, lexicon sentiment, title flags."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import HashingTF, Normalizer, SQLTransformer, StopWordsRemover
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType, StructField, StructType
from pyspark.sql.window import Window

from featloom.functions import columns as fc
from featloom.functions import text as ft
from featloom.operators import coded, sparse, tiles
from featloom.session import materialize

# Fixed value: a term is a run of two or more letters, digits or underscores, in any script.
TERM_PATTERN = r"[\p{L}\p{N}_]{2,}"


def english_stop_words() -> list[str]:
    return StopWordsRemover.loadDefaultStopWords("english")


# --- simple title features -------------------------------------------------


def add_title_length(df: DataFrame, columns: Sequence[str] = ("title", "primaryTitle"), out: str = "title_length") -> DataFrame:
    """Characters of the first present title column, blanks not counted; table unchanged if there is none."""
    column = fc.first_column(df, columns)
    return df.withColumn(out, ft.length_without_blanks(column)) if column else df


def add_title_patterns(
    df: DataFrame,
    columns: Sequence[str] = ("title", "primaryTitle"),
    patterns: Sequence[str] = ft.TITLE_PATTERNS,
    prefix: str = "title_contains_",
) -> DataFrame:
    column = fc.first_column(df, columns)
    return df.withColumns({prefix + p: ft.contains_flag(column, p) for p in patterns}) if column else df


def combined_text(df: DataFrame, overview: str = "overview", tagline: str = "tagline", fallback: str = "primaryTitle") -> Column | None:
    """Overview and tagline joined by a blank, else either one, else the title; None without any."""
    if overview in df.columns and tagline in df.columns:
        return F.concat(F.coalesce(overview, F.lit("")), F.lit(" "), F.coalesce(tagline, F.lit("")))
    name = fc.first_column(df, (overview, tagline, fallback))
    return F.col(name) if name else None


def apply_fingerprint(df: DataFrame, column: str, sort: bool = False) -> DataFrame:
    return df.withColumn(f"{column}_fingerprint", ft.fingerprint(column, sort))


def apply_embedding_clean(df: DataFrame, column: str) -> DataFrame:
    return df.withColumn(f"{column}_embedding", ft.embedding_clean(column))


def _repeated_keys(df: DataFrame, key: str) -> DataFrame | None:
    """(_key) of the keys of two rows or more, null too, written; None without any."""
    counts = df.groupBy(F.col(key).alias("_key")).agg(F.count(F.lit(1)).alias("_n"))
    repeated = materialize(counts.where("_n > 1").select("_key"), "repeated-keys")
    return None if repeated.isEmpty() else repeated


# --- sentiment -------------------------------------------------------------


def lexicon_sentiment(
    df: DataFrame,
    key: str,
    text: Column | str,
    lexicon: DataFrame,
    word_pattern: str = r"[a-z]+",
) -> DataFrame:
    """(key, polarity, subjectivity): means over the words of each text found in ``lexicon``.

    ``lexicon`` has (word, polarity, subjectivity), one row per word. Texts
    without a known word get 0. Words are folded to lower-case ASCII first.
    A text's words are counted in its row; the frequent words of the lexicon (see
    ``_frequent``) are met where the texts are and leave one row of sums a text,
    only the others are moved by word.
    Write a derived lexicon with ``materialize`` first: it is read more than once.
    """
    folded = ft.ascii_fold(F.lower(F.col(text) if isinstance(text, str) else text))
    texts = materialize(df.select(key, ft.counted(ft.words(folded, word_pattern)).alias("_words")), "text-words")
    counted = texts.select(key, F.explode("_words").alias("_w")).select(key, "_w.word", "_w.n")
    known = sparse.join_known(counted, _frequent(lexicon, counted).select("word", "polarity", "subjectivity", "hot"), "word")
    mean = lambda c: F.sum(F.col("n") * F.col(c)) / F.sum(F.when(F.col(c).isNotNull(), F.col("n")))
    scored = known.groupBy(key).agg(mean("polarity").alias("_p"), mean("subjectivity").alias("_s"))
    return texts.select(key).distinct().join(scored, key, "left").select(
        key, F.coalesce("_p", F.lit(0.0)).alias("text_sentiment_polarity"), F.coalesce("_s", F.lit(0.0)).alias("text_sentiment_subjectivity")
    )


def _frequent(lexicon: DataFrame, words: DataFrame) -> DataFrame:
    """``lexicon`` with ``hot``, at most ``sparse.HOT`` rows: all of a short one, else the frequent words.

    A column ``uses`` of the lexicon tells how frequent its words are; without one
    the rows (word) of the texts are counted. It only decides where a word is met.
    """
    if lexicon.limit(sparse.HOT + 1).count() <= sparse.HOT:
        return lexicon.withColumn("hot", F.lit(True))
    if "uses" not in lexicon.columns:
        lexicon = lexicon.join(words.groupBy("word").agg(F.count(F.lit(1)).alias("uses")), "word")
        lexicon = materialize(lexicon, "lexicon-uses")
    return sparse.mark_hot(lexicon, "uses")


# Words that turn the meaning of what follows.
NEGATIONS = ("no", "not", "never", "nor", "neither", "without", "cannot", "n't")
NEGATED = -0.5  # factor on a negated polarity
REACH = 3  # words after a negation in which it holds


def modified_sentiment(
    df: DataFrame,
    key: str,
    text: Column | str,
    lexicon: DataFrame,
    negations: Sequence[str] = NEGATIONS,
    reach: int = REACH,
    word_pattern: str = r"n't|[a-z]+?(?=n't)|[a-z]+",
) -> DataFrame:
    """(key, polarity, subjectivity): means over the rated words of each text, with intensity and negation.

    ``lexicon`` has (word, polarity, subjectivity, intensity), one row per word.
    A word whose intensity is neither null nor 1 is a modifier: directly before
    a rated word it scales that word's numbers (held between -1 and 1, chains of
    modifiers multiply) and does not count itself; elsewhere it counts as a word.
    A negation turns the polarity of the rated words within ``reach`` words by
    ``NEGATED``, up to and with the first of them that is no modifier.
    The distinct words of a block of texts (see ``coded``) meet the lexicon, frequent
    ones (see ``_frequent``) where they are; then each block is read in the order of its
    words, all texts at once. Texts without a rated word, null texts too, get 0. Rows
    that share a key are one text, in no fixed order.
    """
    folded = ft.ascii_fold(F.lower(F.regexp_replace(F.col(text) if isinstance(text, str) else text, "\u2019", "'")))
    texts = df.select(key, ft.words(folded, word_pattern).alias("_w"), F.lit(None).cast("array<int>").alias("_at"))
    if (repeated := _repeated_keys(df, key)) is not None:
        same = F.col(key).eqNullSafe(F.col("_key"))
        own = lambda c: F.flatten(F.collect_list(c))
        several = texts.join(repeated.where("_key IS NOT NULL"), same, "left_semi").withColumn("_at", F.transform("_w", lambda w, i: i))
        several = several.groupBy(key).agg(own("_w").alias("_w"), own("_at").alias("_at"))
        unkeyed = repeated.where("_key IS NULL").select(F.col("_key").alias(key)).withColumns({c: F.lit(None).cast(dict(texts.dtypes)[c]) for c in ("_w", "_at")})
        texts = texts.join(repeated, same, "left_anti").unionByName(several).unionByName(unkeyed)
    places = F.coalesce("_at", F.when(F.size("_w") > 0, F.sequence(F.lit(0), F.size("_w") - 1))) if repeated is not None else None
    held = materialize(coded.blocks(texts, F.col("_w"), [key], places=places), "text-blocks")
    words = coded.dictionaries(held).withColumnRenamed("term", "word")
    rated = _frequent(lexicon, words).select(
        "word", F.coalesce("polarity", F.lit(0.0)).cast("double").alias("p"), F.coalesce("subjectivity", F.lit(0.0)).cast("double").alias("s"),
        F.coalesce("intensity", F.lit(1.0)).cast("double").alias("scale"), "hot",
    )
    turning = sorted(set(negations))

    def score(block: coded.Block, found: pa.Table) -> pa.Table:
        turns = pc.is_in(block.terms, value_set=pa.array(turning, pa.string())).to_numpy(zero_copy_only=False)
        p, s = _sentiments(block, turns, *coded.numbers(found, "code", "p", "s", "scale"), reach)
        return pa.table({key: next(iter(block.kept.values())), "p": pa.array(p), "s": pa.array(s)})

    scored = coded.meet(held, sparse.join_known(words, rated, "word").drop("word"), score, f"`{key}` {df.schema[key].dataType.simpleString()}, p double, s double", spelled=True)
    number = lambda c: F.when(F.col(key).isNull(), 0.0).otherwise(F.col(c))
    return scored.select(key, number("p").alias("text_sentiment_polarity"), number("s").alias("text_sentiment_subjectivity"))


def _sentiments(
    block: coded.Block, turns: np.ndarray, code: np.ndarray, p: np.ndarray, s: np.ndarray, scale: np.ndarray, reach: int
) -> tuple[np.ndarray, np.ndarray]:
    """Mean polarity and subjectivity of each text of a block, 0 without a rated word.

    ``turns`` tells which terms are negations; ``code`` has the terms with ratings, one
    entry for each rating.
    """
    unrated = np.setdiff1d(np.flatnonzero(turns), code)
    code = np.concatenate((code, unrated))
    order = np.argsort(code, kind="stable")
    code = code[order]
    p, s, scale = (np.concatenate((x, np.full(len(unrated), y)))[order] for x, y in ((p, 0.0), (s, 0.0), (scale, 1.0)))
    # Words of the texts that are rated or turn, in order: once for each of their ratings.
    first, n = np.searchsorted(code, block.codes), np.bincount(code, minlength=len(block.terms))[block.codes]
    text, at = np.repeat(block.text, n), np.repeat(block.place, n)
    entry = np.repeat(first, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    if np.any((text[1:] == text[:-1]) & (at[1:] <= at[:-1])):
        order = np.lexsort((scale[entry], s[entry], p[entry], turns[code[entry]], at, text))
        text, at, entry = text[order], at[order], entry[order]
    p, s, scale, turns = p[entry], s[entry], scale[entry], turns[code[entry]]
    here = np.arange(len(text))
    begins = np.searchsorted(text, text)
    modifier = ~turns & (scale != 1)
    beside = np.zeros(len(text), bool)
    beside[1:] = (text[1:] == text[:-1]) & modifier[:-1] & (at[1:] == at[:-1] + 1) & ~turns[1:]
    # A word after modifiers is scaled by all of them: words that follow one first, then those that follow two, ....
    held = np.ones(len(text))
    deep = here - np.maximum.accumulate(np.where(beside, -1, here))
    order = np.argsort(deep, kind="stable")
    cuts = np.searchsorted(deep[order], np.arange(1, deep.max(initial=0) + 2))
    for a, b in zip(cuts[:-1], cuts[1:]):
        i = order[a:b]
        held[i] = held[i - 1] * scale[i - 1]
    # The last negation before a word holds within its reach, unless a plain word came after it.
    before = lambda which: np.concatenate(([-1], np.maximum.accumulate(np.where(which, here, -1))))[:-1]
    last, plain = before(turns), before(~turns & ~modifier)
    turned = (last >= begins) & (last > plain)
    turned &= at - at[last] <= reach
    clipped = lambda x: np.fmax(-1.0, np.fmin(1.0, x * held))
    p, s = clipped(p) * np.where(turned, NEGATED, 1.0), clipped(s)
    counted = ~turns & ~(modifier & np.append(beside[1:], False))
    n = np.bincount(text[counted], minlength=len(block.lengths))
    mean = lambda x: np.divide(np.bincount(text[counted], x[counted], len(n)), n, out=np.zeros(len(n)), where=n > 0)
    return mean(p), mean(s)


# --- TF-IDF ----------------------------------------------------------------


def term_counts(
    df: DataFrame, key: str, text: str, stop_words: Sequence[str] = (), pattern: str = TERM_PATTERN, keep: Sequence[str] = (), distinct: bool = False
) -> DataFrame:
    """(key, keep..., term, tf). A text's terms are counted in its row; ``distinct`` tells that no two rows share a key.

    Else the keys are counted first, and only rows with a key that repeats are summed by term.
    """

    def tallied(rows: DataFrame) -> DataFrame:
        counts = rows.select(key, *keep, F.explode(ft.counted(ft.words(ft.tfidf_clean(text), pattern))).alias("_t"))
        counts = counts.select(key, *keep, F.col("_t.word").alias("term"), F.col("_t.n").alias("tf"))
        return counts.where(~F.col("term").isin(*stop_words)) if stop_words else counts

    if distinct:
        return tallied(df)
    repeated = _repeated_keys(df, key)
    if repeated is None:
        return tallied(df)
    same = F.col(key).eqNullSafe(F.col("_key"))
    summed = tallied(df.join(repeated, same, "left_semi")).groupBy(key, *keep, "term").agg(F.sum("tf").alias("tf"))
    return tallied(df.join(repeated, same, "left_anti")).unionByName(summed)


def inverse_document_frequency(counts: DataFrame, n_docs: int, copies: Column | None = None) -> DataFrame:
    """(term, df, idf) with the smoothed form ln((1+n)/(1+df)) + 1; ``copies`` tells how many texts a row stands for."""
    per_term = counts.groupBy("term").agg((F.count("*") if copies is None else F.sum(copies)).alias("df"))
    return per_term.withColumn("idf", F.ln(F.lit(1.0 + n_docs) / (F.col("df") + 1)) + 1)


def weigh_terms(counts: DataFrame, terms: DataFrame, key: str) -> DataFrame:
    """``counts`` with the columns of ``terms`` and ``tfidf``, rows of unit length per text; unknown terms are ignored.

    ``terms`` has (term, idf, hot, ...); see ``sparse.join_known``. The norm is
    taken over one text's own distinct terms, so a window partition is never larger
    than a text.
    """
    weighted = sparse.join_known(counts, terms, "term", key).withColumn("_w", F.col("tf") * F.col("idf"))
    norm = F.sqrt(F.sum(F.col("_w") * F.col("_w")).over(Window.partitionBy(key)))
    return weighted.withColumn("tfidf", F.col("_w") / norm).drop("_w")


def tfidf_long(df: DataFrame, key: str, text: str, stop_words: Sequence[str] = (), pattern: str = TERM_PATTERN) -> DataFrame:
    """(key, term, tfidf), fitted and applied in one go: the whole vocabulary, no vocabulary on the driver.

    Term counts are written once and used twice (document frequencies, weights),
    instead of tokenising every text twice. The idf table is written too: its
    file size decides between a broadcast and a shuffle join.
    """
    counts = materialize(term_counts(df, key, text, stop_words, pattern), "term-counts")
    idf = materialize(inverse_document_frequency(counts, df.count()), "idf")
    return weigh_terms(counts, sparse.mark_hot(idf.select("term", "df", "idf"), "df").drop("df"), key).select(key, "term", "tfidf")


def distinct_texts(df: DataFrame, text: str) -> DataFrame:
    """(row, text, weight): each text once, with a digest as its row and the number of its rows; null counts as empty."""
    body = F.coalesce(F.col(text), F.lit(""))
    return df.select(F.sha2(body, 256).alias("row"), body.alias("text")).groupBy("row").agg(F.first("text").alias("text"), F.count(F.lit(1)).alias("weight"))


def join_texts(df: DataFrame, text: str, found: DataFrame, out: str, absent: Column) -> DataFrame:
    """``df`` with ``out`` of its texts from (row, out); ``absent`` where a text has none."""
    digest = F.sha2(F.coalesce(F.col(text), F.lit("")), 256)
    held = df.drop(out).withColumn("_row", digest).join(found.select(F.col("row").alias("_row"), out), "_row", "left").drop("_row")
    return held.withColumn(out, F.coalesce(out, absent))


@dataclass(frozen=True)
class TfidfVectors:
    """Fitted TF-IDF: ``terms`` is (term, df, idf, hot, position), written; every term has a position of its own."""

    text: str
    out: str
    stop_words: tuple[str, ...]
    size: int
    terms: DataFrame

    def vectors(self, texts: DataFrame, keep: Sequence[str]) -> DataFrame:
        """(keep..., vector in storage form) of texts: the distinct words of a block meet the terms, its texts stay whole."""
        held = materialize(coded.blocks(texts, _terms(self.text if self.text in texts.columns else "text"), keep), "text-blocks")
        known = sparse.join_known(coded.dictionaries(held), self.terms.select("term", "idf", "hot", "position"), "term").select("block", "code", "idf", "position")
        size, out, keep = self.size, self.out, list(keep)

        def weigh(block: coded.Block, found: pa.Table) -> pa.Table:
            code, idf, position = coded.numbers(found, "code", "idf", "position")
            width = max(len(code), 1)
            at = coded.index_of(code[np.argsort(position)], len(block.terms))[block.codes]
            idf, position = idf[np.argsort(position)], np.sort(position)
            cell = np.sort((block.text * width + at)[at >= 0])
            starts = np.flatnonzero(np.concatenate(([True], cell[1:] != cell[:-1]))) if len(cell) else np.zeros(0, np.int64)
            text, at = np.divmod(cell[starts], width)
            weight = np.diff(starts, append=len(cell)) * idf[at]
            n = len(block.lengths)
            value = weight / np.sqrt(np.bincount(text, weight * weight, n))[text]
            ends = pa.array(np.concatenate(([0], np.cumsum(np.bincount(text, minlength=n)))), pa.int32())
            lists = [pa.ListArray.from_arrays(ends, x) for x in (pa.array(position[at], pa.int32()), pa.array(value, pa.float64()))]
            vector = pa.StructArray.from_arrays([pa.array(np.zeros(n), pa.int8()), pa.array(np.full(n, size), pa.int32()), *lists], ["type", "size", "indices", "values"])
            return pa.table(dict(zip(keep, block.kept.values())) | {out: vector})

        kinds = [f"`{c}` {texts.schema[c].dataType.simpleString()}" for c in keep]
        form = "struct<type: tinyint, size: int, indices: array<int>, values: array<double>>"
        return coded.meet(held, known, weigh, ", ".join([*kinds, f"`{out}` {form}"]))

    def cells(self, texts: DataFrame) -> DataFrame:
        """(row, position, value, weight) of ``distinct_texts``."""
        held = self.vectors(texts, ["row", "weight"])
        at = F.arrays_zip(F.col(f"{self.out}.indices").alias("position"), F.col(f"{self.out}.values").alias("value"))
        return held.select("row", "weight", F.explode(at).alias("_c")).select("row", F.col("_c.position").cast("long").alias("position"), "_c.value", "weight")

    def rows(self, df: DataFrame, keep: Sequence[str] | None = None) -> DataFrame:
        """``df`` with a sparse vector in storage form.

        Each distinct text is worked out once, and its vector moved to its rows; where the
        columns to ``keep`` are named, they go with the texts and neither texts nor vectors
        are moved.
        """
        if keep is not None:
            return self.vectors(df, keep)
        held = self.vectors(distinct_texts(df, self.text), ["row"])
        return join_texts(df, self.text, held, self.out, sparse.no_cells(self.size))

    def transform(self, df: DataFrame) -> DataFrame:
        """``df`` with a sparse vector, written."""
        return sparse.as_vectors(self.rows(df), [self.out])


def _terms(text: str) -> Column:
    return ft.words(ft.tfidf_clean(text), TERM_PATTERN)


def _texts_with(block: coded.Block) -> np.ndarray:
    """In how many texts of a block each of its terms stands."""
    cells = np.sort(block.codes * len(block.lengths) + block.text)
    once = np.concatenate(([True], cells[1:] != cells[:-1])) if len(cells) else np.zeros(0, bool)
    return np.bincount(cells[once] // max(len(block.lengths), 1), minlength=len(block.terms))


def fit_tfidf_vectors(df: DataFrame, text: str, out: str = "tfidf_vec", stop_words: Sequence[str] = ()) -> TfidfVectors:
    """TF-IDF over all terms of the texts; nothing of the vocabulary reaches the driver. Texts are counted by block and term, not by text and term."""
    stop_words = tuple(sorted({w for word in stop_words for w in (word, word.replace("'", ""))}))
    counts = coded.term_numbers(coded.blocks(df, _terms(text), count=_texts_with))
    if stop_words:
        counts = counts.where(~F.col("term").isin(*stop_words))
    idf = materialize(inverse_document_frequency(counts, df.count(), F.col("n")), "idf")
    terms = materialize(sparse.dictionary(sparse.mark_hot(idf, "df"), ["term"]), "terms")
    return TfidfVectors(text, out, stop_words, max(terms.count(), 1), terms)


# --- embeddings ------------------------------------------------------------


def encode_text(
    df: DataFrame,
    text: str,
    out: str,
    load_encoder: Callable[[], Callable[[list[str]], Sequence[Sequence[float]]]],
) -> DataFrame:
    """Vectors from an external encoder, loaded once per Python worker and fed Arrow batches."""
    schema = StructType([*df.schema.fields, StructField(out, ArrayType(FloatType()))])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = load_encoder()
        for batch in batches:
            vectors = encode(batch[text].fillna("").tolist())
            yield batch.assign(**{out: list(np.asarray(vectors, np.float32).reshape(len(batch), -1))})

    return df.mapInPandas(run, schema)


def _tokens(text: Column | str) -> Column:
    return ft.words(ft.embedding_clean(text, null_as_empty=True), r"\w+")


CHUNK = 1 << 20  # words of a block whose pairs are formed at a time


def neighbours(block: coded.Block, window: int) -> np.ndarray:
    """In how many pairs each term of a block stands: a word has as many as there are others at most ``window`` words from it."""
    at, length = block.place, np.repeat(block.lengths, block.lengths)
    near = np.minimum(at, window) + np.minimum(length - 1 - at, window)
    return np.bincount(block.codes, near, len(block.terms)).astype(np.int64)


def counted_pairs(held: DataFrame, known: DataFrame, shape: tiles.Shape, window: int) -> DataFrame:
    """Pieces of tiles (tile, cells, counts) of the pairs of ``known`` words (term, hot, position) in blocks of texts.

    Pairs are counted in the block, ``CHUNK`` words at a time; a column kept with the blocks is the weight of a text.
    """
    chunk = CHUNK

    def count(block: coded.Block, found: pa.Table) -> pa.Table:
        code, position = coded.numbers(found, "code", "position")
        at = np.append(position, -1)[coded.index_of(code, len(block.terms))][block.codes]
        text = block.text
        often = next((x.to_numpy(zero_copy_only=False)[text] for x in block.kept.values()), None)
        out = []
        for s in range(0, len(at), chunk):
            keys, weights = [], []
            for o in range(1, window + 1):
                left, right = slice(s, min(s + chunk, len(at) - o)), slice(s + o, min(s + chunk, len(at) - o) + o)
                if left.stop <= s:
                    break
                a, b = at[left], at[right]
                met = (text[left] == text[right]) & (a >= 0) & (b >= 0)
                a, b = a[met], b[met]
                keys.append(shape.tile(np.minimum(a, b), np.maximum(a, b)))
                if often is not None:
                    weights.append(often[left][met])
            if keys:
                out += tiles.pieces(np.concatenate(keys), None if often is None else np.concatenate(weights).astype(np.int64))
        tile, cells, counts = zip(*out) if out else ((), (), ())
        return pa.table({"tile": pa.array(tile, pa.int64()), "cells": pa.array(cells, pa.binary()), "counts": pa.array(counts, pa.binary())})

    where = sparse.join_known(coded.dictionaries(held), known.select("term", "hot", "position"), "term").select("block", "code", "position")
    return coded.meet(held, where, count, tiles.PIECE)


def _placed_words(held: DataFrame, min_count: int) -> tuple[DataFrame, int, tiles.Shape]:
    """(term, n, hot, position) of the words in ``min_count`` pairs or more, written, with the sum of n and the tiles of their pairs."""
    sums = coded.term_numbers(held).groupBy("term").agg(F.sum("n").alias("n")).where((F.col("n") >= min_count) & (F.col("n") > 0))
    known = materialize(sparse.dictionary(sparse.mark_hot(materialize(sums, "word-counts"), "n"), ["term"]), "words")
    size, total = known.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    return known, total, tiles.shape(size, total // 2)


def word_pairs(texts: DataFrame, window: int) -> DataFrame:
    """(a, b, n): how often the words of the texts (text, weight) stand at most ``window`` words apart, both ways round.

    Words are counted as pairs of positions (see ``counted_pairs``) and shown as words again.
    """
    held = materialize(coded.blocks(texts, _tokens("text"), ["weight"], lambda block: neighbours(block, window)), "text-blocks")
    known, _, shape = _placed_words(held, 1)

    def cells(found: pa.Table) -> pa.Table:
        tile = found.column("tile")[0].as_py()
        own, counts = tiles.added(found)
        own = own.astype(np.int64)
        a, b = tile // shape.grid * shape.edge + (own >> tiles.BITS), tile % shape.grid * shape.edge + (own & ((1 << tiles.BITS) - 1))
        off = a != b
        both = {"p_a": np.concatenate((a, b[off])), "p_b": np.concatenate((b, a[off])), "n": np.concatenate((np.where(off, counts, 2 * counts), counts[off]))}
        return pa.table({c: pa.array(x, pa.int64()) for c, x in both.items()})

    pairs = counted_pairs(held, known, shape, window).groupBy("tile").applyInArrow(lambda found: cells(found), "p_a long, p_b long, n long")
    side = lambda c: known.select(F.col("position").alias(f"p_{c}"), F.col("term").alias(c), "hot")
    return sparse.join_known(sparse.join_known(materialize(pairs, "word-pairs"), side("a"), "p_a"), side("b"), "p_b").select("a", "b", "n")


@dataclass(frozen=True)
class WordVectors:
    """Averaged word vectors: ``words`` is (term, hot, z0, z1, ...), written."""

    text: str
    out: str
    size: int
    words: DataFrame

    def vectors(self, texts: DataFrame) -> DataFrame:
        """(row, vector array, weight) of ``distinct_texts``: the mean over the known words of a text."""
        names = [f"z{i}" for i in range(self.size)]

        def average(block: coded.Block, found: pa.Table) -> pa.Table:
            code, *z = coded.numbers(found, "code", *names)
            at, text = coded.index_of(code, len(block.terms))[block.codes], block.text
            text, at = text[at >= 0], at[at >= 0]
            n = np.bincount(text, minlength=len(block.lengths))
            rows = np.flatnonzero(n)
            means = np.stack([np.bincount(text, x[at], len(n))[rows] / n[rows] for x in z], 1)
            row, weight = (x.take(pa.array(rows)) for x in block.kept.values())
            vector = pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1) * len(names), pa.int32()), pa.array(means.ravel()))
            return pa.table({"row": row, "vector": vector, "weight": weight})

        held = materialize(coded.blocks(texts, _tokens("text"), ["row", "weight"]), "text-blocks")
        known = sparse.join_known(coded.dictionaries(held), self.words, "term").drop("term")
        kind = lambda c: texts.schema[c].dataType.simpleString()
        return coded.meet(held, known, average, f"row {kind('row')}, vector array<double>, weight {kind('weight')}")

    def cells(self, texts: DataFrame) -> DataFrame:
        return self.vectors(texts).select("row", F.posexplode("vector").alias("position", "value"), "weight")

    def transform(self, df: DataFrame) -> DataFrame:
        found = self.vectors(distinct_texts(df, self.text)).select("row", array_to_vector("vector").alias(self.out))
        return join_texts(df, self.text, found, self.out, array_to_vector(F.array_repeat(F.lit(0.0), self.size)))


def fit_word_vectors(df: DataFrame, text: str, out: str = "emb_vec", size: int = 100, window: int = 5, min_count: int = 1) -> WordVectors:
    """Vectors of words by the company they keep: positive pointwise mutual information, factorised.

    Words that stand at most ``window`` words apart are counted as pairs; a pair
    weighs ``ln(n(a, b) * n / (n(a) * n(b)))`` where that is positive, and the words'
    rows of weights are reduced to ``size`` numbers by ``sparse.fit_symmetric_components``
    (not centred). Words in fewer than ``min_count`` pairs have no vector: how many a word
    is in follows from its places, so only pairs of other words are counted. Counts,
    weights and vectors are tables; the vocabulary never reaches the driver, and
    the vectors do not depend on the number of cores.
    """
    held = materialize(coded.blocks(df, _tokens(text), count=lambda block: neighbours(block, window)), "text-blocks")
    known, total, shape = _placed_words(held, min_count)
    cells = tiles.Cells(shape, lambda n, a, b: np.log(n * total / (a * b)))
    counted = counted_pairs(held, known, shape, window)
    matrix = tiles.Tiles(materialize(tiles.from_pieces(counted, tiles.strips(known, ["n"], shape), cells), "word-weights"), cells)
    found, points = sparse.fit_symmetric_components(matrix, size)
    width = max(len(found.variances), 1)
    points = points.withColumns({f"z{i}": F.lit(0.0) for i in range(len(found.variances), width)})
    words = materialize(known.join(points, "position").select("term", "hot", *[f"z{i}" for i in range(width)]), "word-vectors")
    return WordVectors(text, out, width, words)


@dataclass(frozen=True)
class HashedEmbedding:
    """Unit-length hashed bags of words: no fitted vocabulary, a width of the caller's choice."""

    text: str
    out: str
    size: int
    model: PipelineModel

    def cells(self, texts: DataFrame) -> DataFrame:
        """(row, position, value, weight) of ``distinct_texts``."""
        held = self.model.transform(texts.withColumn("_words", _tokens("text")))
        return held.select("row", "weight", F.posexplode(vector_to_array(self.out)).alias("position", "value")).where("value <> 0").select(
            "row", "position", "value", "weight"
        )

    def transform(self, df: DataFrame) -> DataFrame:
        return self.model.transform(df.withColumn("_words", _tokens(self.text)))


def fit_hashed_embedding(df: DataFrame, text: str, out: str = "emb_vec", size: int = 384) -> HashedEmbedding:
    stages = Pipeline(stages=[
        HashingTF(numFeatures=size, inputCol="_words", outputCol="_hashed"),
        Normalizer(p=2.0, inputCol="_hashed", outputCol=out),
        SQLTransformer(statement="SELECT * EXCEPT (_words, _hashed) FROM __THIS__"),
    ])
    return HashedEmbedding(text, out, size, stages.fit(df.withColumn("_words", _tokens(text))))


def fit_embedding(df: DataFrame, text: str, out: str = "emb_vec", method: str = "cooccurrence", **options):
    """Text vectors by the company of their words, or by hashing (``hashing``)."""
    return {"cooccurrence": fit_word_vectors, "hashing": fit_hashed_embedding}[method](df, text, out, **options)


# --- both together ---------------------------------------------------------


@dataclass(frozen=True)
class TextComponents:
    """TF-IDF and word vectors side by side, reduced together; every term keeps its own position up to the reduction."""

    tfidf: TfidfVectors
    embedding: WordVectors | HashedEmbedding
    out: str
    components: sparse.Components

    def cells(self, texts: DataFrame) -> DataFrame:
        return combined_cells(self.tfidf, self.embedding, texts)

    def transform(self, df: DataFrame) -> DataFrame:
        found = self.components.project(self.cells(distinct_texts(df, self.tfidf.text)), "row")
        found = materialize(found.select("row", array_to_vector("components").alias(self.out)), "text-numbers")
        return join_texts(df, self.tfidf.text, found, self.out, array_to_vector(self.components.at_zero()))


def combined_cells(tfidf: TfidfVectors, embedding: WordVectors | HashedEmbedding, texts: DataFrame) -> DataFrame:
    """(row, position, value, weight): the terms first, then the numbers of the word vectors."""
    beside = embedding.cells(texts).withColumn("position", F.col("position") + F.lit(tfidf.size).cast("long"))
    return tfidf.cells(texts).unionByName(beside)


def fit_text_components(df: DataFrame, tfidf: TfidfVectors, embedding: WordVectors | HashedEmbedding, k: int, out: str = "text_pca_wide") -> TextComponents:
    texts = materialize(distinct_texts(df, tfidf.text), "distinct-texts")
    cells = materialize(combined_cells(tfidf, embedding, texts), "text-cells")
    return TextComponents(tfidf, embedding, out, sparse.fit_components(cells, df.count(), k))
