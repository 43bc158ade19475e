"""Texts as blocks of codes, pair counts and products in tiles."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from featloom.operators import coded, sparse, tiles
from featloom.operators import text_features as op


def zipf_texts(seed, n, longest=80):
    rng = random.Random(seed)
    words = [f"w{int(40 / (1 - rng.random()) ** 0.7)}" for _ in range(4000)]
    return [" ".join(rng.choice(words) for _ in range(rng.randrange(longest))) for _ in range(n)]


def test_blocks_hold_whole_texts_in_order(spark, monkeypatch):
    texts = [(i, t or None) for i, t in enumerate(zipf_texts(1, 60))] + [(None, "a b a")]
    df = spark.createDataFrame(texts, "id long, text string").coalesce(2)
    monkeypatch.setattr(coded, "WORDS", 100)
    held = coded.blocks(df, F.split("text", " "), ["id"], lambda b: np.bincount(b.codes, minlength=len(b.terms))).localCheckpoint()
    rows = held.collect()
    assert len(rows) > 5 and len({r.block for r in rows}) == len(rows)
    found = []
    for r in rows:
        lengths, codes = np.frombuffer(r.lengths, np.int32), np.frombuffer(r.codes, np.uint16)
        ends = np.cumsum(lengths)
        found += [(k, " ".join(r.terms[c] for c in codes[e - n : e]) or None) for k, n, e in zip(r["_k0"], lengths, ends)]
        assert len(codes) - lengths[-1] < 100 and len(set(r.terms)) == len(r.terms) and sum(r.counts) == len(codes)
    assert sorted(found, key=str) == sorted(texts, key=str)


def weights(texts, window, min_count):
    """The words' rows of weights, from all pairs of words one by one."""
    count = {}
    for t in texts:
        w = (t or "").split()
        for i, a in enumerate(w):
            for b in w[i + 1 : i + 1 + window]:
                for p in ((a, b), (b, a)):
                    count[p] = count.get(p, 0) + 1
    own = {}
    for (a, _), n in count.items():
        own[a] = own.get(a, 0) + n
    known = sorted(w for w, n in own.items() if n >= min_count)
    total = sum(own[w] for w in known)
    m = np.array([[np.log(count[a, b] * total / (own[a] * own[b])) if (a, b) in count else 0.0 for b in known] for a in known])
    return known, np.maximum(m, 0.0)


@pytest.mark.parametrize("pairs, band", [(1 << 25, 1 << 18), (300, 30)])
def test_word_vectors_move_tiles_not_pairs(spark, monkeypatch, pairs, band):
    """The factorised matrix, cell by cell, however it is cut; words of few pairs have no cells; one row a tile is written."""
    monkeypatch.setattr(tiles, "PAIRS", pairs)
    monkeypatch.setattr(tiles, "BAND", band)
    monkeypatch.setattr(coded, "WORDS", 500)
    monkeypatch.setattr(op, "CHUNK", 200)
    texts = [*zipf_texts(2, 120), "w40 w40 w40", None, ""]
    taken = []
    whole = sparse.fit_symmetric_components
    monkeypatch.setattr(sparse, "fit_symmetric_components", lambda matrix, k: taken.append(matrix) or whole(matrix, k))
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id long, text string").repartition(3)
    fitted = op.fit_word_vectors(df, "text", size=400, min_count=60)
    known, want = weights(texts, 5, 60)
    matrix, size = taken[0], len(known)
    assert matrix.table.count() <= matrix.shape.grid * (matrix.shape.grid + 1) // 2 < (want > 0).sum() / 2
    vectors = {r.term: np.array([r[f"z{i}"] for i in range(fitted.size)]) for r in fitted.words.collect()}
    met = [i for i, row in enumerate(want) if row.any()]
    assert sorted(vectors) == [known[i] for i in met]
    # With all numbers kept, products of vectors are those of the rows.
    points = np.array([vectors[known[i]] for i in met])
    assert np.allclose(points @ points.T, (want @ want.T)[np.ix_(met, met)], atol=1e-6)
    unit = tiles.strips(spark.range(size).select(F.col("id").alias("position"), F.lit(1.0).alias("z0")), ["z0"], matrix.shape)
    rows = tiles.unpacked(matrix.times(unit, 1), ["z0"], matrix.shape).where("z0 > 0").collect()
    assert sorted(r.z0 for r in rows) == pytest.approx(sorted(want[met].sum(1)))
    sums = {r.position: (r.sum, r.squares) for r in matrix.sums().collect()}
    assert sorted(s for s, _ in sums.values()) == pytest.approx(sorted(want[met].sum(1))) and sum(q for _, q in sums.values()) == pytest.approx((want**2).sum())
    assert len(fitted.transform(df).where("id IS NOT NULL").collect()) == len(texts)


SCALES = {"very": 1.1, "so": 0.9}


def read_one_by_one(words, rated, negations, reach=3):
    """(place, word) in order, read by one state."""
    p = s = n = 0
    waiting, last, scale, turned = None, None, 1.0, None
    for at, w in words:
        if w not in rated and w not in negations:
            continue
        turns, k = w in negations, SCALES.get(w, 1.0)
        beside = waiting is not None and at == last + 1 and not turns
        if waiting is not None and not beside:
            p, s, n = p + waiting[0], s + waiting[1], n + 1
        held = scale if beside else 1.0
        clip = lambda x: max(-1.0, min(1.0, x * held))  # noqa: E731, B023
        x = (clip(rated[w][0]) * (-0.5 if turned is not None and at - turned <= reach else 1.0), clip(rated[w][1])) if w in rated else (0.0, 0.0)
        waiting, last, scale = None, at, 1.0
        if turns:
            turned = at
        elif k != 1:
            waiting, scale = x, held * k
        else:
            p, s, n, turned = p + x[0], s + x[1], n + 1, None
    if waiting is not None:
        p, s, n = p + waiting[0], s + waiting[1], n + 1
    return (p / n, s / n) if n else (0.0, 0.0)


def test_modified_sentiment_reads_blocks_not_rows_of_words(spark, monkeypatch):
    """Texts stay whole: nothing is grouped by text; chains of modifiers, repeated and null keys, no texts at all."""
    monkeypatch.setattr(coded, "WORDS", 300)
    rng = random.Random(8)
    rated = {w: (rng.uniform(-1, 1), rng.random()) for w in ("good", "bad", "odd", "very", "so", "not")}
    lexicon = spark.createDataFrame([(w, p, s, SCALES.get(w)) for w, (p, s) in rated.items()], "word string, polarity double, subjectivity double, intensity double")
    words = ["good", "bad", "odd", "very", "so", "not", "never", "x"]
    texts = {i: [rng.choice(words) for _ in range(rng.choice([0, 2, 9, 50]))] for i in range(80)} | {80: ["very"] * 900 + ["good"], 81: ["never"] + ["so"] * 3}
    df = spark.createDataFrame([(k, " ".join(w)) for k, w in texts.items()] + [(82, None), (None, "good")], "id long, text string").repartition(2)
    out = op.modified_sentiment(df, "id", "text", lexicon)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "FlatMapCoGroupsInArrow" in plan and "collect_list" not in plan and "aggregate(" not in plan
    want = {k: read_one_by_one(list(enumerate(w)), rated, op.NEGATIONS) for k, w in texts.items()} | {82: (0.0, 0.0), None: (0.0, 0.0)}
    got = {r.id: (r[1], r[2]) for r in out.collect()}
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k]) for k in want)
    again = df.unionByName(spark.createDataFrame([(0, "so x good"), (0, "not bad"), (82, "very bad"), (None, "bad")], df.schema))
    rows = [(r.id, r[1], r[2]) for r in op.modified_sentiment(again, "id", "text", lexicon).collect()]
    # Rows of a key are one text: its words by place, at one place negations last, then by their numbers.
    merged = sorted([*enumerate(texts[0]), *enumerate(["so", "x", "good"]), *enumerate(["not", "bad"])], key=lambda w: (w[0], w[1] in op.NEGATIONS, rated.get(w[1], (0.0, 0.0)), SCALES.get(w[1], 1.0)))
    want |= {0: read_one_by_one(merged, rated, op.NEGATIONS), 82: read_one_by_one([(0, "very"), (1, "bad")], rated, op.NEGATIONS)}
    assert len(rows) == len(want) and all((p, s) == pytest.approx(want[k]) for k, p, s in rows)
    assert op.modified_sentiment(df.where("false"), "id", "text", lexicon).collect() == []


def test_tfidf_vectors_move_dictionaries_not_terms_of_texts(spark, monkeypatch):
    """The vector of a row is worked out where its text is, whole, with repeated, empty and null texts and null keys."""
    monkeypatch.setattr(coded, "WORDS", 1000)
    texts = [(i, t) for i, t in enumerate(zipf_texts(3, 80))] + [(200, None), (201, ""), (202, "w40 the w40"), (None, "w40 w41"), (None, "the")]
    texts += [(300 + i, t) for i, t in texts[:20]]
    df = spark.createDataFrame(texts, "id long, text string").repartition(3)
    counted = []
    inverse = op.inverse_document_frequency
    monkeypatch.setattr(op, "inverse_document_frequency", lambda counts, *rest: counted.append(counts) or inverse(counts, *rest))
    fitted = op.fit_tfidf_vectors(df, "text", stop_words=["the"])
    assert counted[0].count() < sum(len({w for w in (t or "").split() if w != "the"}) for _, t in texts) / 2  # one row for a block, not for a text
    place = {r.term: r.position for r in fitted.terms.collect()}
    n = {w: sum(w in (t or "").split() for _, t in texts) for w in place}
    want = []
    for i, t in texts:
        v = {place[w]: t.split().count(w) * (np.log((1 + len(texts)) / (1 + n[w])) + 1) for w in set((t or "").split()) - {"the"}}
        want.append((i, [(p, round(v[p] / np.sqrt(sum(x * x for x in v.values())), 9)) for p in sorted(v)]))
    assert set(place) == {w for _, t in texts for w in (t or "").split()} - {"the"}
    out = fitted.rows(df, keep=["id"])
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and "collect_list" not in plan
    shown = lambda rows: sorted(((r.id, [(p, round(v, 9)) for p, v in zip(r.tfidf_vec["indices"], r.tfidf_vec["values"])]) for r in rows), key=str)
    assert shown(out.collect()) == shown(fitted.rows(df).collect()) == sorted(want, key=str)
    assert {(r.tfidf_vec.type, r.tfidf_vec["size"]) for r in out.collect()} == {(0, fitted.size)}
    cells = {(r.position, round(r.value, 9), r.weight) for r in fitted.cells(op.distinct_texts(df, "text")).collect()}
    assert {(p, v) for p, v, _ in cells} == {x for _, v in want for x in v} and {w for _, _, w in cells} == {1, 2}
