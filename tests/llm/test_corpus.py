"""Benchmark passages, language, mixing and the pipeline."""

import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from featloom.llm import decontaminate, language_id, mixing
from tests.oracle import compare, connect

SF = "/root/testdata/sf0.001"


def plain_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain_hits(text, items):
    words, hit, found = plain_words(text), set(), set()
    for ident, body in items:
        w = plain_words(body)
        n = min(10, len(w))
        grams = {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if n else set()
        for i in range(len(words) - n + 1 if n else 0):
            if tuple(words[i : i + n]) in grams:
                hit |= set(range(i, i + n))
                found.add(ident)
    return len(words), len(hit), sorted(str(x) for x in found if x is not None)


def test_contamination_equals_plain_search(spark):
    rng = random.Random(5)
    word = lambda: rng.choice(["the", "of", "a", "Ünder", "x1", "Rare%d" % rng.randrange(300), "w%d" % rng.randrange(30)])
    items = [(i, " ".join(word() for _ in range(rng.choice([1, 2, 3, 5, 9, 10, 11, 25, 40])))) for i in range(40)]
    items = [(i, t if len(plain_words(t)) > 1 else t + " unique%d" % i) for i, t in items]
    items += [(50, None), (51, ""), (52, "..."), (53, "the the the the the the the the the the the the"), (3, items[5][1]), (None, "null item has ten words and one more of the a")]
    docs = []
    for i in range(120):
        parts = []
        for _ in range(rng.randrange(6)):
            body = plain_words(rng.choice(items)[1])
            cut = body[rng.randrange(3) :][: rng.choice([9, 10, 50])]
            parts += [*cut, *[word() for _ in range(rng.randrange(5))]]
        docs.append((i, rng.choice([" ", "\n", ", "]).join(p.upper() if rng.random() < 0.2 else p for p in parts), "x"))
    docs += [(200, None, "x"), (201, "", "x"), (202, "the " * 30000, "x"), (203, items[1][1], "x"), (203, items[1][1], "x"), (None, items[1][1], "x"), (204, items[-1][1], "x")]
    out = decontaminate.contamination(
        spark.createDataFrame(docs, "doc_id long, text string, item string").repartition(5), spark.createDataFrame(items, "item_id long, text string")
    ).collect()
    key = lambda r: str(r)
    got = sorted([(r.doc_id, r.n_words, r.n_hit, r["items"], r.n_items) for r in out], key=key)
    want = sorted([(i, *p, len(p[2])) for i, t, _ in docs for p in [plain_hits(t, items)]], key=key)
    assert got == want and sum(r[2] > 0 for r in want) > 20


def test_contamination_of_empty_tables(spark):
    docs, items = spark.createDataFrame([(1, "a b")], "doc_id long, text string"), spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert [tuple(r) for r in decontaminate.contamination(docs, items.where("false")).collect()] == [(1, 2, 0, [], 0)]
    assert decontaminate.contamination(docs.where("false"), items).collect() == []


LANGS = {"aa": ["bana", "bobu", "abba", "nabo"], "zz": ["zyxt", "xyzz", "tzyk", "kryx"], "ée": ["éàè", "çéàù", "èéçà"]}


def corpus(n):
    rng = random.Random(8)
    rows = []
    for i in range(n):
        lang = rng.choice(list(LANGS))
        rows.append((i, " ".join(rng.choice(LANGS[lang]) for _ in range(rng.choice([1, 5, 80, 400]))), lang))
    return rows


def test_language(spark):
    rows = corpus(240)
    odd = [(1000, None, "aa"), (1001, "", "aa"), (1002, "123 !? 456" * 50, "zz"), (1003, "bana", None), (None, "zyxt xyzz tzyk", "zz"), (1004, "1" * 100_000 + "zyxt kryx" * 9, "x")]
    docs = spark.createDataFrame([(*r, "old") for r in rows + odd], "doc_id long, text string, lang string, score string")
    net = language_id.fit(docs)
    assert set(net.labels) - {"x"} == set(LANGS)
    out = language_id.predict(docs, net).collect()
    assert len(out) == len(rows + odd)
    by = {r.doc_id: r for r in out}
    held_out = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 3 == 1]
    assert np.mean([by[i].lang_pred == lang for i, _, lang in held_out]) > 0.97
    assert all((by[i].lang_pred, by[i].score) == ("und", 0.0) for i in (1000, 1001, 1002))
    assert by[1003].lang_pred == "aa" and by[None].lang_pred == "zz" and all(0 <= r.score <= 1 for r in out)


def test_language_learns_only_from_its_share(spark):
    docs = spark.createDataFrame([(i, "abc def", "aa" if zlib.crc32(str(i).encode()) % 3 == 1 else "bb") for i in range(60)], "doc_id long, text string, lang string")
    assert language_id.fit(docs).labels == ["bb"]
    none = language_id.fit(docs.where("lang = 'aa'"))
    assert none.labels == [] and {r.lang_pred for r in language_id.predict(docs, none).collect()} == {"und"}
    assert language_id.predict(docs.where("false"), none).collect() == []


def test_windows_cover_the_whole_text():
    text = "aé" * 1000
    assert language_id.windows_of(text).tobytes().rstrip(b"\0").decode() == text and language_id.windows_of("").shape == (1, language_id.WINDOW)
    net = language_id.train(np.concatenate([language_id.windows_of("ab" * 300), language_id.windows_of("xy" * 300)]), ["l"] * 3 + ["r"] * 3)
    assert net.predict(["ab" * 128 + "xy" * 1000, "xy" * 128 + "ab" * 1000, None])[0] == ["r", "l", "und"]


def plain_forward(net, window):
    """Probabilities of one window by plain loops over positions and filters."""
    tops, i = [], 0
    for width, table in net.tables.items():
        for f in range(table.shape[2]):
            best = max(sum(float(table[k, window[p + k], f]) for k in range(width)) for p in range(len(window) - width + 1))
            tops.append(max(best + float(net.bias[i]), 0.0))
            i += 1
    z = [sum(t * net.dense[j, c] for j, t in enumerate(tops)) + net.offset[c] for c in range(len(net.labels))]
    e = [np.exp(x - max(z)) for x in z]
    return [x / sum(e) for x in e]


def small_net(epochs):
    x = np.concatenate([language_id.windows_of("abba nabo " * 30)[:, :24], language_id.windows_of("xyzz tzyk " * 30)[:, :24]])
    return x, ["l"] * (len(x) // 2) + ["r"] * (len(x) // 2), language_id.train(x, ["l"] * (len(x) // 2) + ["r"] * (len(x) // 2), epochs=epochs, batch=1000)


def test_forward_pass_equals_plain_loops():
    x, _, net = small_net(2)
    got = net.probabilities(x)
    assert all(got[i] == pytest.approx(plain_forward(net, x[i]), abs=1e-4) for i in range(len(x)))


def test_first_step_follows_the_slope():
    """The first step of Adam moves every number against the sign of its slope, as finite differences tell it."""
    x, labels, before = small_net(0)
    after = small_net(1)[2]
    y = [before.labels.index(v) for v in labels]
    loss = lambda net: -np.mean([np.log(plain_forward(net, row)[c]) for row, c in zip(x[[0, -1]], [y[0], y[-1]])])
    checked = 0
    for j in range(0, before.dense.shape[0], 7):
        for c in range(2):
            up, down = (language_id.ByteNet(before.labels, before.tables, before.bias, before.dense.copy(), before.offset) for _ in range(2))
            up.dense[j, c] += 1e-4
            down.dense[j, c] -= 1e-4
            full = lambda net: -np.mean(np.log(net.probabilities(x)[np.arange(len(x)), y]))
            slope = (full(up) - full(down)) / 2e-4
            if abs(slope) > 1e-3:
                assert np.sign(after.dense[j, c] - before.dense[j, c]) == -np.sign(slope)
                checked += 1
    assert checked > 5 and loss(after) < loss(before)


def test_mixing_meets_its_marginals(spark):
    rng = random.Random(2)
    rows = [(i, "w " * rng.randrange(1, 40), rng.choice("aab"), rng.choice([None, "en", "en", "fr"]), "x") for i in range(3000)]
    rows += [(None, "w w", "a", "en", "x"), (5000, None, "a", "en", "x"), (5001, "", None, None, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, weight string")
    out = mixing.sample(docs, shares={"source": {"a": 1, "b": 3}, "lang": {"en": 2, "fr": 1, None: 1}}).cache()
    assert out.count() == len(rows) and out.where("probability < 0 or probability > 1").count() == 0
    total = out.agg(F.sum(F.col("n_tokens") * F.col("weight"))).head()[0]
    for dim, want in (("source", {"a": 0.25, "b": 0.75}), ("lang", {"en": 0.5, "fr": 0.25, None: 0.25})):
        got = {r[0]: r[1] / total for r in out.where("n_tokens > 0").groupBy(dim).agg(F.sum(F.col("n_tokens") * F.col("weight"))).collect()}
        assert got == pytest.approx(want, abs=1e-6)
    drawn = {r[0]: r[1] for r in out.where("sampled").groupBy("source").agg(F.sum("n_tokens")).collect()}
    assert drawn["b"] / (drawn["a"] + drawn["b"]) == pytest.approx(0.75, abs=0.06)
    assert {r.sampled for r in out.where("n_tokens = 0").collect()} == {False}
    assert mixing.sample(docs.where("false")).collect() == []


def test_targets_that_no_weights_meet(spark, caplog):
    """Each source has its own language, so different shares of both can't hold together; the last dimension of a round is met."""
    docs = spark.createDataFrame([(i, "a b", "ab"[i % 2], ["en", "fr"][i % 2]) for i in range(40)], "doc_id long, text string, source string, lang string")
    out = mixing.sample(docs, shares={"source": {"a": 1, "b": 1}, "lang": {"en": 1, "fr": 3}})
    assert "not met together" in caplog.text
    by = {r.lang: r.weight for r in out.select("lang", "weight").distinct().collect()}
    assert by["fr"] == pytest.approx(3 * by["en"])


def test_mixing_of_one_cell_takes_all(spark):
    docs = spark.createDataFrame([(i, "a b", "s", "en") for i in range(20)], "doc_id long, text string, source string, lang string")
    assert {(r.probability, r.sampled) for r in mixing.sample(docs).collect()} == {(1.0, True)}


def test_pipeline_stages(spark, tmp_path):
    rng = random.Random(9)
    passage = " ".join(f"bench{rng.randrange(99)}" for _ in range(20))
    body = lambda lang, n=120: " ".join(rng.choice(LANGS[lang]) + rng.choice(["", "k", "o"]) + str(rng.randrange(50)) for _ in range(n))
    rows = [(i, body(lang), lang, f"s{i % 3}") for i in range(120) for lang in [rng.choice(list(LANGS))]]
    near = rows[7][1]
    rows += [(200, near, "aa", "s0"), (201, near.replace(" ", "  "), "aa", "s0"), (7, near, rows[7][2], "s1"), (202, None, "aa", "s0"), (203, "12 34", "aa", "s0"),
             (204, body("zz") + " " + passage.upper() + " " + body("zz"), "zz", "s1"), (205, body("aa") + " mail me@x.org " + body("aa"), "aa", None)]
    docs = spark.createDataFrame([(*r, 5 if r[1] is None else len(r[1])) for r in rows], "doc_id long, text string, lang string, source string, n_chars long")
    sf = str(tmp_path)
    docs.write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame([(1, passage)], "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
    assert len(corpus_pipeline.STAGES) == 5
    state, kept = docs, {}
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id for r in state.select("doc_id").collect()}
        state = stage(spark, state.withColumn("extra", F.lit(1)) if name != "mixing" else state, sf)
        state.write.parquet(f"{sf}/{name}")
        state = spark.read.parquet(f"{sf}/{name}")
        kept[name] = before - {r.doc_id for r in state.select("doc_id").collect()}
        assert name == "mixing" or state.columns == corpus_pipeline.COLUMNS
    assert kept["language"] == {202, 203} and kept["near_duplicates"] == {200, 201} and kept["decontamination"] == {204} and kept["pii"] == set()
    redacted = {r.doc_id: r for r in spark.read.parquet(f"{sf}/pii").collect()}
    assert len(redacted) == spark.read.parquet(f"{sf}/pii").count() == 121
    assert " mail [EMAIL] " in redacted[205].text and redacted[205].n_chars == len(redacted[205].text)
    drawn = spark.read.parquet(f"{sf}/mixing").collect()
    assert {r.doc_id for r in drawn} <= set(redacted) and drawn


def test_pipeline_of_nothing(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


@pytest.mark.parametrize("name", [n for n, q in corpus_pipeline.REGISTRY.items() if q.sql])
def test_equals_sql(spark, name):
    assert compare(spark, connect(SF), corpus_pipeline.REGISTRY[name], SF) is None


@pytest.mark.parametrize("name", [n for n, q in corpus_pipeline.REGISTRY.items() if not q.sql])
def test_runs(spark, name):
    df = corpus_pipeline.REGISTRY[name].run(spark, SF)
    assert len(set(df.columns)) == len(df.columns) and df.count() > 0
