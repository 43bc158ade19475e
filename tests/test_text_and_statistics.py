"""Sentiment with modifiers, transliteration, the W test, and files whose form is found."""

import random
import unicodedata
from statistics import NormalDist

import numpy as np
import pytest
from pyspark.sql import functions as F

from featloom.functions import text as ft
from featloom.operators import profile
from featloom.operators import text_features as tf
from featloom.sources import sniff

# Sentiment

LEXICON = [("good", 0.7, 0.6, None), ("bad", -0.7, 0.6, 1.0), ("great", 0.8, 0.75, None), ("very", 0.2, 0.3, 1.3), ("slightly", -0.1, 0.1, 0.5), ("odd", None, 0.4, None)]


def plain_sentiment(text, negations, reach=3):
    words = (text or "").lower().replace("n't", " n't").split()
    rated = {w: (p or 0.0, s, k or 1.0) for w, p, s, k in LEXICON}
    found, turned, i = [], None, 0
    for i, w in enumerate(words):
        if w in negations:
            turned = i
            continue
        if w not in rated:
            continue
        p, s, k = rated[w]
        follows = i + 1 < len(words) and words[i + 1] in rated and words[i + 1] not in negations
        scale, j = 1.0, i - 1
        while j >= 0 and words[j] in rated and words[j] not in negations and rated[words[j]][2] != 1:
            scale, j = scale * rated[words[j]][2], j - 1
        if not (k != 1 and follows):
            clip = lambda x: max(-1.0, min(1.0, x * scale))
            factor = -0.5 if turned is not None and i - turned <= reach else 1.0
            found.append((clip(p) * factor, clip(s)))
        if k == 1:
            turned = None
    return tuple(sum(x) / len(found) for x in zip(*found)) if found else (0.0, 0.0)


def scores(spark, texts, **options):
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    lexicon = spark.createDataFrame(LEXICON, "word string, polarity double, subjectivity double, intensity double")
    return {r.id: (r[1], r[2]) for r in tf.modified_sentiment(df, "id", "text", lexicon, **options).collect()}


def test_modifiers_and_negations(spark):
    texts = ["good", "very good", "not good", "not very good", "very very good", "very", "good very", "not a b good", "not a b c good", "not good good",
             "it isn't good", "not", "", None, "plain words", "not very", "very not good", "slightly bad great", "Good BAD", "odd"]
    got = scores(spark, texts)
    assert got[3] == pytest.approx((0.7 * 1.3 * -0.5, 0.78)) and got[4][0] == pytest.approx(1.0) and got[7][0] == pytest.approx(-0.35)
    assert got[8][0] == pytest.approx(0.7) and got[9][0] == pytest.approx((-0.35 + 0.7) / 2) and got[10][0] == pytest.approx(-0.35) and got[13] == (0, 0)
    for i, t in enumerate(texts):
        assert got[i] == pytest.approx(plain_sentiment(t, tf.NEGATIONS)), t


def test_modifiers_in_long_random_texts(spark):
    rng = random.Random(4)
    words = ["good", "bad", "great", "very", "slightly", "not", "never", "x", "yy", "odd"]
    texts = [" ".join(rng.choice(words) for _ in range(rng.choice([3, 10, 40, 2000]))) for _ in range(60)]
    got = scores(spark, texts)
    assert all(got[i] == pytest.approx(plain_sentiment(t, tf.NEGATIONS)) for i, t in enumerate(texts))
    none = scores(spark, texts, negations=())
    assert all(none[i] == pytest.approx(plain_sentiment(t, ())) for i, t in enumerate(texts))


# Word vectors


def test_related_words_have_near_vectors(spark):
    rng = random.Random(5)
    groups = [[f"sea{i}" for i in range(5)], [f"oven{i}" for i in range(5)], [f"court{i}" for i in range(5)]]
    texts = [" ".join(rng.choice(rng.choice([g, g, g, rng.choice(groups)])) for _ in range(12)) for _ in range(600) for g in [rng.choice(groups)]]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(9000, None), (9001, "")], "id int, text string")
    fitted = tf.fit_word_vectors(df.repartition(5), "text", size=8)
    vectors = {r.term: np.array([r[f"z{i}"] for i in range(fitted.size)]) for r in fitted.words.collect()}
    cos = lambda a, b: vectors[a] @ vectors[b] / np.linalg.norm(vectors[a]) / np.linalg.norm(vectors[b])
    for g in groups:
        inside = min(cos(g[0], w) for w in g[1:])
        assert all(inside > cos(g[0], w) for other in groups if other is not g for w in other)
    again = tf.fit_word_vectors(df.repartition(2), "text", size=8)
    other = {r.term: np.array([r[f"z{i}"] for i in range(again.size)]) for r in again.words.collect()}
    assert all(np.allclose(vectors[w], other[w], atol=1e-8) for w in vectors)
    out = {r.id: r.emb_vec.toArray() for r in fitted.transform(df).where("id IN (0, 9000, 9001)").collect()}
    assert np.allclose(out[0], np.mean([vectors[w] for w in texts[0].split()], axis=0)) and not out[9000].any() and not out[9001].any()


def test_pairs_of_long_texts(spark, monkeypatch):
    monkeypatch.setattr(tf, "CHUNK", 7)
    rng = random.Random(6)
    texts = [" ".join(rng.choice("abcde") for _ in range(n)) for n in (0, 1, 2, 6, 7, 8, 13, 14, 15, 100)]
    df = spark.createDataFrame([(t, 1 + i % 2) for i, t in enumerate(texts)], "text string, weight int")
    want = {}
    for i, t in enumerate(texts):
        w = t.split()
        for a in range(len(w)):
            for b in range(a + 1, min(a + 4, len(w))):
                for pair in ((w[a], w[b]), (w[b], w[a])):
                    want[pair] = want.get(pair, 0) + 1 + i % 2
    assert {(r.a, r.b): r.n for r in tf.word_pairs(df, 3).collect()} == want


# Transliteration


def test_letters_are_kept(spark):
    texts = {
        "Straße": "Strasse", "Łódź Øre Æon œuvre Þór": "Lodz Ore AEon oeuvre Thor".replace("AEon", "Aeon"), "Жуков Щёлково Юлия": "Zhukov Shchelkovo Yuliya",
        "Ψυχή Θεός φως": "Psukhe Theos fos".replace("fos", "phos"), "ひらがな カタカナ": "hiragana katakana", "서울": "seoul", "ﬁn": "fin", "naïve café": "naive cafe",
        "plain": "plain", "漢字": "", "a漢ßb": "assb", "שלום": "shlvm",
    }
    df = spark.createDataFrame([(k, v) for k, v in texts.items()] + [(None, None), ("", "")], "t string, want string")
    assert all(r.got == r.want for r in df.select("want", ft.transliterate("t").alias("got")).collect())


def test_every_letter_of_a_covered_script_has_a_sound():
    table = ft._romanizations()
    signs = {"ъ", "ь", "Ъ", "Ь", "ء"}
    for script in ("GREEK SMALL LETTER", "GREEK CAPITAL LETTER", "CYRILLIC SMALL LETTER", "CYRILLIC CAPITAL LETTER", "HEBREW LETTER", "HIRAGANA LETTER", "KATAKANA LETTER"):
        letters = [chr(p) for p in range(0x80, 0x10000) if unicodedata.name(chr(p), "").startswith(script)]
        assert letters and all(c in table for c in letters if c not in signs)
    assert all(v.isascii() and 0 < len(v) <= ft.LETTERS for v in table.values())


def test_long_mixed_text_is_translated_in_place(spark):
    rng = random.Random(2)
    letters = "abc ßœЖщλか한é漢\n." + "x" * 5
    text = "".join(rng.choice(letters) for _ in range(20_000))
    table = ft._romanizations()
    want = "".join(c if c.isascii() else table.get(c, "") for c in text)
    assert spark.createDataFrame([(text,)], "t string").select(ft.transliterate("t")).first()[0] == want


# W test

FIRST = [0.11, 7.87, 4.61, 10.14, 7.95, 3.14, 0.46, 4.43, 0.21, 4.75, 0.71, 1.52, 3.24, 0.93, 0.42, 4.97, 9.53, 4.55, 0.47, 6.66]
SECOND = [1.36, 1.14, 2.92, 2.55, 1.46, 1.06, 5.27, -1.11, 3.48, 1.10, 0.88, -0.51, 1.46, 0.52, 6.20, 1.69, 0.08, 3.67, 2.81, 3.49]
WEIGHTS = [148, 154, 158, 160, 161, 162, 166, 170, 182, 195, 236]


def test_w_of_published_samples(spark):
    rows = [(name, float(v)) for name, sample in (("first", FIRST), ("second", SECOND), ("weights", WEIGHTS), ("two", [1, 2]), ("same", [3] * 6), ("three", [1, 2, 4])) for v in sample]
    got = {r.column: r for r in profile.w_statistics(spark.createDataFrame(rows, "column string, value double").repartition(4)).collect()}
    assert (got["first"].w, got["first"].p_value) == pytest.approx((0.900473, 0.0420897), abs=2e-6)
    assert (got["second"].w, got["second"].p_value) == pytest.approx((0.9590270, 0.52460), abs=5e-5)
    assert (got["weights"].w, got["weights"].p_value) == pytest.approx((0.78881, 0.006704), abs=2e-5)
    assert "two" not in got and (got["same"].w, got["same"].p_value) == (1.0, 1.0)
    assert got["three"].w == pytest.approx(0.964286, abs=1e-5) and got["three"].p_value == pytest.approx(0.636886, abs=1e-4)


def test_normal_quantile_and_tail(spark):
    p = [1e-8, 1e-4, 0.01, 0.0749, 0.0751, 0.3, 0.5, 0.9, 0.99999]
    rows = spark.createDataFrame([(x,) for x in p], "p double").select("p", profile.normal_quantile(F.col("p")).alias("z")).collect()
    assert [r.z for r in rows] == pytest.approx([NormalDist().inv_cdf(x) for x in p], abs=1e-12)
    z = [-3.0, -0.5, 0.0, 1.0, 4.0]
    tails = spark.createDataFrame([(x,) for x in z], "z double").select(profile.normal_tail(F.col("z"))).collect()
    assert [r[0] for r in tails] == pytest.approx([1 - NormalDist().cdf(x) for x in z], abs=1e-7)


def test_the_test_follows_the_number_of_values(spark, monkeypatch):
    monkeypatch.setattr(profile, "W_ROWS", 300)
    rng = np.random.default_rng(3)
    few = [(float(x), None) for x in rng.standard_normal(200)]
    many = [(None, float(x)) for x in rng.standard_normal(400)]
    got = {r.column: r for r in profile.normality(spark.createDataFrame(few + many, "few double, many double"), ["few", "many"]).collect()}
    assert got["few"].w > 0.98 and got["few"].is_normal and got["many"].w is None and got["many"].p_value == pytest.approx(np.exp(-got["many"].k2 / 2))


# Files


@pytest.mark.parametrize("text, want", [
    ("a,b\n1,2\n3,4\n", (",", '"', True, ("a", "b"))),
    ("a;b;c\n1;2,5;x\n3;4,1;y\n", (";", '"', True, ("a", "b", "c"))),
    ("1\t2\n3\t4\n", ("\t", '"', False, ("column0", "column1"))),
    ("id|note\n1|'x|y'\n2|'it, is'\n", ("|", "'", True, ("id", "note"))),
    ('id,note\n1,"x;y;z"\n2,"p;q;r"\n', (",", '"', True, ("id", "note"))),
    (",x\n0,5\n1,6\n", (",", '"', True, ("_c0", "x"))),
    ("name,kind\nbob,cat\nann,dog\n", (",", '"', True, ("name", "kind"))),
    ("only,header\n", (",", '"', True, ("only", "header"))),
    ("", (",", '"', True, ())),
])
def test_dialects(text, want):
    d = sniff.sniff(text)
    assert (d.delimiter, d.quote, d.header, d.columns) == want


def test_types_meet():
    assert sniff.merge(["bigint", "double"]) == "double" and sniff.merge(["date", "timestamp", "date"]) == "timestamp"
    assert sniff.merge(["boolean", "bigint"]) == "string" and sniff.merge([None]) == "string" and sniff.merge(["bigint", None]) == "bigint"


def test_mixed_shards(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,when,ok,size,name\n1,2024-01-02,true,3,\"x, y\"\n2,2024-01-03,FALSE,NA,b\n")
    (tmp_path / "b.csv").write_text("id;size;name;when\n3;2.5;c;2024-02-01\n4;;d;\n")
    (tmp_path / "c.csv").write_text("5\t2024-03-01\ttrue\t7\te\n6\t2024-03-02\tfalse\t8\tf\n")
    (tmp_path / "d.csv").write_text("")
    out = sniff.read_csv_sniffed(spark, f"{tmp_path}/*.csv")
    assert dict(out.dtypes) == {"id": "bigint", "when": "date", "ok": "boolean", "size": "double", "name": "string"}
    got = {r.id: (str(r.when), r.ok, r["size"], r.name) for r in out.collect()}
    assert got == {1: ("2024-01-02", True, 3.0, "x, y"), 2: ("2024-01-03", False, None, "b"), 3: ("2024-02-01", None, 2.5, "c"), 4: ("None", None, None, "d"),
                   5: ("2024-03-01", True, 7.0, "e"), 6: ("2024-03-02", False, 8.0, "f")}


def test_a_late_value_widens_its_column(spark, tmp_path):
    """Types come from all rows: the last of them is far beyond the sample."""
    (tmp_path / "a.csv").write_text("k,v\n" + "".join(f"{i},{i}\n" for i in range(30_000)) + "30000,late\n")
    out = sniff.read_csv_sniffed(spark, f"{tmp_path}/a.csv")
    assert dict(out.dtypes) == {"k": "bigint", "v": "string"} and out.count() == 30_001
