"""Source divergence, license notices and filter interactions against plain versions."""

import random
import re
from collections import Counter, defaultdict
from itertools import permutations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from featloom.llm import divergence, filter_audit, licenses

lower = lambda t: re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
DOCS = "doc_id long, text string, lang string, source string, part string, term string, bits int"


def frame(spark, rows):
    """Documents with columns whose names the operators use themselves."""
    return spark.createDataFrame([(*r, "x", "y", 7) for r in rows], DOCS).repartition(5)


# Source divergence


def plain_terms(text):
    return re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lower(text))


def plain_audit(rows, least=30, top=50):
    df, counts = defaultdict(Counter), defaultdict(Counter)
    for _, text, lang, source in rows:
        words = plain_terms(text)
        counts[lang or "", source or ""].update(words)
        df[lang or ""].update(set(words))
    out = []
    kept = {lang: {w for w, n in c.items() if n >= least} for lang, c in df.items()}
    whole = {lang: sum((counts[g] for g in counts if g[0] == lang), Counter()) for lang in kept}

    def shares(count, terms):
        total = sum(count[w] for w in terms) + 5 * len(terms)
        return {w: 1 + 10**9 * (count[w] + 5) // total for w in terms}

    of = {g: shares(c, kept[g[0]]) for g, c in counts.items()}
    for (lang, source), p in of.items():
        q = shares(whole[lang], kept[lang])
        pair = [(o, sum(abs(p[w] - of[lang, o][w]) for w in p)) for other, o in of if other == lang and o != source]
        term = [(w, p[w] - q[w]) for w in p if counts[lang, source][w] and p[w] > q[w]]
        for part, found in (("pair", pair), ("term", term)):
            found.sort(key=lambda x: (-x[1], x[0].encode()))
            out += [(lang, source, part, item, value, k + 1) for k, (item, value) in enumerate(found) if part == "pair" or k < top]
    return sorted(out)


@pytest.mark.parametrize("words", [
    [], [""], ["a"], ["a", "a", "ab", "b"], ["x" * n for n in range(1, 40)] * 3, ["prefixed" + "y" * (k % 5) for k in range(50)],
    ["z" * 300 + str(k % 3) for k in range(30)] + ["z" * 64, "z" * 64, "z" * 65, "z" * 63], ["é", "èa", "漢字" * 9, "漢字" * 9],
])
def test_sorted_pointers(words):
    rng = random.Random(4)
    words = words[:]
    rng.shuffle(words)
    text = "1".join(words)
    found = divergence.count_words(pa.array([text, None, text.upper() if text.isascii() else text]), np.array([1, 0, 0]))
    want = Counter(plain_terms(text))
    assert sorted(zip(*[found[c].to_pylist() for c in ("group", "term", "df", "count")])) == sorted((g, w, 1, n) for w, n in want.items() for g in (0, 1))
    body = divergence.FOLD[np.frombuffer(text.encode(), np.uint8)] if text else np.empty(0, np.uint8)
    starts, lengths = divergence.pointers(body, np.array([len(body)]))
    order, new = divergence.sort_words(body, starts, lengths)
    sorted_words = [body.tobytes()[starts[o] : starts[o] + lengths[o]] for o in order]
    assert sorted_words == sorted(sorted_words)
    assert new.tolist() == [k == 0 or w != sorted_words[k - 1] for k, w in enumerate(sorted_words)]


def test_words_end_with_their_text():
    found = divergence.count_words(pa.array(["ab", "cd", "", "é", "e"]), np.array([0, 0, 0, 0, 0]))
    assert found["term"].to_pylist() == ["ab", "cd", "e", "é"] and found["df"].to_pylist() == [1] * 4


@pytest.mark.parametrize("tile", [(2048, 256), (3, 2)])
def test_divergence(spark, monkeypatch, tile):
    monkeypatch.setattr(divergence, "TERMS", tile[0])
    monkeypatch.setattr(divergence, "SOURCES", tile[1])
    rng = random.Random(6)
    word = lambda k: rng.choice(["the", "of", "Über", "naïve", "w" * 20 + "a", "w" * 20 + "b", f"v{rng.randrange(12)}x", "q" * k])
    rows = [(i, " ".join(word(k % 7) for _ in range(rng.randrange(25))), rng.choice(["en", "en", "de", None]), rng.choice(["a", "b", "c", "é", None, "s"]))
            for k, i in enumerate(range(400))]
    rows += [(7, "the " * 3000, "en", "a"), (8, None, "en", "never"), (None, "", "fr", "a"), (9, "seul", "fr", "b"), (7, "the " * 3000, "en", "a"), (10, "one", "it", "x")]
    got = sorted(tuple(r) for r in divergence.audit(frame(spark, rows)).collect())
    assert got == plain_audit(rows) and {r[0] for r in got} == {"", "en", "de", "fr"}
    assert [r[4] for r in got if r[0] == "fr"] == [0, 0]


def test_divergence_of_nothing(spark):
    assert divergence.audit(frame(spark, [(1, "a", "en", "s")]).where("false")).collect() == []


def test_shares_are_exact(spark):
    rows = [(0, 0, 0), (1, 3, 2), (10**12, 10**13, 10**6), (10**13, 10**13, 1), (7, 7 * 10**12, 3 * 10**9)]
    got = spark.createDataFrame(rows, "c long, t long, v long").select(divergence.share("c", "t", "v").alias("p"), "*").collect()
    assert [r.p for r in got] == [1 + 10**9 * (c + 5) // max(1, t + 5 * v) for c, t, v in rows]


# License notices


def plain_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))


def plain_scan(text, templates, phrases, threshold):
    w = plain_words(text)
    spots = sorted((i, label) for p, label in phrases.items() for i in range(len(w)) if w[i : i + len(p.split())] == p.split())
    blocks = set()
    for label, body in templates:
        t = plain_words(body)
        if not t:
            continue
        width = 8
        while width < len(t):
            width *= 2
        for s in range(0, max(len(w) - width, 1), width):
            shared = len(set(t) & set(w[s : s + 2 * width]))
            if shared and shared >= threshold * len(set(t)) - 1e-9:
                blocks.add((s, min(2 * width, len(w) - s), label, shared / len(set(t))))
    labels = sorted({label for _, label in spots} | {b[2] for b in blocks})
    return len(w), spots, sorted(blocks), sorted({label for _, label in spots}), labels, 1.0 if spots else max([b[3] for b in blocks], default=0.0)


@pytest.mark.parametrize("threshold", [0.5, 0.8, 0.9, 1.0])
def test_licenses(spark, threshold):
    rng = random.Random(8)
    templates = [*licenses.TEMPLATES, ("none", ""), ("one", "Über"), ("x", "aa bb cc dd ee ff gg hh ii jj kk ll mm nn oo pp qq rr"), ("x", "ab ab ab")]
    phrases = {**licenses.PHRASES, "ab ab": "twice"}
    noise = lambda n: [rng.choice(["the", "of", "and", "ab", "any", "software", "w%d" % rng.randrange(99)]) for _ in range(n)]
    rows = []
    for i in range(150):
        words = noise(rng.randrange(60))
        for _ in range(rng.randrange(3)):
            body = plain_words(rng.choice(templates)[1])
            words += [w for w in body if rng.random() > rng.choice([0, 0.05, 0.3])] + noise(rng.randrange(40))
        rows.append((i, rng.choice([" ", "\n", ", "]).join(w.upper() if rng.random() < 0.1 else w for w in words), "en", "s"))
    rows += [(200, None, "en", "s"), (201, "", "en", "s"), (202, "the license " * 20000, "en", None), (203, "ab " * 5, None, "s"), (203, "ab " * 5, None, "s"), (None, "Über", "en", "s"),
             (204, "under-the MIT\nlicense", "en", "s"), (205, "notunder the mit licenses", "en", "s")]
    out = licenses.scan(frame(spark, rows), templates=templates, phrases=phrases, threshold=threshold).collect()
    assert len(out) == len(rows)
    plain = lambda r: (r.n_words, [tuple(p) for p in r.places], sorted((b.first, b.length, b.label, b.score) for b in r.blocks), r.base_labels, r.labels, r.score)
    got = sorted(((r.doc_id, *plain(r)) for r in out), key=str)
    want = sorted(((i, *plain_scan(t, templates, phrases, threshold)) for i, t, _, _ in rows), key=str)
    assert got == want and sum(bool(r[3]) for r in want) > 40


def test_licenses_of_nothing(spark):
    docs = frame(spark, [(1, "under the MIT license", "en", "s")])
    assert licenses.scan(docs.where("false")).collect() == []
    [row] = licenses.scan(docs, templates=[]).collect()
    assert (row.labels, row.score, [tuple(p) for p in row.places]) == (["mit"], 1.0, [(0, "mit")])
    with pytest.raises(ValueError):
        licenses.scan(docs, threshold=0)


# Filter interactions


def plain_filters(rows, labels):
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    least = {}
    for i, text, _, _ in rows:
        if i is not None:
            least[text or ""] = min(i, least.get(text or "", i))
    fails = []
    for i, text, _, source in rows:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        bad = {"A"} if len(words) < 200 else set()
        bad |= {"B"} if 100 * len(set(words)) < 50 * len(words) else set()
        bad |= {"C"} if 100 * len(re.findall("[A-Z]", text)) > 2 * len(text) else set()
        bad |= {"D"} if re.search("[#$%&*|]", text) else set()
        bad |= {"E"} if i is not None and least[text] < i else set()
        fails.append((source or "", i, bad))
    out = []
    for part in {f[0] for f in fails}:
        mine = [(i, bad) for p, i, bad in fails if p == part]
        total = Counter()
        steps = []
        for order in permutations("ABCDE"):
            left = mine
            for s, f in enumerate(order):
                gone = [x for x in left if f in x[1]]
                left = [x for x in left if f not in x[1]]
                total[f] += len(gone)
                steps.append((part, "".join(order), s + 1, len(left), len(gone), sum(f in b for _, b in mine) - len(gone), sum(b == {f} for _, b in mine),
                              sum(i in good for i, _ in gone), sum(i in toxic for i, _ in gone), f))
        out += [(*s[:-1], total[s[-1]]) for s in steps]
    return sorted(out)


@pytest.mark.parametrize("hot", [1000, 1])
def test_filter_audit(spark, monkeypatch, hot):
    monkeypatch.setattr(filter_audit, "HOT", hot)
    rng = random.Random(3)
    prose = lambda n: " ".join(f"w{rng.randrange(400)}" for _ in range(n))
    texts = [prose(250), prose(30), "same " * 260, "UP " * 90, "a #b", "", None, prose(300) + " |", "Ünï\x1fcode " * 220]
    rows = [(rng.randrange(80), rng.choice(texts) if rng.random() < 0.6 else prose(rng.choice([50, 210])), "en", rng.choice(["a", "a", "b", None, ""])) for _ in range(160)]
    rows += [(None, texts[0], "en", "a"), (None, texts[1], "en", "b"), (5, texts[0], "en", "a"), (5, texts[0], "en", "a"), (5, texts[0], "en", "b"), (900, "only null holds it", "en", "c"), (None, "only null holds it", "en", "c")]
    rows += [(1000 + k, texts[0], "en", "hot") for k in range(120)]
    labels = [(k, rng.choice([0, 1, None]), rng.choice([0, 1])) for k in range(60)] + [(3, 1, 1), (3, 0, 0), (None, 1, 1), (1005, 1, 1)]
    known = spark.createDataFrame([(*r, 1) for r in labels], "doc_id long, quality int, toxic int, part int")
    got = sorted(tuple(r) for r in filter_audit.audit(frame(spark, rows), known).collect())
    want = plain_filters(rows, labels)
    assert got == want and len(want) == 600 * len({r[3] or "" for r in rows})
    assert filter_audit.audit(frame(spark, rows).where("false"), known).collect() == []
    none = filter_audit.audit(frame(spark, rows[:3]), known.where("false"))
    assert none.agg(F.sum("good_lost") + F.sum("toxic_lost")).head()[0] == 0


def test_other_filters(spark):
    rows = [(1, "a", "en", "s"), (2, "a", "en", "s"), (3, "bbb", "en", "s")]
    known = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    out = filter_audit.audit(frame(spark, rows), known, conditions={"L": lambda text, words: F.length(text) > 2}, duplicate="X")
    assert sorted((r.filter_order, r.step, r.kept, r.removed) for r in out.collect()) == [("LX", 1, 2, 1), ("LX", 2, 1, 1), ("XL", 1, 2, 1), ("XL", 2, 1, 1)]
    with pytest.raises(ValueError):
        filter_audit.audit(frame(spark, rows), known, duplicate="EE")
