"""SimHash groups, embedding groups and components against all pairs."""

import hashlib
import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from featloom.llm import embedding_dedup, simhash
from featloom.llm.graph import components


def closure(nodes, links):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


@pytest.mark.parametrize("links", [
    [], [(1, 1), (None, 2)], [(i, i + 1) for i in range(300)], [(7, i) for i in range(500)], [(random.Random(3).randrange(400), i) for i in range(400)],
    [(i, i + 50) for i in range(0, 1000, 3)],
])
def test_components(spark, links):
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    real = [(a, b) for a, b in links if None not in (a, b) and a != b]
    assert got == closure({x for p in real for x in p}, real)


def plain_print(text):
    import re

    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints():
    for text in [None, "", " \t\r\n", "One", "ONE two", "Ä b c É d", "a b c d\x0be\x0cf " * 50, "\x1fa b", " x  y z " * 30000]:
        assert simhash.fingerprint_of(text) == plain_print(text)


@pytest.mark.parametrize("n", [1, 64, 65, 400])
@pytest.mark.parametrize("radius", [0, 1, 3, 4])
def test_bit_sliced_comparison(n, radius):
    rng = np.random.default_rng(n)
    prints = rng.integers(0, 2**63, max(1, n // 4), dtype=np.uint64)[rng.integers(0, max(1, n // 4), n)]
    for _ in range(4):
        prints = prints ^ np.where(rng.random(n) < 0.6, np.uint64(1) << rng.integers(0, 64, n).astype(np.uint64), np.uint64(0))
    starts = np.repeat([0, n // 3], [n // 3, n - n // 3])
    got = set(zip(*map(np.ndarray.tolist, simhash.linked(prints, starts, radius))))
    assert got == {(i, j) for i in range(n) for j in range(starts[i], i) if (int(prints[i]) ^ int(prints[j])).bit_count() <= radius}


def test_links_over_hot_buckets(spark):
    rng = random.Random(1)
    centre = rng.getrandbits(64)
    prints = {centre ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for _ in range(400)} | {rng.getrandbits(64) for _ in range(300)}
    prints |= {p ^ 0b111 << 40 for p in list(prints)[:50]}
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    df = spark.createDataFrame([(p,) for p in signed], "print long")
    links = [(a, b) for i, a in enumerate(signed) for b in signed[:i] if ((a ^ b) & (1 << 64) - 1).bit_count() <= 3]
    want = closure(signed, links)
    for block in (64, 2048):
        found = closure(signed, [(r.a, r.b) for r in simhash.near_links(df, "print", block=block).collect()])
        assert found == want


def test_near_duplicate_documents(spark):
    base = " ".join(f"word{i * 7919 % 1000}" for i in range(300))
    texts = [base, base.replace("word5 ", "other "), base, "", None, " \n", "alone here now", base.upper(), "a", "A", base + " tail"]
    rows = [(i, t, 0) for i, t in enumerate(texts)] + [(None, base, 0), (3, "", 0)]
    got = simhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string, print long")).collect()
    prints = {(i if i is not None else "none"): plain_print(t) for i, t, _ in rows}
    links = [(a, b) for a in prints for b in prints if a != "none" and b != "none" and a < b and (prints[a] ^ prints[b]).bit_count() <= 3]
    want = closure([p for p in prints if p != "none"], links)
    assert len(got) == len(rows)
    for r in got:
        assert r.print & (1 << 64) - 1 == prints["none" if r.doc_id is None else r.doc_id]
        assert r.component == (0 if r.doc_id is None else want[r.doc_id])
    assert simhash.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def cosine(a, b):
    a, b = np.array(a, float), np.array(b, float)
    return a @ b / np.sqrt((a @ a) * (b @ b))


def test_embeddings(spark):
    rng = np.random.default_rng(2)
    centres = rng.standard_normal((6, 16))
    vectors = [[float(x) for x in centres[i % 6] + rng.standard_normal(16) * (0.1 if i % 3 else 0.5)] for i in range(260)]
    hub = [[float(x) for x in centres[0] + rng.standard_normal(16) * 0.05] for _ in range(200)]
    rows = [(i, v, i % 2) for i, v in enumerate(vectors)] + [(1000 + i, v, 0) for i, v in enumerate(hub)] + [(2000 + i, vectors[4], 0) for i in range(150)]
    odd = [
        (3000, None, 0), (3001, [], 0), (3002, [0.0] * 16, 0), (3003, [None] + vectors[4][1:], 0), (3004, [float("nan")] + vectors[4][1:], 0),
        (3005, [float("inf")] + vectors[4][1:], 0), (3006, vectors[4], None), (3007, vectors[4][:8], 0), (3008, [2 * x for x in vectors[4]], 0), (3009, vectors[4], 5),
    ]
    df = spark.createDataFrame([(*r, "x") for r in rows + odd], "vec_id long, embedding array<double>, label int, component string")
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embedding_dedup.near_duplicates(df, window=64).collect()}
    live = rows + [r for r in odd if r[0] in (3008, 3009, 3007)]
    links = [(a[0], b[0]) for i, a in enumerate(live) for b in live[:i] if a[2] == b[2] and len(a[1]) == len(b[1]) and cosine(a[1], b[1]) >= 0.98]
    root = closure([r[0] for r in rows + odd], links)
    want = {r[0]: (sum(r[0] in p for p in links), root[r[0]], root[r[0]] == r[0]) for r in rows + odd}
    assert got == want


def test_embeddings_without_links(spark):
    schema = "vec_id long, embedding array<float>, label int"
    assert embedding_dedup.near_duplicates(spark.createDataFrame([], schema)).collect() == []
    rows = [(None, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (2, [0.0, 1.0], 1)]
    got = sorted(map(tuple, embedding_dedup.near_duplicates(spark.createDataFrame(rows, schema)).collect()), key=str)
    assert got == sorted([(None, 0, None, False), (1, 1, 1, True), (1, 1, 1, True), (2, 0, 2, True)], key=str)


def test_near_duplicate_stage(spark):
    rng = random.Random(6)
    rows = []
    for k in range(40):
        words = [f"w{rng.randrange(10**6)}" for _ in range(300)]
        for changes in (0, 1, 2, 60):
            copy = list(words)
            for at in rng.sample(range(300), changes):
                copy[at] = f"x{rng.randrange(10**6)}"
            rows.append((len(rows), " ".join(copy)))
    rows += [(None, rows[0][1]), (None, rows[0][1]), (None, "only without an id"), (None, "only without an id"), (7, rows[7][1]), (7, rows[7][1]), (7, rows[90][1]), (900, None), (901, "")]
    rng.shuffle(rows)
    docs = spark.createDataFrame([(*r, "en", "s", 1) for r in rows], "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    prints = [plain_print(t) for _, t in rows]
    links = [(i, j) for i in range(len(rows)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 3]
    groups = closure(range(len(rows)), links)
    want = []
    for g in set(groups.values()):
        mine = [rows[i] for i in range(len(rows)) if groups[i] == g]
        want.append(min(mine, key=lambda r: (r[0] is None, r[0] or 0, r[1] is not None, hashlib.sha256((r[1] or "").encode()).hexdigest())))
    out = corpus_pipeline.drop_near_duplicates(spark, docs, "")
    assert out.columns == corpus_pipeline.COLUMNS
    assert sorted(((r.doc_id, r.text) for r in out.collect()), key=str) == sorted(want, key=str) and len(want) < 120


def test_links_within_a_radius_are_all_found(spark):
    """Every pair of prints within the radius is in one group, whichever bits differ."""
    rng = random.Random(11)
    prints = []
    for _ in range(60):
        p = rng.getrandbits(64)
        prints += [p, p ^ sum(1 << b for b in rng.sample(range(64), rng.choice([1, 2, 3]))), p ^ sum(1 << b for b in rng.sample(range(64), 4))]
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    got = {r.print: r.root for r in simhash.groups(spark.createDataFrame([(p,) for p in signed], "print long")).collect()}
    links = [(i, j) for i in range(len(prints)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 3]
    want = closure(range(len(prints)), links)
    assert all((got[signed[i]] == got[signed[j]]) == (want[i] == want[j]) for i in range(len(prints)) for j in range(i))
