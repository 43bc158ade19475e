"""URL rules, archives and page text."""

import hashlib
import math
import random
import re
import time
from collections import Counter

import pytest
from pyspark.sql import functions as F

from featloom.llm import html_text, url_filter, warc
from featloom.llm.queries import SITE_RULES


def glob_matches(glob, text):
    pattern = "".join(".*" if p == "**" else "[^/]*" if p == "*" else re.escape(p) for p in re.split(r"(\*\*?)", glob))
    return re.fullmatch(pattern, text, re.S) is not None


def test_automaton_equals_regular_expressions():
    rng = random.Random(4)
    pieces = ["a", "b", "/", ".", "*", "**", "ab", "é", "a" * 30]
    globs = ["".join(rng.choice(pieces) for _ in range(rng.randrange(0, 8))) for _ in range(60)]
    texts = ["".join(rng.choice(["a", "b", "/", ".", "é", "a" * 30]) for _ in range(rng.randrange(0, 12))) for _ in range(300)] + ["", "a" * 5000]
    got = url_filter.Automaton(globs).first([t.encode() for t in texts])
    want = [next((k for k, g in enumerate(globs) if glob_matches(g, t)), -1) for t in texts]
    assert got.tolist() == want
    assert url_filter.Automaton([]).first([b"x"]).tolist() == [-1] and url_filter.Automaton(["a"]).first([]).tolist() == []


def test_url_verdicts(spark):
    cases = {
        None: ("", "", None, "block"), "": ("", "", None, "block"), "no-scheme.org/": ("", "", None, "block"), "http://": ("", "", None, "block"),
        "http://EXAMPLE.org/es/x?q#f": ("example.org", "/es/x", "example.org/es/", "block"), "x://a.org?b/": ("a.org", "", None, "allow"),
        "http://org/": ("org", "/", "org/", "allow"), "http://www.example.org/en/12": ("www.example.org", "/en/12", "example.org/en/1", "block"),
        "http://myexample.org/en/1": ("myexample.org", "/en/1", "org/", "allow"), "http://a.com/fr/#x": ("a.com", "/fr/", "com/fr/", "allow"),
        "http://a.com/de/x\ny": ("a.com", "/de/x\ny", "com/de/", "block"), "http://a.net/org/": ("a.net", "/org/", None, "allow"),
        "http://x.ads.net/i": ("x.ads.net", "/i", None, "block"), "http://a.net/" + "p" * 20000 + ".exe": ("a.net", "/" + "p" * 20000 + ".exe", None, "block"),
        "http://ÀB.org/": ("Àb.org", "/", "org/", "allow"), "a://b://c.org/": ("b:", "//c.org/", None, "allow"),
    }
    rows = [(i, u, "old") for i, u in enumerate(cases)] * 2
    got = url_filter.judge(spark.createDataFrame(rows, "page_id long, url string, host string"), SITE_RULES).collect()
    assert len(got) == len(rows)
    want = list(cases.values())
    for r in got:
        assert (r.host, r.path, r.rule, r.verdict) == want[r.page_id]
    assert url_filter.judge(spark.createDataFrame([], "page_id long, url string"), SITE_RULES).collect() == []


@pytest.fixture(scope="module")
def pages(spark):
    long, other = "x" * 200, "é" * 50
    rows = [(5, "u5", long), (3, "u3", long), (9, None, long), (4, "a%\r\nb", other), (2, "u2", other), (1, "u1", None), (7, "u7", ""), (8, "u8", "short"),
            (10, "u10", "short"), (None, "n", long), (11, "big", "y" * 3_000_000), (3, "again", long), (12, "u", "\r\n\r\nWARC/1.1 é\x00" * 20)]
    return spark.createDataFrame([(*r, "z") for r in rows], "page_id long, url string, html string, digest string").repartition(3)


def test_archive_round_trip(spark, pages, tmp_path):
    index = warc.write(pages, str(tmp_path / "archive"))
    back = {}
    for r in warc.read(index).collect():
        back.setdefault(r.id, []).append(r)
    assert sum(map(len, back.values())) == pages.count() == index.count()
    for p in pages.collect():
        raw = (p.html or "").encode()
        for r in back[p.page_id]:
            assert (r.payload_bytes, r.digest) == (len(raw), hashlib.sha256(raw).hexdigest())
            assert r.type == "revisit" or bytes(r.payload) == raw
    kinds = {i: [(r.type, r.refers_to) for r in rs] for i, rs in back.items()}
    assert kinds[3] == [("response", None)] * 2 and kinds[5] == kinds[9] == kinds[None] == [("revisit", 3)]
    assert kinds[2] == [("response", None)] and kinds[4] == [("revisit", 2)]
    assert all(kinds[i] == [("response", None)] for i in (1, 7, 8, 10, 11, 12))
    assert {r.url for r in back[4]} == {"a%\r\nb"} and back[9][0].url is None


@pytest.mark.parametrize("gap, chunk", [(0, 1), (0, 300), (10, 8 << 20), (1 << 20, 8 << 20)])
def test_selected_records(pages, tmp_path, gap, chunk):
    index = warc.write(pages, str(tmp_path / "archive"))
    some = warc.read(index.where("id % 2 = 1"), gap=gap, chunk=chunk).select("id").collect()
    assert sorted(r.id for r in some) == [1, 3, 3, 5, 7, 9, 11]
    assert warc.read(index.where("false")).collect() == []


def test_damaged_record_raises():
    good = warc.record(1, "u", "response", None, hashlib.sha256(b"abc").hexdigest(), b"abc")
    assert warc.parse(good)[6] == b"abc"
    with pytest.raises(ValueError):
        warc.parse(warc.record(1, "u", "response", None, hashlib.sha256(b"abd").hexdigest(), b"abc"))


PAGE = (
    "<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>x='</p><p>no'</script></head><body class='has-sidebar'>"
    "<header><h1>Site</h1></header><nav><ul><li>Menu</ul></nav><div class=cookie-notice>Accept</div><!-- <p>c</p> -->"
    "<article class='post'><h1>Head&amp;line</h1><p><b>Bold</b>ed&nbsp;text<br>next\n line<p>Open <i>x</i><form><input><button>Go</button></form>"
    "<div class='ad'>Buy</div><table><tr><td>1<td>2</table><p data-x='<a>'>5 < 6 &lt; 7<section id=comments><p>First!</p></section></article>"
    "<aside>Side</aside><footer>Foot</footer></body></html>"
)


def test_page_text():
    assert html_text.main_text(PAGE) == "Head&line Bolded text next line Open x 1 2 5 < 6 < 7"
    assert html_text.main_text(None) == html_text.main_text("") == html_text.main_text("<script>x") == html_text.main_text("<!-- a") == ""
    assert html_text.main_text("plain <unclosed") == "plain <unclosed" and html_text.main_text("a</p></div>b") == "a b"
    assert html_text.main_text("<p>" * 5000 + "deep" + "<div>" * 5000) == "deep"
    assert html_text.main_text("<div role=navigation>n</div><main><p>m</main>x") == "m"


def test_site_style_tree(spark):
    rows = []
    for i in range(40):
        page = f"<div class=top><p>Always the same slogan</p></div><div class=story><p>Story {i} {i * i}</p><p>shared line</p></div><div class=end>Imprint</div>"
        rows.append((i, "http://site.org/a", page, "x"))
    rows += [(100, "http://one.org/", rows[0][2], "x"), (101, None, None, "x"), (102, "http://site.org/", "<article><p>shared line</p></article>", "x")] + [rows[0]]
    got = {r.page_id: (r.text, r.n_chars) for r in html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string, paths string")).collect()}
    assert got[3] == ("Story 3 9 shared line", 21)
    assert got[100][0] == "Always the same slogan Story 0 0 shared line Imprint" and got[101] == ("", 0) and got[102][0] == "shared line"
    out = html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string, paths string"))
    assert out.count() == len(rows) and out.where(F.length("text") != F.col("n_chars")).count() == 0
    assert html_text.extract(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []


def test_style_tree_inside_articles(spark):
    rows, body = [], "<article><h1>Title {0}</h1><p>Story {0} of its own</p><p class=motto>Read us daily</p></article><div>Outside {0}</div>"
    for i in range(3000):
        page = body.format(i) if i >= 25 else body.format(i).replace("class=motto", "class=claim")
        rows.append((i, "http://hot.org/a", page))
    rows += [(5000 + i, "http://copies.org/", body.format(7)) for i in range(60)]
    got = {r.page_id: r.text for r in html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)).collect()}
    # Below 1% of the host's pages too; copies of one page are no evidence against its text.
    assert {i: got[i] for i in range(3000)} == {i: f"Title {i} Story {i} of its own" for i in range(3000)}
    assert {got[5000 + i] for i in range(60)} == {"Title 7 Story 7 of its own Read us daily"}


@pytest.mark.parametrize("around", [
    "<div class='layout no-sidebar'>%s</div>", "<div class=with-sidebar>%s</div>", "<div class=content-widget>%s</div>", "<div id=search-results>%s</div>",
    "<form>%s</form>", "<body class='has-comments'>%s</body>", "<div class=sidebar><p>Links</p></div>%s",
])
def test_names_around_the_article(around):
    story = "<h1>Head</h1><p>A story of some length that nobody may lose</p><div class=ad>Buy</div>"
    assert html_text.main_text(around % f"<article>{story}</article>") == "Head A story of some length that nobody may lose"
    assert html_text.main_text(around % f"<div>{story}</div>") == "Head A story of some length that nobody may lose"


def test_frame_by_share_of_text():
    story = "The main text lies in a plain element and is much longer than the cards"
    assert html_text.main_text(f"<div>{story}</div><article>Card</article><article>Card</article>") == f"{story} Card Card"
    assert html_text.main_text(f"<article>{story}</article><div id=comments><article class=comment>{story * 3}</article></div><div>More</div>") == story
    assert html_text.main_text(f"<div class=ad>{story}</div><article>Short</article>") == "Short"


def test_headings_stay_with_their_article(spark):
    body = "<body><nav><ul><li>Home<li>News {1}</ul></nav><article><h1>Title {0}</h1><h2>Background</h2><p>Story {0} of some length, {0} times told</p>" \
        "<h2>Results</h2><p>Found {0} of {0}</p><p class=motto>Read us daily</p></article><div class=x><h2>Links</h2><p>Some link</p></div></body>"
    rows = [(i, "http://heads.org/a", body.format(i, i % 3)) for i in range(40)]
    for lists in (True, False):
        got = {r.page_id: r.text for r in html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string"), lists=lists).collect()}
        assert got == {i: f"Title {i} Background Story {i} of some length, {i} times told Results Found {i} of {i}" for i in range(40)}


def test_the_style_tree_alone_finds_the_article(spark):
    """Without any list of names: menus, adverts and footers of the test pages go, and nothing of the articles."""
    plain = lambda html: html_text.main_text("".join(re.findall("<article>.*?</article>", html, re.S)), lists=False)
    for sf in ("0.1", "0.01"):
        pages = spark.read.parquet(f"/root/testdata/sf{sf}/pages.parquet")
        rows = pages.collect()
        assert all(r.html.count("<nav>") == r.html.count("<footer>") == 1 and "class=\"ad\"" in r.html for r in rows)
        found = {r.page_id: r.text for r in html_text.extract(pages, lists=False).collect()}
        if sf == "0.1":
            assert all(found[r.page_id] == plain(r.html) for r in rows)
        else:  # hosts of one to six pages: some boilerplate beside short articles is left in doubt, no text of an article goes
            assert all(plain(r.html) in found[r.page_id] for r in rows) and sum(found[r.page_id] != plain(r.html) for r in rows) < 0.15 * len(rows)


def test_few_pages_are_judged_with_doubt(spark):
    body = "<div class=a><p>Same line</p></div><div class=b><p>Story {0} and {0}</p></div>"
    for n, gone in ((3, False), (30, True)):
        rows = [(i, "http://few.org/", body.format(i)) for i in range(n)]
        got = html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string"), lists=False).collect()
        assert all(("Same line" not in r.text) == gone and f"Story {r.page_id} and" in r.text for r in got)


def plain_importance(pages):
    """Entropies by plain counts: {(host, path): (m, content, style, chars)}."""
    found = {}
    for host, html in {(h, b) for h, b in pages}:
        for path, _, _, content, style, chars in html_text.branches_of(html):
            found.setdefault((host, path), []).append((content, style, chars))
    out = {}
    for key, rows in found.items():
        m = len(rows) + html_text.PRIOR
        entropy = lambda k: -sum(n / m * math.log(n / m) for n in Counter(r[k] for r in rows).values()) + html_text.PRIOR / m * math.log(m)
        out[key] = (len(rows), entropy(0) / math.log(m), entropy(1) / math.log(m), sum(r[2] for r in rows) / len(rows))
    return out


def test_importance_equals_plain_entropies(spark):
    rng = random.Random(7)
    word = lambda: rng.choice(["a", "bb", "ccc"])
    pages = [(f"h{rng.randrange(3)}", f"<div class=m>{word()}</div><div>" + "".join(f"<p>{word()} {word()}</p>" for _ in range(rng.randrange(4))) + f"<h2>{word()}</h2></div>")
             for _ in range(120)]
    df = spark.createDataFrame(pages, "host string, html string").repartition(3).withColumn("page", F.xxhash64("html"))
    got = {(r.host, r.path): (r.m, r.content, r.style, r.chars) for r in html_text.node_importance(html_text.page_nodes(df)).collect()}
    want = plain_importance(pages)
    assert set(got) == set(want) and all(got[k] == pytest.approx(want[k]) for k in want)


@pytest.mark.parametrize("body", [
    "<a \"" + "<b x " * 1_000_000, "<a '" + "<b x '>" * 700_000, "<script " * 600_000, "</script " * 500_000 + "<script>" + "</script " * 500_000, "<!--" * 1_200_000,
    "<!x" * 1_600_000, "<" * 5_000_000, "<p title=\"" + "x" * 5_000_000, "<p>" + "<i a=\"'>\">" * 450_000,
])
def test_hostile_pages_take_time_by_their_length(body):
    start = time.process_time()
    html_text.main_text(body)
    assert time.process_time() - start < 25


def test_folders_belong_to_the_sessions_file_systems(spark, tmp_path):
    assert warc.qualified(spark, str(tmp_path)) == f"file://{tmp_path}"
    assert warc._store(f"file:{tmp_path}")[1] == warc._store(f"file://{tmp_path}")[1] == str(tmp_path)
    for folder in ("nowhere:/x", "dbfs:/x"):  # the session has no such file system
        with pytest.raises(Exception):
            warc.qualified(spark, folder)
    assert spark.read.format("binaryFile").load(warc.write(spark.createDataFrame([(1, "u", "x")], "page_id long, url string, html string"), str(tmp_path / "w")).head().file).count() == 1
