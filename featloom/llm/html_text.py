"""Main text of web pages by a style tree for each site."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html import unescape

import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from featloom.llm.common import materialize
from featloom.llm.url_filter import host_and_path

TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)")
STOP = re.compile("[>\"']")
#: Elements whose content is no text of the page.
RAW = frozenset("script style template noscript iframe svg textarea title".split())
NAMES = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body br button caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6"
    " head header hr html legend li main menu nav ol option p pre section select summary table tbody td tfoot th thead tr ul video".split()
)
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
MAIN = frozenset(("article", "main"))
#: Elements and names whose presentation says that they are not the article.
NOISE = frozenset("head nav header footer aside button select option dialog menu audio video object canvas map".split())
NOISE_ROLE = frozenset("navigation banner contentinfo complementary alert alertdialog dialog menu menubar toolbar".split())
NOISE_NAME = re.compile(
    r"(?:^|[-_\s])(?:ads?|advert\w*|adsense|adslot|banner|sponsor\w*|promo\w*|cookie\w*|consent|gdpr|notices?|alert|popup|modal|overlay|newsletter|"
    r"subscri\w+|sign-?up|login|menu|nav|navbar|navigation|breadcrumbs?|sidebar|side-?bar|widget|footer|header|masthead|toolbar|shar(?:e|ing)|social|"
    r"related|recommend\w*|comments?|comment-?list|disqus\w*|repl(?:y|ies)|discussion|search|pagination|pager|skip-?link)(?:$|[-_\s])",
    re.I,
)
#: Names of a layout: what it lacks, has or comes with.
LAYOUT = re.compile(r"(?<![A-Za-z0-9])(?:no|has|have|with|without|hide|hidden)[-_]+[A-Za-z0-9]+", re.I)
#: Elements of running text; all other blocks are containers.
FLOW = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd td th tr caption figcaption blockquote pre legend summary".split())
HEADING = frozenset("h1 h2 h3 h4 h5 h6".split())
#: A branch marked by a name or a form goes only with at most this share of the page's text; an article frame needs at least its own.
NAMED_SHARE, FRAME_SHARE = 1 / 3, 1 / 2
PAGE = frozenset(("html", "body", "main", "article"))
#: Names that no element around an article has, however short the article.
APART = re.compile(r"(?:^|[-_\s])(?:ads?|advert\w*|adsense|adslot|sponsor\w*|cookie\w*|consent|gdpr|newsletter|breadcrumbs?|pagination|pager|skip-?link)(?:$|[-_\s])", re.I)
COMMENT = re.compile(r"(?:^|[-_\s])(?:comments?|repl(?:y|ies)|disqus\w*)(?:$|[-_\s])", re.I)


class Node:
    """``mark`` is the nearest element, itself included, that a name or a form speaks against, ``above`` the nearest around it."""

    __slots__ = ("tag", "path", "noise", "main", "apart", "mark", "above", "parent", "children", "texts")

    def __init__(self, tag: str, path: int, noise: bool, main: bool, parent: Node | None = None, named: bool = False, apart: bool = False):
        self.tag, self.path, self.noise, self.main, self.apart, self.children, self.texts = tag, path, noise, main, apart, [], []
        self.parent, self.above = parent, parent.mark if parent else None
        self.mark = self if named else self.above


def _element(parent: Node, tag: str, attributes: str) -> Node:
    names = {"class": "", "id": "", "role": ""}
    if attributes:
        for m in NAMES.finditer(attributes):
            names[m[1].lower()] = m[2] or m[3] or m[4] or ""
    noise = tag in NOISE and not (tag == "header" and parent.main) or names["role"].lower() in NOISE_ROLE
    apart, named = False, tag == "form" or names["role"].lower() in ("form", "search")
    label = f"{names['class']} {names['id']}"
    if label != " ":
        label = LAYOUT.sub(" ", label)
        comment = COMMENT.search(label) is not None
        apart = comment or tag not in PAGE and APART.search(label) is not None
        named = named or apart or tag not in PAGE and NOISE_NAME.search(label) is not None
    key = f"{tag}.{re.sub('[0-9]+', '#', names['class'])}".encode("utf-8", "surrogatepass")
    path = xxhash.xxh64_intdigest(key, parent.path & 0xFFFFFFFFFFFFFFFF)
    path = path - (1 << 64) if path >> 63 else path
    return Node(tag, path, parent.noise or noise, parent.main or tag in MAIN or names["role"].lower() == "main", parent, named, apart)


def tags(html: str) -> Iterator[tuple[int, int, bool, str, str]]:
    """``(start, end, closing, name, attributes)`` of everything that is not text; the name is empty for what just goes.

    One pass: a tag runs to the next ``>`` outside of quotes, and to the next
    ``>`` of any kind where a quote is left open. What is found to be missing
    once is not looked for again, so the time grows with the length of the page.
    """
    at, last = 0, {c: html.rfind(c) for c in ">\"'"}
    while (at := html.find("<", at)) >= 0:
        if html.startswith("<!--", at):
            end = html.find("-->", at + 4)
            end = len(html) if end < 0 else end + 3
            yield at, end, False, "", ""
            at = end
            continue
        if last[">"] < at:
            return
        m = TAG.match(html, at)
        if m is None:
            if html[at + 1 : at + 2] not in ("!", "?"):
                at += 1
                continue
            end = html.index(">", at) + 1
            yield at, end, False, "", ""
            at = end
            continue
        end = m.end()
        while (stop := STOP.search(html, end)) is not None and stop[0] != ">":
            end = html.find(stop[0], stop.end()) + 1 if last[stop[0]] > stop.start() else 0
            if not end:
                break
        end = stop.end() if stop is not None and end else html.index(">", at) + 1
        name = m[2].lower()
        if name in RAW and not m[1]:
            end = _after_raw(html, end, name)
            yield at, end, False, "", ""
        else:
            yield at, end, bool(m[1]), name, html[m.end() : end - 1]
        at = end


def _after_raw(html: str, at: int, name: str) -> int:
    """The end of the closing tag of a raw element; the rest of the page belongs to one that is not closed."""
    m = re.compile(f"</{name}", re.I).search(html, at)
    end = html.find(">", m.end()) if m else -1
    return len(html) if end < 0 else end + 1


def parse(html: str | None) -> tuple[list[tuple[Node, str]], list[Node]]:
    """The blocks of text in page order with their block element, and all block elements. Bad markup is read as browsers do."""
    root = Node("", 0, False, False)
    stack, nodes, blocks, buffer = [root], [root], [], []
    html = html or ""

    def flush() -> None:
        if buffer:
            text = " ".join(unescape("".join(buffer)).split())
            buffer.clear()
            if text:
                owner = next(n for n in reversed(stack) if n.tag in BLOCK or n is root)
                blocks.append((owner, text))
                owner.texts.append(text)

    at = 0
    for start, end, closing, tag, attributes in tags(html):
        if start > at:
            buffer.append(html[at:start])
        at = end
        if not tag:
            continue
        if closing:
            if tag in BLOCK:
                flush()
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == tag:
                    del stack[k:]
                    break
                if tag not in BLOCK and stack[k].tag in BLOCK:
                    break
            continue
        if tag in BLOCK:
            flush()
            if tag not in VOID:
                ends = CLOSES.get(tag, frozenset()) | ({"p"} if tag not in ("button", "option") else set())
                for k in range(len(stack) - 1, 0, -1):
                    if stack[k].tag in ends:
                        del stack[k:]
                        break
                    if stack[k].tag in BLOCK and stack[k].tag not in ("p", *ends):
                        break
        if tag in VOID:
            continue
        node = _element(stack[-1], tag, attributes)
        if tag in BLOCK:
            nodes.append(node)
            stack[-1].children.append(node.path)
        stack.append(node)
    if at < len(html):
        buffer.append(html[at:])
    flush()
    return blocks, nodes


def _ruled_out(blocks: list[tuple[Node, str]], nodes: list[Node]) -> set[Node]:
    """The elements whose name or form rules out their branch.

    A branch with an article or main element is the page itself, whatever its
    name; so is one with a large share of the page's text, comments, adverts and the like excepted.
    """
    if all(n.mark is None for n in nodes):
        return set()
    framing = {m for n in nodes if n.tag in MAIN and not n.noise and n.mark is not n for m in _marks(n.mark)}
    held, total = Counter(), 0
    for n, text in blocks:
        if not n.noise:
            total += len(text)
            held.update({m: len(text) for m in _marks(n.mark)})
    named = {m for n in nodes for m in _marks(n.mark)}
    return {m for m in named if m not in framing and (m.apart or held[m] <= NAMED_SHARE * total)}


def _marks(mark: Node | None) -> Iterator[Node]:
    while mark is not None:
        yield mark
        mark = mark.above


def _gone(blocks: list[tuple[Node, str]], unimportant: frozenset[int]) -> set[Node]:
    """The block elements that lie in an unimportant branch."""
    if not unimportant:
        return set()
    known: dict[Node, bool] = {}
    for node, _ in blocks:
        chain = []
        while node is not None and node not in known:
            chain.append(node)
            node = node.parent
        low = node is not None and known[node]
        for n in reversed(chain):
            low = known[n] = low or n.path in unimportant
    return {n for n, low in known.items() if low}


def main_text(html: str | None, unimportant: frozenset[int] = frozenset(), lists: bool = True) -> str:
    """The kept blocks joined by one space.

    Branches that the site's style tree found unimportant go on every page. With
    ``lists`` those whose presentation is noise go as well, and where the article or
    main elements hold at least ``FRAME_SHARE`` of the rest, only what lies in them is kept.
    """
    blocks, nodes = parse(html)
    gone = _gone(blocks, unimportant)
    blocks = [(n, text) for n, text in blocks if n not in gone]
    if not lists:
        return " ".join(text for _, text in blocks)
    out = _ruled_out(blocks, nodes)
    blocks = [(n, text) for n, text in blocks if not n.noise and out.isdisjoint(_marks(n.mark))]
    framed = sum(len(text) for n, text in blocks if n.main)
    inside = framed > 0 and framed >= FRAME_SHARE * sum(len(text) for _, text in blocks)
    return " ".join(text for n, text in blocks if n.main or not inside)


FLOWING, TITLE = 1, 2  # kinds of a branch beside a container, 0


def branches_of(html: str | None) -> list[tuple[int, list[int], int, int, int, int]]:
    """``(path, ancestors, kind, content, style, chars)`` of every branch of a page, equal paths merged; the ancestors from the page down."""
    merged: dict[int, tuple[Node, list, list]] = {}
    for n in parse(html)[1]:
        _, texts, children = merged.setdefault(n.path, (n, [], []))
        texts += n.texts
        children += n.children
    out = []
    for path, (node, texts, children) in merged.items():
        above, up = [], node.parent
        while up is not None:
            if up.tag in BLOCK or up.parent is None:
                above.append(up.path)
            up = up.parent
        kind = TITLE if node.tag in HEADING else FLOWING if node.tag in FLOW else 0
        content = xxhash.xxh64_intdigest("\n".join(texts).encode("utf-8", "surrogatepass")) >> 1
        out.append((path, above[::-1], kind, content, xxhash.xxh64_intdigest(repr(children)) >> 1, sum(map(len, texts))))
    return out


BRANCHES = "host string, page long, path long, above array<long>, kind int, content long, style long, chars long"


def page_nodes(pages: DataFrame) -> DataFrame:
    """The branches of each page in the columns of ``BRANCHES``, once for equal pages of a host.

    ``pages`` has ``(host, page, html)``, ``page`` a hash of ``html``.
    """

    def branches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            first = frame.drop_duplicates(["host", "page"])
            rows = [(site, page, *b) for site, page, body in zip(first["host"], first["page"], first["html"]) for b in branches_of(body)]
            yield pd.DataFrame(rows, columns=["host", "page", "path", "above", "kind", "content", "style", "chars"])

    found = pages.select("host", "page", "html").mapInPandas(branches, BRANCHES)
    return found.dropDuplicates(["host", "page", "path"])


#: Pages of their own kind that every branch is thought to have been seen on beside the real ones.
PRIOR = 4.0
#: A branch beside the main one needs so many times less than a page's information to be judged on one page alone, and a gap of ``GAP`` to the rest.
DOUBT, GAP = 8.0, 4.0
#: Branches whose content repeats: below ``REPEATED``, or below a gap of ``STEP`` between the host's low and high ones.
REPEATED, STEP = 0.3, 0.15


def node_importance(nodes: DataFrame) -> DataFrame:
    """``(host, path, above, kind, m, content, style, chars, own)`` from ``page_nodes``.

    ``content`` and ``style`` are the entropies of a node's own text and of the
    sequence of its children over the ``m`` different pages that have it, in units of
    the logarithm of their number; ``chars`` is its mean own text. ``own`` is the
    information that it gives a page: content entropy times length.
    """
    values = F.explode(F.array(F.struct(F.lit("content").alias("feature"), F.col("content").alias("value")), F.struct(F.lit("style").alias("feature"), F.col("style").alias("value"))))
    counts = nodes.select("host", "path", values.alias("v")).groupBy("host", "path", "v.feature", "v.value").agg(F.count("*").alias("n"))
    sizes = nodes.groupBy("host", "path").agg(
        F.count("*").alias("m"), F.avg("chars").alias("chars"), F.min("kind").alias("kind"), F.first("above").alias("above")
    )
    # Every page has one value of a feature, so a feature's counts add up to the pages.
    of = lambda f, e: F.sum(F.when(F.col("feature") == f, e).otherwise(0.0))
    n, m = F.col("n").cast("double"), F.lit(PRIOR)
    judged = counts.groupBy("host", "path").agg(*[
        (1 - of(f, n * F.log(n)) / ((of(f, n) + m) * F.log(of(f, n) + m))).alias(f) for f in ("content", "style")
    ])
    return sizes.join(judged, ["host", "path"]).withColumn("own", F.col("content") * F.col("chars"))


def style_tree(nodes: DataFrame) -> DataFrame:
    """``(host, path)``: the unimportant branches of every site, from ``page_nodes``.

    The DOMs of a host are merged by the path of tags and classes. From the
    children up, a branch's composite importance is the information of all nodes in it,
    each with the share of the branch's pages that have it, times a half to one by
    the entropy of the branch's presentation. Containers that hold more than half of
    the host's information form one chain from the page down to the main container.

    Containers beside that chain, outside the main container, are unimportant where
    the host itself shows a gap: sorted by importance together with the main
    container, those below the widest ratio of neighbours, if it is at least ``GAP``.
    Few pages leave doubt: a branch's importance counts ``1 + DOUBT / m`` times.
    Any branch goes whose content repeats: whose entropy is below ``REPEATED``, or
    below the host's widest step between low and high entropies of branches with
    text, if that is at least ``STEP`` (and more on few pages) and the main text lies above it. Headings stay
    with their branch. Every number is smoothed by the pages seen, none is cut off.
    """
    rated = materialize(node_importance(nodes), "node-importance")
    up = F.explode(F.concat("above", F.array("path"))).alias("branch")
    mass = rated.select("host", up, (F.col("own") * F.col("m")).alias("held")).groupBy("host", "branch").agg(F.sum("held").alias("held"))
    rated = rated.join(mass.select("host", F.col("branch").alias("path"), "held"), ["host", "path"])
    rated = rated.withColumn("mass", F.col("held") / F.col("m") * (1 + F.col("style")) / 2).withColumn("depth", F.size("above"))
    total = mass.groupBy("host").agg(F.max("held").alias("total"))  # the page itself holds all
    rated = materialize(rated.join(total, "host").withColumn("chain", (F.col("kind") == 0) & (F.col("held") > F.col("total") / 2)), "branch-importance")
    main = rated.where("chain").groupBy("host").agg(F.max(F.struct("depth", "mass", "path")).alias("main"), F.collect_set("path").alias("chained"))
    beside = rated.join(main, "host").where("NOT chain AND kind = 0 AND held > 0 AND depth <= main.depth")
    beside = beside.where(F.array_contains("chained", F.get("above", F.size("above") - 1)))
    judged = beside.select("host", "path", (F.col("mass") * (1 + DOUBT / F.col("m"))).alias("mass")).unionByName(
        main.select("host", F.col("main.path").alias("path"), F.col("main.mass").alias("mass"))
    )
    apart = _below_gap(judged.withColumn("at", F.log(F.col("mass") + 1e-9)), F.log(F.lit(GAP))).join(main.select("host", F.col("main.path").alias("path")), ["host", "path"], "left_anti")
    texts = rated.where(F.col("chars") > 0).withColumn("at", F.col("content"))
    seen = texts.groupBy("host").agg((STEP + 1 / F.sqrt(F.max("m"))).alias("least"))
    steps = _below_gap(texts.select("host", "path", "at").join(seen, "host"), F.col("least"))
    high = texts.join(steps.withColumn("low", F.lit(True)), ["host", "path"], "left").groupBy("host").agg(
        (F.sum(F.when(F.col("low"), 0.0).otherwise(F.col("own") * F.col("m"))) > F.sum(F.col("own") * F.col("m")) / 2).alias("sound")
    )
    steps = steps.join(high.where("sound").select("host"), "host")
    repeated = texts.where(F.col("content") < REPEATED).select("host", "path").unionByName(steps)
    repeated = repeated.join(rated.where(F.col("kind") != TITLE).where("NOT chain").select("host", "path"), ["host", "path"])
    return apart.unionByName(repeated).distinct()


def _below_gap(values: DataFrame, least: Column) -> DataFrame:
    """``(host, path)`` of those below the widest gap between neighbouring ``at`` of their host, if it is at least ``least``."""
    order = Window.partitionBy("host").orderBy("at", "path")
    gaps = values.withColumn("gap", F.lead("at").over(order) - F.col("at"))
    cut = gaps.where(F.col("gap") >= least).groupBy("host").agg(F.max(F.struct("gap", "at")).at.alias("cut"))
    return values.join(cut, "host").where(F.col("at") <= F.col("cut")).select("host", "path")


def extract(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html", lists: bool = True) -> DataFrame:
    """``key``, ``url``, ``text`` and ``n_chars`` (code points) for every row.

    Null html is empty and gives an empty text; a null or malformed URL belongs to
    the site without a name. Every row is judged by itself, repeated ones too;
    other columns are not read. Without ``lists`` the style tree decides alone.
    """
    rows = pages.select(F.col(key).alias("key"), F.col(url).alias("url"), F.col(html).alias("html"), host_and_path(url)[0].alias("host"))
    rows = rows.withColumn("page", F.xxhash64("html"))
    # Pages of a host are parsed once for the tree and once for their text; what travels between is a few numbers a branch.
    nodes = materialize(page_nodes(rows), "page-nodes")
    low = materialize(style_tree(nodes), "unimportant-branches")
    # One row a site with the branches that go: paths of tags and classes, as many as its templates have.
    paths = materialize(low.groupBy("host").agg(F.collect_list("path").alias("paths")), "site-branches")
    rows = rows.join(paths, "host", "left")

    @F.pandas_udf("string")
    def text_of(bodies: pd.Series, noise: pd.Series) -> pd.Series:
        return pd.Series([main_text(b, frozenset(n) if n is not None else frozenset(), lists) for b, n in zip(bodies, noise)], dtype=object)

    out = rows.select("key", "url", text_of("html", "paths").alias("text"))
    return out.select(F.col("key").alias(key), F.col("url").alias(url), "text", F.length("text").cast("long").alias("n_chars"))
