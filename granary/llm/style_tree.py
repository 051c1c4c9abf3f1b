"""Main text of web pages by a site style tree.

The pages of a host are merged into one tree: a node is a path of elements (name, class, id). For each
node the table counts on how many pages it stands, with which sequences of children (presentation) and
with which texts (content). A node whose presentation and content are alike on the host's pages has
low entropy, so low importance:

    presentation = entropy of the child sequences over the node's m pages, to the base m
    content      = 1 - mean over the node's texts of log_m(pages that have the text)

Nodes on at least ``MIN_PAGES`` pages whose importance is below ``THRESHOLD`` are noise; a page loses
their branches. All elements but scripts and the like are in the tree, whatever they are called, so it finds the
menus and footers of a host by itself (``by_name=False`` leaves it at that). Elements that are never the article (scripts, menus, forms, ...) also go by name, role or a
whole word of class or id on every page, on hosts with one page too, as do compounds with a part of ``_PARTS``
(comments-area, cookie-bar); class and id never mark html, body,
main, article or what holds the page's article. What goes by name needn't be brought to the pages. Inside an article the tree removes containers only,
not paragraphs: copies of an article on a host don't make its text noise.

Counts are partial aggregates by host, path and text, so a host with a third of all pages is spread
over tasks; what returns to the pages is one list of noise paths for a host, in a join that Spark can
split. Null and empty pages have an empty text; a null url counts as the host ''. Rows of a host with the same
html count as one page, so copies of a page don't make its text noise; each has its text. Unclosed and stray tags are allowed.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from html import unescape

import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary.llm.common import checkpointed, pick
from granary.llm.url_filter import host_and_path

MIN_PAGES = 3
THRESHOLD = 0.25

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)|[^<]+|<", re.S)
_ATTRIBUTE = re.compile(r"\b(class|id|role|hidden|aria-hidden)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_RAW = {n: re.compile(rf"</{n}\s*>", re.I) for n in ("script", "style", "textarea", "title", "xmp", "noscript", "template", "iframe")}
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html li main menu nav ol p pre section summary table "
    "tbody td tfoot th thead tr ul".split())
_NEVER = frozenset(
    "script style noscript template head title form button select option input textarea iframe object svg canvas "
    "audio video nav footer aside menu dialog".split())
_TEXTS = frozenset("p h1 h2 h3 h4 h5 h6 b i em strong a span u s small sub sup q cite code br blockquote pre li dd dt td th".split())
_MAIN = ("article", "main")
# whole words of class and id; a word with a dash or the like is left to the tree's importance
_NOISE = frozenset(
    "nav navbar navigation menu sidebar footer masthead topbar ad ads advert adverts advertisement sponsor sponsored promo "
    "banner cookie cookies cookie-notice cookie-banner cookie-consent consent gdpr newsletter subscribe popup modal comments "
    "respond replies disqus share sharing social related recommended breadcrumb breadcrumbs pagination pager login signup "
    "toolbar".split())
# parts of compound words that say reader comments, notices or adverts
_PARTS = frozenset("comment comments cookie cookies consent gdpr ad ads advert adverts advertisement adsbygoogle sponsor sponsored newsletter disqus".split())
_STATES = frozenset("no not has with without hide is can enable".split())  # such a compound tells of a state or a layout
_PAGE = frozenset("html body main article".split())  # never noise by class or id, nor is what holds an article
_CONTENT = frozenset("content main article post entry story".split())  # nor are elements that say so
_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert menu menubar form".split())
_CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
_HOLDERS = ("ul", "ol", "dl", "table", "select", "div", "article", "section")
_SPACE = re.compile(r"\s+")


class Node:
    __slots__ = ("name", "path", "noise", "children", "texts")

    def __init__(self, name: str, path: int, noise: bool):
        self.name, self.path, self.noise = name, path, noise
        self.children: list = []  # nodes and strings


def _compound(word: str) -> bool:
    parts = re.split("[-_]+", word)
    return not _PARTS.isdisjoint(parts) and _STATES.isdisjoint(parts) and _CONTENT.isdisjoint(parts)


def parse(html: str, by_name: bool = True) -> Node:
    """A tolerant tree: unclosed paragraphs, list items and cells close themselves. Without ``by_name``
    only elements that hold no text of the page are noise."""
    root = Node("#", 0, False)
    stack = [root]
    places: dict[str, list[int]] = defaultdict(list)  # where in the stack elements of a name are
    blocks = [0]  # for each place of the stack, that of the nearest block at or below it
    named: list[int] = []  # where in the stack elements are that are noise by class or id only
    at, n = 0, len(html)
    digest = xxhash.xxh3_64_intdigest

    def last(names) -> int:
        return max((places[x][-1] for x in names if places[x]), default=0)

    def cut(k: int) -> None:
        while len(stack) > k:
            places[stack.pop().name].pop()
            blocks.pop()
        while named and named[-1] >= k:
            named.pop()

    while at < n:
        m = _TOKEN.match(html, at)
        at = m.end()
        name = m[2]
        if name is None:
            text = m[0]
            if text[0] != "<" or len(text) == 1:
                stack[-1].children.append(unescape(text))
            continue
        name = name.lower()
        if m[1]:
            k = last((name,))
            if k and not (name in _TEXTS and last(_MAIN) > k):
                cut(k)
            continue
        if name in _BLOCK and stack[blocks[-1]].name == "p":
            cut(blocks[-1])
        if name in _CLOSES:
            k = last(_CLOSES[name])
            if k > last(_HOLDERS):
                cut(k)
        attributes = m[3]
        look = ""
        hidden = False
        if "=" in attributes:
            for a in _ATTRIBUTE.finditer(attributes):
                value = unescape(a[2] or a[3] or a[4] or "")
                kind = a[1].lower()
                if kind == "role":
                    hidden |= value.strip().lower() in _ROLES
                elif kind in ("class", "id"):
                    look += " " + value
                else:
                    hidden |= value.lower() in ("true", "hidden", "")
        top = stack[-1]
        path = digest(f"{top.path}/{name}.{re.sub('[0-9]+', '', look)}")
        hidden |= name in _NEVER
        called = False
        if look and not hidden and name not in _PAGE:
            words = set(look.lower().split())
            called = words.isdisjoint(_CONTENT) and (not words.isdisjoint(_NOISE) or any(map(_compound, words)))
        if not by_name:
            hidden, called = name in _RAW or name == "head", False
        node = Node(name, path, hidden or called)
        top.children.append(node)
        if name in _MAIN and not hidden and not last(_MAIN):
            for k in named:
                stack[k].noise = False
            named.clear()
        raw = _RAW.get(name)
        if raw is not None:
            end = raw.search(html, at)
            at = end.end() if end else n
        elif name not in _VOID and not attributes.rstrip().endswith("/"):
            if called:
                named.append(len(stack))
            places[name].append(len(stack))
            blocks.append(len(stack) if name in _BLOCK else blocks[-1])
            stack.append(node)
    return root


def _own_text(node: Node) -> str:
    return _SPACE.sub(" ", "".join(c if isinstance(c, str) else " " if c.name == "br" else "" for c in node.children)).strip()


def observations(html: str | None) -> list[tuple[int, int, int]]:
    """(path, kind, feature) of a page, each once. Kind 0: the node stands here (feature 1: and doesn't go by
    name, nor with an element around it); 1: a text of its own; 2: a sequence of children."""
    out: set[tuple[int, int, int]] = set()
    todo = [(parse(html), False)] if html else []
    digest = xxhash.xxh3_64_intdigest
    while todo:
        node, named = todo.pop()
        named |= node.noise
        kids = [c for c in node.children if not isinstance(c, str)]
        if node.name in _RAW or node.name == "head":
            continue
        if node.name != "#":
            out.add((node.path, 0, int(not named)))
            text = _own_text(node)
            if text:
                out.add((node.path, 1, digest(text.encode("utf-8", "surrogatepass"))))
            if kids:
                out.add((node.path, 2, digest(" ".join(k.name for k in kids).encode())))
        todo += [(k, named) for k in kids]
    return [tuple(x - (1 << 64) if x >= 1 << 63 else x for x in row) for row in out]


def main_text(html: str | None, low: frozenset | set = frozenset(), by_name: bool = True) -> str:
    """The text of the article, or of the page if it has none, without noise and ``low`` paths."""
    if not html:
        return ""
    root = parse(html, by_name)
    mains: list[Node] = []
    todo = [root]
    while todo:
        node = todo.pop()
        if node.noise or (node.name == "header" and node.name not in _MAIN):
            continue
        if node.name in _MAIN:
            mains.append(node)
        else:
            todo += [c for c in reversed(node.children) if not isinstance(c, str)]
    for tops in ([mains] if mains else []) + [[root]]:
        text = " ".join(b for top in tops for b in _blocks(top, low, bool(mains) and top is not root))
        if text:
            return text
    return ""


def _blocks(top: Node, low, inside: bool) -> list[str]:
    blocks: list[str] = []
    run: list[str] = []

    def close() -> None:
        text = _SPACE.sub(" ", "".join(run)).strip()
        run.clear()
        if text:
            blocks.append(text)

    todo = [(iter(top.children), False)]  # by hand, as pages may be nested deeper than calls can be
    while todo:
        c = next(todo[-1][0], None)
        if c is None:
            if todo.pop()[1]:
                close()
            continue
        if isinstance(c, str):
            run.append(c)
            continue
        if c.name in ("br", "hr", "wbr"):
            run.append("" if c.name == "wbr" else " ")
            continue
        block = c.name in _BLOCK
        if block:
            close()
        signed = c.path - (1 << 64) if c.path >= 1 << 63 else c.path
        if c.noise or (c.name == "header" and not inside) or (signed in low and not (inside and c.name in _TEXTS)):
            continue
        todo.append((iter(c.children), block))
    close()
    return blocks


def noise_paths(pages: DataFrame, min_pages: int = MIN_PAGES, threshold: float = THRESHOLD, unnamed: bool = False) -> DataFrame:
    """(host, low): for each host with such nodes, the paths of low importance; with ``unnamed`` only those that
    don't go by name on every page. ``pages`` has host, html and,
    if copies count as one page, ``copies``: how many rows are copies of this one, itself included."""

    @F.pandas_udf("array<struct<path:long,kind:long,feature:long>>")
    def observe(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for pages_ in batches:
            yield pd.Series([[{"path": p, "kind": k, "feature": f} for p, k, f in observations(h)] for h in pages_])

    once = "copies" in pages.columns
    weight = ["copies"] if once else []
    seen = pages.select("host", *weight, F.explode(observe("html")).alias("o")).select("host", *weight, "o.path", "o.kind", "o.feature")
    # the shares of a page's copies add up to one but for rounding
    n = F.round(F.sum(1 / F.col("copies"))) if once else F.count(F.lit(1))
    counts = seen.groupBy("host", "path", "kind", "feature").agg(n.alias("k"))
    of = lambda kind, value: F.when(F.col("kind") == kind, value)
    nodes = counts.groupBy("host", "path").agg(
        F.sum(of(0, F.col("k"))).alias("m"), F.max(of(0, F.col("feature"))).alias("open"), F.avg(of(1, F.log("k"))).alias("shared"),
        F.sum(of(2, F.col("k") * F.log("k"))).alias("styles"), F.sum(of(2, F.col("k"))).alias("styled"))
    nodes = nodes.filter((F.col("m") >= min_pages) & (F.col("open") >= int(unnamed)))
    log_m = F.log("m")
    content = 1 - F.col("shared") / log_m
    presentation = (F.log("styled") - F.col("styles") / F.col("styled")) / log_m
    importance = F.greatest(F.coalesce(content, F.lit(0.0)), F.coalesce(presentation, F.lit(0.0)))
    # a node without a text of its own is as important as what's in it, which is judged for itself
    low = nodes.filter(F.col("shared").isNotNull() & (importance < threshold))
    return low.groupBy("host").agg(F.collect_set("path").alias("low"))


def with_copies(pages: DataFrame) -> DataFrame:
    """host, html and ``copies``: how many rows of the host have this html. Only numbers are shuffled, and
    none is brought back where no page is repeated."""
    rows = pages.select("host", "html", F.xxhash64("html").alias("h1"), F.xxhash64(F.lit(1), "html").alias("h2"))
    repeated = checkpointed(rows.groupBy("host", "h1", "h2").agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1"))
    if repeated.isEmpty():
        return pages.select("host", "html", F.lit(1).alias("copies"))
    return rows.join(repeated, ["host", "h1", "h2"], "left").select("host", "html", F.coalesce("copies", F.lit(1)).alias("copies"))


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", by_name: bool = True) -> DataFrame:
    """Per row: id, url, text."""
    rows = pick(pages, id_col, url_col, html_col).toDF("id_", "url_", "html")
    rows = rows.withColumn("host", host_and_path(F.col("url_"))[0])
    low = checkpointed(noise_paths(with_copies(rows.select("host", "html")), unnamed=by_name))

    @F.pandas_udf("string")
    def text(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for html, paths in batches:
            yield pd.Series([main_text(h, set() if p is None else set(p.tolist()), by_name) for h, p in zip(html, paths)], dtype=object)

    # without any noise path there's nothing to bring to the pages, so they stay where they are
    rows = rows.withColumn("low", F.lit(None).cast("array<long>")) if low.isEmpty() else rows.join(low, "host", "left")
    return rows.select(F.col("id_").alias(id_col), F.col("url_").alias(url_col), text("html", "low").alias("text"))
