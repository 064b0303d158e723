"""HTML main-text extraction with a site style tree.

Pages of a host are merged into a style tree: a style node is a path of elements, each told by its tag and classes and by
its place in the sequence of its parent's blocks (which run of equal elements it is in, and whether it begins, ends or stands
inside it), with the distribution of its child sequences (presentation) and of its own texts (content) over the host's
pages. Entropy tells boilerplate from content: a node whose presentations and contents repeat over pages has low
importance. Importance is composed bottom-up, and branches that are below the threshold in all their nodes are removed from
each page, inside articles as outside of them; a heading stays inside an article,
and elsewhere where the block behind it stays. Only a host's own pages
decide, at least ``OWN`` of them that are not copies: equal articles of a host count once, and so do equal pages. Branches
inside an article stay where without them less than half of it would be left.

Elements that markup itself names as menus, headers, footers, sidebars, notices, adverts, forms, comments, scripts
or styles go in any case: by tag or role, or by a class or id made up of such words alone (``ad``, ``comment-list``),
unless the page's article or main element is inside. A page's article and main elements stand for it where they
hold at least half of what is left.

Edge cases: a null or empty html gives an empty text; a null url counts as the host without name; unclosed, stray
and nested tags are read as browsers do for blocks; repeated rows are pages each; an empty table gives none.
"""

from __future__ import annotations

import html as html_lib
import re
from collections import Counter

import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written
from .url_rules import url_host

#: Importance below which a branch goes, and the instances on the host that a decision needs.
THRESHOLD, OWN = 0.2, 5
GAMMA = 0.9
#: Element names and name parts (fixed values).
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title noscript template iframe xmp noembed noframes".split())
BLOCKS = set("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul caption".split())
DROPPED = set("script style noscript template iframe object embed svg canvas form nav aside footer head title select button textarea input dialog menu map audio video noembed noframes".split())
ROLES = set("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar toolbar form".split())
NAMED = set("ad ads adbox adslot advert adverts advertisement advertising sponsor sponsored sponsors promo promos promotion banner cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription paywall menu menus nav navbar navigation breadcrumb breadcrumbs sidebar widget widgets related recommended recommendations share sharing social footer masthead topbar comment comments commentlist respond replies disqus pagination pager toolbar login signup search outbrain taboola".split())
NEUTRAL = set("area article articles bar block box btn button buttons bottom container content form group header inner item items left link links list main menu news page panel post posts right section site sticky text thread title top wrap wrapper".split())
HEADINGS = set("h1 h2 h3 h4 h5 h6".split())
_CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
_SCOPE = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"}, "th": {"tr", "table"}, "option": {"select"}}
_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^"'>]|"[^"]*"|'[^']*')*)>""", re.S)
_ATTR = re.compile(r"""\b(class|id|role|hidden)\s*(?:=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
_SEED = 3


class Node:
    __slots__ = ("children", "depth", "drop", "key", "named", "path", "tag")

    def __init__(self, tag: str, key: str, parent: "Node | None", drop: bool, named: bool = False):
        self.tag, self.key, self.drop, self.named = tag, key, drop, named
        self.depth = parent.depth + 1 if parent else 0
        self.path = 0
        self.children: list[Node | str] = []


def is_boilerplate_name(name: str) -> bool:
    """Whether a class or id is made of words for boilerplate, and of neutral ones, alone."""
    parts = [x.rstrip("0123456789") for x in re.split("[-_]+", re.sub("([a-z])([A-Z])", r"\1-\2", name).lower())]
    parts = [x for x in parts if x]
    return any(x in NAMED for x in parts) and all(x in NAMED or x in NEUTRAL for x in parts)


def parse(page: str) -> Node:
    """The page's element tree; children are nodes and undecoded texts."""
    root = Node("#root", "#root", None, False)
    stack, at, end = [root], 0, len(page)
    while at < end:
        m = _TAG.search(page, at)
        if m is None:
            stack[-1].children.append(page[at:])
            break
        if m.start() > at:
            stack[-1].children.append(page[at : m.start()])
        at = m.end()
        tag = m[2]
        if tag is None:
            continue
        tag = tag.lower()
        if m[1]:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == tag:
                    del stack[k:]
                    break
            continue
        if tag in BLOCKS:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == "p":
                    del stack[k:]
                    break
                if stack[k].tag in BLOCKS:
                    break
        if tag in _CLOSES:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag in _CLOSES[tag]:
                    del stack[k:]
                    if tag != "tr" or stack[-1].tag not in _CLOSES[tag]:
                        break
                elif stack[k].tag in _SCOPE[tag]:
                    break
        attrs = {a.lower(): x or y or z or "" for a, x, y, z in _ATTR.findall(m[3])} if m[3] and not m[3].isspace() else {}
        names = " ".join((attrs.get("class", ""), attrs.get("id", ""))).strip()
        key = tag + ("." + ".".join(sorted(re.sub(r"\d+", "0", names).lower().split())) if names else "")
        inside = any(x.tag in ("article", "main") for x in stack)
        drop = tag in DROPPED or "hidden" in attrs or attrs.get("role", "").lower() in ROLES or (tag == "header" and not inside)
        named = bool(names) and tag not in ("html", "body", "main", "article") and any(map(is_boilerplate_name, names.split()))
        node = Node(tag, key, stack[-1], drop or named, named and not drop)
        if tag in ("article", "main"):
            for above in stack:  # what holds the article is not what its name says
                above.drop, above.named = above.drop and not above.named, False
        stack[-1].children.append(node)
        if tag in RAW:
            close = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
            at = close.end() if close else end
        elif tag not in VOID and not m[3].endswith("/"):
            stack.append(node)
    return root


def _inside(node: Node) -> tuple[str, list[Node]]:
    """A block's own text, with that of inline elements in it, and the blocks right below."""
    words: list[str] = []
    below: list[Node] = []
    stack: list[Node | str] = list(reversed(node.children))
    while stack:
        item = stack.pop()
        if isinstance(item, str):
            words.append(html_lib.unescape(item))
        elif item.tag in BLOCKS:
            below.append(item)
        elif not item.drop:
            words.append(" " if item.tag == "br" else "")
            stack += reversed(item.children)
    return " ".join("".join(words).split()), below


def _texts(node: Node) -> list[str]:
    """The texts of a node's blocks, in page order but for what is dropped."""
    out, stack = [], [node]
    while stack:
        text, below = _inside(stack.pop())
        if text:
            out.append(text)
        stack += [c for c in reversed(below) if not c.drop]
    return out


def place(root: Node) -> list[tuple[Node, int, str, list[Node]]]:
    """Gives every block that markup leaves open its style path; returns (block, parent's path, own text, blocks below)."""
    out, stack = [], [(root, 0)]
    while stack:
        node, parent = stack.pop()
        text, below = _inside(node)
        open_ = [c for c in below if not c.drop]
        out.append((node, parent, text, open_))
        runs: Counter = Counter()
        for i, c in enumerate(open_):
            begins, ends = i == 0 or open_[i - 1].key != c.key, i + 1 == len(open_) or open_[i + 1].key != c.key
            runs[c.key] += begins
            spot = f"{c.key}#{min(runs[c.key], 4)}{'b' * begins}{'e' * ends}"
            c.path = xxhash.xxh64_intdigest(f"{node.path}/{spot}", _SEED) >> 1
        stack += [(c, node.path) for c in reversed(open_)]
    return out


def style_counts(page: str, copied: bool = False) -> Counter:
    """(path, parent, depth, kind, value, article) of a page's blocks that markup leaves open.

    Kind 0 is presentation, 1 content; article is a hash of the article's texts for the blocks inside, and of the page for
    those outside if the page is one of several copies, else 0.
    """
    out: Counter = Counter()
    root = parse(page)
    articles = {id(root): (xxhash.xxh64_intdigest(page, _SEED) >> 1) | 1 if copied else 0}
    within: set[int] = set()
    for node, parent, text, below in place(root):
        article = articles[id(node)]
        if id(node) not in within and node.tag in ("article", "main"):
            article = (xxhash.xxh64_intdigest("\n".join(_texts(node)), _SEED) >> 1) | 1
            within.add(id(node))
        for c in below:
            articles[id(c)] = article
            if id(node) in within:
                within.add(id(c))
        shape = [k for i, k in enumerate(c.key for c in below) if i == 0 or below[i - 1].key != k]
        out[(node.path, parent, node.depth, 0, xxhash.xxh64_intdigest(",".join(shape), _SEED) >> 1, article)] += 1
        if text:
            out[(node.path, parent, node.depth, 1, xxhash.xxh64_intdigest(text, _SEED) >> 1, article)] += 1
    return out


def spared_headings(placed: list[tuple[Node, int, str, list[Node]]], removed: set[int]) -> set[int]:
    """Ids of headings of removed paths that stay: those before a block that stays, and all inside an article."""
    out: set[int] = set()
    within: set[int] = set()
    for node, _, _, below in placed:
        if node.tag in ("article", "main"):
            within.add(id(node))
        stays = False
        for c in reversed(below):
            if id(node) in within:
                within.add(id(c))
            if c.tag not in HEADINGS or c.path not in removed:
                stays = c.path not in removed
            elif stays or id(node) in within:
                out.add(id(c))
    return out


def _lines(root: Node, removed: set[int], spared: set[int], headings: set[int] = frozenset()) -> list[tuple[str, int]]:
    """(line, article) of a page: article is the id of the outermost article or main element around, else 0.

    Branches of the removed paths are left out, but not inside spared articles.
    """
    every: list[tuple[str, int]] = []
    words: list[str] = []
    stack: list[tuple[object, int]] = [(root, 0)]

    def flush(article: int) -> None:
        line = " ".join(html_lib.unescape("".join(words)).split())
        if line:
            every.append((line, article))
        words.clear()

    while stack:
        item, article = stack.pop()
        if isinstance(item, str):
            words.append(item)
        elif isinstance(item, Node):
            block = item.tag in BLOCKS
            if item.drop or (block and item.path in removed and article not in spared and id(item) not in headings):
                if block:
                    flush(article)
                continue
            if item.tag == "br":
                words.append(" ")
                continue
            if block:
                flush(article)
                stack.append((None, article))
            within = article or (id(item) if item.tag in ("article", "main") else 0)
            if within != article:
                stack.append((None, within))
            stack += [(c, within) for c in reversed(item.children)]
        else:
            flush(article)
    flush(0)
    return every


def extract(page: str | None, removed: set[int]) -> str:
    """The page's blocks, joined by newlines, without what is dropped or removed."""
    root = parse(page or "")
    headings = spared_headings(place(root), removed) if removed else set()

    def sizes(lines: list[tuple[str, int]]) -> Counter:
        out: Counter = Counter()
        for line, article in lines:
            out[article] += len(line)
        return out

    lines = _lines(root, removed, set(), headings)
    if removed:
        left, full = sizes(lines), sizes(_lines(root, set(), set()))
        spared = {a for a, n in full.items() if a and 2 * left[a] < n}
        lines = _lines(root, removed, spared, headings) if spared else lines
    kept = sizes(lines)
    of_article = kept.total() - kept[0]
    return "\n".join(line for line, article in lines if article or 2 * of_article < kept.total())


def style_trees(pages: DataFrame) -> DataFrame:
    """(host, removed): for every host the style paths whose branches are removed."""

    def count(batches):
        for batch in batches:
            total: Counter = Counter()
            for host, page, copied in zip(batch["host"], batch["html"], batch["copied"], strict=True):
                for key, n in style_counts(page or "", copied).items():
                    total[(host, *key)] = max(total[(host, *key)], n) if key[-1] else total[(host, *key)] + n
            yield pd.DataFrame([(*k, n) for k, n in total.items()], columns=["host", "path", "parent", "depth", "kind", "value", "article", "n"])

    told = pages.select("host", "html", F.xxhash64("html").alias("same"))
    copies = told.groupBy("host", "same").agg(F.count("*").alias("n")).where("n > 1").select("host", "same", F.lit(True).alias("copied"))
    marked = told.join(copies, ["host", "same"], "left").select("host", "html", F.coalesce("copied", F.lit(False)).alias("copied"))
    counted = marked.mapInPandas(count, "host string, path long, parent long, depth int, kind int, value long, article long, n long")
    # A block of copied articles and pages counts once for all of them; what else stands outside of articles once a page.
    once = counted.groupBy("host", "path", "parent", "depth", "kind", "value", "article").agg(F.when(F.col("article") != 0, F.max("n")).otherwise(F.sum("n")).alias("n"))
    valued = written(once.groupBy("host", "path", "parent", "depth", "kind", "value").agg(F.sum("n").alias("n")), "styles")
    scored = valued.groupBy("host", "path", "parent", "depth", "kind").agg(F.sum("n").alias("total"), F.sum(F.col("n") * F.log("n")).alias("spread"))
    diverse = F.when(F.col("total") > 1, (F.log("total") - F.col("spread") / F.col("total")) / F.log("total")).otherwise(F.lit(1.0))
    scored = scored.select("host", "path", "parent", "depth", "kind", "total", diverse.alias("importance"))

    def compose(rows: pd.DataFrame) -> pd.DataFrame:
        imp: dict[int, dict[int, tuple[float, int]]] = {}
        up: dict[int, int] = {}
        enough: dict[int, bool] = {}
        depth: dict[int, int] = {}
        for path, parent, deep, kind, total, value in rows[["path", "parent", "depth", "kind", "total", "importance"]].itertuples(index=False):
            imp.setdefault(path, {})[kind] = (value, total)
            up[path], depth[path] = parent, deep
            enough[path] = enough.get(path, False) or total >= OWN
        below: dict[int, list[tuple[float, int]]] = {}
        low: list[int] = []
        alive: set[int] = set()  # branches that stay, or hold one that stays
        for path in sorted(imp, key=lambda p: -depth[p]):
            parts = below.get(path, []) + ([imp[path][1]] if 1 in imp[path] else [])
            shape, total = imp[path].get(0, (0.0, 1))
            weight = sum(n for _, n in parts)
            inner = sum(v * n for v, n in parts) / weight if weight else shape
            keep = GAMMA ** max(1, len(parts))
            importance = (1 - keep) * shape + keep * inner
            below.setdefault(up[path], []).append((importance, total))
            if path in alive or importance >= THRESHOLD or depth[path] <= 2 or not enough[path]:
                alive.add(up[path])
            else:
                low.append(path)
        return pd.DataFrame({"host": [rows["host"].iloc[0]], "removed": [sorted(low)]})

    return scored.groupBy("host").applyInPandas(compose, "host string, removed array<long>")


def main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    hosted = pages.select("page_id", "url", "html", url_host(F.col("url")).alias("host"))
    trees = written(style_trees(hosted).where(F.size("removed") > 0), "trees")

    @F.pandas_udf("string")
    def text(pages: pd.Series, removed: pd.Series) -> pd.Series:
        return pd.Series([extract(p, set() if r is None else set(r)) for p, r in zip(pages, removed, strict=True)])

    joined = hosted.join(trees, "host", "left")
    out = joined.select("page_id", "url", text(F.col("html"), F.col("removed")).alias("text"))
    return out.withColumn("n_chars", F.length("text").cast("long"))
