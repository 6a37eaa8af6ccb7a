"""Main text of web pages by composite text density.

Every node of the page's tree has a density: characters per tag, adjusted by how many of
both stand in links. The densities of a node's children are summed, and the subtree with
the largest sum holds the article. The least density on the path from that subtree to the
body is the threshold for what else is kept. Parts that are no article by their element
or their name (menus, footers, adverts, forms, comments) never take part, unless they hold most
of the page's text outside links, or its only article.
"""

from __future__ import annotations

import html
import math
import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kilnmark.llm.common import released, table

_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<[!?/][^>]*+>|</?[a-zA-Z][^>]*+>", re.S)
_ATTRIBUTES = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_NOT_SHOWN = re.compile(r"display\s*:\s*none", re.I)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes".split())
BLOCK = frozenset("address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form "
                  "h1 h2 h3 h4 h5 h6 header hr html li main menu nav ol p pre section summary table tbody td tfoot th thead "
                  "tr ul".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements that are no article.
DROPPED = frozenset("nav header footer aside form button select option textarea input script style noscript template iframe "
                    "svg head title menu dialog object canvas audio video".split())
#: Those of them that are dropped whatever they hold, and what else goes from a form that stays.
NEVER_KEPT = DROPPED - frozenset("nav header footer aside form menu dialog".split())
FORM_LABELS = frozenset("label legend optgroup datalist output".split())
#: Whole words of a class, an id or a role that mark what is no article.
DROPPED_NAMES = frozenset("ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie "
                          "cookies consent gdpr notice notices alert newsletter subscribe subscription popup modal overlay "
                          "sidebar sidebars aside menu menus nav navbar navigation breadcrumb breadcrumbs footer header masthead "
                          "comment comments commentlist disqus respond replies reply share sharing social related "
                          "recommended pagination pager search login contentinfo complementary toolbar skip widget".split())
#: Those that mark a part under any prefix or suffix too, as in site-footer or cookie_banner ...
MARKING_WORDS = frozenset("ad ads advert advertisement sponsored promo banner cookie cookies consent gdpr newsletter subscribe popup modal "
                          "sidebar menu nav navbar navigation breadcrumb breadcrumbs footer masthead comment comments disqus "
                          "respond share sharing social related pagination".split())
#: ... unless one of these says that the page only has or lacks such a part.
ABOUT_PAGE = frozenset("no not has have with without is open closed enabled disabled hide show layout".split())
#: What readers have written is no article, however much of it there is.
READERS_WORDS = frozenset("comment comments commentlist disqus respond replies".split())
#: So many characters outside mean that readers' comments are not all that the page has.
OWN_TEXT = 140
_MAY_NOT_DROP = frozenset(("html", "body", "main", "article"))
#: Elements that a start tag of the same group closes, up to the given container.
_CLOSES = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("tr", "table"), "th": ("tr", "table"),
           "option": ("select",)}
_SAME = {"dt": ("dt", "dd"), "dd": ("dt", "dd"), "td": ("td", "th"), "th": ("td", "th"), "tr": ("tr", "td", "th")}


class _Node:
    __slots__ = ("tag", "parent", "parts", "dropped", "marked", "readers", "text", "articles", "chars", "tags", "link_chars", "link_tags",
                 "density", "total", "in_link", "in_article")

    def __init__(self, tag: str, parent: _Node | None, dropped: bool):
        self.tag, self.parent, self.dropped = tag, parent, dropped
        self.in_link = tag == "a" or parent is not None and parent.in_link
        self.in_article = tag == "article" or parent is not None and parent.in_article
        self.parts: list[str | _Node] = []
        self.marked, self.readers, self.text, self.articles = False, False, 0, 0
        self.chars = self.tags = self.link_chars = self.link_tags = 0
        self.density = self.total = 0.0


def _marking(value: str) -> tuple[bool, bool]:
    """Do the names of a class, id or role mark what is no article, and what readers have written?"""
    marked = readers = False
    for name in value.split():
        words = set(re.split("[-_]+", name))
        hits = {name} & DROPPED_NAMES or (set() if words & ABOUT_PAGE else words & MARKING_WORDS)
        marked |= bool(hits)
        readers |= bool(hits & READERS_WORDS)
    return marked, readers


def _judge_name(node: _Node, attributes: str) -> None:
    """Sets whether a node is marked by its element, its names or as hidden; a header inside an article is part of it."""
    if node.tag in DROPPED and not (node.tag == "header" and node.parent.in_article):
        node.marked = True
    if not attributes or node.tag in _MAY_NOT_DROP:
        return
    for m in _ATTRIBUTES.finditer(attributes):
        name, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
        if name in ("class", "id", "role"):
            marked, readers = _marking(value)
            node.marked |= marked
            node.readers |= readers
        if name == "hidden" or name == "aria-hidden" and value == "true" or name == "style" and _NOT_SHOWN.search(value):
            node.marked = True


def _drop_others(nodes: list[_Node], body: _Node) -> None:
    """Settles which marked nodes are dropped, with all below them.

    A marked node stays if it holds more than half of the body's text outside links, or an article or main where
    none stands outside marked nodes. What is marked inside it is judged by itself. Readers' comments stay
    only if the page has next to nothing else.
    """
    for node in reversed(nodes):
        if node.dropped:
            continue
        if not node.in_link:
            node.text += sum(len(x.strip()) for x in node.parts if isinstance(x, str))
        node.articles += node.tag in ("article", "main")
        if node.parent is not None:
            node.parent.text += node.text
            node.parent.articles += node.articles
    under, free = set(), False
    for node in nodes:
        if node.marked or id(node.parent) in under:
            under.add(id(node))
        elif not node.dropped and node.tag in ("article", "main") and node.text:
            free = True
    in_form = set()
    for node in nodes:
        if node.parent is not None and node.parent.dropped:
            node.dropped = True
        elif node.readers:
            node.dropped |= 2 * node.text <= body.text or body.text - node.text >= OWN_TEXT
        elif node.marked:
            node.dropped |= not (2 * node.text > body.text or node.articles and not free)
        if node.tag == "form" or id(node.parent) in in_form:
            in_form.add(id(node))
            node.dropped |= node.tag in FORM_LABELS


class _Open:
    """The open elements, and where on the stack each name stands, so that no end tag walks the stack."""

    def __init__(self, root: _Node):
        self.stack, self.places = [root], {}

    def push(self, node: _Node) -> None:
        self.places.setdefault(node.tag, []).append(len(self.stack))
        self.stack.append(node)

    def last(self, names) -> int:
        """Place of the innermost open element of these names, 0 if there is none."""
        return max((self.places[n][-1] for n in names if self.places.get(n)), default=0)

    def close(self, names: tuple[str, ...], limits: tuple[str, ...] = ()) -> None:
        """Close the innermost element of ``names`` and what is open inside it, unless a limit stands between."""
        at = self.last(names)
        if at and at > self.last(limits):
            for node in self.stack[at:]:
                self.places[node.tag].pop()
            del self.stack[at:]


def _tree(page: str) -> list[_Node]:
    """All nodes, parents before children; unclosed and stray tags are mended as browsers roughly do.

    An end tag of body or html ends nothing: what stands behind it still belongs to the body.
    Every step takes as long as the markup it reads, so a page of any shape takes linear time.
    """
    root = _Node("#root", None, False)
    nodes, opened, at = [root], _Open(root), 0
    ends = page.rfind(">")  # behind it a tag has no end, and the search for one would run to the end of the page each time

    while at <= ends and (m := _MARKUP.search(page, at)):
        if m.start() > at:
            opened.stack[-1].parts.append(page[at:m.start()])
        at = m.end()
        if not m[2]:
            continue
        tag = m[2].lower()
        if m[1]:
            if tag not in ("html", "body"):
                opened.close((tag,), ("body",))
            continue
        if tag in BLOCK:
            # A block ends an open paragraph, whatever inline elements are open inside it.
            opened.close(("p",), ("td", "th", "button", "object", "body", "table", "div", "li", "article", "section"))
        if tag in _CLOSES:
            opened.close(_SAME.get(tag, (tag,)), _CLOSES[tag])
        up = opened.stack[-1]
        node = _Node(tag, up, up.dropped or tag in NEVER_KEPT)
        if not node.dropped:
            _judge_name(node, m[3])
        up.parts.append(node)
        nodes.append(node)
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
            inside, at = (page[at:end.start()], end.end()) if end else (page[at:], len(page))
            if not node.dropped:
                node.parts.append(inside)
        elif tag not in VOID and not m[3].endswith("/"):
            opened.push(node)
    if at < len(page):
        opened.stack[-1].parts.append(page[at:].partition("<!--")[0])
    return nodes


def _measure(nodes: list[_Node], body: _Node) -> None:
    kept = [n for n in nodes if not n.dropped]
    for node in reversed(kept):
        own = sum(len(x.strip()) for x in node.parts if isinstance(x, str))
        node.chars += own
        if node.in_link:
            node.link_chars += own
        if (up := node.parent) is not None:
            up.chars += node.chars
            up.tags += node.tags + 1
            up.link_chars += node.link_chars
            up.link_tags += node.link_tags + (node.tag == "a")
    share = body.link_chars / max(body.chars, 1)
    for node in reversed(kept):
        c, t, lc, lt = node.chars, max(node.tags, 1), max(node.link_chars, 1), max(node.link_tags, 1)
        if c:
            base = math.log(math.log(c / max(c - node.link_chars, 1) * lc + share * c + math.e))
            node.density = c / t * math.log(max(c / lc * t / lt, 1.0)) / max(base, 1e-9)
        if node.parent is not None:
            node.parent.total += node.density


def _collect(root: _Node, wanted, out: list[str]) -> None:
    """Text of the wanted nodes in page order; a list entry that is \\n ends a block."""
    todo: list[_Node | str | tuple[str]] = [root]
    while todo:
        x = todo.pop()
        if isinstance(x, str):
            out.append(x)
            continue
        verdict = wanted(x)
        if verdict is None:
            continue
        block = x.tag in BLOCK
        todo += ["\n"] * block
        todo += [html.unescape(p).replace("\n", " ") if isinstance(p, str) else p
                 for p in reversed(x.parts) if verdict or not isinstance(p, str)]
        todo += ["\n"] * block
        if x.tag == "br":
            todo.append(" ")


def main_text(page: str) -> str:
    """The article of one page: blocks joined by a line feed, empty if there is none."""
    nodes = _tree(page)
    body = next((n for n in nodes if n.tag == "body"), nodes[0])
    _drop_others(nodes, body)
    _measure(nodes, body)
    inside = [n for n in nodes if not n.dropped and n.chars]
    if not inside:
        return ""
    under = {id(body)}
    for n in inside:
        if n.parent is not None and id(n.parent) in under:
            under.add(id(n))
    candidates = [n for n in inside if id(n) in under] or inside
    best = max(candidates, key=lambda n: n.total)
    if best.total == 0:  # no node has a child with text
        best = max(candidates, key=lambda n: n.chars)
    path, top = [best], best
    while path[-1] is not body and path[-1].parent is not None:
        path.append(path[-1].parent)
    for node in path:  # an element that calls itself the article is the article
        if node.tag in ("article", "main"):
            top = node
    threshold = min(n.density for n in path)
    above = {id(n) for n in path[path.index(top) + 1:]}

    def wanted(node: _Node) -> bool | None:
        """True: the node with its own text; False: only what is kept of its children; None: nothing."""
        if node.dropped:
            return None
        if id(node) in whole or (node.parent is not None and id(node.parent) in whole):
            whole.add(id(node))
            return True
        if id(node) in above:
            return False
        # A heading beside the densest subtree is short, so its density says little.
        if node.tag in HEADINGS and node.parent is not None and id(node.parent) in above and 2 * node.link_chars < node.chars:
            whole.add(id(node))
            return True
        if node.density >= threshold and 2 * node.link_chars < node.chars and node.tag in BLOCK:
            whole.add(id(node))
            return True
        return None

    whole, out = {id(top)}, []
    _collect(path[-1], wanted, out)
    blocks = (" ".join(x.split()) for x in "".join(out).split("\n"))
    return "\n".join(x for x in blocks if x)


def extract(pages: DataFrame, column: str = "html") -> DataFrame:
    """``pages`` without ``column`` and with ``text`` and ``n_chars``, one row per row.

    Null html is empty and gives an empty text. Columns of the names ``text`` and
    ``n_chars`` are replaced, others pass through. Each page is read whole.
    """
    rest = [c for c in pages.columns if c not in (column, "text", "n_chars")]
    schema = T.StructType([*(pages.schema[c] for c in rest), T.StructField("text", T.StringType()),
                           T.StructField("n_chars", T.LongType())])

    def run(batches):
        for batch in batches:
            for k in range(0, batch.num_rows, 64):
                part = batch.slice(k, 64)
                texts = [main_text(x) if x else "" for x in part.column(column).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in rest), pa.array(texts, pa.string()),
                     pa.array([len(x) for x in texts], pa.int64())], [*rest, "text", "n_chars"])

    return pages.select(*rest, column).mapInArrow(released(run), schema)


def op4_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages").select("page_id", "url", F.col("html")))
