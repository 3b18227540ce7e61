"""Main text of web pages by composite text density (operator 3).

A page is scanned once into a tree of elements; only what can never be read as
text (scripts, styles, form controls, embedded media, hidden elements) is left
out of it. For every other element the composite text density is computed:
characters per tag below it, adjusted by how many of the characters and tags
belong to links. An element that its name marks as something beside the article
(navigation, page headers and footers, sidebars, forms, adverts, notices, reader
comments) has a weight below 1: its characters and tags count so much less for
the elements around it, and the densities inside it are so much lower. A name
that holds other words too ("notice-period") weighs little; a wrapper that holds
the page's ``article`` or ``main`` element, or most of its text, weighs nothing.

The element whose children's densities add up to most is the core of the article
(and with it the ``article`` or ``main`` element around it). The least density on
the path from the body to it is the threshold: every element that reaches it
gives the subtree with the greatest sum as content, and inside the content an
element that is marked, or that consists of links, is left out again if its
density stays below the threshold.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator
from math import e as EULER
from math import log

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Element names of HTML, by role.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes template".split())
NEVER = RAW | frozenset("head button select option datalist object svg math canvas audio video map".split())
BESIDE = frozenset("nav header footer aside form menu dialog label fieldset".split())  # sections that are not the article
BESIDE_ROLE = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar "
                       "toolbar".split())
BLOCK = frozenset("address article blockquote body caption center dd details dir div dl dt figcaption figure h1 h2 h3 h4 h5 "
                  "h6 hgroup hr html legend li main ol p pre search section summary table tbody td tfoot th thead tr "
                  "ul".split())
CLOSES_P = BLOCK | frozenset("nav header footer aside form fieldset menu dialog".split())
HEADING = frozenset("h1 h2 h3 h4 h5 h6".split())
LISTS = frozenset("div section ul ol dl table tbody tr td center".split())  # blocks that may hold nothing but links
# Formatting inside a run of text; it counts as text, not as a tag of its own.
INLINE = frozenset("abbr acronym b bdi bdo big br cite code data del dfn em font i ins kbd mark q rp rt ruby s samp small "
                   "span strike strong sub sup time tt u var wbr".split())
# A start tag on the left ends an open element on the right, up to an element that bounds it.
ENDS = {"li": ("li", "ul ol menu"), "dt": ("dt dd", "dl"), "dd": ("dt dd", "dl"), "tr": ("tr td th", "table"),
        "td": ("td th", "tr table"), "th": ("td th", "tr table"), "tbody": ("tbody thead tfoot tr td th", "table"),
        "thead": ("tbody thead tfoot tr td th", "table"), "tfoot": ("tbody thead tfoot tr td th", "table"),
        "option": ("option", "select datalist"), "optgroup": ("option optgroup", "select")}
ENDS = {k: (frozenset(a.split()), frozenset(b.split())) for k, (a, b) in ENDS.items()}
# Words of class and id names (cut at every non-letter and capital) of blocks that are not the article.
BOILERPLATE = frozenset("ad ads advert advertisement advertising adsense sponsor sponsored promo promotion banner nav navbar "
                        "navigation menu menubar breadcrumb breadcrumbs sidebar aside footer masthead toolbar "
                        "cookie cookies consent gdpr notice notices notification popup modal overlay newsletter subscribe "
                        "subscription signup login comment comments commentlist disqus respond reply replies share sharing "
                        "social related recommended recommendations pagination pager widget copyright skip feedback discussion".split())
# Words that say where or how, not what: a name of these and the above says the same as the above.
PLACES = frozenset("site page main reader readers user users global top bottom left right primary secondary block box section area wrap wrapper "
                   "container content list item items bar link links inner outer post article story body text title thread form message "
                   "messages panel group header head unit slot space zone first last s".split())
# Words that only count when the whole class or id name consists of them.
BOILERPLATE_ALONE = frozenset({"header", "top", "bottom", "side", "left", "right", "tags", "links", "search", "reviews", "alert"})
# Words that turn the one behind them into a property of the layout ("has-sidebar").
MODIFIERS = frozenset({"has", "no", "with", "without"})
MARKED, HINTED = 0.02, 0.5  # weights of elements whose name says so, and of those where it is one word among others

TOKEN = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)(>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(>|\Z)", re.S)
ATTRIBUTE = re.compile(r"""\b(class|id|role|hidden|aria-hidden|style)\s*(?:=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
SPACE = re.compile(r"\s+")


class Node:
    __slots__ = ("tag", "children", "out", "weight", "inherited", "holds", "held", "chars", "tags", "link_chars", "link_tags", "density", "total", "content",
                 "dropped")

    def __init__(self, tag: str, out: bool = False, weight: float = 1.0):
        self.tag, self.out, self.weight, self.children = tag, out, weight, []
        self.inherited = 1.0  # product of the weights from the root to here
        self.holds = self.content = self.dropped = False
        self.held = self.chars = self.tags = self.link_chars = self.link_tags = 0.0
        self.density = self.total = 0.0


def _hidden(tag: str, attributes: str) -> bool:
    if tag in ("body", "html", "article", "main"):
        return False
    for name, a, b, c in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), a or b or c
        if name == "hidden" or name == "aria-hidden" and value.lower() == "true":
            return True
        if name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
            return True
    return False


def _weight(tag: str, attributes: str) -> float:
    if tag in BESIDE:
        return MARKED
    least = 1.0
    if tag in ("body", "html", "article", "main"):
        return least
    for name, a, b, c in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), a or b or c
        if name == "role" and value.lower() in BESIDE_ROLE:
            return MARKED
        if name in ("class", "id"):
            for part in value.split():
                words = [w.lower() for w in NAME.findall(part)]
                words = [w for i, w in enumerate(words) if not i or words[i - 1] not in MODIFIERS]
                if words and BOILERPLATE_ALONE.issuperset(words):
                    return MARKED
                if not BOILERPLATE.isdisjoint(words):
                    if all(w in BOILERPLATE or w in PLACES or w in BOILERPLATE_ALONE for w in words):
                        return MARKED
                    least = HINTED
    return least


def parse(page: str) -> Node:
    """The element tree; children are nodes and strings. Unclosed and stray tags
    are treated as browsers do in the common cases (implied ends of paragraphs,
    list items and table cells; an end tag closes what is open inside)."""
    root = Node("html")
    stack, at, n = [root], 0, len(page)
    open_tags: Counter[str] = Counter()  # of the stack; spares most searches through a deep one

    def close(k: int) -> None:
        open_tags.subtract(s.tag for s in stack[k:])
        del stack[k:]

    def push(node: Node) -> None:
        open_tags[node.tag] += 1
        stack.append(node)

    def last(tags) -> int:
        """Place of the innermost open element among ``tags``, 0 if there is none."""
        if not any(open_tags[t] for t in tags):
            return 0
        return next(k for k in range(len(stack) - 1, 0, -1) if stack[k].tag in tags)

    while at < n:
        m = TOKEN.search(page, at)
        if m is None:
            stack[-1].children.append(page[at:])
            break
        if m.start() > at:
            stack[-1].children.append(page[at:m.start()])
        at = m.end()
        end, name, attributes = (m[1], m[2], m[3]) if m[2] else (m[5], m[6], m[7])
        if not name:
            continue
        tag = name.lower()
        if tag in ("html", "body"):
            if not end and tag == "body":
                stack[-1].children.append(" ")
                if not open_tags["body"]:
                    close(1)
                    node = Node("body")
                    root.children.append(node)
                    push(node)
            continue
        if end:
            hit = last(HEADING if tag in HEADING else (tag,))
            if hit and tag not in CLOSES_P and any(s.tag in CLOSES_P and s.tag != "p" for s in stack[hit + 1:]):
                hit = 0  # an inline end tag does not close blocks
            if hit:
                close(hit)
            continue
        if open_tags["head"] and tag not in RAW and tag != "head" and tag not in VOID:
            close(1)  # the head ends at the first element of the body
        if tag in CLOSES_P:
            hit = last(("p",))
            if hit and not any(s.tag in CLOSES_P for s in stack[hit + 1:]):
                close(hit)
            if tag in HEADING and stack[-1].tag in HEADING:
                close(len(stack) - 1)
        if tag in ENDS:
            closed, bound = ENDS[tag]
            while (hit := last(closed)) and hit > last(bound):
                close(hit)
        node = Node(tag, tag in NEVER or _hidden(tag, attributes), _weight(tag, attributes))
        stack[-1].children.append(node)
        if tag in VOID or attributes.endswith("/") and tag in ("svg", "path", "use"):
            continue
        if tag in RAW:
            stop = re.compile(rf"</{re.escape(tag)}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.I).search(page, at)
            at = stop.end() if stop else n
            continue
        push(node)
    return root


def _unmark(root: Node) -> None:
    """Takes the weight off elements that hold most of the text of all ``article``
    and ``main`` elements; on a page without one, off those that hold most of its
    characters outside links; and off the header of an article that holds its headline. Articles
    inside articles (reader comments) do not count."""
    order, todo = [], [(root, None, False, False)]
    while todo:
        node, parent, linked, within = todo.pop()
        order.append((node, parent))
        linked = linked or node.tag == "a"
        node.chars = 0 if linked else sum(len(SPACE.sub(" ", c).strip()) for c in node.children if isinstance(c, str))
        node.holds = node.tag in ("article", "main") and not within
        if node.tag == "header" and parent is not None and parent.tag in ("article", "main") and any(
                isinstance(c, Node) and c.tag in HEADING | {"hgroup"} for c in node.children):
            node.weight = 1.0
        within = within or node.tag == "article"
        todo += [(c, node, linked, within) for c in node.children if isinstance(c, Node) and not c.out]
    for node, parent in reversed(order):  # children before parents
        node.held = node.chars if node.holds else node.held
        if parent is not None:
            parent.chars += node.chars
            parent.held += node.held
    for node, _ in order:
        if node.weight < 1 and (2 * node.held > root.held if root.held else 2 * node.chars > root.chars):
            node.weight = 1.0


def _walk(root: Node) -> list[tuple[Node, Node | None, bool]]:
    """Elements in page order with their parent and whether a link encloses them."""
    order, todo = [], [(root, None, False)]
    while todo:
        node, parent, linked = todo.pop()
        order.append((node, parent, linked))
        inside = linked or node.tag == "a"
        todo += [(c, node, inside) for c in reversed(node.children) if isinstance(c, Node) and not c.out]
    return order


def composite(chars: float, tags: float, link_chars: float, link_tags: float, ratio: float) -> float:
    """Characters per tag, the less the more of both are links; ``ratio`` is the body's share of characters in links."""
    if not chars > link_chars:
        return 0.0
    t, lc, lt = max(tags, 1), max(link_chars, 1), max(link_tags, 1)
    base = log(chars * link_chars / max(chars - link_chars, 1) + ratio * chars + EULER)
    return chars / t * max(log(max(chars * t / (lc * lt), 1.0)), 0.0) / log(max(base, 1.0) + 1.0)


def _measure(order: list[tuple[Node, Node | None, bool]]) -> None:
    for node, parent, linked in order:
        own = sum(len(SPACE.sub(" ", c).strip()) for c in node.children if isinstance(c, str))
        node.chars, node.tags = float(own), 0.0
        link = linked or node.tag == "a"
        node.link_chars, node.link_tags = float(own) if link else 0.0, 0.0
        node.inherited = node.weight * (parent.inherited if parent is not None else 1.0)
    for node, parent, linked in reversed(order):  # children before parents
        if parent is not None:
            w = node.weight
            parent.chars += w * node.chars
            parent.link_chars += w * node.link_chars
            parent.tags += w * (node.tags + (node.tag not in INLINE))
            parent.link_tags += w * (node.link_tags + (linked or node.tag == "a"))
    body = order[0][0]
    ratio = body.link_chars / body.chars if body.chars else 0.0
    for node, parent, _ in reversed(order):
        if node.chars:
            node.density = node.inherited * composite(node.chars, node.tags, node.link_chars, node.link_tags, ratio)
        if parent is not None:
            parent.total += node.total if node.tag in INLINE else node.density


def _mark(order: list[tuple[Node, Node | None, bool]]) -> None:
    body = next((n for n, _, _ in order if n.tag == "body"), order[0][0])
    above = {id(n): p for n, p, _ in order}
    best = max((n for n, _, _ in order), key=lambda n: n.total)  # the first of equals
    if not best.total:
        body.content = True  # no element carries text of its own: all of the body's text
        return
    threshold, node = best.density, best
    while node is not None and node is not body:
        threshold = min(threshold, node.density)
        node = above[id(node)]
    threshold = min(threshold, body.density)
    # at each dense element, the subtree with the greatest sum; children come before parents
    top: dict[int, Node] = {}
    for node, parent, _ in reversed(order):
        own = top.get(id(node), node)
        own = node if node.total >= own.total else own
        if parent is not None:
            seen = top.get(id(parent))
            if seen is None or own.total >= seen.total:
                top[id(parent)] = own
    for node, _, _ in order:
        if node.density >= threshold > 0 and node.tag not in INLINE:
            own = top.get(id(node), node)
            (own if own.total > node.total else node).content = True
    best.content = True
    node = best
    while node is not None:  # a core inside an article stands for the whole of it
        if node.tag in ("article", "main"):
            node.content = True
            break
        node = above[id(node)]
    for node, _, _ in order:
        listed = node.tag in LISTS and node.link_tags >= 2 and 2 * node.link_chars > node.chars
        node.dropped = node.density < threshold and (node.weight <= MARKED or listed) and node is not best


def blocks(root: Node) -> list[str]:
    """Text of the content elements, a string per block, in page order."""
    out: list[str] = []
    line: list[str] = []

    def close() -> None:
        text = SPACE.sub(" ", entities.unescape("".join(line))).strip()
        if text:
            out.append(text)
        line.clear()

    todo: list[tuple[Node | str | None, bool]] = [(root, False)]
    while todo:
        item, inside = todo.pop()
        if item is None:
            close()
        elif isinstance(item, str):
            if inside:
                line.append(item)
        elif item.out or item.dropped:
            if item.tag in CLOSES_P:
                close()
        else:
            inside = inside or item.content
            if item.tag == "br":
                line.append(" ")
            if item.tag in CLOSES_P:
                close()
                todo.append((None, inside))
            todo += [(c, inside) for c in reversed(item.children)]
    close()
    return out


def main_text(page: str | None) -> str:
    """The article of a page; an empty string if it has no text."""
    if not page:
        return ""
    root = parse(page)
    _unmark(root)
    order = _walk(root)
    _measure(order)
    _mark(order)
    return "\n".join(blocks(root))


def extract(pages: DataFrame, key: str = "page_id", keep: tuple[str, ...] = ("url",), html: str = "html") -> DataFrame:
    """``key``, the columns ``keep``, ``text`` and ``n_chars`` per page.

    Null and empty pages have an empty text. Null or repeated keys pass through,
    a row per input row; columns that are not named are not read, so a page
    table may have columns of any other name (``text``, ``n_chars``).
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(p) for p in batch.column(batch.num_columns - 1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                [*(f"c{i}" for i in range(batch.num_columns - 1)), "text", "n_chars"])

    names = [key, *keep]
    kinds = ", ".join(f"c{i} {pages.schema[n].dataType.simpleString()}" for i, n in enumerate(names))
    out = pages.select(*(F.col(n).alias(f"c{i}") for i, n in enumerate(names)), F.col(html).alias("h")).mapInArrow(
        run, f"{kinds}, text string, n_chars long")
    return out.toDF(*names, "text", "n_chars")
