"""Main text of web pages by composite text density.

A page becomes a tree of elements. Every element gets its composite text density: the
characters per tag below it, adjusted by how many of those characters and tags are links
and by the share of link text in the whole body. The density sum of an element is the sum
of its children's densities. The element with the largest sum is looked up, and the threshold
is the smallest density on the path from the body to it. The content is one subtree: the
article around that element, or else its main element. Without either it grows upwards from that
element to each one around it that adds text: a neighbour at or above the threshold, a
neighbour with a twentieth of the text found so far (in the body itself a quarter), or a
paragraph, heading or the like beside it.

Elements that are never article text (scripts, styles, forms, navigation, headers, footers,
sidebars, and boxes whose class, id or role names an advert, comments, notice, menu and the
like) are cut before the densities, so they carry no weight. A name counts as a whole or by
its head (``site-footer``, ``comment-list``), not by any word in it (``has-sidebar``), and a
box that holds most of the page's text outside links stays unless an article or main element
stands outside the boxes. Inside an article its own header (the title) stays, and so do boxes
whose name may as well be a topic (legal, share) if they hold paragraphs. Lists and divs that
hold nothing but links are cut, never a paragraph, and in an article or main element no list
right under a heading (sources).

Text: character references are decoded, white space inside a block is one space, blocks are
trimmed and joined by a line feed in page order; nothing else is dropped.

Defined results: null and empty pages, and pages without visible text, give an empty text;
unclosed, misnested and unknown tags are read as far as they make sense (an open paragraph
ends at the next block, the end of the page closes everything); very deep nesting is
walked without recursion; repeated rows give equal texts.
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import pick

#: Element names by their role in a page.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea noscript iframe xmp noembed noframes".split())
SKIP = RAW | frozenset("""head nav header footer aside form button select option template svg canvas
    object audio video menu dialog map fieldset label datalist""".split())
BLOCK = frozenset("""address article aside blockquote body caption center dd details dir div dl dt
    fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main
    menu nav ol p pre section summary table tbody td tfoot th thead tr ul""".split())
ENDS_P = BLOCK - frozenset("body html caption tbody td tfoot th thead tr".split())
#: Elements that an equal (or sibling) start tag closes, and where the search for them stops.
CLOSES = {"li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}),
          "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}),
          "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
          "tbody": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}),
          "tfoot": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}),
          "option": ({"option"}, {"select"})}
#: Words in class, id or role that mark a box as no part of the article.
BOXES = frozenset("""ad ads advert adverts advertisement advertising adbox sponsor sponsored promo
    promotion banner sidebar side menu nav navbar navigation navigationbar breadcrumb breadcrumbs
    pagination pager footer header masthead topbar toolbar cookie cookies consent gdpr notice notices
    popup modal overlay newsletter subscribe subscription signup login search share sharing social
    related recommended recommendations comment comments commentlist respond disqus replies reply
    widget widgets copyright legal disclaimer contentinfo complementary alert""".split())

#: Names that are a topic as well: inside an article such a box stays if it holds paragraphs.
TOPICS = frozenset("legal copyright disclaimer share sharing social alert widget widgets search login side".split())
#: Blocks that hold running text.
PROSE = frozenset("p h1 h2 h3 h4 h5 h6 li blockquote pre dd dt td th figcaption summary".split())

#: Words that may follow the name of a box, and words before which a name is only a state of the page.
AFTER_BOX = frozenset("""area bar block body bottom box btn button buttons col column container content
    footer form group header holder inner item items left link links list main outer panel post posts
    right row section slot space text thread title top unit wrap wrapper zone""".split())
STATES = frozenset("has have no not non with without is hide show hidden".split())

_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
                  r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)"
                  r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)", re.S)
_MARK = re.compile(r"""(?:^|[\s"'/])(class|id|role|hidden|style|aria-hidden)\s*(?:=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""",
                   re.I | re.S)
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_LETTER = re.compile(r"[^\W_]")
_SPACE = re.compile(r"\s+")


class Node:
    __slots__ = ("name", "children", "cut", "chars", "tags", "link_chars", "link_tags", "block", "density", "sum",
                 "box", "topic", "prose")

    def __init__(self, name: str, cut: bool = False, box: bool = False, topic: bool = False):
        self.name, self.cut, self.box, self.topic = name, cut, box, topic
        self.prose = False  # holds text outside links, or a paragraph
        self.children: list[Node | str] = []
        self.block = name in BLOCK  # or holds a block
        self.chars = self.tags = self.link_chars = self.link_tags = 0
        self.density = self.sum = 0.0


def _names_box(token: str) -> str | None:
    """The box that a class, id or role token names, as a whole or by its head."""
    parts = [p.lower() for p in _PART.findall(token)]
    if not parts or parts[0] in STATES:
        return None
    for name in (token.lower(), parts[-1]):
        if name in BOXES:
            return name
    return parts[0] if parts[0] in BOXES and all(p in BOXES or p in AFTER_BOX for p in parts[1:]) else None


def _marks(attributes: str) -> tuple[bool, bool, bool]:
    """(hidden, box, only boxes whose names are topics too) as the attributes say."""
    hidden, boxes = False, []
    if attributes and not attributes.isspace():
        for m in _MARK.finditer(attributes):
            key, value = m[1].lower(), (m[2] or "").strip("\"'")
            if key == "hidden" or key == "aria-hidden" and value.lower() == "true":
                hidden = True
            elif key == "style":
                hidden |= bool(re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I))
            elif key in ("class", "id", "role"):
                boxes += [b for t in value.split() if (b := _names_box(t))]
    return hidden, bool(boxes), all(b in TOPICS for b in boxes)


def _cut_boxes(root: Node) -> None:
    """Cut the boxes, but not one with most of the text outside links if no article or main
    element with text stands outside the boxes."""
    nodes = _order(root)
    if not any(n.box for n in nodes):
        return
    state = {id(root): (False, False)}  # (in a link, in a box)
    for n in nodes:
        link, box = state[id(n)]
        mine = (link or n.name == "a", box or n.box)
        state[id(n)] = mine
        for c in n.children:
            if not isinstance(c, str) and not c.cut:
                state[id(c)] = mine
    plain: dict[int, int] = {}
    outside = False
    for n in reversed(nodes):
        link, box = state[id(n)]
        plain[id(n)] = sum((0 if link else len("".join(c.split()))) if isinstance(c, str) else plain.get(id(c), 0)
                           for c in n.children)
        outside |= n.name in ("article", "main") and not box and plain[id(n)] > 0
    articles = {id(root): root.name == "article"}
    for n in nodes:
        for c in n.children:
            if not isinstance(c, str):
                articles[id(c)] = articles[id(n)] or c.name == "article"
        topic = n.topic and articles[id(n)] and any(
            not isinstance(c, str) and c.name in PROSE for c in n.children)
        if n.box and not topic and (outside or 2 * plain[id(n)] <= plain[id(root)]):
            n.cut = True


def parse(page: str) -> Node:
    """The element tree of a page (its body where there is one)."""
    root = Node("html")
    stack, at, n = [root], 0, len(page)
    body: Node | None = None
    while at < n:
        m = _TAG.search(page, at)
        if m is None:
            stack[-1].children.append(page[at:])
            break
        if m.start() > at:
            stack[-1].children.append(page[at:m.start()])
        at = m.end()
        name = m[2] or m[5]
        if name is None:
            if m[0].startswith("<![CDATA["):
                stack[-1].children.append(m[0][9:].removesuffix("]]>"))
            continue
        name, closing, attributes = name.lower(), bool(m[1] or m[4]), m[3] or m[6] or ""
        if closing:
            if name == "p" and not any(x.name == "p" for x in stack):
                continue
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].name == name:
                    if name not in ("body", "html"):
                        del stack[i:]
                    break
                # An inline end tag does not close blocks around it.
                if name not in BLOCK and name not in SKIP and stack[i].name in BLOCK:
                    break
            continue
        if name in RAW:
            end = re.compile(rf"</{re.escape(name)}(?=[\s/>])", re.I).search(page, at)
            stop = end.start() if end else n
            close = page.find(">", stop)
            at = n if end is None or close < 0 else close + 1
            continue
        if name == "html":
            continue
        if name == "body":
            if body is None:
                body = Node("body")
                root.children.append(body)
                stack = [root, body]
            continue
        if name in ENDS_P:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].name == "p":
                    del stack[i:]
                    break
                if stack[i].name in BLOCK:
                    break
        if name in CLOSES:
            ends, stops = CLOSES[name]
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].name in stops:
                    break
                if stack[i].name in ends:
                    del stack[i:]
                    # A row also ends the cells that are still open above it.
                    continue
        inner = name in ("article", "header") and any(x.name == "article" for x in stack)
        hidden, box, topic = _marks(attributes) if name not in ("article", "main") or inner else (False, False, False)
        # An article's own header holds its title.
        node = Node(name, name in SKIP and not (inner and name == "header") or hidden,
                    box and not (inner and name == "header"), topic)
        if name == "head":
            node.cut = True
        elif stack[-1].name == "head":
            del stack[-1]
        if name in VOID:
            stack[-1].children.append(node)
            continue
        if not attributes.endswith("/") or name not in VOID:
            stack[-1].children.append(node)
            stack.append(node)
    top = body if body is not None else root
    _cut_boxes(top)
    return top


def _order(root: Node) -> list[Node]:
    """Kept elements, parents before their children."""
    out, stack = [], [root]
    while stack:
        node = stack.pop()
        out.append(node)
        stack.extend(c for c in node.children if not isinstance(c, str) and not c.cut)
    return out


def measure(root: Node) -> list[Node]:
    """Fill in counts, densities and density sums; the elements, parents first."""
    nodes = _order(root)
    inside: dict[int, bool] = {}
    for node in nodes:
        link = inside.get(id(node), False) or node.name == "a"
        for c in node.children:
            if not isinstance(c, str) and not c.cut:
                inside[id(c)] = link
    own: dict[int, list[int]] = {}  # what stands in an element outside the blocks below it
    for node in reversed(nodes):
        link = inside.get(id(node), False) or node.name == "a"
        below, direct = [0, 0, 0, 0], [0, 0, 0, 0]
        for c in node.children:
            if isinstance(c, str):
                k = 0 if c.isspace() else len(c)
                node.prose |= bool(k) and not link and bool(_LETTER.search(html.unescape(c)))
                counts = (k, 0, k if link else 0, 0)
            elif c.cut:
                continue
            else:
                counts = (c.chars, c.tags + 1, c.link_chars, c.link_tags + (c.name == "a"))
                node.block = node.block or c.block
                node.prose |= c.prose or c.name == "p" and c.chars > 0
            into = below if not isinstance(c, str) and c.block else direct
            for i, k in enumerate(counts):
                into[i] += k
        own[id(node)] = direct
        node.chars, node.tags, node.link_chars, node.link_tags = (
            x + y for x, y in zip(below, direct, strict=True))
    share = root.link_chars / max(root.chars, 1)
    for node in reversed(nodes):
        node.density = _density(node.chars, node.tags, node.link_chars, node.link_tags, share)
        # Text that stands between the blocks counts as one more child.
        node.sum = _density(*own[id(node)], share) + sum(
            x.density for x in node.children if not isinstance(x, str) and not x.cut and x.block)
    return nodes


def _density(chars: int, tags: int, link_chars: int, link_tags: int, body_share: float) -> float:
    """Composite text density: characters per tag times a logarithm that falls with links,
    to a base that grows with the link share of the element and of the body (and is e where
    there are no links at all)."""
    if not chars:
        return 0.0
    tags, lc, lt = max(tags, 1), max(link_chars, 1), max(link_tags, 1)
    base = math.log(chars / max(chars - link_chars, 1) * link_chars + body_share * chars + math.e ** math.e)
    return chars / tags * math.log(max(chars / lc * tags / lt, 1.0)) / math.log(base)


def content(root: Node) -> tuple[Node | None, bool]:
    """The content subtree, and whether it is an article or main element."""
    nodes = measure(root)
    if not root.chars:
        return None, False
    best = max((n for n in nodes if n.block or n is root), key=lambda x: x.sum)  # the first of equals, which is the outer one
    if best.sum <= 0:
        return root, False
    parent = {id(c): n for n in nodes for c in n.children if not isinstance(c, str)}
    threshold, path = best.density, [best]
    while path[-1] is not root:
        path.append(parent[id(path[-1])])
        threshold = min(threshold, path[-1].density)
    for name in ("article", "main"):
        around = [n for n in path if n.name == name]
        if around:
            return around[-1], True
    # From the best element upwards: an element around it is content as a whole if it adds some.
    cover = best
    for inner, outer in zip(path, path[1:], strict=False):
        if any(_adds(c, cover, threshold, outer is root) for c in outer.children if c is not inner):
            cover = outer
    return cover, False


def _adds(c: Node | str, cover: Node, threshold: float, top: bool) -> bool:
    """Whether a neighbour of the content found so far belongs to it: it is at or above the
    threshold, holds a good part of running text, or (below the body) is itself a paragraph, a
    heading or the like."""
    whole = max(cover.chars - cover.link_chars, 1)
    if isinstance(c, str):
        return not c.isspace() and bool(_LETTER.search(c)) and len(c.strip()) * (4 if top else 20) >= whole
    if c.cut or not c.prose:
        return False
    return (c.density >= threshold or (c.chars - c.link_chars) * (4 if top else 20) >= whole
            or not top and c.name in PROSE)


def _link_list(node: Node) -> bool:
    """A list or div that holds links and nothing else."""
    return node.name in ("ul", "ol", "menu", "dir", "div") and node.link_tags >= 2 and not node.prose


def _headed(node: Node) -> set[int]:
    """Elements that follow a heading directly."""
    out = set()
    for n in _order(node):
        last = ""
        for c in n.children:
            if not isinstance(c, str) and not c.cut:
                if last in ("h1", "h2", "h3", "h4", "h5", "h6"):
                    out.add(id(c))
                last = c.name
            elif isinstance(c, str) and not c.isspace():
                last = ""
    return out


def blocks(node: Node, article: bool = False) -> list[str]:
    """Texts of the blocks of a subtree in page order. A list of links only is left out, but in an
    article not if it stands under a heading of its own."""
    headed = _headed(node) if article else set()
    out: list[str] = []
    run: list[str] = []

    def flush() -> None:
        text = _SPACE.sub(" ", html.unescape("".join(run))).strip()
        run.clear()
        if text:
            out.append(text)

    # (element, True) on the way in, False on the way out.
    stack: list[tuple[Node | str, bool]] = [(node, True)]
    while stack:
        x, entering = stack.pop()
        if isinstance(x, str):
            run.append(x)
        elif not entering:
            flush()
        elif x.cut or x is not node and _link_list(x) and id(x) not in headed:
            flush() if x.name in BLOCK else None
        else:
            if x.name in ("br", "hr"):
                run.append("\n")
            if x.name in BLOCK:
                flush()
                stack.append((x, False))
            stack.extend((c, True) for c in reversed(x.children))
    flush()
    return out


def extract(page: str | None) -> str:
    """The main text of one page."""
    if not page:
        return ""
    node, article = content(parse(page))
    return "\n".join(blocks(node, article)) if node is not None else ""


def extract_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
                 html_col: str = "html") -> DataFrame:
    """(id, url, text) for every row, read where the row is."""
    base = pick(pages, id=id_col, url=url_col, html=html_col)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, b.num_rows, 500):
                s = b.slice(lo, 500)
                texts = pa.array([extract(h) for h in s.column("html").to_pylist()], pa.string())
                yield pa.RecordBatch.from_arrays([s.column("id"), s.column("url"), texts],
                                                 names=["id", "url", "text"])

    kind = base.schema["id"].dataType.simpleString()
    return (base.mapInArrow(work, f"id {kind}, url string, text string")
            .select(F.col("id").alias(id_col), F.col("url").alias(url_col), "text"))
