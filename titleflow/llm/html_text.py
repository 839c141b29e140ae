"""Main text of web pages by composite text density.

A page becomes a tree of element nodes. Text that no reader sees as the
article's (scripts, menus, forms, notices, comments, told by tag, role and
by the words of class and id) is cut off first, but by its name alone no
node that holds most of the page's paragraphs. Every remaining node has
its characters, tags, link characters and link tags; its composite density

    (C / T) * log_b(C / LC * T / LT),
    b = ln(C / (C - LC) * LC + LC_body / C_body * C + e)

is the characters per tag, adjusted downwards by how much of them is links.
A node's density sum adds the densities of its children. The threshold is
the smallest density on the path from the body to the node with the
greatest density sum. From the body down, as long as nodes reach the
threshold, the subtree of the greatest sum inside each of them belongs to
the article. The blocks of all these subtrees are joined in page order.

Pages are independent: Spark deals them out, a task holds one Arrow batch.
"""

from __future__ import annotations

import html as entities
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Content up to the end tag is no markup.
RAW = frozenset("script style textarea title noscript template iframe xmp noembed noframes".split())
DROPPED = RAW | frozenset(
    "head nav header footer aside form button select option menu dialog svg canvas audio video object "
    "applet map input fieldset label math".split())
BLOCK = frozenset(
    "html body address article blockquote center dd details div dl dt figcaption figure h1 h2 h3 h4 h5 h6 hgroup "
    "hr li main ol p pre section summary table tbody td tfoot th thead tr ul caption search legend".split())
#: Tags whose element ends where one of the given tags begins.
_CLOSES = {
    "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]),
    "tr": frozenset(["tr", "td", "th"]), "td": frozenset(["td", "th"]), "th": frozenset(["td", "th"]),
    "option": frozenset(["option"]), "tbody": frozenset(["thead", "tbody", "tr", "td", "th"]),
    "tfoot": frozenset(["tbody", "tr", "td", "th"]),
}
_SCOPE = {"li": frozenset(["ul", "ol", "menu"]), "dt": frozenset(["dl"]), "dd": frozenset(["dl"]),
          "tr": frozenset(["table"]), "td": frozenset(["table"]), "th": frozenset(["table"]),
          "tbody": frozenset(["table"]), "tfoot": frozenset(["table"]), "option": frozenset(["select"])}
#: Words of class, id and role that mark what is not the article.
_MARKED = re.compile(
    r"(?:^|[\s_\-])(?:ads?|advert\w*|adsense|adbox|banner|sponsor\w*|promo\w*|nav|navbar|navigation|menu\w*|"
    r"breadcrumbs?|sidebar\w*|side|aside|widgets?|footer|foot|header|masthead|topbar|toolbar|comments?|"
    r"comment\w*|disqus|replies|reply|respond|share|sharing|social|related|recommend\w*|newsletter|subscribe|"
    r"signup|login|search|cookies?|consent|gdpr|notices?|popup|modal|overlay|pagination|pager|tags|copyright|"
    r"complementary|contentinfo|dialog|alert)(?:$|[\s_\-])", re.I)
#: Names that tell of a layout with or without such a part, not of the part.
_LAYOUT = re.compile(r"(?<!\S)(?:has|with|without|no|not|hide|show)[_\-]\S*", re.I)
_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*)(?:>|\Z)",
                    re.S)
_ATTRIBUTE = re.compile(r"""([^\s=/>"']+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""")
#: White space that HTML folds, and the no-break and other Unicode blanks.
_BLANKS = re.compile(r"\s+")
#: One character each that no text holds: a block's edge.
_EDGE = "\x00"


class Node:
    __slots__ = ("tag", "children", "parent", "dropped", "named", "chars", "tags", "link_chars", "link_tags", "density", "sum",
                 "top", "home")

    def __init__(self, tag: str, parent: Node | None, dropped: bool = False):
        self.tag, self.parent, self.dropped, self.named = tag, parent, dropped, False
        self.children: list[Node | str] = []


def _is_dropped(tag: str, attributes: str) -> bool:
    if tag in DROPPED:
        return True
    if not attributes or tag in ("html", "body", "main", "article"):
        return False
    for name, a, b, c in _ATTRIBUTE.findall(attributes):
        low = name.lower()
        if low == "aria-hidden" and (a or b or c).lower() == "true":
            return True
        if low == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", a or b or c, re.I):
            return True
    return bool(re.search(r"(?:^|\s)hidden(?:$|\s)", re.sub(r"""=\s*("[^"]*"|'[^']*'|\S+)""", "=", attributes), re.I))


def _is_named(tag: str, attributes: str) -> bool:
    """Whether class, id or role call the element something else than the article."""
    return bool(attributes) and tag not in ("html", "body", "main", "article") and any(
        name.lower() in ("class", "id", "role") and _MARKED.search(_LAYOUT.sub(" ", a or b or c))
        for name, a, b, c in _ATTRIBUTE.findall(attributes))


def _drop_named(root: Node) -> None:
    """Drop the named nodes, but none with most of the page's text in blocks
    outside links, unless an article stands beside it: there the density decides."""
    nodes = _preorder(root)
    if not any(n.named for n in nodes):
        return
    for n in nodes:
        n.link_chars = n.tag == "a" or n.parent is not None and n.parent.link_chars
        n.chars = 0 if n.link_chars else sum(len("".join(c.split())) for c in n.children if isinstance(c, str))
        n.tags = 0  # characters in blocks below the node
        n.link_tags = int(n.tag == "article")  # articles in the subtree
    for n in reversed(nodes):
        if n.parent is not None:
            block = n.tag in BLOCK
            n.parent.tags += n.tags + n.chars if block else n.tags
            n.parent.chars += 0 if block else n.chars
            n.parent.link_tags += n.link_tags
    for n in nodes:
        beside = n.named and root.link_tags > n.link_tags and (
            root.link_tags > n.link_tags + sum(a.tag == "article" for a in _path(n)))
        n.dropped = n.named and (beside or 2 * n.tags <= root.tags + root.chars)


def parse(page: str) -> Node:
    """The page's tree; ends that are missing or misplaced are repaired."""
    root = Node("html", None)
    here, at, end = root, 0, len(page)
    while at < end:
        m = _TOKEN.search(page, at)
        if m is None:
            here.children.append(page[at:])
            break
        if m.start() > at:
            here.children.append(page[at:m.start()])
        at = m.end()
        tag = m[2]
        if tag is None:
            continue
        tag = tag.lower()
        if m[1]:
            node = here
            while node is not None and node.tag != tag:
                node = node.parent
            if node is not None and node.parent is not None:
                here = node.parent
            continue
        if tag in ("html", "body") and any(n.tag == tag for n in _path(here)) or tag == "html":
            continue
        here = _closed_before(here, tag)
        node = Node(tag, here, _is_dropped(tag, m[3]))
        node.named = not node.dropped and _is_named(tag, m[3])
        here.children.append(node)
        if tag in RAW:
            close = re.compile(rf"</{tag}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.I).search(page, at)
            at = close.end() if close else end
        elif tag not in VOID and not m[3].endswith("/"):
            here = node
    _drop_named(root)
    return root


def _path(node: Node | None) -> Iterator[Node]:
    while node is not None:
        yield node
        node = node.parent


def _closed_before(here: Node, tag: str) -> Node:
    """The element that a new element belongs to, after implied ends."""
    if tag in BLOCK:
        for node in _path(here):  # a paragraph ends where a block begins
            if node.tag == "p" and node.parent is not None:
                return _closed_before(node.parent, tag)
            if node.tag in BLOCK or node.tag in DROPPED:
                break
    ends = _CLOSES.get(tag)
    if ends:
        for node in _path(here):
            if node.tag in ends and node.parent is not None:
                return _closed_before(node.parent, tag)
            if node.tag in _SCOPE[tag]:
                break
    return here


def _preorder(root: Node) -> list[Node]:
    """All kept nodes, parents first (no recursion: pages can nest deeply)."""
    out, stack = [], [root]
    while stack:
        node = stack.pop()
        out.append(node)
        stack.extend(c for c in reversed(node.children) if isinstance(c, Node) and not c.dropped)
    return out


def measure(nodes: list[Node]) -> None:
    """Characters, tags and density of every node of a preorder list."""
    for n in nodes:
        n.chars = sum(len("".join(c.split())) for c in n.children if isinstance(c, str))
        n.tags = n.link_chars = n.link_tags = 0
        n.density = n.sum = 0.0
    for n in reversed(nodes):  # children before parents
        if n.tag == "a":
            n.link_chars = n.chars
        if (p := n.parent) is not None:
            p.chars += n.chars
            p.tags += n.tags + 1
            p.link_chars += n.link_chars
            p.link_tags += n.link_tags + (n.tag == "a")
    body = nodes[0]
    ratio = body.link_chars / body.chars if body.chars else 0.0
    for n in nodes:
        if not n.chars:
            continue
        tags, links, link_tags = max(n.tags, 1), max(n.link_chars, 1), max(n.link_tags, 1)
        plain = max(n.chars - n.link_chars, 1)
        base = math.log(n.chars / plain * n.link_chars + ratio * n.chars + math.e)
        value = n.chars / links * tags / link_tags
        n.density = max(0.0, n.chars / tags * (math.log(value) / math.log(base) if base > 1 else math.log(value)))
        if n.parent is not None and n.parent.sum is not None:
            n.parent.sum += n.density


def article_of(root: Node) -> list[Node]:
    """The subtrees of the greatest density sums under the body's threshold,
    in page order, none inside another."""
    body = next((n for n in _preorder(root) if n.tag == "body"), root)
    body.parent = None
    nodes = _preorder(body)
    measure(nodes)
    best = max(nodes, key=lambda n: n.sum)
    threshold = min(n.density for n in _path(best))
    for n in nodes:
        # paragraphs cut up by a wrapper of their own belong to the same article
        n.home = n if n.tag in ("article", "main") else n.parent and n.parent.home
        n.top = n if n.tag in BLOCK else None
    for n in reversed(nodes):  # the first block of the greatest sum in the node's subtree
        p = n.parent
        if p is not None and n.top is not None and (p.top is None or (n.top.sum, p.top is not p) > (p.top.sum, False)):
            p.top = n.top
    marked, stack = set(), [body]
    while stack:
        node = stack.pop()
        if node.density >= threshold:
            if node.chars and node.top is not None:
                marked.add(node.top.home or node.top)
            stack.extend(c for c in node.children if isinstance(c, Node) and not c.dropped)
    out, stack = [], [body]
    while stack:
        node = stack.pop()
        if node in marked:
            out.append(node)
        else:
            stack.extend(c for c in reversed(node.children) if isinstance(c, Node) and not c.dropped)
    return out


def _clean(text: str) -> str:
    return _BLANKS.sub(" ", entities.unescape(text)).strip()


def blocks(node: Node) -> list[str]:
    """Texts of the subtree's blocks in page order, white space folded."""
    parts: list[str] = []
    stack: list[Node | str] = [node]
    while stack:
        item = stack.pop()
        if isinstance(item, str):
            parts.append(item)
        elif item.tag == "br":
            parts.append(" ")
        elif not item.dropped:
            edge = item.tag in BLOCK
            if edge:
                parts.append(_EDGE)
                stack.append(_EDGE)
            stack.extend(reversed(item.children))
    out = (_clean(b) for b in "".join(parts).split(_EDGE))
    return [b for b in out if b]


def extract(page: str | None) -> str:
    """The article of a page; null, empty and textless pages: empty."""
    if not page:
        return ""
    return "\n\n".join(b for n in article_of(parse(page.replace(_EDGE, "�"))) for b in blocks(n))


def extract_pages(pages: DataFrame, id_col: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """One row per input row: id, url, text, n_chars (code points).

    Null html is an empty text; repeated rows and null ids give a row each;
    other columns are ignored.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [extract(x) for x in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()),
                 pa.array(list(map(len, texts)), pa.int64())], [id_col, url, "text", "n_chars"])

    kind = pages.schema[id_col].dataType.simpleString()
    return pages.select(id_col, url, html).mapInArrow(
        run, f"`{id_col}` {kind}, `{url}` string, text string, n_chars long")
