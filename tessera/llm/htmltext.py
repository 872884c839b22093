"""Main text of web pages by composite text density.

Every node of a page's tree gets a density: its characters outside links per
tag below it (a node without tags counts one). A node's score is the sum of
its children's densities, or its own if it has none; the node with the highest
score is the core. Tags of blocks that are mostly links do not count. The least
density on the path from the body to the core, without the body unless it is
the core, is the page's threshold.
If an ``article`` or ``main`` element encloses the core, all its text is
returned; if the core holds some whose score reaches the threshold, that of the
highest score. Else the core is widened out of paragraphs, headings, lists and inline
markup to the first block that holds them. A block of the page beside the path
from the body to it (or in the body, if that is the core) goes if it is mostly
links, or if it has no text paragraph and less density than the threshold; in
a body that is itself the core, such a block stays if it has no links.

Before that, nodes that are never main text are cut: menus, footers, sidebars,
forms, scripts, styles and the like by tag, role or the words of their class
and id, page headers, adverts, notices and reader comments.

White space (as Unicode has it) inside a block becomes one space, ``br`` is
white space, blocks are joined in page order by one space. Null or empty html,
or a page without text, gives an empty text. Rows are independent: repeated
rows give equal results, an empty table none. The tree of one page is held in
memory at a time.
"""

from __future__ import annotations

import html as _html
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Batches

# Element and class names.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea xmp iframe noembed noframes".split())
NOISE_TAGS = frozenset(
    "head nav footer aside form script style noscript template select option button textarea title"
    " iframe object svg canvas menu dialog label input datalist audio video map xmp noembed noframes".split()
)
NOISE_ROLES = frozenset(
    "navigation banner complementary contentinfo search form dialog alertdialog alert menu menubar".split()
)
NOISE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising advertorial sponsor sponsored sponsors promo"
    " promoted promotion banner cookie cookies consent gdpr notice notices popup modal overlay"
    " newsletter subscribe subscription signup login sidebar widget widgets menu menus nav navbar"
    " navigation breadcrumb breadcrumbs masthead topbar toolbar footer share sharing social related"
    " recommended recommendations pagination pager copyright disclaimer".split()
)
COMMENT_WORDS = frozenset("comment comments commentlist disqus replies reply respond discussion".split())
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure"
    " footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main nav ol p pre section summary table"
    " tbody td tfoot th thead tr ul".split()
)
ENDS_P = BLOCKS - {"body", "html", "td", "th", "tr", "tbody", "thead", "tfoot"}
SIBLINGS = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
    "tbody": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}),
}
INNER = frozenset(
    "p h1 h2 h3 h4 h5 h6 li ul ol dl dd dt blockquote pre table tbody thead tr td th figure figcaption".split()
)
PARAGRAPHS = frozenset("p blockquote pre".split())

_TAG = re.compile(
    r"<!--(?:.*?-->|.*\Z)|<!\[CDATA\[.*?\]\]>|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)",
    re.S,
)
# Every attribute in turn, quoted values whole; a stray quoted text has no name.
_ATTR = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?|"[^"]*"|'[^']*'""")
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")


class Node:
    __slots__ = ("tag", "parent", "children", "noise", "chars", "link", "tags", "density", "score", "prose")

    def __init__(self, tag: str, parent: Node | None, noise: bool = False):
        self.tag, self.parent, self.noise = tag, parent, noise
        self.children: list[Node | str] = []
        self.chars = self.link = self.tags = 0
        self.density = self.score = 0.0
        self.prose = False  # has a paragraph that is not mostly links


def _is_noise(tag: str, attrs: str, inside: bool) -> bool:
    if tag in NOISE_TAGS or (tag == "header" and not inside):
        return True
    if not attrs or tag in ("html", "body"):
        return False
    for name, a, b, c in _ATTR.findall(attrs):
        name, value = name.lower(), a or b or c
        if name == "role":
            if value.lower() in NOISE_ROLES:
                return True
        elif name == "hidden" or (name == "aria-hidden" and value.lower() == "true"):
            return tag != "main"
        elif name in ("class", "id"):
            words = {w.lower() for w in _WORDS.findall(value)}
            if words & COMMENT_WORDS or (tag not in ("article", "main") and words & NOISE_WORDS):
                return True
    return False


def parse(text: str) -> Node:
    """Tree of a page; markup need not be well formed."""
    root = Node("html", None)
    body = Node("body", root)
    root.children.append(body)
    top, at = body, 0

    def pop_to(tags: set[str] | frozenset[str], stop: set[str] | frozenset[str]) -> None:
        nonlocal top
        n, found = top, None
        while n is not body and n.tag not in stop:
            if n.tag in tags:
                found = n
                if len(tags) == 1:
                    break
            n = n.parent
        if found is not None:
            top = found.parent

    pos, size = 0, len(text)
    while pos < size:
        m = _TAG.search(text, pos)
        if m is None:
            break
        if m.start() > at:
            top.children.append(text[at : m.start()])
        pos = at = m.end()
        tag = m.group(2)
        if tag is None:
            continue
        tag = tag.lower()
        if m.group(1):
            if tag == "p" and top.tag != "p":
                pop_to({"p"}, {"article", "section", "div", "td", "table"})
            elif tag not in ("html", "body", "br"):
                n = top
                block = tag in BLOCKS
                while n is not body and n.tag != tag and (block or n.tag not in BLOCKS):
                    n = n.parent
                if n is not body and n.tag == tag:
                    top = n.parent
            continue
        attrs = m.group(3) or ""
        if tag in ("html", "body"):
            continue
        if tag in ENDS_P:
            pop_to({"p"}, {"article", "section", "div", "td", "th", "li", "button", "table"})
        if tag in SIBLINGS:
            pop_to(*SIBLINGS[tag])
        inside = any(True for _ in _within(top, "article", "main"))
        node = Node(tag, top, _is_noise(tag, attrs, inside))
        top.children.append(node)
        if tag in RAW:
            end = re.compile(rf"</{tag}[\s/>]", re.I).search(text, pos)
            pos = at = end.start() if end else size
            top = node
        elif tag not in VOID and not attrs.endswith("/"):
            top = node
    if at < size:
        top.children.append(text[at:])
    return root


def _within(n: Node | None, *tags: str):
    while n is not None:
        if n.tag in tags:
            yield n
        n = n.parent


def _above(n: Node):
    """The parents of a node, up to the body."""
    while n.tag != "body":
        n = n.parent
        yield n


def _order(root: Node) -> list[Node]:
    """Nodes that are not noise, parents first."""
    out, todo = [], [root]
    while todo:
        n = todo.pop()
        out.append(n)
        todo.extend(c for c in n.children if isinstance(c, Node) and not c.noise)
    return out


def _measure(nodes: list[Node]) -> None:
    for n in reversed(nodes):
        for c in n.children:
            if isinstance(c, Node):
                if not c.noise:
                    n.chars += c.chars
                    n.link += c.chars if c.tag == "a" else c.link
                    n.tags += 0 if c.tag in BLOCKS and c.link * 2 > c.chars else c.tags + 1
                    n.score += c.density
                    n.prose |= c.prose
            else:
                n.chars += len("".join(c.split()))
        if n.tag == "a":
            n.link = n.chars
        n.density = (n.chars - n.link) / max(n.tags, 1)
        n.prose |= n.tag in PARAGRAPHS and n.chars > 0 and n.link * 2 <= n.chars


def _sum(n: Node) -> float:
    return n.score if n.tags else n.density


def _is_text(n: Node, threshold: float, whole: bool) -> bool:
    """Whether a block beside the core is main text; ``whole``: the core is the body itself."""
    if n.chars == 0 or n.link * 2 > n.chars:
        return False
    return n.tag in INNER or n.prose or n.density >= threshold or (whole and n.link == 0)


def _collect(n: Node, cut: set[int]) -> str:
    """Text of a subtree without the nodes of ``cut``."""
    blocks: list[str] = []
    run: list[str] = []

    def flush() -> None:
        words = " ".join("".join(run).split())
        if words:
            blocks.append(words)
        run.clear()

    todo: list[Node | str | None] = [n]
    while todo:
        x = todo.pop()
        if x is None:
            flush()
        elif isinstance(x, str):
            run.append(_html.unescape(x))
        elif not x.noise and id(x) not in cut:
            if x.tag == "br":
                run.append(" ")
                continue
            if x.tag in BLOCKS:
                flush()
                todo.append(None)
            todo.extend(reversed(x.children))
    flush()
    return " ".join(blocks)


def main_text(page: str | None) -> str:
    """Main text of one page."""
    if not page:
        return ""
    root = parse(page)
    body = root.children[0]
    nodes = _order(body)
    _measure(nodes)
    if body.chars == 0:
        return ""
    core = max(nodes, key=lambda n: (_sum(n), n.chars))
    path = list(_within(core, *{n.tag for n in nodes}))
    threshold = min(n.density for n in path if n is core or n not in (body, root))
    for holder in _within(core, "article", "main"):
        return _collect(holder, set())
    inner = [n for n in _order(core) if n.tag in ("article", "main") and n.chars and _sum(n) >= threshold]
    if inner:
        return _collect(max(inner, key=lambda n: (_sum(n), n.chars)), set())
    while core is not body and (core.tag in INNER or core.tag not in BLOCKS):
        core = core.parent
    trunk = [core] if core is body else list(_above(core))
    kept = {id(core), *map(id, trunk)}
    cut = {
        id(c)
        for n in trunk
        for c in n.children
        if isinstance(c, Node) and id(c) not in kept and c.tag in BLOCKS
        and not _is_text(c, threshold, core is body)
    }
    return _collect(body, cut)


def _extract(batches: Batches) -> Batches:
    for b in batches:
        texts = [main_text(x.as_py()) for x in b.column(2)]
        yield pa.RecordBatch.from_arrays(
            [b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
            ["page_id", "url", "text", "n_chars"],
        )


def extract_text(pages: DataFrame, id_col: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """page_id, url, text and n_chars (code points) of every page."""
    return pages.select(
        F.col(id_col).cast("long").alias("page_id"), F.col(url).alias("url"), F.col(html).alias("html")
    ).mapInArrow(_extract, "page_id long, url string, text string, n_chars long")
