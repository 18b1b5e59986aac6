"""Main text of a web page by scoring its element tree.

Paragraphs earn points for their length and commas and pass them to their ancestors (all to the parent, half to the next, less
above); an element's points are discounted by the share of its text inside links. The element with the most points is
the article, with those of its siblings that hold text with few links. Menus, headers, footers, sidebars,
notices, adverts, forms, scripts, styles and comments are left out by element, role and class before anything is scored. A class or id
leaves an element out only if it holds less than half of the page's prose: layout wrappers have such names too.

Null and empty pages give an empty text. A page that breaks off anywhere gives what was there. Of elements with equal points the first one is the article. Very
long and very deep pages are read whole, in time that grows with their length: points go up ``LEVELS`` levels, beyond which an ancestor's share would be under half a hundredth, and
the tree is built without a search up to its root. Pages that repeat give equal rows, an empty table none; columns beside page_id, url and html do not matter.
"""

import html
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Element names of HTML by the part they play.
RAW = {"script", "style", "textarea", "title", "noscript", "iframe", "xmp", "noembed", "noframes"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
LEFT_OUT = {
    "script", "style", "noscript", "template", "head", "title", "nav", "footer", "aside", "form", "button", "select", "option", "textarea", "input",
    "iframe", "object", "embed", "applet", "svg", "canvas", "audio", "video", "map", "dialog", "menu", "xmp", "noembed", "noframes", "datalist", "fieldset",
}
BLOCK = {
    "address", "article", "aside", "blockquote", "body", "caption", "center", "dd", "details", "div", "dl", "dt", "fieldset", "figcaption", "figure",
    "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hgroup", "hr", "html", "legend", "li", "main", "menu", "nav", "ol", "p", "pre",
    "section", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul",
}
CLOSES_P = BLOCK - {"caption", "legend", "td", "th", "tr", "tbody", "thead", "tfoot", "body", "html"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
PROSE = {"p", "pre", "blockquote", "td", "li", "dd", "figcaption", *HEADINGS}
#: An opening tag of the key ends an open element of the set, unless one of the stops lies between.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"}),
}
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alert", "alertdialog", "menu", "menubar", "toolbar", "status", "tablist"}
UNLIKELY = re.compile(
    r"(?:^|[^a-z])(?:ads?|adverts?|advertisements?|adbox|adslot|banners?|sponsor(?:ed|s)?|promos?|promotions?|cookies?|consent|gdpr|notices?|alerts?|"
    r"menus?|nav|navbar|navigation|breadcrumbs?|sidebars?|side|rail|footers?|headers?|masthead|comments?|commentlist|disqus|respond|replies|reply|"
    r"shar(?:e|ing)|social|related|recommend(?:ed|ations)?|subscri(?:be|ption)|newsletter|popups?|modals?|overlay|widgets?|login|signup|search|"
    r"pagination|pager|toolbar|skip|hidden|toc)(?:$|[^a-z])"
)
_TAG = re.compile(r"""<!--.*?(?:--!?>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:"[^"]*"|'[^']*'|[^'">])*)(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)""", re.S)
_ATTRIBUTE = re.compile(r"""([a-zA-Z_:][-\w:.]*)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")


LEVELS = 64
#: Where the search for an open paragraph ends.
_SCOPES = ("p", "td", "th", "li", "table", "button", "object")


class Node:
    __slots__ = ("children", "length", "linked", "named", "out", "parent", "points", "scope", "tag")

    def __init__(self, tag: str, parent: "Node | None", out: bool):
        self.tag, self.parent, self.out = tag, parent, out
        self.scope: Node | None = self if tag in _SCOPES else parent.scope if parent else None
        self.children: list[Node | str] = []
        self.points = 0.0
        self.named = False  # a class or id that boilerplate has
        self.length = self.linked = 0


def _attributes(attributes: str) -> dict[str, str]:
    return {k.lower(): a or b or c for k, a, b, c in _ATTRIBUTE.findall(attributes)}


def _named(tag: str, attributes: str) -> bool:
    if not attributes or tag in ("html", "body", "article", "main", "header") or tag in HEADINGS:
        return False
    named = _attributes(attributes)
    marks = re.sub(r"([a-z])([A-Z])", r"\1 \2", f"{named.get('class', '')} {named.get('id', '')}").lower()
    return bool(UNLIKELY.search(marks))


def _dropped(tag: str, attributes: str, in_article: bool) -> bool:
    if tag in LEFT_OUT or tag == "header" and not in_article:
        return True
    if not attributes or tag in ("html", "body", "article", "main"):
        return False
    named = _attributes(attributes)
    if named.get("role", "").lower() in ROLES or "hidden" in named or named.get("aria-hidden") == "true":
        return True
    return bool(re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", named.get("style", "").lower()))


def _leave_out_named(root: Node) -> None:
    """Leaves out elements by class or id, outermost first, unless they hold half of the prose: that of article and main if these hold a quarter."""
    order, todo = [], [root]
    while todo:
        node = todo.pop()
        order.append(node)
        todo += [c for c in node.children if isinstance(c, Node) and not c.out]
    prose: dict[int, int] = {}
    inside: dict[int, int] = {}
    for node in reversed(order):
        inner = [c for c in node.children if isinstance(c, Node) and not c.out]
        text = sum(len(c.strip()) for c in node.children if isinstance(c, str))
        prose[id(node)] = 0 if node.tag == "a" else text + sum(prose[id(c)] for c in inner)
        inside[id(node)] = prose[id(node)] if node.tag in ("article", "main") else sum(inside[id(c)] for c in inner)
    held = inside if 4 * inside[id(root)] >= prose[id(root)] else prose
    todo = [root]
    while todo:
        node = todo.pop()
        if node.named and 2 * held[id(node)] < max(held[id(root)], 1):
            node.out = True
        else:
            todo += [c for c in node.children if isinstance(c, Node) and not c.out]


def tree(page: str) -> Node:
    """The element tree, with open and misplaced tags put right in the ways that matter for text."""
    root = node = Node("#", None, False)
    at, size = 0, len(page)
    open_tags: Counter[str] = Counter()  # from the root down to ``node``

    def leave(to: Node) -> Node:
        up = node
        while up is not to:
            open_tags[up.tag] -= 1
            up = up.parent
        return to

    while at < size:
        m = _TAG.search(page, at)
        if not m:
            break
        if m.start() > at:
            node.children.append(page[at : m.start()])
        at = m.end()
        closing, tag = m[1] or m[4], (m[2] or m[5] or "").lower()
        if not tag:
            continue
        if closing:
            if open_tags[tag]:
                up = node
                while up.tag != tag:
                    up = up.parent
                node = leave(up.parent)
            continue
        if tag in CLOSES_P and node.scope and node.scope.tag == "p":
            node = leave(node.scope.parent)
        if tag in ENDS and any(open_tags[t] for t in ENDS[tag][0]):
            ended, stops = ENDS[tag]
            up, to = node, None
            while up.parent and up.tag not in stops:
                if up.tag in ended:
                    to = up.parent
                up = up.parent
            node = leave(to) if to else node
        attributes = m[3] if m[3] is not None else m[6] or ""
        child = Node(tag, node, node.out or _dropped(tag, attributes, bool(open_tags["article"] or open_tags["main"])))
        child.named = _named(tag, attributes)
        node.children.append(child)
        if tag in RAW:
            end = re.compile(rf"</{tag}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.I).search(page, at)
            if not child.out:
                child.children.append(page[at : end.start() if end else size])
            at = end.end() if end else size
        elif tag not in VOID and not (attributes.endswith("/") and tag not in BLOCK):
            node = child
            open_tags[tag] += 1
    if at < size:
        node.children.append(page[at:])
    _leave_out_named(root)
    return root


def _measure(root: Node) -> list[Node]:
    """Text and link lengths of all kept elements, and points from prose to its ancestors. Elements in page order."""
    order, todo = [], [root]
    while todo:
        node = todo.pop()
        order.append(node)
        todo += [c for c in reversed(node.children) if isinstance(c, Node) and not c.out]
    commas: dict[int, int] = {}
    for node in reversed(order):
        n = 0
        for c in node.children:
            if isinstance(c, str):
                node.length += len(c.strip())
                n += c.count(",") + c.count("，") + c.count("、")
            elif not c.out:
                node.length += c.length
                node.linked += c.linked
                n += commas[id(c)]
        commas[id(node)] = n
        if node.tag == "a":
            node.linked = node.length
    for node in order:
        loose = node.tag in ("div", "section", "article", "main", "body") and any(isinstance(c, str) and c.strip() for c in node.children)
        if not node.length or not (node.tag in PROSE or loose):
            continue
        points = (1 + commas[id(node)] + min(node.length / 100, 3)) * (1 - node.linked / node.length)
        if loose:
            node.points += points
        up, level = node.parent, 0
        while up and level < LEVELS:
            up.points += points / (1 if level == 0 else 2 if level == 1 else 3 * level)
            up, level = up.parent, level + 1
    return order


def _density(node: Node) -> float:
    return node.linked / node.length if node.length else 0.0


def article(root: Node) -> list[Node | str]:
    """The best container, and all beside it that holds text with few links or is a heading, in page order."""
    order = [n for n in _measure(root) if n.length]
    best = max((n for n in order if n.tag not in PROSE or n.tag in ("td", "blockquote")), key=lambda n: n.points * (1 - _density(n)), default=None)
    if best is None or best.points <= 0:
        return [n for n in order[:1]]
    up = best
    while up.parent:  # an article holds its own headings and sections
        up = up.parent
        if up.tag in ("article", "main"):
            best = up
            break
    if best.parent is None or best.tag in ("article", "main", "body", "html"):
        return [best]
    runs: list[list[Node | str]] = [[]]  # blocks alone; text and inline elements between them together
    for node in best.parent.children:
        if not isinstance(node, str) and (node.out or node.tag in BLOCK):
            runs += [[node], []]
        else:
            runs[-1].append(node)
    out = []
    for run in runs:
        run = [n for n in run if isinstance(n, str) or not n.out]
        length = sum(len(n.strip()) if isinstance(n, str) else n.length for n in run)
        linked = sum(n.linked for n in run if not isinstance(n, str))
        if length and (best in run or linked < 0.25 * length or (not isinstance(run[0], str) and run[0].tag in HEADINGS)):
            out += run
    return out


def _blocks(nodes: list[Node | str]) -> list[str]:
    out: list[str] = []
    line: list[str] = []

    def end() -> None:
        text = " ".join(html.unescape("".join(line)).split())
        if text:
            out.append(text)
        line.clear()

    todo: list = list(reversed(nodes))
    while todo:
        item = todo.pop()
        if item is None:
            end()
        elif isinstance(item, str):
            line.append(item)
        elif not item.out:
            if item.tag == "br":
                line.append(" ")
            edge = item.tag in BLOCK
            if edge:
                end()
                todo.append(None)
            todo += reversed(item.children)
    end()
    return out


def main_text(page: str | None) -> str:
    return "\n".join(_blocks(article(tree(page)))) if page else ""


def extract(page: Column) -> Column:
    """Main text of a page. Whole pages, one at a time; no shuffle."""

    @F.arrow_udf("string")
    def run(column: pa.Array) -> pa.Array:
        return pa.array([main_text(x.as_py()) for x in column], pa.string())

    return run(page)


def report(pages: DataFrame) -> DataFrame:
    rows = pages.select("page_id", "url", extract(F.col("html")).alias("text"))
    return rows.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
