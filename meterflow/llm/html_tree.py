"""A tolerant reader of HTML: element trees, text blocks."""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass, field
from html import unescape

TAG = re.compile(
    r"""<(?:(?P<comment>!--(?:.*?-->|>|.*))|(?P<bogus>[!?][^>]*(?:>|$))|(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*)(?:(?P<rest>(?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|(?P<loose>[^>]*)(?:>|$)))""",
    re.S,
)
ATTRIBUTE = re.compile(r"""(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
RAW = frozenset("script style textarea title noscript xmp iframe noembed noframes".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rb rp rt ruby s samp"
    " small span strike strong sub sup time tt u var wbr".split()
)
# What a starting tag ends, as far as it is open in the nearest of the elements named after it.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
#: Tags that end a paragraph; other tags leave it open.
_BLOCKS = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4"
    " h5 h6 header hgroup hr main menu nav ol p pre search section summary table ul".split()
)
_FENCE = frozenset("article aside blockquote body div footer header li main nav section table td th".split())


# Elements nest this deep at most; what is below stands side by side in the last one, as in browsers at their limit.
DEEPEST = 100


@dataclass(slots=True)
class Element:
    name: str
    marks: str = ""  # class, id and role
    children: list = field(default_factory=list)  # elements and strings


def parse(html: str) -> Element:
    """Tree of a page; open elements end where their parents do."""
    root = Element("#page")
    stack = [root]
    is_open: Counter[str] = Counter()
    at = 0

    def cut(depth: int) -> None:
        for ended in stack[depth:]:
            is_open[ended.name] -= 1
        if depth >= DEEPEST:
            # The end of a block among its siblings.
            stack[depth].children.append(Element(stack[depth].name))
        del stack[depth:]

    def start(element: Element) -> None:
        if len(stack) >= DEEPEST:
            element = Element(element.name, element.marks, stack[-1].children)
        is_open[element.name] += 1
        stack.append(element)

    def close(names: set[str] | frozenset[str], fence: set[str] | frozenset[str]) -> None:
        if not any(is_open[n] for n in names):
            return
        for depth in range(len(stack) - 1, 0, -1):
            if stack[depth].name in names:
                cut(depth)
                return
            if stack[depth].name in fence:
                return

    while True:
        match = TAG.search(html, at)
        text = html[at : match.start()] if match else html[at:]
        if text:
            stack[-1].children.append(unescape(text))
        if not match:
            return root
        at = match.end()
        if match["name"] is None:
            continue
        name = match["name"].lower()
        if match["close"]:
            if is_open[name]:
                cut(max(depth for depth in range(len(stack)) if stack[depth].name == name))
            continue
        if name in _BLOCKS:
            close({"p"}, _FENCE)
        if name in ENDS:
            close(*ENDS[name])
        rest = match["rest"] if match["rest"] is not None else match["loose"] or ""
        marks = ""
        if rest:
            marks = " ".join(unescape(a or b or c) for _, a, b, c in ATTRIBUTE.findall(rest)).lower()
        element = Element(name, marks)
        stack[-1].children.append(element)
        if name in RAW:
            end = re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*>?", re.I).search(html, at)
            at = end.end() if end else len(html)
        elif name not in VOID and not rest.endswith("/"):
            start(element)
        elif name not in VOID and name in _BLOCKS | INLINE | _FENCE:
            # A slash at the end of a tag that isn't void has no meaning.
            start(element)


def blocks(element: Element, skipped) -> list[str]:
    """Texts of the blocks in page order, blanks as single spaces; empty ones and skipped elements left out."""
    out: list[str] = []
    line: list[str] = []

    def flush() -> None:
        text = " ".join("".join(line).split())
        line.clear()
        if text:
            out.append(text)

    # An explicit stack: broken pages nest deeply.
    todo: list = [element]
    while todo:
        node = todo.pop()
        if node is None:
            flush()
        elif isinstance(node, str):
            line.append(node)
        elif node.name == "br":
            line.append(" ")
        elif node.name not in RAW and not skipped(node):
            if node.name not in INLINE:
                flush()
                todo.append(None)
            todo.extend(reversed(node.children))
    flush()
    return out
