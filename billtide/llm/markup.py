"""HTML as a tree of blocks, without a browser's full rules: what is cut short, unclosed or misnested is taken as meant.

Any text gives a tree in time linear in its length. Inline markup is no node, only its text counts; of links the length is kept.
"""

from __future__ import annotations

import html
import re

# Fixed values of HTML: elements without content, elements whose content is no markup, and what ends an open element.
VOID = frozenset("area base br col embed frame hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark nobr q rp rt ruby s samp small "
    "span strike strong sub sup time tt u var wbr".split()
)
#: Starting one of these ends open ones of the others, up to the container behind the colon.
ENDED_BY = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"thead", "tbody", "tfoot", "tr", "td", "th"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tfoot", "tr", "td", "th"}, {"table"}),
    "option": ({"option"}, {"select"}),
    "body": ({"head"}, {"html"}),
}
SCOPES = frozenset("table td th caption button object html".split())

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^<>]*>|"
    r"<(/?)([a-zA-Z][^\s/<>]*)"
    r"((?:[^<>\"']++|\"[^\"<]*+\"|'[^'<]*+'|\"[^\"]{0,1000}+\"|'[^']{0,1000}+')*+|[^<>]*+)>",
    re.S,
)
ATTRIBUTE = re.compile(r"\b(id|class|role|itemprop|hidden|aria-hidden|style)\s*+(?:=\s*+(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
DIGITS = re.compile(r"[0-9]+")
#: Deeper elements are taken as part of the one at this depth.
MOST_DEPTH = 60


class Node:
    """An element: its label (tag, id, classes and role without digits) and its children, nodes or texts."""

    __slots__ = ("label", "tag", "names", "children", "mark")

    def __init__(self, tag: str, names: str):
        self.tag, self.names, self.label = tag, names, tag + names
        self.children: list[Node | Text] = []
        self.mark = ""


class Text:
    """A run of text in a block: the text with its white space turned into single blanks, and how much of it is linked."""

    __slots__ = ("parts", "linked")
    label = "#"

    def __init__(self):
        self.parts: list[str] = []
        self.linked = 0

    def text(self) -> str:
        return " ".join("".join(self.parts).split())


def names_of(attributes: str) -> str:
    """Id, classes, role and the like, without digits, in one order."""
    if "=" not in attributes and "hidden" not in attributes:
        return ""
    found = []
    for m in ATTRIBUTE.finditer(attributes):
        key, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
        if key == "class":
            found += sorted("." + c for c in DIGITS.sub("", value).split())
        elif key == "id":
            found.append("#" + DIGITS.sub("", value.strip()))
        elif key in ("hidden", "aria-hidden", "style"):
            squeezed = value.replace(" ", "")
            if key == "hidden" or squeezed == "true" or "display:none" in squeezed or "visibility:hidden" in squeezed:
                found.append("!hidden")
        else:
            found.append(f"[{value.strip()}]")
    return "".join(found)


def parse(source: str) -> Node:
    """The tree of blocks of a page."""
    root = Node("", "")
    stack, links, at, size = [root], 0, 0, len(source)
    run: Text | None = None

    def add(text: str) -> None:
        nonlocal run
        if not text:
            return
        if run is None:
            run = Text()
            stack[-1].children.append(run)
        run.parts.append(html.unescape(text) if "&" in text else text)
        if links:
            run.linked += len(text)

    def close(tags: set[str] | frozenset[str], stop: set[str] | frozenset[str]) -> None:
        """Ends the outermost open element of ``tags`` above the nearest one of ``stop``."""
        last = 0
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag in tags:
                last = i
            elif stack[i].tag in stop:
                break
        if last:
            del stack[last:]

    while at < size:
        m = TOKEN.search(source, at)
        if m is None:
            add(source[at:])
            break
        add(source[at : m.start()])
        at = m.end()
        if m[2] is None:
            continue
        tag, ends, attributes = m[2].lower(), m[1], m[3]
        if tag in RAW and not ends:
            over = re.compile(rf"</{tag}(?=[\s/>]|\Z)[^>]*>?", re.I).search(source, at)
            run = None
            node = Node(tag, names_of(attributes))
            stack[-1].children.append(node)
            at = over.end() if over else size
        elif tag in INLINE:
            if tag == "br":
                add(" ")
            elif tag == "a":
                links = 0 if ends else 1
        elif ends:
            run, links = None, 0
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == tag:
                    del stack[i:]
                    break
                if stack[i].tag in ("table", "article", "main") and tag not in ("body", "html", "article", "main", "table"):
                    break
        else:
            run, links = None, 0
            if tag in ENDED_BY:
                close(*ENDED_BY[tag])
            else:
                close({"p", "h1", "h2", "h3", "h4", "h5", "h6"}, SCOPES | {"div", "section", "article", "main", "li", "dd", "body", "blockquote"})
            if tag in VOID:
                continue
            node = Node(tag, names_of(attributes))
            stack[-1].children.append(node)
            if len(stack) < MOST_DEPTH and not attributes.endswith("/"):
                stack.append(node)
            elif len(stack) >= MOST_DEPTH:
                stack[-1].children.pop()
    return root
