"""A small tolerant HTML parser: element trees with their texts."""

from __future__ import annotations

import html
import re
from dataclasses import dataclass, field

#: Element classes of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes plaintext".split())
HIDDEN = frozenset("script style template noscript head title meta link iframe object embed svg math canvas audio video noembed noframes".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section summary table tbody td tfoot "
    "th thead tr ul caption".split()
)
#: Elements that a start tag of one of the named ones ends, within the bounds after the bar.
ENDS_P = BLOCK - {"body", "html", "td", "th", "tr", "tbody", "thead", "tfoot", "caption", "legend"}
IMPLIED = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dd": ({"dd", "dt"}, {"dl"}), "dt": ({"dd", "dt"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}), "tfoot": ({"tbody", "thead", "tr", "td", "th"}, {"table"}),
    "option": ({"option"}, {"select"}), "optgroup": ({"option", "optgroup"}, {"select"}),
}
P_BOUNDS = frozenset("table td th caption html body article section div blockquote li dd button object".split())

MARKUP = re.compile(r"<(?:!--(?:.*?-->|.*)|(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*'|[\"'])*?)(>|\Z)|[!?/][^>]*(?:>|\Z))", re.S)
ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")


@dataclass(slots=True)
class Node:
    """An element; its children are nodes and strings in page order."""

    tag: str
    attrs: dict[str, str] = field(default_factory=dict)
    children: list = field(default_factory=list)


def _attributes(source: str) -> dict[str, str]:
    if not source or source.isspace():
        return {}
    found: dict[str, str] = {}
    for name, *values in ATTRIBUTE.findall(source):
        found.setdefault(name.lower(), html.unescape(next((v for v in values if v), "")))
    return found


def _close(stack: list[Node], names: set[str] | frozenset[str], bounds: set[str] | frozenset[str]) -> None:
    """Pop up to the innermost element of names, unless one of bounds is nearer."""
    for i in range(len(stack) - 1, 0, -1):
        if stack[i].tag in names:
            del stack[i:]
            return
        if stack[i].tag in bounds:
            return


def parse(source: str) -> Node:
    """The tree of a page or a part of one, of any depth. Never fails: unknown, unclosed and cut-off markup has a place.

    Comments and a tag that the end of the page cuts off are no text; an end tag without its start is ignored.
    """
    root = Node("#root")
    stack, at, n = [root], 0, len(source)
    while at < n:
        found = MARKUP.search(source, at)
        if not found:
            stack[-1].children.append(html.unescape(source[at:]))
            break
        if found.start() > at:
            stack[-1].children.append(html.unescape(source[at : found.start()]))
        at = found.end()
        closing, tag, attrs, end = found.groups()
        if tag is None or end == "":
            continue
        tag = tag.lower()
        if closing:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == tag:
                    del stack[i:]
                    break
                if tag not in BLOCK and stack[i].tag in BLOCK and tag not in ("a", "b", "i", "em", "strong", "span", "font", "u"):
                    break
            continue
        if tag in ENDS_P:
            _close(stack, {"p"}, P_BOUNDS)
        if tag in IMPLIED:
            _close(stack, *IMPLIED[tag])
        node = Node(tag, _attributes(attrs))
        stack[-1].children.append(node)
        if tag in RAW:
            stop = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>?", re.I).search(source, at)
            node.children.append(source[at : stop.start() if stop else n])
            at = stop.end() if stop else n
        elif tag not in VOID and (tag in BLOCK or not attrs.endswith("/")):  # the slash of <div/> means nothing in HTML
            stack.append(node)
    return root
