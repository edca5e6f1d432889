"""A tolerant reader of HTML: one pass over a page gives its elements in page order and the text between them.

Every character is looked at a bounded number of times, also in broken markup: an unclosed comment, tag or raw element ends the
page, a quote without a partner is an ordinary character, and open elements are found by their name, not by a
search. Elements are closed as browsers do where it matters for the order of texts: a block ends an open paragraph, an
item ends the item before it, an end tag ends all that was opened inside its element, and end tags without an element, and
those of inline elements that would end a block, are ignored.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from html import unescape

# Elements by their role in HTML.
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rb rp rt rtc ruby s samp small span"
    " strike strong sub sup time tt u var".split()
)
IN_LINE = INLINE | frozenset(
    "script style template noscript img input link meta wbr source track param col base area embed button select textarea svg iframe"
    " object canvas audio video".split()
)  # what does not end a line of text
IN_HEAD = frozenset("meta link title style script base noscript template".split())
ENDS_PARAGRAPH = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6"
    " header hgroup hr li main menu nav ol p pre search section summary table ul dd dt".split()
)
PARAGRAPH_SCOPE = frozenset("table td th caption button object applet marquee template body html".split())
ITEM_SCOPE = frozenset("ul ol menu table body html".split())

_TAG = re.compile(r"""<(/?)([A-Za-z][^\s/>]*+)((?:[^>"'=]++|=\s*+(?:"[^"]*+"|'[^']*+')?|["'])*+)>""")
_ATTRIBUTE = re.compile(r"""([^\s/>=]++)(?:\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s>]*+)))?""")


@dataclass
class Element:
    tag: str
    parent: int
    attributes: str
    first: int  # its texts are those from `first` to `last`, exclusive
    last: int = -1


@dataclass
class Page:
    """Elements in the order of their start tags; element 0 is the page. Each text has its element; a text of None is the border
    of a block."""

    elements: list[Element] = field(default_factory=lambda: [Element("", -1, "", 0)])
    texts: list[str | None] = field(default_factory=list)
    owners: list[int] = field(default_factory=list)


def attributes(source: str) -> dict[str, str]:
    """The attributes of a tag by lower-cased name, the first of a repeated one."""
    out: dict[str, str] = {}
    for name, double, single, bare in _ATTRIBUTE.findall(source):
        out.setdefault(name.lower(), unescape(double or single or bare))
    return out


def read(html: str) -> Page:
    page = Page()
    elements, texts, owners = page.elements, page.texts, page.owners
    stack = [0]
    of_name: dict[str, list[int]] = {}  # depths of the open elements of a name
    paragraph, item, block = [-1], [-1], [0]  # for each depth: depth of the open p or li in scope, and of the innermost block

    def border() -> None:
        if texts and texts[-1] is not None:
            texts.append(None)
            owners.append(stack[-1])

    def close(depth: int) -> None:
        """Close the elements from `depth` on."""
        while len(stack) > depth:
            number = stack.pop()
            tag = elements[number].tag
            of_name[tag].pop()
            paragraph.pop(), item.pop(), block.pop()
            if tag not in IN_LINE:
                border()
            elements[number].last = len(texts)

    def text(raw: str) -> None:
        if raw:
            if elements[stack[-1]].tag == "head" and not raw.isspace():
                close(len(stack) - 1)
            texts.append(unescape(raw))
            owners.append(stack[-1])

    at, size = 0, len(html)
    while at < size:
        sign = html.find("<", at)
        if sign < 0:
            text(html[at:])
            break
        following = html[sign + 1:sign + 2]
        ends = following == "/" and html[sign + 2:sign + 3].isalpha()
        if not (following.isalpha() and following.isascii()) and not ends and following not in ("!", "?", "/"):
            text(html[at:sign + 1])
            at = sign + 1
            continue
        text(html[at:sign])
        if not (following.isalpha() or ends):  # comments, declarations and broken end tags
            end = html.find("-->", sign + 2) if html.startswith("<!--", sign) else html.find(">", sign)
            if end < 0:
                break
            at = end + (3 if html.startswith("<!--", sign) else 1)
            continue
        found = _TAG.match(html, sign)
        if not found:
            break
        at, tag = found.end(), found.group(2).lower()
        if found.group(1):
            depths = of_name.get(tag)
            if tag == "br":
                border()
            elif depths and not (tag in INLINE and depths[-1] < block[-1]):
                close(depths[-1])
            continue
        if tag in ENDS_PARAGRAPH and paragraph[-1] >= 0:
            close(paragraph[-1])
        if tag == "li" and item[-1] >= 0:
            close(item[-1])
        if elements[stack[-1]].tag == "head" and tag not in IN_HEAD:
            close(len(stack) - 1)
        if tag not in IN_LINE:
            border()
        if tag in VOID:
            continue
        depth = len(stack)
        elements.append(Element(tag, stack[-1], found.group(3), len(texts)))
        stack.append(len(elements) - 1)
        of_name.setdefault(tag, []).append(depth)
        paragraph.append(depth if tag == "p" else -1 if tag in PARAGRAPH_SCOPE else paragraph[-1])
        item.append(depth if tag == "li" else -1 if tag in ITEM_SCOPE else item[-1])
        block.append(block[-1] if tag in INLINE else depth)
        if tag in RAW:
            end = re.compile(rf"</{tag}(?=[\s/>])", re.I).search(html, at)
            text(html[at:end.start()] if end else html[at:])
            if not end:
                break
            at = end.start()
    close(1)
    elements[0].last = len(texts)
    return page
