"""The text blocks of an HTML page in order, each with its path of tags.

A block is the text between two borders of block elements; inline elements, line breaks and images do not end one. Broken markup is read
as browsers do where it matters here: open paragraphs, list items and cells are closed by the next one, an end tag without a
start ends a block, a comment or script without an end takes the rest. The time is linear in the page's length.
"""

from __future__ import annotations

import re
from collections import Counter
from html import unescape

# HTML elements by how they take part in blocks.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd mark nobr q rp rt ruby s samp small span strike strong sub "
    "sup time tt u var wbr picture source track map area math mi mn mo mrow msup msub semantics annotation".split()
)
VOID = frozenset("area base basefont bgsound br col embed frame hr img input keygen link meta param source track wbr".split())
#: Elements whose content is no markup; that of a text area is text of the page.
RAW = frozenset("script style title iframe noembed noframes xmp textarea".split())
CLOSES_PARAGRAPH = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup "
    "hr main menu nav ol p pre search section summary table ul li dt dd".split()
)
#: An element of a kind ends an open one of the kind, unless one of the bounds is nearer.
ENDS_SIBLING = {
    "li": (("li",), ("ul", "ol", "menu")),
    "dt": (("dt", "dd"), ("dl",)),
    "dd": (("dt", "dd"), ("dl",)),
    "option": (("option",), ("select",)),
    "td": (("td", "th"), ("tr", "table")),
    "th": (("td", "th"), ("tr", "table")),
    "tr": (("tr",), ("table",)),
    "tbody": (("tbody", "thead", "tfoot"), ("table",)),
    "tfoot": (("tbody", "thead", "tfoot"), ("table",)),
}
PARAGRAPH_BOUNDS = ("table", "td", "th", "caption", "button", "object")

# A tag: quotes count behind an equals sign only; one that is never closed counts as a character.
TAG = re.compile(r"""</?+([a-zA-Z][^\s/>]*+)((?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+'|))*+)>""")
PLAIN_TAG = re.compile(r"</?+([a-zA-Z][^\s/>]*+)([^>]*+)>")
END = {tag: re.compile(f"</{tag}(?![a-z0-9])", re.I) for tag in (*RAW, "svg")}
ATTRIBUTE = re.compile(r"""(?<![^\s"'/])(class|id|role|hidden|aria-hidden|style|data-label)(?![^\s=/>])(?:\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s"'>]++)))?""", re.I)
WORD = re.compile(r"[a-z]+|[A-Z]+(?![a-z])|[A-Z][a-z]*")
CACHED = 20_000


def _tokens(tag: str, attributes: str) -> tuple[str, ...]:
    """What a path says of an element: its tag, the words of its class and id, its role, whether it is hidden."""
    found = [tag]
    for name, *values in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), unescape("".join(values))
        if name in ("class", "id"):
            found += ["." + word.lower() for word in WORD.findall(value)]
        elif name == "role":
            found.append("role " + value.lower())
        elif name == "hidden" or (name == "aria-hidden" and value == "true") or (name == "style" and re.search(r"display\s*:\s*none", value)):
            found.append("hidden")
        elif name == "data-label":
            found.append("label " + value)
    return tuple(dict.fromkeys(found))


class Page:
    """Blocks of a page: `texts`, characters inside links, number of the path node; `nodes` are (parent, tokens), the root first."""

    def __init__(self, html: str | None):
        self.texts: list[str] = []
        self.linked: list[int] = []
        self.paths: list[int] = []
        self.nodes: list[tuple[int, tuple[str, ...]]] = [(-1, ())]
        self._parts: list[str] = []
        self._linked, self._links = 0, 0
        self._stack: list[tuple[str, int]] = [("", 0)]
        self._open: Counter[str] = Counter()
        if html:
            self._read(html)
            self._flush()
        del self._parts, self._stack, self._open

    def _flush(self) -> None:
        if self._parts:
            text = " ".join("".join(self._parts).split())
            if text:
                self.texts.append(text)
                self.linked.append(min(self._linked, len(text)))
                self.paths.append(self._stack[-1][1])
            self._parts, self._linked = [], 0

    def _text(self, raw: str) -> None:
        if raw:
            text = unescape(raw) if "&" in raw else raw
            self._parts.append(text)
            if self._links:
                self._linked += len(text)

    def _pop(self, tag: str) -> None:
        while True:
            closed, _ = self._stack.pop()
            self._open[closed] -= 1
            if closed == tag:
                return

    def _close(self, kinds: tuple[str, ...], bounds: tuple[str, ...]) -> None:
        """End the nearest open element of the kinds, unless a bound is nearer."""
        if any(self._open[kind] for kind in kinds):
            for tag, _ in reversed(self._stack):
                if tag in kinds:
                    return self._pop(tag)
                if tag in bounds:
                    return

    def _start(self, tag: str, attributes: str) -> None:
        if tag in CLOSES_PARAGRAPH:
            self._close(("p",), PARAGRAPH_BOUNDS)
        if tag in ENDS_SIBLING:
            self._close(*ENDS_SIBLING[tag])
        if tag in VOID:
            return
        key = (tag, attributes)
        tokens = _known.get(key)
        if tokens is None:
            if len(_known) >= CACHED:
                _known.clear()
            tokens = _known[key] = _tokens(tag, attributes)
        self.nodes.append((self._stack[-1][1], tokens))
        self._stack.append((tag, len(self.nodes) - 1))
        self._open[tag] += 1

    def _read(self, html: str) -> None:
        at, size, last = 0, len(html), html.rfind(">")
        tags = TAG
        while at < size:
            begin = html.find("<", at)
            if begin < 0:
                self._text(html[at:])
                return
            self._text(html[at:begin])
            following = html[begin + 1 : begin + 2]
            if html.startswith("<!--", begin):
                at = begin + 5 if html.startswith("<!-->", begin) else html.find("-->", begin + 4) + 3
                if at == 2:
                    return
                continue
            if following and following in "!?/" and not html[begin + 2 : begin + 3].isalpha() or following in ("!", "?"):
                at = html.find(">", begin) + 1
                if not at:
                    return
                continue
            if not (following == "/" or following.isascii() and following.isalpha()):
                self._text("<")
                at = begin + 1
                continue
            if begin > last:
                return
            match = tags.match(html, begin)
            if not match:  # a value's closing quote is the last one: from here on, a tag ends at the next bracket
                tags = PLAIN_TAG
                match = tags.match(html, begin)
            at, tag = match.end(), match[1].lower()
            if following == "/":
                if tag == "a":
                    self._links = 0
                elif tag == "br":
                    self._parts.append(" ")
                elif tag not in INLINE:
                    self._flush()
                    if self._open[tag]:
                        self._pop(tag)
            elif tag in RAW or tag == "svg":
                found = END[tag].search(html, at)
                end = found.start() if found else -1
                if tag == "textarea":
                    self._flush()
                    self._start(tag, match[2])
                    self._text(html[at : end if end >= 0 else size])
                    self._flush()
                    self._pop(tag)
                if end < 0:
                    return
                at = html.find(">", end) + 1
                if not at:
                    return
            elif tag == "a":
                self._links = int("href" in match[2].lower())
            elif tag == "br":
                self._parts.append(" ")
            elif tag not in INLINE:
                self._flush()
                self._start(tag, match[2])


#: Tokens by tag and attributes; a worker starts anew when it is full.
_known: dict[tuple[str, str], tuple[str, ...]] = {}
