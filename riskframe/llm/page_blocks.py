"""Pages cut into blocks of text, each with the path of elements that holds it.

A block is the text between two tags that begin or end a block-level element; white space in
it becomes one space, a line break counts as white space. Elements that never hold text to
read (scripts, styles, titles, templates, drawings) are passed over. Unclosed and misnested
tags are settled roughly as browsers do: a paragraph ends where the next block begins, list
items and cells end each other, an end tag without its start is passed over.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass, field
from html import unescape

# Names of HTML elements by what they mean for the cutting.
BLOCK = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt "
    "fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html label "
    "legend li main menu nav noscript ol optgroup option p pre search section select summary "
    "table tbody td tfoot th thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
PASSED = frozenset("script style title textarea iframe noembed noframes template svg object".split())
ENDS = {  # a start tag ends these, up to the nearest of the second set
    "li": (frozenset(["li"]), frozenset(["ul", "ol", "menu", "dir"])),
    "dt": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "dd": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "option": (frozenset(["option"]), frozenset(["select"])),
    "tr": (frozenset(["tr", "td", "th"]), frozenset(["table"])),
    "td": (frozenset(["td", "th"]), frozenset(["table", "tr"])),
    "th": (frozenset(["td", "th"]), frozenset(["table", "tr"])),
}
NESTS_IN_P = frozenset(["button", "label", "option", "select", "noscript"])

_TAG = re.compile(
    r"""<!--.*?(?:--!?>|\Z)|<[!?][^>]*+(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>"""
    r"""|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)(?:>|\Z)|</[^>]*+(?:>|\Z)""",
    re.S,
)
_NAMED = re.compile(r"""(?<![\w-])(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")

OUTER, INNER = 8, 56  # elements of a path that are looked at, where it is deeper than both


@dataclass
class Blocks:
    """The blocks of a page: texts, paths (tuples of words), and their characters in links."""

    texts: list[str] = field(default_factory=list)
    paths: list[tuple[str, ...]] = field(default_factory=list)
    linked: list[int] = field(default_factory=list)


def element_words(name: str, attributes: str) -> tuple[str, ...]:
    """The element's name and the words of its class, id and role."""
    out = [name]
    if "=" in attributes:
        for key, *values in _NAMED.findall(attributes):
            out += [f"{key[0].lower()}.{w.lower()}" for w in _PART.findall(" ".join(values))[:16]]
            out += [f".{w.lower()}" for w in _PART.findall(" ".join(values))[:16]]
    return tuple(out)


class _Page:
    def __init__(self):
        self.names: list[str] = []
        self.words: list[tuple[str, ...]] = []
        self.open: Counter = Counter()
        self.out = Blocks()
        self.parts: list[str] = []
        self.in_links: list[str] = []
        self.path: tuple[str, ...] | None = None

    def text(self, piece: str) -> None:
        self.parts.append(piece)
        if self.open["a"]:
            self.in_links.append(piece)

    def close_block(self) -> None:
        if self.parts:
            text = " ".join(unescape("".join(self.parts)).split())
            if text:
                self.out.texts.append(text)
                self.out.paths.append(self.current_path())
                self.out.linked.append(len(" ".join("".join(self.in_links).split())) if self.in_links else 0)
            self.parts, self.in_links = [], []

    def current_path(self) -> tuple[str, ...]:
        if self.path is None:
            held = self.words if len(self.words) <= OUTER + INNER else self.words[:OUTER] + self.words[-INNER:]
            self.path = tuple(w for words in held for w in words)
        return self.path

    def pop_to(self, depth: int) -> None:
        while len(self.names) > depth:
            self.open[self.names.pop()] -= 1
            self.words.pop()
        self.path = None

    def end_open(self, which: frozenset, within: frozenset) -> None:
        """End the outermost of ``which`` that is open inside the nearest of ``within``."""
        if not any(self.open[n] for n in which):
            return
        found = None
        for depth in range(len(self.names) - 1, -1, -1):
            if self.names[depth] in within:
                break
            if self.names[depth] in which:
                found = depth
        if found is not None:
            self.pop_to(found)

    def start(self, name: str, attributes: str) -> None:
        if name in BLOCK:
            self.close_block()
            if self.open["p"] and name not in NESTS_IN_P:
                self.end_open(frozenset(["p"]), frozenset(["td", "th", "button"]))
            if name in ENDS:
                self.end_open(*ENDS[name])
        elif name == "br":
            self.text(" ")
        if name not in VOID and not attributes.endswith("/"):
            self.names.append(name)
            self.words.append(element_words(name, attributes))
            self.open[name] += 1
            if name in BLOCK or not self.parts:
                self.path = None

    def end(self, name: str) -> None:
        if name in BLOCK:
            self.close_block()
        if not self.open[name]:
            return
        for depth in range(len(self.names) - 1, -1, -1):
            if self.names[depth] == name:
                self.pop_to(depth)
                return
            if name not in BLOCK and self.names[depth] in BLOCK:
                # an inline element is not ended across a block; it only stops counting as a link
                inner = len(self.names) - 1 - self.names[::-1].index(name)
                self.open[name] -= 1
                self.names[inner] = ""
                self.open[""] += 1
                return


_CLOSERS = {name: re.compile(rf"</{name}(?=[\s/>]|\Z)", re.I) for name in PASSED}


def page_blocks(html: str) -> Blocks:
    """The blocks of a page in page order; an empty page has none."""
    page, at = _Page(), 0
    while True:
        tag = _TAG.search(html, at)
        if tag is None:
            break
        if tag.start() > at:
            page.text(html[at : tag.start()])
        at = tag.end()
        name = tag[2] or tag[5]
        if name is None:
            continue
        name = name.lower()
        if tag[1] or tag[4]:
            page.end(name)
            continue
        attributes = tag[3] if tag[2] else tag[6]
        if name in PASSED:
            if not attributes.endswith("/") or name in ("script", "style", "title", "textarea", "iframe"):
                closer = _CLOSERS[name].search(html, at)
                at = closer.start() if closer else len(html)
            continue
        page.start(name, attributes)
    if at < len(html):
        page.text(html[at:])
    page.close_block()
    return page.out
