"""Leaf blocks of an HTML page, by a tolerant single pass over its tags."""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

#: Elements that begin and end a block of text.
BLOCK_TAGS = frozenset("address article aside blockquote body button caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol optgroup option p pre section select summary table tbody td tfoot th thead tr ul".split())
#: Elements without an end tag.
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content no browser shows as text of the page; without an end tag the first two go on to the page's end, the others are read on after their start.
RAW_TAGS = ("script", "style", "template", "title", "textarea", "iframe")
#: What an element's start closes, within its own container.
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",), "tbody": ("thead", "tbody", "tr", "td", "th")}
#: Containers beyond which nothing is closed so.
WALLS = frozenset("ul ol menu dl table select div article section main aside nav form body".split())
#: A comment, a declaration, an end tag without a name, or a tag. In a tag a quoted part begins only after "="; a quote anywhere else is a plain sign.
_MARK = re.compile(r"""<!--(?:-?>|.*?(?:--!?>|\Z))|<[!?][^>]*+(?:>|\Z)|</(?![a-zA-Z])[^>]*+>|<(/?)([a-zA-Z][^\s/>]*+)((?:[^=>]++|=\s*+(?:"[^"]*+"|'[^']*+')?+)*+)(?:>|\Z)""", re.S)
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]++)\s*+(?:=\s*+("[^"]*+"|'[^']*+'|[^\s>]*+))?""")
_ENDS = {t: re.compile(rf"</{t}(?=[\s/>]|\Z)", re.I) for t in RAW_TAGS}
_NAMES = re.compile(r"[a-z]+")
_HUMP = re.compile(r"([a-z])([A-Z])")
_HIDDEN = re.compile(r"display\s*:\s*none")


class Place:
    """An open element: its tag, its class, id and role words, and the one around it. A page has one of each kind and place."""

    __slots__ = ("up", "tag", "words", "held")

    def __init__(self, up: Place | None, tag: str, words: tuple[str, ...]) -> None:
        self.up, self.tag, self.words, self.held = up, tag, words, None


@dataclass
class Block:
    text: str
    #: the innermost open element, or None
    place: Place | None
    linked: int = 0

    @property
    def path(self) -> tuple[tuple[str, tuple[str, ...]], ...]:
        """Tag and words of every open element, outermost first."""
        out, at = [], self.place
        while at:
            out.append((at.tag, at.words))
            at = at.up
        return tuple(reversed(out))


def _words(attributes: str) -> tuple[str, ...]:
    if "=" not in attributes and "hidden" not in attributes:
        return ()
    out = []
    for name, value in _ATTRIBUTE.findall(attributes):
        name = name.lower()
        if name in ("class", "id", "role"):
            out += _NAMES.findall(_HUMP.sub(r"\1 \2", value).lower())
        elif name == "hidden" or name == "style" and _HIDDEN.search(value):
            out.append("hidden")
    return tuple(dict.fromkeys(out))


class _Open:
    """The open elements, and how many of each tag."""

    def __init__(self) -> None:
        self.path: list[Place] = []
        self.tags: Counter = Counter()
        self.places: dict[tuple, Place] = {}

    def innermost(self) -> Place | None:
        return self.path[-1] if self.path else None

    def push(self, tag: str, words: tuple[str, ...]) -> None:
        up = self.innermost()
        key = (id(up), tag, words)
        if key not in self.places:
            self.places[key] = Place(up, tag, words)
        self.path.append(self.places[key])
        self.tags[tag] += 1

    def pop(self) -> str:
        tag = self.path.pop().tag
        self.tags[tag] -= 1
        return tag

    def close(self, tag: str) -> None:
        """An end tag closes the last element of its name and all within it; without one it does nothing."""
        if self.tags[tag] > 0:
            while self.pop() != tag:
                pass

    def begin(self, tag: str) -> None:
        """What the start of an element closes."""
        shut = CLOSES.get(tag, ()) + (("p",) if tag in BLOCK_TAGS else ())
        while any(self.tags[t] > 0 for t in shut):
            k = len(self.path) - 1
            while self.path[k].tag not in shut:
                if self.path[k].tag in WALLS:
                    return
                k -= 1
            while len(self.path) > k:
                self.pop()
            if tag not in ("tr", "tbody"):
                return


def blocks(page: str | None) -> Iterator[Block]:
    """Blocks with text, in page order; references are decoded and white space is one blank."""
    page = page or ""
    open_, unended = _Open(), set()
    parts: list[str] = []
    linked = at = 0

    def flush() -> Iterator[Block]:
        nonlocal parts, linked
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                yield Block(text, open_.innermost(), min(linked, len(text)))
        parts, linked = [], 0

    while True:
        mark = _MARK.search(page, at)
        end = mark.start() if mark else len(page)
        if at < end:
            text = page[at:end]
            if "&" in text:
                text = html.unescape(text)
            parts.append(text)
            if open_.tags["a"] > 0:
                linked += len(text.strip())
        if not mark:
            break
        at = mark.end()
        if mark[2] is None:
            continue
        tag, closing = mark[2].lower(), mark[1]
        if tag in _ENDS and not closing:
            if not mark[3].endswith("/") and tag not in unended:
                ended = _ENDS[tag].search(page, at)
                if ended:
                    at = ended.start()
                elif tag in RAW_TAGS[:2]:
                    break
                else:
                    unended.add(tag)
            continue
        if tag == "br":
            parts.append(" ")
            continue
        if tag in BLOCK_TAGS:
            yield from flush()
        if tag in VOID_TAGS:
            continue
        if closing:
            open_.close(tag)
            continue
        open_.begin(tag)
        if not mark[3].endswith("/") or tag in BLOCK_TAGS:
            open_.push(tag, _words(mark[3]))
    yield from flush()
