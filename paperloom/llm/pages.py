"""Main text of web pages, by a linear-chain conditional random field over DOM leaf blocks.

Each block is in one of two states, boilerplate or main text. Its features are the tags and
the class, id and role words of its ancestors, and its text's length, links and signs;
neighbours are tied by transition weights, which depend on whether the blocks share a
container. Weights maximise the penalised likelihood of labelled pages
(labelled_pages makes them, in many layouts and with text of every kind), with gradients
from forward-backward sums; a page is decoded by Viterbi.

Defined results: a null or empty page, or one without main text, gives an empty text; of a
page that is cut off what stands is read; very long pages are read whole; where both states
are as likely a block is boilerplate; repeated rows are extracted one by one; an empty table
gives an empty table; other columns, whatever their names, are kept by the operator and not
read by the query.
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .dom import Block, Place, blocks
from .shared import appended, small_batches, unused

#: Pages that the field is trained on; the bound of training.
TRAINING_PAGES, SEED = 900, 5
STEPS, RATE, RIDGE = 150, 0.15, 2e-4
_SIGN = re.compile(r"©|\bcopyright\b|all rights reserved|\bcookies?\b|\bsubscribe\b|\bnewsletter\b|\bsign in\b|\blog ?in\b|privacy policy|terms of", re.I)


# Features


_INLINE = frozenset(("b", "i", "em", "strong", "span"))


@lru_cache(maxsize=20_000)
def _inside(around: tuple[frozenset, str], tag: str, words: tuple[str, ...]) -> tuple[frozenset, str]:
    """The features that an element gives to all within it, with those of the elements around it, and the tag of its block."""
    of, block = around
    own = {f"word:{w}" for w in words} | ({f"in:{tag}"} if tag not in _INLINE and tag not in ("html", "body") else set())
    return (of if own <= of else of | own, block if tag in _INLINE or tag == "a" else tag)


@lru_cache(maxsize=20_000)
def _named(inside: tuple[frozenset, str]) -> tuple[str, ...]:
    of, block = inside
    return tuple(sorted(of | {f"tag:{block}"} | (set() if of & {"in:article", "in:main"} else {"outside"})))


_NOWHERE = (frozenset(), "none")


def path_features(place: Place | None) -> tuple[str, ...]:
    """Features of the open elements; each place keeps its own."""
    chain = []
    while place and place.held is None:
        chain.append(place)
        place = place.up
    held = place.held if place else _NOWHERE
    for p in reversed(chain):
        held = p.held = _inside(held, p.tag, p.words)
    return _named(held)


def text_features(block: Block) -> tuple[str, ...]:
    n = len(block.text)
    out = [f"length:{min(6, n.bit_length() // 2)}"]
    share = block.linked / max(1, n)
    out.append("links:" + ("none" if share == 0 else "some" if share < 0.5 else "most"))
    if n < 400 and _SIGN.search(block.text):
        out.append("sign")
    return tuple(out)


def features(page: list[Block]) -> list[tuple[str, ...]]:
    return [path_features(b.place) + text_features(b) for b in page]


def ties(page: list[Block]) -> list[int]:
    """For each block but the first: 1 if it shares the container with the one before, else 0."""
    around = [b.place and b.place.up for b in page]
    return [int(a is b) for a, b in zip(around, around[1:], strict=False)]


# Model


@dataclass
class Field:
    """weights: feature to the two states' scores; steps: [tie][state before][state]."""

    weights: dict[str, tuple[float, float]]
    steps: list[list[list[float]]]

    def decode(self, page: list[Block]) -> list[int]:
        """The likeliest states, by Viterbi."""
        if not page:
            return []
        scores = []
        for names in features(page):
            boiler = main = 0.0
            for f in names:
                if (w := self.weights.get(f)) is not None:
                    boiler += w[0]
                    main += w[1]
            scores.append((boiler, main))
        a, b = scores[0]
        back = []
        for (x, y), tie in zip(scores[1:], ties(page), strict=True):
            (aa, ab), (ba, bb) = self.steps[tie]
            from_a, from_b = (aa + a, ba + b), (ab + a, bb + b)
            back.append((int(from_a[1] > from_a[0]), int(from_b[1] > from_b[0])))
            a, b = max(from_a) + x, max(from_b) + y
        state = int(b > a)
        out = [state]
        for choice in reversed(back):
            state = choice[state]
            out.append(state)
        return out[::-1]

    def extract(self, page: str | None) -> str:
        found = list(blocks(page))
        return "\n".join(b.text for b, s in zip(found, self.decode(found), strict=True) if s)


def train(pages: list[tuple[list[Block], list[int]]], steps: int = STEPS) -> Field:
    """The field that maximises the penalised likelihood of labelled pages, by Adam on the whole set."""
    pages = [(p, s) for p, s in pages if p]
    names: dict[str, int] = {}
    longest = max(len(p) for p, _ in pages)
    n = len(pages)
    of_block, place = [], []
    mask, gold, tied = np.zeros((n, longest), bool), np.zeros((n, longest), int), np.zeros((n, longest - 1), int)
    for i, (page, states) in enumerate(pages):
        mask[i, : len(page)], gold[i, : len(page)], tied[i, : len(page) - 1] = True, states, ties(page)
        for j, found in enumerate(features(page)):
            for f in found:
                of_block.append(names.setdefault(f, len(names)))
                place.append(i * longest + j)
    of_block, place = np.array(of_block), np.array(place)
    w, t = np.zeros((len(names), 2)), np.zeros((2, 2, 2))
    moments = [[np.zeros_like(x), np.zeros_like(x)] for x in (w, t)]
    both = mask[:, 1:]

    def sums(scores: np.ndarray) -> np.ndarray:
        top = scores.max(-1, keepdims=True)
        return (top + np.log(np.exp(scores - top).sum(-1, keepdims=True)))[..., 0]

    for step in range(1, steps + 1):
        emit = np.zeros((n * longest, 2))
        for y in (0, 1):
            emit[:, y] = np.bincount(place, w[of_block, y], n * longest)
        emit = emit.reshape(n, longest, 2) * mask[..., None]
        move = t[tied] * both[..., None, None]
        ahead, behind = np.zeros_like(emit), np.zeros_like(emit)
        ahead[:, 0] = emit[:, 0]
        for j in range(1, longest):
            new = sums((ahead[:, j - 1, :, None] + move[:, j - 1]).swapaxes(1, 2)) + emit[:, j]
            ahead[:, j] = np.where(mask[:, j, None], new, ahead[:, j - 1])
        for j in range(longest - 2, -1, -1):
            new = sums(move[:, j] + (emit[:, j + 1] + behind[:, j + 1])[:, None, :])
            behind[:, j] = np.where(both[:, j, None], new, 0)
        total = sums(ahead[:, -1])
        p = np.exp(ahead + behind - total[:, None, None]) * mask[..., None]
        pair = np.exp(ahead[:, :-1, :, None] + move + (emit + behind)[:, 1:, None, :] - total[:, None, None, None]) * both[..., None, None]
        error = p - np.eye(2)[gold] * mask[..., None]
        flat = error.reshape(-1, 2)
        g_w = np.stack([np.bincount(of_block, flat[place, y], len(names)) for y in (0, 1)], 1) / n + RIDGE * w
        seen = np.eye(2)[gold[:, :-1]][..., :, None] * np.eye(2)[gold[:, 1:]][..., None, :] * both[..., None, None]
        g_t = np.stack([((pair - seen) * (tied == k)[..., None, None]).sum((0, 1)) for k in (0, 1)]) / n + RIDGE * t
        for x, g, (m, v) in zip((w, t), (g_w, g_t), moments, strict=True):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            x -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return Field({f: (float(w[k, 0]), float(w[k, 1])) for f, k in names.items()}, t.tolist())


# Labelled pages

_SYLLABLES = ("ba", "co", "dun", "el", "fri", "gor", "hu", "is", "ka", "lom", "men", "or", "pra", "qui", "ru", "sta", "tion", "ul", "ver", "zen", "é", "ü", "ña", "ß", "the", "and", "of")
_MAIN, _BOILER = "\ue000", "\ue001"  # marks before each block's text, taken off when blocks are read


class _Writer:
    def __init__(self, seed: int) -> None:
        self.r = random.Random(seed)

    def word(self) -> str:
        return "".join(self.r.choices(_SYLLABLES, k=self.r.randint(1, 4)))

    def prose(self, low: int, high: int) -> str:
        """Words in one of the ways that pages have: sentences, capitals, signs, columns, lists of numbers."""
        words = [self.word() for _ in range(self.r.randint(low, high))]
        kind = self.r.random()
        if kind < 0.1:
            words = [w.upper() + "!!" for w in words]
        elif kind < 0.2:
            words = [w + self.r.choice(("$$$", "%%%", "***", "&amp;&amp;", "###")) for w in words]
        elif kind < 0.25:
            return " | ".join(words)
        elif kind < 0.3:
            words = [str(self.r.randint(0, 99999)) if self.r.random() < 0.4 else w for w in words]
        elif kind < 0.5:
            words[0] = words[0].capitalize()
            words[-1] += self.r.choice((".", ".\n" + self.word() + "."))
        else:
            words = [w.capitalize() if k % 9 == 0 else w + "." if k % 9 == 8 else w + "," if k % 9 == 4 else w for k, w in enumerate(words)]
        return " ".join(words)

    def maybe(self, chance: float, text: str) -> str:
        return text if self.r.random() < chance else ""

    def named(self, tag: str, words: str, text: str, own: str = "") -> str:
        """An element that its tag, or a class or id, names."""
        way = self.r.random()
        word = self.r.choice(words.split())
        mark = f' {self.r.choice(("class", "id", "class", "role"))}="{word}{self.maybe(0.3, "-" + self.word())}"'
        if own and way < 0.45:
            return f"<{own}{self.maybe(0.4, mark)}>{text}</{own}>"
        return f"<{tag}{mark}>{text}</{tag}>"

    def links(self, low: int, high: int) -> str:
        rows = "".join(f'<li><a href="/{self.word()}">{_BOILER}{self.prose(1, 3)}</a></li>' for _ in range(self.r.randint(low, high)))
        return f"<ul>{rows}</ul>"

    def boiler(self, low: int = 1, high: int = 30) -> str:
        """A few blocks of prose, links or both."""
        out = ""
        for _ in range(self.r.randint(1, 3)):
            tag = self.r.choice(("p", "div", "span", "h3", "h4", ""))
            text = _BOILER + self.prose(low, high)
            if self.r.random() < 0.3:
                text = f'{_BOILER}<a href="#">{self.prose(1, 6)}</a>'
            out += f"<{tag}>{text}</{tag}>" if tag else f"<div>{text}</div>" if out else text
        return out

    def menu(self) -> str:
        return self.named("div", "menu nav navbar navigation topnav breadcrumb breadcrumbs", self.links(2, 8), "nav")

    def advert(self) -> str:
        return self.named(self.r.choice(("div", "div", "section", "aside")), "ad ads advert advertisement adbox banner sponsored promo promotion", self.boiler())

    def notice(self) -> str:
        return self.named(self.r.choice(("div", "section")), "cookie cookies consent notice notification alert popup modal gdpr banner warning", self.boiler(4, 30) + self.maybe(0.5, f"<button>{_BOILER}OK</button>"))

    def form(self) -> str:
        return f'<form{self.maybe(0.4, " class=" + self.r.choice(("search", "newsletter", "login", "signup", "subscribe")))}><label>{_BOILER}{self.prose(1, 5)}</label><input name="q"><p>{_BOILER}{self.prose(2, 20)}</p>{self.maybe(0.6, f"<button>{_BOILER}{self.prose(1, 2)}</button>")}</form>'

    def sidebar(self) -> str:
        return self.named("div", "sidebar side related widget recommended recent trending popular", self.maybe(0.6, f"<h3>{_BOILER}{self.prose(1, 4)}</h3>") + self.r.choice((self.links(2, 5), self.boiler())), "aside")

    def footer(self) -> str:
        sign = self.r.choice(("&copy; 2020 ", "&copy; ", "Copyright ", ""))
        inner = f"{_BOILER}{sign}{self.prose(1, 12)}" + self.maybe(0.3, " &middot; " + self.prose(2, 8)) + self.maybe(0.3, f"<p>{_BOILER}{self.prose(2, 20)}</p>") + self.maybe(0.2, self.links(1, 4))
        return self.named("div", "footer bottom colophon copyright legal", inner, "footer" if self.r.random() < 0.9 else "")

    def header(self) -> str:
        inner = self.r.choice((f"<div>{_BOILER}{self.prose(1, 4)}</div>", f"<h1>{_BOILER}{self.prose(1, 4)}</h1>", f"{_BOILER}{self.prose(1, 20)}", f'<a href="/">{_BOILER}{self.prose(1, 3)}</a>'))
        return self.named("div", "header masthead topbar logo sitename branding", inner + self.maybe(0.4, self.menu()), "header" if self.r.random() < 0.9 else "")

    def social(self) -> str:
        inner = self.r.choice((f'<a href="#">{_BOILER}{self.prose(1, 2)}</a>', self.links(1, 4), f"<p>{_BOILER}{self.prose(1, 12)}</p>", f"{_BOILER}{self.prose(1, 4)}"))
        return self.named(self.r.choice(("div", "div", "ul", "p")), "share social sharing buttons tags newsletter subscribe signup follow", inner)

    def remarks(self) -> str:
        rows = "".join(f'<{(t := self.r.choice(("div", "li", "p")))} {self.maybe(0.7, "class=comment")}>{_BOILER}{self.prose(2, 60)}</{t}>' for _ in range(self.r.randint(1, 6)))
        return self.named(self.r.choice(("div", "section", "ol")), "comments comment remarks replies discussion responses disqus", self.maybe(0.6, f"<h3>{_BOILER}{self.prose(1, 3)}</h3>") + rows + self.maybe(0.3, self.form()))

    def paragraph(self) -> str:
        way = self.r.random()
        low, high = self.r.choice(((1, 1), (1, 4), (5, 30), (20, 120), (40, 200)))
        text = _MAIN + self.prose(low, high)
        if way < 0.06:
            return "<ul>" + "".join(f"<li>{_MAIN}{self.prose(1, 20)}</li>" for _ in range(self.r.randint(1, 5))) + "</ul>"
        if way < 0.1:
            return f"<h{(n := self.r.randint(2, 4))}>{_MAIN}{self.prose(1, 8)}</h{n}>"
        if way < 0.13:
            return f"<blockquote>{text}</blockquote>"
        if way < 0.15:
            return f"<pre>{text}</pre>"
        if way < 0.18:
            return "<table>" + "".join(f"<tr><td>{_MAIN}{self.prose(1, 4)}</td><td>{_MAIN}{self.prose(1, 4)}</td></tr>" for _ in range(self.r.randint(1, 3))) + "</table>"
        if way < 0.24:
            return f"<p><b>{text}<br>"
        if way < 0.28:
            return f"{text} <b>{self.prose(1, 3)}</b> {self.prose(1, 9)}"
        if way < 0.34:
            return f'<p>{text} <a href="/{self.word()}">{self.prose(1, 3)}</a> {self.prose(1, 10)}</p>'
        return f"<p>{text}</p>"

    def article(self) -> str:
        inner = self.maybe(0.05, self.menu()) + self.maybe(0.7, f"<h1>{_MAIN}{self.prose(1, 9)}</h1>")
        for _ in range(self.r.randint(1, 12)):
            inner += self.paragraph() + self.maybe(0.04, self.advert()) + self.maybe(0.02, self.sidebar()) + self.maybe(0.02, self.form()) + self.maybe(0.01, self.notice()) + self.maybe(0.01, self.social())
        inner += self.maybe(0.12, self.social()) + self.maybe(0.1, self.remarks())
        way = self.r.random()
        if way < 0.5:
            return f"<article{self.maybe(0.3, ' class=post')}>{inner}{self.maybe(0.95, '</article>')}"
        if way < 0.65:
            return f"<main>{inner}</main>"
        if way < 0.75:
            return f"<main><article>{inner}</article></main>"
        word = self.r.choice("content article post entry story body text main maincontent articlebody".split())
        return f'<div {self.r.choice(("id", "class"))}="{word}">{inner}</div>'

    def page(self) -> str:
        out = f'<!DOCTYPE html><html><head><meta charset="utf-8"><title>{self.prose(1, 8)}</title><style>p{{margin:0}}</style><script>var t="</p>";</script></head><body>'
        out += self.maybe(0.15, self.notice()) + self.maybe(0.5, self.header()) + self.maybe(0.7, self.menu()) + self.maybe(0.4, self.advert()) + self.maybe(0.1, self.form()) + self.maybe(0.15, self.sidebar())
        out += self.maybe(0.97, self.article())
        out += self.maybe(0.25, self.remarks()) + self.maybe(0.25, self.sidebar()) + self.maybe(0.2, self.advert()) + self.maybe(0.1, self.form()) + self.maybe(0.1, self.notice())
        return out + self.maybe(0.75, self.footer()) + self.maybe(0.9, "</body></html>")


def labelled_pages(number: int = TRAINING_PAGES, seed: int = SEED) -> list[tuple[list[Block], list[int]]]:
    """Blocks of made-up pages in many layouts, with 1 for main text and 0 for the rest."""
    out, writer = [], _Writer(seed)
    for _ in range(number):
        found = list(blocks(writer.page()))
        states = [int(_MAIN in b.text) for b in found]
        plain = [Block(b.text.replace(_MAIN, "").replace(_BOILER, ""), b.place, b.linked) for b in found]
        out.append((plain, states))
    return out


@lru_cache(maxsize=1)
def trained_field() -> Field:
    return train(labelled_pages())


# Operator


def extract_text(pages: DataFrame, html: str = "html", into: str = "text", field: Field | None = None) -> DataFrame:
    """pages with the main text in place of the html; the column replaces one of the same name."""
    small_batches(pages.sparkSession)
    field = field or trained_field()
    kept = [c for c in pages.columns if c not in (html, into)]
    (held,) = unused(kept, "html")
    plain = pages.select(*[f"`{c}`" for c in kept], F.col(f"`{html}`").cast("string").alias(held))

    def run(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [field.extract(h) for h in batch.column(len(kept)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(texts, pa.string())], names=[*kept, into])

    return plain.mapInArrow(run, appended(plain.drop(held).schema, f"`{into}` string"))


def page_digest(pages: DataFrame) -> DataFrame:
    found = extract_text(pages.select("page_id", "url", "html"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
