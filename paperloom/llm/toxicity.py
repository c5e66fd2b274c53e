"""Toxicity by a weighted lexicon, matched with an Aho-Corasick automaton.

A text is folded first: lower case, compatibility forms, look-alike letters of other
scripts, and digits or signs that stand for letters inside a word. Whole words and word
stems of the lexicon are then found in one pass, hits inside an exception phrase are
dropped, and the sum of their weights is divided by the number of words.

Score: d / (d + c), where d is that density and c the density at which a text counts as
toxic, so that score >= 0.5 is the decision.

Defined results: a null or empty text has no hit and scores 0; ties and repeated rows are
scored one by one and alike; an empty table gives an empty table; other columns are kept
by the operator as they are, whatever their names.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import appended, held_out, small_batches, training_sample, unused

#: Words with which the lexicon begins, before anything is learnt.
SEED_WORDS = ("idiot", "moron", "stupid", "loser", "scum", "trash", "clown", "pathetic", "worthless", "disgusting", "imbecile", "dumbass", "bastard", "retard", "scumbag", "asshole", "bitch")
#: Phrases in which such words mean no harm.
EXCEPTIONS = ("trash can", "trash bin", "trash bag", "taking out the trash", "take out the trash", "clown fish", "clownfish", "circus clown", "class clown", "idiot proof", "idiot-proof", "sore loser", "pond scum", "soap scum")
#: Letters of other scripts that look like Latin ones, in the order of LOOKS_LIKE.
LOOK_ALIKES = "авекмнорстухіїјѕԁԛԝɡαβεικνορτυχаеоɩʟɪıł"
LOOKS_LIKE = "abekmhopctyxiijsdqwgabeikvoptuxaeoiliil"
#: Digits and signs that stand for letters.
SIGNS = "0134578@$€!|+"
SIGN_LETTERS = "oieastbaseiit"

PER_CLASS = 2500
#: Least log odds of an entry's rate per word in toxic texts.
LEAST_ODDS = 3.0
MIN_SUPPORT = 5
STEM_LENGTHS = range(4, 9)
#: Density (hits per word) that counts as toxic while nothing has been learnt.
DEFAULT_LIMIT = 1 / 250

_LETTERS = str.maketrans(LOOK_ALIKES, LOOKS_LIKE)
_SIGNS = str.maketrans(SIGNS, SIGN_LETTERS)
_FOREIGN = re.compile("[" + re.escape("".join(sorted(set(LOOK_ALIKES)))) + "­​-‍⁠ﬀ-ﬆ！-～\U0001d400-\U0001d7ffⒶ-ⓩ]")
_WIDE = re.compile("[ﬀ-ﬆ！-～\U0001d400-\U0001d7ffⒶ-ⓩ]")
_UNSEEN = re.compile("[­​-‍⁠]")
_SIGN = re.compile("[" + re.escape(SIGNS) + "]")
#: A whole run of word characters and signs that holds a sign; it is looked for at the run's beginning alone.
_MIXED = re.compile(r"(?<![\w" + re.escape(SIGNS) + r"])[^\W" + "".join(c for c in SIGNS if c.isdigit()) + r"]*+[" + re.escape(SIGNS) + r"][\w" + re.escape(SIGNS) + r"]*+")
_WORD = re.compile(r"[^\W\d_]+")


def fold(text: str) -> str:
    """The text as the automaton reads it."""
    text = text.lower()
    if not text.isascii() and _FOREIGN.search(text):
        if _WIDE.search(text):
            text = unicodedata.normalize("NFKC", text).lower()
        text = _UNSEEN.sub("", text).translate(_LETTERS)
    if _SIGN.search(text):
        text = _MIXED.sub(_spelt, text)
    return text


def _spelt(run: re.Match) -> str:
    """A run of two letters or more with its signs as letters, but for those at its end; any other as it is."""
    word = run[0].rstrip(SIGNS)
    if sum(map(str.isalpha, word)) < 2:
        return run[0]
    return word.translate(_SIGNS) + run[0][len(word) :]


@dataclass
class Lexicon:
    """Weights of whole words and of word stems, exception phrases, and the density that counts as toxic."""

    words: dict[str, float]
    stems: dict[str, float] = field(default_factory=dict)
    exceptions: tuple[str, ...] = EXCEPTIONS
    limit: float = DEFAULT_LIMIT

    def automaton(self) -> ahocorasick.Automaton:
        found: dict[str, tuple[str, int, float]] = {}
        for kind, entries in (("word", self.words), ("stem", self.stems)):
            for w, weight in entries.items():
                # fold() reads the digit 1 as i, but it may stand for l as well
                for form in {fold(w), fold(w).replace("l", "i")}:
                    found.setdefault(form, (kind, len(form), weight))
        for phrase in self.exceptions:
            found[fold(phrase)] = ("exception", len(fold(phrase)), 0.0)
        out = ahocorasick.Automaton()
        for form, value in found.items():
            out.add_word(form, value)
        out.make_automaton()
        return out


def hits(folded: str, automaton: ahocorasick.Automaton) -> Iterator[tuple[int, int, float]]:
    """Spans and weights of the lexicon's entries that stand at a word's start, outside exception phrases."""
    spans, safe, size = [], [], len(folded)
    for end, (kind, length, weight) in automaton.iter(folded):
        start = end - length + 1
        if start and folded[start - 1].isalpha():
            continue
        if kind != "stem" and end + 1 < size and folded[end + 1].isalpha():
            continue
        (safe if kind == "exception" else spans).append((start, end + 1, weight))
    safe.sort()
    last, reach, k = -1, 0, 0  # reach: the furthest end of the exceptions that begin so far
    for start, end, weight in sorted(spans, key=lambda s: (s[0], -s[2], -s[1])):
        while k < len(safe) and safe[k][0] <= start:
            reach, k = max(reach, safe[k][1]), k + 1
        if start != last and end > reach:
            yield start, end, weight
            last = start


def density(text: str | None, automaton: ahocorasick.Automaton) -> tuple[float, int]:
    """Sum of weights per word, and the number of hits."""
    if not text:
        return 0.0, 0
    found = list(hits(fold(text), automaton))
    return sum(w for *_, w in found) / max(1, len(text.split())), len(found)


def _forms(text: str) -> tuple[Counter, int]:
    """How often each whole word stands in the text, and each stem, with a dash at its end; and the number of words."""
    words = Counter(_WORD.findall(fold(text)))
    stems: Counter = Counter()
    for w, times in words.items():
        for n in STEM_LENGTHS:
            if len(w) > n:
                stems[f"{w[:n]}-"] += times
    return words + stems, words.total()


def learn(rows: Iterable[tuple[str, int]]) -> Lexicon:
    """A lexicon from labelled texts: the seed words, then what stands in toxic texts far more often than in others.

    Words and stems are taken greedily by the number of toxic texts they newly cover; a
    weight is the smoothed log odds of their rates per word, over that of the strongest
    entry. An entry may stand in clean texts by chance: the density tells these apart.
    """
    rows = list(rows)
    toxic = [t for t, y in rows if y == 1]
    texts, bad, bad_words = Counter(), Counter(), 1
    for t in toxic:
        forms, n = _forms(t)
        texts.update(forms.keys())
        bad.update(forms)
        bad_words += n
    wanted = {f for f, n in texts.items() if n >= MIN_SUPPORT}
    clean, clean_words = Counter(), 1
    for t, y in rows:
        if y == 0:
            forms, n = _forms(t)
            clean.update({f: c for f, c in forms.items() if f in wanted})
            clean_words += n
    odds = {f: math.log((bad[f] + 0.5) / bad_words) - math.log((clean[f] + 0.5) / clean_words) for f in wanted}
    strong = {f for f in wanted if odds[f] >= LEAST_ODDS}
    where: dict[str, set[int]] = {}
    for k, t in enumerate(toxic):
        for f in strong & _forms(t)[0].keys():
            where.setdefault(f, set()).add(k)
    # a stem goes where a word or a longer stem that begins with it covers nearly as much, or half as much far more surely
    for f in sorted(where, key=len, reverse=True):
        stem = f.removesuffix("-")
        for n in STEM_LENGTHS:
            shorter = f"{stem[:n]}-"
            if n < len(stem) and shorter in where and f in where:
                share = len(where[f]) / len(where[shorter])
                if share >= 0.9 and clean[f] <= clean[shorter] or share >= 0.5 and odds[f] >= odds[shorter] + 1.5:
                    del where[shorter]
    for word in SEED_WORDS:
        for n in STEM_LENGTHS:
            if len(where.get(f"{word[:n]}-", set()) - where.get(word, set())) < MIN_SUPPORT:
                where.pop(f"{word[:n]}-", None)
    taken: dict[str, float] = {}
    # An entry that tells toxic texts apart covers many of them; a rare invented word is in a few by chance.
    least = max(MIN_SUPPORT, math.ceil(0.004 * len(toxic)))
    left = set(range(len(toxic)))
    for once in (False, True):
        # first whatever covers uncovered texts, longer forms first among equals, then all whole words as strong
        while where and not once:
            best = max(where, key=lambda f: (len(where[f] & left), -clean[f], len(f), f))
            if len(where[best] & left) < least:
                break
            taken[best] = odds[best]
            left -= where.pop(best)
        if once:
            floor = max(8 * least, 0.05 * len(toxic))
            for f in sorted(where):
                if len(where[f]) >= floor and not any(f.startswith(s[:-1]) or s.startswith(f[:-1]) for s in taken if s.endswith("-")):
                    taken[f] = odds[f]
    top = max(taken.values(), default=1.0)
    scale = {f: round(max(0.25, w / top), 4) for f, w in taken.items()}
    words = {w: 1.0 for w in SEED_WORDS} | {f: w for f, w in scale.items() if not f.endswith("-")}
    out = Lexicon(words, {f[:-1]: w for f, w in scale.items() if f.endswith("-")})
    out.limit = _limit(rows, out)
    return out


def _limit(rows: list[tuple[str, int]], lexicon: Lexicon) -> float:
    """The density that splits the labelled texts with the fewest errors; DEFAULT_LIMIT without both classes."""
    machine = lexicon.automaton()
    found = sorted((density(t, machine)[0], y) for t, y in rows)
    n_toxic = sum(y for _, y in found)
    if not 0 < n_toxic < len(found):
        return DEFAULT_LIMIT
    floor, wrong, best = 1 / 2000, len(found) - n_toxic, []
    points = [(floor, next((k for k, (d, _) in enumerate(found) if d > floor), len(found)))]
    points += [(d, k + 1) for k, (d, _) in enumerate(found) if d > floor and (k + 1 == len(found) or found[k + 1][0] > d)]
    missed = [0]
    for _, y in found:
        missed.append(missed[-1] + y)
    for d, k in points:
        errors = missed[k] + (wrong - (k - missed[k]))
        above = found[k][0] if k < len(found) else d * 2
        best.append((errors, d, above))
    errors = min(e for e, *_ in best)
    _, low, high = next(b for b in best if b[0] == errors)
    return math.sqrt(low * max(high, low))


def score_toxicity(documents: DataFrame, lexicon: Lexicon, text: str = "text", into: tuple[str, str] = ("toxicity", "toxic_hits")) -> DataFrame:
    """documents with a score of 0 to 1 and the number of hits; these columns replace any of the same name."""
    small_batches(documents.sparkSession)
    kept = [c for c in documents.columns if c not in into]
    schema = appended(documents.select(*[f"`{c}`" for c in kept]).schema, f"`{into[0]}` double, `{into[1]}` long")

    def run(batches):
        machine, limit = lexicon.automaton(), lexicon.limit
        for batch in batches:
            found = [density(t, machine) for t in batch.column(kept.index(text)).to_pylist()]
            score, number = pa.array([d / (d + limit) for d, _ in found], pa.float64()), pa.array([n for _, n in found], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns, score, number], names=[*kept, *into])

    return documents.select(*[f"`{c}`" for c in kept]).mapInArrow(run, schema)


def fitted(documents: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> Lexicon:
    """A lexicon learnt from at most per_class labelled texts of either class; held-out rows are never read."""
    return learn(training_sample(documents, labels, "toxic", per_class))


def decision(score: Column, least: float = 0.5) -> Column:
    return (score >= least).cast("int")


def toxicity_digest(documents: DataFrame, labels: DataFrame) -> DataFrame:
    scored = score_toxicity(documents.select("doc_id", "text"), fitted(documents, labels))
    return scored.select("doc_id", held_out().alias("held_out"), F.col("toxicity").alias("score"), decision(F.col("toxicity")).alias("predicted"), F.col("toxic_hits").alias("hits"))


def drop_toxic(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """documents without the toxic ones, in their own columns, whatever these are named.

    Null and empty texts stay, repeated rows are decided each by itself and alike, and very
    long texts by their whole; an empty table stays empty.
    """
    score, number = unused(documents.columns, "score", "hits")
    scored = score_toxicity(documents, fitted(documents, labels), into=(score, number))
    return scored.where(decision(F.col(score)) == 0).select(*[f"`{c}`" for c in documents.columns])
