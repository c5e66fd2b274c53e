"""SentencePiece encoding and decoding of whole texts by a vocabulary of scored pieces.

Blanks become the sign U+2581, and one is put before the text. An Aho-Corasick automaton
over the pieces reads the signs once; at every sign it follows its output links to all
pieces that end there, longest first, and each relaxes the best score of its end: a single
pass Viterbi for the segmentation with the greatest sum of scores. A character that is no
piece is written as the byte pieces of its UTF-8 form, at the lowest score less a penalty.
No piece goes on past a run of blanks or a line end, so segments between these are encoded
by themselves, and the ids of frequent ones are kept.

Decoding joins the pieces' bytes, and gives back every text exactly.

Defined results: a null or empty text has no ids; very long texts are read whole; the blank sign itself, in a text, is
written as bytes; repeated rows are encoded one by one; an empty table gives an empty
table; other columns are kept as they are, whatever their names.
"""

from __future__ import annotations

import math
import re
from array import array
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import appended, small_batches

BLANK = "▁"
#: Stands for a blank sign of the text itself; no text can hold a lone surrogate.
_LITERAL = "\ud800"
#: What an unknown character's score is below the lowest of all pieces.
PENALTY = 10.0
#: Segments whose ids are kept, and the longest of these.
MEMORY, LONGEST_KEPT = 800_000, 24
_SEGMENTS = re.compile(f"{BLANK}+[^{BLANK}]*|[^{BLANK}]+")


@dataclass
class Vocabulary:
    """Pieces with scores, by id; byte pieces by value. Ids that are neither are None in pieces."""

    pieces: list[str | None]
    scores: list[float]
    byte_ids: list[int]

    @staticmethod
    def load(path: str) -> Vocabulary:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        plain = [not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i) or model.is_byte(i)) for i in range(n)]
        by_value = {model.id_to_piece(i): i for i in range(n) if model.is_byte(i)}
        return Vocabulary([model.id_to_piece(i) if plain[i] else None for i in range(n)], [model.get_score(i) for i in range(n)], [by_value[f"<0x{b:02X}>"] for b in range(256)])


class _Kept(dict):
    """Ids of segments, as bytes, found when they are first asked for."""

    def __init__(self, codec: Codec) -> None:
        super().__init__()
        self.codec = codec

    def __missing__(self, segment: str) -> bytes:
        out = array("i", self.codec.best(segment)).tobytes()
        if len(segment) <= LONGEST_KEPT:
            if len(self) >= MEMORY:
                self.clear()
            self[segment] = out
        return out


class Codec:
    def __init__(self, vocabulary: Vocabulary) -> None:
        self.automaton = ahocorasick.Automaton()
        known = [(i, p) for i, p in enumerate(vocabulary.pieces) if p]
        for i, piece in known:
            self.automaton.add_word(piece, (len(piece), vocabulary.scores[i], i))
        self.automaton.make_automaton()
        self.single = {p for _, p in known if len(p) == 1}
        self.unknown = min((vocabulary.scores[i] for i, _ in known), default=0.0) - PENALTY
        self.byte_ids = vocabulary.byte_ids
        self.spelt: dict[int, bytes] = {i: p.replace(BLANK, " ").encode() for i, p in known} | {i: bytes([b]) for b, i in enumerate(vocabulary.byte_ids)}
        self.lines_apart = not any("\n" in p for _, p in known)
        self.words_apart = not any(BLANK in p.lstrip(BLANK) for _, p in known)
        self.kept = _Kept(self)

    def best(self, segment: str) -> list[int]:
        """Ids of the segmentation with the greatest sum of scores; of equal ones, that with the longer last piece."""
        n = len(segment)
        score, back = [0.0] + [-math.inf] * n, [(1, -1)] * (n + 1)
        strange = [at for at, sign in enumerate(segment) if sign not in self.single]
        seen = 0
        for end, (length, value, i) in self.automaton.iter(segment):
            while seen < len(strange) and strange[seen] < end:
                self._unknown(strange[seen], score, back)
                seen += 1
            total = score[end + 1 - length] + value
            if total > score[end + 1]:
                score[end + 1], back[end + 1] = total, (length, i)
        for at in strange[seen:]:
            self._unknown(at, score, back)
        out, at = [], n
        while at:
            length, i = back[at]
            at -= length
            if i >= 0:
                out.append(i)
            else:
                sign = BLANK if segment[at] == _LITERAL else segment[at]
                out += [self.byte_ids[b] for b in reversed(sign.encode())]
        out.reverse()
        return out

    def _unknown(self, at: int, score: list[float], back: list[tuple[int, int]]) -> None:
        """Relax the end of a character that is no piece, before anything that ends later does."""
        if score[at] + self.unknown > score[at + 1]:
            score[at + 1], back[at + 1] = score[at] + self.unknown, (1, -1)

    def _segments(self, text: str) -> Iterable[str]:
        if BLANK in text:
            text = text.replace(BLANK, _LITERAL)
        if not self.words_apart:
            return [BLANK + text.replace(" ", BLANK)]
        if self.lines_apart and "  " not in text and text[:1] != " ":
            return filter(None, (BLANK + text.replace(" ", " " + BLANK).replace("\n", " \n ")).split(" "))
        marked = BLANK + text.replace(" ", BLANK)
        lines = marked.split("\n") if self.lines_apart else [marked]
        return chain.from_iterable((["\n"] if k else []) + _SEGMENTS.findall(line) for k, line in enumerate(lines))

    def encode(self, text: str | None) -> bytes:
        """Ids as int32 bytes."""
        return b"".join(map(self.kept.__getitem__, self._segments(text))) if text else b""

    def decode(self, ids: np.ndarray) -> str:
        out = b"".join(map(self.spelt.__getitem__, ids.tolist())).decode("utf-8", "replace")
        return out[1:] if out.startswith(" ") else out


def encode_pieces(documents: DataFrame, model_path: str, text: str = "text", into: str = "ids", check: str | None = None) -> DataFrame:
    """documents with the ids of the text; check names a column for whether decoding gives the text back. model_path is read on the driver."""
    small_batches(documents.sparkSession)
    shared = documents.sparkSession.sparkContext.broadcast(Vocabulary.load(model_path))
    new = [into] + ([check] if check else [])
    kept = [c for c in documents.columns if c not in new]
    plain = documents.select(*[f"`{c}`" for c in kept])

    def run(batches) -> Iterator[pa.RecordBatch]:
        codec = Codec(shared.value)
        for batch in batches:
            texts = batch.column(kept.index(text)).to_pylist()
            coded = [codec.encode(t) for t in texts]
            ends = np.concatenate([[0], np.cumsum([len(c) // 4 for c in coded])]).astype(np.int32)
            columns = [pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(coded), np.int32)))]
            if check:
                columns.append(pa.array([codec.decode(np.frombuffer(c, np.int32)) == (t or "") for c, t in zip(coded, texts, strict=True)], pa.bool_()))
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], names=[*kept, *new])

    return plain.mapInArrow(run, appended(plain.schema, f"`{into}` array<int>" + (f", `{check}` boolean" if check else "")))


def decode_pieces(coded: DataFrame, model_path: str, ids: str = "ids", into: str = "text") -> DataFrame:
    """coded with the text that the ids spell."""
    small_batches(coded.sparkSession)
    shared = coded.sparkSession.sparkContext.broadcast(Vocabulary.load(model_path))
    kept = [c for c in coded.columns if c != into]
    plain = coded.select(*[f"`{c}`" for c in kept])

    def run(batches) -> Iterator[pa.RecordBatch]:
        codec = Codec(shared.value)
        for batch in batches:
            texts = [codec.decode(np.array(x or [], np.int32)) for x in batch.column(kept.index(ids)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*kept, into])

    return plain.mapInArrow(run, appended(plain.schema, f"`{into}` string"))


def piece_digest(documents: DataFrame, model_path: str) -> DataFrame:
    coded = encode_pieces(documents.select("doc_id", "text"), model_path, check="round_trip")
    return coded.select("doc_id", "ids", F.size("ids").alias("n_ids"), "round_trip")
