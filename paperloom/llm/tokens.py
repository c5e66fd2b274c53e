"""Token ids of whole texts by a public tokenizer file, read on the driver and given to the workers."""

from __future__ import annotations

import json
import re

import numpy as np
import regex
from tokenizers import Tokenizer

#: Characters that no normal form joins with a neighbour, and whose only white space is tab, line ends and blank.
_PLAIN = re.compile("[^\t\n\r\x20-\x7e\xa1-\xff]")
#: Words whose ids are kept; when so many are held, the memory begins anew.
MEMORY = 800_000
LONGEST_KEPT = 24


def _byte_signs() -> list[str]:
    """The sign that a byte-level vocabulary has for each byte: itself where it prints, else one from 256 on."""
    prints = {*range(33, 127), *range(161, 173), *range(174, 256)}
    out, extra = [], 256
    for b in range(256):
        out.append(chr(b if b in prints else extra))
        extra += b not in prints
    return out


class _Words(dict):
    """Ids, as bytes, of what stands between white space."""

    def __init__(self, model, pattern: str) -> None:
        super().__init__()
        self.model, self.find, self.signs = model, regex.compile(pattern).findall, _byte_signs()

    def __missing__(self, word: str) -> bytes:
        ids = []
        for part in [word] if word.isalpha() and word.isascii() else self.find(word):
            coded = part if part.isascii() else "".join(map(self.signs.__getitem__, part.encode()))
            ids += [t.id for t in self.model.tokenize(coded)]
        out = np.array(ids, "<u4").tobytes()
        if len(word) <= LONGEST_KEPT:
            if len(self) >= MEMORY:
                self.clear()
            self[word] = out
        return out


class Encoder:
    """encode(text) gives the ids that the file's tokenizer gives without special tokens, as little-endian uint32 bytes.

    Where the file's rules are lower case, a split that never crosses white space, and a
    byte-level BPE, a plain text is cut at white space and the ids of a word are kept: the
    rules treat every such word by itself. Any other text goes to the tokenizer as it is.
    """

    def __init__(self, spec: str) -> None:
        self.tokenizer = Tokenizer.from_str(spec)
        rules = json.loads(spec)
        kinds = [n["type"] for n in (rules["normalizer"] or {}).get("normalizers", [])]
        split = (rules["pre_tokenizer"] or {}).get("pretokenizers", [])
        self.words = None
        if kinds == ["NFC", "Replace", "Lowercase"] and [p["type"] for p in split] == ["Split", "ByteLevel"] and rules["model"]["type"] == "BPE":
            first, second = split
            apart = first["invert"] and first["behavior"] == "Removed" and not second["use_regex"] and not second["add_prefix_space"]
            if apart and rules["normalizer"]["normalizers"][1]["pattern"] == {"Regex": "\\s+"} and first["pattern"]["Regex"].endswith("[^\\s\\p{L}\\p{N}]+"):
                self.words = _Words(self.tokenizer.model, first["pattern"]["Regex"])
        self.special = [t["content"] for t in rules.get("added_tokens", [])]

    def encode(self, text: str) -> bytes:
        if self.words is not None and not _PLAIN.search(text) and not any(s in text for s in self.special):
            return b"".join(map(self.words.__getitem__, text.lower().split()))
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
