"""Token ids of whole texts with the tokenizers library, at the price of the distinct words.

The library's steps (normalise, split, merge) never look across white space, so a text is the
concatenation of its words. A worker keeps the ids of the words it has met; the library is asked
only for new ones. The store is emptied when it holds ``MAX_WORDS`` words, which bounds memory and
changes no result.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Sequence
from functools import lru_cache

import numpy as np

#: Words kept per Python worker, about 200 bytes each.
MAX_WORDS = 700_000

#: Letters of which none joins with another under normalisation.
_LETTERS = "a-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff"
_PLAIN = re.compile(f"([{_LETTERS}]*)([.,]?)")


class Encoder:
    """Encodes UTF-8 texts; ``end_id`` is appended to every text."""

    def __init__(self, path: str, end_id: int | None, max_words: int = MAX_WORDS):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.end_id, self.max_words = end_id, max_words
        self.marked: dict[str, tuple[int, ...]] = {}
        #: Strings of special tokens are found before lower-casing, so case matters near them.
        self.marks = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.lowers = self._lowers()
        self.letters = self._letters() if self.lowers else {}
        self.simple = self.lowers and self._simple()
        self._clear()

    def _clear(self) -> None:
        self.words: dict[bytes, int] = _Words(self)
        self.flat = array("I")
        self.begins, self.sizes = array("q"), array("q")

    def _ids(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _lowers(self) -> bool:
        """Whether the library itself lower-cases A-Z, so that doing it first changes no ASCII text.

        Before a combining mark it can: some letters have a composed form in lower case only.
        """
        letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
        return "lowercase" in str(self.tokenizer.normalizer).lower() and all(
            self.tokenizer.normalizer.normalize_str(c) == c.lower() for c in letters
        )

    def _letters(self) -> dict[int, str]:
        """How the library spells each plain letter when it hands a piece to the model."""
        letters = [c for c in map(chr, range(256)) if _PLAIN.fullmatch(c) and c.isalpha()]
        spelt = {c: self.tokenizer.normalizer.normalize_str(c) for c in letters}
        return {
            ord(c): "".join(p for p, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(x))
            for c, x in spelt.items()
        }

    def _simple(self) -> bool:
        """Whether plain letters in a row are one piece of the model, and the mark another."""
        samples = ["abz", "theq", "ab.", "xyzzyq,", "z.", "\u00e9t\u00c9", "\u00c9\u00ff.", *(
            f"q{chr(c)}x{chr(c)}," for c in self.letters
        )]
        return all(self._ids(s) == list(self._plain(_PLAIN.fullmatch(s))) for s in samples)

    def _plain(self, word: re.Match) -> tuple[int, ...]:
        head, tail = word.groups()
        ids = tuple(t.id for t in self.model.tokenize(head.translate(self.letters))) if head else ()
        return ids + self._mark(tail) if tail else ids

    def _mark(self, mark: str) -> tuple[int, ...]:
        if mark not in self.marked:
            self.marked[mark] = tuple(t.id for t in self.model.tokenize(mark))
        return self.marked[mark]

    def add(self, word: bytes) -> int:
        text = word.decode()
        plain = self.simple and _PLAIN.fullmatch(text)
        ids = self._plain(plain) if plain else self._ids(text)
        code = len(self.begins)
        self.begins.append(len(self.flat))
        self.sizes.append(len(ids))
        self.flat.extend(ids)
        return code

    def encode(self, texts: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts in a row (uint32), and how many each text has."""
        if len(self.words) > self.max_words:
            self._clear()
        codes, counts = array("q"), []
        for text in texts:
            if self.lowers and not any(m[:2] in text for m in self.marks):
                if text.isascii():
                    words = text.lower().split()
                else:
                    words = [w.lower() if w.isascii() else w for w in text.split()]
            else:
                words = text.split()
            codes.extend(map(self.words.__getitem__, words))
            counts.append(len(words))
        codes = np.frombuffer(codes, np.int64)
        begins, sizes = np.frombuffer(self.begins, np.int64), np.frombuffer(self.sizes, np.int64)
        size = sizes[codes]
        ends = np.cumsum(size)
        total = int(ends[-1]) if len(ends) else 0
        where = np.arange(total) + np.repeat(begins[codes] - (ends - size), size)
        ids = np.frombuffer(self.flat, np.uint32)[where] if total else np.empty(0, np.uint32)
        upto = np.concatenate([[0], ends])[np.cumsum([0, *counts])]
        lengths = np.diff(upto)
        if self.end_id is not None:
            ids = np.insert(ids, upto[1:], np.uint32(self.end_id))
            lengths = lengths + 1
        return ids, lengths


class _Words(dict):
    def __init__(self, encoder: Encoder):
        super().__init__()
        self.encoder = encoder

    def __missing__(self, word: bytes) -> int:
        code = self[word] = self.encoder.add(word)
        return code


@lru_cache(maxsize=2)
def encoder(path: str, end_id: int | None) -> Encoder:
    """One encoder per worker process, so that later tasks know the words of earlier ones."""
    return Encoder(path, end_id)
