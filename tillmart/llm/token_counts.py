"""Word-piece token counts without building the pieces.

Greedy longest-match over a word needs one pass when the vocabulary trie has failure links and, at
every node, the number of pieces that following its link completes. Words are runs of anything but
ASCII white space. With ``spell``, a word that begins with no start piece begins with the bare word
start, and a character in no piece is its UTF-8 bytes, as the model has it; so no word is unknown.
Without it, as in the WordPiece model, a word that the pieces cannot spell is one unknown token.

Defined results: null and empty texts have no words and no tokens. Repeated rows are counted each.
Other columns are dropped, whatever their names. An empty table gives no rows.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillmart.llm.arrow import slices, utf8

#: Counts kept per Python worker; the store is emptied at this size.
MAX_WORDS = 1_000_000


class Automaton:
    """``starts`` are pieces at the start of a word, ``inner`` those that follow one.

    ``spell``: the bare word start and the 256 bytes are pieces too.
    """

    def __init__(self, starts: Iterable[str], inner: Iterable[str], spell: bool = False):
        self.spell = spell
        self.next: list[dict[str, int]] = [{}, {}]
        self.link: list[int] = [-1, -1]
        self.popped: list[int] = [0, 0]
        whole = [False, False]
        for root, pieces in ((0, starts), (1, inner)):
            for piece in pieces:
                node = root
                for c in piece:
                    found = self.next[node].get(c)
                    if found is None:
                        found = self.next[node][c] = len(self.next)
                        self.next.append({})
                        self.link.append(-1)
                        self.popped.append(0)
                        whole.append(False)
                    node = found
                whole[node] = whole[node] or bool(piece)
        if spell:
            self.link[0], self.popped[0] = 1, 1
        self._join(whole)

    def _join(self, whole: list[bool]) -> None:
        queue = deque([0, 1])
        while queue:
            parent = queue.popleft()
            for c, node in self.next[parent].items():
                if whole[node]:
                    self.link[node], self.popped[node] = 1, 1
                else:
                    back, n = self.link[parent], self.popped[parent]
                    while back >= 0 and c not in self.next[back]:
                        n += self.popped[back]
                        back = self.link[back]
                    if back >= 0:
                        self.link[node], self.popped[node] = self.next[back][c], n
                    elif self.spell:
                        self.link[node], self.popped[node] = 1, n + len(c.encode())
                queue.append(node)

    def count(self, word: str) -> int:
        """Pieces of the word; 0 if it cannot be spelt."""
        node, n = 0, 0
        for c in word:
            found = self.next[node].get(c)
            while found is None:
                back = self.link[node]
                if back < 0:
                    if not self.spell:
                        return 0
                    n += len(c.encode())
                    found = node
                    break
                n += self.popped[node]
                node = back
                found = self.next[node].get(c)
            node = found
        while node != 1:
            back = self.link[node]
            if back < 0:
                return 0
            n += self.popped[node]
            node = back
        return n


class _Counts(dict):
    def __init__(self, automaton: Automaton):
        super().__init__()
        self.automaton = automaton

    def __missing__(self, word: bytes) -> int:
        n = self[word] = self.automaton.count(word.decode())
        return n


def pieces(model_file: str) -> tuple[list[str], list[str]]:
    """Start and inner pieces of a sentencepiece vocabulary (word starts carry U+2581).

    Control, byte and unknown pieces are left out: they are no strings of a text.
    """
    from sentencepiece import SentencePieceProcessor

    p = SentencePieceProcessor(model_file=model_file)
    plain = [
        p.id_to_piece(i)
        for i in range(p.get_piece_size())
        if not (p.is_control(i) or p.is_byte(i) or p.is_unknown(i))
    ]
    starts = [x[1:] for x in plain if x.startswith("▁")]
    return [x for x in starts if x], [x for x in plain if "▁" not in x]


def spells(model_file: str) -> bool:
    """Whether a sentencepiece vocabulary has the bare word start and every byte."""
    from sentencepiece import SentencePieceProcessor

    p = SentencePieceProcessor(model_file=model_file)
    every = range(p.get_piece_size())
    return sum(map(p.is_byte, every)) == 256 and any(p.id_to_piece(i) == "▁" for i in every)


@lru_cache(maxsize=2)
def _counts(model_file: str, spell: bool) -> _Counts:
    return _Counts(Automaton(*pieces(model_file), spell and spells(model_file)))


def token_counts(docs: DataFrame, model_file: str, spell: bool = False) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_words, n_tokens, n_unknown.

    ``n_tokens`` counts an unknown word as one token. ``spell`` has an effect only if the vocabulary
    has the pieces for it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = _counts(model_file, spell)
        for batch in slices(batches):
            if len(counts) > MAX_WORDS:
                counts.clear()
            rows = []
            for text in utf8(batch.column("text")):
                found = list(map(counts.__getitem__, text.split()))
                unknown = found.count(0)
                rows.append((len(found), sum(found) + unknown, unknown))
            columns = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(c, pa.int64()) for c in columns)],
                ["doc_id", "n_words", "n_tokens", "n_unknown"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(run, "doc_id long, n_words long, n_tokens long, n_unknown long")
