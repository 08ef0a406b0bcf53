"""Capitals whose composed form exists in lower case only."""

import numpy as np
import public_tokenizers
from brute import ids

from tillmart.llm.encoder import Encoder

PAIRS = ["J̌", "H̱", "T̈", "W̊", "Y̊"]


def test_capitals_before_combining_marks():
    texts = [*PAIRS, *(f"Ab x{p}Y, {p} CD" for p in PAIRS), *(p.lower() for p in PAIRS)]
    found, n = Encoder(public_tokenizers.path("word_bpe_49k.json"), 2).encode(
        [t.encode() for t in texts]
    )
    ends = np.cumsum(n)
    for text, a, b in zip(texts, ends - n, ends, strict=True):
        assert list(found[a:b]) == list(ids(text)), text
