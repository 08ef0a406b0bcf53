"""Plain restatements of what the operators must return, for small inputs."""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections import Counter
from functools import cache

import numpy as np
import public_tokenizers
import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@cache
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def ids(text):
    return np.array([*tokenizer().encode(text or "", add_special_tokens=False).ids, 2], "<u4")


def roots(n, links):
    """Smallest index reached by each of n nodes."""
    near = [set() for _ in range(n)]
    for a, b in links:
        near[a].add(b)
        near[b].add(a)
    root = [-1] * n
    for i in range(n):
        todo = [i] if root[i] < 0 else []
        while todo:
            j = todo.pop()
            if root[j] < 0:
                root[j] = i
                todo += near[j]
    return root


def smallest_ids(root, given):
    best = {}
    for r, d in zip(root, given, strict=True):
        if d is not None:
            best[r] = min(best.get(r, d), d)
    return [best.get(r) for r in root]


def fingerprint(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(rows):
    """Component of every row, as the number of its first row."""
    prints = [fingerprint(t) for _, t in rows]
    links = [
        (i, j)
        for i in range(len(prints))
        for j in range(i)
        if (prints[i] ^ prints[j]).bit_count() <= 4
    ]
    return roots(len(rows), links)


def simhash(rows):
    prints = [fingerprint(t) for _, t in rows]
    found = smallest_ids(groups(rows), [d for d, _ in rows])
    return [
        (d, format(p, "016x"), c) for (d, _), p, c in zip(rows, prints, found, strict=True)
    ]


def covered(rows, least=200):
    texts = [(t or "").encode() for _, t in rows]
    seen = Counter(t[a : a + least] for t in texts for a in range(len(t) - least + 1))
    out = []
    for (doc_id, _), text in zip(rows, texts, strict=True):
        gone = bytearray(len(text))
        for a in range(len(text) - least + 1):
            if seen[text[a : a + least]] > 1:
                gone[a : a + least] = b"\1" * least
        left = bytes(x for x, g in zip(text, gone, strict=True) if not g)
        runs = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        digest = hashlib.sha256(left).hexdigest()
        out.append((doc_id, len(text), len(text) - len(left), runs, digest))
    return out


def vector_links(rows, threshold=0.95):
    def valid(v):
        return v is not None and any(v) and all(x is not None and np.isfinite(x) for x in v)

    n, links, degree = len(rows), [], [0] * len(rows)
    for i in range(n):
        for j in range(i):
            v, w = rows[i][1], rows[j][1]
            if valid(v) and valid(w) and len(v) == len(w):
                a, b = np.array(v, float), np.array(w, float)
                a, b = a / np.abs(a).max(), b / np.abs(b).max()
                if a @ b / np.linalg.norm(a) / np.linalg.norm(b) >= threshold:
                    links.append((i, j))
                    degree[i] += 1
                    degree[j] += 1
    found = smallest_ids(roots(n, links), [d for d, _ in rows])
    return [(d, g, c, d == c) for (d, _), g, c in zip(rows, degree, found, strict=True)]


def captures(rows):
    payloads = [(h or "").encode() for _, _, h in rows]
    n, first = Counter(payloads), {}
    for (p, _, _), b in zip(rows, payloads, strict=True):
        if p is not None:
            first[b] = min(first.get(b, p), p)
    out = []
    for (p, _, _), b in zip(rows, payloads, strict=True):
        response = n[b] == 1 or p == first.get(b)
        digest = base64.b32encode(hashlib.sha1(b).digest()).decode()
        kind = "response" if response else "revisit"
        out.append((p, len(b), digest, kind, None if response else first.get(b)))
    return out


def token_file(rows):
    """Expects distinct doc_ids."""
    out, start = [], 0
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0])):
        found = ids(text)
        out.append((doc_id, start, len(found), zlib.crc32(found.tobytes())))
        start += len(found)
    return out
