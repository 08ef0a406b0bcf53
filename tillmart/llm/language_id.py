"""Language of texts: sparse multinomial logistic regression on TF-IDF of character n-grams.

Features are the n-grams of one to three letters within words, word ends marked, hashed into
``BUCKETS``. Document frequencies are counted over all documents that may be learned from. The
weights are fitted by follow-the-regularised-leader with L1 and L2 penalties on a bounded sample, at
most ``SAMPLE`` documents in all (one a label if there are more labels) and the same number for each
label as far as it has them: those with the smallest hashes of doc_id and text; a part of the sample
is set aside to find the temperature that calibrates the scores.

Term frequencies are shares of a text's n-grams, so the logits of a text are sums over its words. A
worker keeps the sums of the words it has met.

What is learned from: rows with a label, a text with a letter, and a doc_id whose crc32 modulo 4 is
not 2. Defined results: null texts and texts without a letter are ``und`` with score 0; so is all
if there is nothing to learn from. Null doc_ids are predicted but never learned from. Ties go to the
label that sorts first. Repeated rows count each in
frequencies and predictions, and are one row of the sample. Other columns, ``source`` too, are never read. An
empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillmart.llm.arrow import slices, utf8

BUCKETS = 1 << 17
LENGTHS = (1, 2, 3)
#: Labelled documents that the weights are fitted on.
SAMPLE = 6000
#: Of these, one in so many is for the temperature.
CALIBRATE = 5
EPOCHS = 3
ALPHA, BETA, L1, L2 = 0.5, 1.0, 1e-3, 1e-3
SCALE = 30.0
SEED = 4
#: Words kept per Python worker; the store is emptied at this size and no result depends on it.
MAX_WORDS = 500_000
UNKNOWN = "und"


def grams(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the n-grams of all words in a row, and how many each word has.

    Letters are lower-cased, other characters left out; a word without a letter has none.
    """
    joined = " " + " ".join(w.decode().replace(" ", "") for w in words).lower() + " "
    points = np.frombuffer(joined.encode("utf-32-le"), "<u4")
    found, at = np.unique(points, return_inverse=True)
    kept = np.array([chr(p).isalpha() or p == 32 for p in found.tolist()])[at]
    points = points[kept].astype(np.uint64)
    edge = points == 32
    owner = np.cumsum(edge) - 1
    owners, hashes = [], []
    for n in LENGTHS:
        size = len(points) - n + 1
        begin = np.arange(max(size, 0))
        # One letter alone, two characters of which one is a letter, three around a letter.
        letter = ~edge[begin + n // 2] if n != 2 else ~(edge[begin] & edge[begin + 1])
        begin = begin[letter]
        h = np.full(len(begin), n, np.uint64)
        for k in range(n):
            h = h * np.uint64(0x9E3779B97F4A7C15) + points[begin + k]
        h ^= h >> np.uint64(29)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        owners.append(owner[begin])
        hashes.append((h >> np.uint64(64 - BUCKETS.bit_length() + 1)).astype(np.int32))
    owners = np.concatenate(owners)
    order = np.argsort(owners, kind="stable")
    return np.concatenate(hashes)[order], np.bincount(owners, minlength=len(words))


class Words(dict):
    """Numbers of words, and the n-grams of each in one flat array."""

    def __init__(self) -> None:
        super().__init__()
        self.start_over()

    def start_over(self) -> None:
        self.clear()
        self.new: list[bytes] = []
        self.flat = array("i")
        self.edges = array("q", [0])
        self.scores: dict[str, np.ndarray] = {}

    def __missing__(self, word: bytes) -> int:
        code = self[word] = len(self)
        self.new.append(word)
        return code

    def _take_in(self) -> None:
        """Find the n-grams of the words that are new."""
        if self.new:
            flat, sizes = grams(self.new)
            self.flat.frombytes(flat.tobytes())
            self.edges.frombytes((self.edges[-1] + np.cumsum(sizes)).astype(np.int64).tobytes())
            self.new = []

    def numbered(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of all words of the texts in a row, and where each text begins and ends."""
        if len(self) > MAX_WORDS:
            self.start_over()
        codes, ends = array("q"), [0]
        for text in texts:
            codes.extend(map(self.__getitem__, text.split()))
            ends.append(len(codes))
        self._take_in()
        return np.frombuffer(codes, np.int64), np.array(ends)

    def of(self, codes: np.ndarray) -> np.ndarray:
        """Buckets of all n-grams of the words with these numbers."""
        edges = np.frombuffer(self.edges, np.int64)
        begin, size = edges[codes], edges[codes + 1] - edges[codes]
        where = np.arange(size.sum()) + np.repeat(begin - np.cumsum(size) + size, size)
        return np.frombuffer(self.flat, np.int32)[where]

    def sizes(self) -> np.ndarray:
        return np.diff(np.frombuffer(self.edges, np.int64))

    def scored(self, model: Model) -> np.ndarray:
        """Sums of the weights of all words, one row for each; kept for the next texts."""
        have = self.scores.get(model.key)
        done = 0 if have is None else len(have)
        edges = np.frombuffer(self.edges, np.int64)[done:]
        flat = np.frombuffer(self.flat, np.int32)[edges[0] :]
        table = model.table()
        new = np.empty((len(edges) - 1, len(model.labels)))
        for label in range(len(model.labels)):
            upto = np.concatenate([[0], np.cumsum(table[flat, label])])
            at = edges - edges[0]
            new[:, label] = upto[at[1:]] - upto[at[:-1]]
        self.scores = {model.key: new if have is None else np.concatenate([have, new])}
        return self.scores[model.key]


_words: list[Words] = []


def _store() -> Words:
    """The words of this worker process."""
    if not _words:
        _words.append(Words())
    return _words[0]


@dataclass(frozen=True)
class Model:
    """Weights of the n-grams (inverse document frequency included), one column for each label."""

    labels: list[str]
    buckets: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    temperature: float = 1.0
    key: str = ""

    def table(self) -> np.ndarray:
        out = np.zeros((BUCKETS, len(self.labels)))
        out[self.buckets] = self.weights
        return out

    def logits(self, texts: list[bytes], words: Words) -> tuple[np.ndarray, np.ndarray]:
        """Logits of the texts, and the number of n-grams of each."""
        codes, ends = words.numbered(texts)
        text = np.repeat(np.arange(len(texts)), np.diff(ends))
        n = np.bincount(text, words.sizes()[codes], len(texts))
        scores = words.scored(self)[codes]
        sums = [np.bincount(text, scores[:, k], len(texts)) for k in range(len(self.labels))]
        return self.bias + SCALE * np.array(sums).T / np.maximum(n, 1)[:, None], n


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


def fitted(
    rows: list[tuple[int, np.ndarray, np.ndarray]], idf: np.ndarray, labels: list[str]
) -> Model:
    """Fit on (label, buckets, counts) rows by follow-the-regularised-leader."""
    k = len(labels)
    z, n = np.zeros((BUCKETS + 1, k)), np.zeros((BUCKETS + 1, k))

    def weights(at: np.ndarray) -> np.ndarray:
        shrunk = np.sign(z[at]) * np.maximum(np.abs(z[at]) - L1 * (at < BUCKETS)[:, None], 0)
        return -shrunk / ((BETA + np.sqrt(n[at])) / ALPHA + L2)

    rng = np.random.default_rng(SEED)
    order = rng.permutation(len(rows))
    aside, learn = order[::CALIBRATE], np.delete(order, np.s_[::CALIBRATE])
    if not len(learn):
        learn = order
    features = []
    for label, buckets, counts in rows:
        at = np.append(buckets, BUCKETS)
        x = np.append(SCALE * counts / counts.sum() * idf[buckets], 1.0)
        features.append((label, at, x))
    for _ in range(EPOCHS):
        for i in rng.permutation(learn):
            label, at, x = features[i]
            w = weights(at)
            slope = _softmax(x @ w)
            slope[label] -= 1
            g = x[:, None] * slope
            new = n[at] + g * g
            z[at] += g - (np.sqrt(new) - np.sqrt(n[at])) / ALPHA * w
            n[at] = new
    w = weights(np.arange(BUCKETS + 1))
    seen = [(features[i][0], features[i][2] @ w[features[i][1]]) for i in aside]
    some = np.flatnonzero((w[:-1] != 0).any(1))
    weighted = w[some] * idf[some, None]
    key = hashlib.md5(weighted.tobytes() + some.tobytes()).hexdigest()
    return Model(labels, some, weighted, w[-1], _temperature(seen), key)


def _temperature(rows: list[tuple[int, np.ndarray]]) -> float:
    """What to divide the logits by for the least log loss on the rows set aside."""
    if not rows:
        return 1.0
    label, logits = np.array([r[0] for r in rows]), np.array([r[1] for r in rows])

    def loss(log_t: float) -> float:
        p = _softmax(logits / np.exp(log_t))[np.arange(len(label)), label]
        return float(-np.log(np.maximum(p, 1e-12)).mean())

    low, high = -3.0, 3.0
    for _ in range(60):
        a, b = low + (high - low) / 3, high - (high - low) / 3
        low, high = (low, b) if loss(a) <= loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


def _rest(doc_id: str = "doc_id") -> Column:
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4


def _sample(learn: DataFrame, sizes: dict[str, tuple[int, float]], size: int = 0) -> DataFrame:
    """The rows of ``learn`` (lang, text, drawn) with the smallest numbers, at most ``size`` in all.

    Every label has the same share, at least one row. ``sizes`` holds each label's rows and smallest
    number. Rows above four shares' worth of numbers are passed over before anything is shuffled, and
    equal rows become one, so a label or doc_id with a third of all rows sends no more than another.
    """
    share = max((size or SAMPLE) // len(sizes), 1)
    upto = {s: max(min(1.0, 4 * share / n), low) for s, (n, low) in sizes.items()}
    some = F.create_map(*(F.lit(x) for s, cut in upto.items() for x in (s, cut)))
    near = learn.where(F.col("drawn") <= some[F.col("lang")]).select("lang", "drawn", "text")
    order = F.row_number().over(Window.partitionBy("lang").orderBy("drawn"))
    near = near.dropDuplicates(["lang", "drawn"])
    return near.withColumn("nth", order).where(F.col("nth") <= share).drop("nth")


def train(docs: DataFrame) -> Model | None:
    """Fit on ``docs`` (doc_id, text, lang). The driver sees the counts of the hashed n-grams, one
    for each bucket at most, and the n-gram counts of the sample."""
    learn = docs.select("doc_id", "text", "lang").where(
        (_rest() != 2) & F.col("lang").isNotNull() & F.col("text").isNotNull()
    )

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, n, seen = np.zeros(BUCKETS, np.int64), 0, np.zeros(BUCKETS, bool)
        words = _store()
        for batch in slices(batches):
            codes, ends = words.numbered(utf8(batch.column("text")))
            for a, b in zip(ends, ends[1:], strict=False):
                buckets = words.of(codes[a:b])
                seen[buckets] = True
                found = np.flatnonzero(seen)
                seen[found] = False
                df[found] += 1
                n += len(found) > 0
        some = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(some, -1)), pa.array(np.append(df[some], n))], ["bucket", "df"]
        )

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _store()
        for batch in slices(batches):
            codes, ends = words.numbered(utf8(batch.column("text")))
            found = [
                np.unique(words.of(codes[a:b]), return_counts=True)
                for a, b in zip(ends, ends[1:], strict=False)
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("lang"),
                    pa.array([x for x, _ in found], pa.list_(pa.int32())),
                    pa.array([x for _, x in found], pa.list_(pa.int32())),
                ],
                ["lang", "buckets", "counts"],
            )

    counted = learn.select("text").mapInArrow(frequencies, "bucket long, df long")
    df = dict(counted.groupBy("bucket").agg(F.sum("df")).collect())
    total = df.pop(-1, 0)
    # A number for each row that differs in doc_id or text; equal rows share it.
    drawn = F.pmod(F.xxhash64(F.lit(SEED), "doc_id", "text"), F.lit(1 << 52)) / F.lit(float(1 << 52))
    learn = learn.withColumn("drawn", drawn)
    by_label = learn.groupBy("lang").agg(F.count("*").alias("n"), F.min("drawn").alias("low"))
    sizes = {r.lang: (r.n, r.low) for r in by_label.collect()}
    if not total or not df:
        return None
    idf = np.zeros(BUCKETS)
    idf[list(df)] = np.log((1 + total) / (1 + np.array(list(df.values())))) + 1
    labels = sorted(sizes)
    sample = _sample(learn, sizes)
    found = sample.select("lang", "text").mapInArrow(
        features, "lang string, buckets array<int>, counts array<int>"
    )
    number = {s: i for i, s in enumerate(labels)}
    table = found.where(F.size("buckets") > 0).toArrow()
    rows = sorted(
        (
            (number[s], np.array(b), np.array(c, np.float64))
            for s, b, c in zip(*(table.column(i).to_pylist() for i in range(3)), strict=True)
        ),
        key=lambda r: (r[0], r[1].tobytes(), r[2].tobytes()),
    )
    return fitted(rows, idf, labels) if rows else None


def predicted(docs: DataFrame, model: Model | None) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, held_out, lang_pred, score."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = utf8(batch.column("text"))
            names, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
            if model is not None:
                logits, n = model.logits(texts, _store())
                p = _softmax(logits / model.temperature)
                best = p.argmax(1)
                known = n > 0
                scores = np.where(known, p[np.arange(len(texts)), best], 0.0)
                names = [
                    model.labels[i] if k else UNKNOWN
                    for i, k in zip(best.tolist(), known.tolist(), strict=True)
                ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(names), pa.array(scores)],
                ["doc_id", "held_out", "lang_pred", "score"],
            )

    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(_rest() == 2, F.lit(False)).alias("held_out"),
        "text",
    )
    return rows.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")


def identified(docs: DataFrame) -> DataFrame:
    return predicted(docs, train(docs))
