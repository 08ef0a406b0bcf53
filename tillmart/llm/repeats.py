"""Suffix-array deduplication: bytes covered by a long string that also starts elsewhere.

Equal strings of ``LEAST`` bytes hold an equal anchor, a KEY-byte string whose hash is the smallest
nearby. So it is enough to compare the surroundings of anchors that occur twice or more:

1. Every text gives its anchors: position, hash of the anchor, hash of its surroundings (the bytes
   that share a LEAST-byte string with it).
2. Anchors are counted by both hashes, summed before the shuffle. Where equal surroundings recur,
   all their bytes are covered and need no further work; that settles copies and the inside of
   long repeats, however common.
3. For an anchor with several different surroundings, one row for each is brought together and
   ``suffixes`` finds the maximal repeats among them by a common-prefix interval tree.

A bucket with more than ``MOST`` different surroundings is first cut by how far the repeat
reaches to the left of the anchor: each part asks for more equal bytes, surroundings that are
equal on a whole part are settled and merged, those without a partner leave. So no task gets an
unbounded bucket and no string is left out.

Texts are known by 96 bits of two hashes of their bytes; hashes of surroundings have 128 bits (both taken
together).

Defined results: null text is the empty text. Texts shorter than LEAST lose nothing. Texts that
occur twice or more with LEAST bytes lose everything. Repeated rows are documents of their own, so
they remove each other. A text that loses all bytes keeps the empty string. Other columns are
dropped from the report; ``without_repeats`` carries them. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillmart.llm.arrow import slices, utf8
from tillmart.llm.scratch import kept
from tillmart.llm.suffixes import Hashed, Strings, mix

LEAST = 200
KEY = 100
#: Different surroundings in a bucket that one task compares.
MOST = 4096
#: Bytes of a text that are hashed at once; longer texts go in overlapping blocks.
BLOCK = 1 << 20
#: Parts into which a large bucket is cut.
PARTS = 4
MOST_BROADCAST = 100_000

_REACH = LEAST - KEY


def text_keys(texts: list[bytes]) -> tuple[list[int], list[int]]:
    """96 bits that stand for a text: a long and an int."""
    found = [xxhash.xxh3_128_intdigest(t) for t in texts]
    long = [((x >> 64) ^ (1 << 63)) - (1 << 63) for x in found]
    return long, [((x & 0xFFFFFFFF) ^ (1 << 31)) - (1 << 31) for x in found]


def _key_columns(text: Column) -> tuple[Column, Column]:
    """96 bits that stand for a text, of two hash functions; no text goes to Python for them."""
    whole = F.coalesce(text, F.lit(""))
    return F.xxhash64(whole), F.hash(whole)


def _keyed(docs: DataFrame) -> DataFrame:
    """(k, k2, text) of the texts that can hold a repeat."""
    k, k2 = _key_columns(F.col("text"))
    rows = docs.where(F.octet_length("text") >= LEAST)
    return rows.select(k.alias("k"), k2.alias("k2"), "text")


def _extreme(values: np.ndarray, width: int, pick: np.ufunc) -> np.ndarray:
    """Smallest or largest of every run of ``width`` values."""
    out, have = values, 1
    while 2 * have <= width:
        out = pick(out[:-have], out[have:])
        have *= 2
    n = len(values) - width + 1
    return pick(out[:n], out[width - have : width - have + n])


def anchors(text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Positions of the anchors, hashes of the anchors and of their surroundings."""
    found = []
    for at in range(0, max(1, len(text) - KEY + 1), BLOCK):
        begin, end = max(0, at - LEAST), min(len(text), at + BLOCK + LEAST + KEY)
        if end - begin < LEAST:
            continue
        hashed = Hashed(np.frombuffer(text, np.uint8, end - begin, begin))
        keys = hashed.windows(KEY)
        least = _extreme(keys, _REACH + 1, np.minimum)
        edge = np.zeros(_REACH, np.uint64)
        chosen = _extreme(np.concatenate([edge, least, edge]), _REACH + 1, np.maximum) == keys
        pos = np.flatnonzero(chosen)
        pos = pos[(pos + begin >= at) & (pos + begin < at + BLOCK)]
        lo, hi = np.maximum(pos - _REACH, 0), np.minimum(pos + LEAST, end - begin)
        shape = ((pos - lo) << 20 | (hi - pos)).astype(np.uint64)
        found.append((pos + begin, keys[pos], hashed.of(lo, hi) ^ mix(shape)))
    if not found:
        none = np.empty(0, np.uint64)
        return none.astype(np.int64), none, none
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _anchored(docs: DataFrame) -> DataFrame:
    """(k, k2, pos, run, g, c): runs of equal anchors that follow each other are one row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            out: list[list] = [[] for _ in range(6)]
            keys = (batch.column(c).to_pylist() for c in ("k", "k2"))
            for text, k, k2 in zip(utf8(batch.column("text")), *keys, strict=True):
                pos, g, c = anchors(text)
                new = np.r_[True, (np.diff(pos) != 1) | (g[1:] != g[:-1]) | (c[1:] != c[:-1])]
                at = np.flatnonzero(new)
                n = len(at)
                parts = (
                    np.full(n, k, np.int64),
                    np.full(n, k2, np.int32),
                    pos[at].astype(np.int32),
                    np.diff(np.r_[at, len(pos)]).astype(np.int32),
                    g[at].view(np.int64),
                    c[at].view(np.int64),
                )
                for column, part in zip(out, parts, strict=True):
                    column.append(part)
            if out[0]:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(c)) for c in out], ["k", "k2", "pos", "run", "g", "c"]
                )

    return _keyed(docs).mapInArrow(run, "k long, k2 int, pos int, run int, g long, c long")


def _surroundings(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """The bytes around the anchors in ``wanted`` (k, k2, pos, g, n), one row for each."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = {name: [] for name in ("k", "k2", "pos", "b", "n", "left", "bytes")}
            texts = utf8(batch.column("text"))
            keys = (batch.column(c).to_pylist() for c in ("k", "k2", "at"))
            for text, k, k2, places in zip(texts, *keys, strict=True):
                for place in places:
                    pos = place["pos"]
                    lo = max(0, pos - _REACH)
                    row = (k, k2, pos, place["g"], place["n"], pos - lo, text[lo : pos + LEAST])
                    for column, value in zip(rows.values(), row, strict=True):
                        column.append(value)
            yield pa.RecordBatch.from_pydict(rows, schema)

    schema = pa.schema(
        [("k", pa.int64()), ("k2", pa.int32()), ("pos", pa.int32()), ("b", pa.int64()),
         ("n", pa.int64()), ("left", pa.int32()), ("bytes", pa.binary())]
    )
    places = wanted.groupBy("k", "k2").agg(F.collect_list(F.struct("pos", "g", "n")).alias("at"))
    # Copies of a text would each be searched; one of them is enough.
    joined = _keyed(docs).join(places, ["k", "k2"]).dropDuplicates(["k", "k2"])
    return joined.mapInArrow(
        cut, "k long, k2 int, pos int, b long, n long, left int, bytes binary"
    ).withColumns({"lo": F.lit(0), "hi": F.lit(_REACH)})


def _cut(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows of large buckets in parts; and the spans that are settled by that."""
    step = F.ceil((F.col("hi") - F.col("lo") + 1) / PARTS).cast("int")
    first = F.explode(F.sequence(F.col("lo"), F.col("hi"), step))
    parts = rows.withColumn("_step", step).withColumn("_lo", first)
    parts = parts.withColumn("hi", F.least("hi", F.col("_lo") + F.col("_step") - 1))
    parts = parts.withColumn("lo", F.col("_lo")).drop("_lo", "_step")
    left, size = F.col("left"), F.length("bytes")
    parts = parts.where((left >= F.col("lo")) & (size - left >= LEAST - F.col("hi")))
    reach = F.least("left", "hi")
    begin, end = left - reach, F.least(size, left + LEAST - F.col("lo"))
    core = _sub(left - F.col("lo"), left + LEAST - F.col("hi"))
    parts = parts.withColumns(
        {
            "b": F.xxhash64("b", "lo", core),
            "_f": F.xxhash64(F.lit(2), "b", "lo", _sub(begin, end), reach),
            "_from": F.col("pos") - reach,
            "_to": F.col("pos") - left + end,
        }
    )
    kinds = parts.groupBy("b", "_f").agg(F.sum("n").alias("_n"), F.min("k").alias("_k"))
    several = kinds.groupBy("b").agg(F.count("*").alias("_kinds"))
    told = parts.join(kinds, ["b", "_f"]).join(several, "b")
    told = kept(told, "parts")
    spans = told.where((F.col("_n") > 1) & (F.col("_to") - F.col("_from") >= LEAST)).select(
        "k", "k2", F.col("_from").alias("start"), F.col("_to").alias("end")
    )
    rest = told.where("_kinds > 1").dropDuplicates(["b", "_f"]).withColumn("n", F.col("_n"))
    return rest.select(*rows.columns), spans


def _sub(begin: Column, end: Column) -> Column:
    return F.col("bytes").substr(begin + 1, end - begin)


def _compared(rows: DataFrame) -> DataFrame:
    """Spans (k, k2, start, end) that repeat within the buckets of ``rows``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            for part in slices(iter([batch]), "bytes", 1 << 19):
                buckets = part.column("b").to_numpy()
                same = buckets[::-1] == buckets[-1]
                cut = 0 if same.all() else len(buckets) - int(same.argmin())
                last = held[-1].column("b")[-1].as_py() if held else None
                if held and size > 1 << 20:
                    # Rows of the last bucket may still come: compare up to where it began.
                    if buckets[0] != last:
                        yield from compare(pa.Table.from_batches(held))
                        held, size = [], 0
                    elif cut:
                        yield from compare(pa.Table.from_batches([*held, part.slice(0, cut)]))
                        held, size = [], 0
                        part = part.slice(cut)
                held.append(part)
                size += part.nbytes
        if held:
            yield from compare(pa.Table.from_batches(held))

    def compare(table: pa.Table) -> Iterator[pa.RecordBatch]:
        table = table.combine_chunks()
        col = {c: table.column(c).to_numpy() for c in ("k", "k2", "pos", "b", "n", "left", "lo", "hi")}
        strings = table.column("bytes").to_pylist()
        left = col["left"].astype(np.int64)
        first, last = np.maximum(left - col["hi"], 0), left - col["lo"]
        out = [[], [], [], []]
        text = np.unique(col["k"] ^ col["k2"], return_inverse=True)[1]
        offset = col["pos"] - left
        best: dict[tuple[int, int], int] = {}
        found = Strings(strings, col["b"], first, last, text, offset).repeats(LEAST)
        for length, owner, start in found:
            for i, s in zip(owner.tolist(), start.tolist(), strict=True):
                if length > best.get((i, s), 0):
                    best[i, s] = length
        for (i, s), length in best.items():
            begin = int(col["pos"][i] - left[i]) + s
            row = (int(col["k"][i]), int(col["k2"][i]), begin, begin + length)
            for column, value in zip(out, row, strict=True):
                column.append(value)
        if best:
            yield pa.RecordBatch.from_pydict(dict(zip(schema.names, out, strict=True)), schema)

    schema = pa.schema(
        [("k", pa.int64()), ("k2", pa.int32()), ("start", pa.int32()), ("end", pa.int32())]
    )
    dealt = rows.repartition("b").sortWithinPartitions("b")
    return dealt.mapInArrow(run, "k long, k2 int, start int, end int")


def spans(docs: DataFrame) -> DataFrame:
    """(k, k2, start, end): repeated stretches of every text; they may overlap or be repeated.

    ``k`` and ``k2`` are ``_key_columns``; an ``end`` beyond the text means its end.
    """
    found = kept(_anchored(docs), "anchors")
    kinds = found.groupBy("g", "c").agg(F.sum("run").alias("n"))
    groups = kinds.groupBy("g").agg(F.sum("n").alias("total"), F.count("*").alias("kinds"))
    told = kinds.join(groups.where("total > 1"), "g").select("g", "c", "n", "kinds")
    told = kept(told, "repeated-anchors")
    marked = kept(
        found.join(told, ["g", "c"]).select("k", "k2", "pos", "run", "g", "c", "n", "kinds"),
        "marked-anchors",
    )
    settled = marked.where("n > 1").select(
        "k",
        "k2",
        F.greatest(F.col("pos") - _REACH, F.lit(0)).alias("start"),
        (F.col("pos") + F.col("run") - 1 + LEAST).alias("end"),
    )
    wanted = marked.where("kinds > 1")
    wanted = wanted.where("n = 1").unionByName(wanted.where("n > 1").dropDuplicates(["g", "c"]))
    rows = kept(_surroundings(docs, wanted.select("k", "k2", "pos", "g", "n")), "surroundings")
    while True:
        large = kept(
            rows.groupBy("b").agg(F.count("*").alias("_rows")).where(F.col("_rows") > MOST),
            "large-buckets",
        ).select("b")
        count = large.count()
        if not count:
            break
        large = F.broadcast(large) if count <= MOST_BROADCAST else large
        rest, more = _cut(rows.join(large, "b", "left_semi"))
        settled = settled.unionByName(more)
        rows = kept(rows.join(large, "b", "left_anti").unionByName(rest), "surroundings")
    return settled.unionByName(_compared(rows))


def _merged(places: list[tuple[int, int]], size: int) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for start, end in sorted((a, min(b, size)) for a, b in places):
        if end - start < LEAST:
            continue
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return [(a, b) for a, b in out]


def _with_spans(docs: DataFrame, columns: list[str]) -> DataFrame:
    """``columns`` and ``_text`` of every row, and ``_at``, the stretches of its text."""

    k, k2 = _key_columns(F.col("text"))
    rows = docs.select(*columns, F.col("text").alias("_text"), k.alias("_k"), k2.alias("_k2"))
    by_text = spans(docs).groupBy(F.col("k").alias("_k"), F.col("k2").alias("_k2"))
    found = kept(by_text.agg(F.collect_set(F.struct("start", "end")).alias("_at")), "spans")
    return rows.join(found, ["_k", "_k2"], "left").select(*columns, "_text", "_at")


def _places(column: pa.Array) -> list[list[tuple[int, int]]]:
    return [[(p["start"], p["end"]) for p in x or ()] for x in column.to_pylist()]


def _remains(text: bytes, gone: list[tuple[int, int]]) -> bytes:
    edges = [0, *(x for span in gone for x in span), len(text)]
    return b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))


def report(docs: DataFrame) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_bytes, n_removed, n_spans, kept_sha256."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "_text"):
            rows = []
            texts = utf8(batch.column("_text"))
            for text, at in zip(texts, _places(batch.column("_at")), strict=True):
                gone = _merged(at, len(text))
                left = _remains(text, gone)
                digest = hashlib.sha256(left).hexdigest()
                rows.append((len(text), len(text) - len(left), len(gone), digest))
            columns = list(map(pa.array, zip(*rows, strict=True)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], names)

    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    names = [c.split()[0] for c in schema.split(", ")]
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return _with_spans(rows, ["doc_id"]).mapInArrow(run, schema)


def without_repeats(docs: DataFrame, drop_empty: bool = True) -> DataFrame:
    """``docs`` with the repeated stretches taken out of ``text``; ``n_chars`` is counted anew.

    A character that is cut in two goes whole. Texts of which nothing but white space is left are
    dropped if ``drop_empty`` is set.
    """
    others = [f"_c{i}" for i, c in enumerate(docs.columns) if c not in ("text", "n_chars")]
    names = [c for c in docs.columns if c not in ("text", "n_chars")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "_text"):
            out = []
            for text, at in zip(
                batch.column("_text").to_pylist(), _places(batch.column("_at")), strict=True
            ):
                if text is not None and at:
                    raw = text.encode()
                    text = _remains(raw, _merged(at, len(raw))).decode("utf-8", "ignore")
                out.append(text)
            arrays = [*(batch.column(c) for c in others), pa.array(out, pa.string())]
            yield pa.RecordBatch.from_arrays(arrays, [*others, "text"])

    rows = docs.select(*(F.col(c).alias(n) for c, n in zip(names, others, strict=True)), "text")
    schema = rows.schema
    out = _with_spans(rows, others).mapInArrow(run, schema)
    if drop_empty:
        out = out.where(F.col("text").rlike(r"\S"))
    given = {c: F.col(n) for c, n in zip(names, others, strict=True)} | {"text": F.col("text")}
    if "n_chars" in docs.columns:
        given["n_chars"] = F.length("text").cast(docs.schema["n_chars"].dataType)
    return out.select(*(given[c].alias(c) for c in docs.columns))
