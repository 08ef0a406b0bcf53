"""SimHash near-duplicates by anchor points.

A 64-bit fingerprint is cut into three parts. If two fingerprints differ in at most four bits, they
differ in at most one bit in some part. The anchors of a part are a covering code: a Hamming code
over fifteen of its bits (covering radius one) and every value of the others. A fingerprint lives
at the anchor next to it and is copied to every anchor within the covering radius plus one; it is
compared with all that come to its home. So no pair within the threshold is missed, and the number
of copies is fixed (about 15 for each part).

Only distinct fingerprints are compared; equal ones are one class from the start. Anchors with very
many fingerprints are compared in a grid of cells.

Defined results: null, empty and blank texts have no words and the fingerprint zero, and are linked
like any other. Texts of one to three words are one shingle. Component ids are smallest doc_ids;
null doc_ids do not count for that, so a component of null ids has a null id. Repeated rows are
rows of their own. Other columns are dropped from the report; ``kept_documents`` carries all
columns. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillmart.llm.arrow import slices, utf8
from tillmart.llm.cells import forest, gridded, pair_chunks, whole_cells
from tillmart.llm.components import components
from tillmart.sources.shared import stored

WORDS = 4
SEED = 42
THRESHOLD = 4
#: First bit and number of bits of each part. One part more would be needed for each two bits more.
PARTS = ((0, 22), (22, 21), (43, 21))
#: The Hamming code covers the low fifteen bits of a part with radius one.
CODE = 15
RADIUS = 1
#: Fingerprints of an anchor that are compared in one cell.
CELL = 4096
#: Bytes of text that are hashed at once; their shingles take some thirty times as much.
SLICE_BYTES = 1 << 20


def fingerprints(texts: list[bytes]) -> np.ndarray:
    """Fingerprints (uint64) of UTF-8 texts."""
    digest, hashes, counts = xxhash.xxh64_intdigest, [], []
    for text in texts:
        words = text.lower().split()  # bytes: A-Z only, ASCII white space only
        line = b" ".join(words)
        if len(words) < WORDS:
            hashes += [digest(line, SEED)] if words else []
            counts.append(1 if words else 0)
            continue
        ends = np.cumsum([len(w) + 1 for w in words])
        starts = np.concatenate([[0], ends[: -WORDS]]).tolist()
        stops = (ends[WORDS - 1 :] - 1).tolist()
        hashes += [digest(line[a:b], SEED) for a, b in zip(starts, stops, strict=True)]
        counts.append(len(starts))
    n = np.array(counts, np.int64)
    out = np.zeros(len(texts), np.uint64)
    some = np.flatnonzero(n)
    if len(some):
        raw = np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8)
        begins = (np.cumsum(n) - n)[some]
        set_bits = np.empty((len(some), 64), np.int64)
        for byte in range(8):
            bits = np.unpackbits(raw[:, byte : byte + 1], axis=1, bitorder="little")
            set_bits[:, 8 * byte : 8 * byte + 8] = np.add.reduceat(bits, begins, 0, np.int64)
        half = 2 * set_bits > n[some, None]
        out[some] = np.packbits(half, axis=1, bitorder="little").view("<u8").ravel()
    return out


def _with_prints(docs: DataFrame, columns: list[str]) -> DataFrame:
    """``columns`` of ``docs`` and ``fp``, the fingerprint as a signed number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "_text", SLICE_BYTES):
            found = fingerprints(utf8(batch.column("_text"))).view(np.int64)
            arrays = [*(batch.column(c) for c in columns), pa.array(found)]
            yield pa.RecordBatch.from_arrays(arrays, [*columns, "fp"])

    rows = docs.select(*columns, F.col("text").alias("_text"))
    schema = rows.select(*columns, F.lit(0).cast("long").alias("fp")).schema
    return rows.mapInArrow(run, schema)


def _syndrome(mask: int) -> int:
    """Which codeword-breaking pattern the set bits of ``mask`` make; zero for a codeword."""
    out = 0
    for bit in range(CODE):
        if mask >> bit & 1:
            out ^= bit + 1
    return out


def _masks(bits: int) -> list[list[int]]:
    """For each syndrome, the flips of up to RADIUS + 1 bits that lead to an anchor."""
    ones = [1 << i for i in range(bits)]
    flips = [0, *ones, *(a | b for i, a in enumerate(ones) for b in ones[:i])]
    table: list[list[int]] = [[] for _ in range(CODE + 1)]
    for flip in flips:
        table[_syndrome(flip)].append(flip)
    return table


def anchored(classes: DataFrame) -> DataFrame:
    """(part, anchor, fp, home): every anchor that each fingerprint of ``classes`` goes to."""
    parts = []
    for part, (first, bits) in enumerate(PARTS):
        x = F.shiftrightunsigned("fp", first).bitwiseAND(F.lit((1 << bits) - 1).cast("long"))
        syndrome: Column = F.lit(0)
        for j in range(4):
            checked = sum(1 << i for i in range(CODE) if (i + 1) >> j & 1)
            parity = F.bit_count(F.col("_x").bitwiseAND(F.lit(checked).cast("long"))) % 2
            syndrome = syndrome + parity * (1 << j)
        table = F.array(*(F.array(*map(F.lit, flips)) for flips in _masks(bits)))
        rows = classes.select("fp", x.alias("_x")).withColumn("_s", syndrome)
        nearest = F.when(F.col("_s") == 0, 0).otherwise(F.expr("shiftleft(1, _s - 1)"))
        rows = rows.withColumn("_near", nearest).withColumn("_flip", F.explode(F.get(table, "_s")))
        parts.append(
            rows.select(
                F.lit(part).alias("part"),
                F.col("_x").bitwiseXOR(F.col("_flip").cast("long")).cast("int").alias("anchor"),
                "fp",
                (F.col("_flip") == F.col("_near")).alias("home"),
            )
        )
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def _links(classes: DataFrame) -> DataFrame:
    """Edges (a, b) that span every set of fingerprints linked within a cell."""
    by = ("part", "anchor", "cell_h", "cell_v")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, bounds in whole_cells(batches, by):
            fp = table.column("fp").to_numpy()
            bits = fp.view(np.uint64)
            home, visitor = (table.column(c).to_numpy() for c in ("is_home", "is_visitor"))
            for x, y in pair_chunks(bounds, home, visitor):
                near = np.bitwise_count(bits[x] ^ bits[y]) <= THRESHOLD
                near &= fp[x] != fp[y]
                if near.any():
                    node, root = forest(fp[x[near]], fp[y[near]])
                    yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(root)], ["a", "b"])

    return gridded(anchored(classes), ["part", "anchor"], "fp", CELL).mapInArrow(
        run, "a long, b long"
    )


def _labels(prints: DataFrame) -> DataFrame:
    """(fp, root, component_id) of every distinct fingerprint of ``prints`` (doc_id, fp)."""
    classes = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "classes")
    roots = components(_links(classes))
    labelled = classes.join(roots, classes["fp"] == roots["node"], "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")
    )
    smallest = labelled.groupBy("root").agg(F.min("first").alias("component_id"))
    labels = labelled.join(smallest, "root").select("fp", "root", "component_id")
    return stored(labels, "labels")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, fingerprint (hex), component_id."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    prints = stored(_with_prints(rows, ["doc_id"]), "fingerprints")
    return prints.join(_labels(prints), "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def kept_documents(docs: DataFrame) -> DataFrame:
    """One row of ``docs`` for each component: one with the smallest doc_id.

    Chosen by row, so texts that share a doc_id stand for their own components. A component without
    any doc_id keeps one row.
    """
    names = [f"_c{i}" for i in range(len(docs.columns))]
    rows = docs.select(*(F.col(c).alias(n) for c, n in zip(docs.columns, names, strict=True)))
    rows = stored(rows.withColumn("_row", F.monotonically_increasing_id()), "rows")
    # Texts go to the Python workers, only numbers come back.
    doc_id, text = (F.col(names[[c.lower() for c in docs.columns].index(x)]) for x in ("doc_id", "text"))
    prints = rows.select(doc_id.cast("long").alias("doc_id"), "_row", text.alias("text"))
    prints = stored(_with_prints(prints, ["doc_id", "_row"]), "fingerprints")
    labelled = prints.join(_labels(prints.select("doc_id", "fp")), "fp")
    best = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "_row")).alias("best")
    chosen = labelled.groupBy("root").agg(best).select(F.col("best._row").alias("_row"))
    # A table of the chosen numbers, so that the rows themselves need no sort.
    kept = rows.join(chosen.hint("shuffle_hash"), "_row", "left_semi")
    return kept.select(*(F.col(n).alias(c) for c, n in zip(docs.columns, names, strict=True)))
