"""Packing of documents into sequences of a fixed length.

Documents are dealt at random into groups of about ``group_tokens`` ids. In a group, documents
longer than a sequence give whole sequences first; what is left is packed first-fit decreasing,
where a tournament tree over the free room of the sequences finds the leftmost that fits in
logarithmic time. Then the least filled sequences are cut up to fill the gaps of the others, and
the last one is cut at powers of two, which need no padding.

Defined results: null text is the empty text (its end id alone). Repeated rows are documents of
their own. Rows of a common doc_id are spread by their place in the input. Other columns are
dropped, whatever their names. An empty table gives no rows. A document that is longer than a
group is a group by itself.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillmart.llm.arrow import slices, utf8
from tillmart.llm.encoder import encoder

SEQUENCE = 4096
GROUP_TOKENS = 1 << 21
#: Gaps below this are padded; a cut-off shorter than this is of no use to a model.
LEAST_CUT = 16

PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
    "sequence_id long, offset long"
)


class RoomTree:
    """Tournament tree of the free room of bins; the leftmost bin with enough room wins."""

    def __init__(self, bins: int, size: int):
        self.leaves = 1 << max(0, bins - 1).bit_length()
        self.room = [size] * (2 * self.leaves)

    def take(self, amount: int) -> int:
        """The first bin with room for ``amount``, which is then taken there."""
        room, node = self.room, 1
        while node < self.leaves:
            node *= 2
            if room[node] < amount:
                node += 1
        left = room[node] = room[node] - amount
        leaf, node = node - self.leaves, node // 2
        while node:
            left = max(room[2 * node], room[2 * node + 1])
            if room[node] == left:
                break
            room[node] = left
            node //= 2
        return leaf


def pack(lengths: list[int], size: int = SEQUENCE) -> list[list[tuple[int, int, int]]]:
    """Sequences as lists of (document, start, length), each with at most ``size`` ids."""
    full, rest = [], []
    for doc, n in enumerate(lengths):
        full += [[(doc, at, size)] for at in range(0, n - size + 1, size)]
        if n % size:
            rest.append((doc, n - n % size, n % size))
    rest.sort(key=lambda piece: (-piece[2], piece[0]))
    bins: list[list[tuple[int, int, int]]] = [[] for _ in rest]
    tree = RoomTree(len(rest), size)
    for piece in rest:
        bins[tree.take(piece[2])].append(piece)
    return full + _fill([b for b in bins if b], size)


def _fill(bins: list[list[tuple[int, int, int]]], size: int) -> list[list[tuple[int, int, int]]]:
    """Gaps of the fuller bins take pieces of the emptier ones, cut where they must be."""
    used = lambda b: sum(n for _, _, n in b)
    bins = sorted(bins, key=used, reverse=True)
    to, last = 0, len(bins) - 1
    gap = size - used(bins[0]) if bins else 0
    while to < last:
        if gap < LEAST_CUT:
            to += 1
            gap = size - used(bins[to])
            continue
        doc, start, n = bins[last].pop()
        take = min(n, gap)
        bins[to].append((doc, start, take))
        gap -= take
        if take < n:
            bins[last].append((doc, start + take, n - take))
        if not bins[last]:
            last -= 1
    bins = bins[: last + 1]
    return bins[:-1] + _powers(bins[-1]) if bins else bins


def _powers(pieces: list[tuple[int, int, int]]) -> list[list[tuple[int, int, int]]]:
    """One sequence for each binary digit of what the pieces hold together."""
    left = sum(n for _, _, n in pieces)
    pieces, sequences = pieces[::-1], []
    while left:
        room = 1 << (left.bit_length() - 1)
        left -= room
        sequences.append([])
        while room:
            doc, start, n = pieces.pop()
            take = min(n, room)
            sequences[-1].append((doc, start, take))
            room -= take
            if take < n:
                pieces.append((doc, start + take, n - take))
    return sequences


def packed(
    docs: DataFrame,
    tokenizer: str,
    end_id: int | None,
    size: int = SEQUENCE,
    group_tokens: int = GROUP_TOKENS,
    seed: int = 17,
    with_ids: bool = False,
) -> DataFrame:
    """Pieces of every document of ``docs`` (doc_id, text) with their place in the sequences.

    ``sequence_id`` is unique over all groups. ``with_ids`` adds the ids of each piece.
    """

    def emit(group: list[tuple[int | None, np.ndarray]], first: int) -> tuple[pa.RecordBatch, int]:
        columns: list[list] = [[] for _ in range(8)]
        sequences = pack([len(ids) for _, ids in group], size)
        for number, pieces in enumerate(sequences, first):
            offset = 0
            for doc, start, n in pieces:
                doc_id, ids = group[doc]
                part = ids[start : start + n]
                row = (doc_id, start, n, zlib.crc32(part), len(ids), number, offset, part)
                for column, value in zip(columns, row, strict=True):
                    column.append(value)
                offset += n
        arrays = [pa.array(c, pa.int64()) for c in columns[:7]]
        if with_ids:
            arrays.append(pa.array(columns[7], pa.list_(pa.int32())))
        return pa.RecordBatch.from_arrays(arrays, names), first + len(sequences)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 40
        group, held = [], 0
        for batch in slices(batches):
            ids, lengths = encoder(tokenizer, end_id).encode(utf8(batch.column("text")))
            ids = ids.astype("<u4", copy=False)
            ends = np.cumsum(lengths)
            for doc_id, a, b in zip(
                batch.column("doc_id").to_pylist(), ends - lengths, ends, strict=True
            ):
                if b > a:
                    group.append((doc_id, ids[a:b]))
                    held += int(b - a)
                if held >= group_tokens:
                    out, number = emit(group, number)
                    yield out
                    group, held = [], 0
        if group:
            yield emit(group, number)[0]

    schema = PIECES + (", ids array<int>" if with_ids else "")
    names = [c.split()[0] for c in schema.split(", ")]
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    place = F.xxhash64(F.lit(seed), "doc_id", F.spark_partition_id())
    # In an order of their own, so that a task that is run again packs the same sequences.
    dealt = rows.withColumn("_place", place).repartition("_place")
    return dealt.sortWithinPartitions("_place", "doc_id", F.xxhash64("text")).mapInArrow(run, schema)
