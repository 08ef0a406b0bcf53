"""Comparison within buckets of any size.

A bucket is a set of rows that share a key; every home row of it meets every row. Buckets of more
than ``most`` rows are cut into a grid of cells, so that a task never needs more than about two
blocks of ``most`` rows at once, however large a bucket is. No pair is left out and none is written:
cells give sums and spanning edges only.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillmart.sources.shared import stored

#: Tables of large buckets are broadcast up to this many rows (about 24 bytes each).
MOST_BROADCAST = 100_000


def gridded(rows: DataFrame, key: Sequence[str], node: str, most: int) -> DataFrame:
    """``rows`` (key columns, node, ``home``, ...) dealt out by cell, each partition sorted by it.

    Adds ``cell_h``, ``cell_v``, ``is_home`` and ``is_visitor``.
    """
    sizes = rows.groupBy(*key).agg(F.count("*").alias("_n")).where(F.col("_n") > most)
    large = stored(sizes.withColumn("_g", F.ceil(F.col("_n") / most)).drop("_n"), "large-buckets")
    if large.count() <= MOST_BROADCAST:
        large = F.broadcast(large)
    dealt = rows.join(large, list(key), "left").withColumn("_g", F.coalesce("_g", F.lit(1)))
    block = F.pmod(F.xxhash64(node), F.col("_g"))
    cell = lambda h, v, home, visitor: F.struct(
        h.cast("long").alias("h"), v.cast("long").alias("v"), home.alias("x"), visitor.alias("y")
    )
    yes, no = F.lit(True), F.lit(False)
    others = F.sequence(F.lit(0).cast("long"), F.col("_g") - 1)
    grid = F.concat(
        F.transform(others, lambda h: cell(h, block, no, yes)),
        F.when(F.col("home"), F.transform(others, lambda v: cell(block, v, yes, no))).otherwise(
            F.array().cast("array<struct<h:bigint,v:bigint,x:boolean,y:boolean>>")
        ),
    )
    whole = F.array(cell(F.lit(0), F.lit(0), F.col("home"), yes))
    dealt = dealt.withColumn("_c", F.explode(F.when(F.col("_g") == 1, whole).otherwise(grid)))
    dealt = dealt.withColumns(
        {
            "cell_h": F.col("_c.h"),
            "cell_v": F.col("_c.v"),
            "is_home": F.col("_c.x"),
            "is_visitor": F.col("_c.y"),
        }
    ).drop("_c", "_g", "home")
    by = [*key, "cell_h", "cell_v"]
    return dealt.repartition(*by).sortWithinPartitions(*by)


def whole_cells(
    batches: Iterator[pa.RecordBatch], by: Sequence[str]
) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of complete cells, with the first row of each cell and the end of the last."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        marks = _bounds(batch, by)
        first = tuple(batch.column(c)[0].as_py() for c in by)
        if held and first != last:
            yield _together(held, by)
            held = []
        cut = int(marks[-1])  # where the last cell of the batch begins
        if cut:
            held.append(batch.slice(0, cut))
            yield _together(held, by)
            held = []
        held.append(batch.slice(cut))
        last = tuple(batch.column(c)[batch.num_rows - 1].as_py() for c in by)
    if held:
        yield _together(held, by)


def _bounds(batch: pa.RecordBatch | pa.Table, by: Sequence[str]) -> np.ndarray:
    new = np.ones(batch.num_rows, bool)
    new[1:] = False
    for c in by:
        x = batch.column(c).to_numpy(zero_copy_only=False) if isinstance(
            batch, pa.RecordBatch
        ) else batch.column(c).to_numpy()
        new[1:] |= x[1:] != x[:-1]
    return np.flatnonzero(new)


def _together(held: list[pa.RecordBatch], by: Sequence[str]) -> tuple[pa.Table, np.ndarray]:
    table = pa.Table.from_batches(held).combine_chunks()
    return table, np.append(_bounds(table, by), table.num_rows)


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nodes that are linked to another, and the smallest node each reaches."""
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = ends[: len(a)], ends[len(a) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[x], label[y])
        new = label.copy()
        np.minimum.at(new, label[x], low)
        np.minimum.at(new, label[y], low)
        while not np.array_equal(new, new[new]):
            new = new[new]
        if np.array_equal(new, label):
            break
        label = new
    other = label != np.arange(len(nodes))
    return nodes[other], nodes[label[other]]


def pair_chunks(
    bounds: np.ndarray, home: np.ndarray, visitor: np.ndarray, most: int = 1 << 21
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows (home, visitor) to compare, of all cells, about ``most`` at once."""
    visitors = np.flatnonzero(visitor)
    lo, hi = np.searchsorted(visitors, bounds[:-1]), np.searchsorted(visitors, bounds[1:])
    homes = np.flatnonzero(home)
    cell = np.searchsorted(bounds, homes, "right") - 1
    width = hi[cell] - lo[cell]
    upto = np.concatenate([[0], np.cumsum(width)])
    at = 0
    while at < len(homes):
        end = max(at + 1, int(np.searchsorted(upto, upto[at] + most, "right")) - 1)
        n = width[at:end]
        total = int(n.sum())
        shift = np.repeat(lo[cell[at:end]] - (np.cumsum(n) - n), n)
        yield np.repeat(homes[at:end], n), visitors[np.arange(total) + shift]
        at = end
