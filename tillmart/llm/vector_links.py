"""Embedding near-duplicates by Euclidean p-stable hashing.

A normalised vector is projected on Gaussian directions and each projection is cut into steps of
``WIDTH``; a table's key is made of ``depth`` such numbers. At cosine 0.95 two unit vectors are 0.316
apart and agree in one number with probability 0.874, at a right angle with 0.486. ``depth`` grows
with the logarithm of the number of vectors and the number of tables follows from it, so that a
pair at the threshold is missed with probability ``MISS`` at most, a closer one far more rarely.
Vectors that meet in a table are then compared exactly, in double precision. A pair that meets in
several tables counts in the first only, so links are counted, not written. Large buckets are
compared in a grid of cells. Identical vectors are one class from the start.

Defined results: null or zero vectors, and those with null or non-finite components, have no links
and stay as they are; so do vectors of another length than their neighbours. Null vec_ids count as
vectors but not as component ids; ``kept`` is vec_id = component_id with nulls equal. Repeated rows
are vectors of their own. Other columns, the label too, are dropped. An empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillmart.llm.cells import forest, gridded, whole_cells
from tillmart.llm.components import components
from tillmart.sources.shared import stored

THRESHOLD = 0.95
WIDTH = 2.0
MISS = 1e-7
#: Unlike vectors that may meet a vector in a table on average; sets the depth of the keys.
CHANCE = 256
LEAST_DEPTH = 8
SEED = 6
#: Vectors compared in one cell.
CELL = 1024


def agreement(distance: float, width: float = WIDTH) -> float:
    """Probability that two points at this distance agree in one quantised projection."""
    r = width / distance
    below = 0.5 * (1 + math.erf(-r / math.sqrt(2)))
    return 1 - 2 * below - 2 / (math.sqrt(2 * math.pi) * r) * (1 - math.exp(-r * r / 2))


def shape(n: int, threshold: float = THRESHOLD) -> tuple[int, int]:
    """Projections per key, and tables, for ``n`` vectors."""
    far, near = agreement(math.sqrt(2)), agreement(math.sqrt(2 - 2 * threshold))
    depth = max(LEAST_DEPTH, math.ceil(math.log(max(n, CHANCE) / CHANCE) / -math.log(far)))
    return depth, math.ceil(math.log(MISS) / math.log1p(-(near**depth)))


def keys(unit: np.ndarray, depth: int, tables: int) -> np.ndarray:
    """Bucket keys (int32), one column per table. Depends on the seed and the length only."""
    rng = np.random.default_rng([SEED, unit.shape[1], depth])
    lines = rng.standard_normal((unit.shape[1], depth * tables))
    shift = rng.uniform(0, WIDTH, depth * tables)
    mix = rng.integers(1, 1 << 62, depth, dtype=np.int64) | 1
    steps = np.floor((unit @ lines + shift) / WIDTH).astype(np.int64).reshape(-1, tables, depth)
    return ((steps * mix).sum(2) >> 17).astype(np.int32)


def _valid(column: str) -> Column:
    v = F.col(column)
    ok = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(ok & F.exists(v, lambda x: x != 0), F.lit(False))


def _matrix(column: pa.ChunkedArray | pa.Array, width: int) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _dealt(classes: DataFrame, depth: int, tables: int) -> DataFrame:
    """A row for each class and table: t, key, size, the vector, and its keys in earlier tables."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column("size").to_numpy()
            for size in np.unique(sizes).tolist():
                part = batch.filter(pa.array(sizes == size))
                for at in range(0, part.num_rows, 1000):
                    yield from deal(part.slice(at, 1000), size)

    def deal(batch: pa.RecordBatch, size: int) -> Iterator[pa.RecordBatch]:
        n = batch.num_rows
        raw = _matrix(batch.column("v"), size).astype(np.float64)
        raw = raw / np.abs(raw).max(1, keepdims=True)  # lest squares leave the range of doubles
        found = keys(raw / np.linalg.norm(raw, axis=1, keepdims=True), depth, tables)
        for t in range(tables):
            earlier = pa.ListArray.from_arrays(
                pa.array(np.arange(n + 1, dtype=np.int32) * t), pa.array(found[:, :t].ravel())
            )
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(n, t, np.int32)),
                    pa.array(found[:, t].copy()),
                    *(batch.column(c) for c in ("size", "node", "copies", "v")),
                    earlier,
                ],
                ["t", "key", "size", "node", "copies", "v", "earlier"],
            )

    kind = classes.schema["v"].dataType.simpleString()
    return classes.mapInArrow(
        run,
        f"t int, key int, size int, node long, copies long, v {kind}, earlier array<int>",
    ).withColumn("home", F.lit(True))


def _links(dealt: DataFrame, threshold: float) -> DataFrame:
    """(node, links, root): partial counts of linked vectors; root is null for a bare count."""
    by = ("t", "key", "size", "cell_h", "cell_v")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, bounds in whole_cells(batches, by):
            node, copies = (table.column(c).to_numpy() for c in ("node", "copies"))
            home, visitor = (table.column(c).to_numpy() for c in ("is_home", "is_visitor"))
            left, right = [], []
            for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
                if b - a < 2:
                    continue
                part = table.slice(a, b - a)
                t, size = part.column("t")[0].as_py(), part.column("size")[0].as_py()
                v = _matrix(part.column("v"), size).astype(np.float64)
                v /= np.abs(v).max(1, keepdims=True)
                v /= np.linalg.norm(v, axis=1, keepdims=True)
                x, y = np.flatnonzero(home[a:b]), np.flatnonzero(visitor[a:b])
                near = v[x] @ v[y].T >= threshold
                near &= node[a:b][x][:, None] < node[a:b][y][None, :]
                i, j = np.nonzero(near)
                if not len(i):
                    continue
                i, j = x[i], y[j]
                if t:
                    met = _matrix(part.column("earlier"), t)
                    new = ~(met[i] == met[j]).any(1)
                    i, j = i[new], j[new]
                left.append(i + a)
                right.append(j + a)
                if sum(map(len, left)) > 1 << 20:
                    yield from counted(node, copies, left, right)
                    left, right = [], []
            if left:
                yield from counted(node, copies, left, right)

    def counted(node, copies, left, right) -> Iterator[pa.RecordBatch]:
        i, j = np.concatenate(left), np.concatenate(right)
        if not len(i):
            return
        links = np.zeros(len(node), np.int64)
        np.add.at(links, i, copies[j])
        np.add.at(links, j, copies[i])
        some = np.flatnonzero(links)
        member, root = forest(node[i], node[j])
        for rows in (
            [node[some], links[some], pa.nulls(len(some), pa.int64())],
            [member, np.zeros(len(member), np.int64), root],
        ):
            yield pa.RecordBatch.from_arrays(list(map(pa.array, rows)), ["node", "links", "root"])

    rows = gridded(dealt, ["t", "key", "size"], "node", CELL)
    return rows.mapInArrow(run, "node long, links long, root long")


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Per row of ``vectors`` (vec_id, embedding): vec_id, n_links, component_id, kept."""
    rows = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").alias("v")
    )
    valid = rows.where(_valid("v"))
    grouped = valid.groupBy("v").agg(F.min("vec_id").alias("first"), F.count("*").alias("copies"))
    # Numbered as they are written, so that a class has one number from then on.
    classes = stored(grouped.withColumn("node", F.monotonically_increasing_id()), "vectors")
    small = classes.withColumn("size", F.size("v")).select("size", "node", "copies", "v")
    found = stored(_links(_dealt(small, *shape(classes.count(), threshold)), threshold), "links")
    counts = found.groupBy("node").agg(F.sum("links").alias("links"))
    roots = components(
        found.where("root IS NOT NULL").select(F.col("node").alias("a"), F.col("root").alias("b"))
    )
    labelled = (
        classes.select("v", "node", "first", "copies")
        .join(counts, "node", "left")
        .join(roots, "node", "left")
        .withColumn("root", F.coalesce("root", "node"))
    )
    ids = labelled.groupBy("root").agg(F.min("first").alias("component_id"))
    by_class = labelled.join(ids, "root").select(
        F.col("v").alias("_v"),
        (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
        "component_id",
    )
    lone = rows.where(~_valid("v")).select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    joined = valid.join(by_class, F.col("v") == F.col("_v")).select(
        "vec_id", "n_links", "component_id"
    )
    return joined.unionByName(lone).withColumn("kept", F.expr("vec_id <=> component_id"))
