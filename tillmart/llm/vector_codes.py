"""Vectors as short codes: a codebook for each part, fitted exactly with adaptive distance bounds.

Components become integers, so every distance, sum and tie is exact. Each of ``ROUNDS`` rounds
assigns every part to the nearest entry of its codebook and moves the entries to the floored means;
a last assignment gives the codes.

Only the first assignment looks at all entries. It leaves with every part the ids of its ``b``
closest entries, a lower bound on the distance to each, and one outer bound for all others. When
entries move, the bounds shrink by the way moved. Then, part by part:

* The exact distance to the assigned entry is below all bounds: nothing can have changed.
* It is below the bounds from some place on: the entries before that place are compared, in
  integers, ties going to the lower index.
* It is not below the outer bound either: all entries are compared and the part gets new neighbours.

Bounds are rounded down, so a tie or a near tie is always verified. ``b`` is adapted after each round:
it falls to what nearly all parts needed of it, and stays while many need all entries.

The rows with their bounds are written to the shared folder once a round and the older ones removed.
Workers add up their parts' sums before the shuffle; the driver holds codebooks, sums and counts of
the bounds needed, which do not grow with the table.

Defined results: rows whose vector is null or holds null or non-finite components are left out.
Vectors must have one length that can be cut into ``PARTS`` parts, and components below ``LARGEST`` in
size, beyond which a sum of squares would not fit a long; anything else is an error that says so. Of
equal vec_ids the smaller vector comes first in the first codebooks; null vec_ids come last. With
fewer rows than ``ENTRIES`` the codebooks have an entry for each. Repeated rows count as often as they
stand. An empty table gives no rows. Other columns are dropped, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from contextlib import ExitStack
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillmart.sources.shared import scratch, stored

PARTS = 4
ENTRIES = 256
ROUNDS = 4
SCALE = 1024
#: Components at or beyond this size are refused.
LARGEST = float(1 << 17)
#: Neighbours with a bound of their own at the start, and the share of parts they should suffice for.
NEAREST = 16
SUFFICES = 0.99
#: Rows that are compared with a whole codebook at once.
CHUNK = 4096

_ROW = "vec_id long, label string, ints array<int>"
_STATE = f"{_ROW}, code array<short>, near array<short>, low array<float>, outer array<float>"


@dataclass(frozen=True)
class Fitted:
    """Codes of all rows, and the codebooks (part, entry, component) they stand for."""

    rows: DataFrame
    codebooks: np.ndarray
    #: Parts in each assignment that were certain, compared with some entries, compared with all.
    work: list[tuple[int, int, int]]


def integers(vectors: DataFrame) -> DataFrame:
    """(vec_id, label, ints) of the rows that can be coded."""
    finite = F.forall(
        "embedding",
        lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))),
    )
    whole = F.transform("embedding", lambda x: F.floor(x.cast("double") * SCALE))
    small = F.forall("embedding", lambda x: F.abs(x) < LARGEST)
    refused = F.raise_error(F.lit(f"a component is not below {LARGEST:.0f} in size"))
    return vectors.where(F.col("embedding").isNotNull() & finite).select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("label").cast("string").alias("label"),
        F.when(small, whole.cast("array<int>")).otherwise(refused).alias("ints"),
    )


def distances(parts: np.ndarray, book: np.ndarray) -> np.ndarray:
    """Exact squared distances of every part (rows) to every entry (columns).

    Products of whole numbers are exact in double precision while the sums stay below 2 ** 53.
    """
    most = max(int(np.abs(parts).max(initial=0)), int(np.abs(book).max(initial=0)))
    kind = np.float64 if 4 * most * most * book.shape[1] < 1 << 53 else np.int64
    a, b = parts.astype(kind), book.astype(kind)
    return ((a * a).sum(1)[:, None] - 2 * (a @ b.T) + (b * b).sum(1)).astype(np.int64)


def _to(parts: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances of every part to its own entries; shapes (n, d) and (n, m, d)."""
    gap = parts[:, None, :].astype(np.int64) - entries
    return np.einsum("nmd,nmd->nm", gap, gap)


def _below(squared: np.ndarray) -> np.ndarray:
    """Distances, rounded down to single precision."""
    root = np.sqrt(squared.astype(np.float64)) * (1 - 1e-12)
    single = root.astype(np.float32)
    return np.where(single > root, np.nextafter(single, np.float32(-np.inf)), single)


def _less(bound: np.ndarray, way: np.ndarray) -> np.ndarray:
    """``bound - way``, rounded down; ``way`` is rounded up already."""
    exact = bound.astype(np.float64) - way
    single = exact.astype(np.float32)
    return np.where(single > exact, np.nextafter(single, np.float32(-np.inf)), single)


class Bounds:
    """What is kept of n parts: closest entries (the first is the assigned one), bounds, outer bound."""

    def __init__(self, near: np.ndarray, low: np.ndarray, outer: np.ndarray):
        self.near, self.low, self.outer = near, low, outer

    @staticmethod
    def fresh(parts: np.ndarray, book: np.ndarray, b: int) -> Bounds:
        """Compare every part with all entries."""
        n = len(parts)
        b = min(b, len(book))
        near, low = np.empty((n, b), np.int16), np.empty((n, b), np.float32)
        outer = np.full(n, np.inf, np.float32)
        for at in range(0, n, CHUNK):
            here = slice(at, at + CHUNK)
            squared = distances(parts[here], book)
            order = np.argsort(squared, axis=1, kind="stable")  # ties: the lower index first
            near[here] = order[:, :b]
            ordered = np.take_along_axis(squared, order[:, : b + 1], 1)
            low[here] = _below(ordered[:, :b])
            if b < len(book):
                outer[here] = _below(ordered[:, b])
        return Bounds(near, low, outer)

    def moved(self, ways: np.ndarray) -> None:
        """Entries have moved by ``ways``: shrink the bounds, the outer one by the longest way outside."""
        self.low = _less(self.low, ways[self.near])
        longest = np.argsort(-ways)[: self.near.shape[1] + 1]
        inside = (self.near[:, None, :] == longest[:, None]).any(2)
        self.outer = _less(self.outer, ways[longest[inside.argmin(1)]])

    def cut(self, b: int) -> None:
        """Keep ``b`` neighbours; the bounds of the others go into the outer bound."""
        if b < self.near.shape[1]:
            self.outer = np.minimum(self.outer, self.low[:, b:].min(1))
            self.near, self.low = self.near[:, :b], self.low[:, :b]

    def settle(self, parts: np.ndarray, book: np.ndarray) -> np.ndarray:
        """Assign every part again; returns how many neighbours were needed, b + 1 meaning all entries."""
        n, b = self.near.shape
        now = _to(parts, book[self.near[:, :1]])[:, 0]
        distance = np.nextafter(np.sqrt(now.astype(np.float64)), np.inf)
        # The smallest bound of all neighbours from a place on, the outer one included.
        bounds = np.concatenate([self.low[:, 1:], self.outer[:, None]], 1)
        bounds = np.minimum.accumulate(bounds[:, ::-1], axis=1)[:, ::-1]
        safe = distance[:, None] < bounds
        needed = np.where(safe.any(1), safe.argmax(1) + 1, b + 1)
        for m in np.unique(needed).tolist():
            rows = np.flatnonzero(needed == m)
            if m == 1:
                self.low[rows, 0] = _below(now[rows])
            elif m <= b:
                for at in range(0, len(rows), CHUNK):
                    self._compare(rows[at : at + CHUNK], m, parts, book)
            else:
                again = Bounds.fresh(parts[rows], book, b)
                self.near[rows], self.low[rows], self.outer[rows] = again.near, again.low, again.outer
        return needed

    def _compare(self, rows: np.ndarray, m: int, parts: np.ndarray, book: np.ndarray) -> None:
        """Put the first ``m`` neighbours of ``rows`` in order by exact distance, then index."""
        near = self.near[rows, :m]
        squared = _to(parts[rows], book[near])
        order = np.lexsort((near, squared), axis=1)
        self.near[rows, :m] = np.take_along_axis(near, order, 1)
        self.low[rows, :m] = _below(np.take_along_axis(squared, order, 1))


def _matrix(column: pa.Array, kind: type, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(len(column), width)


def _lists(values: np.ndarray, kind: pa.DataType) -> pa.Array:
    n, width = values.shape
    offsets = pa.array(np.arange(n + 1, dtype=np.int32) * width)
    return pa.ListArray.from_arrays(offsets, pa.array(np.ascontiguousarray(values).ravel(), kind))


def _assigned(
    rows: DataFrame, books: np.ndarray, before: np.ndarray | None, have: int, b: int
) -> DataFrame:
    """``rows`` with codes and bounds for ``books``; their bounds, ``have`` wide, hold for ``before``.

    ``needed`` is, for each part, how many neighbours the decision took.
    """
    parts, size = len(books), books.shape[2]
    ways = None
    if before is not None:
        squared = ((books - before) ** 2).sum(2).astype(np.float64)
        ways = np.nextafter(np.sqrt(squared) * (1 + 1e-12), np.inf)
        ways[squared == 0] = 0.0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            ints = _matrix(batch.column("ints"), np.int64, parts * size).reshape(n, parts, size)
            if ways is not None:
                near = _matrix(batch.column("near"), np.int16, parts * have).reshape(n, parts, have)
                low = _matrix(batch.column("low"), np.float32, parts * have).reshape(n, parts, have)
                outer = _matrix(batch.column("outer"), np.float32, parts)
            out: list[Bounds] = []
            needed = np.full((n, parts), len(books[0]) + 1, np.int16)
            for p in range(parts):
                own = np.ascontiguousarray(ints[:, p])
                if ways is None:
                    out.append(Bounds.fresh(own, books[p], b))
                    continue
                bounds = Bounds(near[:, p].copy(), low[:, p].copy(), outer[:, p].copy())
                bounds.moved(ways[p])
                bounds.cut(b)
                needed[:, p] = bounds.settle(own, books[p])
                out.append(bounds)
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c) for c in ("vec_id", "label", "ints")),
                    _lists(np.stack([x.near[:, 0] for x in out], 1), pa.int16()),
                    _lists(np.concatenate([x.near for x in out], 1), pa.int16()),
                    _lists(np.concatenate([x.low for x in out], 1), pa.float32()),
                    _lists(np.stack([x.outer for x in out], 1), pa.float32()),
                    _lists(needed, pa.int16()),
                ],
                ["vec_id", "label", "ints", "code", "near", "low", "outer", "needed"],
            )

    return rows.mapInArrow(run, f"{_STATE}, needed array<short>")


def _sums(state: DataFrame, parts: int, size: int) -> DataFrame:
    """(part, entry, n, sums): rows and componentwise sums of each entry, added up by task first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros((parts, ENTRIES), np.int64)
        sums = np.zeros((parts, ENTRIES, size), np.int64)
        for batch in batches:
            ints = _matrix(batch.column("ints"), np.int64, parts * size)
            ints = ints.reshape(batch.num_rows, parts, size)
            code = _matrix(batch.column("code"), np.int64, parts)
            for p in range(parts):
                np.add.at(n[p], code[:, p], 1)
                np.add.at(sums[p], code[:, p], ints[:, p])
        part, entry = np.nonzero(n)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(part),
                pa.array(entry),
                pa.array(n[part, entry]),
                _lists(sums[part, entry], pa.int64()),
            ],
            ["part", "entry", "n", "sums"],
        )

    schema = "part long, entry long, n long, sums array<long>"
    # Sums of longs as decimals: they may not fit a long at the size of a whole table.
    each = [F.sum(F.col("sums")[i].cast("decimal(38,0)")).alias(f"s{i}") for i in range(size)]
    by_task = state.select("ints", "code").mapInArrow(run, schema)
    return by_task.groupBy("part", "entry").agg(F.sum("n").alias("n"), *each)


def _moved(books: np.ndarray, sums: DataFrame) -> np.ndarray:
    """Entries at the floored means of their parts; unused ones stay."""
    new = books.copy()
    for row in sums.collect():  # at most one row for each entry
        total = [int(row[f"s{i}"]) for i in range(books.shape[2])]
        new[row.part, row.entry] = [s // row.n for s in total]
    return new


def _needs(state: DataFrame, b: int) -> list[int]:
    """How often each number of neighbours was needed (index b + 1: all entries)."""
    counts = [0] * (b + 2)
    by = state.select(F.explode("needed").alias("m")).groupBy(F.least("m", F.lit(b + 1)).alias("m"))
    for row in by.count().collect():  # at most b + 2 rows
        counts[row.m] += row["count"]
    return counts


def _enough(counts: list[int], b: int) -> int:
    """The fewest neighbours that would have settled ``SUFFICES`` of all parts, ``b`` if none do."""
    held = 0
    for m in range(1, b + 1):
        held += counts[m]
        if held >= SUFFICES * sum(counts):
            return max(2, m)
    return b


def fit(vectors: DataFrame) -> Fitted | None:
    """Codebooks and codes of ``vectors`` (vec_id, embedding, label); None if no row can be coded."""
    spark = vectors.sparkSession
    rows = stored(integers(vectors), "integers")
    shape = rows.agg(F.min(F.size("ints")).alias("lo"), F.max(F.size("ints")).alias("hi")).first()
    if shape.hi is None:
        return None
    if shape.lo != shape.hi or shape.hi % PARTS or not shape.hi:
        raise ValueError(f"vectors of {shape.lo} to {shape.hi} components cannot be cut into {PARTS} parts")
    size = shape.hi // PARTS
    first = rows.select("vec_id", "ints").orderBy(F.col("vec_id").asc_nulls_last(), "ints").limit(ENTRIES)
    books = np.array([r.ints for r in first.collect()], np.int64)
    books = books.reshape(len(books), PARTS, size).transpose(1, 0, 2)

    work: list[tuple[int, int, int]] = []
    b = have = min(NEAREST, books.shape[1])
    state, before, held = rows, None, ExitStack()
    try:
        for _ in range(ROUNDS):
            now = ExitStack()
            given = _assigned(state, books, before, have, b)
            state, have = now.enter_context(scratch(given, "bounds")), b
            held.close()
            held = now
            counts = _needs(state, b)
            work.append(_kinds(counts, before is None))
            if before is not None:
                b = _enough(counts, b)
            before, books = books, _moved(books, _sums(state, PARTS, size))
        given = _assigned(state, books, before, have, b)
        codes = stored(given.select("vec_id", "label", "ints", "code", "needed"), "codes")
    finally:
        held.close()
    work.append(_kinds(_needs(codes, b), before is None))
    return Fitted(_with_errors(codes, books), books, work)


def _kinds(counts: list[int], first: bool) -> tuple[int, int, int]:
    if first:
        return 0, 0, sum(counts)
    return counts[1], sum(counts[2:-1]), counts[-1]


def _with_errors(codes: DataFrame, books: np.ndarray) -> DataFrame:
    """(vec_id, label, code, error): code in hex, squared distance to what it stands for."""
    parts, size = len(books), books.shape[2]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            ints = _matrix(batch.column("ints"), np.int64, parts * size).reshape(n, parts, size)
            code = _matrix(batch.column("code"), np.int64, parts)
            gap = ints - books[np.arange(parts), code]
            hexed = [bytes(row).hex() for row in code.astype(np.uint8)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("vec_id"),
                    batch.column("label"),
                    pa.array(hexed, pa.string()),
                    pa.array((gap * gap).sum((1, 2))),
                ],
                ["vec_id", "label", "code", "error"],
            )

    return codes.select("vec_id", "label", "ints", "code").mapInArrow(
        run, "vec_id long, label string, code string, error long"
    )


def digest(books: np.ndarray) -> str:
    """SHA-256 of all components by part, entry and place, in decimal with commas between."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def decoded(codes: DataFrame, books: np.ndarray) -> DataFrame:
    """``codes`` (vec_id, code) with ``embedding``: the entries the codes stand for, scaled back."""
    flat = (books / SCALE).astype(np.float32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            code = np.array([list(bytes.fromhex(c)) for c in batch.column("code").to_pylist()], np.int64)
            code = code.reshape(batch.num_rows, len(flat))
            own = flat[np.arange(len(flat)), code].reshape(batch.num_rows, -1)
            arrays = [batch.column("vec_id"), batch.column("code"), _lists(own, pa.float32())]
            yield pa.RecordBatch.from_arrays(arrays, ["vec_id", "code", "embedding"])

    return codes.select("vec_id", "code").mapInArrow(
        run, "vec_id long, code string, embedding array<float>"
    )


def report(vectors: DataFrame) -> DataFrame:
    """Per coded row: vec_id, code, error, label_error (equal labels together), codebooks_sha256."""
    fitted = fit(vectors)
    if fitted is None:
        return _nothing(vectors.sparkSession)
    rows = fitted.rows.withColumn("_l", F.coalesce(F.concat(F.lit("="), "label"), F.lit("none")))
    by_label = rows.groupBy("_l").agg(F.sum("error").alias("label_error"))
    # On an expression of the key both sides move, so that a very common label can be split.
    turned = F.concat(F.lit("="), F.col("_l"))
    joined = rows.withColumn("_t", turned).join(
        by_label.select(turned.alias("_t"), "label_error"), "_t"
    )
    return joined.select(
        "vec_id", "code", "error", "label_error", F.lit(digest(fitted.codebooks)).alias("codebooks_sha256")
    )


def _nothing(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        [], "vec_id long, code string, error long, label_error long, codebooks_sha256 string"
    )


def _sql() -> str:
    """The report in DuckDB SQL, every part compared with every entry in every round."""
    steps = []
    for n in range(ROUNDS + 1):
        steps.append(f"""
near{n} AS MATERIALIZED (
  SELECT r, p, min(q * {ENTRIES} + e) AS best FROM (
    SELECT r, x.p, e, sum((x.c - b.c) * (x.c - b.c)) AS q FROM x JOIN book{n} b ON x.p = b.p AND x.d = b.d
    GROUP BY r, x.p, e) GROUP BY r, p)""")
        if n < ROUNDS:
            steps.append(f"""
mean{n} AS (
  SELECT x.p, best % {ENTRIES} AS e, d, CAST(floor(CAST(sum(c) AS DOUBLE) / count(*)) AS BIGINT) AS c
  FROM x JOIN near{n} n ON x.r = n.r AND x.p = n.p GROUP BY x.p, best % {ENTRIES}, d),
book{n + 1} AS MATERIALIZED (
  SELECT b.p, b.e, b.d, coalesce(m.c, b.c) AS c
  FROM book{n} b LEFT JOIN mean{n} m ON b.p = m.p AND b.e = m.e AND b.d = m.d)""")
    return f"""
WITH good AS (
  SELECT vec_id, label,
    list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
rows AS MATERIALIZED (SELECT row_number() OVER (ORDER BY vec_id, v) - 1 AS r, * FROM good),
x AS MATERIALIZED (
  SELECT r, (i - 1) // (n // {PARTS}) AS p, (i - 1) % (n // {PARTS}) AS d, c
  FROM (SELECT r, len(v) AS n, unnest(range(1, len(v) + 1)) AS i, unnest(v) AS c FROM rows)),
book0 AS MATERIALIZED (SELECT p, r AS e, d, c FROM x WHERE r < {ENTRIES}),{",".join(steps)},
books AS (SELECT sha256(string_agg(CAST(c AS VARCHAR), ',' ORDER BY p, e, d)) AS codebooks_sha256 FROM book{ROUNDS}),
codes AS MATERIALIZED (
  SELECT r, string_agg(printf('%02x', best % {ENTRIES}), '' ORDER BY p) AS code,
    CAST(sum(best // {ENTRIES}) AS BIGINT) AS error FROM near{ROUNDS} GROUP BY r)
SELECT vec_id, code, error,
  CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM rows JOIN codes USING (r), books
"""


SQL = _sql()
