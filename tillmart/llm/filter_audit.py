"""What filters remove in every order: sorted posting lists of failing rows, merged by galloping.

For each part of a table the rows that fail a filter are a sorted list of ids. A table of such lists is
written once: one row for each part and id range, at most ``RANGE`` ids, with the list of every
filter and of every mark (sets of rows whose loss is counted). Ranges are cut from rows sorted by
part and id, so a part with most of the rows, or an id with many, is many ranges.

The audit then works on lists alone. Range by range it builds the union of each set of filters by a
k-way merge and takes it from each other filter's list; both gallop: from the place reached, the step
doubles until the sought id is passed, then the gap is halved. Sizes of unions and differences
are added up by part. From the sizes for every set and filter follow all orders of the filters.

An id in a list is a row's place in its range, so repeated and null doc_ids are rows of their own;
``ids`` keeps the doc_id of every place, and ``failing`` gives them back.

Defined results: a null part is the empty string. A condition that gives null is not failed. Rows that
repeat count as often as they stand. A part without rows does not appear, so an empty table gives
no rows. Other columns are dropped, whatever their names.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator, Mapping, Sequence
from itertools import permutations
from math import factorial

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillmart.llm.arrow import slices, utf8
from tillmart.llm.scratch import kept
from tillmart.operators.lookup import lookup

#: Rows of one id range: what a task holds as lists at once.
RANGE = 1 << 15

# -- sorted lists ------------------------------------------------------------------------


def gallop(ids: Sequence[int], sought: int, at: int) -> int:
    """First place from ``at`` on that holds ``sought`` or more."""
    step = 1
    while at + step < len(ids) and ids[at + step] < sought:
        at += step
        step *= 2
    return bisect_left(ids, sought, at, min(at + step + 1, len(ids)))


def union(lists: Sequence[Sequence[int]]) -> list[int]:
    """All ids of sorted lists, merged; whole runs of one list are copied at once."""
    heads = [[ids[0], n, 0] for n, ids in enumerate(lists) if len(ids)]
    out: list[int] = []
    while len(heads) > 1:
        heads.sort()
        (_, n, at), until = heads[0], heads[1][0]
        ids = lists[n]
        upto = gallop(ids, until, at)
        out.extend(ids[at:upto])
        if upto < len(ids) and ids[upto] == until:
            upto += 1  # the other list gives it
        if upto < len(ids):
            heads[0] = [ids[upto], n, upto]
        else:
            heads.pop(0)
    for _, n, at in heads:
        out.extend(lists[n][at:])
    return out


def difference(ids: Sequence[int], gone: Sequence[int]) -> list[int]:
    """Ids of one sorted list that are not in the other."""
    out: list[int] = []
    at = b = 0
    while at < len(ids):
        b = gallop(gone, ids[at], b) if b < len(gone) else b
        if b == len(gone):
            out.extend(ids[at:])
            break
        if gone[b] == ids[at]:
            at += 1
        else:
            upto = gallop(ids, gone[b], at)
            out.extend(ids[at:upto])
            at = upto
    return out


# -- posting lists -----------------------------------------------------------------------


def posting_lists(
    rows: DataFrame,
    part: Column,
    filters: Mapping[str, Column],
    marks: Mapping[str, Column],
    most: int = RANGE,
) -> DataFrame:
    """(part, ids, ``filters``, ``marks``): a row for each id range of each part of ``rows`` (doc_id, ...).

    ``ids`` are the doc_ids of the range in ascending order, nulls first; each list has the places in
    it of the rows that fail the filter or bear the mark. A range has at most ``most`` rows.
    """
    names = [*filters, *marks]
    flags = [F.coalesce(c, F.lit(False)) for c in (*filters.values(), *marks.values())]
    bits = [F.when(flag, 1 << n).otherwise(0) for n, flag in enumerate(flags)]
    narrow = rows.select(
        F.coalesce(part.cast("string"), F.lit("")).alias("part"),
        F.col("doc_id").cast("long").alias("id"),
        sum(bits[1:], bits[0]).alias("bits"),
        F.monotonically_increasing_id().alias("_row"),
    )
    # Ranges are drawn from a sample of the rows, which therefore must not change between reads.
    narrow = kept(narrow, "flags")
    order = ("part", "id", "_row")
    sorted_rows = narrow.repartitionByRange(*order).sortWithinPartitions(*order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, ids, lists = None, [], [[] for _ in names]

        def block() -> pa.RecordBatch:
            columns = [pa.array([part], pa.string()), pa.array([ids], pa.list_(pa.int64()))]
            columns += [pa.array([x], pa.list_(pa.int32())) for x in lists]
            return pa.RecordBatch.from_arrays(columns, ["part", "ids", *names])

        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("part", "id", "bits"))
            for p, i, b in zip(*columns, strict=True):
                if ids and (p != part or len(ids) == most):
                    yield block()
                    ids, lists = [], [[] for _ in names]
                part = p
                while b:
                    low = b & -b
                    lists[low.bit_length() - 1].append(len(ids))
                    b ^= low
                ids.append(i)
        if ids:
            yield block()

    schema = "part string, ids array<long>" + "".join(f", `{n}` array<int>" for n in names)
    return kept(sorted_rows.select("part", "id", "bits").mapInArrow(run, schema), "postings")


def failing(postings: DataFrame, name: str) -> DataFrame:
    """(part, doc_id) of the rows in one of the lists."""
    own = F.transform(F.col(f"`{name}`"), lambda place: F.element_at("ids", place + 1))
    return postings.select("part", F.explode(own).alias("doc_id"))


# -- audit -------------------------------------------------------------------------------


def sizes(postings: DataFrame, filters: Sequence[str], marks: Sequence[str]) -> DataFrame:
    """Per part, set of filters before (bits) and filter not in it: rows in the part, in the union with
    the filter, and in the filter's list but no list before; the latter also for each mark."""
    several = [[n for n in range(len(filters)) if s >> n & 1] for s in range(1 << len(filters))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                lists = [row[f] for f in filters]
                unions = [union([lists[n] for n in own]) for own in several]
                out = []
                for s, gone in enumerate(unions):
                    for n, ids in enumerate(lists):
                        if s >> n & 1:
                            continue
                        removed = difference(ids, gone)
                        lost = [len(removed) - len(difference(removed, row[m])) for m in marks]
                        out.append((row["part"], s, n, len(row["ids"]), len(unions[s | 1 << n]), len(removed), *lost))
                yield pa.RecordBatch.from_arrays(list(map(pa.array, zip(*out, strict=True))), names)

    lost = [f"{m}_lost" for m in marks]
    names = ["part", "before", "filter", "n_rows", "n_union", "removed", *lost]
    schema = "part string, " + ", ".join(f"{n} long" for n in names[1:])
    by_range = postings.mapInArrow(run, schema)
    return by_range.groupBy("part", "before", "filter").agg(*[F.sum(n).alias(n) for n in names[3:]])


def orders(filters: Sequence[str]) -> list[tuple[str, int, int, int]]:
    """(filter_order, step, before, filter) of every order and step."""
    out = []
    for order in permutations(range(len(filters))):
        before = 0
        for step, n in enumerate(order, 1):
            out.append(("".join(filters[i] for i in order), step, before, n))
            before |= 1 << n
    return out


def audit(postings: DataFrame, filters: Sequence[str], marks: Sequence[str]) -> DataFrame:
    """Per part, filter_order and step: kept, removed, redundant, unique_fails, ``<mark>_lost``, shapley.

    ``redundant`` fails the step's filter but went before; ``unique_fails`` fails no other filter;
    ``shapley`` sums what the filter removes over all orders.
    """
    n = len(filters)
    alone = F.bit_count("before") == n - 1
    # A set of s filters stands before a given one in s! * (n - 1 - s)! orders.
    ways = F.element_at(
        F.array(*[F.lit(factorial(s) * factorial(n - 1 - s)) for s in range(n)]),
        F.bit_count("before") + 1,
    )
    found = kept(sizes(postings, filters, marks), "sizes")
    of_filter = found.groupBy("part", "filter").agg(
        F.sum(F.when(alone, F.col("removed"))).alias("unique_fails"),
        F.sum(F.when(F.col("before") == 0, F.col("removed"))).alias("fails"),
        F.sum(F.col("removed") * ways).alias("shapley"),
    )
    # As many rows as filters have orders and steps: fixed by their number, not by the table.
    steps = postings.sparkSession.createDataFrame(
        orders(filters), "filter_order string, step int, before long, filter long"
    )
    return found.join(F.broadcast(steps), ["before", "filter"]).join(of_filter, ["part", "filter"]).select(
        "part",
        "filter_order",
        "step",
        (F.col("n_rows") - F.col("n_union")).alias("kept"),
        "removed",
        (F.col("fails") - F.col("removed")).alias("redundant"),
        "unique_fails",
        *[f"{m}_lost" for m in marks],
        "shapley",
    )


# -- the five filters of the query -------------------------------------------------------

#: Fewest words; fewest distinct words and most capitals, per cent; characters no text may hold.
WORDS, DISTINCT, CAPITALS, SYMBOLS = 200, 50, 3, b"#$%&*|"
FILTERS = ("A", "B", "C", "D", "E")
MARKS = ("good", "toxic")
_CAPITALS = bytes(range(ord("A"), ord("Z") + 1))


def fails(text: bytes) -> tuple[bool, bool, bool, bool]:
    """Whether a UTF-8 text fails A, B, C, D."""
    words = text.split()
    n_capitals = len(text) - len(text.translate(None, _CAPITALS))
    n_chars = len(text.decode("utf-8"))
    return (
        len(words) < WORDS,
        100 * len(set(words)) < DISTINCT * len(words),
        100 * n_capitals > CAPITALS * n_chars,
        len(text.translate(None, SYMBOLS)) < len(text),
    )


def checked(docs: DataFrame) -> DataFrame:
    """(doc_id, part, A, B, C, D, E) of every row of ``docs`` (doc_id, text, lang).

    E: a smaller doc_id has the same text (null is the empty text). Texts are told apart by 128-bit hashes.
    A null doc_id is not smaller than any and has none below it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = utf8(batch.column("text"))
            found = [fails(t) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("part"),
                    pa.array([xxhash.xxh3_128_hexdigest(t) for t in texts], pa.string()),
                    *(pa.array([f[n] for f in found], pa.bool_()) for n in range(4)),
                ],
                ["doc_id", "part", "same", "A", "B", "C", "D"],
            )

    given = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("part"), "text"
    )
    rows = kept(
        given.mapInArrow(
            run,
            "doc_id long, part string, same string, A boolean, B boolean, C boolean, D boolean",
        ),
        "checked",
    )
    ids = rows.groupBy("same").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"))
    copied = ids.where("lo < hi").drop("hi")
    return lookup(rows, copied, "same", spread_by="doc_id").withColumn("E", F.col("doc_id") > F.col("lo"))


def marked(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """``rows`` with ``good`` and ``toxic``; a doc_id with several labels has all of them."""
    own = labels.where("doc_id IS NOT NULL AND (quality = 1 OR toxic = 1)").groupBy(
        F.col("doc_id").cast("long").alias("doc_id")
    )
    own = own.agg(F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic"))
    by_id = own.withColumnRenamed("doc_id", "_id")
    return lookup(rows.withColumn("_id", F.col("doc_id")), by_id, "_id", spread_by="same")


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The audit of the filters A to E per language."""
    rows = marked(checked(docs), labels)
    postings = posting_lists(
        rows, F.col("part"), {f: F.col(f) for f in FILTERS}, {m: F.col(m) for m in MARKS}
    )
    return audit(postings, FILTERS, MARKS)


#: The report in DuckDB SQL, by counts of each combination of failed filters.
SQL = rf"""
WITH texts AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents),
split AS MATERIALIZED (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w FROM texts),
smallest AS (SELECT t, min(doc_id) AS lo FROM texts GROUP BY t),
label AS (SELECT doc_id, max(CAST(quality = 1 AS INT)) AS good, max(CAST(toxic = 1 AS INT)) AS toxic
  FROM labels GROUP BY doc_id),
flags AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
    CAST(len(w) < {WORDS} AS INT)
    + 2 * CAST(100 * len(list_distinct(w)) < {DISTINCT} * len(w) AS INT)
    + 4 * CAST(100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > {CAPITALS} * length(t) AS INT)
    + 8 * CAST(regexp_matches(t, '[#$%&*|]') AS INT)
    + 16 * coalesce(CAST(doc_id > lo AS INT), 0) AS bits
  FROM split JOIN smallest USING (t) LEFT JOIN label USING (doc_id)),
counts AS MATERIALIZED (
  SELECT part, bits, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM flags GROUP BY part, bits),
letter(f, b) AS (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)),
perm AS (
  SELECT a.f || b.f || c.f || d.f || e.f AS filter_order, [a.b, b.b, c.b, d.b, e.b] AS bs
  FROM letter a, letter b, letter c, letter d, letter e
  WHERE (a.b | b.b | c.b | d.b | e.b) = 31),
steps AS MATERIALIZED (
  SELECT filter_order, step, bs[step] AS own, CAST(coalesce(list_sum(bs[1:step - 1]), 0) AS BIGINT) AS before
  FROM perm, range(1, 6) s(step)),
each AS (
  SELECT part, filter_order, step, own,
    sum(CASE WHEN bits & (own | before) = 0 THEN n ELSE 0 END) AS kept,
    sum(CASE WHEN bits & own <> 0 AND bits & before = 0 THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN bits & own <> 0 AND bits & before <> 0 THEN n ELSE 0 END) AS redundant,
    sum(CASE WHEN bits = own THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN bits & own <> 0 AND bits & before = 0 THEN good ELSE 0 END) AS good_lost,
    sum(CASE WHEN bits & own <> 0 AND bits & before = 0 THEN toxic ELSE 0 END) AS toxic_lost
  FROM counts, steps GROUP BY part, filter_order, step, own)
SELECT part, filter_order, CAST(step AS INT) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
  CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
  CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley
FROM each
"""
