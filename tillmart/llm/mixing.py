"""Mixing sources to target weights by Poisson replication.

The copies of a row follow a Poisson distribution whose mean is the rate of its source,
``target weight * total / rows of the source``. The draw inverts the distribution at a number
hashed from the seed, the whole row and a number among equal rows, so it needs no state, gives the
same copies in every run and lets a rate be below or above one. Copies are then dealt over all
partitions by a hashed key and sorted by it, which is a random order of the whole.

Defined results: every row has a draw of its own, whether its doc_id is null, repeated or not, so
every source meets its weight however its rows are named. Null is a source of its own; sources
without a given weight are left out, and with no weights given the target is the number of rows to
the power ``exponent``. Null texts are kept. Other columns are carried along, whatever their names;
an input that has ``copy`` or ``shuffle_key`` itself gets them replaced. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillmart.sources.shared import stored

EXPONENT = 0.7
SEED = 10
#: Columns of the documents table, as the SQL hashes them.
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: Rates are broadcast only up to this many entries of all their tables together (8 bytes each).
MOST_ENTRIES = 1_000_000


def _digits(text: Column) -> Column:
    """52 random bits of a text."""
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("long")


def _row_text(columns: list[Column]) -> Column:
    """MD5 of a whole row; null and text are told apart in every column."""
    parts = [F.coalesce(F.md5(c.cast("string").cast("binary")), F.lit("null")) for c in columns]
    return F.md5(F.concat_ws(",", *parts))


def _numbered(rows: DataFrame, columns: list[str]) -> DataFrame:
    """``rows`` and ``_key``: a text for each row that no other row and no order of rows changes.

    Rows equal in ``columns`` are numbered from 0. The numbers are dealt by where the rows lie, so
    rows that are equal in very many places are no task of their own.
    """
    rows = rows.withColumn("_h", _row_text([F.col(c) for c in columns]))
    rows = rows.withColumn("_at", F.spark_partition_id())
    many = stored(rows.groupBy("_h").count().where("count > 1").select("_h"), "equal-rows")
    single = rows.join(many, "_h", "left_anti").drop("_at").withColumn("_n", F.lit(0).cast("long"))
    equal = rows.join(many, "_h", "left_semi")
    equal = stored(equal.withColumn("_row", F.monotonically_increasing_id()), "equal-rows")
    places = equal.groupBy("_h", "_at").agg(F.count("*").alias("_n"))
    upto = F.sum("_n").over(Window.partitionBy("_h").orderBy("_at"))
    places = places.select("_h", "_at", (upto - F.col("_n")).alias("_first"))
    number = F.row_number().over(Window.partitionBy("_h", "_at").orderBy("_row"))
    equal = equal.withColumn("_n", number - 1).join(places, ["_h", "_at"])
    equal = equal.withColumn("_n", F.col("_n") + F.col("_first")).select(*single.columns)
    key = F.concat_ws(":", "_h", F.col("_n").cast("string"))
    return single.unionByName(equal).withColumn("_key", key).drop("_h", "_n")


def rates(
    docs: DataFrame, weights: Mapping[str, float] | None, exponent: float, total: float | None
) -> DataFrame:
    """Per source: rate, and the cumulative probabilities of 0, 1, 2 ... copies.

    One row a source and number of copies is summed up by windows, so the work is linear in the rates.
    """
    sizes = docs.groupBy("source").agg(F.count("*").cast("double").alias("n"))
    if weights is None:
        weight = F.pow("n", F.lit(float(exponent)))
    else:
        given = [F.when(F.col("source") == s, F.lit(float(w))) for s, w in weights.items()]
        weight = F.coalesce(*given, F.lit(0.0))
    sizes = stored(sizes.withColumn("weight", weight), "sizes")
    n, w = sizes.agg(F.sum("n"), F.sum("weight")).first()
    if not n or not w:
        return sizes.where("false").selectExpr("source", "weight AS rate", "array(weight) AS below")
    target = float(n if total is None else total)
    rate = F.col("weight") / F.lit(w) * F.lit(target) / F.col("n")
    most = F.ceil(F.col("rate") + 12 * F.sqrt("rate") + 30).cast("int")
    upto = Window.partitionBy("source").orderBy("k").rowsBetween(Window.unboundedPreceding, 0)
    factorial = F.sum(F.log(F.greatest("k", F.lit(1)).cast("double"))).over(upto)
    terms = (
        sizes.where("weight > 0")
        .select("source", rate.alias("rate"))
        .select("source", "rate", F.explode(F.sequence(F.lit(0), most)).alias("k"))
        .withColumn("p", F.exp(F.col("k") * F.log("rate") - F.col("rate") - factorial))
        .withColumn("below", F.sum("p").over(upto))
    )
    # The sums never fall, so sorting them keeps the order of k.
    tables = terms.groupBy("source").agg(
        F.first("rate").alias("rate"), F.sort_array(F.collect_list("below")).alias("below")
    )
    return stored(tables, "rates")


def mixed(
    docs: DataFrame,
    weights: Mapping[str, float] | None = None,
    exponent: float = EXPONENT,
    total: float | None = None,
    seed: int = SEED,
) -> DataFrame:
    """All columns of ``docs`` (source, ...) with ``copy`` (from 1) and ``shuffle_key``."""
    table = rates(docs.select("source"), weights, exponent, total).select(
        F.col("source").alias("_source"), F.col("below").alias("_below")
    )
    entries = table.agg(F.sum(F.size("_below"))).first()[0] or 0
    if entries <= MOST_ENTRIES:
        table = F.broadcast(table)
    docs = docs.drop("copy", "shuffle_key")
    # Inside, the columns have names that clash with nothing.
    names = [f"_c{i}" for i in range(len(docs.columns))]
    source = names[[c.lower() for c in docs.columns].index("source")]
    rows = _numbered(docs.toDF(*names), names)
    u = _digits(F.concat_ws(":", F.lit(str(seed)), "_key")) / F.lit(float(1 << 52))
    rows = rows.join(table, F.col(source).eqNullSafe(F.col("_source"))).withColumn("_u", u)
    copies = F.size(F.filter("_below", lambda p: p <= F.col("_u")))
    rows = rows.withColumn("_copies", copies).where("_copies > 0")
    rows = rows.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies"))))
    key = _digits(F.concat_ws(":", F.lit(f"{seed}s"), "_key", F.col("_copy").cast("string")))
    out = rows.select(*names, "_copy", key.alias("_shuffle"))
    out = out.repartition("_shuffle").sortWithinPartitions("_shuffle")
    return out.toDF(*docs.columns, "copy", "shuffle_key")


def sql(columns: Sequence[str] = COLUMNS, table: str = "documents") -> str:
    """``mixed`` with its defaults over a table of ``columns``, in DuckDB's SQL."""
    bits = "CAST('0x' || substr(md5({}), 1, 13) AS BIGINT)"
    draw = bits.format(f"concat_ws(':', '{SEED}', row_key)")
    key = bits.format(f"concat_ws(':', '{SEED}s', row_key, CAST(copy AS VARCHAR))")
    parts = ", ".join(f"coalesce(md5(CAST({c} AS VARCHAR)), 'null')" for c in columns)
    return f"""
WITH sizes AS (SELECT source, CAST(count(*) AS DOUBLE) AS n FROM {table} GROUP BY source),
sums AS (SELECT sum(n) AS total, sum(pow(n, {EXPONENT})) AS weights FROM sizes),
rated AS (SELECT source, pow(n, {EXPONENT}) / weights * total / n AS rate FROM sizes, sums),
terms AS (
    SELECT source, k, exp(k * ln(rate) - rate - lgamma(k + 1.0)) AS p FROM (
        SELECT source, rate, unnest(range(0, CAST(ceil(rate + 12 * sqrt(rate) + 30) AS BIGINT) + 1)) AS k
        FROM rated)
),
below AS (SELECT source, sum(p) OVER (PARTITION BY source ORDER BY k) AS p FROM terms),
tables AS (SELECT source, list(p) AS below FROM below GROUP BY source),
hashed AS (SELECT *, md5(concat_ws(',', {parts})) AS h FROM {table}),
numbered AS (
    SELECT *, concat_ws(':', h, CAST(row_number() OVER (PARTITION BY h) - 1 AS VARCHAR)) AS row_key FROM hashed
),
drawn AS (
    SELECT d.*, len(list_filter(below, lambda p: p <= {draw} / 4503599627370496.0)) AS copies
    FROM numbered d JOIN tables t ON d.source IS NOT DISTINCT FROM t.source
),
copied AS (SELECT * EXCLUDE (copies), CAST(unnest(range(1, copies + 1)) AS INTEGER) AS copy FROM drawn)
SELECT * EXCLUDE (h, row_key), {key} AS shuffle_key FROM copied
"""
