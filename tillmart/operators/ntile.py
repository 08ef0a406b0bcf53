"""NTILE over a whole table without moving it to one task."""

from __future__ import annotations

from collections.abc import Mapping
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from tillmart.schemas import MONEY
from tillmart.sources.shared import scratch

# monotonically_increasing_id() keeps the partition number above 33 bits of row number.
_ROW_BITS = 33


def tile_starts(rows: int, tiles: int) -> list[int]:
    """First 1-based rank of tile 2, 3, ... (the first ``rows % tiles`` tiles have one more)."""
    size, extra = divmod(rows, tiles)
    starts = [1 + t * size + min(t, extra) for t in range(1, tiles)]
    return [s for s in starts if s <= rows]


def add_ntiles(
    rows: DataFrame,
    measures: Mapping[str, str],
    tie: str,
    tiles: int = 5,
    value_type: str = MONEY,
) -> DataFrame:
    """Add one ``ntile(tiles)`` column per measure (output name to measure column, ascending).

    ``tie`` is a unique column that orders equal measures, ``value_type`` a type that holds
    every measure exactly. ``rows`` is read several times and should be a stored table.

    All measures are sorted together: a range-partitioned sort of (measure, value, tie)
    triples is written out once, and the size of each sorted partition tells which row
    stands at the first rank of each tile. These few rows are the cut points; giving every
    row its tiles is then a comparison with literals, without a shuffle or a join. Equal
    values are split between partitions by ``tie``, so a very common value is no hot spot.
    """
    columns = list(measures.values())
    values = F.array(*[F.col(c).cast(value_type) for c in columns])
    ordered = (
        rows.select(F.col(tie).alias("tie"), F.posexplode(values).alias("measure", "value"))
        .orderBy("measure", "value", "tie")
        .withColumn("position", F.monotonically_increasing_id())
    )
    with scratch(ordered, "ranks") as ranked:
        cuts = _cut_rows(ranked, len(columns), tiles)

    def tile(m: int) -> Column:
        value, value_of = F.col(columns[m]), rows.schema[columns[m]].dataType
        number = F.lit(1)
        # The last cut is asked first: most rows are settled after one or two comparisons.
        for no, cut in enumerate((c for c in cuts if c["measure"] == m), start=2):
            at = F.lit(cut["value"]).cast(value_of)
            past = (value > at) | ((value == at) & (F.col(tie) >= cut["tie"]))
            number = F.when(past, no).otherwise(number)
        return number

    return rows.withColumns({name: tile(m) for m, name in enumerate(measures)})


def _cut_rows(ranked: DataFrame, n_measures: int, tiles: int) -> list[Row]:
    """The first row of tile 2, 3, ... of each measure."""
    # One line per sorted partition and measure: a few thousand at most.
    blocks = (
        ranked.groupBy(F.shiftright("position", _ROW_BITS).alias("part"), "measure")
        .agg(F.min("position").alias("first"), F.count("*").alias("n"))
        .orderBy("measure", "part")
        .collect()
    )
    positions = []
    for m in range(n_measures):
        mine = [b for b in blocks if b["measure"] == m]
        ends = list(accumulate(b["n"] for b in mine))
        for start in tile_starts(ends[-1] if ends else 0, tiles):
            block, end = next((b, e) for b, e in zip(mine, ends) if start <= e)
            positions.append(block["first"] + start - (end - block["n"]) - 1)
    if not positions:
        return []
    return ranked.where(F.col("position").isin(positions)).orderBy("position").collect()
