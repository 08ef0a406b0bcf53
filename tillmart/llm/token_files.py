"""Token ids in ORC: written in document order, read back in parallel.

Each file holds one range of doc_id in ascending order. Ids are an integer list, which ORC
run-length encodes; the files carry row indexes, stripe statistics and Bloom filters on doc_id, so
``read(...).where("doc_id = 7")`` skips whole files, stripes and row groups. ``row_start`` counts
the ids before a document within its file, so global offsets need one sum per file and no pass
over the ids.

Defined results: null text is the empty text (the end id alone). Null doc_ids come first. Rows that
repeat a doc_id are all kept, ordered by text; identical rows are interchangeable. Other columns of
the input are not stored, whatever their names. An empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillmart.llm.arrow import slices, utf8
from tillmart.llm.encoder import encoder

SCHEMA = "doc_id long, part long, row_start long, n_tokens long, ids array<int>"

#: ORC settings: Bloom filters on the document id, an index entry every 10,000 rows.
LAYOUT = {
    "orc.bloom.filter.columns": "doc_id",
    "orc.bloom.filter.fpp": "0.01",
    "orc.create.index": "true",
    "orc.row.index.stride": "10000",
    "orc.stripe.size": str(64 << 20),
    "compression": "zstd",
}


def _lists(ids: np.ndarray, lengths: np.ndarray) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(ids.view(np.int32)))


def write(docs: DataFrame, path: str, tokenizer: str, end_id: int | None) -> None:
    """Encode every text of ``docs`` (doc_id, text) and write the ids in ascending doc_id order.

    Ranges of doc_id are found by sampling; a doc_id that is very common is divided by its texts.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held = TaskContext.get().partitionId(), 0
        for batch in slices(batches):
            ids, n = encoder(tokenizer, end_id).encode(utf8(batch.column("text")))
            starts = held + np.cumsum(n) - n
            held += int(n.sum())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(np.full(len(n), part, np.int64)),
                    pa.array(starts.astype(np.int64)),
                    pa.array(n.astype(np.int64)),
                    _lists(ids, n),
                ],
                ["doc_id", "part", "row_start", "n_tokens", "ids"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    ordered = rows.repartitionByRange("doc_id", F.xxhash64("text")).sortWithinPartitions(
        "doc_id", "text"
    )
    ordered.mapInArrow(encode, SCHEMA).write.options(**LAYOUT).orc(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SCHEMA).orc(path)


def digests(spark: SparkSession, path: str) -> DataFrame:
    """Per document of the files: doc_id, start, n_tokens, ids_crc32.

    The driver sees one sum per file, as many as the write had tasks.
    """
    files = read(spark, path)
    sums = sorted(files.groupBy("part").agg(F.sum("n_tokens")).collect())
    totals = np.cumsum([0, *(n for _, n in sums)]).tolist()
    bases = spark.createDataFrame(
        [(part, base) for (part, _), base in zip(sums, totals, strict=False)],
        "part long, base long",
    )

    def checksum(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("ids")
            ends = np.frombuffer(ids.offsets.buffers()[1], np.int32)
            ends = ends[ids.offsets.offset : ids.offsets.offset + len(ids) + 1].tolist()
            raw = memoryview(ids.values.to_numpy().astype("<i4", copy=False)).cast("B")
            crcs = [
                zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(ends, ends[1:], strict=False)
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c) for c in ("doc_id", "part", "row_start", "n_tokens")),
                    pa.array(crcs, pa.int64()),
                ],
                ["doc_id", "part", "row_start", "n_tokens", "ids_crc32"],
            )

    found = files.mapInArrow(
        checksum, "doc_id long, part long, row_start long, n_tokens long, ids_crc32 long"
    )
    return found.join(bases, "part").select(
        "doc_id", (F.col("base") + F.col("row_start")).alias("start"), "n_tokens", "ids_crc32"
    )
