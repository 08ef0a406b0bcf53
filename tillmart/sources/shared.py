"""Intermediate tables written to the cluster's shared folder."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark import inheritable_thread_target
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


#: Folders for sessions that were started without the setting, by application.
_own: dict[str, str] = {}


def use_folder(spark: SparkSession, folder: str) -> None:
    """Name the shared folder of a session that was started without ``spark.checkpoint.dir``."""
    if not spark.conf.get("spark.checkpoint.dir", None):
        _own.setdefault(spark.sparkContext.applicationId, folder.rstrip("/"))


def shared_folder(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``, else the one given to ``use_folder``."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    folder = folder or _own.get(spark.sparkContext.applicationId)
    if not folder:
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    return folder.rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


#: Bytes of a row group where rows cost far more to parse than to read.
PARSED_GROUP = 4 << 20


def stored(frame: DataFrame, name: str, row_group: int | None = None) -> DataFrame:
    """Write ``frame`` once and read it back, so that several later jobs see the same rows.

    The files outlive a lost executor, and readers pick only the columns they need. A file is
    divided among tasks by row groups of about ``row_group`` bytes, Parquet's own size if not given.
    """
    return _write(frame, new_folder(frame.sparkSession, name), row_group)


def _write(frame: DataFrame, path: str, row_group: int | None = None) -> DataFrame:
    options = {"parquet.block.size": row_group} if row_group else {}
    frame.write.options(**options).parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def existing_parquet(spark: SparkSession, path: str, schema: StructType) -> DataFrame | None:
    """What lies under ``path``, or None if there is no such folder."""
    return _existing(spark.read.schema(schema).parquet, path)


def existing_json(spark: SparkSession, path: str, schema: str) -> DataFrame | None:
    return _existing(spark.read.schema(schema).json, path)


def _existing(read: Callable[[str], DataFrame], path: str) -> DataFrame | None:
    try:
        return read(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def side_by_side(spark: SparkSession, *works: Callable[[], None]) -> None:
    """Works that do not depend on each other: one's tasks fill the cores that the other leaves idle.

    All of them end before the first error among them is raised.
    """
    with ThreadPoolExecutor(len(works)) as pool:
        running = [pool.submit(inheritable_thread_target(spark)(work)) for work in works]
    for done in running:
        done.result()


@contextmanager
def scratch(frame: DataFrame, name: str) -> Iterator[DataFrame]:
    """``stored`` for rows nobody needs after the block; the files are emptied then."""
    spark = frame.sparkSession
    path = new_folder(spark, name)
    try:
        yield _write(frame, path)
    finally:
        spark.createDataFrame([], frame.schema).write.mode("overwrite").parquet(path)
