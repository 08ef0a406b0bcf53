"""Written intermediate tables whose sources' shuffle files are given up at once."""

from __future__ import annotations

import gc

from pyspark.sql import DataFrame, SparkSession

from tillmart.sources.shared import stored


def forget(spark: SparkSession) -> None:
    """A hint to the driver to forget what it no longer refers to.

    Spark deletes the shuffle files of a finished step when the driver collects its garbage,
    which a driver with little to do may not do for the whole job.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def kept(frame: DataFrame, name: str) -> DataFrame:
    """``stored``, then ``forget``."""
    out = stored(frame, name)
    del frame
    forget(out.sparkSession)
    return out
