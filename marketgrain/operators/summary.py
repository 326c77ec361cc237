"""Summaries used more than once."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketgrain.session import scratch_dir


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def cleared(spark: SparkSession) -> Iterator[None]:
    """What a statement in here shuffles is removed from the disks when it ends."""
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP, before)


def one_row(frame: DataFrame) -> Column:
    """A one-row result as a struct column, for use in any other query.

    All its fields come from one subquery. A subquery per field would be pruned
    to that field and then computed again for the next one.
    """
    return frame.select(F.struct("*")).scalar()


def materialized(frame: DataFrame, label: str, **options: str) -> DataFrame:
    """Write a summary to the shared scratch folder and read it back.

    Two analyses of the same summary would each be pruned to other columns and
    scan the facts again; the written table is scanned instead. It lives in
    shared storage, so losing an executor loses nothing. What was shuffled for it
    is removed from the disks when it is written. ``options`` are those of the writer.
    """
    spark, path = frame.sparkSession, scratch_dir(frame.sparkSession, label)
    with cleared(spark):
        frame.write.options(**options).parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


SMALL_SPLITS = 16  # a source with more is never moved, however many cores there are


def spread(frame: DataFrame) -> DataFrame:
    """Rows of a small source over all cores, ahead of work that costs more
    than moving them. A source with splits for at least half of the cores, or
    with more than ``SMALL_SPLITS``, is left alone: at most that many splits,
    about 2 GB at Spark's split size, are ever shuffled for this.

    Only for frames without a shuffle of their own: counting the partitions of
    any other frame would run it."""
    cores = frame.sparkSession.sparkContext.defaultParallelism
    splits = frame.rdd.getNumPartitions()
    return frame.repartition(cores) if splits <= SMALL_SPLITS and splits * 2 <= cores else frame
