"""What the operators share: shared-folder tables, shipping code, reading sources."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_SHIPPED: set[str] = set()


def scratch(spark: SparkSession, label: str) -> str:
    """A fresh path in the folder that driver and executors share.

    ``spark.checkpoint.dir`` names it. Where it is unset, a single-process
    session (as in tests) gets a folder of its own; any other session is refused,
    because its executors could not see one another's files.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="llm-"))
        root = spark.sparkContext.getCheckpointDir()
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def stored(frame: DataFrame, label: str) -> DataFrame:
    """The rows as a written table: a later reader scans them instead of computing
    them again, and losing an executor loses nothing."""
    path = scratch(frame.sparkSession, label)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


SMALL_BYTES = 64 << 20


def small_side(frame: DataFrame, row_bytes: int) -> DataFrame:
    """A stored table with a broadcast hint if its rows, counted, fit ``SMALL_BYTES``;
    a larger one as it is, so that the join shuffles."""
    return F.broadcast(frame) if frame.count() * row_bytes <= SMALL_BYTES else frame


def ship(spark: SparkSession) -> None:
    """Make this package importable in the Python workers, once a session."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    name = os.path.join(tempfile.mkdtemp(prefix="llm-code-"), "marketgrain_code.zip")
    with zipfile.ZipFile(name, "w") as archive:
        for folder, _, files in os.walk(top):
            for file in files:
                if file.endswith(".py"):
                    path = os.path.join(folder, file)
                    archive.write(path, os.path.relpath(path, os.path.dirname(top)))
    context.addPyFile(name)
    _SHIPPED.add(context.applicationId)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def id_remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id's text, modulo ``modulus``; a null id counts as an empty text."""
    text = F.coalesce(doc_id.cast("string"), F.lit(""))
    return F.pmod(F.crc32(F.encode(text, "utf-8")), F.lit(modulus)).cast("int")


def tasks(spark: SparkSession) -> int:
    """Partitions of an ordinary shuffle of this session."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
