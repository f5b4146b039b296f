"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, which every executor can read."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return configured.rstrip("/")


_owned: list[list[str]] = []  # paths of the open ``stored_tables`` blocks, innermost last


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that nothing else writes to."""
    path = f"{shared_folder(spark)}/quipu/{label}-{uuid.uuid4().hex}"
    if _owned:
        _owned[-1].append(path)
    return path


@contextmanager
def stored_tables(spark: SparkSession) -> Iterator[None]:
    """Remove, at the end of the block, the tables that operators stored inside it.

    Results must be written or collected inside the block, as they read those tables.
    Without a block the tables stay until the shared folder is cleaned.
    """
    _owned.append([])
    try:
        yield
    finally:
        jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        for path in _owned.pop():
            place = jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(conf).delete(place, True)


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and return the stored table.

    Used where two branches must see the very same rows (for example row numbers
    given after a range shuffle, whose bounds come from a sample). The stored
    table also cuts the lineage, so a lost executor re-reads files only.
    """
    spark = df.sparkSession
    path = fresh_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


SHORT = 1_000_000  # rows
SMALL = 128 * 1024 * 1024  # bytes, far below an executor's memory


def _bytes(name: str, kind: T.DataType) -> Column:
    """Size of a value, with room for its place in a row."""
    column = F.col(f"`{name}`")
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(column), F.lit(0)) + 16
    if isinstance(kind, (T.ArrayType, T.MapType, T.StructType)):
        return F.coalesce(F.octet_length(F.to_json(F.struct(column))), F.lit(0)) * 2 + 32
    return F.lit(16)


def is_short(df: DataFrame, rows: int = SHORT, size: int = SMALL) -> bool:
    """Whether ``df`` has at most so many rows and takes at most so many bytes."""
    width = sum((_bytes(f.name, f.dataType) for f in df.schema.fields), F.lit(0))
    found = df.agg(F.count(F.lit(1)).alias("n"), F.sum(width.cast("bigint")).alias("bytes")).first()
    return found["n"] <= rows and (found["bytes"] or 0) <= size


def broadcast_if_short(df: DataFrame, rows: int = SHORT) -> DataFrame:
    """Mark ``df`` for broadcast, but only after measuring that it is small.

    A larger table is returned as it is, and joins by shuffle.
    """
    return F.broadcast(df) if is_short(df, rows) else df
