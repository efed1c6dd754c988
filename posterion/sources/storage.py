"""Shared-folder helpers: cutting lineage and keeping a table for many passes."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F


def _shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir, and where it is unset a folder of the warehouse, which executors share too."""
    return (spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
            or spark.conf.get("spark.sql.warehouse.dir") + "/_stage")


def _removed_at_end(spark: SparkSession, path: str) -> str:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(target)
    return path


def stage_path(spark: SparkSession, name: str) -> str:
    """A new path for a written table in the shared folder; the session removes it when it ends."""
    return _removed_at_end(spark, f"{_shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}")


def reused(df: DataFrame) -> DataFrame:
    """The table kept for several passes.

    It is written to the shared folder, so a lost executor costs a reread and not a
    recomputation of everything before it.
    """
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(_shared_folder(df.sparkSession))
    return df.checkpoint(eager=True)


BROADCAST_BYTES = 16 << 20   # of a derived table that may be sent to every executor


def sized(df: DataFrame) -> DataFrame:
    """A derived table for the small side of a join: computed once, measured, and marked for
    broadcast only when its rows take no more than BROADCAST_BYTES. Otherwise Spark joins it by shuffle."""
    kept = reused(df)
    row = F.lit(16)
    for f in kept.schema.fields:
        c = F.col("`" + f.name.replace("`", "``") + "`")
        kind = f.dataType.simpleString()
        if kind in ("string", "binary"):
            row = row + F.coalesce(F.octet_length(c), F.lit(0))
        else:
            row = row + (8 * F.size(c) if kind.startswith(("array<", "map<")) else F.lit(8))
    return F.broadcast(kept) if (kept.agg(F.sum(row)).head()[0] or 0) <= BROADCAST_BYTES else kept
