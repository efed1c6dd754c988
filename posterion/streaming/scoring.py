"""Scoring a stream. All score operators only add columns, so `score` takes a streaming
table unchanged; this module adds the file-to-file job."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, types as T

from posterion.operators.score import score
from posterion.plans.model import Model


def read_stream(spark: SparkSession, path: str, schema: T.StructType, *, pattern: str | None = None) -> DataFrame:
    """A folder of parquet files as a stream."""
    reader = spark.readStream.schema(schema)
    return (reader.option("pathGlobFilter", pattern) if pattern else reader).parquet(path)


def score_stream(stream: DataFrame, model: Model, queries, *, path: str, checkpoint: str, **options) -> None:
    """Score everything that is available and write it to parquet, exactly once per input file."""
    scored = score(stream, model, queries, **options)
    (scored.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
     .outputMode("append").trigger(availableNow=True).start().awaitTermination())
