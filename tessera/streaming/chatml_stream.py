"""ST1: conversations read lazily as a stream and rendered in the training
ChatML format, Parquet in and Parquet out.

The rendering is stateless (one nested conversation per row), so the
stream needs no watermark or state store; ``availableNow`` drains what is
in the source folder and stops, and the checkpoint location makes the
query restartable after an executor or driver loss.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.chat import chatml_train

NESTED_SCHEMA = T.StructType([
    T.StructField("conv_id", T.LongType()),
    T.StructField("messages", T.ArrayType(T.StructType([
        T.StructField("role", T.StringType()), T.StructField("content", T.StringType())]))),
])


def chatml_stream(spark: SparkSession, source_dir: str, sink_dir: str, checkpoint: str,
                  max_files_per_trigger: int | None = None):
    """Start the stream; returns the StreamingQuery."""
    reader = spark.readStream.schema(NESTED_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    src = reader.parquet(source_dir)
    out = src.select("conv_id", chatml_train(F.col("messages")).alias("text"))
    return (out.writeStream.format("parquet").option("path", sink_dir)
            .option("checkpointLocation", checkpoint).outputMode("append")
            .trigger(availableNow=True).start())


def drain(spark: SparkSession, source_dir: str, sink_dir: str, checkpoint: str) -> DataFrame:
    q = chatml_stream(spark, source_dir, sink_dir, checkpoint)
    q.awaitTermination()
    return spark.read.schema("conv_id bigint, text string").parquet(sink_dir)
