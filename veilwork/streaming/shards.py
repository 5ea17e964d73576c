"""A stream over a folder of parquet listings, processed as available: the finite counterpart of lazy shard loading."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def decoded_stream(spark: SparkSession, folder: str, schema: str, decode) -> DataFrame:
    return decode(spark.readStream.schema(schema).parquet(folder))


def run_available(stream: DataFrame, out: str, checkpoint: str) -> None:
    stream.writeStream.format("parquet").option("checkpointLocation", checkpoint).trigger(availableNow=True).start(out).awaitTermination()
