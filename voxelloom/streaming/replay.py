"""Stream queries over the events table, run until all input is read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch


def events_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    return spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir).withColumn("ts", F.col("ts").cast("timestamp"))


def drained(stream: DataFrame, mode: str, label: str) -> DataFrame:
    """Run a stream over what there is; its output: all batches' in append mode, the last one's in complete mode."""
    spark = stream.sparkSession
    out, checkpoint = scratch(spark, label), scratch(spark, f"{label}-checkpoint")

    def batch(rows: DataFrame, number: int) -> None:
        rows.write.mode("overwrite").parquet(out if mode == "complete" else f"{out}/batch={number}")

    stream.writeStream.outputMode(mode).foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(stream.schema).parquet(out)


def state_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tickets of each state and hour, kept up as the stream runs."""
    state = F.when(F.col("event_type").isin("click", "view"), "queued").when(F.col("event_type") == "signup", "active").when(F.col("event_type") == "purchase", "completed").otherwise("failed")
    counts = events_stream(spark, sf_dir).groupBy(F.window("ts", "1 hour").alias("w"), state.alias("state")).agg(F.count("*").alias("n"))
    out = drained(counts.select(F.col("w.start").alias("hour"), "state", "n"), "complete", "state-counts")
    return out.select(F.col("hour").cast("timestamp_ntz").alias("hour"), "state", "n")
