"""Streaming forms: verify responses as they arrive, and drop repeated texts within a watermark."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from verisift.functions import text as T
from verisift.operators import verify

RESPONSES = "key string, response string, ground_truth string, at timestamp"


def read_responses(spark: SparkSession, path: str, schema: str = RESPONSES) -> DataFrame:
    """JSON lines files that appear in a folder, as a stream."""
    return spark.readStream.schema(schema).json(path)


def drop_repeats(stream: DataFrame, text: str, event_time: str, delay: str = "1 hour") -> DataFrame:
    """The first arrival of each normalised text; state is dropped once the watermark passes it."""
    keyed = stream.withWatermark(event_time, delay).withColumn("_key", F.sha1(T.normalize(F.col(text))))
    return keyed.dropDuplicatesWithinWatermark(["_key"]).drop("_key")


def constraint_rate(stream: DataFrame, event_time: str, width: str = "10 minutes", delay: str = "1 hour", ids: list[str] | None = None) -> DataFrame:
    """Share of followed constraints by event-time window and constraint: stateless checks, then a windowed count."""
    rows = verify.explode_constraints(stream.withWatermark(event_time, delay), verify.ground_truth(stream))
    checked = verify.check_rows(rows, "response", ids)
    return checked.groupBy(F.window(event_time, width), "constraint_id").agg(F.count(F.lit(1)).alias("n"), F.count_if("followed").alias("n_followed"))


def verify_stream(stream: DataFrame, out: str, checkpoint: str, ids: list[str] | None = None) -> StreamingQuery:
    """Verifies each micro-batch and writes it to out/batch=<id>; a repeated batch replaces its own output."""

    def sink(batch: DataFrame, batch_id: int) -> None:
        verify.verify(batch, "key", "response", ids).write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    return stream.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
