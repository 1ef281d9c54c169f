"""Progress events and landing folders as streams."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

EVENT_SCHEMA = "event_type string, batch_id string, ts timestamp, payload string"
FILE_SCHEMA = "path string, modificationTime timestamp, length long, content binary"


def landing_files(spark: SparkSession, folder: str, suffix: str = "*.pdf") -> DataFrame:
    """Files that arrive in a folder, one row each, with content."""
    return spark.readStream.format("binaryFile").schema(FILE_SCHEMA).option("pathGlobFilter", suffix).load(folder)


def progress_events(spark: SparkSession, folder: str) -> DataFrame:
    """Events that are written to a folder as JSON lines."""
    return spark.readStream.schema(EVENT_SCHEMA).json(folder)


def event_counts(events: DataFrame, late: str = "10 minutes", window: str = "5 minutes") -> DataFrame:
    """Events per batch, type and window; events later than `late` are left out, repeated ones count once."""
    fresh = events.withWatermark("ts", late).dropDuplicatesWithinWatermark(["batch_id", "event_type", "ts", "payload"])
    return fresh.groupBy(F.window("ts", window), "batch_id", "event_type").count().select("window.start", "window.end", "batch_id", "event_type", "count")


def keep_history(events: DataFrame, table: str, checkpoint: str, keep: int = 500, trigger: dict | None = None):
    """Append events to a Parquet folder, at most `keep` of a micro-batch for each batch_id; readers take the last `keep`
    with `last_events`. Returns the running query."""

    def write(rows: DataFrame, _: int) -> None:
        last_events(rows, keep).write.mode("append").parquet(table)

    return events.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def last_events(events: DataFrame, keep: int = 500) -> DataFrame:
    """The newest `keep` events of each batch."""
    from pyspark.sql import Window

    back = F.row_number().over(Window.partitionBy("batch_id").orderBy(F.desc("ts"), F.desc("payload")))
    return events.withColumn("_back", back).where(F.col("_back") <= keep).drop("_back")


def sse(events: DataFrame) -> DataFrame:
    """Events as server-sent messages."""
    return events.select("batch_id", "ts", F.concat(F.lit("data: "), F.to_json(F.struct("event_type", "batch_id", "ts", "payload")), F.lit("\n\n")).alias("message"))


def each_batch(stream: DataFrame, work: Callable[[DataFrame], DataFrame], out: str, checkpoint: str):
    """Run a batch transformation on every micro-batch and append its rows to a Parquet folder."""
    return stream.writeStream.foreachBatch(lambda rows, _: work(rows).write.mode("append").parquet(out)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
