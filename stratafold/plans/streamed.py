"""Queries that run a stream over a given table to its end and return what it has sent."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratafold.plans.document import shared_folder
from stratafold.streaming.history import HEARTBEAT, SENT, sent_events

#: Seconds of silence and lateness for the given events, whose users pause for hours.
PAUSE, LATE = 12 * 3600, 10


def b12_b17_sent_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What followers of the events' users are sent: each event with its number, and heartbeats in the pauses, also after a
    user's last event up to the watermark. The stream's state is the history of each user."""
    path = f"{sf_dir}/events.parquet"
    # a pattern, as a stream takes a folder or a pattern but no single file
    events = spark.readStream.schema(spark.read.parquet(path).schema).parquet(f"{sf_dir}/event[s].parquet")
    named = events.select(F.col("user_id").cast("string").alias("batch_id"), "event_type", "ts", F.lpad(F.col("event_id").cast("string"), 20, "0").alias("payload"))
    out = f"{shared_folder(spark)}/sent-{uuid4().hex}"
    query = sent_events(named, silence=PAUSE, late=f"{LATE} seconds").writeStream.format("parquet").option("path", f"{out}/rows").option("checkpointLocation", f"{out}/checkpoint").trigger(availableNow=True).start()
    query.awaitTermination()
    sent = spark.read.schema(SENT).parquet(f"{out}/rows")
    return sent.select(F.col("batch_id").cast("long").alias("batch_id"), F.coalesce("seq", F.lit(-1)).alias("seq"), "event_type", F.unix_millis("ts").alias("ms"))


STREAMED = {"b12_b17_sent_events": b12_b17_sent_events}


def streamed_sql() -> dict[str, str]:
    ms = "epoch_us(ts) // 1000"
    beats = f"SELECT batch_id, -1 AS seq, '{HEARTBEAT}' AS event_type, ms + {PAUSE * 1000} * k AS ms FROM gaps, unnest(range(1, greatest(0, (until - ms) // {PAUSE * 1000}) + 1)) AS u(k)"
    return {
        "b12_b17_sent_events": f"""
WITH e AS (SELECT user_id AS batch_id, event_id, event_type, {ms} AS ms, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS seq FROM events),
gaps AS (SELECT batch_id, ms, coalesce(lead(ms) OVER (PARTITION BY batch_id ORDER BY seq) - 1, (SELECT max(ms) FROM e) - {LATE * 1000}) AS until FROM e)
SELECT batch_id, seq, event_type, ms FROM e UNION ALL {beats}"""
    }
