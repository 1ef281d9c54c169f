"""Histories, replays and heartbeats of batches as stream state.

One stateful operator keeps, per batch, a ring of its newest events, hands on every event, plays the ring to whoever
subscribes, and sends a heartbeat whenever a batch has been silent. Silence is event time: gaps between two events that come
in one trigger are filled when the later one comes, and a timer fills the gap after the last one as the watermark moves on.
So what is sent does not depend on how events fall into triggers.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

#: Events kept per batch, seconds of silence, the event type of a heartbeat, those that end a batch.
HISTORY, SILENCE, HEARTBEAT, LAST = 500, 15, "心跳", ("批次完成", "批次失败")
SENT = "batch_id string, subscriber string, seq long, event_type string, ts timestamp, payload string"
_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def stateful_session(spark: SparkSession) -> SparkSession:
    """The session with the state store that the operator needs."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", _PROVIDER)
    return spark


class History(StatefulProcessor):
    """State per batch: `ring`, place (seq modulo keep) -> event, and `at`, the next seq, the time of the last event and
    heartbeat in milliseconds, and whether the batch has ended."""

    def __init__(self, keep: int = HISTORY, silence: int = SILENCE):
        self.keep, self.silence = keep, silence * 1000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.ring = handle.getMapState("ring", "place int", "seq long, event_type string, ms long, payload string")
        self.at = handle.getValueState("at", "seq long, ms long, ended boolean")

    def _beats(self, key: str, after: int, until: int) -> list[tuple]:
        """Heartbeats of the silence from `after` up to `until`."""
        return [(key, None, None, HEARTBEAT, ms, "{}") for ms in range(after + self.silence, until + 1, self.silence)]

    def _frame(self, rows: list[tuple]) -> pd.DataFrame:
        out = pd.DataFrame(rows, columns=["batch_id", "subscriber", "seq", "event_type", "ts", "payload"])
        out["seq"] = out["seq"].astype("Int64")
        out["ts"] = pd.to_datetime(out["ts"], unit="ms")
        return out

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        """A trigger's events of one batch, in the order of time and payload, then its subscriptions."""
        batch = key[0]
        seq, last, ended = self.at.get() if self.at.exists() else (0, None, False)
        came = pd.concat(list(rows)).sort_values(["ts", "payload", "event_type"], kind="stable")
        ms = came["ts"].astype("datetime64[ms]").astype("int64")
        sent: list[tuple] = []
        for kind, payload, subscriber, now in zip(came["event_type"], came["payload"], came["subscriber"], ms):
            if isinstance(subscriber, str):
                continue
            if last is not None and not ended:
                sent += self._beats(batch, last, int(now) - 1)
            self.ring.updateValue((seq % self.keep,), (seq, kind, int(now), payload))
            sent.append((batch, None, seq, kind, int(now), payload))
            seq, last, ended = seq + 1, max(last or int(now), int(now)), ended or kind in LAST
        asked = [s for s in came["subscriber"] if isinstance(s, str)]
        if asked:
            held = sorted(tuple(v) for _, v in self.ring.iterator())
            sent += [(batch, s, n, kind, t, payload) for s in dict.fromkeys(asked) for n, kind, t, payload in held]
        if last is not None:
            self.at.update((seq, last, ended))
            for t in list(self.handle.listTimers()):
                self.handle.deleteTimer(t)
            if not ended:
                self.handle.registerTimer(last + self.silence)
        yield self._frame(sent)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        """Heartbeats up to the watermark, and the next timer after them."""
        seq, last, ended = self.at.get()
        sent = [] if ended else self._beats(key[0], last, timerValues.getCurrentWatermarkInMs())
        if sent:
            last = sent[-1][4]
            self.at.update((seq, last, ended))
            self.handle.registerTimer(last + self.silence)
        yield self._frame(sent)

    def close(self) -> None:
        pass


def sent_events(events: DataFrame, subscriptions: DataFrame | None = None, keep: int = HISTORY, silence: int = SILENCE, late: str = "10 seconds") -> DataFrame:
    """The stream of what followers get, from a stream of events(batch_id, event_type, ts, payload): every event with its
    number, heartbeats after each `silence` seconds without one (until the batch has ended), and for each row of
    subscriptions(batch_id, subscriber, ts) the newest `keep` events, addressed to the subscriber.

    Events may be `late`; later ones of their batch still come, but are not put in order. A trigger's events of one batch are
    held together, so its size is bounded by the source's rate limit. Rows without a batch or a time are left out."""
    stateful_session(events.sparkSession)
    came = events.select("batch_id", "event_type", F.col("ts").cast("timestamp").alias("ts"), F.coalesce("payload", F.lit("{}")).alias("payload"), F.lit(None).cast("string").alias("subscriber"))
    if subscriptions is not None:
        came = came.unionByName(subscriptions.select("batch_id", F.lit("").alias("event_type"), F.col("ts").cast("timestamp").alias("ts"), F.lit("").alias("payload"), "subscriber"))
    came = came.where("batch_id is not null and ts is not null").withWatermark("ts", late)
    return came.groupBy("batch_id").transformWithStateInPandas(History(keep, silence), SENT, "Append", "EventTime")
