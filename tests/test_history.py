"""Histories, replays and heartbeats as stream state."""

import json
from datetime import datetime, timedelta

import pytest

from stratafold.streaming.history import HEARTBEAT, sent_events

EVENT = "batch_id string, event_type string, ts timestamp, payload string, subscriber string"
START = datetime(2024, 1, 1)


@pytest.fixture
def stream(spark, tmp_path):
    """A function that adds a file of (batch, kind, second, payload, subscriber) rows and gives what was sent because of it."""
    src, out = tmp_path / "in", str(tmp_path / "out")
    src.mkdir()
    before: list[tuple] = []
    n = [0]

    def push(*rows, keep=500, silence=15):
        n[0] += 1
        lines = [{"batch_id": b, "event_type": k, "ts": (START + timedelta(seconds=s)).isoformat(), "payload": p, "subscriber": who} for b, k, s, p, who in rows]
        (src / f"{n[0]:03d}.json").write_text("\n".join(json.dumps(x) for x in lines))
        came = spark.readStream.schema(EVENT).option("maxFilesPerTrigger", 1).json(str(src))
        sent = sent_events(came.where("subscriber is null"), came.where("subscriber is not null"), keep, silence)
        q = sent.writeStream.format("parquet").option("path", out).option("checkpointLocation", str(tmp_path / "cp")).outputMode("append").trigger(availableNow=True).start()
        assert q.awaitTermination(120)
        now = [(r.batch_id, r.event_type, int((r.ts - START).total_seconds()), r.seq, r.subscriber) for r in spark.read.parquet(out).collect()]
        new = sorted(now, key=str)
        for x in before:
            new.remove(x)
        before[:] = now
        return new

    return push


def event(batch, second, kind="阶段进度"):
    return (batch, kind, second, f"{second:05d}", None)


def test_heartbeats_and_replay(stream):
    first = stream(event("a", 0), event("a", 10), event("a", 50), event("b", 0))
    # 40 seconds between two events are two heartbeats; the watermark stands at 40, so b has been silent twice by then
    assert [x for x in first if x[0] == "a"] == sorted([("a", "阶段进度", 0, 0, None), ("a", "阶段进度", 10, 1, None), ("a", HEARTBEAT, 25, None, None), ("a", HEARTBEAT, 40, None, None), ("a", "阶段进度", 50, 2, None)], key=str)
    assert [x for x in first if x[0] == "b"] == sorted([("b", "阶段进度", 0, 0, None), ("b", HEARTBEAT, 15, None, None), ("b", HEARTBEAT, 30, None, None)], key=str)
    # an event of b goes on where the heartbeats ended; a follower of a gets its history, once
    second = stream(event("b", 52, "批次完成"), ("a", "", 52, "", "me"))
    assert [x for x in second if x[0] == "b"] == sorted([("b", HEARTBEAT, 45, None, None), ("b", "批次完成", 52, 1, None)], key=str)
    assert [x for x in second if x[4] == "me"] == sorted([("a", "阶段进度", s, i, "me") for i, s in enumerate((0, 10, 50))], key=str)
    # a batch that has ended is silent for good; a is not
    third = stream(event("c", 200))
    assert not [x for x in third if x[0] == "b"]
    assert sorted(x[1:3] for x in third if x[0] == "a") == [(HEARTBEAT, s) for s in range(65, 190, 15)]


def test_event_501_pushes_out_the_first(stream):
    rows = [event("a", s) for s in range(501)]
    assert len(stream(*rows[:300])) == 300
    sent = stream(*rows[300:], ("a", "", 501, "", "me"))
    mine = sorted(x[3] for x in sent if x[4] == "me")
    assert mine == list(range(1, 501)) and sorted(x[3] for x in sent if x[4] is None) == list(range(300, 501))
