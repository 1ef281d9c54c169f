"""The prefix trie against plain loops."""

import hashlib
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from stratafold.llm import tries

TURNS = "conv_id long, turn long, role string, text string"


def plain_trie(sequences):
    """The definition, node by node; sequences: conv_id -> list of (role, text)."""
    members = defaultdict(list)
    for c, turns in sequences.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    out = []
    for prefix, convs in members.items():
        below = [p for p in members if p[: len(prefix)] == prefix]
        ends = sorted(c for c in convs if len(sequences[c]) == len(prefix))
        out.append((
            min(convs), len(prefix), min(members[prefix[:-1]]) if prefix else None, len(convs), sum(len(p) == len(prefix) + 1 for p in below),
            sum(not any(len(q) == len(p) + 1 and q[: len(p)] == p for q in below) for p in below),
            sum((len(members[p]) - 1) * len(p[-1][1].encode()) for p in below if p), hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest(),
        ))
    return sorted(out, key=str)


def in_order(rows):
    found = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            r, t = role or "", text or ""
            found[c].append(((turn is not None, turn or 0), hashlib.sha256(f"{len(r.encode())}:{r}{t}".encode()).digest(), (r, t)))
    return {c: [x[2] for x in sorted(turns, key=lambda x: x[:2])] for c, turns in found.items()}


def rebuilt(sequences):
    out = {}
    for c, own in sequences.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = sequences.get(c - c % 5, [])[:h] + own[h:]
    return out


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


ODD = [
    (1, 0, "user", "ä"), (1, 1, "bot", "b"), (2, 0, "user", "ä"), (2, 1, "bot", "c"), (3, None, None, None), (3, 0, "user", None), (3, 0, "user", None),
    (4, 0, "user", "ä"), (4, 1, "bot", "b"), (5, 0, "user", "ä"), (None, 0, "user", "lost"), (6, 2, "user", "x" * 100_000), (6, 2, "bot", "tie"), (11, 0, "u", "only turn"), (12, 0, "user", "ä"), (12, 1, "bot", "b"), (12, 2, "user", "d"),
]


def test_odd_turns(spark):
    turns = spark.createDataFrame(ODD, TURNS)
    got = rows_of(tries.prefix_trie(turns))
    assert got == plain_trie(in_order(ODD))
    clash = turns.select("*", *(F.lit("clash").alias(c) for c in ("pos", "digest", "n", "n_bytes", "row", "part", "depth", "owner", "prefix", "block", "end", "at", "h", "m", "size", "base")))
    assert got == rows_of(tries.prefix_trie(clash))
    assert tries.prefix_trie(turns.limit(0)).count() == 0 and tries.prefix_trie(turns.where("conv_id is null")).count() == 0
    shared = rows_of(tries.trie(*tries.shared_prefixes(*tries.ordered_turns(turns))))
    assert shared == plain_trie(rebuilt(in_order(ODD)))


@pytest.mark.parametrize("block, span, chunk", [(64, 1024, 65536), (2, 3, 20)])
def test_many_shapes(spark, monkeypatch, block, span, chunk):
    """Nested prefixes, copies, one conversation over many tasks, chains over several levels of blocks, lists cut in pieces."""
    monkeypatch.setattr(tries, "BLOCK", block)
    monkeypatch.setattr(tries, "SPAN", span)
    monkeypatch.setattr(tries, "CHUNK", chunk)
    rows = [(c, t, "ab"[t % 2], f"turn {t}") for c in range(20, 32) for t in range(c - 20)]
    rows += [(c, t, "a", "same") for c in range(100, 140) for t in range(3)]
    rows += [(c, t, "a", f"{(c // (t + 1)) % 3}") for c in range(200, 230) for t in range(c % 9)]
    rows += [(7, t, "ab"[t % 2], f"turn {t}") for t in range(70)]
    turns = spark.createDataFrame(rows, TURNS).repartition(7)
    assert rows_of(tries.prefix_trie(turns)) == plain_trie(in_order(rows))
    assert rows_of(tries.trie(*tries.shared_prefixes(*tries.ordered_turns(turns)))) == plain_trie(rebuilt(in_order(rows)))


def test_equal_prefixes_share_a_digest(spark):
    """However long, and wherever the conversation was cut."""
    turns = spark.createDataFrame([(c, t, "u", str(t) if t < 150 else f"{c} {t}") for c in (1, 2) for t in range(150 + c)], TURNS)
    placed, _ = tries.ordered_turns(turns)
    found = tries._chained(placed, 152).groupBy("pos").agg(F.countDistinct("prefix").alias("n"), F.count("*").alias("m")).collect()
    assert {r.pos: (r.n, r.m) for r in found} == {t: (1, 2) for t in range(150)} | {150: (2, 2), 151: (1, 1)}
