"""Mixing sources to target weights (op 4).

Each source's words are packed end to end into blocks of a fixed length. The slots of every output shard are dealt to the
sources by a multinomial draw; the slots that a source gets are numbered through, and a slot takes the block at its number's
place in a pseudorandom permutation of the source's blocks, one permutation per pass over the source. Blocks and slots meet
by index.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stratafold.llm.common import WS, count_words, group_rows, materialise, tidy

WEIGHTS = (5.0, 2.0, 1.0)
#: Words per block, slots per shard, and sources up to which their facts are broadcast (about 100 bytes each).
BLOCK, SLOTS, FEW_SOURCES = 256, 16384, 20_000


def targets(sizes: dict[str | None, int], total_share: float = 1.5, weights: tuple[float, ...] = WEIGHTS, most: float = 2.0) -> dict[str | None, float]:
    """Words to take from each source: sources in code-point order (null last) share total_share of all words by the
    repeating weights; a source stops at `most` times its size, and the excess is shared out again by weight."""
    order = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, open_ = total_share * sum(sizes.values()), list(order)
    out: dict[str | None, float] = {}
    while open_:
        per = left / sum(weight[s] for s in open_)
        full = [s for s in open_ if per * weight[s] > most * sizes[s]]
        if not full:
            return out | {s: per * weight[s] for s in open_}
        for s in full:
            out[s] = most * sizes[s]
            left -= out[s]
        open_ = [s for s in open_ if s not in out]
    return out


def _mix(x: np.ndarray, key: int) -> np.ndarray:
    """A keyed integer hash of 64 bits."""
    with np.errstate(over="ignore"):
        x = (x.astype(np.uint64) + np.uint64(key & 0xFFFFFFFFFFFFFFFF)) * np.uint64(0x9E3779B97F4A7C15)
        x ^= x >> np.uint64(32)
        x *= np.uint64(0xD6E8FEB86659FD93)
        x ^= x >> np.uint64(29)
    return x


def permute(index: np.ndarray, n: int, key: int) -> np.ndarray:
    """Place of each index in a pseudorandom permutation of 0 to n - 1: a four-round Feistel network on the next even number
    of bits, walked until it falls below n."""
    half = max(1, (max(1, n - 1).bit_length() + 1) // 2)
    mask = np.uint64((1 << half) - 1)
    out = index.astype(np.uint64).copy()
    todo = np.ones(len(out), bool)
    while todo.any():
        left, right = out[todo] >> np.uint64(half), out[todo] & mask
        for r in range(4):
            left, right = right, left ^ (_mix(right, key * 4 + r) & mask)
        out[todo] = left << np.uint64(half) | right
        todo[todo] = out[todo] >= n
    return out.astype(np.int64)


def place_of(block: int, n: int, key: int) -> int:
    """The index that permute() sends to `block`."""
    half = max(1, (max(1, n - 1).bit_length() + 1) // 2)
    mask = (1 << half) - 1
    x = block
    while True:
        left, right = x >> half, x & mask
        for r in reversed(range(4)):
            left, right = right ^ (int(_mix(np.array([left]), key * 4 + r)[0]) & mask), left
        x = left << half | right
        if x < n:
            return x


def whole_slots(size: int, target: int, block: int, key: int) -> tuple[int, int]:
    """(slots, words of the last slot) that take exactly `target` words of a source: full passes, then the first slots of
    one more pass, the last of them cut. Only the source's last block is shorter than the others."""
    if target <= 0 or size <= 0:
        return 0, 0
    n = -(-size // block)
    passes, rest = divmod(target, size)
    if not rest:
        passes, rest = passes - 1, size
    short = size - (n - 1) * block
    at = place_of(n - 1, n, key + passes)
    if rest <= at * block:
        used = -(-rest // block)
        return passes * n + used, rest - (used - 1) * block
    rest -= at * block
    if rest <= short:
        return passes * n + at + 1, rest
    rest -= short
    used = -(-rest // block)
    return passes * n + at + 1 + used, rest - (used - 1) * block


def mix(docs: DataFrame, text: str = "text", id_col: str = "doc_id", source: str = "source", block: int = BLOCK, slots: int = SLOTS, seed: int = 11, **shares) -> tuple[DataFrame, DataFrame]:
    """(members, takes). members has a row per document: row_id, id, h (hash of id and text), size, source_size, target. takes has the mix itself, a
    row per piece: shard, slot, pass_no, row_id, first (word number in the document), words.

    Sizes are words; null texts have none and are never taken. Every source is numbered in groups of documents that follow
    its size, so a source with a third of all rows has no task of its own. Multinomial draws are made shard by shard, each
    from its own seed, in parallel; slots by which a source passes its share are dealt to the sources that fell short, so
    that each source ends on its target to the word. Reruns agree: all draws hang on the seed, the ids and the sizes.
    Repeated rows and null ids count as documents of their own; other columns are not read, whatever their names. An empty
    table, or one without words, gives an empty mix.

    One row per source reaches the driver, which weighs the sources (about 300 bytes each, however many there are); up to
    FEW_SOURCES of them are broadcast, more are joined by a shuffle."""
    spark = docs.sparkSession
    base = docs.select(F.col(id_col).alias("id"), F.col(source).alias("source"), count_words(text).alias("size"), F.xxhash64(id_col, text).alias("h"))
    base = materialise(base, "sizes")
    known = base.groupBy("source").agg(F.sum("size").cast("long").alias("size"), F.count(F.lit(1)).alias("rows"))
    rows = known.collect()
    sizes = {r["source"]: r["size"] for r in rows}
    goal = targets(sizes, **shares)
    order = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    number = {s: i for i, s in enumerate(order)}
    group = group_rows(sum(r["rows"] for r in rows))
    groups = {r["source"]: -(-r["rows"] // group) for r in rows}
    n_blocks = [-(-sizes[s] // block) for s in order]
    keys = [seed * 1_000_003 + i * 101 for i in range(len(order))]
    plan = [whole_slots(sizes[s], round(goal[s]), block, keys[i]) for i, s in enumerate(order)]
    facts = spark.createDataFrame([(s, number[s], groups[s], sizes[s], float(goal[s])) for s in order] or [(None, -1, 1, 0, 0.0)], "source string, source_no int, groups long, source_size long, target double")
    # number of words before each document in its source: within its group, plus all groups before
    facts = F.broadcast(facts) if len(order) <= FEW_SOURCES else facts
    numbered = base.join(facts, base["source"].eqNullSafe(facts["source"])).select("id", "size", "h", "source_no", "source_size", "target", F.pmod(F.hash("h", F.lit(seed)), F.col("groups")).alias("g"))
    inside = Window.partitionBy("source_no", "g").orderBy("h", "id", "row_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    numbered = materialise(numbered.withColumn("row_id", F.monotonically_increasing_id()), "numbered")
    # rows without a word, of which very many may be alike, need no place
    worded = numbered.where("size > 0").withColumn("before", F.sum("size").over(inside) - F.col("size"))
    members = materialise(worded.unionByName(numbered.where("size = 0").withColumn("before", F.lit(0).cast("long"))), "members")
    starts = members.groupBy("source_no", "g").agg(F.sum("size").alias("n")).withColumn("base", F.sum("n").over(Window.partitionBy("source_no").orderBy("g")) - F.col("n")).drop("n")
    placed = members.where("size > 0").join(starts, ["source_no", "g"]).withColumn("start", F.col("base") + F.col("before"))
    placed = placed.select("row_id", "source_no", "start", "size", F.explode(F.sequence(F.expr(f"start div {block}"), F.expr(f"(start + size - 1) div {block}"))).alias("block"))
    in_block = placed.select("source_no", "block", "row_id", F.greatest(F.lit(0), F.col("start") - F.col("block") * block).alias("lo"), F.least(F.lit(block), F.col("start") + F.col("size") - F.col("block") * block).alias("hi"), (F.col("block") * block - F.col("start")).alias("shift"))
    dealt = deal(spark, plan, n_blocks, keys, slots, seed)
    # the slots come out of a generator whose size the planner cannot tell, so no side may be broadcast on its estimate
    met = dealt.hint("merge").join(in_block, ["source_no", "block"]).withColumn("hi", F.least("hi", "words")).where("hi > lo")
    takes = met.select("shard", "slot", "pass_no", "row_id", (F.col("lo") + F.col("shift")).alias("first"), (F.col("hi") - F.col("lo")).alias("words"))
    return members.select("row_id", "id", "h", "size", "source_size", "target"), takes


def deal(spark, plan: list[tuple[int, int]], n_blocks: list[int], keys: list[int], slots: int, seed: int) -> DataFrame:
    """The slots of all shards: (shard, slot, source_no, pass_no, block, words). words is the block's length except in the
    last slot of a source, which is cut to meet the target."""
    need = np.array([p[0] for p in plan], np.int64)
    last = np.array([p[1] for p in plan], np.int64)
    total = int(need.sum())
    shards = -(-total // slots)
    kind = "shard long, slot int, source_no int, pass_no int, block long, words long"
    if not total:
        return spark.createDataFrame([], kind)
    share = need / total
    length = lambda shard: int(min(slots, total - shard * slots))

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard in batch.column("id").to_pylist():
                c = np.random.default_rng([seed, shard]).multinomial(length(shard), share)
                at = np.flatnonzero(c)
                yield pa.RecordBatch.from_arrays([pa.array([shard] * len(at), pa.int64()), pa.array(at, pa.int32()), pa.array(c[at], pa.int64()), pa.array((np.cumsum(c) - c)[at], pa.int64())], ["shard", "source_no", "n", "offset"])

    ids = spark.range(0, shards, 1, max(1, min(shards, 4 * spark.sparkContext.defaultParallelism)))
    drawn = materialise(ids.mapInArrow(draw, "shard long, source_no int, n long, offset long"), "shard-counts")
    over = drawn.groupBy("source_no").agg(F.sum("n").alias("drawn"))
    got = {r["source_no"]: r["drawn"] for r in over.collect()}
    got = np.array([got.get(i, 0) for i in range(len(need))], np.int64)
    # slots beyond a source's need, numbered through by source, are filled with the lacking slots of the others
    extra = np.concatenate([[0], np.cumsum(np.maximum(got - need, 0))])
    lack = np.maximum(need - got, 0)
    lack_end = np.cumsum(lack)
    # number of a source's slots before each shard: within its run of shards, plus all runs before
    runs = drawn.withColumn("run", F.expr("shard div 1024"))
    of_run = runs.groupBy("source_no", "run").agg(F.sum("n").alias("m"))
    of_run = of_run.withColumn("base", F.sum("m").over(Window.partitionBy("source_no").orderBy("run")) - F.col("m")).drop("m")
    inside = F.sum("n").over(Window.partitionBy("source_no", "run").orderBy("shard")) - F.col("n")
    before = runs.withColumn("inside", inside).join(of_run, ["source_no", "run"]).select("shard", "source_no", "n", "offset", (F.col("inside") + F.col("base")).alias("before"))
    # slots are laid out shard by shard, whatever source they go to
    before = before.repartition(max(1, min(shards, 4 * spark.sparkContext.defaultParallelism)), "shard")

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, source, n, first, offset in zip(*(batch.column(c).to_pylist() for c in ("shard", "source_no", "n", "before", "offset"))):
                j = first + np.arange(n, dtype=np.int64)
                who = np.full(n, source, np.int64)
                past = j >= need[source]
                if past.any():
                    e = extra[source] + j[past] - need[source]
                    who[past] = np.searchsorted(lack_end, e, "right")
                    j[past] = got[who[past]] + e - (lack_end - lack)[who[past]]
                pass_no = np.zeros(n, np.int64)
                block = np.zeros(n, np.int64)
                words = np.full(n, np.iinfo(np.int32).max, np.int64)
                for s in np.unique(who):
                    at = who == s
                    pass_no[at] = j[at] // n_blocks[s]
                    for p in np.unique(pass_no[at]):
                        own = at & (pass_no == p)
                        block[own] = permute(j[own] % n_blocks[s], n_blocks[s], keys[s] + int(p))
                    words[at & (j == need[s] - 1)] = last[s]
                # a slot's place in its shard is a pseudorandom one, so that sources do not stand in runs
                slot = permute(offset + np.arange(n), length(shard), seed * 7919 + shard)
                yield pa.RecordBatch.from_arrays([pa.array([shard] * n, pa.int64()), pa.array(slot, pa.int32()), pa.array(who, pa.int32()), pa.array(pass_no, pa.int32()), pa.array(block), pa.array(words)], ["shard", "slot", "source_no", "pass_no", "block", "words"])

    return before.mapInArrow(tidy(fill), kind)


def mix_summary(members: DataFrame, takes: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """One row per document: id, size, source_size, target (its source's), taken (words taken, repeats counted)."""
    taken = takes.groupBy("row_id").agg(F.sum("words").alias("taken"))
    return members.join(taken, "row_id", "left").select(F.col("id").alias(id_col), "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))


def mixed_text(text: str = "text", takes: str = "takes", size: str = "size"):
    """Text of a document's takes, an array of (pass_no, first, words) in order: a pass that takes all words gives the text
    itself, any other the words it takes; passes follow each other on new lines. The text is split once, and only if a
    pass takes a part of it."""
    whole = lambda t: (t["first"] == 0) & (t["words"] == F.col(size))
    words = F.filter(F.split(F.coalesce(F.col(text), F.lit("")), WS), lambda w: w != "")
    one = lambda t, w: F.when(whole(t), F.col(text)).otherwise(F.array_join(F.slice(w, t["first"].cast("int") + 1, t["words"].cast("int")), " "))
    cut = F.element_at(F.transform(F.array(words), lambda w: F.array_join(F.transform(F.col(takes), lambda t: one(t, w)), "\n")), 1)
    return F.when(F.forall(F.col(takes), whole), F.array_join(F.transform(F.col(takes), lambda t: F.col(text)), "\n")).otherwise(cut)
