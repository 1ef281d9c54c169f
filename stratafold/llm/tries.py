"""Prefix trie of conversations (op 11): chained SHA-256 digests of prefixes, one node per (depth, digest), sums over subtrees.

A node is owned by its smallest member. The nodes of one owner lie on one path, from where its prefix is no longer shared with
a smaller member down to its last turn, so (owner, depth) names a node, and the trie is a tree of such paths. For the sums
over subtrees each path, not each of its nodes, is exploded to the paths above it; the nodes of a path then take suffix sums.
A node exploded by itself would cost the square of a conversation's length; a path costs one row for each owner above it,
which is never more than the conversation has turns, so all of this grows with the number of turns.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratafold.llm.common import discard, materialise, tidy

#: Turns whose digests are chained in one group; a longer conversation is a chain of such groups, level upon level.
BLOCK = 64
#: Nodes of a path that are summed in one window, and bytes of a list of ids that are hashed as one row.
SPAN, CHUNK = 1024, 65536


def _digest(value: Column) -> Column:
    return F.unhex(F.sha2(value, 256))


def _number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by conversation, with the number of each in its conversation, as far as this task sees it."""
    context = TaskContext.get()
    part = context.partitionId() if context else 0
    last, before = None, 0
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        ids, at = batch.column("conv_id").to_numpy(), np.arange(n)
        first = np.concatenate([[last is None or ids[0] != last], ids[1:] != ids[:-1]])
        run = np.maximum.accumulate(np.where(first, at, -1))
        no = np.where(run >= 0, at - run, before + at)
        last, before = ids[-1], int(no[-1]) + 1
        yield pa.RecordBatch.from_arrays([batch.column("conv_id"), pa.array(np.full(n, part, np.int32)), pa.array(no), batch.column("digest"), batch.column("n_bytes")], ["conv_id", "part", "no", "digest", "n_bytes"])


def ordered_turns(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(turns, sizes): turns has conv_id, pos (from 0), digest of role and text, n_bytes of the text in UTF-8; sizes has
    conv_id and n.

    Turns are in the order of turn, null first, equal ones by digest. Only digests are moved, never texts. Rows are dealt out
    by ranges of (conversation, turn), so that one huge conversation lies in many tasks; what a task's first conversation has
    in the tasks before is added from a table of one row per task at most."""
    text, role = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (text_col, role_col))
    slim = turns.where(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).alias("turn"),
        _digest(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)).alias("digest"), F.octet_length(text).cast("long").alias("n_bytes"),
        F.monotonically_increasing_id().alias("row"),
    )
    order = ["conv_id", F.asc_nulls_first("turn"), "digest", "row"]
    sorted_rows = slim.repartitionByRange(*order).sortWithinPartitions(*order).select("conv_id", "digest", "n_bytes")
    numbered = materialise(sorted_rows.mapInArrow(tidy(_number), "conv_id long, part int, no long, digest binary, n_bytes long"), "turns")
    parts = numbered.groupBy("conv_id", "part").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    parts = materialise(parts.withColumn("before", F.coalesce(before, F.lit(0))), "turn-parts")
    begun = parts.where("before > 0").select("conv_id", "part", "before")  # a task has at most one conversation begun before it
    placed = numbered.join(F.broadcast(begun), ["conv_id", "part"], "left")
    placed = placed.select("conv_id", (F.col("no") + F.coalesce("before", F.lit(0))).alias("pos"), "digest", "n_bytes")
    return placed, parts.groupBy("conv_id").agg(F.sum("n").alias("n"))


def shared_prefixes(turns: DataFrame, sizes: DataFrame, every: int = 5, most: int = 8) -> tuple[DataFrame, DataFrame]:
    """(turns, sizes) of the conversations in which c begins with the first h turns of conversation c - c % every (all if
    fewer, none if absent) and goes on with its own turns after its first h; h = crc32(c in decimal) % (most + 1).
    % is SQL's, with the sign of c. A conversation may end up without a turn."""
    c = F.col("conv_id")
    h = (F.crc32(c.cast("string").cast("binary")) % (most + 1)).alias("h")
    base = (c - c % every).alias("base")
    of_base = sizes.select(F.col("conv_id").alias("base"), F.col("n").alias("n_base"))
    plan = sizes.select("conv_id", "n", h, base).join(of_base, "base", "left")
    plan = plan.withColumn("m", F.least("h", F.coalesce("n_base", F.lit(0))))
    plan = materialise(plan.withColumn("size", F.col("m") + F.greatest(F.col("n") - F.col("h"), F.lit(0))), "rebuilt")
    own = turns.where(F.col("pos") >= (F.crc32(c.cast("string").cast("binary")) % (most + 1))).join(plan.select("conv_id", "h", "m"), "conv_id")
    own = own.select("conv_id", (F.col("pos") - F.col("h") + F.col("m")).alias("pos"), "digest", "n_bytes")
    lent = turns.where((c % every == 0) & (F.col("pos") < most)).withColumnRenamed("conv_id", "base")
    lent = lent.join(plan.select("conv_id", "base", "h"), "base").where("pos < h").select("conv_id", "pos", "digest", "n_bytes")
    return own.unionByName(lent), plan.select("conv_id", F.col("size").alias("n"))


def _chained(rows: DataFrame, top: int) -> DataFrame:
    """conv_id, pos, n_bytes and prefix: the digest of all turns up to pos. The digest of a turn in the first block is
    chained to the one before; in a later block the chain begins anew and its link is hashed with the digest of all earlier
    blocks, which are chained in the same way. So no group holds more than BLOCK turns, and equal prefixes have equal digests."""
    turns = F.sort_array(F.collect_list(F.struct("pos", "digest", "n_bytes")))
    link = lambda acc, t: F.concat(acc, F.array(_digest(F.concat(F.element_at(acc, -1), t["digest"]))))
    blocks = rows.withColumn("block", F.floor(F.col("pos") / BLOCK)).groupBy("conv_id", "block").agg(turns.alias("turns"))
    blocks = blocks.withColumn("chain", F.aggregate("turns", F.array(F.lit(b"").cast("binary")), link))
    if top > BLOCK:
        blocks = materialise(blocks, "blocks")
        full = blocks.where(F.size("turns") == BLOCK).select("conv_id", F.col("block").alias("pos"), F.element_at("chain", -1).alias("digest"), F.lit(0).cast("long").alias("n_bytes"))
        states = _chained(full, -(-top // BLOCK)).select("conv_id", (F.col("pos") + 1).alias("block"), F.col("prefix").alias("state"))
        blocks = blocks.join(states, ["conv_id", "block"], "left")
    else:
        blocks = blocks.withColumn("state", F.lit(None).cast("binary"))
    out = blocks.select("conv_id", "state", F.inline(F.transform("turns", lambda t, i: F.struct(t["pos"].alias("pos"), t["n_bytes"].alias("n_bytes"), F.get("chain", i + 1).alias("link")))))
    prefix = F.when(F.col("state").isNull(), F.col("link")).otherwise(_digest(F.concat("state", "link")))
    return out.select("conv_id", "pos", "n_bytes", prefix.alias("prefix"))


def _lists(chunk: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Sorted (owner, depth, conv_id) rows as comma-joined ids, at most about `chunk` bytes a row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, first, held, size = None, None, [], 0
        schema = pa.schema([("owner", pa.int64()), ("depth", pa.int64()), ("first", pa.int64()), ("ids", pa.string())])
        batch_of = lambda rows: pa.RecordBatch.from_pydict(dict(zip(schema.names, map(list, zip(*rows)))), schema)
        for batch in batches:
            out = []
            for owner, depth, conv in zip(*(batch.column(c).to_pylist() for c in ("owner", "depth", "conv_id"))):
                if node != (owner, depth) or size > chunk:
                    if held:
                        out.append((*node, first, ",".join(held)))
                    node, first, held, size = (owner, depth), conv, [], 0
                held.append(str(conv))
                size += len(held[-1]) + 1
            if out:
                yield batch_of(out)
        if held:
            yield batch_of([(*node, first, ",".join(held))])

    return run


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The SHA-256 of each node's list, read piece by piece in order."""
    node, state = None, hashlib.sha256()
    schema = pa.schema([("owner", pa.int64()), ("depth", pa.int64()), ("ends_sha256", pa.string())])
    for batch in batches:
        out = []
        for owner, depth, ids in zip(*(batch.column(c).to_pylist() for c in ("owner", "depth", "ids"))):
            if node == (owner, depth):
                state.update(b",")
            else:
                if node:
                    out.append((*node, state.hexdigest()))
                node, state = (owner, depth), hashlib.sha256()
            state.update(ids.encode())
        if out:
            yield pa.RecordBatch.from_pydict(dict(zip(schema.names, map(list, zip(*out)))), schema)
    if node:
        yield pa.RecordBatch.from_pydict(dict(zip(schema.names, ([x] for x in (*node, state.hexdigest())))), schema)


def _ends(paths: DataFrame) -> DataFrame:
    """owner, depth, ends_sha256 of the nodes at which conversations end. A node at which very many end has its ids joined in
    many tasks, by ranges; the one task that hashes them, in order as the digest asks, reads long strings one by one."""
    order = ["owner", "depth", "conv_id"]
    ends = paths.select(F.col("end.owner").alias("owner"), F.col("end.depth").alias("depth"), "conv_id").repartitionByRange(*order).sortWithinPartitions(*order)
    lists = ends.mapInArrow(tidy(_lists(CHUNK)), "owner long, depth long, first long, ids string")
    return lists.repartition("owner", "depth").sortWithinPartitions("owner", "depth", "first").mapInArrow(tidy(_hashed), "owner long, depth long, ends_sha256 string")


def _suffix_sums(values: DataFrame) -> DataFrame:
    """values(owner, depth, leaves, saved) summed over depth and all greater depths of the owner, in spans of SPAN depths."""
    values = values.withColumn("span", F.floor(F.col("depth") / SPAN))
    later = values.where("span > 0").groupBy("owner", "span").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
    down = Window.partitionBy("owner").orderBy(F.desc("span"))
    later = later.select("owner", (F.col("span") - 1).alias("span"), F.sum("leaves").over(down).alias("_leaves"), F.sum("saved").over(down).alias("_saved"))
    within = Window.partitionBy("owner", "span").orderBy(F.desc("depth"))
    values = values.withColumn("leaves", F.sum("leaves").over(within)).withColumn("saved", F.sum("saved").over(within)).join(later, ["owner", "span"], "left")
    return values.select(*[c for c in values.columns if c not in ("span", "leaves", "saved", "_leaves", "_saved")], *((F.col(c) + F.coalesce(f"_{c}", F.lit(0))).alias(c) for c in ("leaves", "saved")))


def trie(turns: DataFrame, sizes: DataFrame) -> DataFrame:
    """The nodes of the prefix trie of turns(conv_id, pos, digest, n_bytes); sizes(conv_id, n) names every conversation, those
    without a turn too. Columns as in `prefix_trie`."""
    whole = sizes.agg(F.min("conv_id"), F.count(F.lit(1)), F.max("n")).first()
    first, n_convs, top = whole[0], whole[1], whole[2] or 0
    long = lambda x: F.lit(x).cast("long")
    rows = materialise(_chained(turns, top).withColumn("depth", F.col("pos") + 1).drop("pos"), "prefixes")
    nodes = materialise(rows.groupBy("depth", "prefix").agg(F.min("conv_id").alias("owner"), F.count(F.lit(1)).alias("n_convs"), F.min("n_bytes").alias("n_bytes")), "nodes")
    steps = rows.select("conv_id", "depth", "prefix").join(nodes.select("depth", "prefix", "owner"), ["depth", "prefix"]).select("conv_id", "depth", "owner")
    steps = materialise(steps.unionByName(sizes.select("conv_id", long(0).alias("depth"), long(first).alias("owner"))), "steps")
    discard(rows)
    step, other = F.struct("depth", "owner"), F.col("owner") != F.col("conv_id")
    paths = materialise(steps.groupBy("conv_id").agg(F.max(step).alias("end"), F.max(F.when(other, step)).alias("at")), "paths")
    owned = paths.where(F.col("end.owner") == F.col("conv_id")).select(F.col("conv_id").alias("owner"), F.col("end.depth").alias("end"), F.col("at.owner").alias("at_owner"), F.col("at.depth").alias("at_depth"))
    hung = owned.where("at_owner is not null").groupBy(F.col("at_owner").alias("owner"), F.col("at_depth").alias("end")).agg(F.count(F.lit(1)).alias("hung"))
    saved = nodes.groupBy("owner").agg(F.sum((F.col("n_convs") - 1) * F.col("n_bytes")).alias("saved"))
    totals = owned.join(hung, ["owner", "end"], "left").join(saved, "owner", "left")
    totals = totals.select(F.col("owner").alias("conv_id"), "at_depth", F.col("hung").isNull().cast("long").alias("leaf"), F.coalesce("saved", F.lit(0)).alias("saved"))
    above = steps.where(other).groupBy("conv_id", "owner").agg(F.max("depth").alias("depth"))
    gained = above.join(totals, "conv_id").groupBy("owner", "depth").agg(
        F.sum("leaf").alias("below_leaves"), F.sum("saved").alias("below_saved"), F.count(F.when(F.col("at_depth") == F.col("depth"), 1)).alias("hung"),
    )
    root = sizes.agg(long(0).alias("depth"), F.min("conv_id").alias("owner"), F.count(F.lit(1)).alias("n_convs"), long(0).alias("n_bytes")).where("owner is not null")
    full = nodes.select("depth", "owner", "n_convs", "n_bytes").unionByName(root).join(gained, ["owner", "depth"], "left").join(owned, "owner")
    goes_on = (F.col("depth") < F.col("end")).cast("long")
    full = full.withColumn("n_children", F.coalesce("hung", F.lit(0)) + goes_on)
    full = full.withColumn("leaves", (F.col("n_children") == 0).cast("long") + F.coalesce("below_leaves", F.lit(0)))
    full = full.withColumn("saved", (F.col("n_convs") - 1) * F.col("n_bytes") + F.coalesce("below_saved", F.lit(0)))
    parent = F.when(F.col("depth") == 0, F.lit(None)).when(F.col("depth") == F.col("at_depth") + 1, F.col("at_owner")).otherwise(F.col("owner"))
    full = _suffix_sums(full.select("owner", "depth", parent.cast("long").alias("parent_conv_id"), "n_convs", "n_children", "leaves", "saved"))
    full = full.join(_ends(paths), ["owner", "depth"], "left")
    nothing = F.lit(hashlib.sha256(b"").hexdigest())
    return full.select(F.col("owner").alias("conv_id"), "depth", "parent_conv_id", "n_convs", "n_children", F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"), F.coalesce("ends_sha256", nothing).alias("ends_sha256"))


def prefix_trie(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """The prefix trie of conversations, a row per node: conv_id (smallest member), depth, parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens, ends_sha256.

    Null roles and texts are empty; null turns come first; turns with equal numbers, repeated rows too, are turns of their own,
    in the order of the digest of role and text. Texts of any length count whole. Rows without a conversation id take no
    part. Other columns are not read, whatever their names. A table without conversations has no node, not even a root."""
    return trie(*ordered_turns(conversations, conv_col, turn_col, role_col, text_col))


def oracle() -> str:
    """op11 in DuckDB SQL, by comparing whole prefixes, for small tables."""
    crc = "list_reduce(list_prepend(4294967295::bigint, [ascii(x)::bigint FOR x IN string_split(c::varchar, '')]), lambda s, b: list_reduce(list_prepend(xor(s, b), [0::bigint, 0, 0, 0, 0, 0, 0, 0]), lambda x, y: xor(x >> 1, 3988292384::bigint * (x & 1))))"
    return f"""
WITH t AS (
  SELECT conv_id AS c, turn, {{'role': coalesce(role, ''), 'text': coalesce(text, '')}} AS t,
    sha256(strlen(coalesce(role, ''))::varchar || ':' || coalesce(role, '') || coalesce(text, '')) AS d
  FROM conversations WHERE conv_id IS NOT NULL),
o AS (SELECT c, list(t ORDER BY turn NULLS FIRST, d) AS own FROM t GROUP BY c),
h AS (SELECT c, own, xor({crc}, 4294967295::bigint) % 9 AS h FROM o),
r AS (SELECT h.c, list_concat(coalesce(b.own, [])[:h.h], h.own[h.h + 1:]) AS turns FROM h LEFT JOIN h b ON b.c = h.c - h.c % 5),
p AS (SELECT c, d, turns[:d] AS prefix, len(turns) = d AS ends FROM r, unnest(range(len(turns) + 1)) AS u(d)),
n AS (SELECT d, prefix, min(c) AS conv_id, count(*) AS n_convs, sha256(coalesce(string_agg(c::varchar, ',' ORDER BY c) FILTER (ends), '')) AS ends_sha256 FROM p GROUP BY d, prefix),
k AS (SELECT d - 1 AS d, prefix[:d - 1] AS prefix, count(*) AS n_children FROM n WHERE d > 0 GROUP BY ALL),
f AS (SELECT n.*, coalesce(n_children, 0) AS n_children, CASE WHEN n.d = 0 THEN 0 ELSE (n_convs - 1) * strlen(n.prefix[-1].text) END AS saved FROM n LEFT JOIN k USING (d, prefix)),
a AS (SELECT x.d, x.prefix, count(*) FILTER (y.n_children = 0) AS n_leaves, sum(y.saved) AS saved_tokens FROM f x JOIN f y ON y.d >= x.d AND y.prefix[:x.d] = x.prefix GROUP BY ALL)
SELECT f.conv_id, f.d AS depth, q.conv_id AS parent_conv_id, f.n_convs, f.n_children, a.n_leaves, a.saved_tokens::bigint AS saved_tokens, f.ends_sha256
FROM f JOIN a USING (d, prefix) LEFT JOIN f q ON q.d = f.d - 1 AND q.prefix = f.prefix[:f.d - 1]"""
