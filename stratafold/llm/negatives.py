"""Hard-negative mining (op 13): all scores between anchors and rows as a block matrix product.

Vectors become integers and lie in blocks of rows, cut again into chunks of dimensions. A grid of (anchor block, share of the
row blocks, chunk) cells makes partial score tiles; a shuffle adds the tiles of the chunks in int64; the task that has a whole
tile takes from it what may still count and drops it. Two products are made, each over other tiles: first those in which
labels may be equal, for the positives; then all in which labels may differ, for the negatives in the windows below them. As
blocks are sorted by label, few tiles fall into both.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratafold.llm.common import materialise, tidy

#: Anchors and rows of a block at most, dimensions of a chunk, and row blocks that a cell of the grid meets on average.
ANCHORS, ROWS, CHUNK, SHARE = 256, 1024, 32, 8
#: Anchor blocks are at most about so many; with more anchors they grow. Each row block names the anchor blocks it meets.
MOST_BLOCKS = 4096
#: Below it a product of doubles is exact; above it the chunk is multiplied in int64.
EXACT = float(1 << 53)
_BLOCK = "block long, dim long, chunk int, low long, high long, n int, ids binary, labels binary, marks binary, vals binary"


BLOCK_SCHEMA = pa.schema([("block", pa.int64()), ("dim", pa.int64()), ("chunk", pa.int32()), ("low", pa.int64()), ("high", pa.int64()), ("n", pa.int32()), *((c, pa.binary()) for c in ("ids", "labels", "marks", "vals"))])
_TILE = "anchor_block long, block long, chunk int, n int, a_n int, ids binary, labels binary, marks binary, a_ids binary, a_labels binary, a_marks binary, a_wins binary, tile binary"
TILE_SCHEMA = pa.schema([("anchor_block", pa.int64()), ("block", pa.int64()), ("chunk", pa.int32()), ("n", pa.int32()), ("a_n", pa.int32()), *((c, pa.binary()) for c in ("ids", "labels", "marks", "a_ids", "a_labels", "a_marks", "a_wins", "tile"))])
_FOUND = ("anchor_block", "place", "anchor_id", "anchor_mark", "positive_id", "positive_mark", "positive_score", "id", "mark", "score")


def _int64(raw: bytes | None) -> np.ndarray:
    return np.frombuffer(raw or b"", "<i8")


def _cut(size: int, scale: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows sorted by (dim, label, id, mark) as blocks of at most `size` vectors of one length, a row for each chunk. Equal
    rows follow each other and count once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        block = (context.partitionId() if context else 0) << 32
        held: list[tuple[int, int, int, np.ndarray]] = []
        dim, last = -1, None

        def flush() -> pa.RecordBatch:
            ids, labels, marks = (np.array([h[k] for h in held], "<i8") for k in range(3))
            vals = np.floor(scale * np.stack([h[3] for h in held])) if dim else np.zeros((len(held), 0))
            rows = [
                {"block": block, "dim": dim, "chunk": k, "low": int(labels.min()), "high": int(labels.max()), "n": len(held), "ids": ids.tobytes(), "labels": labels.tobytes(), "marks": marks.tobytes(), "vals": vals[:, k * CHUNK : (k + 1) * CHUNK].astype("<i8").tobytes()}
                for k in range(max(1, -(-dim // CHUNK)))
            ]
            return pa.RecordBatch.from_pylist(rows, BLOCK_SCHEMA)

        for batch in batches:
            col = batch.column("vec")
            flat, offsets = np.asarray(col.flatten().to_numpy(zero_copy_only=False), np.float64), col.offsets.to_numpy()
            offsets = offsets - offsets[0]
            for i, key in enumerate(zip(*(batch.column(c).to_pylist() for c in ("id", "label", "mark")))):
                size_i = int(offsets[i + 1] - offsets[i])
                if (size_i, key) == last:
                    continue
                last = (size_i, key)
                if held and (size_i != dim or len(held) >= size):
                    yield flush()
                    held.clear()
                    block += 1
                dim = size_i
                held.append((*key, flat[offsets[i] : offsets[i + 1]]))
        if held:
            yield flush()

    return run


def _blocks(rows: DataFrame, size: int, parts: int | None, scale: int, name: str) -> DataFrame:
    order = ["dim", "label", "id", "mark"]
    dealt = rows.repartitionByRange(parts, *order) if parts else rows.repartitionByRange(*order)
    return materialise(dealt.sortWithinPartitions(*order).mapInArrow(tidy(_cut(size, scale)), _BLOCK), name)


def _partial_tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cells of the grid, the anchor block first and then its row blocks: a partial tile for each of these. What names the
    anchors and rows of a tile goes with its first chunk only."""
    cell, anchors, about, top = None, np.zeros((0, 0)), {}, 0.0
    names = ("n", "ids", "labels", "marks", "wins")
    for batch in batches:
        for r in batch.to_pylist():
            key = (r["anchor_block"], r["share"], r["chunk"])
            vals = _int64(r["vals"]).reshape(r["n"], -1)
            most = float(np.abs(vals).max()) if vals.size else 0.0
            if r["side"] == 0:
                cell, anchors, top, about = key, vals, most, {c: r[c] for c in names}
                continue
            if key != cell:  # no anchor block of that name
                continue
            exact = most * top * max(1, vals.shape[1]) < EXACT
            tile = (anchors.astype(np.float64) @ vals.T.astype(np.float64)).astype("<i8") if exact else anchors @ vals.T
            out = {"anchor_block": key[0], "block": r["block"], "chunk": key[2], "n": r["n"], "tile": np.ascontiguousarray(tile, "<i8").tobytes()}
            if key[2] == 0:
                out |= {c: r[c] for c in names[1:4]} | {f"a_{c}": about[c] for c in names}
            yield pa.RecordBatch.from_pylist([out], TILE_SCHEMA)


TILE_SCHEMA = pa.schema([("anchor_block", pa.int64()), ("block", pa.int64()), ("chunk", pa.int32()), ("n", pa.int32()), ("a_n", pa.int32()), *((c, pa.binary()) for c in ("ids", "labels", "marks", "a_ids", "a_labels", "a_marks", "a_wins", "tile"))])
_TILE = "anchor_block long, block long, chunk int, n int, a_n int, ids binary, labels binary, marks binary, a_ids binary, a_labels binary, a_marks binary, a_wins binary, tile binary"

class _Best:
    """The best `k` (score, id, mark) of each line (an anchor, or an anchor and one of its positives), tile after tile."""

    def __init__(self, lines: int, k: int):
        self.k = k
        self.line, self.score, self.id, self.mark = (np.zeros(0, np.int64) for _ in range(4))
        self.least = np.full(lines, np.iinfo(np.int64).min)  # a line's k-th score, from when it has so many

    def add(self, line: np.ndarray, score: np.ndarray, ids: np.ndarray, marks: np.ndarray) -> None:
        keep = score >= self.least[line]
        if not keep.any():
            return
        line, score, ids, marks = (np.concatenate([old, new[keep]]) for old, new in zip((self.line, self.score, self.id, self.mark), (line, score, ids, marks)))
        order = np.lexsort((marks, ids, ~score, line))
        line = line[order]
        start = np.flatnonzero(np.concatenate([[True], line[1:] != line[:-1]]))
        rank = np.arange(len(line)) - np.repeat(start, np.diff([*start, len(line)]))
        order, line, rank = order[rank < self.k], line[rank < self.k], rank[rank < self.k]
        self.line, self.score, self.id, self.mark = line, score[order], ids[order], marks[order]
        self.least[line[rank == self.k - 1]] = self.score[rank == self.k - 1]


def _windows(raw: bytes | None, anchors: int) -> np.ndarray:
    """(anchor in block, score, id, mark) of the positives, a row each."""
    return _int64(raw).reshape(-1, 4)


def _reduce(k: int, low: int, high: int, negatives: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Partial tiles sorted by (anchor block, row block): their sums, and of these the best k for each line. Lines are anchors
    (candidates have the anchor's label), or, for negatives, positives (candidates have another label and a score from
    low / high of the positive's score up to that). A task returns k rows at most for each line of an anchor block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: list = [None, None]  # anchor block, row block
        tile, names, about, best = None, {}, {}, None

        def close_tile() -> None:
            if tile is None:
                return
            ids, labels, marks = (_int64(names[c]) for c in ("ids", "labels", "marks"))
            a_ids, a_labels, a_marks = (_int64(about[c]) for c in ("a_ids", "a_labels", "a_marks"))
            scores = tile.reshape(len(a_ids), len(ids))
            same = a_labels[:, None] == labels[None, :]
            if negatives:
                w = _windows(about["a_wins"], len(a_ids))
                for at in range(0, len(w), 64):  # bounds memory
                    part = w[at : at + 64]
                    top = part[:, 1]
                    floor = low * (top // high) - (-low * (top % high)) // high  # low * top / high, rounded up
                    s = scores[part[:, 0]]
                    line, j = np.nonzero(~same[part[:, 0]] & (s <= top[:, None]) & (s >= np.maximum(floor, best.least[at : at + 64])[:, None]))
                    best.add(line + at, s[line, j], ids[j], marks[j])
            else:
                other = (a_ids[:, None] != ids[None, :]) | (a_marks[:, None] != marks[None, :])
                line, j = np.nonzero(same & other & (scores >= best.least[:, None]))
                best.add(line, scores[line, j], ids[j], marks[j])

        def close_block() -> pa.RecordBatch | None:
            if best is None or not len(best.line):
                return None
            a_ids, a_marks = (_int64(about[c]) for c in ("a_ids", "a_marks"))
            n = len(best.line)
            out = {"anchor_block": np.full(n, now[0], np.int64)}
            if negatives:
                w = _windows(about["a_wins"], len(a_ids))[best.line]
                out |= {"place": w[:, 0], "anchor_id": a_ids[w[:, 0]], "anchor_mark": a_marks[w[:, 0]], "positive_id": w[:, 2], "positive_mark": w[:, 3], "positive_score": w[:, 1]}
            else:
                none = np.zeros(n, np.int64)
                out |= {"place": best.line, "anchor_id": a_ids[best.line], "anchor_mark": a_marks[best.line], "positive_id": none, "positive_mark": none, "positive_score": none}
            out |= {"id": best.id, "mark": best.mark, "score": best.score}
            return pa.RecordBatch.from_pydict({c: pa.array(x, pa.int64()) for c, x in out.items()})

        for batch in batches:
            for i in range(batch.num_rows):
                get = lambda c: batch.column(c)[i].as_py()  # noqa: B023, E731
                part = _int64(get("tile"))
                if [get("anchor_block"), get("block")] == now:
                    tile = tile + part
                    continue
                close_tile()
                if get("anchor_block") != now[0]:
                    if (out := close_block()) is not None:
                        yield out
                    about = {c: get(c) for c in ("a_n", "a_ids", "a_labels", "a_marks", "a_wins")}
                    best = _Best(len(_int64(about["a_wins"])) // 4 if negatives else about["a_n"], k)
                now = [get("anchor_block"), get("block")]
                tile, names = part, {c: get(c) for c in ("ids", "labels", "marks")}
        close_tile()
        if (out := close_block()) is not None:
            yield out

    return run


def _product(anchors: DataFrame, rows: DataFrame, met: str, shares: int, work: Callable, key: list[str], k: int) -> DataFrame:
    """The best k rows for each key. anchors: blocks with `wins`; rows: blocks with an array `met` of the anchor blocks that
    each meets. Adds rank."""
    cols = ["anchor_block", "share", "chunk", "side", "block", "n", "ids", "labels", "marks", "wins", "vals"]
    left = anchors.withColumn("share", F.explode(F.sequence(F.lit(0), F.lit(shares - 1)))).withColumn("side", F.lit(0)).withColumn("anchor_block", F.col("block"))
    right = rows.withColumn("anchor_block", F.explode(met)).withColumn("share", F.pmod(F.xxhash64("block"), F.lit(shares)).cast("int")).withColumn("side", F.lit(1)).withColumn("wins", F.lit(None).cast("binary"))
    cells = left.select(*cols).unionByName(right.select(*cols))
    grid = ["anchor_block", "share", "chunk"]
    tiles = cells.repartition(*grid).sortWithinPartitions(*grid, "side").mapInArrow(tidy(_partial_tiles), _TILE)
    tiles = tiles.repartition("anchor_block", "block").sortWithinPartitions("anchor_block", "block", "chunk")
    found = tiles.mapInArrow(tidy(work), ", ".join(f"{c} long" for c in _FOUND))
    best = Window.partitionBy(*key).orderBy(F.desc("score"), "id", "mark")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def hard_negatives(vectors: DataFrame, anchor: Column, vec_col: str = "embedding", id_col: str = "vec_id", label: Column | str = "label", positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100, scale: int = 256) -> DataFrame:
    """For each anchor row and each of its first `positives` other rows of one label (by integer inner product, highest first,
    ties by smaller id) the first `negatives` rows of another label whose score is at most the positive's and at least
    low / high of it: anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    `anchor` and `label` are columns of `vectors`. A component x counts as floor(scale * x). Rows with a null id, label or
    vector or with a null or non-finite component take no part, nor do vectors whose scaled squared length passes 2**62, as
    their scores would not fit a long. Equal rows (id, label, vector) count once; rows with one id and different vectors or
    labels are different rows, told apart by a hash. Vectors of different lengths have no score. Anchors without positives,
    and positives without a row in their window, give no row; an empty table gives an empty table.

    The work is anchors x rows x dimensions, as every pair has to be scored; it is spread over tiles of ANCHORS x ROWS scores.
    One row for each anchor block (at most about MOST_BLOCKS) reaches the driver."""
    v = F.col("vec")
    label = F.col(label) if isinstance(label, str) else label
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), label.cast("long").alias("label"), F.col(vec_col).cast("array<double>").alias("vec"), F.coalesce(anchor, F.lit(False)).alias("anchor"))
    sound = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    fits = F.aggregate(v, F.lit(0.0), lambda s, x: s + F.floor(scale * x).cast("double") * F.floor(scale * x).cast("double")) <= float(1 << 62)
    rows = rows.where(F.col("id").isNotNull() & F.col("label").isNotNull() & v.isNotNull() & sound & fits)
    rows = rows.withColumn("dim", F.size("vec")).withColumn("mark", F.xxhash64("vec"))
    n_anchors = rows.where("anchor").count()
    most = max(ANCHORS, -(-2 * n_anchors // MOST_BLOCKS))
    a = _blocks(rows.where("anchor"), most, max(1, -(-n_anchors // most)), scale, "anchor-blocks")
    r = _blocks(rows, ROWS, None, scale, "row-blocks")
    known = [tuple(x) for x in a.where("chunk = 0").select("block", "dim", "low", "high").collect()]
    shares = max(1, -(-r.where("chunk = 0").count() // SHARE))

    def meets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, dim, lo, hi = (np.array(x, np.int64) for x in zip(*known)) if known else (np.zeros(0, np.int64),) * 4
        for batch in batches:
            same, other = [], []
            for d, x, y in zip(*(batch.column(c).to_pylist() for c in ("dim", "low", "high"))):
                same.append(block[(dim == d) & (lo <= y) & (hi >= x)])
                other.append(block[(dim == d) & ~((lo == hi) & (lo == x) & (x == y))])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(same, pa.list_(pa.int64())), pa.array(other, pa.list_(pa.int64()))], [*batch.schema.names, "same", "other"])

    r = r.mapInArrow(meets, f"{_BLOCK}, same array<long>, other array<long>")
    first = _product(a.withColumn("wins", F.lit(None).cast("binary")), r, "same", shares, _reduce(positives, low, high, False), ["anchor_id", "anchor_mark", "anchor_block", "place"], positives)
    first = materialise(first, "positives")
    wins = first.groupBy(F.col("anchor_block").alias("block")).agg(F.sort_array(F.collect_list(F.array("place", "score", "id", "mark"))).alias("wins"))

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("block"), pa.array([np.array(x, "<i8").tobytes() for x in batch.column("wins").to_pylist()], pa.binary())], ["block", "wins"])

    a = a.join(wins.mapInArrow(packed, "block long, wins binary"), "block")
    second = _product(a, r, "other", shares, _reduce(negatives, low, high, True), ["anchor_id", "anchor_mark", "anchor_block", "place", "positive_id", "positive_mark"], negatives)
    return second.select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


def oracle() -> str:
    """op13 by brute force in DuckDB SQL, for small tables."""
    return """
WITH v AS (
  SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, [floor(256 * x::double) FOR x IN embedding] AS e
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (
  SELECT a.id AS anchor_id, b.id AS id, a.label = b.label AS same, coalesce(list_sum([z[1] * z[2] FOR z IN list_zip(a.e, b.e)]), 0)::bigint AS score
  FROM v a JOIN v b ON a.id <> b.id AND len(a.e) = len(b.e) WHERE a.id % 100 = 0),
p AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5),
n AS (
  SELECT p.*, s.id AS negative_id, s.score AS negative_score, row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY s.score DESC, s.id)::int AS rank
  FROM p JOIN s USING (anchor_id) WHERE NOT same AND 80 * positive_score <= 100 * score AND score <= positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 5"""
