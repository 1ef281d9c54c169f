"""SimHash near-duplicates (op 7): fingerprints of word shingles, compared as vertical bit planes.

Distances are counted for 64 pairs at a time: the fingerprints of a sorted batch are turned into 64 bit planes, a plane is
xored with itself shifted by a lag, and carry-save counters of a few bits take up the differing planes. Words of the planes
in which every lane has gone past the radius are abandoned.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratafold.llm.common import by_units, connected_components, local_forest, materialise, split_hot, tidy

#: Bit blocks (first bit, bits) that cut a fingerprint in five. Fingerprints that differ in at most 3 bits agree on at least
#: two blocks, so the ten pairs of blocks lose no link, and a key has 25 or 26 bits.
BLOCKS = ((0, 13), (13, 13), (26, 13), (39, 13), (52, 12))
RADIUS = 3
_LOWER = bytes(range(256)).replace(bytes(range(65, 91)), bytes(range(97, 123)))


def shingle_fingerprint(text: str | None, width: int = 3, seed: int = 42) -> int:
    """Fingerprint of one text: a bit is set if it is set in over half of the shingles' XXH64 values. No words: 0."""
    from xxhash import xxh64_intdigest

    words = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not words:
        return 0
    if len(words) < width:
        words = [b" ".join(words)]
    else:
        words = list(map(b" ".join, zip(*(words[k:] for k in range(width)))))
    ones = np.zeros(64, np.int64)
    for at in range(0, len(words), 32768):
        part = words[at : at + 32768]
        h = np.fromiter((xxh64_intdigest(x, seed) for x in part), np.uint64, len(part))
        bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.uint16 if len(part) < 65536 else np.int64)
    return int(np.packbits(2 * ones > len(words), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """(id, fp): fp holds the 64 fingerprint bits as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            col = batch.column("_text")
            fps = np.fromiter((shingle_fingerprint(col[i].as_py()) for i in range(len(col))), np.uint64, len(col))
            yield pa.RecordBatch.from_arrays([batch.column("_id"), pa.array(fps.view(np.int64))], ["_id", "fp"])

    kind = docs.schema[id_col].dataType.simpleString()
    slim = docs.select(F.col(id_col).alias("_id"), F.col(text).alias("_text"))
    return slim.mapInArrow(tidy(run), f"_id {kind}, fp long").withColumnRenamed("_id", id_col)


def bit_planes(fps: np.ndarray) -> np.ndarray:
    """(64, words) planes: lane i of plane b is bit b of fingerprint i. Two spare words follow."""
    n = len(fps)
    lanes = -(-n // 64) * 64 + 128
    bits = np.zeros((64, lanes), np.uint8)
    bits[:, :n] = np.unpackbits(np.ascontiguousarray(fps).view(np.uint8).reshape(n, 8), axis=1, bitorder="little").T
    return np.packbits(bits, axis=1, bitorder="little").view(np.uint64)


def near_pairs(group: np.ndarray, fps: np.ndarray, radius: int = RADIUS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of rows of one group (rows sorted by group) whose fingerprints differ in at most `radius` bits."""
    n = len(fps)
    if n < 2:
        return
    ends = np.append(np.flatnonzero(group[1:] != group[:-1]), n - 1)
    later = ends[np.searchsorted(ends, np.arange(n))] - np.arange(n)  # rows of the group that follow
    planes = bit_planes(fps)
    later = np.concatenate([later, np.zeros(-n % 64, np.int64)]).reshape(-1, 64)
    most = later.max(axis=1)
    ones = ~np.uint64(0)
    digits = max(1, int(radius).bit_length())
    start = (1 << digits) - 1 - radius  # the counters overflow at radius + 1
    for lag in range(1, int(most.max()) + 1):
        at = np.flatnonzero(most >= lag)
        dead = ~np.packbits(later[at] >= lag, axis=1, bitorder="little").view(np.uint64)[:, 0]
        count = [np.full(len(at), ones if start >> d & 1 else 0, np.uint64) for d in range(digits)]
        q, r = divmod(lag, 64)
        for b in range(64):
            plane = planes[b]
            moved = plane[at + q] if not r else plane[at + q] >> np.uint64(r) | plane[np.minimum(at + q + 1, planes.shape[1] - 1)] << np.uint64(64 - r)
            carry = plane[at] ^ moved
            for d in range(digits):
                carry, count[d] = count[d] & carry, count[d] ^ carry
            dead |= carry
            if b % 4 == 3:
                alive = dead != ones
                if not alive.all():
                    at, dead, count = at[alive], dead[alive], [c[alive] for c in count]
                    if not len(at):
                        break
        if len(at):
            hit = np.unpackbits(~dead.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            word, lane = np.nonzero(hit)
            i = at[word] * 64 + lane
            yield i, i + lag


def _links(whole: pa.Table) -> Iterator[pa.RecordBatch]:
    keys = [whole.column(c).to_numpy() for c in ("key", "unit_i", "unit_j")]
    new = np.zeros(whole.num_rows, np.int64)
    new[1:] = np.any([k[1:] != k[:-1] for k in keys], axis=0)
    rep = whole.column("rep").to_numpy()
    a: list[np.ndarray] = []
    b: list[np.ndarray] = []
    held = 0
    for i, j in near_pairs(np.cumsum(new), whole.column("fp").to_numpy().view(np.uint64)):
        a.append(rep[i])
        b.append(rep[j])
        held += len(i)
        if held > 2_000_000:
            x, y = local_forest(np.concatenate(a), np.concatenate(b))
            a, b, held = [x], [y], len(x)
    if a:
        x, y = local_forest(np.concatenate(a), np.concatenate(b))
        if len(x):
            yield pa.RecordBatch.from_arrays([pa.array(x), pa.array(y)], ["a", "b"])


def _masks() -> list[list[int]]:
    """For each pair of blocks, four masks that share out the bits outside it (as signed longs)."""
    out = []
    for i in range(5):
        for j in range(i):
            own = {b for k in (i, j) for b in range(BLOCKS[k][0], BLOCKS[k][0] + BLOCKS[k][1])}
            rest = [b for b in range(64) if b not in own]
            out.append([int(np.array(sum(1 << b for b in rest[k::4]), np.uint64).view(np.int64)) for k in range(4)])
    return out


def _rekey(met: DataFrame, cap: int) -> DataFrame:
    """Keys with over `cap` fingerprints are taken further: the bits outside a key's blocks fall in four parts, and
    fingerprints that differ in at most three bits agree on one of them. Their rows move to keys made of the old key and a
    part, four for each; that loses no link either. Keys are hashed; keys that fall together are compared as one."""
    hot = materialise(met.groupBy("key").agg(F.count(F.lit(1)).alias("m")).where(F.col("m") > cap).select("key"), "hot-keys")
    rest = met.join(hot, "key", "left_anti")
    parts = F.array(*[F.array(*[F.lit(m).cast("long") for m in masks]) for masks in _masks()])
    mine = F.element_at(parts, F.shiftright("key", 32).cast("int") + 1)
    finer = F.transform(mine, lambda m, k: F.xxhash64("key", k, F.col("fp").bitwiseAND(m)))
    return rest.unionByName(met.join(hot, "key", "left_semi").select("fp", "rep", F.explode(finer).alias("key")))


def near_duplicates(docs: DataFrame, text: str = "text", id_col: str = "doc_id", cap: int = 2048) -> DataFrame:
    """One row per document: id, fingerprint (16 hex digits), component_id (smallest id reachable over links of at most
    three differing bits).

    Equal fingerprints are folded to their smallest id first, so copies never meet as pairs. The distinct fingerprints meet
    under ten keys of two bit blocks each, which loses no link; keys with over `cap` fingerprints are replaced by finer ones,
    and what is still over `cap` then is cut into chunks that meet pairwise on different tasks. A task returns a spanning forest of its links, not the links. Null and wordless texts
    have fingerprint zero and link like any other. A null id stays a component of its own (null). Repeated rows give
    repeated rows; other columns are not read; an empty table gives an empty table."""
    made = materialise(fingerprints(docs, text, id_col).withColumnRenamed(id_col, "id"), "fingerprints")
    folded = made.where("id is not null").groupBy("fp").agg(F.min("id").cast("long").alias("rep"))
    folded = materialise(folded, "folded")
    cut = lambda k: F.shiftrightunsigned("fp", BLOCKS[k][0]).bitwiseAND(F.lit((1 << BLOCKS[k][1]) - 1))
    pairs = [(i, j) for i in range(5) for j in range(i)]
    keys = F.array(*[F.lit(n << 32).cast("long") + F.shiftleft(cut(i), 13) + cut(j) for n, (i, j) in enumerate(pairs)])
    met = split_hot(_rekey(folded.select("fp", "rep", F.explode(keys).alias("key")), cap), ["key"], "rep", cap)
    links = by_units(met.select("key", "unit_i", "unit_j", "fp", "rep"), ["key", "unit_i", "unit_j"], _links, "a long, b long")
    roots = connected_components(links, "simhash")
    by_fp = folded.join(roots, folded["rep"] == roots["node"], "left").select("fp", F.coalesce("component", "rep").alias("component_id"))
    out = made.join(by_fp, "fp", "left")
    return out.select(F.col("id").alias(id_col), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), F.when(F.col("id").isNotNull(), F.col("component_id")).alias("component_id"))
