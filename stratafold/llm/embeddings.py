"""Near-duplicate embeddings (op 3): cross-polytope hashing after fast Hadamard rotations, probed at several buckets, with
every candidate pair verified in double precision."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratafold.llm.common import by_units, connected_components, local_forest, materialise, split_hot, tidy

#: Hash tables, cross-polytope functions per table, and probes per table beside the own bucket (the second choice of each
#: function). Two vectors at a cosine of exactly 0.95 are found with a probability of 0.99 at 64 dimensions and 0.96 at
#: 1,024 (a test measures it); the 2 million buckets of a table stay small for billions of vectors.
TABLES, FUNCTIONS, SEED = 8, 3, 7
#: Rows of a unit compared at once with the rows that follow, and pairs looked at together. They bound memory only.
TILE, PAIRS = 128, 50_000
#: Bit of a key at which the number of its table stands; below it stands a bucket code, which is folded to so many bits
#: (two buckets that fall together are compared as one, which loses nothing and, as pairs are verified, adds nothing).
TABLE_AT = 42


def hadamard(x: np.ndarray) -> np.ndarray:
    """Walsh-Hadamard transform of the rows; their length is a power of two."""
    n, d = x.shape
    h = 1
    while h < d:
        y = x.reshape(n, d // (2 * h), 2, h)
        x = np.stack([y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]], axis=2).reshape(n, d)
        h *= 2
    return x


@lru_cache(maxsize=256)
def _signs(d: int, table: int, function: int) -> np.ndarray:
    return np.random.default_rng([SEED, d, table, function]).choice([-1.0, 1.0], (3, d))


def hash_codes(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(home, probes) bucket codes of unit vectors: (n, TABLES) and (n, TABLES, FUNCTIONS)."""
    n, dim = unit.shape
    d = 1 << max(1, dim - 1).bit_length()
    padded = np.zeros((n, d))
    padded[:, :dim] = unit
    home = np.zeros((n, TABLES), np.int64)
    probes = np.zeros((n, TABLES, FUNCTIONS), np.int64)
    rows = np.arange(n)
    for t in range(TABLES):
        best, second = [], []
        for f in range(FUNCTIONS):
            x = padded
            for signs in _signs(d, t, f):
                x = hadamard(x * signs) / np.sqrt(d)
            size = np.abs(x)
            for out in (best, second):
                at = size.argmax(axis=1)
                out.append(2 * at + (x[rows, at] < 0))
                size[rows, at] = -1
        code = lambda parts: sum(p * (2 * d) ** k for k, p in enumerate(parts))
        home[:, t] = code(best)
        for f in range(FUNCTIONS):
            probes[:, t, f] = code([*best[:f], second[f], *best[f + 1 :]])
    return home, probes


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        col = batch.column("vec")
        sizes = np.diff(col.offsets.to_numpy())
        flat = np.asarray(col.flatten().to_numpy(zero_copy_only=False), np.float64)
        starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        for dim in np.unique(sizes):
            at = np.flatnonzero(sizes == dim)
            x = flat[starts[at][:, None] + np.arange(dim)]
            home, probes = hash_codes(x / np.linalg.norm(x, axis=1)[:, None])
            blob = lambda a: pa.array([r.tobytes() for r in a], pa.binary())
            keys = (np.int64(dim % (1 << 15)) << 48) + (np.arange(TABLES, dtype=np.int64) << TABLE_AT)
            fold = (1 << TABLE_AT) - 1
            all_keys = np.concatenate([(home & fold) + keys, ((probes & fold) + keys[None, :, None]).reshape(len(at), -1)], axis=1)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(at) + 1, dtype=np.int32) * all_keys.shape[1]), pa.array(all_keys.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column("id").take(pa.array(at)), batch.column("copies").take(pa.array(at)), blob(x), blob(home), blob(probes.reshape(len(at), -1)), lists], ["id", "copies", "vec", "home", "probes", "keys"])


def _packed(column: pa.ChunkedArray) -> Callable[[int, int, type], np.ndarray]:
    """A view of the values that rows lo to hi of a binary column hold, end to end."""
    flat = pa.concat_arrays(column.chunks).cast(pa.binary())
    offsets = np.frombuffer(flat.buffers()[1], np.int32)[flat.offset : flat.offset + len(flat) + 1]
    data = flat.buffers()[2]
    return lambda lo, hi, kind: np.frombuffer(data, kind, (offsets[hi] - offsets[lo]) // 8, offsets[lo])


def _verify(least: float):
    def work(whole: pa.Table) -> Iterator[pa.RecordBatch]:
        get = lambda c: whole.column(c).to_numpy()
        key, ui, uj, ids, copies, chunk, role = (get(c) for c in ("key", "unit_i", "unit_j", "id", "copies", "chunk", "role"))
        vec, home_codes, probe_codes = (_packed(whole.column(c)) for c in ("vec", "home", "probes"))
        change = np.flatnonzero((key[1:] != key[:-1]) | (ui[1:] != ui[:-1]) | (uj[1:] != uj[:-1])) + 1
        bounds = [0, *change.tolist(), len(key)]
        nodes, node = np.unique(ids, return_inverse=True)
        links = np.zeros(len(nodes), np.int64)
        forest: list[tuple[np.ndarray, np.ndarray]] = []  # node numbers keep the order of ids
        held = 0
        for lo, hi in zip(bounds, bounds[1:]):
            if hi - lo < 2 or role[lo:hi].all():
                continue
            x = vec(lo, hi, np.float64).reshape(hi - lo, -1)
            home = home_codes(lo, hi, np.int64).reshape(hi - lo, TABLES)
            probes = probe_codes(lo, hi, np.int64).reshape(hi - lo, TABLES, FUNCTIONS)
            size = np.linalg.norm(x, axis=1)
            table = int(key[lo] >> TABLE_AT) & 63
            for top in range(0, hi - lo, TILE):
                part = slice(top, min(top + TILE, hi - lo))
                cos = (x[part] @ x[top:].T) / size[part][:, None] / size[top:][None, :]
                i, j = np.nonzero(np.triu(cos >= least - 1e-9, 1))
                i, j = i + lo + top, j + lo + top
                # a pair counts in the unit of its two chunks, if one of the two is at home in the bucket
                own = (np.minimum(chunk[i], chunk[j]) == ui[lo]) & (np.maximum(chunk[i], chunk[j]) == uj[lo]) & ((role[i] == 0) | (role[j] == 0))
                i, j = i[own], j[own]
                for at in range(0, len(i), PAIRS):
                    p, q = i[at : at + PAIRS], j[at : at + PAIRS]
                    swap = ids[p] > ids[q]
                    p, q = np.where(swap, q, p), np.where(swap, p, q)
                    sure = np.einsum("ij,ij->i", x[p - lo], x[q - lo]) / size[p - lo] / size[q - lo] >= least
                    p, q = p[sure], q[sure]
                    hp, hq, pp, pq = home[p - lo], home[q - lo], probes[p - lo], probes[q - lo]
                    ways = np.stack([hp == hq, (pp == hq[:, :, None]).any(axis=2), (pq == hp[:, :, None]).any(axis=2)], axis=2)
                    first = ways.reshape(len(p), -1).argmax(axis=1)  # the first of all the ways in which the pair is found
                    here = first == 3 * table + np.where(role[p] == 1, 1, np.where(role[q] == 1, 2, 0))
                    p, q = p[here], q[here]
                    np.add.at(links, node[p], copies[q])
                    np.add.at(links, node[q], copies[p])
                    forest.append((node[p], node[q]))
                    held += len(p)
                    if held > 4 * PAIRS:
                        forest = [local_forest(*map(np.concatenate, zip(*forest)))]
                        held = 0
        met = np.flatnonzero(links)
        if not len(met):
            return
        x, y = local_forest(*map(np.concatenate, zip(*forest)))
        zero = np.zeros(len(x), np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([nodes[met], nodes[x]])), pa.array(np.concatenate([nodes[met], nodes[y]])), pa.array(np.concatenate([links[met], zero]))], ["a", "b", "links"])

    return work


def near_vectors(vectors: DataFrame, vec_col: str = "embedding", id_col: str = "vec_id", least: float = 0.95, cap: int = 1024) -> DataFrame:
    """One row per vector: id, n_links (other vectors at a cosine of at least `least`), component_id (smallest id reachable
    over links), kept (id = component_id).

    Equal vectors are folded first and counted as often as they occur. The distinct ones meet as (bucket, id) rows; only
    those that share a bucket get their vectors attached. Buckets of over `cap` rows are cut into chunks that meet pairwise
    on different tasks. A pair that meets in several tables counts where it meets first, so tasks return link counts and a
    spanning forest, never the pairs. No bucket is capped. Null, zero and non-finite vectors, and vectors with a null
    component or a null id, link with nothing and are their own component; vectors of different lengths never link.
    Repeated rows count as vectors of their own with the same id, and so do different vectors with one id. Other columns are not read, whatever their names; an empty
    table gives an empty table."""
    v = F.col("vec")
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("vec"))
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    sound = F.coalesce(F.col("id").isNotNull() & v.isNotNull() & finite & F.exists(v, lambda x: x != 0), F.lit(False))
    rows = rows.withColumn("vec", F.when(sound, v))
    folded = rows.where("vec is not null").groupBy("vec").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("copies"))
    folded = materialise(folded.withColumn("no", F.monotonically_increasing_id()), "vectors")  # an id may have several vectors
    kind = "id long, copies long, vec binary, home binary, probes binary, keys array<long>"
    hashed = materialise(folded.select(F.col("no").alias("id"), "copies", "vec").mapInArrow(tidy(_hashed), kind), "hashed")
    met = hashed.select("id", F.posexplode("keys").alias("no", "key")).select("id", "key", (F.col("no") >= TABLES).cast("int").alias("role"))
    met = split_hot(met, ["key"], "id", cap).join(hashed.drop("keys"), "id")
    found = by_units(met.select("key", "unit_i", "unit_j", "id", "copies", "chunk", "role", "vec", "home", "probes"), ["key", "unit_i", "unit_j"], _verify(least), "a long, b long, links long", 32768)
    found = materialise(found, "verified")
    links = found.groupBy("a").agg(F.sum("links").alias("links"))
    roots = connected_components(found.select("a", "b"), "vectors-components")
    classes = folded.join(links, folded["no"] == links["a"], "left").join(roots, folded["no"] == roots["node"], "left")
    classes = materialise(classes.select("vec", "id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "no").alias("root")), "rooted")
    classes = classes.join(classes.groupBy("root").agg(F.min("id").alias("component_id")), "root").select("vec", "n_links", "component_id")
    out = rows.join(materialise(classes, "classes"), "vec", "left").select("id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "id").alias("component_id"))
    return out.withColumn("kept", F.col("id").eqNullSafe(F.col("component_id"))).withColumnRenamed("id", id_col)


def oracle(least: float = 0.95) -> str:
    """The same by brute force in DuckDB SQL, for small tables."""
    return f"""
WITH RECURSIVE v AS (
  SELECT vec_id, embedding::double[] AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0 AND len([x FOR x IN embedding IF x <> 0]) > 0),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) WHERE list_cosine_similarity(a.e, b.e) >= {least}),
reach(a, b) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
root AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a),
n AS (SELECT a, count(*) AS n_links FROM links GROUP BY a)
SELECT vec_id, coalesce(n_links, 0)::bigint AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings LEFT JOIN root ON vec_id = root.a LEFT JOIN n ON vec_id = n.a"""
