"""SimHash and embedding near-duplicates against brute force."""

import numpy as np
import pytest
from xxhash import xxh64_intdigest

import corpus_pipeline
from stratafold.llm.common import connected_components, shared_dir
from stratafold.llm.embeddings import near_vectors
from stratafold.llm.simhash import near_duplicates, near_pairs, shingle_fingerprint

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def fingerprint(text):
    """The definition, bit by bit."""
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in low.replace("\t", " ").replace("\n", " ").replace("\r", " ").replace("\x0b", " ").replace("\x0c", " ").split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words)] if len(words) < 3 else [" ".join(words[i : i + 3]) for i in range(len(words) - 2)]
    hs = [xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def components(ids, linked):
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in linked:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


@pytest.mark.parametrize("text", [None, "", " \n", "One", "one TWO", "a b c", "Ä b\tc\nd e f g", "x " * 70000])
def test_fingerprint(text):
    assert shingle_fingerprint(text) == fingerprint(text)


@pytest.mark.parametrize("groups", [1, 3, 400])
def test_bit_sliced_pairs(groups):
    rng = np.random.default_rng(groups)
    base = rng.integers(0, 2**63, 120, dtype=np.uint64)
    flips = [np.uint64(sum(1 << int(b) for b in rng.choice(64, k, replace=False))) for k in (1, 2, 3, 4, 5)]
    fps = np.concatenate([base, *[base[:60] ^ f for f in flips]])
    group = np.sort(rng.integers(0, groups, len(fps)))
    got = {p for i, j in near_pairs(group, fps) for p in zip(i.tolist(), j.tolist())}
    want = {(i, j) for i in range(len(fps)) for j in range(i + 1, len(fps)) if group[i] == group[j] and int(fps[i] ^ fps[j]).bit_count() <= 3}
    assert got == want


def test_near_duplicates_match_brute_force(spark):
    rng = np.random.default_rng(5)
    words = [f"w{i}" for i in range(400)]
    texts = {}
    for i in range(0, 120, 4):
        w = list(rng.choice(words, 900))
        texts[i], texts[i + 1] = " ".join(w), " ".join(w)
        w[-1] = "changed"
        texts[i + 2] = " ".join(w)
        texts[i + 3] = " ".join(rng.choice(words, 3))
    texts |= {200: None, 201: "", 202: "  ", 203: "one"}
    rows = [(k, t, "en", "s", 1) for k, t in texts.items()] + [(None, "one", None, None, None), (203, "one", "en", "s", 1)]
    df = near_duplicates(spark.createDataFrame(rows, DOCS), cap=8)
    got = sorted(map(tuple, df.collect()), key=str)
    fp = {k: fingerprint(t) for k, t in texts.items()}
    links = [(a, b) for a in fp for b in fp if a < b and (fp[a] ^ fp[b]).bit_count() <= 3]
    root = components(fp, links)
    want = sorted([(k, f"{fp[k]:016x}", root[k]) for k in fp] + [(203, f"{fp[203]:016x}", root[203]), (None, f"{fp[203]:016x}", None)], key=str)
    assert got == want
    assert root[202] == 200 and any(fp[a] != fp[b] for a, b in links)


def test_dedup_stage_tells_rows_with_one_id_apart(spark):
    rng = np.random.default_rng(8)
    x, y, z, u, v = (" ".join(rng.choice([f"w{i}" for i in range(400)], 300)) for _ in range(5))
    rows = [(1, x), (2, x), (2, y), (3, z), (3, u), (4, u), (5, v), (5, v), (None, v), (None, v)]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], DOCS)
    got = sorted(((r.doc_id, r.text) for r in corpus_pipeline.drop_near_duplicates(spark, docs, "").collect()), key=str)
    assert got == sorted([(1, x), (2, y), (3, z), (3, u), (5, v), (None, v), (None, v)], key=str)


def test_near_duplicates_of_nothing(spark):
    assert near_duplicates(spark.createDataFrame([], DOCS)).count() == 0


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 160)] + [(5, 5)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(1, 61)}, **{i: 100 for i in range(101, 160)}}
    assert shared_dir(spark)


def test_vectors_match_brute_force(spark):
    rng = np.random.default_rng(1)
    base = rng.normal(size=(150, 24))
    near = base[:60] + 0.02 * rng.normal(size=(60, 24))
    hot = base[0] + 0.01 * rng.normal(size=(90, 24))
    x = np.concatenate([base, near, hot, 3.0 * base[:5]]).astype(np.float32)
    rows = [(i, [float(v) for v in r], 0) for i, r in enumerate(x)]
    odd = [(900, None, 0), (901, [0.0] * 24, 0), (902, [float("nan")] * 24, 0), (903, [None] + [1.0] * 23, 0), (904, rows[0][1], 0), (904, rows[0][1], 0), (905, [1.0, 2.0], 0), (None, rows[1][1], 0)]
    got = near_vectors(spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>, label int"), cap=32).collect()
    full = np.concatenate([x, x[:1], x[:1]]).astype(float)
    ids = [*range(len(x)), 904, 904]
    u = full / np.linalg.norm(full, axis=1)[:, None]
    link = (u @ u.T >= 0.95) & ~np.eye(len(u), dtype=bool)
    root = components(set(ids), [(ids[i], ids[j]) for i, j in zip(*np.nonzero(link)) if ids[i] != ids[j]])
    want = {(ids[i], int(link[i].sum()), root[ids[i]]) for i in range(len(ids))}
    assert {(r.vec_id, r.n_links, r.component_id) for r in got if r.vec_id is not None and (r.vec_id < 900 or r.vec_id == 904)} == want
    assert all(r.n_links == 0 and r.component_id == r.vec_id and r.kept for r in got if r.vec_id in (900, 901, 902, 903, 905, None))
    assert len(got) == len(rows) + len(odd)


def test_no_vectors(spark):
    assert near_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0
