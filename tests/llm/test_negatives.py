"""Hard negatives against plain loops."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from stratafold.llm import negatives

VECTORS = "vec_id long, embedding array<double>, label int"


def plain(rows, anchor, positives=5, negs=5):
    """The definition, pair by pair."""
    seen, out = {}, []
    for i, x, label in rows:
        if i is not None and label is not None and x is not None and all(c is not None and math.isfinite(c) for c in x):
            v = [math.floor(256 * c) for c in x]
            if sum(c * c for c in v) <= 1 << 62:
                seen[i, label, tuple(x)] = v
    for (i, label, x), v in seen.items():
        if not anchor(i):
            continue
        score = {k: sum(p * q for p, q in zip(v, w)) for k, w in seen.items() if len(w) == len(v) and k != (i, label, x)}
        same = sorted((-s, k[0]) for k, s in score.items() if k[1] == label)[:positives]
        for s, pos in same:
            other = sorted((-n, k[0]) for k, n in score.items() if k[1] != label and 80 * -s <= 100 * n <= 100 * -s)[:negs]
            out += [(i, pos, rank + 1, k, -s, -n) for rank, (n, k) in enumerate(other)]
    return sorted(out)


def got(df):
    return sorted(map(tuple, df.collect()))


def mined(vectors):
    return negatives.hard_negatives(vectors, F.col("vec_id") % 10 == 0)


def test_odd_vectors(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.normal(size=5)], int(i % 3)) for i in range(60)]
    rows += [(70, None, 1), (80, [1.0, None], 1), (90, [1.0] * 5, None), (100, [float("nan")] * 5, 0), (110, [float("inf")] * 5, 0), (None, [1.0] * 5, 0)]
    rows += [(120, [], 0), (121, [], 0), (122, [], 1), (130, [0.0] * 5, 0), (131, [0.0] * 5, 0), (132, [-0.1] * 5, 1), (140, [1e30] * 5, 0), (150, [3.0], 0), (151, [4.0], 0), (152, [2.5], 1)]
    rows += rows[:5] + [(20, [0.5] * 5, 2)]  # repeated rows; one id with two vectors
    vectors = spark.createDataFrame(rows, VECTORS).repartition(4)
    want = plain(rows, lambda i: i % 10 == 0)
    assert want and got(mined(vectors)) == want
    clash = vectors.select("*", *(F.lit("clash").alias(c) for c in ("id", "vec", "anchor", "dim", "mark", "block", "chunk", "share", "side", "wins", "score", "rank", "place")))
    assert got(mined(clash)) == want
    assert mined(vectors.limit(0)).count() == 0 and mined(vectors.where("vec_id % 10 = 1")).count() == 0


@pytest.mark.parametrize("scale", [1.0, 4000.0])
def test_many_blocks_ties_and_one_hot_label(spark, monkeypatch, scale):
    """A third of all rows have one label, many scores are equal, and scores of the second case pass 2**53."""
    monkeypatch.setattr(negatives, "SHARE", 1)
    rng = np.random.default_rng(4)
    rows = [(i, [float(x) * scale for x in rng.integers(-2, 4, 70)], 0 if i % 3 == 0 else int(i % 17)) for i in range(1500)]
    if scale > 1:
        rows = [(i, [x * 16 for x in v], label) for i, v, label in rows[:600]]
    vectors = spark.createDataFrame(rows, VECTORS).repartition(5)
    want = plain(rows, lambda i: i % 10 == 0)
    assert len(want) > 100 and got(mined(vectors)) == want


def test_running_best_is_that_of_a_sort():
    rng = np.random.default_rng(5)
    best = negatives._Best(4, 3)
    rows = []
    for _ in range(20):
        part = [rng.integers(0, k, 30) for k in (4, 6, 50, 2)]
        rows += list(zip(*(p.tolist() for p in part)))
        best.add(*part)
    want = sorted((n, -s, i, m) for n, s, i, m in rows)
    want = [r for n in range(4) for r in [x for x in want if x[0] == n][:3]]
    assert list(zip(best.line.tolist(), (-best.score).tolist(), best.id.tolist(), best.mark.tolist())) == want
