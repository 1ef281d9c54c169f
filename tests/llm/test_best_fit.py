"""Best-fit packing against the plain algorithm and the tokeniser."""

import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from stratafold.llm.tokens import _as_bytes, best_fit, best_fit_documents, tokenizer_path

DOCS = "doc_id long, text string"


def plain_best_fit(counts, max_len):
    """Best fit decreasing, piece by piece: the room left in each pack."""
    rooms = []
    for n in sorted(Counter(counts).elements(), reverse=True):
        fits = [r for r in rooms if r >= n]
        if fits:
            rooms.remove(min(fits))
            rooms.append(min(fits) - n)
        else:
            rooms.append(max_len - n)
    return sorted(rooms)


@pytest.mark.parametrize("seed", range(8))
def test_plan_over_counts(seed):
    rng = np.random.default_rng(seed)
    max_len = int(rng.integers(5, 60))
    counts = {int(n): int(rng.integers(1, 40)) for n in rng.choice(max_len, min(max_len, 12), replace=False) + 1}
    plan = best_fit(counts, max_len)
    got = Counter()
    for lengths, packs in plan:
        assert packs > 0 and sum(lengths) <= max_len
        for n in lengths:
            got[n] += packs
    assert got == counts
    assert sorted(max_len - sum(p) for p, n in plan for _ in range(n)) == plain_best_fit(counts, max_len)


def test_plan_is_small():
    counts = {n: 10**9 + n * 7919 for n in range(1, 2049)}
    plan = best_fit(counts, 2048)
    assert len(plan) < 4 * 2048 and sum(n for _, n in plan) * 2048 < 1.01 * sum(k * n for k, n in counts.items())


def test_documents(spark):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(tokenizer_path())
    ids = lambda t: [*tok.encode(t or "", add_special_tokens=False).ids, 0]
    rows = [(i, f"the cat and the dog number {i} went home " * (i % 7)) for i in range(60)]
    rows += [(100, None), (101, ""), (102, " \n"), (103, "word " * 3000), (104, "a" * 63), (None, "no id"), (None, "no id"), (None, None), (5, "another text of document five"), (6, None), (6, None)]
    docs = spark.createDataFrame(rows, DOCS).repartition(3)
    packed, pieces = best_fit_documents(docs, 64)
    got = packed.collect()
    texts = defaultdict(list)
    for i, t in rows:
        texts[i].append(ids(t))
    of_row = defaultdict(list)
    for r in got:
        of_row[r.row].append(r)
    assert len(of_row) == len(rows)
    for parts in of_row.values():
        parts.sort(key=lambda r: r.piece)
        assert [r.piece for r in parts] == list(range(len(parts))) and len({r.doc_id for r in parts}) == 1
        assert all(r.length == 64 for r in parts[1:])
        whole = next(x for x in texts[parts[0].doc_id] if [zlib.crc32(_as_bytes(x[r.start : r.start + r.length])) for r in parts] == [r.ids_crc32 for r in parts])
        texts[parts[0].doc_id].remove(whole)
        assert [r.start for r in parts] == [0, *np.cumsum([r.length for r in parts])[:-1]] and sum(r.length for r in parts) == len(whole)
    places = defaultdict(list)
    for r in got:
        places[r.sequence_id].append((r.offset, r.length))
    for seq in places.values():
        seq.sort()
        assert [o for o, _ in seq] == [0, *np.cumsum([n for _, n in seq])[:-1]] and sum(n for _, n in seq) <= 64
    assert len(places) == len(plain_best_fit(Counter(r.length for r in got), 64))
    clash = docs.select("*", *(F.lit("x").alias(c) for c in ("_id", "_text", "row", "piece", "start", "length", "ids", "sequence_id", "offset", "_salt", "_rank")))
    assert best_fit_documents(clash, 64)[0].count() == len(got)
    assert best_fit_documents(docs.limit(0), 64)[0].count() == 0


def test_a_common_length_is_ranked_in_groups(spark):
    """Thousands of equal rows without an id fall into several ranking groups and still take distinct places."""
    docs = spark.range(3000).select(F.lit(None).cast("long").alias("doc_id"), F.lit("same text").alias("text"))
    got = best_fit_documents(docs, 64)[0].select("sequence_id", "offset").collect()
    assert len({tuple(r) for r in got}) == 3000
