"""Source mixing, WARC archives and the pipeline."""

import gzip
import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from stratafold.llm import warc
from stratafold.llm.common import fresh_path
from stratafold.llm.mixing import mix, mix_summary, permute, place_of, targets, whole_slots

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.mark.parametrize("n", [1, 2, 3, 17, 64, 1000])
def test_permutation(n):
    p = permute(np.arange(n), n, 5)
    assert sorted(p) == list(range(n)) and all(p[place_of(b, n, 5)] == b for b in {0, n // 2, n - 1})


def test_slots_meet_the_target_to_the_word():
    for size in (1, 7, 100):
        for target in range(2 * size + 1):
            slots, last = whole_slots(size, target, 8, 3)
            n = -(-size // 8)
            blocks = [int(permute(np.array([j % n]), n, 3 + j // n)[0]) for j in range(slots)]
            lengths = [min(8, size - 8 * b) for b in blocks]
            assert sum(lengths[:-1]) + (last if slots else 0) == target and (not slots or last <= lengths[-1])


def test_targets_stop_and_reshare():
    assert targets({"a": 100, "b": 100, None: 100}) == pytest.approx({"a": 200.0, "b": 250 * 2 / 3, None: 250 / 3})
    assert targets({"a": 0, "b": 10}) == {"a": 0.0, "b": 15.0} and targets({}) == {}


@pytest.fixture(scope="module")
def docs(spark):
    rng = random.Random(4)
    rows = [(i, " ".join(rng.choice("abcdef") for _ in range(rng.randint(0, 90))), "en", rng.choice(["x", "y", "y", "y", None, ""]), 0) for i in range(300)]
    return spark.createDataFrame(rows + [(900, None, None, "x", None), (901, "w " * 4000, None, "z", 1), (5, rows[5][1], "en", rows[5][3], 0)], DOCS)


def test_mix(spark, docs):
    members, takes = mix(docs, block=16, slots=64)
    rows = mix_summary(members, takes).collect()
    text = {r.doc_id: r for r in docs.collect()}
    assert len(rows) == docs.count()
    per = {}
    for r in rows:
        t = text[r.doc_id]
        assert r.size == len((t.text or "").split()) and r.taken <= 2 * r.size
        per.setdefault(t.source, []).append(r)
    for got in per.values():
        assert abs(sum(r.taken for r in got) - got[0].target) <= 0.5 and got[0].source_size == sum(r.size for r in got)
    again = mix_summary(*mix(docs.repartition(7), block=16, slots=64)).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, rows))
    pieces = takes.join(members.select("row_id", "size"), "row_id")
    assert pieces.where("first < 0 or words < 1 or first + words > size").count() == 0
    assert takes.groupBy("shard", "slot").agg(F.sum("words").alias("n")).where("n > 16").count() == 0


def test_mix_of_nothing(spark):
    empty = spark.createDataFrame([], DOCS)
    assert mix_summary(*mix(empty)).count() == 0
    blank = spark.createDataFrame([(1, " ", None, None, None)], DOCS)
    assert [tuple(r) for r in mix_summary(*mix(blank)).collect()] == [(1, 0, 0, 0.0, 0)]


def test_loser_tree():
    rng = random.Random(1)
    for k in range(9):
        runs = [sorted((rng.randint(0, 20), i) for i in range(rng.randint(0, 9))) for _ in range(k)]
        assert [x[0] for x in warc.LoserTree([iter(r) for r in runs])] == sorted(x[0] for r in runs for x in r)


def test_url_keys():
    assert warc.url_key("HTTPS://www.Example.org:8080/A?b=1#c") == "org,example:8080)/A?b=1" and warc.url_key(None) == ")/" and warc.url_key("http://[bad") == "http://[bad"


def test_archives_round_trip(spark):
    big = "é" * 80
    rows = [(1, "http://a.b/1", big), (2, "http://a.b/1", big), (3, None, None), (4, "http://c/\r\nx", "short"), (5, "http://c", "short"), (None, "http://d", big), (7, "http://e", "x" * 99), (8, "http://e", "x" * 99), (9, "u", "y" * 100), (9, "u", "y" * 100), (10, "u", "WARC/1.1\r\n\r\n" * 20)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    folder = fresh_path(spark, "warc-test")
    index = warc.merge_index(warc.write_archives(pages, folder))
    got = warc.read_archives(index, folder, payloads=True).collect()
    assert len(got) == len(rows)
    html = {r[0]: r[2] for r in rows}
    for r in got:
        payload = (html[r.page_id] or "").encode()
        assert (r.payload_bytes, r.payload_digest) == (len(payload), hashlib.sha256(payload).hexdigest())
        assert r.payload is None if r.record_type == "revisit" else bytes(r.payload) == payload
    kinds = sorted((str(r.page_id), r.record_type, r.refers_to) for r in got if r.record_type == "revisit")
    assert kinds == [("2", "revisit", 1), ("None", "revisit", 1)]
    order = [(r.url_key, r.captured) for r in index.orderBy(F.spark_partition_id(), "place").collect()]
    assert len(order) == len(rows)
    raw = gzip.decompress(b"".join(open(f, "rb").read() for f in __import__("glob").glob(folder.removeprefix("file://") + "/*.warc.gz")))
    assert raw.count(b"WARC-Record-ID") == len(rows)
    assert warc.archive_round_trip(pages.limit(0)).count() == 0


def test_pipeline_stages(spark, docs, tmp_path):
    spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    more = docs.unionByName(spark.createDataFrame([(950, "you idiot moron scum " * 20, "en", "y", 1), (951, "key token = abcdefghijkl " + "word " * 60, "en", "y", 1)], DOCS)).withColumn("extra", F.lit(1))
    more.write.parquet(f"{tmp_path}/documents.parquet")
    now = spark.read.parquet(f"{tmp_path}/documents.parquet")
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        now = stage(spark, now, str(tmp_path))
        now.write.parquet(f"{tmp_path}/{name}")
        now = seen[name] = spark.read.parquet(f"{tmp_path}/{name}")
        if name != "packing":
            assert now.columns == list(corpus_pipeline.COLUMNS)
    ids = {n: {r.doc_id for r in d.select("doc_id").collect()} for n, d in seen.items()}
    assert 950 not in ids["toxicity"] and 951 in ids["toxicity"]
    assert seen["simhash_near_dedup"].groupBy("doc_id").count().where("count > 1").count() == 0
    assert "[SECRET]" in seen["secret_scan"].where("doc_id = 951").first().text and ids["secret_scan"] == ids["simhash_near_dedup"]
    before = {r.doc_id: len((r.text or "").split()) for r in seen["secret_scan"].collect()}
    after = {r.doc_id: len(r.text.split()) for r in seen["source_mixing"].collect()}
    assert all(0 < n <= 2 * before[i] for i, n in after.items()) and sum(after.values()) == pytest.approx(1.5 * sum(before.values()), abs=5)
    assert ids["packing"] == ids["source_mixing"]
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == seen["packing"].count()
