"""Odd tables for every operator and stage: clashing extra columns, repeated rows, nulls, long texts, no rows at all."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from stratafold.llm import langid, quality, secrets, toxicity, warc
from stratafold.llm.embeddings import near_vectors
from stratafold.llm.mixing import mix, mix_summary
from stratafold.llm.simhash import near_duplicates
from stratafold.llm.tokens import packed_documents, token_counts

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LONG = "the cat saw you idiot and password=abcdefgh12345 " * 30_000
CLASHING = ("_id", "_text", "id", "h", "t", "w", "lines", "blob", "vec", "fp", "rep", "key", "length", "size", "label", "spans", "chunk", "target", "rows", "share", "block", "url_key", "run", "copies", "component", "held_out", "row_id", "start", "offset", "n_words", "kept", "todo", "scanned", "taken", "windows")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (2, 0, 1), (2, 0, 0), (None, 0, 1), (3, None, None)], "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, f"the cat and the dog number {i} went home " * (i % 7), ["en", "de", None][i % 3], ["a", "a", "b", None][i % 4], 1) for i in range(40)]
    odd = [(100, None, "en", "a", None), (101, "", "en", None, 0), (102, " \n\t", None, "b", 3), (103, LONG, "en", "a", len(LONG)), (None, "a text without an id", "en", "a", 20), (None, None, None, None, None)]
    return spark.createDataFrame(rows + odd + rows[:3] + odd[:1] + odd[4:5], DOCS)


def with_clashes(df):
    return df.select("*", *(F.lit("clash").alias(c) for c in CLASHING if c not in df.columns))


OPERATORS = {
    "quality": lambda d, _: quality.quality_rules(d),
    "language": lambda d, _: langid.predict_language(d, langid.fit(d)),
    "mixing": lambda d, _: mix_summary(*mix(d, block=16, slots=64)),
    "toxicity": lambda d, labels: toxicity.score_toxicity(d, toxicity.fit(d, labels)),
    "simhash": lambda d, _: near_duplicates(d),
    "secrets": lambda d, _: secrets.secrets_digest(secrets.find_secrets(d)),
    "tokens": lambda d, _: token_counts(d),
}


def rows_of(df):
    return sorted(tuple(round(x, 9) if isinstance(x, float) else str(x) for x in r) for r in df.collect())


@pytest.mark.parametrize("name", OPERATORS)
def test_documents(spark, docs, labels, name):
    f = OPERATORS[name]
    plain = f(docs, labels)
    rows = rows_of(plain)
    assert len(rows) == docs.count()  # repeated rows, null ids and null texts have rows of their own
    assert rows == rows_of(f(with_clashes(docs), with_clashes(labels)))
    assert f(docs.limit(0), labels).columns == plain.columns and f(docs.limit(0), labels).count() == 0
    assert f(docs.limit(0), labels.limit(0)).count() == 0


def test_packing(spark, docs):
    packed = lambda d: packed_documents(d, 64)[0].select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
    rows = packed(docs).collect()
    ends = token_counts(docs).collect()
    assert sum(r.length for r in rows) == sum(r.n_tokens + 1 for r in ends) and sum(r.start == 0 for r in rows) == len(ends)
    assert len({(r.sequence_id, r.offset) for r in rows}) == len(rows)
    assert sorted((str(r.doc_id), r.start, r.ids_crc32) for r in rows) == sorted((str(r.doc_id), r.start, r.ids_crc32) for r in packed(with_clashes(docs)).collect())
    assert packed(docs.limit(0)).count() == 0


def test_vectors(spark):
    rows = [(1, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.01]), (3, None), (4, [0.0, 0.0]), (5, [float("nan"), 1.0]), (6, [None, 1.0]), (7, [1.0]), (None, [1.0, 0.0])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    want = [("1", "2", "1", "True")] * 2 + [("2", "2", "1", "False"), *((str(i), "0", str(i), "True") for i in range(3, 8)), ("None", "0", "None", "True")]
    assert rows_of(near_vectors(vectors)) == sorted(want) == rows_of(near_vectors(with_clashes(vectors)))
    assert near_vectors(vectors.limit(0)).count() == 0
    two = spark.createDataFrame([(1, [1.0, 0.0, 0.0]), (1, [0.0, 1.0, 0.0]), (2, [1.0, 0.01, 0.0]), (3, [0.01, 1.0, 0.0])], "vec_id long, embedding array<float>")
    assert rows_of(near_vectors(two)) == [("1", "1", "1", "True")] * 2 + [("2", "1", "1", "False"), ("3", "1", "1", "False")]  # one id with two vectors


def test_pages(spark):
    rows = [(1, "http://a/x", "x" * 200), (1, "http://a/x", "x" * 200), (2, None, "x" * 200), (3, "u", None), (None, "v", "y" * 5_000_000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = rows_of(warc.archive_round_trip(pages))
    assert len(got) == len(rows) and got == rows_of(warc.archive_round_trip(with_clashes(pages)))
    assert warc.archive_round_trip(pages.limit(0)).count() == 0


@pytest.mark.parametrize("stage", range(len(corpus_pipeline.STAGES)))
def test_stages(spark, docs, labels, tmp_path, stage):
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    name, f = corpus_pipeline.STAGES[stage]
    rows = f(spark, docs, str(tmp_path))
    got = rows_of(rows)
    if name == "secret_scan":
        assert len(got) == docs.count() and not any("abcdefgh12345" in r[1] for r in got)
    if name == "simhash_near_dedup":
        assert sum(r[0] == "None" for r in got) == 3
    if name == "toxicity":
        assert 0 < len(got) <= docs.count()
    if name == "source_mixing":
        assert sum(len(r[1].split()) for r in got) > 0
    if name != "packing":
        assert rows.columns == list(corpus_pipeline.COLUMNS)
        assert got == rows_of(f(spark, with_clashes(docs), str(tmp_path)))
    empty = f(spark, docs.limit(0), str(tmp_path))
    assert empty.columns == rows.columns and empty.count() == 0
