"""The corpus pipeline: toxicity, near-duplicates, secrets, source mixing, packing. Every stage takes (spark, docs, sf_dir)
and works on all rows that its predecessor kept; all but the last return the columns of documents.

Columns of docs that a stage does not know are dropped, so clashing names cannot arise; a missing n_chars is worked out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratafold.llm import secrets, toxicity
from stratafold.llm.common import materialise, table
from stratafold.llm.mixing import mix, mixed_text
from stratafold.llm.simhash import near_duplicates
from stratafold.llm.tokens import packed_documents

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _documents(df: DataFrame, text="text") -> DataFrame:
    """The columns of documents, with n_chars (code points) following the text; null texts keep a null."""
    text = F.col(text) if isinstance(text, str) else text
    return df.select("doc_id", text.alias("text"), "lang", "source", F.length(text).cast("long").alias("n_chars"))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity grammar does not reject. A document is judged by its text, so equal rows share a fate;
    a null id is judged by its own text."""
    grammar = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return _documents(toxicity.keep_clean(docs.select(*COLUMNS), grammar))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The row with the smallest id (and then hash of id and text) of each SimHash component, once; rows without an id stay.
    Components are those of rows, told apart by id and text, so that rows with one id and two texts do not link groups."""
    named = docs.where("doc_id is not null").select(*COLUMNS, F.xxhash64("doc_id", "text").alias("h"))
    classes = near_duplicates(named.select("h", "text"), id_col="h").select("h", "component_id").distinct()
    first = named.select("doc_id", "h").distinct().join(classes, "h").groupBy("component_id").agg(F.min(F.struct("doc_id", "h")).alias("row"))
    kept = named.join(first.select("row.doc_id", "row.h"), ["doc_id", "h"], "left_semi").dropDuplicates(["doc_id", "h"])
    return _documents(kept.select(*COLUMNS).unionByName(docs.where("doc_id is null").select(*COLUMNS)))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with every secret span replaced by [SECRET]. A blob's findings come from the ledger; only documents
    with findings are rewritten."""
    found = secrets.find_blobs(docs)
    marked = docs.select(*COLUMNS, secrets.blob_of("text").alias("blob")).join(found, "blob", "left")
    return _documents(marked, F.when(F.col("spans").isNotNull(), secrets.redact(F.col("text"), F.col("spans"))).otherwise(F.col("text")))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix as documents: a document's text becomes the words that the mix takes from it, pass after pass; documents of
    which nothing is taken go. Rows with equal ids and texts become one row."""
    docs = docs.select(*COLUMNS)
    members, takes = mix(docs)
    takes = takes.join(members.select("row_id", "h", "id", "size"), "row_id")
    whole = takes.groupBy("row_id", "h", "id", "size", "pass_no").agg(F.sum("words").alias("words"), F.sort_array(F.collect_list(F.struct("first", "words"))).alias("parts"))
    part = lambda first, words: F.struct(F.col("row_id"), F.col("pass_no"), first.cast("long").alias("first"), words.cast("long").alias("words"))
    parts = F.when(F.col("words") == F.col("size"), F.array(part(F.lit(0), F.col("words")))).otherwise(F.transform("parts", lambda p: part(p["first"], p["words"])))
    taken = whole.groupBy("h", "id").agg(F.sort_array(F.flatten(F.collect_list(parts))).alias("takes"), F.first("size").alias("size"))
    taken = materialise(taken, "takes")
    keyed = docs.withColumn("h", F.xxhash64("doc_id", "text"))
    named = keyed.join(taken, (keyed["h"] == taken["h"]) & keyed["doc_id"].eqNullSafe(taken["id"])).drop(taken["h"])
    return _documents(named.dropDuplicates(["doc_id", "h"]), mixed_text())


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in sequences of at most 2048 tokens."""
    packed, _ = packed_documents(docs)
    return packed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_duplicates),
    ("secret_scan", redact_secrets),
    ("source_mixing", mix_sources),
    ("packing", pack_sequences),
]

#: The stages train a model, link fingerprints transitively and draw at random, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over all documents; each stage's rows are written to the shared folder in between."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
