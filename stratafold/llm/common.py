"""Helpers shared by the corpus operators: the shared folder, lineage cuts, hot-bucket splitting, connected components."""

from __future__ import annotations

import ctypes
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII white space that separates words in every operator here.
WS = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share (spark.checkpoint.dir). Where it is unset, as in tests on one machine,
    a temporary folder becomes the session's checkpoint folder."""
    sc = spark.sparkContext
    found = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not found:
        jdir = sc._jsc.sc().getCheckpointDir()
        found = jdir.get() if jdir.isDefined() else None
    if not found:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        found = "file://" + tempfile.mkdtemp(prefix="stratafold-")
        sc.setCheckpointDir(found)
    return found.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write df to the shared folder and read it back. The lineage ends there and a lost executor costs no recomputation."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete the files behind a materialised frame that nothing reads any more."""
    spark = df.sparkSession
    jvm = spark._jvm
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def release() -> None:
    """Give memory that Arrow and the C library hold on to back to the system."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def tidy(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """`run`, after whose end its worker, which Spark reuses, keeps no memory of the task."""

    def inner(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            release()

    return inner


def group_rows(total: int, least: int = 500, groups: int = 50_000) -> int:
    """Rows per group when rows are numbered in groups: so many that about `groups` groups come out at most, whose sizes
    the driver can hold, and no fewer than `least`."""
    return max(least, -(-total // groups))


def words_col(text: Column | str) -> Column:
    """Words of a text as an array; null and blank texts give an empty array."""
    text = F.col(text) if isinstance(text, str) else text
    return F.filter(F.split(F.coalesce(text, F.lit("")), WS), lambda w: w != "")


def count_words(text: Column | str) -> Column:
    """Number of words of a text without building them: white-space runs between the trimmed ends, plus one."""
    text = F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))
    blank = " \t\n\x0b\f\r"
    inner = F.translate(text, "\t\n\x0b\f\r", "     ")
    return F.when(F.translate(text, blank, "") == "", F.lit(0)).otherwise(F.size(F.split(F.trim(inner), " +"))).cast("long")


def split_hot(df: DataFrame, keys: list[str], node: str, cap: int) -> DataFrame:
    """Cut buckets of more than `cap` rows into chunks and return every row once for each pair of chunks it belongs to.

    Adds chunk, unit_i and unit_j. All rows of one (keys, unit_i, unit_j) form a unit of at most about 2 * cap rows, and any two
    rows of a bucket meet in at least one unit. A bucket of m rows costs m * m / cap rows in place of m * m pairs.
    Buckets of one row are left out, as they hold no pair."""
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_m")).where("_m > 1")
    chunks = F.ceil(F.col("_m") / F.lit(cap)).cast("int")
    met = df.join(sizes, keys).withColumn("_n", chunks).withColumn("_c", F.pmod(F.xxhash64(node), F.col("_n")).cast("int"))
    met = met.withColumn("_j", F.explode(F.sequence(F.lit(0), F.col("_n") - 1)))
    return met.withColumn("unit_i", F.least("_c", "_j")).withColumn("unit_j", F.greatest("_c", "_j")).withColumnRenamed("_c", "chunk").drop("_m", "_n", "_j")


def by_units(df: DataFrame, keys: list[str], work: Callable[[pa.Table], Iterator[pa.RecordBatch]], schema: str, rows: int = 131072, size: int = 128 << 20) -> DataFrame:
    """Run `work` over whole groups of `keys`, many small groups at a time. Each call gets a table sorted by the keys; a
    group is never cut, and not much more than `rows` rows or `size` bytes are held at once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        n = held_bytes = 0
        for batch in batches:
            held.append(batch)
            n += batch.num_rows
            held_bytes += batch.nbytes
            if n < rows and held_bytes < size:
                continue
            whole = pa.Table.from_batches(held)
            last = [whole.column(k)[n - 1].as_py() for k in keys]
            same = np.ones(n, bool)
            for k, v in zip(keys, last):
                same &= whole.column(k).to_numpy() == v
            cut = n - int(np.argmin(same[::-1])) if not same.all() else 0
            if cut:
                yield from work(whole.slice(0, cut))
                rest = whole.slice(cut)
                held, n = rest.combine_chunks().to_batches(), rest.num_rows
                held_bytes = rest.nbytes
        if n:
            yield from work(pa.Table.from_batches(held))

    return df.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(tidy(run), schema)


def local_forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, smallest node of its component) for the nodes of the edges a-b, roots left out."""
    nodes, flat = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = flat[: len(a)], flat[len(a) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[x], label[y])
        new = label.copy()
        np.minimum.at(new, label[x], low)
        np.minimum.at(new, label[y], low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    own = label != np.arange(len(nodes))
    return nodes[own], nodes[label[own]]


def connected_components(edges: DataFrame, name: str = "components") -> DataFrame:
    """Components of undirected edges (a, b) of type long: one row (node, component) per node that is not the smallest of
    its component. Alternates large-star and small-star steps; each round is written to the shared folder, and only its
    row count and a checksum reach the driver."""
    state = lambda df: tuple(df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
    now = materialise(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), name)
    mark = state(now)
    while mark[0]:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        met = large.join(low, "a")
        small = met.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(low.select("a", F.col("m").alias("b")))
        after = materialise(small.distinct(), name)
        new_mark = state(after)
        discard(now)
        now = after
        if new_mark == mark:
            break
        mark = new_mark
    return now.select(F.col("a").alias("node"), F.col("b").alias("component"))
