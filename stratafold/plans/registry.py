"""Registered queries: each is written once against a dialect, planned by Spark, and given to DuckDB as its oracle."""

from __future__ import annotations

import re
from collections.abc import Callable
from uuid import uuid4
from zlib import crc32

from pyspark.sql import DataFrame, SparkSession

from stratafold.functions.dialect import DUCK, REGISTERED, SPARK, Dialect

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")
Builder = Callable[[Dialect], str]
BUILDERS: dict[str, Builder] = {}


def query(f: Builder) -> Builder:
    BUILDERS[f.__name__] = f
    return f


def with_(parts: dict[str, str], last: str) -> str:
    return "WITH " + ",\n".join(f"{k} AS ({v})" for k, v in parts.items()) + "\n" + last


#: Bytes of a row group, about, and of a table that is not worth dealing out.
ROW_GROUP, TINY = 128 << 20, 256 << 10


def table(spark: SparkSession, path: str) -> DataFrame:
    """A table of a folder. One that is smaller than a row group for each core may lie in fewer row groups than there are
    cores, so its rows are dealt out to them first; a larger one is read as it lies."""
    df = spark.read.parquet(path)
    cores = spark.sparkContext.defaultParallelism
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return df.repartition(cores) if TINY < size < cores * ROW_GROUP else df


def with_tasks(spark: SparkSession, sql: str, count: Callable[[str], int]) -> str:
    """SQL with the number of tasks for each TASKS[table, rows] of `Dialect.dealt`: as many as the cores, or more where the
    table has more rows."""
    known: dict[str, int] = {}

    def tasks(found: re.Match) -> str:
        if found[1] not in known:
            known[found[1]] = count(found[1])
        return str(max(spark.sparkContext.defaultParallelism, -(-known[found[1]] // int(found[2]))))

    return re.sub(r"TASKS\[(\w+), (\d+)\]", tasks, sql)


def run_sql(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    """Plan SQL over the tables of a folder. They are bound under names of this package, one for each folder, so that no
    view of the user's session is touched."""
    known: dict[str, str] = {}

    def bound(found: re.Match) -> str:
        name = found[2]
        if name not in known:
            known[name] = f"stratafold_{name}_{crc32(sf_dir.encode()):08x}"
            table(spark, f"{sf_dir}/{name}.parquet").createOrReplaceTempView(known[name])
        return f"{found[1]}{known[name]}"

    sql = with_tasks(spark, sql, lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet").count())
    return spark.sql(re.sub(rf"\b((?:FROM|JOIN)\s+)({'|'.join(TABLES)})\b(?!\s*\()", bound, sql))


def run_over(spark: SparkSession, name: str, frames: dict[str, DataFrame]) -> DataFrame:
    """A registered plan over relations of the caller's own (the names and columns of plans.state) in place of the tables.
    Relations that are left out are empty."""
    from stratafold.plans.state import COLUMNS, empty

    views = {}
    doc_id = next((f.schema["doc_id"].dataType.simpleString() for f in frames.values()), "long")
    for relation, columns in COLUMNS.items():
        frame = frames[relation].select(*columns.split(", ")) if relation in frames else empty(spark, relation, doc_id)
        view = f"stratafold_{relation}_{uuid4().hex}"
        frame.createOrReplaceTempView(view)
        views[relation] = f"SELECT * FROM {view}"
    return spark.sql(BUILDERS[name](SPARK, views))


def spark_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: lambda spark, sf_dir, f=f: run_sql(spark, sf_dir, f(REGISTERED)) for name, f in BUILDERS.items()}


def duck_sql() -> dict[str, str]:
    return {name: f(DUCK) for name, f in BUILDERS.items()}
