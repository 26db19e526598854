"""Shared by the operators here: tables, staged results, and joins on keys that may be hot."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from batchwarden.session import shared_folder

# A key is hot when it holds more than this share of all rows, so there are at most 1 / share of them.
HOT_SHARE = 1 / 1000
# White space that separates words: space and the controls tab to carriage return.
WORD = r"[^\x20\x09-\x0D]+"
# What a Python worker keeps from task to task, by name. Workers outlive the operator that fills it.
memos: dict[str, object] = {}


def forget() -> None:
    """Let go what another operator has kept in this Python worker."""
    memos.clear()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A parquet table of a folder."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not use yet, whatever its own columns are called."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def stage(df: DataFrame, label: str, compression: str = "zstd") -> DataFrame:
    """Write ``df`` to the folder that all executors share and return the written table.

    The table has no lineage to replay, so lost executors cost nothing that was staged before.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/batchwarden-llm/{label}-{uuid.uuid4().hex}"
    df.write.option("compression", compression).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, *staged: DataFrame) -> None:
    """Remove staged tables that nothing will read any more, and the shuffle files of what led to them.

    Spark removes shuffle files once the driver has forgotten the plans they belong to.
    """
    jvm = spark.sparkContext._jvm
    for df in staged:
        for name in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            path = jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
    jvm.System.gc()


def attach(rows: DataFrame, facts: DataFrame, key: str, count: str) -> DataFrame:
    """Left-join facts (one row per key, ``count`` = rows of that key) to rows, whatever the key's skew.

    Hot keys are at most 1 / HOT_SHARE by their counted rows and are broadcast; no other key holds
    more than HOT_SHARE of the rows, so the rest is shuffled evenly. Both inputs are read twice and
    should be staged. Keys are not null.
    """
    total = facts.agg(F.sum(count)).first()[0] or 0
    is_hot = F.col(count) > F.lit(total * HOT_SHARE)
    hot = F.broadcast(facts.filter(is_hot))
    cold = facts.filter(~is_hot)
    settled = rows.join(hot, key)
    return settled.unionByName(rows.join(hot.select(key), key, "left_anti").join(cold, key, "left"))
