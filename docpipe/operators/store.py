"""Keyed tables on files: every write makes a new version, readers take the last complete one."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docpipe.operators.index import upsert
from docpipe.sources.objects import folder_exists

SEQ = "__seq"


@dataclass(frozen=True)
class Result:
    success: int
    failed: int


def _versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the complete versions below path; a write that broke off has left no mark of success."""
    if not folder_exists(spark, path):
        return []
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in fs.listStatus(p)]
    return sorted(int(n[2:]) for n in names if n.startswith("v=") and n[2:].isdigit() and folder_exists(spark, f"{path}/{n}/_SUCCESS"))


def index_exists(spark: SparkSession, path: str) -> bool:
    """Whether the table has ever been written completely. Nothing is made."""
    return bool(_versions(spark, path))


def current(spark: SparkSession, path: str) -> DataFrame | None:
    """The table as it is, or None if there is none yet."""
    v = _versions(spark, path)
    return spark.read.parquet(f"{path}/v={v[-1]}").drop(SEQ) if v else None


def bulk_index(spark: SparkSession, path: str, docs: DataFrame, key: str, seq: str | None = None, keep: int = 2) -> Result:
    """Upsert docs by key: rows written and rows that failed for want of a key.

    Later writes win over earlier ones; within docs the row with the largest seq, or without seq the largest row.
    Writing the same rows again changes nothing, so a broken run is simply repeated. The last `keep` versions stay.
    """
    done = _versions(spark, path)
    number = done[-1] + 1 if done else 0
    order = F.col(seq) if seq else F.lit(0)
    new = docs.withColumn("__order", order)
    new = upsert(new.limit(0), new, key, "__order").drop("__order").withColumn(SEQ, F.lit(number).cast("long"))
    old = spark.read.parquet(f"{path}/v={done[-1]}") if done else new.limit(0)
    counted = docs.agg(F.count("*").alias("n"), F.count(key).alias("ok")).first()
    if not counted["n"] and done:
        return Result(0, 0)
    upsert(old, new, key, SEQ).write.mode("overwrite").parquet(f"{path}/v={number}")
    fs_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    for v in done[: max(0, len(done) + 1 - keep)]:
        p = fs_path(f"{path}/v={v}")
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
    return Result(counted["ok"], counted["n"] - counted["ok"])


def index_document(spark: SparkSession, path: str, document: DataFrame, key: str) -> bool:
    """Upsert of one document; true if it was created or replaced."""
    return bulk_index(spark, path, document, key) == Result(1, 0)


def new_path(folder: str) -> str:
    return f"{folder}/{uuid.uuid4().hex}"
