"""Id ranges, their split over instances, skip lists and object keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docpipe.functions.text import col, strip

INSTANCES, LAST_ID = 8, 2_000_000


def id_range(spark: SparkSession, start: int, end: int) -> DataFrame:
    """norm_id from start to end, both included."""
    if start > end:
        raise ValueError(f"the range {start}..{end} is empty")
    return spark.range(start, end + 1).withColumnRenamed("id", "norm_id")


def instance_of(norm_id: Column | str, n: int = INSTANCES, last: int = LAST_ID) -> Column:
    """Instance 1..n of an id; the last takes the remainder and what lies beyond."""
    return F.greatest(F.lit(1), F.least(F.floor((col(norm_id) - 1) / (last // n)) + 1, F.lit(n))).cast("int")


def range_plan(spark: SparkSession, n: int = INSTANCES, last: int = LAST_ID) -> DataFrame:
    """instance, first_id, last_id."""
    size = last // n
    i = F.col("id")
    return spark.range(1, n + 1).select(i.cast("int").alias("instance"), ((i - 1) * size + 1).alias("first_id"), F.when(i == n, last).otherwise(i * size).cast("long").alias("last_id"))


def skip_ids(lines: DataFrame, line: str) -> DataFrame:
    """Distinct ids of the lines that hold nothing but digits; other lines are passed over."""
    t = strip(line)
    return lines.where(t.rlike("^[0-9]+$")).select(t.try_cast("bigint").alias("norm_id")).where("norm_id is not null").distinct()


def object_key(knowledge_id: str, doc_id: Column, prefix: str = "originals") -> Column:
    return F.concat_ws("/", F.lit(knowledge_id), F.lit(prefix), F.concat(doc_id, F.lit(".json")))


def doc_key(norm_id: Column | str) -> Column:
    return F.concat(F.lit("bcn-"), col(norm_id).cast("string"))


def first_by_key(df: DataFrame, key: Column, n: int = 1000) -> DataFrame:
    """The first n rows in the order of an object listing, i.e. by key as text."""
    return df.withColumn("key", key).orderBy("key").limit(n)


def read_documents(spark: SparkSession, path: str, schema: str) -> tuple[DataFrame, DataFrame]:
    """(documents, broken): stored JSON documents below path with an explicit schema; broken ones keep their raw text."""
    text = spark.read.option("recursiveFileLookup", "true").text(path, wholetext=True)
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_broken"}
    doc = text.select(F.from_json("value", f"{schema}, _broken string", options).alias("d")).select("d.*")
    return doc.where("_broken is null").drop("_broken"), doc.where("_broken is not null").select("_broken")


def log_events(spark: SparkSession, path: str) -> DataFrame:
    """Log lines in JSON with the open part of their schema left as text."""
    lines = spark.read.text(path)
    return lines.select(F.from_json("value", "event string, norm_id bigint, norm_type string, timestamp string").alias("e"), "value").select("e.*", F.col("value").alias("line"))

