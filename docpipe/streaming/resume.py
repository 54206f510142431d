"""Resumable processing of an event table as a stream with idempotent keyed state."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docpipe.session import ensure_checkpoint_dir


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder below the session's shared checkpoint folder."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext._jsc.sc().getCheckpointDir().get()}/{name}-{uuid.uuid4().hex}"


FILES_PER_BATCH = 16


def _is_folder(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(p).isDirectory()


def run_once(source: DataFrame, by: str, where: str) -> None:
    """Process what is new in a streaming source and stop; every micro-batch writes its counts under its own number.

    A batch that is run again overwrites its own folder, so the sums never count a row twice.
    """

    def save(batch: DataFrame, number: int) -> None:
        batch.groupBy(by).agg(F.count("*").alias("n")).write.mode("overwrite").parquet(f"{where}/counts/batch={number}")

    query = source.writeStream.foreachBatch(save).option("checkpointLocation", f"{where}/offsets").trigger(availableNow=True).start()
    query.awaitTermination()


def counts_so_far(spark: SparkSession, by: str, kind: str, where: str) -> DataFrame:
    return spark.read.schema(f"{by} {kind}, n bigint, batch int").parquet(f"{where}/counts").groupBy(by).agg(F.sum("n").alias("n"))


def resumable_counts(spark: SparkSession, path: str, by: str, where: str | None = None) -> DataFrame:
    """Counts per value of `by` of a parquet table read as a stream; run twice, the second run finds nothing new."""
    where = where or shared_folder(spark, "stream")
    schema = spark.read.parquet(path).schema
    folder, pattern = (path, "*.parquet") if _is_folder(spark, path) else path.rsplit("/", 1)
    for _ in range(2):
        source = spark.readStream.schema(schema).option("maxFilesPerTrigger", FILES_PER_BATCH).option("pathGlobFilter", pattern)
        run_once(source.parquet(folder), by, where)
    return counts_so_far(spark, by, schema[by].dataType.simpleString(), where)
