"""Counters of a pipeline run, observed on the data as it passes and put together in one small table."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from docpipe.operators import embed, index, store
from docpipe.operators.chunk import chunk_texts
from docpipe.sources.objects import put_objects
from docpipe.sources.ranges import doc_key, object_key


def written(df: DataFrame, path: str, **counts: Column) -> tuple[DataFrame, dict[str, int]]:
    """df written to path and read again, with what was counted on its rows on the way; no further pass is made."""
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("rows"), *(c.alias(n) for n, c in counts.items())).write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), {k: v or 0 for k, v in seen.get.items()}


def merged(spark: SparkSession, parts: Mapping[str, Mapping[str, int]]) -> DataFrame:
    """component, counter, value."""
    return spark.createDataFrame([(p, c, int(v)) for p, counts in parts.items() for c, v in counts.items()], "component string, counter string, value long")


def index_norms(norms: DataFrame, where: str, provider: embed.Provider = embed.hashing_provider, knowledge_id: str = index.KNOWLEDGE_ID) -> dict[str, dict[str, int]]:
    """Chunk, embed, index and store norms (one row per norm_id) below where; the counters of every component and of the run.

    A norm without text counts as failed and is neither indexed nor stored. Every step is written under its own name and
    replaces what a broken run left, so a run may be repeated.
    """
    spark = norms.sparkSession
    blank = F.count_if(F.coalesce(F.regexp_replace("full_content", r"\s", ""), F.lit("")) == "")
    one, read = written(norms, f"{where}/norms", blank=blank)
    chunks, cut = written(chunk_texts(one, ["norm_id"], "full_content"), f"{where}/chunks", tokens=F.sum("token_count"))
    vectors, made = written(embed.embed(chunks, ["norm_id", "chunk_index"], "text", provider), f"{where}/vectors")
    rows = index.index_rows(one, embed.with_vectors(chunks, vectors, ["norm_id", "chunk_index"], "vector"), knowledge_id)
    indexed = store.bulk_index(spark, f"{where}/index", rows, "doc_id")
    counts = chunks.groupBy("norm_id").agg(F.count("*").cast("int").alias("chunks"))
    wrapped = index.as_json(index.wrapped_original(one, counts), "norm_id")
    named = wrapped.withColumn("key", object_key(knowledge_id, doc_key("norm_id")))
    _, stored = written(put_objects(named, "key", "document", f"{where}/objects"), f"{where}/manifest", ok=F.count_if("ok"))
    return {
        "pipeline": {"processed": read["rows"], "chunks": cut["rows"], "vectors": made["rows"], "indexed": indexed.success, "stored": stored["ok"], "failed": read["blank"]},
        "chunker": {"texts": read["rows"] - read["blank"], "failed": read["blank"], "tokens": cut["tokens"]},
        "embedder": {"texts": cut["rows"], "vectors": made["rows"]},
        "index": {"success": indexed.success, "failed": indexed.failed},
        "store": {"uploaded": stored["ok"], "failed": stored["rows"] - stored["ok"]},
    }


def batch_result(df: DataFrame, ok: Column) -> DataFrame:
    """One row: success, failed."""
    good = F.coalesce(ok, F.lit(False))
    return df.agg(F.count_if(good).alias("success"), F.count_if(~good).alias("failed"))
