"""Batches of texts for embedding requests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_TEXTS, MAX_REQUEST, MAX_TEXT = 96, 100_000, 100_000


def _fold(items: Column, texts: int, request: int, single: int) -> Column:
    """Batch number of every item of an array of token counts, by greedy packing in order."""
    start = F.struct(F.array().cast("array<int>").alias("ids"), F.lit(0).alias("batch"), F.lit(0).alias("size"), F.lit(0).cast("long").alias("tokens"))

    def state(ids: Column, batch: Column, size: Column, tokens: Column) -> Column:
        return F.struct(ids.alias("ids"), batch.alias("batch"), size.alias("size"), tokens.cast("long").alias("tokens"))

    def step(acc: Column, t: Column) -> Column:
        fresh = F.when(acc["size"] > 0, acc["batch"] + 1).otherwise(acc["batch"])
        alone = state(F.array_append(acc["ids"], fresh), fresh + 1, F.lit(0), F.lit(0))
        full = (acc["size"] >= texts) | (acc["tokens"] + t > request)
        new = state(F.array_append(acc["ids"], fresh), fresh, F.lit(1), t)
        grown = state(F.array_append(acc["ids"], acc["batch"]), acc["batch"], acc["size"] + 1, acc["tokens"] + t)
        return F.when(t > single, alone).when(full, new).otherwise(grown)

    return F.aggregate(items, start, step, lambda acc: acc["ids"])


def greedy_batches(df: DataFrame, unit: str, order: str, tokens: str, texts: int = MAX_TEXTS, request: int = MAX_REQUEST, single: int = MAX_TEXT) -> DataFrame:
    """unit, order, tokens, batch: batches of at most `texts` texts and `request` tokens, formed in order within a unit.

    A text above `single` tokens goes alone. The rule is sequential, so the unit must be bounded by its definition
    (a range of keys); only token counts are gathered, the texts stay where they are. Null tokens are left out.
    """
    rows = df.where(F.col(tokens).isNotNull()).groupBy(unit).agg(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col(tokens).cast("int").alias("t")))).alias("s"))
    ids = _fold(F.transform("s", lambda x: x["t"]), texts, request, single)
    out = rows.select(unit, F.explode(F.arrays_zip(F.col("s"), ids.alias("b"))).alias("z"))
    return out.select(unit, F.col("z.s.o").alias(order), F.col("z.s.t").alias(tokens), F.col("z.b").alias("batch"))


def batch_stats(batches: DataFrame, unit: str, tokens: str, single: int = MAX_TEXT) -> DataFrame:
    """One row: texts, batches, oversized texts and the mean size of a batch (0 without any)."""
    sizes = batches.groupBy(unit, "batch").agg(F.count("*").alias("n"), F.sum((F.col(tokens) > single).cast("int")).alias("over"))
    return sizes.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total_chunks"), F.count("*").alias("batches_created"), F.coalesce(F.sum("over"), F.lit(0)).alias("oversized"), F.coalesce(F.avg("n"), F.lit(0.0)).alias("avg_batch_size"))


def fixed_batches(df: DataFrame, unit: str, order: str, size: int = MAX_TEXTS) -> DataFrame:
    """unit, order, batch: ordinal batches of `size` within a unit; equal orders count as one row."""
    rows = df.groupBy(unit).agg(F.array_sort(F.collect_set(F.col(order))).alias("s"))
    return rows.select(unit, F.posexplode("s").alias("i", order)).select(unit, order, F.floor(F.col("i") / size).cast("int").alias("batch"))
