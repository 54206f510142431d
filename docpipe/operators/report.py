"""Reports: distributions, nearest-rank quantiles, histograms, projections, timings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docpipe.session import cut_lineage

RANGES = 64  # most ranges in which the distinct values are summed up side by side
VALUES_PER_RANGE = 100_000


def by_value(df: DataFrame, value: str) -> DataFrame:
    """v, n: the rows per distinct value, nulls aside, written to the checkpoint folder: what is behind it is read once."""
    return cut_lineage(df.where(F.col(value).isNotNull()).groupBy(F.col(value).alias("v")).agg(F.count("*").alias("n")))


def with_prefix(counts: DataFrame, per_range: int = VALUES_PER_RANGE) -> tuple[DataFrame, int]:
    """(v, n, upto: the rows up to each value in order; the number of all rows).

    Sums run within ranges of about per_range values, so that no task holds all of many.
    """
    size = counts.agg(F.count("*").alias("values"), F.sum("n").alias("n")).first()
    ranges = min(RANGES, max(1, size["values"] // per_range))
    place, before = F.lit(0), F.lit(0)
    if ranges > 1:
        # at most RANGES numbers each
        cuts = counts.agg(F.percentile_approx("v", [i / ranges for i in range(1, ranges)], 10_000).alias("c")).first()["c"]
        place = sum((F.when(F.col("v") > F.lit(c), 1).otherwise(0) for c in sorted(set(cuts))), F.lit(0))
        sums, total = {r["r"]: r["n"] for r in counts.groupBy(place.alias("r")).agg(F.sum("n").alias("n")).collect()}, 0
        for k in sorted(sums):
            before = F.when(F.col("r") == k, total).otherwise(before)
            total += sums[k]
    inner = F.sum("n").over(Window.partitionBy("r").orderBy("v").rowsBetween(Window.unboundedPreceding, 0))
    return counts.withColumn("r", place).select("v", "n", (inner + before).alias("upto")), size["n"] or 0


def rank_columns(quantiles: dict[str, float], total: int) -> list[Column]:
    """Aggregates over with_prefix: for each name the element at the zero-based place floor(total q) of the sorted values."""
    return [F.min(F.when(F.col("upto") > F.floor(F.lit(total) * F.lit(q)), F.col("v"))).alias(name) for name, q in quantiles.items()]


def nearest_rank(df: DataFrame, value: str, quantiles: dict[str, float], per_range: int = VALUES_PER_RANGE) -> DataFrame:
    """One row: for each name the element at the zero-based place floor(n q) of the sorted values.

    Works on the counts per distinct value, summed up by ranges, whatever the number of distinct values. Nulls are
    ignored; no rows give nulls.
    """
    summed, total = with_prefix(by_value(df, value), per_range)
    return summed.agg(*rank_columns(quantiles, total))


QUANTILES = {"median": 0.5, "p90": 0.9, "p95": 0.95}


def chunk_report(counts: DataFrame) -> DataFrame:
    """docs, total_chunks, mean, median, p90, p95, smallest, largest over a column `chunks`, which is read once."""
    summed, rows = with_prefix(by_value(counts, "chunks"))
    total = F.sum(F.col("v") * F.col("n"))
    return summed.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("docs"), total.alias("total_chunks"), F.try_divide(total, F.sum("n")).alias("mean_chunks"),
        F.min("v").alias("min_chunks"), F.max("v").alias("max_chunks"), *rank_columns(QUANTILES, rows),
    )


def histogram(counts: DataFrame, top: int = 10) -> DataFrame:
    """bucket, label, n, pct, bar: chunks per document, all above `top` in one bucket."""
    n = counts.where("chunks is not null").groupBy(F.least("chunks", F.lit(top)).alias("bucket")).agg(F.count("*").alias("n"))
    total = F.sum("n").over(Window.partitionBy())  # a row per bucket
    pct = F.col("n") * 100.0 / total
    label = F.when(F.col("bucket") == top, F.concat(F.lit(str(top)), F.lit("+"))).otherwise(F.col("bucket").cast("string"))
    return n.withColumn("pct", pct).select("bucket", label.alias("label"), "n", "pct", F.repeat(F.lit("#"), F.floor(F.col("pct") / 2).cast("int")).alias("bar"))


# Chunks per document and the days to index all documents that the plan foresees for them.
SCENARIOS = ((3, 39), (4, 52), (5, 65), (6, 78))
DOCUMENTS, TOKENS_PER_CHUNK, TOKENS_PER_DAY = 411_000, 512, 16_200_000.0


def scenario_lookup(report: DataFrame) -> DataFrame:
    """chunks, days, applies, projected_days: the scenario within half a chunk of the mean, and the days by formula."""
    rows = F.array(*(F.struct(F.lit(c).alias("chunks"), F.lit(d).alias("days")) for c, d in SCENARIOS))
    each = report.select("mean_chunks", F.explode(rows).alias("s"))
    days = F.floor(F.lit(DOCUMENTS) * F.col("mean_chunks") * F.lit(TOKENS_PER_CHUNK) / F.lit(TOKENS_PER_DAY)).cast("int")
    return each.select("s.chunks", "s.days", (F.abs(F.col("mean_chunks") - F.col("s.chunks")) < 0.5).alias("applies"), days.alias("projected_days"))


def timing_stats(df: DataFrame, kind: str, elapsed: str) -> DataFrame:
    """kind, n, avg, min, max of the elapsed seconds, nulls aside."""
    return df.where(F.col(elapsed).isNotNull()).groupBy(F.col(kind).alias("kind")).agg(F.count("*").alias("n"), F.avg(elapsed).alias("avg_s"), F.min(elapsed).alias("min_s"), F.max(elapsed).alias("max_s"))


VALID, INVALID, INSTANCES = 411_000, 1_589_000, 8


def extrapolated_days(stats: DataFrame) -> DataFrame:
    """One row: days of a full run on all instances from the average of either kind, and the share of the invalid."""
    avg = stats.agg(F.max(F.when(F.col("kind") == "valid", F.col("avg_s"))).alias("v"), F.max(F.when(F.col("kind") == "invalid", F.col("avg_s"))).alias("i"))
    total = F.col("v") * VALID + F.col("i") * INVALID
    return avg.select((total / INSTANCES / 86400).alias("days"), (F.col("i") * INVALID / total).alias("invalid_share"))
