"""Outcome counters, checkpoints and resume points."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docpipe.functions.maps import now_iso
from docpipe.operators import store
from docpipe.session import cut_lineage

MAX_RETRIES = 3


def success_rate(success: Column, total: Column) -> Column:
    return F.when(total == 0, 0.0).otherwise(success * 100.0 / total)


def outcome_counters(df: DataFrame, by: str, outcome: str) -> DataFrame:
    """Per instance, counts of attempts and of final outcomes, and the success rate.

    outcome: ok, not_found, timeout, unparseable, placeholder or retry (any other counts in total_events only). A page
    not found is tried MAX_RETRIES times and each try counts as skipped before it fails; a timeout counts its retries.
    """
    o = F.col(outcome)
    c = df.groupBy(by).agg(
        F.count_if(o == "ok").alias("success_count"), F.count_if(o.isin("not_found", "timeout", "unparseable")).alias("failed_count"),
        (F.count_if(o == "not_found") * MAX_RETRIES + F.count_if(o == "placeholder")).alias("skipped_count"), F.count_if(o == "placeholder").alias("final_skipped"),
        F.count_if(o == "retry").alias("retry_count"), F.count_if(o.isin("ok", "not_found", "timeout", "unparseable", "placeholder")).alias("total_processed"), F.count("*").alias("total_events"),
    )
    rate = success_rate(F.col("success_count"), F.col("total_processed"))
    return c.withColumns({"success_rate": rate, "rate_text": F.format_string("%.2f%%", rate)})


def latest_checkpoints(df: DataFrame) -> DataFrame:
    """The furthest saved state of every instance (largest last id, then latest save). Null instances are left out."""
    state = F.struct("last_id_processed", "saved_at", "total_processed", "success_count", "failed_count", "skipped_count", "retry_count", "status")
    last = df.where("instance_id is not null").groupBy("instance_id").agg(F.max(state).alias("s"))
    return last.select("instance_id", "s.*")


def resume_points(plan: DataFrame, checkpoints: DataFrame) -> DataFrame:
    """instance_id, start_id: one past the last processed id; the planned start where nothing, or 0, was saved.

    plan: instance_id, first_id.
    """
    c = checkpoints.select("instance_id", "last_id_processed")
    start = F.coalesce(F.nullif("last_id_processed", F.lit(0)) + 1, F.col("first_id"), F.lit(1))
    return plan.join(c, "instance_id", "left").select("instance_id", start.cast("long").alias("start_id"))


def mark(checkpoints: DataFrame, instance_id: str, status: str, at: str | Column, error: str | None = None) -> DataFrame:
    """The table with one instance's status set to completed or failed; every other column and row is kept."""
    here = F.col("instance_id") == instance_id
    when = "completed_at" if status == "completed" else "failed_at"
    out = checkpoints.withColumns({"status": F.when(here, status).otherwise(F.col("status")), when: F.when(here, at).otherwise(F.col(when))})
    return out if error is None else out.withColumn("error_message", F.when(here, error).otherwise(F.col("error_message")))


COUNTS = ("total_processed", "success_count", "failed_count", "skipped_count", "retry_count")
STATE = ", ".join(["instance_id string", "last_id_processed long", *(f"{c} long" for c in COUNTS), "saved_at string", "status string", "completed_at string", "failed_at string", "error_message string", "metadata map<string,string>"])


def save_all(spark: SparkSession, path: str, states: DataFrame) -> store.Result:
    """Save states (instance_id, last_id_processed, and what else of STATE is known) as running; each replaces its instance's row."""
    names = [f.name for f in T.StructType.fromDDL(STATE).fields]
    given = {"saved_at": now_iso(), "status": F.lit("running"), **{c: F.col(c) for c in states.columns}}
    types = {f.name: f.dataType for f in T.StructType.fromDDL(STATE).fields}
    full = states.select(*(F.coalesce(given[n], F.lit(0)).cast("long").alias(n) if n in COUNTS and n in given else given.get(n, F.lit(0) if n in COUNTS else F.lit(None)).cast(types[n]).alias(n) for n in names))
    return store.bulk_index(spark, path, full, "instance_id")


def save(spark: SparkSession, path: str, instance_id: str, last_id: int, metadata: dict[str, str] | None = None, **counts: int) -> bool:
    """Save one state as running; true if it was stored."""
    row = {"instance_id": instance_id, "last_id_processed": last_id, **counts, "metadata": metadata}
    kinds = T.StructType([f for f in T.StructType.fromDDL(STATE).fields if f.name in row])
    return save_all(spark, path, spark.createDataFrame([tuple(row[f.name] for f in kinds.fields)], kinds)) == store.Result(1, 0)


def finish(spark: SparkSession, path: str, instance_id: str, status: str, error: str | None = None) -> bool:
    """Mark an instance completed or failed; false if it has no state. Only a running state changes: an end is an end."""
    now = store.current(spark, path)
    if now is None:
        return False
    row = now.where((F.col("instance_id") == instance_id) & (F.col("status") == "running"))
    row = cut_lineage(mark(row.withColumn("__at", now_iso()), instance_id, status, F.col("__at"), error).drop("__at"))
    return not row.isEmpty() and store.bulk_index(spark, path, row, "instance_id") == store.Result(1, 0)


def start_of(spark: SparkSession, path: str, instance_id: str, planned: int) -> int:
    """One past the last processed id of an instance, the planned start where nothing, or 0, was saved."""
    now = store.current(spark, path)
    row = None if now is None else now.where(F.col("instance_id") == instance_id).first()
    return row["last_id_processed"] + 1 if row is not None and row["last_id_processed"] else planned


def running_progress(df: DataFrame, by: str, order: list[str], ok: Column, every: int = 100, ranges: int | None = None) -> DataFrame:
    """by, position, succeeded, rate at every `every`-th row of an instance in order.

    Rows are cut into ranges of the whole order, sized by a sample, so neither an instance nor a single key with a third
    of all rows makes a range too large. Positions are sums in two levels: inside a range, and of the ranges before.
    The ranges are written to the checkpoint folder, so that both levels see the same.
    """
    n = ranges or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    d = df.select(by, *order, ok.cast("long").alias("__ok")).repartitionByRange(n, by, *order)
    d = cut_lineage(d.withColumn("__range", F.spark_partition_id()))
    totals = d.groupBy(by, "__range").agg(F.count("*").alias("n"), F.sum("__ok").alias("k"))
    w = Window.partitionBy(by).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    before = totals.select(by, "__range", F.coalesce(F.sum("n").over(w), F.lit(0)).alias("n0"), F.coalesce(F.sum("k").over(w), F.lit(0)).alias("k0"))
    inner = Window.partitionBy(by, "__range").orderBy(*order)
    upto = inner.rowsBetween(Window.unboundedPreceding, 0)
    r = d.select(by, "__range", F.row_number().over(inner).alias("n"), F.sum("__ok").over(upto).alias("k")).join(before, [by, "__range"])
    r = r.select(by, (F.col("n") + F.col("n0")).alias("position"), (F.col("k") + F.col("k0")).alias("succeeded"))
    return r.where(F.col("position") % every == 0).withColumn("rate", F.col("succeeded") * 100.0 / F.col("position"))
