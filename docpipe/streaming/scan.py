"""A resumable scan of a range of ids with a checkpoint after every so many of them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from docpipe.operators import checkpoint
from docpipe.sources.ranges import id_range

Process = Callable[[DataFrame], DataFrame]


class Interrupted(RuntimeError):
    """The scan was stopped; what is checkpointed stays."""


def scan_range(spark: SparkSession, instance_id: str, start: int, end: int, every: int, process: Process, where: str, stop_after: int | None = None) -> list[tuple[int, int]]:
    """Process the ids start..end in blocks of `every`, one distributed job each; returns the blocks done now.

    process turns a table of norm_id into result rows, among them norm_id. A block's rows are written under its first id
    and replace what a broken run left there; then its last id is saved as checkpoint. A later call goes on behind the
    last checkpoint and so does the ids after it again: at least once each, exactly once in the results. stop_after
    breaks off in the middle of that many blocks plus one, after its rows and before its checkpoint. At the end the
    state is marked completed, or failed with the error, without moving the last id.
    """
    done: list[tuple[int, int]] = []
    first = checkpoint.start_of(spark, f"{where}/state", instance_id, start)
    try:
        while first <= end:
            last = min(end, start + ((first - start) // every + 1) * every - 1)
            process(id_range(spark, first, last)).write.mode("overwrite").parquet(f"{where}/results/block={first}")
            if stop_after is not None and len(done) == stop_after:
                raise Interrupted(f"stopped behind id {last}")
            if (last - start + 1) % every == 0:
                checkpoint.save(spark, f"{where}/state", instance_id, last)
            done.append((first, last))
            first = last + 1
    except Interrupted:
        raise
    except Exception as e:
        checkpoint.finish(spark, f"{where}/state", instance_id, "failed", str(e))
        raise
    checkpoint.finish(spark, f"{where}/state", instance_id, "completed")
    return done


def results(spark: SparkSession, where: str) -> DataFrame:
    return spark.read.parquet(f"{where}/results").drop("block")
