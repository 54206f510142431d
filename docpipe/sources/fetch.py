"""Pages by id behind a fetcher interface, with retries; where pages come from is the caller's matter."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from docpipe.sources.html import MIN_PAGE

# (status, page) of an id; no status means no response. A fetcher raises TimeoutError, or anything else on a fault.
Fetcher = Callable[[int], tuple[int | None, str | None]]
TRIES = 3
FIELDS = (("status", T.IntegerType()), ("html", T.StringType()), ("attempts", T.IntegerType()), ("outcome", T.StringType()))


def fetch_one(norm_id: int, fetcher: Fetcher, least: int = MIN_PAGE) -> tuple[int | None, str | None, str]:
    """(status, page or null, outcome); outcome is ok, no_response, not_found, bad_status, too_short, timeout or error."""
    try:
        status, page = fetcher(norm_id)
    except TimeoutError:
        return None, None, "timeout"
    except Exception:
        return None, None, "error"
    if status is None:
        return None, None, "no_response"
    if status != 200:
        return status, None, "not_found" if status == 404 else "bad_status"
    return (status, page, "ok") if page is not None and len(page) >= least else (status, None, "too_short")


def fetch_pages(ids: DataFrame, key: str, fetcher: Fetcher, tries: int = TRIES, wait: Callable[[float], None] = time.sleep, pause: float = 0.0) -> DataFrame:
    """key, status, html, attempts, outcome: one row per id, the page only where outcome is ok.

    A page that doesn't come is tried again up to `tries` times in all, with 1, 2, 4... seconds between; `pause` seconds
    go before every id. Null ids give no row. The fetcher runs in the workers, one id at a time in each task, so the
    number of partitions bounds the load on the site.
    """
    base = ids.where(ids[key].isNotNull()).select(key)
    schema = T.StructType([base.schema[key], *(T.StructField(n, t) for n, t in FIELDS)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for s in range(0, b.num_rows, 64):
                part, rows = b.slice(s, 64), []
                for i in part.column(0).to_pylist():
                    if pause:
                        wait(pause)
                    for attempt in range(1, tries + 1):
                        status, page, outcome = fetch_one(i, fetcher)
                        if outcome == "ok" or attempt == tries:
                            break
                        wait(2.0 ** (attempt - 1))
                    rows.append((status, page, attempt, outcome))
                cols = list(zip(*rows, strict=True))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(cols[0], pa.int32()), pa.array(cols[1], pa.string()), pa.array(cols[2], pa.int32()), pa.array(cols[3], pa.string())], names=[key, *(n for n, _ in FIELDS)])

    return base.mapInArrow(run, schema)
