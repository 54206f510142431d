"""All named queries of the core with their SQL."""

from __future__ import annotations

from docpipe.plans import chunks, extraction, pipeline, state
from docpipe.plans.registry import Query

PARTS = (chunks.R, extraction.R, pipeline.R, state.R)


def queries() -> dict[str, Query]:
    return {k: q for r in PARTS for k, q in r.queries.items()}


def oracle_sql() -> dict[str, str]:
    return {k: s for r in PARTS for k, s in r.sql.items()}
