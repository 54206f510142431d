"""Validation of norm records with the reasons of rejection, and the filters around it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docpipe.functions.text import squeeze, strip

NORM_TYPES = ("ley", "codigo", "dfl", "decreto", "reglamento")
PLACEHOLDER_TITLE = "Biblioteca del Congreso Nacional"
PLACEHOLDER_CHARS = 500


def _bad(name: str, ok: Column) -> Column:
    return F.when(~F.coalesce(ok, F.lit(False)), F.lit(name))


def reject_reasons() -> Column:
    """Names of the fields that break a rule, in field order; lengths are those of the raw values."""
    n = F.length
    rules = {
        "norm_id": F.col("norm_id") > 0,
        "norm_type": F.col("norm_type").isin(*NORM_TYPES),
        "norm_number": n("norm_number") >= 1,
        "title": n("title").between(10, 500),
        "publication_date": F.col("publication_date").isNotNull(),
        "issuing_body": n("issuing_body") >= 5,
        "official_url": F.col("official_url").rlike("(?i)^https?://[^/]+"),
        "summary": n("summary").between(50, 2000),
        "full_content": (n("full_content") >= 100) & ~F.lower("full_content").contains("<html") & ~F.lower("full_content").contains("javascript:"),
    }
    return F.array_compact(F.array(*(_bad(k, v) for k, v in rules.items())))


def is_placeholder(content: str = "full_content", title: str = "title") -> Column:
    return (F.length(content) < PLACEHOLDER_CHARS) & F.col(title).contains(PLACEHOLDER_TITLE)


def validated(df: DataFrame) -> DataFrame:
    """Records that keep every rule, with content stripped, tags stripped, lowered and without empties, title squeezed."""
    ok = df.where(F.size(reject_reasons()) == 0)
    tags = F.filter(F.transform(F.coalesce("subject_tags", F.array().cast("array<string>")), lambda t: F.lower(strip(t))), lambda t: t != "")
    return ok.withColumns({"full_content": strip("full_content"), "subject_tags": tags, "title": strip(squeeze("title"))})


def without(df: DataFrame, skip: DataFrame, key: str) -> DataFrame:
    """Rows whose key is in no row of skip; rows without a key stay."""
    return df.join(skip.select(key).where(F.col(key).isNotNull()).distinct(), key, "left_anti")
