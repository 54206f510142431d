"""The fields of a norm from a parsed page: ordered fallbacks as coalesce and when, evaluated by the JVM."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docpipe.functions.dates import ABBREVIATED, DAY_MONTH_YEAR, MONTHS, from_parts, labelled_date, month_number, parse_date
from docpipe.functions.text import WS, clean_text, col, group1, not_empty, strip
from docpipe.sources.html import fetched, meta, with_page

# Names and defaults of the site's records; the patterns below are those its pages are read by.
SITE = "Ley Chile"
URL = "https://bcn.cl/leychile/navegar?idNorma="
DEFAULT_BODY = "CONGRESO NACIONAL"
MAX_TAGS = 15


def norm_type(title: Column | str) -> Column:
    t = F.upper(col(title))
    return (
        F.when(t.rlike(r"\bCODIGO\b"), "codigo").when(t.rlike(r"\bD\.?F\.?L\.?\b"), "dfl")
        .when(t.rlike(r"\bDECRETO\b") & ~t.contains("LEY"), "decreto").when(t.rlike(r"\bREGLAMENTO\b"), "reglamento").otherwise("ley")
    )


def norm_number(title: Column | str, norm_id: Column | str) -> Column:
    """Digits behind NUM., else behind DFL or DECRETO, else the id."""
    behind = group1(title, rf"(?iu)N[UÚ]M\.?{WS}*(\d[\d.,\t\n\x0B\f\r -]*)")
    return F.coalesce(not_empty(F.translate(behind, "., ", "")), group1(title, rf"(?iu)(?:DFL|DECRETO){WS}+(\d+)"), col(norm_id).cast("string"))


def title_text(page: str = "page") -> Column:
    """The page's own title: og:title by name, else <title> if longer than 10, else <h1>."""
    return F.col(f"{page}.raw_title")


def composed_title(raw: Column | str, description: Column | str) -> Column:
    """Kind, number and description, where the description says more than the title; at most 200 characters."""
    r, d = col(raw), F.coalesce(strip(description), F.lit(""))
    keep = (F.length(d) < 20) | d.contains(SITE) | r.contains(F.substring(d, 1, 50))
    decree, law, dfl = group1(r, rf"(?iu)Decreto{WS}+(\d+)"), group1(r, rf"(?iu)Ley{WS}+(?:N[°Úu]?m?\.?{WS}*)?(\d+[\d.,]*)"), group1(r, rf"(?iu)DFL{WS}+(\d+)")
    made = (
        F.when(decree.isNotNull(), F.concat(F.lit("Decreto "), decree, F.lit(": "), d))
        .when(law.isNotNull(), F.concat(F.lit("Ley "), F.translate(law, ".,", ""), F.lit(": "), d))
        .when(dfl.isNotNull(), F.concat(F.lit("DFL "), dfl, F.lit(": "), d))
        .otherwise(F.when(F.length(d) > 20, d).otherwise(r))
    )
    return F.when(keep, r).otherwise(F.when(F.length(made) > 200, F.concat(F.substring(made, 1, 197), F.lit("..."))).otherwise(made))


def publication_date(datos: Column | str, published: Column, modified: Column) -> Column:
    return F.coalesce(labelled_date(datos, "Publicaci[oó]n"), parse_date(published), parse_date(modified), F.lit("2000-01-01").cast("date"))


def promulgation_date(datos: Column | str, norm_start: Column) -> Column:
    """From the data box, else from `Santiago, d de month de yyyy`, else the first d-MMM-yyyy of the text's start.

    A day that doesn't exist ends the search with null; an unknown month lets it go on.
    """
    sig = rf"(?iu)Santiago,?{WS}+(\d{{1,2}}){WS}+de{WS}+(\w+){WS}+de{WS}+(\d{{4}})"
    s, m = [group1(norm_start, sig, i) for i in (1, 2, 3)], [group1(norm_start, DAY_MONTH_YEAR, i) for i in (1, 2, 3)]
    long_month, short_month = month_number(s[1], MONTHS), month_number(m[1], ABBREVIATED)
    behind = F.when(long_month.isNotNull(), from_parts(s[2], long_month, s[0])).when(short_month.isNotNull(), from_parts(m[2], short_month, m[0]))
    return F.coalesce(labelled_date(datos, "Promulgaci[oó]n"), behind)


def last_modified(datos: Column | str, modified: Column) -> Column:
    return F.coalesce(labelled_date(datos, rf"[ÚU]ltima{WS}+Modificaci[oó]n"), labelled_date(datos, "Modificaci[oó]n"), parse_date(modified))


def issuing_body(author: Column) -> Column:
    """The author as stripped; a blank author stays empty and fails validation later."""
    return F.when(author.isNotNull() & (author != ""), strip(author)).otherwise(DEFAULT_BODY)


def version(datos: Column | str) -> Column:
    v = strip(group1(datos, rf"(?iu)Versi[oó]n:{WS}*([^\n\r-]+)"))
    return F.when(~F.lower(v).contains("nica"), v)


def subject_tags(keywords: Column | str) -> Column:
    """At most 15 tags in lower case: split at commas and semicolons if there are any, else at blanks and word ends."""
    k = strip(keywords)
    parted = F.filter(F.transform(F.split(k, rf"[,;]{WS}*"), strip), lambda x: F.length(x) > 3)
    broken = F.split(F.regexp_replace(k, "(CION|SION|DAD|TAD|NTE|CIA|DOR|DORA)([A-ZÑÁÉÍÓÚ])", "$1|$2"), rf"\||{WS}+")
    fused = F.array_distinct(F.transform(F.filter(broken, lambda x: F.length(x) >= 4), F.lower))
    tags = F.when(k.rlike("[,;]"), F.transform(parted, F.lower)).otherwise(fused)
    return F.when(not_empty(k).isNull(), F.array().cast("array<string>")).otherwise(F.slice(tags, 1, MAX_TAGS))


def full_content(page: str = "page") -> Column:
    """The first container whose text has 100 characters, else the paragraphs together, cleaned; else null."""
    return F.col(f"{page}.content")


def summary(description: Column, og_description: Column, element: Column, content: Column, title: Column) -> Column:
    """The first that says something: meta descriptions, a summary element, the content if short, the title."""

    def said(c: Column) -> Column:
        s = strip(c)
        return F.when((F.length(s) >= 50) & ~s.contains(SITE), F.substring(clean_text(s), 1, 2000))

    named = F.when(F.length(element) >= 50, F.substring(clean_text(element), 1, 2000))
    short = F.when((F.length(content) <= 1800) & (content != ""), content)
    return F.coalesce(said(description), said(og_description), named, short, F.concat(F.lit("Normativa sobre "), F.lower(title), F.lit(".")))


def official_url(norm_id: Column | str) -> Column:
    return F.concat(F.lit(URL), col(norm_id).cast("string"))


def parse_pages(df: DataFrame, norm_id: str = "norm_id", html: str = "html", status: str | None = None) -> DataFrame:
    """The 13 fields of every page that is worth parsing. Pages without title or content are dropped.

    The record is made as one value and then taken apart behind a generator, so that no later filter is pushed through
    it and evaluates the rules again for every field it reads.
    """
    p = with_page(fetched(df, html, status).select(norm_id, html), html)
    p = p.select(F.col(norm_id).alias("norm_id"), "page").where("page.raw_title is not null and page.content is not null")
    title, content, datos, desc = title_text(), full_content(), F.col("page.datos"), meta("description")
    record = F.struct(
        "norm_id", norm_type(title).alias("norm_type"), norm_number(title, "norm_id").alias("norm_number"), composed_title(title, desc).alias("title"),
        publication_date(datos, meta("article:published_time"), meta("article:modified_time")).alias("publication_date"),
        promulgation_date(datos, F.col("page.norm_start")).alias("promulgation_date"), last_modified(datos, meta("article:modified_time")).alias("last_modified"),
        issuing_body(meta("article:author")).alias("issuing_body"), version(datos).alias("norm_version"), subject_tags(meta("keywords")).alias("subject_tags"),
        official_url("norm_id").alias("official_url"), summary(desc, meta("og:description"), F.col("page.summary_text"), content, title).alias("summary"),
        content.alias("full_content"),
    )
    return p.select(F.explode(F.array(record)).alias("r")).select("r.*")
