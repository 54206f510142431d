"""Queries on page parsing, field extraction and validation. Pages are rendered from the norms, so SQL can say what must come back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docpipe.functions.dates import ABBREVIATED, MONTHS, parse_date
from docpipe.functions.text import strip
from docpipe.operators import extract, validate
from docpipe.plans.registry import SQL_WS, Registry, sql_clean, sql_squeeze, sql_strip
from docpipe.sources.html import fetched, meta, with_page
from docpipe.sources.tables import table

R = Registry()
TAIL = "</div></div></body></html>"


def escaped(c: Column) -> Column:
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


def month_name(c: str, names: tuple[str, ...]) -> Column:
    return F.element_at(F.array(*map(F.lit, names)), F.month(c))


def short_date(c: str) -> Column:
    """d-MMM-yyyy in Spanish capitals."""
    return F.concat_ws("-", F.format_string("%02d", F.dayofmonth(c)), F.upper(month_name(c, ABBREVIATED)), F.year(c))


def pages(spark: SparkSession, d: str) -> DataFrame:
    """norm_id, html of every norm row; where a field is null its place is missing."""
    n = table(spark, d, "norms")

    def tag(name: str, value: Column) -> Column:
        return F.coalesce(F.concat(F.lit(f'<meta name="{name}" content="'), escaped(value), F.lit('">')), F.lit(""))

    def datum(label: str, value: Column) -> Column:
        return F.coalesce(F.concat(F.lit(f"<b>{label}:</b>"), value, F.lit("\n")), F.lit(""))

    body = F.concat_ws("", F.transform(F.split(escaped(F.coalesce("full_content", F.lit(""))), "\n"), lambda p: F.concat(F.lit("<p>"), p, F.lit("</p>"))))
    html = F.concat(
        F.lit('<html><head><meta charset="utf-8"><title>Ley Chile - '), escaped(F.col("title")), F.lit(" - Biblioteca del Congreso Nacional</title>"),
        tag("description", F.col("summary")), tag("article:author", F.col("issuing_body")), tag("keywords", F.upper(F.array_join("subject_tags", ", "))),
        tag("article:published_time", F.date_format("publication_date", "yyyy-MM-dd")), tag("article:modified_time", F.date_format("last_modified", "yyyy-MM-dd")),
        F.lit("</head><body><script>var x = '<p>no</p>';</script><h1>"), escaped(F.col("title")), F.lit('</h1><div class="caja datos">'),
        datum("Promulgación", short_date("promulgation_date")), datum("Última Modificación", short_date("last_modified")), datum("Versión", F.concat(escaped(F.col("norm_version")), F.lit(" -03-AGO-2026"))),
        F.lit('</div><div class="cuerpo-norma"><div class="texto_norma">'), body, F.lit(TAIL),
    )
    return n.select("norm_id", html.alias("html"))


SQL_JOINED = f"array_to_string([{sql_strip('p')} FOR p IN string_split(full_content, chr(10)) IF {sql_strip('p')} <> ''], chr(10) || chr(10))"
SQL_CONTENT = f"CASE WHEN length({SQL_JOINED}) >= 100 THEN {sql_clean(SQL_JOINED)} END"
SQL_TITLE = f"nullif({sql_strip('title')}, '')"


@R.query(f"SELECT norm_id, {SQL_TITLE} AS title_text FROM norms")
def title_text(spark: SparkSession, d: str) -> DataFrame:
    return with_page(pages(spark, d), "html").select("norm_id", extract.title_text().alias("title_text"))


SQL_TYPE = r"""CASE WHEN regexp_matches(upper(title), '\bCODIGO\b') THEN 'codigo' WHEN regexp_matches(upper(title), '\bD\.?F\.?L\.?\b') THEN 'dfl'
  WHEN regexp_matches(upper(title), '\bDECRETO\b') AND NOT contains(upper(title), 'LEY') THEN 'decreto' WHEN regexp_matches(upper(title), '\bREGLAMENTO\b') THEN 'reglamento' ELSE 'ley' END"""
SQL_NUMBER = rf"""coalesce(nullif(translate(regexp_extract(title, '(?i)N[UÚuú]M\.?{SQL_WS}*(\d[\d.,\t\n\x0B\f\r -]*)', 1), '., ', ''), ''),
  nullif(regexp_extract(title, '(?i)(?:DFL|DECRETO){SQL_WS}+(\d+)', 1), ''), CAST(norm_id AS VARCHAR))"""


@R.query(f"SELECT norm_id, title, {SQL_TYPE} AS norm_type FROM norms")
def norm_type(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "norms").select("norm_id", "title", extract.norm_type("title").alias("norm_type"))


@R.query(f"SELECT norm_id, title, {SQL_NUMBER} AS norm_number FROM norms")
def norm_number(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "norms").select("norm_id", "title", extract.norm_number("title", "norm_id").alias("norm_number"))


SQL_COMPOSED = rf"""WITH b AS (SELECT norm_id, title AS r, coalesce({sql_strip("summary")}, '') AS d,
    nullif(regexp_extract(title, '(?i)Decreto{SQL_WS}+(\d+)', 1), '') AS de, nullif(regexp_extract(title, '(?i)Ley{SQL_WS}+(?:N[°Úúu]?m?\.?{SQL_WS}*)?(\d+[\d.,]*)', 1), '') AS le,
    nullif(regexp_extract(title, '(?i)DFL{SQL_WS}+(\d+)', 1), '') AS df FROM norms),
  m AS (SELECT *, CASE WHEN de IS NOT NULL THEN 'Decreto ' || de || ': ' || d WHEN le IS NOT NULL THEN 'Ley ' || translate(le, '.,', '') || ': ' || d
    WHEN df IS NOT NULL THEN 'DFL ' || df || ': ' || d WHEN length(d) > 20 THEN d ELSE r END AS made FROM b)
  SELECT norm_id, CASE WHEN length(d) < 20 OR contains(d, 'Ley Chile') OR contains(r, substr(d, 1, 50)) THEN r WHEN length(made) > 200 THEN substr(made, 1, 197) || '...' ELSE made END AS title FROM m"""


@R.query(SQL_COMPOSED)
def title_compose(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "norms").select("norm_id", extract.composed_title("title", "summary").alias("title"))


SQL_MONTHS = "['" + "', '".join(MONTHS) + "']"
SQL_SHORTS = "['" + "', '".join(m.upper() for m in ABBREVIATED) + "']"


@R.query(
    """SELECT norm_id, CASE norm_id % 6 WHEN 0 THEN publication_date WHEN 1 THEN publication_date WHEN 2 THEN publication_date ELSE NULL END AS parsed
    FROM norms WHERE publication_date IS NOT NULL"""
)
def date_parse(spark: SparkSession, d: str) -> DataFrame:
    """Dates written in six ways, three of them readable: ISO, d-MMM-yyyy, long form; ISO time, no such day, no such month."""
    n = table(spark, d, "norms").where("publication_date is not null")
    p, day, year = "publication_date", F.dayofmonth("publication_date").cast("string"), F.year("publication_date").cast("string")
    ways = F.array(
        F.date_format(p, "yyyy-MM-dd"), F.concat(short_date(p), F.lit(" foo")), F.concat(day, F.lit(" de "), F.initcap(month_name(p, MONTHS)), F.lit(" de "), year),
        F.concat(F.date_format(p, "yyyy-MM-dd"), F.lit("T10:00")), F.concat(F.lit("31-FEB-"), year), F.concat(day, F.lit("-XYZ-"), year),
    )
    return n.select("norm_id", parse_date(F.get(ways, (F.col("norm_id") % 6).cast("int"))).alias("parsed"))


@R.query("SELECT norm_id, coalesce(publication_date, last_modified, DATE '2000-01-01') AS publication_date FROM norms")
def publication_date(spark: SparkSession, d: str) -> DataFrame:
    p = with_page(pages(spark, d), "html")
    return p.select("norm_id", extract.publication_date("page.datos", meta("article:published_time"), meta("article:modified_time")).alias("publication_date"))


@R.query("SELECT norm_id, promulgation_date FROM norms")
def promulgation_date(spark: SparkSession, d: str) -> DataFrame:
    p = with_page(pages(spark, d), "html")
    return p.select("norm_id", extract.promulgation_date("page.datos", F.lit("")).alias("promulgation_date"))


@R.query("SELECT norm_id, promulgation_date FROM norms")
def promulgation_date_in_text(spark: SparkSession, d: str) -> DataFrame:
    """The same date read from the place and date line of the text."""
    p = F.col("promulgation_date")
    line = F.concat(F.lit("Santiago, "), F.dayofmonth(p), F.lit(" de "), month_name("promulgation_date", MONTHS), F.lit(" de "), F.year(p))
    n = table(spark, d, "norms").select("norm_id", F.concat(F.lit("Visto: lo dispuesto. "), F.coalesce(line, F.lit(""))).alias("start"))
    return n.select("norm_id", extract.promulgation_date(F.lit(""), F.col("start")).alias("promulgation_date"))


@R.query("SELECT norm_id, last_modified FROM norms")
def last_modified(spark: SparkSession, d: str) -> DataFrame:
    p = with_page(pages(spark, d), "html")
    return p.select("norm_id", extract.last_modified("page.datos", meta("article:modified_time")).alias("last_modified"))


@R.query(f"SELECT norm_id, CASE WHEN issuing_body IS NULL OR issuing_body = '' THEN 'CONGRESO NACIONAL' ELSE {sql_strip('issuing_body')} END AS issuing_body FROM norms")
def issuing_body(spark: SparkSession, d: str) -> DataFrame:
    return with_page(pages(spark, d), "html").select("norm_id", extract.issuing_body(meta("article:author")).alias("issuing_body"))


SQL_VERSION = f"{sql_strip('regexp_extract(norm_version, $$^[^-]+$$)')}"


@R.query(f"SELECT norm_id, CASE WHEN norm_version IS NULL OR contains(lower({SQL_VERSION}), 'nica') THEN NULL ELSE {SQL_VERSION} END AS norm_version FROM norms")
def version_tag(spark: SparkSession, d: str) -> DataFrame:
    return with_page(pages(spark, d), "html").select("norm_id", extract.version("page.datos").alias("norm_version"))


SQL_KEYS = f"{sql_strip('upper(array_to_string(subject_tags, $$, $$))')}"
SQL_SPLIT_TAGS = f"[lower({sql_strip('t')}) FOR t IN string_split_regex({SQL_KEYS}, '[,;]{SQL_WS}*') IF length({sql_strip('t')}) > 3]"
SQL_FUSED = f"string_split_regex(regexp_replace({SQL_KEYS}, '(CION|SION|DAD|TAD|NTE|CIA|DOR|DORA)([A-ZÑÁÉÍÓÚ])', '\\1|\\2', 'g'), '\\||{SQL_WS}+')"


def sql_first_seen(x: str) -> str:
    return f"[v FOR v, i IN {x} IF list_position({x}, v) = i]"


SQL_TAGS = f"""CASE WHEN nullif({SQL_KEYS}, '') IS NULL THEN CAST([] AS VARCHAR[]) WHEN regexp_matches({SQL_KEYS}, '[,;]') THEN list_slice({SQL_SPLIT_TAGS}, 1, 15)
  ELSE list_slice({sql_first_seen(f"[lower(t) FOR t IN {SQL_FUSED} IF length(t) >= 4]")}, 1, 15) END"""


@R.query(f"SELECT norm_id, {SQL_TAGS} AS tags FROM norms")
def subject_tags_delimited(spark: SparkSession, d: str) -> DataFrame:
    return with_page(pages(spark, d), "html").select("norm_id", extract.subject_tags(F.coalesce(meta("keywords"), F.lit(""))).alias("tags"))


SQL_FUSED_KEYS = "replace(" + SQL_KEYS + ", ', ', '')"


@R.query(f"SELECT norm_id, {SQL_TAGS.replace(SQL_KEYS, SQL_FUSED_KEYS)} AS tags FROM norms")
def subject_tags_fused(spark: SparkSession, d: str) -> DataFrame:
    p = with_page(pages(spark, d), "html").select("norm_id", F.replace(F.coalesce(meta("keywords"), F.lit("")), F.lit(", "), F.lit("")).alias("k"))
    return p.select("norm_id", extract.subject_tags("k").alias("tags"))


SQL_SUMMARY = f"""coalesce(CASE WHEN length({sql_strip("summary")}) >= 50 AND NOT contains(summary, 'Ley Chile') THEN substr({sql_clean(sql_strip("summary"))}, 1, 2000) END,
  CASE WHEN length({SQL_CONTENT}) <= 1800 AND ({SQL_CONTENT}) <> '' THEN {SQL_CONTENT} END, 'Normativa sobre ' || lower({SQL_TITLE}) || '.')"""


@R.query(f"SELECT norm_id, {SQL_SUMMARY} AS summary FROM norms")
def summary_fallback(spark: SparkSession, d: str) -> DataFrame:
    p = with_page(pages(spark, d), "html").withColumn("content", extract.full_content())
    return p.select("norm_id", extract.summary(meta("description"), meta("og:description"), F.col("page.summary_text"), F.col("content"), extract.title_text()).alias("summary"))


@R.query(f"SELECT norm_id, {SQL_CONTENT} AS full_content FROM norms")
def full_content(spark: SparkSession, d: str) -> DataFrame:
    return with_page(pages(spark, d), "html").select("norm_id", extract.full_content().alias("full_content"))


@R.query(f"SELECT norm_id, {SQL_CONTENT} AS full_content FROM norms")
def full_content_paragraphs(spark: SparkSession, d: str) -> DataFrame:
    """Pages without any known container: the paragraphs alone."""
    bare = pages(spark, d).withColumn("html", F.replace(F.replace("html", F.lit('class="texto_norma"'), F.lit('class="x"')), F.lit('class="cuerpo-norma"'), F.lit('id="y"')))
    return with_page(bare, "html").select("norm_id", extract.full_content().alias("full_content"))


@R.query(f"SELECT norm_id, {sql_clean(SQL_JOINED.replace('string_split(full_content', 'string_split(full_content'))} || ' [Ley 1 D.O. 2] fin' AS full_content FROM norms WHERE length({SQL_JOINED}) >= 100")
def dom_container_notes(spark: SparkSession, d: str) -> DataFrame:
    """A margin note stays in place, in brackets."""
    noted = pages(spark, d).withColumn("html", F.replace("html", F.lit(TAIL), F.lit(f'<span class="n">Ley 1<br> D.O. 2</span>fin{TAIL}')))
    long = table(spark, d, "norms").select("norm_id", F.array_join(F.filter(F.transform(F.split("full_content", "\n"), strip), lambda x: x != ""), "\n\n").alias("j")).where("length(j) >= 100").select("norm_id").distinct()
    return with_page(noted.join(long, "norm_id", "left_semi"), "html").select("norm_id", extract.full_content().alias("full_content"))


SQL_HTML_LENGTH = "length(title) + length(full_content)"


@R.query(f"SELECT norm_id FROM norms WHERE {SQL_HTML_LENGTH} >= 1000")
def html_min_length(spark: SparkSession, d: str) -> DataFrame:
    """Pages of at least 1000 characters; the title and text stand for the page, so that SQL knows its length."""
    n = table(spark, d, "norms").select("norm_id", F.concat("title", "full_content").alias("html"))
    return fetched(n, "html").select("norm_id")


@R.query("SELECT norm_id, event FROM scrape_log WHERE length(event) >= 9 AND event <> 'norm_not_found' AND event NOT IN ('fetch_timeout', 'parse_failed', 'retry_scheduled', 'skipping_placeholder')")
def http_status_split(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "scrape_log")
    status = F.when(F.col("event") == "norm_not_found", 404).when(F.col("event").isin("fetch_timeout", "parse_failed", "retry_scheduled", "skipping_placeholder"), 500).otherwise(200)
    return fetched(e.withColumn("status", status), "event", "status", least=9).select("norm_id", "event")


@R.query("SELECT norm_id, length(full_content) AS n FROM (SELECT norm_id, full_content, CASE WHEN norm_id % 3 = 0 THEN title || ' - Biblioteca del Congreso Nacional' ELSE title END AS title FROM norms) WHERE NOT (length(full_content) < 500 AND contains(title, 'Biblioteca del Congreso Nacional'))")
def placeholder_filter(spark: SparkSession, d: str) -> DataFrame:
    n = table(spark, d, "norms").withColumn("title", F.when(F.col("norm_id") % 3 == 0, F.concat("title", F.lit(" - Biblioteca del Congreso Nacional"))).otherwise(F.col("title")))
    return n.where(~validate.is_placeholder()).select("norm_id", F.length("full_content").cast("long").alias("n"))


def sql_reasons(src: str) -> str:
    rules = {
        "norm_id": "norm_id > 0", "norm_type": "norm_type IN ('ley', 'codigo', 'dfl', 'decreto', 'reglamento')", "norm_number": "length(norm_number) >= 1", "title": "length(title) BETWEEN 10 AND 500",
        "publication_date": "publication_date IS NOT NULL", "issuing_body": "length(issuing_body) >= 5", "official_url": "regexp_matches(official_url, '(?i)^https?://[^/]+')", "summary": "length(summary) BETWEEN 50 AND 2000",
        "full_content": "length(full_content) >= 100 AND NOT contains(lower(full_content), '<html') AND NOT contains(lower(full_content), 'javascript:')",
    }
    return "[x FOR x IN [" + ", ".join(f"CASE WHEN NOT coalesce({v}, false) THEN '{k}' END" for k, v in rules.items()) + "] IF x IS NOT NULL]"


@R.query(f"SELECT norm_id, {sql_reasons('norms')} AS reject_reason FROM norms")
def validation_reject_reasons(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "norms").select("norm_id", validate.reject_reasons().alias("reject_reason"))


@R.query(
    f"""SELECT norm_id, {sql_strip(sql_squeeze("title"))} AS title, {sql_strip("full_content")} AS full_content,
    [lower({sql_strip("t")}) FOR t IN coalesce(subject_tags, CAST([] AS VARCHAR[])) IF lower({sql_strip("t")}) <> ''] AS subject_tags FROM norms WHERE len({sql_reasons("norms")}) = 0"""
)
def validated_norms(spark: SparkSession, d: str) -> DataFrame:
    return validate.validated(table(spark, d, "norms")).select("norm_id", "title", "full_content", "subject_tags")


SQL_PARSED = f"""SELECT norm_id, {SQL_TYPE.replace("title", "t")} AS norm_type, coalesce(publication_date, last_modified, DATE '2000-01-01') AS publication_date, promulgation_date, last_modified,
  CASE WHEN issuing_body IS NULL OR issuing_body = '' THEN 'CONGRESO NACIONAL' ELSE {sql_strip("issuing_body")} END AS issuing_body, {SQL_SUMMARY} AS summary, {SQL_CONTENT} AS full_content, t
  FROM (SELECT *, {SQL_TITLE} AS t FROM norms)"""


@R.query(
    f"""SELECT norm_id, norm_type, publication_date, promulgation_date, last_modified, issuing_body, summary, {sql_strip("full_content")} AS full_content FROM ({SQL_PARSED}) WHERE full_content IS NOT NULL AND t IS NOT NULL AND length(issuing_body) >= 5
    AND length(summary) BETWEEN 50 AND 2000 AND length(full_content) >= 100 AND NOT contains(lower(full_content), '<html') AND NOT contains(lower(full_content), 'javascript:') AND length(t) >= 10"""
)
def parse_validate_pages(spark: SparkSession, d: str) -> DataFrame:
    p = extract.parse_pages(pages(spark, d).withColumn("html", F.concat("html", F.lit(" " * 1000))))
    return validate.validated(p).select("norm_id", "norm_type", "publication_date", "promulgation_date", "last_modified", "issuing_body", "summary", "full_content")
