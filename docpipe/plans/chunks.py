"""Queries on chunking, batching and the reports about them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docpipe.functions import chunking
from docpipe.functions.text import est_tokens
from docpipe.operators import batching, report
from docpipe.operators.chunk import chunk_counts, chunk_texts, cut_texts
from docpipe.plans.registry import SQL_WS, Registry, sql_strip, sql_tokens
from docpipe.session import once_per_key
from docpipe.sources.tables import table

R = Registry()

SQL_NORMALIZED = "regexp_replace(regexp_replace({x}, ' +', ' ', 'g'), '\\n{{3,}}', chr(10) || chr(10), 'g')"
SQL_SENTENCE = rf"\.{SQL_WS}+"
SQL_ARTICLE = rf"((?:Artículo|ARTÍCULO|Art\.){SQL_WS}+\d+)"


def sql_normalized(x: str) -> str:
    return SQL_NORMALIZED.format(x=sql_strip(x))


def sql_marks(x: str) -> str:
    signs = (rf"Artículo{SQL_WS}+\d+", rf"ARTÍCULO{SQL_WS}+\d+", rf"Art\.{SQL_WS}+\d+", rf"Artículo{SQL_WS}+[IVXLCDM]+")
    return "CAST(" + " + ".join(f"len(regexp_extract_all({x}, '{s}'))" for s in signs) + " AS INTEGER)"


def sql_parts(x: str, separator: str) -> str:
    """Parts of x at a separator regex, stripped, without empty ones."""
    s = sql_strip("p")
    return f"[{s} FOR p IN string_split_regex({x}, '{separator}') IF {s} <> '']"


def sql_chunks(source: str, key: str, mode: str = "auto") -> str:
    """CTEs ending in `chunked(key, whole, chunks)`: the packing as recursion over the parts of each text."""
    article = {"auto": f"{sql_marks('whole')} >= 3", "articles": "true", "paragraphs": "false"}[mode]
    marked = f"regexp_replace(whole, '{SQL_ARTICLE}', chr(1) || '\\1', 'g')"
    fold = """
        SELECT {keep}, parts, i + 1, CASE WHEN {fits} OR cur = '' THEN done ELSE list_append(done, cur) END,
          CASE WHEN {fits} AND cur <> '' THEN cur || {joiner} || parts[i] ELSE parts[i] END, CASE WHEN {fits} THEN tok ELSE 0 END + {t}
        FROM {name} WHERE i <= len(parts)"""
    t = sql_tokens("parts[i]")
    sub = fold.format(keep="k, u", name="sub", joiner="' '", t=t, fits=f"tok + {t} <= 1000")
    return f"""
    WITH RECURSIVE src AS (SELECT {key} AS k, {sql_normalized("text")} AS whole FROM ({source}) WHERE text IS NOT NULL),
    moded AS (SELECT k, whole, {article} AS art FROM src WHERE {sql_strip("whole")} <> ''),
    units AS (SELECT k, whole, art, CASE WHEN art THEN {sql_parts(marked, chr(92) + "x01")} ELSE {sql_parts("whole", chr(92) + "n" + chr(92) + "n")} END AS us FROM moded),
    unit AS (SELECT k, art, unnest(us) AS txt, unnest(range(1, len(us) + 1)) AS u FROM units),
    big AS (SELECT k, u, CASE WHEN art THEN {sql_parts("txt", chr(92) + "n" + chr(92) + "n")} ELSE {sql_parts("txt", SQL_SENTENCE)} END AS parts FROM unit WHERE {sql_tokens("txt")} > 1000),
    sub AS (SELECT k, u, parts, 1 AS i, CAST([] AS VARCHAR[]) AS done, '' AS cur, 0 AS tok FROM big UNION ALL {sub}),
    cut AS (SELECT k, u, CASE WHEN cur = '' THEN done ELSE list_append(done, cur) END AS pieces FROM sub WHERE i = len(parts) + 1),
    pieced AS (SELECT unit.k, unit.art, unit.u, txt, pieces FROM unit LEFT JOIN cut ON unit.k = cut.k AND unit.u = cut.u),
    listed AS (SELECT k, list({{'t': txt, 'p': pieces}} ORDER BY u) AS parts FROM pieced WHERE NOT art GROUP BY k),
    pack AS (SELECT k, parts, 1 AS i, CAST([] AS VARCHAR[]) AS done, '' AS cur, 0 AS tok FROM listed UNION ALL
        SELECT k, parts, i + 1,
          CASE WHEN parts[i].p IS NOT NULL THEN list_concat(CASE WHEN cur = '' THEN done ELSE list_append(done, cur) END, parts[i].p)
               WHEN cur = '' OR tok + {sql_tokens("parts[i].t")} <= 512 THEN done ELSE list_append(done, cur) END,
          CASE WHEN parts[i].p IS NOT NULL THEN '' WHEN cur <> '' AND tok + {sql_tokens("parts[i].t")} <= 512 THEN cur || chr(10) || chr(10) || parts[i].t ELSE parts[i].t END,
          CASE WHEN parts[i].p IS NOT NULL THEN 0 WHEN tok + {sql_tokens("parts[i].t")} <= 512 THEN tok + {sql_tokens("parts[i].t")} ELSE {sql_tokens("parts[i].t")} END
        FROM pack WHERE i <= len(parts)),
    chunks_of AS (SELECT k, CASE WHEN cur = '' THEN done ELSE list_append(done, cur) END AS chunks FROM pack WHERE i = len(parts) + 1
        UNION ALL SELECT k, flatten(list(CASE WHEN pieces IS NULL THEN [txt] ELSE pieces END ORDER BY u)) FROM pieced WHERE art GROUP BY k),
    chunked AS (SELECT moded.k, moded.whole, coalesce(chunks, CAST([] AS VARCHAR[])) AS chunks FROM moded LEFT JOIN chunks_of ON moded.k = chunks_of.k)
    """


SQL_TAIL = "CASE WHEN length({c}) <= 80 THEN {c} WHEN instr(right({c}, 80), '. ') > 0 THEN substr(right({c}, 80), instr(right({c}, 80), '. ') + 2) ELSE right({c}, 80) END"
SQL_OVERLAPPED = f"[CASE WHEN i = 1 THEN chunks[i] ELSE {SQL_TAIL.format(c='chunks[i - 1]')} || ' [...] ' || chunks[i] END FOR i IN range(1, len(chunks) + 1)]"

DOCS = "SELECT doc_id, text FROM documents"
# the derivations of SURVEY 7.4, so that every path is taken: line ends doubled, with article marks
DOUBLED = "SELECT doc_id, replace(text, chr(10), chr(10) || chr(10)) AS text FROM documents"
MARKED = "SELECT doc_id, replace(text, '. ', '.' || chr(10) || chr(10) || 'Artículo 1. ') AS text FROM documents"
NORMS = "SELECT norm_id, min(full_content) AS text FROM norms WHERE norm_id IS NOT NULL GROUP BY norm_id"


def documents(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", "text")


def norm_texts(spark: SparkSession, d: str) -> DataFrame:
    """One text per norm; only the texts of norms met more than once are moved."""
    n = table(spark, d, "norms").where("norm_id is not null").select("norm_id", F.col("full_content").alias("text"))
    return once_per_key(n, ["norm_id"], "text")


def doubled(spark: SparkSession, d: str) -> DataFrame:
    return documents(spark, d).withColumn("text", F.replace("text", F.lit("\n"), F.lit("\n\n")))


def marked(spark: SparkSession, d: str) -> DataFrame:
    return documents(spark, d).withColumn("text", F.replace("text", F.lit(". "), F.lit(".\n\nArtículo 1. ")))


@R.query(f"SELECT doc_id, {sql_tokens('text')} AS tokens FROM documents")
def token_estimate(spark: SparkSession, d: str) -> DataFrame:
    return documents(spark, d).select("doc_id", est_tokens("text").alias("tokens"))


@R.query(f"SELECT doc_id, {sql_normalized('text')} AS text FROM ({DOUBLED.replace('chr(10) || chr(10)', 'chr(10) || chr(10) || chr(10) || chr(32) || chr(32)')})")
def normalize_text(spark: SparkSession, d: str) -> DataFrame:
    longer = documents(spark, d).withColumn("text", F.replace("text", F.lit("\n"), F.lit("\n\n\n  ")))
    return longer.select("doc_id", chunking.normalize("text").alias("text"))


@R.query(f"SELECT norm_id, {sql_marks('text')} AS marks, {sql_marks('text')} >= 3 AS has_articles FROM ({NORMS}) WHERE text IS NOT NULL")
def detect_articles(spark: SparkSession, d: str) -> DataFrame:
    n = chunking.article_marks("text")
    return norm_texts(spark, d).where("text is not null").select("norm_id", n.alias("marks"), (n >= 3).alias("has_articles"))


SQL_EXPLODED = "SELECT k AS {key}, CAST(i - 1 AS INTEGER) AS chunk_index, chunks[i] AS chunk FROM (SELECT k, chunks, unnest(range(1, len(chunks) + 1)) AS i FROM chunked)"


@R.query(sql_chunks(NORMS, "norm_id", "articles") + SQL_EXPLODED.format(key="norm_id"))
def chunk_articles(spark: SparkSession, d: str) -> DataFrame:
    return cut_texts(norm_texts(spark, d), ["norm_id"], "text", chunking.by_articles)


@R.query(
    f"""WITH RECURSIVE src AS (SELECT doc_id AS k, {sql_parts(sql_normalized("text"), SQL_SENTENCE)} AS parts FROM documents WHERE text IS NOT NULL),
    f AS (SELECT k, parts, 1 AS i, CAST([] AS VARCHAR[]) AS done, '' AS cur, 0 AS tok FROM src UNION ALL
      SELECT k, parts, i + 1, CASE WHEN cur = '' OR tok + {sql_tokens("parts[i]")} <= 1000 THEN done ELSE list_append(done, cur) END,
        CASE WHEN cur <> '' AND tok + {sql_tokens("parts[i]")} <= 1000 THEN cur || ' ' || parts[i] ELSE parts[i] END,
        CASE WHEN tok + {sql_tokens("parts[i]")} <= 1000 THEN tok ELSE 0 END + {sql_tokens("parts[i]")} FROM f WHERE i <= len(parts)),
    chunked AS (SELECT k, CASE WHEN cur = '' THEN done ELSE list_append(done, cur) END AS chunks FROM f WHERE i = len(parts) + 1)
    {SQL_EXPLODED.format(key="doc_id")}"""
)
def chunk_sentences(spark: SparkSession, d: str) -> DataFrame:
    return cut_texts(documents(spark, d), ["doc_id"], "text", chunking.by_sentences)


@R.query(sql_chunks(DOUBLED, "doc_id", "paragraphs") + SQL_EXPLODED.format(key="doc_id"))
def chunk_paragraphs(spark: SparkSession, d: str) -> DataFrame:
    return cut_texts(doubled(spark, d), ["doc_id"], "text", chunking.by_paragraphs)


@R.query(sql_chunks(DOUBLED, "doc_id") + f", lapped AS (SELECT k, {SQL_OVERLAPPED} AS chunks FROM chunked) " + SQL_EXPLODED.format(key="doc_id").replace("FROM chunked", "FROM lapped"))
def chunk_overlap(spark: SparkSession, d: str) -> DataFrame:
    return cut_texts(doubled(spark, d), ["doc_id"], "text", lambda whole: chunking.with_overlap(chunking.plain_chunks(whole)))


SQL_ROWS = f"""SELECT k AS {{key}}, CAST(i - 1 AS INTEGER) AS chunk_index, CAST(len(lap) AS INTEGER) AS chunk_total, lap[i] AS text, {sql_tokens("lap[i]")} AS token_count,
  CAST(instr(whole, lap[i]) - 1 AS INTEGER) AS char_start, CAST(instr(whole, lap[i]) - 1 + length(lap[i]) AS INTEGER) AS char_end
  FROM (SELECT k, whole, {SQL_OVERLAPPED} AS lap, unnest(range(1, len(chunks) + 1)) AS i FROM chunked)"""


@R.query(sql_chunks(DOCS, "doc_id") + SQL_ROWS.format(key="doc_id"))
def chunk_offsets(spark: SparkSession, d: str) -> DataFrame:
    return chunk_texts(documents(spark, d), ["doc_id"], "text")


@R.query(sql_chunks(NORMS, "norm_id") + SQL_ROWS.format(key="norm_id"))
def chunk_norms(spark: SparkSession, d: str) -> DataFrame:
    return chunk_texts(norm_texts(spark, d), ["norm_id"], "text")


@R.query(sql_chunks(MARKED, "doc_id") + "SELECT k AS doc_id, CAST(len(chunks) AS INTEGER) AS chunks FROM chunked")
def chunk_marked_documents(spark: SparkSession, d: str) -> DataFrame:
    return chunk_counts(marked(spark, d), ["doc_id"], "text")


SQL_COUNTS = sql_chunks(NORMS, "norm_id") + ", counts AS (SELECT k, CAST(len(chunks) AS INTEGER) AS chunks FROM chunked), s AS (SELECT list(chunks ORDER BY chunks) AS l FROM counts)"


@R.query(
    SQL_COUNTS
    + """SELECT (SELECT count(*) FROM counts) AS docs, (SELECT CAST(sum(chunks) AS BIGINT) FROM counts) AS total_chunks, (SELECT avg(chunks) FROM counts) AS mean_chunks,
    (SELECT min(chunks) FROM counts) AS min_chunks, (SELECT max(chunks) FROM counts) AS max_chunks, l[CAST(floor(len(l) * 0.5) AS BIGINT) + 1] AS median,
    l[CAST(floor(len(l) * CAST(0.9 AS DOUBLE)) AS BIGINT) + 1] AS p90, l[CAST(floor(len(l) * CAST(0.95 AS DOUBLE)) AS BIGINT) + 1] AS p95 FROM s"""
)
def chunks_per_doc_report(spark: SparkSession, d: str) -> DataFrame:
    return report.chunk_report(chunk_counts(norm_texts(spark, d), ["norm_id"], "text"))


@R.query(
    SQL_COUNTS
    + """SELECT CAST(least(chunks, 10) AS INTEGER) AS bucket, CASE WHEN least(chunks, 10) = 10 THEN '10+' ELSE CAST(least(chunks, 10) AS VARCHAR) END AS label, count(*) AS n,
    count(*) * CAST(100 AS DOUBLE) / (SELECT count(*) FROM counts) AS pct, repeat('#', CAST(floor(count(*) * CAST(100 AS DOUBLE) / (SELECT count(*) FROM counts) / 2) AS INTEGER)) AS bar
    FROM counts GROUP BY least(chunks, 10)"""
)
def chunk_histogram(spark: SparkSession, d: str) -> DataFrame:
    return report.histogram(chunk_counts(norm_texts(spark, d), ["norm_id"], "text"))


@R.query(
    SQL_COUNTS
    + """SELECT c AS chunks, dd AS days, abs((SELECT avg(chunks) FROM counts) - c) < 0.5 AS applies, CAST(floor(411000 * (SELECT avg(chunks) FROM counts) * 512 / CAST(16200000 AS DOUBLE)) AS INTEGER) AS projected_days
    FROM (VALUES (3, 39), (4, 52), (5, 65), (6, 78)) v(c, dd)"""
)
def scenario_lookup(spark: SparkSession, d: str) -> DataFrame:
    return report.scenario_lookup(report.chunk_report(chunk_counts(norm_texts(spark, d), ["norm_id"], "text")))


def _units(spark: SparkSession, d: str) -> DataFrame:
    return documents(spark, d).groupBy("doc_id").agg(F.max(est_tokens("text")).alias("tokens")).withColumn("unit", F.floor(F.col("doc_id") / 960))


SQL_BATCHES = f"""WITH RECURSIVE src AS (SELECT CAST(floor(doc_id / 960) AS BIGINT) AS unit, list({{{{'o': doc_id, 't': t}}}} ORDER BY doc_id) AS s
      FROM (SELECT doc_id, max({sql_tokens("text")}) * {{scale}} AS t FROM documents GROUP BY doc_id) WHERE t IS NOT NULL GROUP BY ALL),
    f AS (SELECT unit, s, 1 AS i, 0 AS batch, 0 AS size, 0 AS tokens, CAST(NULL AS BIGINT) AS doc_id, CAST(NULL AS INTEGER) AS t, CAST(NULL AS INTEGER) AS b FROM src UNION ALL
      SELECT unit, s, i + 1,
        CASE WHEN s[i].t > 100000 THEN batch + CASE WHEN size > 0 THEN 2 ELSE 1 END WHEN size > 0 AND (size >= 96 OR tokens + s[i].t > 100000) THEN batch + 1 ELSE batch END,
        CASE WHEN s[i].t > 100000 THEN 0 WHEN size >= 96 OR tokens + s[i].t > 100000 THEN 1 ELSE size + 1 END,
        CASE WHEN s[i].t > 100000 THEN 0 WHEN size >= 96 OR tokens + s[i].t > 100000 THEN s[i].t ELSE tokens + s[i].t END,
        s[i].o, s[i].t, CASE WHEN size > 0 AND (s[i].t > 100000 OR size >= 96 OR tokens + s[i].t > 100000) THEN batch + 1 ELSE batch END
      FROM f WHERE i <= len(s)),
    batched AS (SELECT unit, doc_id, t AS tokens, b AS batch FROM f WHERE doc_id IS NOT NULL)"""


@R.query(SQL_BATCHES.format(scale=1) + "SELECT * FROM batched")
def greedy_batches(spark: SparkSession, d: str) -> DataFrame:
    return batching.greedy_batches(_units(spark, d), "unit", "doc_id", "tokens")


@R.query(SQL_BATCHES.format(scale=20) + "SELECT * FROM batched")
def greedy_batches_large_texts(spark: SparkSession, d: str) -> DataFrame:
    big = _units(spark, d).withColumn("tokens", F.col("tokens") * 20)
    return batching.greedy_batches(big, "unit", "doc_id", "tokens")


@R.query(
    SQL_BATCHES.format(scale=1)
    + """SELECT CAST(coalesce(sum(n), 0) AS BIGINT) AS total_chunks, count(*) AS batches_created, CAST(coalesce(sum(o), 0) AS BIGINT) AS oversized, coalesce(avg(n), CAST(0 AS DOUBLE)) AS avg_batch_size
    FROM (SELECT unit, batch, count(*) AS n, count_if(tokens > 100000) AS o FROM batched GROUP BY ALL)"""
)
def batch_stats(spark: SparkSession, d: str) -> DataFrame:
    return batching.batch_stats(greedy_batches(spark, d), "unit", "tokens")


@R.query("SELECT unit, doc_id, CAST(floor((row_number() OVER (PARTITION BY unit ORDER BY doc_id) - 1) / 96) AS INTEGER) AS batch FROM (SELECT DISTINCT doc_id, CAST(floor(doc_id / 960) AS BIGINT) AS unit FROM documents)")
def fixed_batches(spark: SparkSession, d: str) -> DataFrame:
    return batching.fixed_batches(documents(spark, d).withColumn("unit", F.floor(F.col("doc_id") / 960)), "unit", "doc_id")


@R.query(f"SELECT norm_id, avg({sql_tokens('text')}) AS avg_tokens, count(*) AS n FROM (SELECT DISTINCT norm_id, chunk_index, text FROM chunks WHERE text IS NOT NULL) GROUP BY norm_id")
def avg_tokens_per_chunk(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "chunks").where("text is not null").select("norm_id", "chunk_index", "text").distinct()
    return c.groupBy("norm_id").agg(F.avg(est_tokens("text")).alias("avg_tokens"), F.count("*").alias("n"))
