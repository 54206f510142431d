"""Queries on ranges, skip lists, index rows, upserts, counters, checkpoints, logs, timings and streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docpipe.operators import checkpoint, embed, index, report, validate
from docpipe.operators.chunk import chunk_counts, chunk_texts
from docpipe.plans.chunks import NORMS, norm_texts, sql_chunks
from docpipe.plans.registry import Registry
from docpipe.sources import ranges
from docpipe.sources.tables import table
from docpipe.streaming import resume

R = Registry()


def log(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "scrape_log")


@R.query("SELECT CAST(greatest(1, least(floor((norm_id - 1) / 250) + 1, 8)) AS INTEGER) AS instance, count(*) AS n, min(norm_id) AS first_seen, max(norm_id) AS last_seen FROM scrape_log WHERE norm_id IS NOT NULL GROUP BY 1")
def id_range_partition(spark: SparkSession, d: str) -> DataFrame:
    e = log(spark, d).where("norm_id is not null").withColumn("instance", ranges.instance_of("norm_id", 8, 2000))
    return e.groupBy("instance").agg(F.count("*").alias("n"), F.min("norm_id").alias("first_seen"), F.max("norm_id").alias("last_seen"))


@R.query("SELECT CAST(i AS INTEGER) AS instance, CAST((i - 1) * 250000 + 1 AS BIGINT) AS first_id, CAST(i * 250000 AS BIGINT) AS last_id FROM range(1, 9) t(i)")
def range_plan(spark: SparkSession, d: str) -> DataFrame:
    return ranges.range_plan(spark)


@R.query("SELECT r AS norm_id FROM range(1, 10001) t(r) WHERE r NOT IN (SELECT norm_id FROM scrape_log WHERE norm_id IS NOT NULL)")
def ids_never_fetched(spark: SparkSession, d: str) -> DataFrame:
    return validate.without(ranges.id_range(spark, 1, 10000), log(spark, d), "norm_id")


@R.query("SELECT id AS norm_id FROM range(1, (SELECT max(norm_id) FROM scrape_log) + 1) t(id) WHERE id NOT IN (SELECT norm_id FROM scrape_log WHERE norm_id IS NOT NULL)")
def ids_missing_so_far(spark: SparkSession, d: str) -> DataFrame:
    """Ids up to the last of the log that were never fetched."""
    last = log(spark, d).agg(F.max("norm_id")).first()[0]
    return validate.without(ranges.id_range(spark, 1, last), log(spark, d), "norm_id")


SQL_LATEST = """SELECT instance_id, unnest(max({'last_id_processed': last_id_processed, 'saved_at': saved_at, 'total_processed': total_processed, 'success_count': success_count, 'failed_count': failed_count,
  'skipped_count': skipped_count, 'retry_count': retry_count, 'status': status})) FROM checkpoints WHERE instance_id IS NOT NULL GROUP BY instance_id"""


@R.query(f"SELECT * FROM ({SQL_LATEST}) WHERE instance_id = 'scr-00000'")
def keyed_lookup(spark: SparkSession, d: str) -> DataFrame:
    return checkpoint.latest_checkpoints(table(spark, d, "checkpoints").where("instance_id = 'scr-00000'"))


@R.query(SQL_LATEST)
def checkpoint_state(spark: SparkSession, d: str) -> DataFrame:
    return checkpoint.latest_checkpoints(table(spark, d, "checkpoints"))


@R.query("SELECT instance_id, last_id_processed, CASE WHEN instance_id = 'scr-00000' THEN 'failed' ELSE status END AS status, CASE WHEN instance_id = 'scr-00000' THEN '2025-02-01T00:00:00' ELSE failed_at END AS failed_at, CASE WHEN instance_id = 'scr-00000' THEN 'timeout' ELSE error_message END AS error_message FROM checkpoints")
def checkpoint_mark_failed(spark: SparkSession, d: str) -> DataFrame:
    return checkpoint.mark(table(spark, d, "checkpoints"), "scr-00000", "failed", "2025-02-01T00:00:00", "timeout").select("instance_id", "last_id_processed", "status", "failed_at", "error_message")


@R.query(
    f"""SELECT p.instance_id, CAST(coalesce(nullif(last_id_processed, 0) + 1, first_id, 1) AS BIGINT) AS start_id FROM (SELECT 'scr-' || printf('%05d', i - 1) AS instance_id, (i - 1) * 250000 + 1 AS first_id FROM range(1, 9) t(i)) p
    LEFT JOIN ({SQL_LATEST}) c ON p.instance_id = c.instance_id"""
)
def resume_points(spark: SparkSession, d: str) -> DataFrame:
    plan = ranges.range_plan(spark).select(F.format_string("scr-%05d", F.col("instance") - 1).alias("instance_id"), "first_id")
    return checkpoint.resume_points(plan, checkpoint.latest_checkpoints(table(spark, d, "checkpoints")))


@R.query("SELECT DISTINCT norm_id FROM scrape_log WHERE event = 'norm_not_found' AND norm_id IS NOT NULL")
def skip_list_parse(spark: SparkSession, d: str) -> DataFrame:
    """A skip list with blanks around ids and lines of words between them."""
    lines = log(spark, d).select(F.when(F.col("event") == "norm_not_found", F.concat(F.lit(" \t"), F.col("norm_id").cast("string"), F.lit("  "))).otherwise(F.concat(F.col("event"), F.lit(" "), F.col("norm_id"))).alias("line"))
    return ranges.skip_ids(lines, "line")


@R.query("SELECT norm_id, title FROM norms WHERE NOT EXISTS (SELECT 1 FROM scrape_log s WHERE s.norm_id = norms.norm_id AND event = 'parse_failed')")
def skip_anti_join(spark: SparkSession, d: str) -> DataFrame:
    return validate.without(table(spark, d, "norms"), log(spark, d).where("event = 'parse_failed'"), "norm_id").select("norm_id", "title")


@R.query("SELECT 'legal-norms/originals/bcn-' || doc_id || '.json' AS key, doc_id FROM documents ORDER BY key LIMIT 1000")
def head_sample_by_key(spark: SparkSession, d: str) -> DataFrame:
    key = ranges.object_key(index.KNOWLEDGE_ID, ranges.doc_key("doc_id"))
    return ranges.first_by_key(table(spark, d, "documents").select("doc_id"), key).select("key", "doc_id")


SQL_OUTCOME = "CASE event WHEN 'document_stored' THEN 'ok' WHEN 'norm_not_found' THEN 'not_found' WHEN 'fetch_timeout' THEN 'timeout' WHEN 'parse_failed' THEN 'unparseable' WHEN 'skipping_placeholder' THEN 'placeholder' WHEN 'retry_scheduled' THEN 'retry' ELSE 'other' END"


def outcomes(spark: SparkSession, d: str) -> DataFrame:
    names = {"document_stored": "ok", "norm_not_found": "not_found", "fetch_timeout": "timeout", "parse_failed": "unparseable", "skipping_placeholder": "placeholder", "retry_scheduled": "retry"}
    o = F.lit("other")
    for k, v in names.items():
        o = F.when(F.col("event") == k, v).otherwise(o)
    return log(spark, d).distinct().withColumn("outcome", o)


@R.query(
    f"""WITH o AS (SELECT instance_id, {SQL_OUTCOME} AS o FROM (SELECT DISTINCT * FROM scrape_log)),
    c AS (SELECT instance_id, count_if(o = 'ok') AS success_count, count_if(o IN ('not_found', 'timeout', 'unparseable')) AS failed_count, count_if(o = 'not_found') * 3 + count_if(o = 'placeholder') AS skipped_count,
      count_if(o = 'placeholder') AS final_skipped, count_if(o = 'retry') AS retry_count, count_if(o IN ('ok', 'not_found', 'timeout', 'unparseable', 'placeholder')) AS total_processed, count(*) AS total_events FROM o GROUP BY 1)
    SELECT instance_id, CAST(success_count AS BIGINT) AS success_count, CAST(failed_count AS BIGINT) AS failed_count, CAST(skipped_count AS BIGINT) AS skipped_count, CAST(final_skipped AS BIGINT) AS final_skipped, CAST(retry_count AS BIGINT) AS retry_count,
      CAST(total_processed AS BIGINT) AS total_processed, total_events, CASE WHEN total_processed = 0 THEN 0.0 ELSE success_count * CAST(100 AS DOUBLE) / total_processed END AS success_rate,
      printf('%.2f%%', CASE WHEN total_processed = 0 THEN CAST(0 AS DOUBLE) ELSE success_count * CAST(100 AS DOUBLE) / total_processed END) AS rate_text FROM c"""
)
def outcome_counters(spark: SparkSession, d: str) -> DataFrame:
    return checkpoint.outcome_counters(outcomes(spark, d), "instance_id", "outcome")


@R.query(
    f"""SELECT instance_id, position, CAST(succeeded AS BIGINT) AS succeeded, succeeded * CAST(100 AS DOUBLE) / position AS rate FROM (
      SELECT instance_id, row_number() OVER w AS position, sum(CASE WHEN {SQL_OUTCOME} = 'ok' THEN 1 ELSE 0 END) OVER w AS succeeded
      FROM (SELECT DISTINCT event, norm_id, norm_type, logged_at, received_at, instance_id FROM scrape_log WHERE norm_id IS NOT NULL)
      WINDOW w AS (PARTITION BY instance_id ORDER BY norm_id, received_at, event, coalesce(logged_at, ''), coalesce(norm_type, '') ROWS UNBOUNDED PRECEDING)) WHERE position % 100 = 0"""
)
def running_progress(spark: SparkSession, d: str) -> DataFrame:
    o = outcomes(spark, d).where("norm_id is not null").na.fill("", ["logged_at", "norm_type"])
    return checkpoint.running_progress(o, "instance_id", ["norm_id", "received_at", "event", "logged_at", "norm_type"], F.col("outcome") == "ok")


@R.query("SELECT norm_type, count(*) AS n FROM scrape_log WHERE event = 'norm_parsed' GROUP BY norm_type")
def log_group_count(spark: SparkSession, d: str) -> DataFrame:
    return log(spark, d).where("event = 'norm_parsed'").groupBy("norm_type").agg(F.count("*").alias("n"))


@R.query("SELECT kind, count(*) AS n, avg(elapsed) AS avg_s, min(elapsed) AS min_s, max(elapsed) AS max_s FROM timing_samples WHERE elapsed IS NOT NULL GROUP BY kind")
def timing_stats(spark: SparkSession, d: str) -> DataFrame:
    return report.timing_stats(table(spark, d, "timing_samples"), "kind", "elapsed")


@R.query(
    """SELECT (v * 411000 + i * 1589000) / 8 / 86400 AS days, i * 1589000 / (v * 411000 + i * 1589000) AS invalid_share
    FROM (SELECT avg(elapsed) FILTER (kind = 'valid') AS v, avg(elapsed) FILTER (kind = 'invalid') AS i FROM timing_samples)"""
)
def timing_extrapolation(spark: SparkSession, d: str) -> DataFrame:
    return report.extrapolated_days(timing_stats(spark, d))


@R.query("SELECT event, count(*) AS n FROM scrape_log GROUP BY event")
def stream_resume_counts(spark: SparkSession, d: str) -> DataFrame:
    return resume.resumable_counts(spark, f"{d}/scrape_log.parquet", "event")


SQL_UPSERT = "SELECT norm_id, unnest(max({'received_at': received_at, 'event': event, 'instance_id': instance_id})) FROM scrape_log WHERE norm_id IS NOT NULL GROUP BY norm_id"


@R.query(SQL_UPSERT)
def index_upsert_last_wins(spark: SparkSession, d: str) -> DataFrame:
    e = log(spark, d).select("norm_id", "received_at", "event", "instance_id")
    return index.upsert(e.where("event <> 'document_stored'"), e.where("event = 'document_stored'"), "norm_id", "received_at")


@R.query(
    """SELECT 'bcn-' || norm_id AS doc_id, 'legal-norms' AS knowledge_id, norm_type AS tipo_norma, norm_number AS numero_norma, title AS titulo, strftime(publication_date, '%Y-%m-%d') AS fecha_publicacion,
    strftime(promulgation_date, '%Y-%m-%d') AS fecha_promulgacion, strftime(last_modified, '%Y-%m-%d') AS ultima_modificacion, issuing_body AS organismo, norm_version AS version_norma, subject_tags AS materias,
    official_url AS url_oficial, summary AS resumen, full_content AS contenido_completo FROM norms"""
)
def index_format(spark: SparkSession, d: str) -> DataFrame:
    return index.index_format(table(spark, d, "norms"))


SQL_ONE = "SELECT norm_id, min(title) AS title, min(summary) AS summary, min(full_content) AS full_content, any_value(subject_tags) AS subject_tags FROM norms GROUP BY norm_id"


@R.query(
    f"""WITH n AS ({SQL_ONE}), c AS (SELECT norm_id, chunk_index, min(text) AS text, max(chunk_total) AS chunk_total FROM chunks GROUP BY ALL)
    SELECT 'bcn-' || c.norm_id || '-chunk-' || chunk_index AS doc_id, chunk_index, chunk_total, text AS content, title AS titulo, subject_tags AS materias, CASE WHEN chunk_index = 0 THEN summary END AS resumen FROM c JOIN n ON c.norm_id = n.norm_id"""
)
def index_rows(spark: SparkSession, d: str) -> DataFrame:
    norms = table(spark, d, "norms").groupBy("norm_id").agg(*(F.min(c).alias(c) for c in ("norm_type", "norm_number", "title", "publication_date", "promulgation_date", "last_modified", "issuing_body", "norm_version", "official_url", "summary", "full_content")), F.first("subject_tags", ignorenulls=True).alias("subject_tags"))
    chunks = table(spark, d, "chunks").groupBy("norm_id", "chunk_index").agg(F.min("text").alias("text"), F.max("chunk_total").alias("chunk_total"))
    return index.index_rows(norms, chunks).select("doc_id", "chunk_index", "chunk_total", "content", "titulo", "materias", "resumen")


@R.query(f"WITH n AS ({SQL_ONE}) SELECT norm_id, 'bcn-' || norm_id AS doc_id, title AS titulo, summary IS NULL AS no_resumen FROM n")
def index_json_drops_nulls(spark: SparkSession, d: str) -> DataFrame:
    n = table(spark, d, "norms").groupBy("norm_id").agg(F.min("title").alias("title"), F.min("summary").alias("summary"))
    j = index.as_json(n.select("norm_id", ranges.doc_key("norm_id").alias("doc_id"), F.col("title").alias("titulo"), F.col("summary").alias("resumen")), "norm_id")
    f = F.from_json("document", "doc_id string, titulo string")
    return j.select("norm_id", f["doc_id"].alias("doc_id"), f["titulo"].alias("titulo"), (~F.col("document").contains('"resumen":')).alias("no_resumen"))


@R.query(
    sql_chunks(NORMS, "norm_id")
    + f"SELECT n.norm_id, 'bcn-' || n.norm_id AS doc_id, title AS titulo, full_content AS contenido_completo, CAST(len(chunks) AS INTEGER) AS chunks FROM ({SQL_ONE}) n JOIN chunked ON n.norm_id = chunked.k"
)
def wrapped_original_json(spark: SparkSession, d: str) -> DataFrame:
    norms = table(spark, d, "norms").groupBy("norm_id").agg(*(F.min(c).alias(c) for c in ("norm_type", "norm_number", "title", "publication_date", "promulgation_date", "last_modified", "issuing_body", "norm_version", "official_url", "summary", "full_content")), F.first("subject_tags", ignorenulls=True).alias("subject_tags"))
    w = index.wrapped_original(norms, chunk_counts(norm_texts(spark, d), ["norm_id"], "text"))
    j = index.as_json(w, "norm_id")
    back = F.from_json("document", "norm_id bigint, scraped_at struct<doc_id: string, titulo: string, contenido_completo: string>, chunks int")
    return j.select(back.alias("j")).select("j.norm_id", "j.scraped_at.doc_id", "j.scraped_at.titulo", "j.scraped_at.contenido_completo", "j.chunks")


@R.query("SELECT DISTINCT norm_id, chunk_index, length(text) AS chars, len(chunk_vector) AS dims FROM chunks WHERE text IS NOT NULL AND chunk_vector IS NOT NULL")
def positional_vector_join(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "chunks")
    texts = c.where("text is not null").select("norm_id", "chunk_index", "text").distinct()
    vectors = c.where("chunk_vector is not null").select("norm_id", "chunk_index", "chunk_vector").distinct()
    j = embed.with_vectors(texts, vectors, ["norm_id", "chunk_index"], "chunk_vector")
    return j.select("norm_id", "chunk_index", F.length("text").cast("long").alias("chars"), F.size("vector").cast("long").alias("dims"))


@R.query()
def embed_offline(spark: SparkSession, d: str) -> DataFrame:
    """Chunks of the norms with their offline vectors."""
    chunks = chunk_texts(norm_texts(spark, d), ["norm_id"], "text")
    return embed.embed(chunks, ["norm_id", "chunk_index"], "text")


@R.query(sql_chunks(NORMS, "norm_id") + "SELECT k AS norm_id, CAST(i - 1 AS INTEGER) AS chunk_index, 64 AS dims FROM (SELECT k, unnest(range(1, len(chunks) + 1)) AS i FROM chunked)")
def embed_dimensions(spark: SparkSession, d: str) -> DataFrame:
    """Every chunk has a vector of the provider's dimensions, under its own key."""
    return embed_offline(spark, d).select("norm_id", "chunk_index", F.size("vector").alias("dims"))
