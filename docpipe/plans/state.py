"""Queries on sources, sinks, states and counters: each writes below the shared folder and says what came of it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docpipe.functions import maps
from docpipe.operators import checkpoint, counters, extract, index, store
from docpipe.operators.chunk import chunk_texts
from docpipe.plans.chunks import NORMS, SQL_OVERLAPPED, SQL_ROWS, norm_texts, sql_chunks
from docpipe.plans.pipeline import SQL_ONE, SQL_OUTCOME, log, outcomes
from docpipe.plans.registry import Registry, sql_strip, sql_tokens
from docpipe.sources import fetch, objects, ranges
from docpipe.sources.tables import table
from docpipe.streaming import scan
from docpipe.streaming.resume import shared_folder

R = Registry()


def one_norm_each(spark: SparkSession, d: str) -> DataFrame:
    plain = ("norm_type", "norm_number", "title", "publication_date", "promulgation_date", "last_modified", "issuing_body", "norm_version", "official_url", "summary", "full_content")
    return table(spark, d, "norms").groupBy("norm_id").agg(*(F.min(c).alias(c) for c in plain), F.first("subject_tags", ignorenulls=True).alias("subject_tags"))


SQL_WRITE = "SELECT count(*) FILTER (norm_id IS NOT NULL) AS success, count(*) FILTER (norm_id IS NULL) AS failed, count(DISTINCT {'n': norm_id, 'c': chunk_index}) AS docs FROM chunks"


@R.query(f"SELECT 1 AS write, * FROM ({SQL_WRITE}) UNION ALL SELECT 2, * FROM ({SQL_WRITE}) UNION ALL SELECT 3, 0, 0, docs FROM ({SQL_WRITE})")
def bulk_upsert_result(spark: SparkSession, d: str) -> DataFrame:
    """The chunks indexed twice, and then none at all: what every write reports, and the documents there are after it."""
    path = shared_folder(spark, "index")
    chunks = table(spark, d, "chunks").withColumn("doc_id", F.format_string("bcn-%d-chunk-%d", "norm_id", "chunk_index"))
    done = []
    for number, docs in enumerate((chunks, chunks, chunks.limit(0)), 1):
        r = store.bulk_index(spark, path, docs, "doc_id")
        done.append((number, r.success, r.failed, store.current(spark, path).count()))
    return spark.createDataFrame(done, "write int, success long, failed long, docs long")


@R.query("SELECT false AS before, true AS made, true AS again, true AS after, 1 AS docs")
def index_exists_check(spark: SparkSession, d: str) -> DataFrame:
    """A table is there once a document was upserted, and a second upsert of it replaces it."""
    path = shared_folder(spark, "index")
    doc = table(spark, d, "norms").where("norm_id is not null").orderBy("norm_id").limit(1).select("norm_id", "title")
    before = store.index_exists(spark, path)
    made, again = (store.index_document(spark, path, doc, "norm_id") for _ in range(2))
    return spark.createDataFrame([(before, made, again, store.index_exists(spark, path), store.current(spark, path).count())], "before boolean, made boolean, again boolean, after boolean, docs int")


@R.query(
    f"""WITH o AS (SELECT instance_id, norm_id, {SQL_OUTCOME} AS o FROM (SELECT DISTINCT * FROM scrape_log) WHERE instance_id IS NOT NULL)
    SELECT instance_id, max(norm_id) AS last_id_processed, CAST(count_if(o IN ('ok', 'not_found', 'timeout', 'unparseable', 'placeholder')) AS BIGINT) AS total_processed, CAST(count_if(o = 'ok') AS BIGINT) AS success_count,
      CAST(count_if(o IN ('not_found', 'timeout', 'unparseable')) AS BIGINT) AS failed_count, CASE WHEN instance_id = (SELECT min(instance_id) FROM o) THEN 'completed' ELSE 'running' END AS status, instance_id = (SELECT min(instance_id) FROM o) AS has_end FROM o GROUP BY instance_id"""
)
def checkpoint_saved(spark: SparkSession, d: str) -> DataFrame:
    """The counters of every instance saved twice as its state; then the first instance is completed, which a later failure doesn't change."""
    path = shared_folder(spark, "states")
    o = outcomes(spark, d).where("instance_id is not null")
    last = o.groupBy("instance_id").agg(F.max("norm_id").alias("last_id_processed"))
    states = checkpoint.outcome_counters(o, "instance_id", "outcome").select("instance_id", *checkpoint.COUNTS).join(last, "instance_id")
    checkpoint.save_all(spark, path, states.withColumn("last_id_processed", F.lit(0).cast("long")))
    checkpoint.save_all(spark, path, states)
    first = states.agg(F.min("instance_id")).first()[0]
    checkpoint.finish(spark, path, first, "completed")
    checkpoint.finish(spark, path, first, "failed", "too late")
    return store.current(spark, path).select("instance_id", "last_id_processed", "total_processed", "success_count", "failed_count", "status", F.col("completed_at").isNotNull().alias("has_end"))


@R.query("SELECT instance_id, last_id_processed, CASE WHEN instance_id = 'scr-00000' THEN 'completed' ELSE status END AS status, CASE WHEN instance_id = 'scr-00000' THEN '2025-02-01T00:00:00' ELSE completed_at END AS completed_at, error_message FROM checkpoints")
def checkpoint_mark_completed(spark: SparkSession, d: str) -> DataFrame:
    return checkpoint.mark(table(spark, d, "checkpoints"), "scr-00000", "completed", "2025-02-01T00:00:00").select("instance_id", "last_id_processed", "status", "completed_at", "error_message")


@R.query(
    """WITH seen AS (SELECT norm_id, max(CASE event WHEN 'document_stored' THEN 2 WHEN 'norm_not_found' THEN 1 ELSE 0 END) AS best FROM scrape_log WHERE norm_id IS NOT NULL GROUP BY norm_id)
    SELECT CASE WHEN best IS NULL THEN 'never' WHEN best = 2 THEN 'stored' WHEN best = 1 THEN 'not_found' ELSE 'other' END AS outcome, count(*) AS n
    FROM range(1, (SELECT max(norm_id) FROM scrape_log) + 1) t(id) LEFT JOIN seen ON id = norm_id GROUP BY 1"""
)
def range_scan_resumed(spark: SparkSession, d: str) -> DataFrame:
    """Outcomes of all ids up to the last in the log, by a scan that breaks off behind a third block and is resumed."""
    where = shared_folder(spark, "scan")
    end = log(spark, d).agg(F.max("norm_id")).first()[0]
    best = F.max(F.when(F.col("event") == "document_stored", 2).when(F.col("event") == "norm_not_found", 1).otherwise(0)).alias("best")

    def process(ids: DataFrame) -> DataFrame:
        seen = log(spark, d).where("norm_id is not null").groupBy("norm_id").agg(best)
        outcome = F.when(F.col("best").isNull(), "never").when(F.col("best") == 2, "stored").when(F.col("best") == 1, "not_found").otherwise("other")
        return ids.join(seen, "norm_id", "left").select("norm_id", outcome.alias("outcome"))

    every = max(1, end // 8)
    try:
        scan.scan_range(spark, "scan-1", 1, end, every, process, where, stop_after=2)
    except scan.Interrupted:
        scan.scan_range(spark, "scan-1", 1, end, every, process, where)
    return scan.results(spark, where).groupBy("outcome").agg(F.count("*").alias("n"))


def _site() -> fetch.Fetcher:
    """A site for tests without network: what it answers follows from the id, and some pages come at the third try only."""
    asked: dict[int, int] = {}

    def answer(i: int) -> tuple[int | None, str | None]:
        asked[i] = asked.get(i, 0) + 1
        if i % 17 == 0:
            return 404, None
        if i % 19 == 0:
            return 503, "busy"
        if i % 23 == 0 and asked[i] < 3:
            raise TimeoutError
        if i % 29 == 0:
            return None, None
        if i % 31 == 0:
            return 200, "<html></html>"
        if i % 37 == 0:
            raise ValueError("broken")
        return 200, "<html>" + "x" * (1000 + i % 100)

    return answer


SQL_SITE = "CASE WHEN norm_id % 17 = 0 THEN 'not_found' WHEN norm_id % 19 = 0 THEN 'bad_status' WHEN norm_id % 29 = 0 THEN 'no_response' WHEN norm_id % 31 = 0 THEN 'too_short' WHEN norm_id % 37 = 0 THEN 'error' ELSE 'ok' END"


@R.query(
    f"""SELECT norm_id, outcome, CASE outcome WHEN 'not_found' THEN 404 WHEN 'bad_status' THEN 503 WHEN 'ok' THEN 200 WHEN 'too_short' THEN 200 END AS status,
      CASE WHEN outcome <> 'ok' OR norm_id % 23 = 0 THEN 3 ELSE 1 END AS attempts, CASE WHEN outcome = 'ok' THEN CAST(1006 + norm_id % 100 AS INTEGER) END AS chars
    FROM (SELECT *, {SQL_SITE} AS outcome FROM (SELECT DISTINCT norm_id FROM scrape_log WHERE norm_id IS NOT NULL))"""
)
def fetch_outcomes(spark: SparkSession, d: str) -> DataFrame:
    """Pages of all ids of the log from a site that often fails, with up to three tries."""
    ids = log(spark, d).select("norm_id").distinct()
    got = fetch.fetch_pages(ids, "norm_id", _site(), wait=lambda _: None)
    return got.select("norm_id", "outcome", "status", "attempts", F.length("html").alias("chars"))


@R.query(f"SELECT 'legal-norms/originals/bcn-' || norm_id || '.json' AS key, norm_id, title, CAST(length(full_content) AS INTEGER) AS chars, true AS ok, 'scrape' AS source FROM ({SQL_ONE})")
def object_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """Every norm stored as an object of its own, listed by prefix and read again."""
    root = shared_folder(spark, "objects")
    norms = one_norm_each(spark, d).select("norm_id", "title", "full_content")
    named = index.as_json(norms, "norm_id").select(ranges.object_key(index.KNOWLEDGE_ID, ranges.doc_key("norm_id")).alias("key"), "document", F.create_map(F.lit("source"), F.lit("scrape")).alias("tags"))
    manifest, _ = counters.written(objects.put_objects(named, "key", "document", root, "tags"), f"{root}-manifest")
    listed = objects.list_objects(spark, root, f"{index.KNOWLEDGE_ID}/originals/bcn-")
    docs, _ = ranges.read_documents(spark, root, "norm_id bigint, title string, full_content string")
    back = docs.withColumn("key", ranges.object_key(index.KNOWLEDGE_ID, ranges.doc_key("norm_id"))).join(listed, "key").join(manifest.select("key", "ok", "metadata"), "key")
    return back.select("key", "norm_id", "title", F.length("full_content").alias("chars"), "ok", F.col("metadata")["source"].alias("source"))


@R.query("SELECT event, norm_type, count(*) AS n, count(norm_id) AS with_id, count(logged_at) AS with_time FROM scrape_log GROUP BY ALL")
def log_event_scan(spark: SparkSession, d: str) -> DataFrame:
    """The log written as JSON lines and read again as events."""
    path = shared_folder(spark, "log")
    log(spark, d).select(F.to_json(F.struct("event", "norm_id", "norm_type", F.col("logged_at").alias("timestamp"), "instance_id")).alias("value")).write.text(path)
    return ranges.log_events(spark, path).groupBy("event", "norm_type").agg(F.count("*").alias("n"), F.count("norm_id").alias("with_id"), F.count("timestamp").alias("with_time"))


@R.query("SELECT DISTINCT norm_id, 'https://bcn.cl/leychile/navegar?idNorma=' || norm_id AS official_url FROM norms WHERE norm_id IS NOT NULL")
def official_urls(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "norms").where("norm_id is not null").select("norm_id").distinct().select("norm_id", extract.official_url("norm_id").alias("official_url"))


@R.query(sql_chunks(NORMS, "norm_id") + f"SELECT c.*, 'bcn-' || norm_id AS doc_id, 'https://bcn.cl/leychile/navegar?idNorma=' || norm_id AS official_url FROM ({SQL_ROWS.format(key='norm_id')}) c")
def chunk_metadata(spark: SparkSession, d: str) -> DataFrame:
    """Chunks that carry other columns of their norm."""
    n = norm_texts(spark, d).select("norm_id", F.col("text").alias("body"), ranges.doc_key("norm_id").alias("doc_id"), extract.official_url("norm_id").alias("official_url"))
    return chunk_texts(n, ["norm_id"], "body", carry=["doc_id", "official_url"])


@R.query(
    """SELECT norm_id, chunk_index, coalesce(metadata['tipo_norma'], '-') AS kind, coalesce(list_contains(map_keys(metadata), 'titulo'), false) AS titled,
      CAST(len(list_distinct(list_concat(coalesce(map_keys(metadata), []), ['run']))) AS INTEGER) AS keys FROM (SELECT DISTINCT norm_id, chunk_index, metadata FROM (SELECT norm_id, chunk_index, min(metadata) AS metadata FROM chunks GROUP BY ALL))"""
)
def map_values(spark: SparkSession, d: str) -> DataFrame:
    entries = F.array_sort(F.map_entries("metadata"))
    c = table(spark, d, "chunks").groupBy("norm_id", "chunk_index").agg(F.min(entries).alias("e")).withColumn("metadata", F.map_from_entries("e"))
    return c.select("norm_id", "chunk_index", maps.value_or("metadata", "tipo_norma", F.lit("-")).alias("kind"), maps.has_key("metadata", "titulo").alias("titled"), F.size(maps.merged("metadata", F.create_map(F.lit("run"), F.lit("2")))).alias("keys"))


@R.query("SELECT doc_id, strlen(text) AS bytes, CASE WHEN text IS NOT NULL THEN true END AS same FROM documents")
def utf8_round_trip(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "documents")
    return t.select("doc_id", F.octet_length(maps.utf8("text")).cast("long").alias("bytes"), (maps.from_utf8(maps.utf8("text")) == F.col("text")).alias("same"))


@R.query("SELECT instance_id, (epoch_us(max(received_at)) - epoch_us(min(received_at))) / CAST(1000000 AS DOUBLE) AS seconds, (epoch_us(max(received_at)) - epoch_us(min(received_at))) / CAST(1000000 AS DOUBLE) / 86400 AS days FROM scrape_log GROUP BY instance_id")
def elapsed_times(spark: SparkSession, d: str) -> DataFrame:
    e = log(spark, d).groupBy("instance_id").agg(F.min("received_at").alias("a"), F.max("received_at").alias("b"))
    return e.select("instance_id", maps.elapsed_seconds("a", "b").alias("seconds")).withColumn("days", maps.days("seconds"))


SQL_RUN = (
    sql_chunks(NORMS, "norm_id")
    + f""", c AS (SELECT unnest(chunks) AS chunk FROM (SELECT {SQL_OVERLAPPED} AS chunks FROM chunked)),
    t AS (SELECT (SELECT count(DISTINCT norm_id) FROM norms) AS processed, (SELECT count(*) FROM c) AS chunks, (SELECT CAST(sum({sql_tokens("chunk")}) AS BIGINT) FROM c) AS tokens,
      (SELECT count(*) FROM ({NORMS}) WHERE text IS NULL OR {sql_strip("text")} = '') AS failed, (SELECT count(*) FROM chunked WHERE len(chunks) > 0) AS stored)"""
)


def _run(spark: SparkSession, d: str) -> DataFrame:
    return counters.merged(spark, counters.index_norms(one_norm_each(spark, d), shared_folder(spark, "run")))


@R.query(SQL_RUN + "SELECT u.counter, u.value FROM t, LATERAL (VALUES ('processed', processed), ('chunks', chunks), ('vectors', chunks), ('indexed', chunks), ('stored', stored), ('failed', failed)) u(counter, value)")
def pipeline_counters(spark: SparkSession, d: str) -> DataFrame:
    """All norms chunked, embedded, indexed and stored, with the counters of the run."""
    return _run(spark, d).where("component = 'pipeline'").select("counter", "value")


@R.query(
    SQL_RUN
    + """SELECT u.component, u.counter, u.value FROM t, LATERAL (VALUES ('chunker', 'texts', processed - failed), ('chunker', 'failed', failed), ('chunker', 'tokens', tokens), ('embedder', 'texts', chunks), ('embedder', 'vectors', chunks),
      ('index', 'success', chunks), ('index', 'failed', 0), ('store', 'uploaded', stored), ('store', 'failed', 0)) u(component, counter, value)"""
)
def component_counters(spark: SparkSession, d: str) -> DataFrame:
    return _run(spark, d).where("component <> 'pipeline'")


@R.query(f"SELECT count(*) FILTER (ok) AS success, count(*) FILTER (NOT ok) AS failed FROM (SELECT coalesce({sql_strip('full_content')} <> '', false) AS ok FROM norms)")
def batch_index_result(spark: SparkSession, d: str) -> DataFrame:
    return counters.batch_result(table(spark, d, "norms").select("full_content"), F.regexp_replace("full_content", r"^\s+|\s+$", "") != "")


@R.query(
    f"""SELECT position, CAST(succeeded AS BIGINT) AS succeeded, succeeded * CAST(100 AS DOUBLE) / position AS rate FROM (SELECT row_number() OVER w AS position, sum(ok) OVER w AS succeeded
      FROM (SELECT norm_id, CAST(coalesce({sql_strip("min(full_content)")} <> '', false) AS INTEGER) AS ok FROM norms WHERE norm_id IS NOT NULL GROUP BY norm_id) WINDOW w AS (ORDER BY norm_id ROWS UNBOUNDED PRECEDING)) WHERE position % 10 = 0"""
)
def batch_progress(spark: SparkSession, d: str) -> DataFrame:
    """The running rate of norms with text, at every tenth norm."""
    n = norm_texts(spark, d).select(F.lit("batch").alias("batch"), "norm_id", (F.coalesce(F.regexp_replace("text", r"^\s+|\s+$", ""), F.lit("")) != "").alias("ok"))
    return checkpoint.running_progress(n, "batch", ["norm_id"], F.col("ok"), every=10).select("position", "succeeded", "rate")
