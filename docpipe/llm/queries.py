"""Queries of the eight problems; each reads its whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docpipe.llm import canon, encoding, knn, lookalike, mixing, neardup, residue, splitting, sql
from docpipe.session import cut_lineage
from docpipe.sources.tables import table


def _vectors(spark: SparkSession, d: str, field: str) -> DataFrame:
    """norm_id, chunk_index, vec of one field; chunk_index is -1 for norms."""
    if field == "chunk_vector":
        return table(spark, d, "chunks").select("norm_id", "chunk_index", F.col("chunk_vector").alias("vec")).where("norm_id is not null and chunk_index is not null")
    return table(spark, d, "norms").select("norm_id", F.lit(-1).alias("chunk_index"), F.col("resumen_vector").alias("vec")).where("norm_id is not null")


VECTOR_KEYS = ["norm_id", "chunk_index"]


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    parts = [knn.similar_pairs(knn.nearest_vectors(_vectors(spark, d, f), VECTOR_KEYS, "vec"), VECTOR_KEYS).select(F.lit(f).alias("field_name"), "norm_id_a", "chunk_index_a", "norm_id_b", "chunk_index_b") for f in ("chunk_vector", "resumen_vector")]
    return parts[0].unionByName(parts[1])


def p1_neighbors(spark: SparkSession, d: str) -> DataFrame:
    parts = [knn.nearest_vectors(_vectors(spark, d, f), VECTOR_KEYS, "vec").withColumn("field_name", F.lit(f)) for f in ("chunk_vector", "resumen_vector")]
    return parts[0].unionByName(parts[1])


def p1_copies(spark: SparkSession, d: str) -> DataFrame:
    parts = [knn.vector_copies(_vectors(spark, d, f), VECTOR_KEYS, "vec").withColumn("field_name", F.lit(f)) for f in ("chunk_vector", "resumen_vector")]
    return parts[0].unionByName(parts[1])


def _typed_values(spark: SparkSession, d: str) -> DataFrame:
    """field, norm_id, value as stored, each once."""
    n = table(spark, d, "norms").where("norm_id is not null")
    bodies = n.select(F.lit("issuing_body").alias("field"), "norm_id", F.col("issuing_body").alias("value"))
    tags = n.select(F.lit("subject_tags").alias("field"), "norm_id", F.explode("subject_tags").alias("value"))
    return bodies.unionByName(tags).where("value is not null").distinct()


def _reference_list(spark: SparkSession, d: str) -> DataFrame:
    bodies = table(spark, d, "ref_bodies").select(F.lit("issuing_body").alias("field"), F.col("body_id").alias("ref_id"), F.col("body_name").alias("name"), "sigla")
    tags = table(spark, d, "ref_tags").select(F.lit("subject_tags").alias("field"), F.col("tag_id").alias("ref_id"), F.col("tag_name").alias("name"), F.lit(None).cast("string").alias("sigla"))
    return bodies.unionByName(tags)


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    refs = _reference_list(spark, d)
    odd = _typed_values(spark, d).join(refs.select("field", F.col("name").alias("value")).distinct(), ["field", "value"], "left_anti")
    matched = canon.match_values(odd, refs)
    return odd.join(matched, ["field", "value"]).select(F.col("field").alias("field_name"), "norm_id", F.col("value").alias("raw_value"), "ref_id")


def p2_unmatched(spark: SparkSession, d: str) -> DataFrame:
    """Report of the values that no entry of the lists stands for, with the norms that carry them."""
    return p2_found(spark, d).where("ref_id = 0").groupBy("field_name", "raw_value").agg(F.count("*").alias("norms"))


NORM_SHINGLES = {
    "full_content": neardup.Shingles("words", 3, 80, 0.6, rows=4),
    "title": neardup.Shingles("chars", 3, 60, 0.8, rows=8),
}


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    members, found = neardup.near_duplicates(table(spark, d, "norms"), "norm_id", NORM_SHINGLES)
    pairs = neardup.all_pairs(members, found)
    return pairs.select(F.col("field").alias("field_name"), F.col("a").alias("norm_id_a"), F.col("b").alias("norm_id_b"))


def p3_groups(spark: SparkSession, d: str) -> DataFrame:
    members, found = neardup.near_duplicates(table(spark, d, "norms"), "norm_id", NORM_SHINGLES)
    return neardup.groups(members, found).withColumnsRenamed({"field": "field_name", "id": "norm_id"})


def p3_classes(spark: SparkSession, d: str) -> DataFrame:
    """Every norm that takes part, with the smallest id of its class of copies and the size of the class."""
    members = neardup.class_members(neardup.classes(table(spark, d, "norms"), "norm_id", NORM_SHINGLES))
    return members.withColumnsRenamed({"field": "field_name", "id": "norm_id"})


def _long_fields(spark: SparkSession, d: str) -> DataFrame:
    n = table(spark, d, "norms").select(F.lit("full_content").alias("field_name"), "norm_id", F.lit(-1).alias("chunk_index"), F.col("full_content").alias("text"))
    c = table(spark, d, "chunks").select(F.lit("chunk_text").alias("field_name"), "norm_id", "chunk_index", "text")
    return n.unionByName(c)


PIECE_KEYS = ["field_name", "norm_id", "chunk_index"]


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    cut = splitting.split_texts(_long_fields(spark, d), PIECE_KEYS, "text")
    return cut.where("text_kind <> 'whole' and piece = 0").select(*PIECE_KEYS, F.col("text_kind").alias("cut_kind"))


def p4_pieces(spark: SparkSession, d: str) -> DataFrame:
    return splitting.split_texts(_long_fields(spark, d), PIECE_KEYS, "text")


RESIDUE_FIELDS = ["full_content", "title"]


def _residue_sample(spark: SparkSession, d: str) -> DataFrame:
    log = table(spark, d, "scrape_log").where("norm_id is not null").groupBy("norm_id").agg(F.max(F.col("event").isin("norm_parsed", "document_stored").cast("int")).alias("ok"))
    failed = log.where("ok = 0")
    return residue.training_texts(table(spark, d, "norms"), "norm_id", RESIDUE_FIELDS, "title", "official_url", failed)


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return p5_kinds(spark, d).select(F.col("field").alias("field_name"), "norm_id")


def p5_kinds(spark: SparkSession, d: str) -> DataFrame:
    model = residue.train(_residue_sample(spark, d))
    return residue.detect(table(spark, d, "norms"), "norm_id", RESIDUE_FIELDS, "title", model)


def p5_kept(spark: SparkSession, d: str) -> DataFrame:
    """The norms that stay: those of which neither text nor title is residue."""
    return table(spark, d, "norms").where("norm_id is not null").select("norm_id").distinct().join(p5_kinds(spark, d), "norm_id", "left_anti")


def p5_validation(spark: SparkSession, d: str) -> DataFrame:
    """Precision and recall by windows of hosts (or, where there is one host, blocks of keys) kept out of the fit."""
    rows = residue.validate(_residue_sample(spark, d))
    df = spark.createDataFrame(rows, "held_out string, fold int, positives int, found int, taken int, negatives int")
    return df.withColumn("recall", F.try_divide("found", "positives")).withColumn("precision", F.try_divide("found", "taken"))


def p6_ids(spark: SparkSession, d: str) -> DataFrame:
    return encoding.encode_documents(table(spark, d, "documents"), "doc_id", "text")


def p6_ids_by_tree(spark: SparkSession, d: str) -> DataFrame:
    """The same ids by small leaves, so that almost every text is cut and every word above 12 characters goes through the tree."""
    return encoding.encode_documents(table(spark, d, "documents"), "doc_id", "text", leaf=256, run=12)


def _sized_documents(spark: SparkSession, d: str) -> DataFrame:
    """doc_id, source, tokens."""
    docs = table(spark, d, "documents")
    ids = encoding.encode_documents(docs, "doc_id", "text").select("doc_id", F.size("ids").alias("tokens"))
    return docs.groupBy("doc_id").agg(F.min("source").alias("source")).join(ids, "doc_id")


def p7_mixture(spark: SparkSession, d: str) -> DataFrame:
    return mixing.mix_sources(_sized_documents(spark, d), "doc_id", "source", "tokens", table(spark, d, "mix_targets"))


def p7_shares(spark: SparkSession, d: str) -> DataFrame:
    docs, targets = cut_lineage(_sized_documents(spark, d)), table(spark, d, "mix_targets")
    return mixing.shares(mixing.mix_sources(docs, "doc_id", "source", "tokens", targets), docs, "source", "tokens", targets, "doc_id")


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    return lookalike.alike_pairs(lookalike.look_prints(table(spark, d, "documents"), "doc_id", "text"), "doc_id")


def p8_canonical(spark: SparkSession, d: str) -> DataFrame:
    return lookalike.canonical_texts(table(spark, d, "documents"), ["doc_id"], "text")


def p8_classes(spark: SparkSession, d: str) -> DataFrame:
    return lookalike.alike_classes(lookalike.look_prints(table(spark, d, "documents"), "doc_id", "text"), "doc_id")


def queries() -> dict:
    return {"p1_found": p1_found, "p1_neighbors": p1_neighbors, "p1_copies": p1_copies, "p2_found": p2_found, "p2_unmatched": p2_unmatched, "p3_found": p3_found, "p3_groups": p3_groups, "p3_classes": p3_classes, "p4_found": p4_found, "p4_pieces": p4_pieces, "p5_found": p5_found, "p5_kinds": p5_kinds, "p5_kept": p5_kept, "p5_validation": p5_validation, "p6_ids": p6_ids, "p6_ids_by_tree": p6_ids_by_tree, "p7_mixture": p7_mixture, "p7_shares": p7_shares, "p8_found": p8_found, "p8_canonical": p8_canonical, "p8_classes": p8_classes}


def oracle_sql() -> dict[str, str]:
    return dict(sql.ORACLE)
