"""Index-format records, index rows, stored originals and keyed upserts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docpipe.sources.ranges import doc_key

KNOWLEDGE_ID = "legal-norms"


def iso(c: str) -> Column:
    return F.date_format(c, "yyyy-MM-dd")


def _fields(knowledge_id: str) -> list[Column]:
    return [
        doc_key("norm_id").alias("doc_id"), F.lit(knowledge_id).alias("knowledge_id"), F.col("norm_type").alias("tipo_norma"), F.col("norm_number").alias("numero_norma"), F.col("title").alias("titulo"),
        iso("publication_date").alias("fecha_publicacion"), iso("promulgation_date").alias("fecha_promulgacion"), iso("last_modified").alias("ultima_modificacion"), F.col("issuing_body").alias("organismo"),
        F.col("norm_version").alias("version_norma"), F.col("subject_tags").alias("materias"), F.col("official_url").alias("url_oficial"), F.col("summary").alias("resumen"), F.col("full_content").alias("contenido_completo"),
    ]


def index_format(norms: DataFrame, knowledge_id: str = KNOWLEDGE_ID) -> DataFrame:
    """Records under the names of the index; dates as ISO text, nulls stay null."""
    return norms.select(*_fields(knowledge_id))


def index_rows(norms: DataFrame, chunks: DataFrame, knowledge_id: str = KNOWLEDGE_ID) -> DataFrame:
    """One row per chunk with the fields of its norm; the summary and its vector only with the first chunk.

    norms: one row per norm_id; chunks: norm_id, chunk_index, chunk_total, text, and a vector where there is one.
    """
    own = F.col("resumen_vector") if "resumen_vector" in norms.columns else F.lit(None).cast("array<float>").alias("resumen_vector")
    n = norms.select("norm_id", *_fields(knowledge_id), own).drop("contenido_completo")
    vector = F.col("vector") if "vector" in chunks.columns else F.lit(None).cast("array<float>")
    c = chunks.select("norm_id", "chunk_index", "chunk_total", F.col("text").alias("content"), vector.alias("contentVector"))
    rows = c.join(n, "norm_id")
    first = F.col("chunk_index") == 0
    return rows.withColumns({"doc_id": F.format_string("bcn-%d-chunk-%d", "norm_id", "chunk_index"), "resumen": F.when(first, F.col("resumen")), "resumen_vector": F.when(first, F.col("resumen_vector"))}).drop("norm_id")


def as_json(df: DataFrame, key: str) -> DataFrame:
    """key, document: rows as JSON without their nulls."""
    return df.select(key, F.to_json(F.struct("*")).alias("document"))


def wrapped_original(norms: DataFrame, chunk_counts: DataFrame) -> DataFrame:
    """norm_id, scraped_at (the index-format record), chunks."""
    wrapped = norms.select("norm_id", F.struct(*_fields(KNOWLEDGE_ID)).alias("scraped_at"))
    return wrapped.join(chunk_counts.select("norm_id", "chunks"), "norm_id")


def _orderable(df: DataFrame, c: str) -> Column:
    """A column by which rows can be ordered: of a map its sorted entries; of what holds maps inside, its JSON."""
    kind = df.schema[c].dataType
    if isinstance(kind, T.MapType) and "map<" not in kind.valueType.simpleString():
        return F.array_sort(F.map_entries(c))
    return F.to_json(F.struct(c)) if "map<" in kind.simpleString() else F.col(c)


def upsert(old: DataFrame, new: DataFrame, key: str, seq: str) -> DataFrame:
    """The row with the largest seq for every key of old and new; of equal seqs the larger row, column by column.

    Columns may be of any type, maps too; columns of one side only are null on the other. Rows without a key are left
    out. Aggregates before the shuffle, so a key that a third of all rows bear is no hot spot.
    """
    both = old.unionByName(new, allowMissingColumns=True).where(F.col(key).isNotNull())
    rest = [c for c in both.columns if c not in (key, seq)]
    if any("map<" in both.schema[c].dataType.simpleString() for c in rest):
        last = both.groupBy(key).agg(F.max_by(F.struct(F.col(seq), *map(F.col, rest)), F.struct(F.col(seq), *(_orderable(both, c).alias(c) for c in rest))).alias("r"))
    else:
        last = both.groupBy(key).agg(F.max(F.struct(F.col(seq), *map(F.col, rest))).alias("r"))
    return last.select(key, *(F.col(f"r.{c}").alias(c) for c in both.columns if c != key))


def write_originals(norms: DataFrame, path: str, knowledge_id: str = KNOWLEDGE_ID) -> None:
    """Flat originals as JSON, laid out by knowledge id; a second run replaces them."""
    norms.withColumns({"knowledge_id": F.lit(knowledge_id), "doc_id": doc_key("norm_id")}).write.mode("overwrite").partitionBy("knowledge_id").json(path)
