"""Golden values of the field and chunk rules."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from docpipe.functions import chunking
from docpipe.functions.dates import parse_date
from docpipe.functions.text import clean_text, est_tokens
from docpipe.operators import extract, report
from docpipe.operators.chunk import chunk_texts


def each(spark, values, column):
    """column(F.col('x')) of every value, in order."""
    df = spark.createDataFrame(list(enumerate(values)), "i int, x string")
    return [r.y for r in df.select("i", column(F.col("x")).alias("y")).orderBy("i").collect()]


def test_numbers(spark):
    titles = ["LEY NUM. 19.846 SUBSIDIO HABITACIONAL", "LEY NUM. 19.846 - X", "LEY NUM. 19846, 2003 Y", "Decreto 37", "DFL 830", "D.F.L. Núm 5", "CODIGO CIVIL", "Ley 21.000"]
    assert each(spark, titles, lambda c: extract.norm_number(c, F.lit(7))) == ["19846", "19846-", "198462003", "37", "830", "5", "7", "7"]


def test_types(spark):
    want = {"CODIGO CIVIL": "codigo", "CÓDIGO CIVIL": "ley", "D.F.L. 5": "dfl", "DFL5": "ley", "DECRETO 37": "decreto", "DECRETO LEY 3500": "ley", "DECRETO 37 LEYENDA": "ley", "REGLAMENTO X": "reglamento", "DECRETO CON FUERZA DE LEY 1": "ley", "otra cosa": "ley"}
    assert each(spark, list(want), extract.norm_type) == list(want.values())


def test_dates(spark):
    values = ["2024-05-15", "2024-05-15T10:00", "15-MAY-2024 foo", "03-AGO-2026", "15 de Mayo de 2024", "31-FEB-2024", "15-XYZ-2024", "", None]
    d = dt.date(2024, 5, 15)
    assert each(spark, values, parse_date) == [d, None, d, dt.date(2026, 8, 3), d, None, None, None, None]


def test_versions_and_modification(spark):
    assert each(spark, ["Versión:Con modificaciones -03-AGO-2026", "Versión:Única -03-AGO-2026"], extract.version) == ["Con modificaciones", None]
    assert each(spark, ["Última Modificación:15-JUN-2024"], lambda c: extract.last_modified(c, F.lit(None).cast("string"))) == [dt.date(2024, 6, 15)]


def test_promulgation_stops_at_a_day_that_does_not_exist(spark):
    starts = ["Santiago, 31 de febrero de 2020. 01-ENE-2021", "Santiago, 1 de nunca de 2020. 01-ENE-2021", "nada"]
    assert each(spark, starts, lambda c: extract.promulgation_date(F.lit(""), c)) == [None, dt.date(2021, 1, 1), None]


def test_tags(spark):
    values = ["CIRCULACION VEHICULARGOBERNACION PROVINCIALARICA", "CONTENIDO", "TRABAJADORAPENSION", "Vivienda, subsidios;IVA;  ley de rentas", "", None]
    want = [["circulacion", "vehiculargobernacion", "provincia", "larica"], ["conte", "nido"], ["trabajador", "apension"], ["vivienda", "subsidios", "ley de rentas"], [], []]
    assert each(spark, values, extract.subject_tags) == want


def test_clean_text(spark):
    assert each(spark, [" a \n b &amp; c &NBSP; d &#39; "], clean_text) == ["a b  c  d &#39;"]


def test_title_composition(spark):
    long = "x" * 300
    df = spark.createDataFrame([("LEY 19.846, X", "Una descripción de más de veinte"), ("DFL 8", "corta"), ("Decreto 5", long)], "r string, d string")
    got = [r[0] for r in df.select(extract.composed_title("r", "d")).collect()]
    assert got == ["Ley 19846: Una descripción de más de veinte", "DFL 8", "Decreto 5: " + "x" * 186 + "..."]


def test_tokens(spark):
    assert each(spark, ["x" * 7, "x" * 2000, ""], est_tokens) == [4, 1200, 0]


def test_article_marks_and_cuts(spark):
    assert each(spark, ["Artículo 1 Artículo II Art. 3"], chunking.article_marks) == [3]
    assert chunking.has_articles("Artículo 1 Artículo II Art. 3") and not chunking.has_articles("Artículo 1 Artículo II")
    assert chunking.by_articles("Artículo 1. a Artículo II b Art. 3 c") == ["Artículo 1. a Artículo II b", "Art. 3 c"]


def test_overlap():
    assert chunking.with_overlap(["ab", "cd"]) == ["ab", "ab [...] cd"]
    assert [chunking.tail(c) for c in ("x" * 50 + ". " + "y" * 60, "k" * 60 + ". " + "m" * 30 + ". " + "n" * 40)] == ["y" * 60, "m" * 30 + ". " + "n" * 40]


@pytest.mark.parametrize(
    ("text", "lengths"),
    [(". ".join(["x" * 1000] * 3), [1000, 1000, 1000]), (". ".join(["x" * 700] * 3), [1401, 700]), ("x" * 2000, [2000]), ("", [])],
)
def test_sentence_packing(text, lengths):
    assert [len(c) for c in chunking.by_sentences(text)] == lengths


@pytest.mark.parametrize(
    ("parts", "lengths"), [(["x" * 400] * 3, [802, 400]), (["p" * 100, "a" * 900 + ". " + "b" * 900, "q" * 100], [100, 900, 900, 100])]
)
def test_paragraph_packing(parts, lengths):
    assert [len(c) for c in chunking.by_paragraphs("\n\n".join(parts))] == lengths


def test_chunk_rows(spark):
    df = spark.createDataFrame([(1, "a" * 1000 + ". " + "b" * 1000, "clash"), (2, None, ""), (3, "  \n ", "")], "id int, text string, chunk_index string")
    rows = chunk_texts(df, ["id"], "text").orderBy("chunk_index").collect()
    assert [(r.id, r.chunk_index, len(r.text), r.char_start, r.char_end, r.token_count) for r in rows] == [(1, 0, 1000, 0, 1000, 600), (1, 1, 1087, -1, 1086, 652)]
    assert chunk_texts(df.limit(0), ["id"], "text").count() == 0


def test_chunks_carry_other_columns(spark):
    df = spark.createDataFrame([(1, "a" * 1000 + ". " + "b" * 1000, "LEY 1", {"tipo": "ley"})], "id int, body string, titulo string, meta map<string,string>")
    rows = chunk_texts(df, ["id"], "body", carry=["titulo", "meta"]).collect()
    assert [(r.id, r.titulo, r.meta, r.chunk_total) for r in rows] == [(1, "LEY 1", {"tipo": "ley"}, 2)] * 2
    with pytest.raises(ValueError, match="twice"):
        chunk_texts(df.withColumnRenamed("titulo", "text"), ["id"], "body", carry=["text"])


def test_very_long_text_is_cut_in_linear_time(spark):
    import time

    text = "\n\n".join(f"Párrafo {i} con algo de texto para llenar." for i in range(200_000))
    started = time.time()
    chunks = chunking.with_overlap(chunking.plain_chunks(text))
    assert chunking.places(text, chunks)[1] == -1
    assert time.time() - started < 20
    assert sum(len(c) for c in chunking.plain_chunks(text)) > len(text) * 0.99


@pytest.mark.parametrize(("values", "want"), [(range(1, 11), (6, 10, 10)), (range(1, 5), (3, 4, 4)), ([], (None, None, None))])
def test_nearest_rank(spark, values, want):
    df = spark.createDataFrame([(v,) for v in values], "v int")
    assert tuple(report.nearest_rank(df, "v", report.QUANTILES).first()) == want


def test_nearest_rank_of_many_values(spark):
    df = spark.range(30_001).selectExpr("(id * 7919) % 30001 / 4.0 as v")
    for per_range in (10**6, 5000, 500):
        assert tuple(report.nearest_rank(df, "v", report.QUANTILES, per_range).first()) == tuple(int(30_001 * q) / 4 for q in (0.5, 0.9, 0.95))
    hot = spark.range(1000).selectExpr("if(id < 900, 1.5, id) as v")
    assert tuple(report.nearest_rank(hot, "v", report.QUANTILES, 10).first()) == (1.5, 900.0, 950.0)


@pytest.mark.parametrize(("mean", "days"), [(3.0, 38), (4.0, 51), (5.0, 64), (6.0, 77)])
def test_projection(spark, mean, days):
    rows = report.scenario_lookup(spark.createDataFrame([(mean,)], "mean_chunks double")).collect()
    assert {r.projected_days for r in rows} == {days}
    assert [r.chunks for r in rows if r.applies] == [int(mean)]
