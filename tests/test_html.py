from __future__ import annotations

from docpipe.operators import extract, validate
from docpipe.sources.html import fetched, parse_page, with_page

LONG = "palabra " * 30


def contents(spark, *pages):
    df = spark.createDataFrame(list(enumerate(pages)), "i int, html string")
    return [r.c for r in with_page(df, "html").select("i", extract.full_content().alias("c")).orderBy("i").collect()]


def test_containers_and_notes(spark):
    h1 = f'<div class="texto_norma"><p>Artículo 1 Uno<span class="n">Ley 1<br>D.O. 2</span></p><p>{LONG}</p></div>'
    h2 = f'<div class="cuerpo-norma"><div class="texto_norma">corto</div><p>{LONG}</p><span class="n"> x </span></div>'
    h3 = "<p>a <b>b</b> c</p>" * 40
    got = contents(spark, h1, h2, h3, "<p>corto</p>", None)
    assert got[0] == "Artículo 1 Uno [Ley 1 D.O. 2] " + LONG.strip()
    assert got[1] == "corto " + LONG.strip() + " [x]"
    assert got[2] == " ".join(["abc"] * 40)
    assert got[3] is None
    assert got[4] is None


def test_titles(spark):
    pages = ['<meta property="og:title" content="no"><title>doce letras!</title>', '<meta name="og:title" content="Ley Chile - Sí"><title>doce letras!</title>', "<title>corto</title><h1>El H1</h1>", "<p>nada</p>"]
    df = spark.createDataFrame(list(enumerate(pages)), "i int, html string")
    assert [r.t for r in with_page(df, "html").select("i", extract.title_text().alias("t")).orderBy("i").collect()] == ["doce letras!", "Sí", "El H1", None]


def test_unclosed_elements_and_scripts():
    p = parse_page("<p><b>uno<br><p>dos<script>var a = '<p>';</script></p><div>tres")
    assert p["paragraph_text"] == "uno\n\ndos"


def test_deep_nesting():
    assert parse_page("<div>" * 20000 + "<p>x</p>")["paragraph_text"] == "x"


def test_placeholder_and_filters(spark):
    rows = [("x" * 499, "de la Biblioteca del Congreso Nacional"), ("x" * 500, "de la Biblioteca del Congreso Nacional"), ("x", "otra")]
    df = spark.createDataFrame(rows, "full_content string, title string")
    assert [r.p for r in df.select(validate.is_placeholder().alias("p")).collect()] == [True, False, False]
    pages = spark.createDataFrame([("x" * 999, 200), ("x" * 1000, 200), ("x" * 1000, 404), (None, 200)], "html string, status int")
    assert fetched(pages, "html", "status").count() == 1


def test_a_rejected_page(spark):
    head = '<title>Una ley cualquiera</title><meta name="article:author" content="   ">'
    page = f"{head}<p>{LONG * 6}</p>"
    parsed = extract.parse_pages(spark.createDataFrame([(5, page)], "norm_id bigint, html string"))
    assert parsed.count() == 1
    assert parsed.select(validate.reject_reasons().alias("r")).first().r == ["issuing_body"]
    assert validate.validated(parsed).count() == 0
