from __future__ import annotations

import pytest

from docpipe.llm import canon

ENTRIES = [(1, "Ministerio de Aguas y Riego", "MIAR"), (2, "Subsecretaría de Aguas Termales", "SATER"), (3, "Dirección General de Faros", "DIGEFA"), (4, "Municipalidad de Colmigal", "MUCOL"), (5, "Comisión de Límites Comunales", None), (6, None, "X")]


@pytest.fixture(scope="module")
def refs(spark):
    return spark.createDataFrame([("f", i, n, s) for i, n, s in ENTRIES], "field string, ref_id int, name string, sigla string")


def matched(spark, refs, values):
    df = spark.createDataFrame([("f", v, "clash") for v in values], "field string, value string, score string")
    return {r.value: r.ref_id for r in canon.match_values(df, refs).collect()}


def test_typed_values(spark, refs):
    want = {
        "MINISTREIO DE AGUAS Y RIEGO": 1, "Min. de Agas y Riego": 1, "Mº de Aguas y Riego": 1, "Aguas y Riego (Ministerio)": 1, "m.i.a.r.": 1, "MIAR (of. partes)": 1, "aguas termales, subsecretaria de": 2,
        "SubsecretarÃ­a de Aguas Termales": 2, "D.G. de Faros": 3, "DIR. GRAL. DE FAROS / DEPTO. JURÍDICO": 3, "direcciongeneraldefaros": 3, "Munic. de Colmigla": 4, "Comis. Límites Comunale": 5,
        "Ministerio de Asuntos Espaciales": 0, "Municipalidad de Rauvilsina": 0, "-----": 0, "": 0, "   ": 0, "123": 0,
    }
    assert matched(spark, refs, [*want, *want, None]) == want


def test_no_values_and_no_entries(spark, refs):
    assert matched(spark, refs, []) == {}
    assert matched(spark, refs.limit(0), ["Ministerio"]) == {"Ministerio": 0}


def test_a_very_long_value(spark, refs):
    long = "palabra " * 300 + "Faros"
    assert set(matched(spark, refs, [long])) == {long}


@pytest.mark.parametrize(("a", "b", "d"), [("abc", "abc", 0), ("abc", "acb", 1), ("", "ab", 2), ("ca", "abc", 2), ("colecvta", "colectiva", 2), ("kitten", "sitting", 3)])
def test_edits(a, b, d):
    assert canon.edits(a, b) == canon.edits(b, a) == d


def test_shared_variants_find_every_word_within_two_edits():
    words = ["telegrafos", "glaciares", "embalses"]
    for w in words:
        for typed in (w[:2] + w[3] + w[2] + w[4:], w[1:], w + "x", "q" + w[2:], w[:3] + "zz" + w[3:]):
            if canon.edits(typed, w) <= 2:
                assert canon.token_keys(typed, "word", False) & canon.word_keys(w, "word", [])
