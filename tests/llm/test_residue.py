from __future__ import annotations

import pytest

from docpipe.llm import queries, residue

BAD = {
    "template": ["Considerando que {{ norma.vigencia }} rige", "el día [..] de [.....] de [....]", "a ____ de ________ de 20__", "por la suma de $ ............. (..............)", "XX de XXXXXX de 20XX", "la cuota [AUTORIDAD] de captura", "de «comuna» texto"],
    "filler": ["Lorem nunc congue viverra tempor felis", "qwerty asdf jkl zzz", "Aquí va el texto del artículo"],
    "failed_page": ["HTTP Status 404 - Gateway", "Su sesión ha caducado por inactividad", "Acceso denegado", "500 Not Found"],
    "script_notice": ["Para ver este contenido debe habilitar  JavaScript en su navegador", "Compruebe que no es un robot"],
}
GOOD = [
    "Artículo 404. La sesión que expire sin acuerdo se tendrá por no celebrada.", "aunque la persona no disponga de JavaScript ni de cookies", "El acceso denegado sin fundamento podrá reclamarse", "La actualización del navegador de a bordo será exigida",
    "[Norma 4041 Art. 25 D.O. 06.03.2014]", "individualizado en el plano [véase hoja 14]", "se consignará en Ralredol <<bajo recibo>>", "Se entenderá por «Panfeñilén» el predio", "Los casilleros marcados con # o @ en la planilla", "Toda suma superior a $ 120.000 (pesos)", "----------------",
]


@pytest.mark.parametrize(("kind", "text"), [(k, t) for k, ts in BAD.items() for t in ts])
def test_phrases(kind, text):
    assert residue.phrase_kind(text) == kind
    assert residue.phrase_kind("El titular deberá presentar. " * 40 + "\n" + text + "\n. Otra cosa" * 30) == kind


@pytest.mark.parametrize("text", GOOD)
def test_harmless(text):
    assert residue.phrase_kind(text) is None


def test_any_blanks_in_a_phrase():
    assert residue.phrase_kind("Título  de \n la norma aquí") == "filler"
    assert residue.phrase_kind("Error: tiempo  de espera agotado\tal consultar") == "failed_page"


def texts_of(spark, rows):
    return spark.createDataFrame(rows, "norm_id long, full_content string, title string, extra string")


def test_classifier_on_whole_tables(spark, small):
    sample = queries._residue_sample(spark, small.replace("sf0.001", "sf0.01"))
    assert {r.held_out for r in sample.select("held_out").distinct().collect()} == {"key_block"}
    model = residue.train(sample)
    lorem = "Lorem nunc congue viverra tempor felis nunc congue. " * 4
    df = texts_of(
        spark,
        [(1, lorem, "Acceso denegado", "x"), (1, lorem, "Acceso denegado", "x"), (2, None, None, "x"), (3, "", "", "x"), (None, "qwerty asdf", "x", "x"),
         (4, "El titular del permiso deberá presentar el plano de deslindes. " * 5, "DECRETO 5 APRUEBA PLANO DE DESLINDES DEL PREDIO Y ASIGNA RECURSOS AL COMITÉ", "x"), (5, "El titular deberá presentar el plano. " * 20000, "DECRETO 6 MODIFICA PLANO DE DESLINDES DEL PREDIO Y ASIGNA RECURSOS AL COMITÉ", "x")],
    )
    found = residue.detect(df, "norm_id", ["full_content", "title"], "title", model).collect()
    assert ("full_content", 1) in {(r.field, r.norm_id) for r in found}
    assert not {r.norm_id for r in found} & {2, 3, 4, 5}
    assert len(found) == len({(r.field, r.norm_id) for r in found})
    assert residue.detect(df.limit(0), "norm_id", ["full_content", "title"], "title", model).count() == 0
    v = residue.validate(sample, 0.0, 0.0)
    positives, hit, taken = (sum(r[i] for r in v) for i in (2, 3, 4))
    assert hit >= 0.5 * positives and hit >= 0.9 * taken  # a few dozen examples only


def test_score_decides_without_phrases(spark, small):
    """The rows of detect are those whose own score reaches the bound, whether a phrase is known or not."""
    import numpy as np

    model = residue.train(queries._residue_sample(spark, small))
    norms = spark.read.parquet(f"{small}/norms.parquet").select("norm_id", "full_content", "title")
    rows = norms.where("full_content is not null and full_content <> ''").dropDuplicates(["norm_id"]).collect()
    z = residue.scores(residue.windows_of([r.full_content for r in rows], np.zeros(len(rows))), model.weights, model.dense)
    found = {r.norm_id for r in residue.detect(norms, "norm_id", ["full_content"], "title", model).collect()}
    assert found == {r.norm_id for r, x in zip(rows, z, strict=True) if x >= residue.BOUND}


def test_hosts_are_held_out_whole(spark):
    rows = [(i, "El titular deberá presentar el plano.", "DECRETO", f"https://{'abc'[i % 3]}.example/x?i={i}") for i in range(300)]
    sample = residue.training_texts(texts_of(spark, rows).withColumnRenamed("extra", "url"), "norm_id", ["full_content", "title"], "title", "url", None)
    hosts = sample.select("held_out", "fold", "doc").distinct().collect()
    assert {r.held_out for r in hosts} == {"host"}
    assert len({r.fold for r in hosts}) == 3
    assert {sum(r.fold == f for r in hosts) for f in {r.fold for r in hosts}} == {100}


def test_nothing_to_learn(spark):
    empty = texts_of(spark, []).withColumnRenamed("extra", "url")
    model = residue.train(residue.training_texts(empty, "norm_id", ["full_content", "title"], "title", "url", None))
    assert residue.detect(texts_of(spark, [(1, "hola", "t", "x")]), "norm_id", ["full_content", "title"], "title", model).count() == 0


def test_windows_of_nothing():
    import numpy as np

    w = residue.windows_of([], np.empty(0))
    assert len(residue.scores(w, np.zeros(1 << residue.BITS, np.float32), np.zeros(5))) == 0
