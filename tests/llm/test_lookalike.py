from __future__ import annotations

import unicodedata

from hypothesis import given, settings
from hypothesis import strategies as st

from docpipe.llm import lookalike as lk


def one(t):
    return lk.canonical(["x", t, "y"])[1]


def test_same_look():
    for a, b in (("ｈｏｌａ", "hola"), ("árbol", "árbol"), ("ho​la", "hola"), ("a b", "a b"), ("a b", "a b"), ("ﬁn", "fin"), ("соsа", "cosa"), ("Ⅸ", "IX"), ("µ", "μ"), ("а́", "á"), ("x‑y", "x-y"), ("a\r\nb", "a\nb"), ("hola ", "hola"), ("­hola", "hola"), ("çã", "çã")):
        assert one(a) == one(b), (a, b)


def test_letters_of_many_scripts():
    for a in ("ρаypal", "pɑypаl", "раyраl", "ⲣaypal"):
        assert one(a) == "paypal", a
    for a, b in (("κιlο", "kilo"), ("օso", "oso"), ("ꓡꓰꓬ", "LEY"), ("ᎪᏟᎢᎪ", "ACTA"), ("Սno", "Uno")):
        assert one(a) == b, a
    assert len(lk.LOOK_ALIKES) < 200
    assert all(v.isascii() for v in lk.LOOK_ALIKES.values())


def test_different_look():
    for a, b in (("m³", "m3"), ("½", "1/2"), ("hola", "hóla"), ("Hola", "hola"), ("1", "l"), ("a b", "ab"), ("n", "ñ"), ("H₂O", "H2O"), ("a–b", "a-b")):
        assert one(a) != one(b), (a, b)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.characters(min_codepoint=0xC0, max_codepoint=0x345), max_size=12))
def test_composition_is_canonical(t):
    if any(c in lk.LOOK_ALIKES or unicodedata.decomposition(c).startswith("<") for c in unicodedata.normalize("NFD", t)):
        return
    assert one("a" + t) == unicodedata.normalize("NFC", "a" + t).strip()


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=30))
def test_the_form_is_stable(t):
    assert one(one(t)) == one(t)


def test_a_group_of_many_copies(spark, monkeypatch):
    monkeypatch.setattr(lk, "PART", 10)
    forms = ("hola", "hоla", "ho\u00adla")
    rows = [(i, forms[i % 3]) for i in range(120)] + [(1000, "otra"), (1001, "otra")]
    prints = lk.look_prints(spark.createDataFrame(rows, "doc_id long, text string"), "doc_id", "text")
    pairs = [tuple(r) for r in lk.alike_pairs(prints, "doc_id").collect()]
    assert len(pairs) == len(set(pairs)) == 3 * 40 * 40
    assert all(a < b and a % 3 != b % 3 for a, b in pairs)
    got = {r.doc_id: tuple(r)[1:] for r in lk.alike_classes(prints, "doc_id").collect()}
    assert all(got[i] == (0, i % 3, 120, 3, 80) for i in range(120))
    assert got[1000] == got[1001] == (1000, 1000, 2, 1, 0)
    assert lk.alike_classes(prints.limit(0), "doc_id").count() == 0


def test_pairs(spark):
    rows = [(1, "hola"), (2, "hоla"), (3, "hola"), (3, "hola"), (4, "hóla"), (5, None), (6, ""), (7, "​ "), (8, "‍"), (9, "ho­la"), (None, "hola"), (10, "x" * 200_000), (11, "x" * 200_000 + "​")]
    df = spark.createDataFrame([(k, t, 1) for k, t in rows], "doc_id long, text string, look_1 int")
    got = sorted(map(tuple, lk.alike_pairs(lk.look_prints(df, "doc_id", "text"), "doc_id").collect()))
    assert got == [(1, 2), (1, 9), (2, 3), (2, 9), (3, 9), (10, 11)]
    assert lk.look_prints(df.limit(0), "doc_id", "text").count() == 0
    canon = {r.doc_id: (r.canonical, r.changed) for r in lk.canonical_texts(df, ["doc_id"], "text").collect()}
    assert canon[2] == ("hola", True)
    assert canon[1] == ("hola", False)
    assert canon[5] == (None, None)
