from __future__ import annotations

from hypothesis import given, settings
from hypothesis import strategies as st

from docpipe.llm import splitting as sp

PIECE = st.sampled_from(["a", "bc", " ", ". ", "\n\n", "\n", ", ", "; ", "x" * 40, "y" * 90, "ñ"])


@settings(max_examples=400, deadline=None)
@given(st.lists(PIECE, max_size=150), st.sampled_from([20, 30, 60]), st.sampled_from([0, 5, 10]))
def test_pieces(parts, limit, overlap):
    text = "".join(parts)
    got = sp.pieces(text, limit, overlap)
    assert got[0][0] == 0
    assert got[-1][1] == len(text)
    for i, (a, e, _) in enumerate(got):
        assert sp.tokens(e - a) <= limit
        if i:
            assert a <= got[i - 1][1] < e
    fits = sp.longest_run(text) <= sp.chars_within(limit)
    assert not (fits and any(k == "forced" for _, _, k in got))
    for a, e, k in got:
        if k == "boundary":
            assert text[e - 1].isspace() or text[e].isspace(), (a, e)


def test_limits():
    assert sp.chars_within(1000) == 1668
    assert sp.chars_reaching(50) == 84
    assert [sp.tokens(n) for n in (0, 1, 2, 1668, 1669)] == [0, 0, 1, 1000, 1001]
    text = "palabra " * 1000
    got = sp.pieces(text)
    assert all(got[i][1] - got[i + 1][0] == 84 for i in range(len(got) - 1))


def test_rows(spark):
    rows = [(1, "corto", "c"), (1, "corto", "c"), (2, None, "c"), (3, "", "c"), (4, "x" * 5000, "c"), (5, "hola. " * 900, "c"), (None, "x" * 5000, "c")]
    df = spark.createDataFrame(rows, "id int, t string, piece string")
    got = sp.split_texts(df, ["id"], "t").collect()
    by = {}
    for r in sorted(got, key=lambda r: (r.id, r.piece)):
        by.setdefault(r.id, []).append(r)
    assert set(by) == {1, 3, 4, 5}
    assert [(r.piece, r.text_kind, r.piece_text) for r in by[1]] == [(0, "whole", "corto")]
    assert by[3][0].piece_text == ""
    assert {r.text_kind for r in by[4]} == {"forced"}
    assert {r.text_kind for r in by[5]} == {"boundary"}
    for k, text in ((4, "x" * 5000), (5, "hola. " * 900)):
        assert by[k][0].piece_text + "".join(r.piece_text[r.overlap_chars :] for r in by[k][1:]) == text
    assert sp.split_texts(df.limit(0), ["id"], "t").count() == 0
