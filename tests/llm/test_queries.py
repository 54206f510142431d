from __future__ import annotations

import pytest
from parity import assert_same, connect

from docpipe.llm import queries, sql

COLUMNS = {
    "p1_found": "field_name string, norm_id_a bigint, chunk_index_a int, norm_id_b bigint, chunk_index_b int",
    "p2_found": "field_name string, norm_id bigint, raw_value string, ref_id int",
    "p3_found": "field_name string, norm_id_a bigint, norm_id_b bigint",
    "p4_found": "field_name string, norm_id bigint, chunk_index int, cut_kind string",
    "p5_found": "field_name string, norm_id bigint",
    "p6_ids": "doc_id bigint, ids array<int>",
    "p8_found": "doc_id_a bigint, doc_id_b bigint",
}


@pytest.mark.parametrize("name", sorted(queries.queries()))
def test_query(spark, small, name):
    df = queries.queries()[name](spark, small)
    if name in COLUMNS:
        assert ", ".join(f"{c} {t}" for c, t in df.dtypes) == COLUMNS[name]
    rows = df.collect()
    assert rows or name == "p8_found"
    if name.endswith("_found"):
        assert len({tuple(r) for r in rows}) == len(rows)


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_says_what_its_sql_says(spark, small, name):
    assert_same(queries.queries()[name](spark, small), connect(small), queries.oracle_sql()[name])


def test_neighbours_against_brute_force(spark, small):
    """Recall and precision of the pairs against every pair compared in SQL."""
    found = {tuple(r) for r in queries.p1_found(spark, small).collect()}
    want = set(connect(small).execute(sql.P1_FOUND_EXACT).fetchall())
    assert len(found & want) >= 0.97 * max(len(want), len(found))
