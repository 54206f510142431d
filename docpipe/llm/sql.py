"""DuckDB SQL of the queries that SQL can express, by brute force."""

from __future__ import annotations

from docpipe.plans.registry import SQL_WS

_VECTORS = """v AS (SELECT 'chunk_vector' AS field_name, norm_id, chunk_index, chunk_vector AS vec FROM chunks UNION ALL SELECT 'resumen_vector', norm_id, -1, resumen_vector FROM norms),
 k AS (SELECT DISTINCT field_name, norm_id, chunk_index, vec FROM v WHERE norm_id IS NOT NULL AND chunk_index IS NOT NULL AND len(vec) > 0 AND list_max([abs(x) FOR x IN vec]) > 0),
 r AS (SELECT field_name, vec, min({'n': norm_id, 'c': chunk_index}) AS m FROM k GROUP BY ALL)"""

P1_COPIES = f"""WITH {_VECTORS}
 SELECT k.norm_id, k.chunk_index, r.m.n AS rep_norm_id, r.m.c AS rep_chunk_index, k.field_name FROM k JOIN r ON k.field_name = r.field_name AND k.vec = r.vec"""

_TEXTS = rf"""one AS (SELECT norm_id, min(full_content) AS c, min(title) AS t FROM norms WHERE norm_id IS NOT NULL GROUP BY norm_id),
 u AS (SELECT 'full_content' AS f, norm_id, regexp_extract_all(lower(c), '[\p{{L}}\p{{N}}]+') AS w FROM one WHERE c IS NOT NULL
   UNION ALL SELECT 'title', norm_id, string_split(lower(trim(regexp_replace(t, '{SQL_WS}+', ' ', 'g'))), '') FROM one WHERE t IS NOT NULL),
 big AS (SELECT * FROM u WHERE len(w) >= CASE f WHEN 'title' THEN 60 ELSE 80 END)"""
_PAIRS = """g AS (SELECT DISTINCT f, norm_id, unnest([w[i] || chr(1) || w[i + 1] || chr(1) || w[i + 2] FOR i IN range(1, len(w) - 1)]) AS x FROM big),
 n AS (SELECT f, norm_id, count(*) AS n FROM g GROUP BY ALL),
 s AS (SELECT a.f, a.norm_id AS a, b.norm_id AS b, count(*) AS s FROM g a JOIN g b ON a.f = b.f AND a.x = b.x AND a.norm_id < b.norm_id GROUP BY ALL),
 pairs AS (SELECT s.f AS field_name, s.a AS norm_id_a, s.b AS norm_id_b FROM s JOIN n p ON s.f = p.f AND s.a = p.norm_id JOIN n q ON s.f = q.f AND s.b = q.norm_id
   WHERE s / CAST(p.n + q.n - s AS DOUBLE) >= CASE s.f WHEN 'title' THEN CAST(0.8 AS DOUBLE) ELSE CAST(0.6 AS DOUBLE) END)"""
_CLASSES = "cls AS (SELECT b.f AS field_name, b.norm_id, min(o.norm_id) AS rep, count(*) AS copies FROM big b JOIN big o ON b.f = o.f AND b.w = o.w GROUP BY ALL)"

P3_FOUND = f"WITH {_TEXTS}, {_PAIRS} SELECT * FROM pairs"
P3_CLASSES = f"WITH {_TEXTS}, {_CLASSES} SELECT * FROM cls"
P3_GROUPS = f"""WITH RECURSIVE {_TEXTS}, {_PAIRS}, {_CLASSES},
 edge AS (SELECT field_name, norm_id_a AS a, norm_id_b AS b FROM pairs UNION ALL SELECT field_name, norm_id_b, norm_id_a FROM pairs),
 reach AS (SELECT field_name, norm_id AS a, norm_id AS b FROM cls UNION SELECT r.field_name, r.a, e.b FROM reach r JOIN edge e ON r.field_name = e.field_name AND r.b = e.a),
 grp AS (SELECT field_name, a AS norm_id, min(b) AS group_id FROM reach GROUP BY ALL),
 lnk AS (SELECT x.field_name, x.norm_id, count(DISTINCT y.rep) AS links FROM cls x JOIN edge e ON x.field_name = e.field_name AND x.norm_id = e.a JOIN cls y ON y.field_name = e.field_name AND y.norm_id = e.b WHERE y.rep <> x.rep GROUP BY ALL)
 SELECT grp.field_name, grp.norm_id, group_id, coalesce(links, 0) AS links FROM grp LEFT JOIN lnk ON grp.field_name = lnk.field_name AND grp.norm_id = lnk.norm_id"""

P4_FOUND = rf"""WITH t AS (SELECT 'full_content' AS field_name, norm_id, -1 AS chunk_index, min(full_content) AS x FROM norms WHERE norm_id IS NOT NULL GROUP BY norm_id
   UNION ALL SELECT 'chunk_text', norm_id, chunk_index, min(text) FROM chunks WHERE norm_id IS NOT NULL AND chunk_index IS NOT NULL GROUP BY norm_id, chunk_index)
 SELECT field_name, norm_id, chunk_index, CASE WHEN list_max([length(r) FOR r IN string_split_regex(x, '{SQL_WS}+')]) * 6 // 10 > 1000 THEN 'forced' ELSE 'boundary' END AS cut_kind
 FROM t WHERE length(x) * 6 // 10 > 1000"""

# exact; the index finds every neighbour at the small scales (recall of larger ones: README)
P1_FOUND_EXACT = f"""WITH {_VECTORS},
 p AS (SELECT a.field_name AS f, a.m AS a, b.m AS b, list_cosine_similarity(CAST(a.vec AS DOUBLE[]), CAST(b.vec AS DOUBLE[])) AS cos FROM r a JOIN r b ON a.field_name = b.field_name AND a.m <> b.m),
 top AS (SELECT f, a, b FROM (SELECT *, row_number() OVER (PARTITION BY f, a ORDER BY cos DESC, b) AS i FROM p) WHERE i <= 5)
 SELECT DISTINCT f AS field_name, least(a, b).n AS norm_id_a, least(a, b).c AS chunk_index_a, greatest(a, b).n AS norm_id_b, greatest(a, b).c AS chunk_index_b FROM top"""

ORACLE = {"p1_found": P1_FOUND_EXACT, "p1_copies": P1_COPIES, "p3_found": P3_FOUND, "p3_classes": P3_CLASSES, "p3_groups": P3_GROUPS, "p4_found": P4_FOUND}
