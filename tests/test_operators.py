from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from docpipe.operators import batching, checkpoint, embed, index, validate
from docpipe.sources import ranges
from docpipe.streaming import resume


def batches(spark, tokens):
    df = spark.createDataFrame([(0, i, t) for i, t in enumerate(tokens)], "u int, o int, t int")
    return [r.batch for r in batching.greedy_batches(df, "u", "o", "t").orderBy("o").collect()]


@pytest.mark.parametrize(
    ("tokens", "want"),
    [([5] * 97, [0] * 96 + [1]), ([100_000, 100_001], [0, 1]), ([60_000, 60_000], [0, 1]), ([5, 200_000, 5], [0, 1, 2]), ([200_000, 5], [0, 1]), ([], [])],
)
def test_greedy_batches(spark, tokens, want):
    assert batches(spark, tokens) == want


def test_greedy_batches_keep_order_and_limits(spark):
    tokens = [(i * 7919) % 40_000 for i in range(300)]
    got = batches(spark, tokens)
    assert got == sorted(got)
    for b in set(got):
        assert sum(t for t, x in zip(tokens, got, strict=True) if x == b) <= 100_000
        assert got.count(b) <= 96


def test_upsert(spark):
    old = spark.createDataFrame([(1, 1, "a"), (2, 5, "b"), (None, 1, "x")], "k int, s int, v string")
    new = spark.createDataFrame([(1, 2, "c"), (2, 4, "d"), (3, 1, None), (3, 1, "e")], "k int, s int, v string")
    once = index.upsert(old, new, "k", "s")
    assert sorted(map(tuple, once.collect())) == [(1, 2, "c"), (2, 5, "b"), (3, 1, "e")]
    assert sorted(map(tuple, index.upsert(once, new, "k", "s").collect())) == sorted(map(tuple, once.collect()))


@pytest.mark.parametrize(
    ("outcomes", "want"),
    [(["ok"], (1, 0, 0, 0, 1)), (["not_found"], (0, 1, 3, 0, 1)), (["retry"] * 3 + ["timeout"], (0, 1, 0, 3, 1)), (["unparseable"], (0, 1, 0, 0, 1)), (["placeholder"], (0, 0, 1, 0, 1))],
)
def test_outcome_counters(spark, outcomes, want):
    c = checkpoint.outcome_counters(spark.createDataFrame([("i", o) for o in outcomes], "i string, o string"), "i", "o").first()
    assert (c.success_count, c.failed_count, c.skipped_count, c.retry_count, c.total_processed) == want


def test_counters_without_rows(spark):
    assert checkpoint.outcome_counters(spark.createDataFrame([], "i string, o string"), "i", "o").count() == 0


def test_ranges(spark):
    plan = {r.instance: (r.first_id, r.last_id) for r in ranges.range_plan(spark).collect()}
    assert plan[1] == (1, 250_000)
    assert plan[8] == (1_750_001, 2_000_000)
    assert [r.i for r in spark.createDataFrame([(1,), (250_000,), (250_001,), (2_500_000,)], "x long").select(ranges.instance_of("x").alias("i")).collect()] == [1, 1, 2, 8]
    with pytest.raises(ValueError, match="empty"):
        ranges.id_range(spark, 2, 1)


def test_skip_list(spark):
    lines = spark.createDataFrame([(" 7 ",), ("7",), ("x8",), ("",), (None,), ("9\t",), ("99999999999999999999999",)], "line string")
    assert sorted(r.norm_id for r in ranges.skip_ids(lines, "line").collect()) == [7, 9]
    ids = spark.createDataFrame([(7,), (8,), (None,)], "norm_id long")
    assert ids.count() - validate.without(ids, ranges.skip_ids(lines, "line"), "norm_id").count() == 1


def test_resume_points(spark):
    plan = spark.createDataFrame([("a", 1), ("b", 10), ("c", 20)], "instance_id string, first_id long")
    saved = spark.createDataFrame([("a", 40), ("b", 0)], "instance_id string, last_id_processed long")
    assert {r.instance_id: r.start_id for r in checkpoint.resume_points(plan, saved).collect()} == {"a": 41, "b": 10, "c": 20}


def test_running_progress_across_ranges(spark):
    df = spark.createDataFrame([("i", n, n % 2 == 0) for n in range(1, 501)], "i string, n int, ok boolean")
    got = checkpoint.running_progress(df, "i", ["n"], F.col("ok"), every=50, ranges=7)
    assert {r.position: r.succeeded for r in got.collect()} == {p: p // 2 for p in range(50, 501, 50)}


def test_a_stream_run_again_adds_nothing(spark, tmp_path):
    spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "e string, n int").write.parquet(str(tmp_path / "in"))
    where = str(tmp_path / "state")
    for _ in range(2):
        counts = resume.resumable_counts(spark, str(tmp_path / "in"), "e", where)
        assert {r.e: r.n for r in counts.collect()} == {"a": 2, "b": 1}


def test_originals_and_broken_documents(spark, tmp_path):
    norms = spark.createDataFrame([(1, "ñ", None)], "norm_id long, title string, summary string")
    index.write_originals(norms, str(tmp_path / "out"))
    back = spark.read.schema("norm_id long, title string, doc_id string").json(str(tmp_path / "out"))
    assert back.first().asDict() == {"norm_id": 1, "title": "ñ", "doc_id": "bcn-1", "knowledge_id": "legal-norms"}
    (tmp_path / "docs").mkdir()
    (tmp_path / "docs" / "a.json").write_text(json.dumps({"norm_id": 1, "full_content": "x"}, indent=2))
    (tmp_path / "docs" / "b.json").write_text("{broken")
    good, broken = ranges.read_documents(spark, str(tmp_path / "docs"), "norm_id long, full_content string")
    assert (good.count(), broken.count()) == (1, 1)


def test_embedding(spark):
    df = spark.createDataFrame([(i, f"texto {i % 3}") for i in range(200)] + [(900, None), (901, "")], "id int, t string")
    rows = embed.embed(df, ["id"], "t").collect()
    assert len(rows) == 200
    assert len({tuple(r.vector) for r in rows}) == 3

    def short(texts: list[str]) -> list[list[float]]:
        return [[0.0]] * (len(texts) - 1)

    with pytest.raises(Exception, match="vectors received"):
        embed.embed(df, ["id"], "t", short).collect()


def test_mark(spark):
    t = spark.createDataFrame([("a", "running", None, None, None), ("b", "running", None, None, None)], "instance_id string, status string, completed_at string, failed_at string, error_message string")
    done = {r.instance_id: r for r in checkpoint.mark(t, "a", "completed", "now").collect()}
    assert (done["a"].status, done["a"].completed_at, done["b"].status) == ("completed", "now", "running")
