"""Sources, sinks, states and settings beyond what the queries show."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from docpipe.config import Config
from docpipe.functions import maps
from docpipe.operators import checkpoint, counters, embed, index, store
from docpipe.session import once_per_key
from docpipe.sources import fetch, objects
from docpipe.streaming import scan


def test_config():
    c = Config.from_env({"INDEX_URL": "https://x", "MAX_RETRIES": "5"})
    assert (c.max_retries, c.rate_limit_seconds, c.knowledge_id) == (5, 2.5, "legal-norms")
    with pytest.raises(ValueError, match="INDEX_USER is required; INDEX_PASSWORD is required"):
        c.validate_required()
    with pytest.raises(ValueError, match="RATE_LIMIT_SECONDS must lie.*MAX_RETRIES is not a number"):
        Config.from_env({"RATE_LIMIT_SECONDS": "0.5", "MAX_RETRIES": "many"})


def test_fetch_waits_between_tries(spark):
    waits = []
    assert fetch.fetch_one(1, lambda i: (200, "x" * 999))[2] == "too_short"
    ids = spark.createDataFrame([(1,), (None,)], "norm_id long").coalesce(1)

    def down(i):
        raise TimeoutError

    got = fetch.fetch_pages(ids, "norm_id", down, wait=waits.append).collect()
    assert [(r.norm_id, r.status, r.attempts, r.outcome) for r in got] == [(1, None, 3, "timeout")]
    assert fetch.fetch_pages(ids.limit(0), "norm_id", down).count() == 0


def test_only_throttling_is_tried_again():
    asked, waits = [], []

    def busy(texts):
        asked.append(len(texts))
        if len(asked) < 3:
            raise embed.Throttled
        return [[1.0]] * len(texts)

    assert embed.embed_request(["a", "b"], busy, wait=waits.append) == [[1.0], [1.0]]
    assert waits == [1.0, 2.0]

    def broken(texts):
        asked.append(0)
        raise KeyError

    asked.clear()
    with pytest.raises(KeyError):
        embed.embed_request(["a"], broken, wait=waits.append)
    assert asked == [0]
    for bad in ([], [""], ["x"] * 97):
        with pytest.raises(ValueError):
            embed.embed_request(bad, broken)
    assert len(embed.embed_one("hola")) == embed.DIMENSIONS


def test_upsert_with_maps(spark):
    old = spark.createDataFrame([("a", 1, {"x": "1"}), ("b", 5, None), (None, 1, None)], "k string, s int, m map<string,string>")
    new = spark.createDataFrame([("a", 2, {"y": "2"}, "n"), ("b", 4, {"z": "9"}, "n"), ("c", 1, {"p": "1"}, "n"), ("c", 1, {"p": "2"}, "n")], "k string, s int, m map<string,string>, note string")
    got = {r.k: (r.s, r.m, r.note) for r in index.upsert(old, new, "k", "s").collect()}
    assert got == {"a": (2, {"y": "2"}, "n"), "b": (5, None, None), "c": (1, {"p": "2"}, "n")}
    assert index.upsert(old.limit(0), new.limit(0), "k", "s").count() == 0


def test_store_passes_over_broken_versions(spark, tmp_path):
    path = str(tmp_path / "t")
    docs = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "k string, v int")
    assert not store.index_exists(spark, path) and store.current(spark, path) is None
    assert store.bulk_index(spark, path, docs, "k") == store.Result(2, 1)
    (tmp_path / "t" / "v=1").mkdir()  # a write that broke off
    assert store.current(spark, path).count() == 2
    assert store.bulk_index(spark, path, spark.createDataFrame([("a", 0)], "k string, v int"), "k") == store.Result(1, 0)
    assert {r.k: r.v for r in store.current(spark, path).collect()} == {"a": 0, "b": 2}  # the later write, though the smaller row
    assert store.bulk_index(spark, path, docs.limit(0), "k") == store.Result(0, 0)


def test_checkpoints(spark, tmp_path):
    path = str(tmp_path / "s")
    assert not checkpoint.finish(spark, path, "i", "completed")
    assert checkpoint.start_of(spark, path, "i", 7) == 7
    assert checkpoint.save(spark, path, "i", 40, {"note": "x"}, success_count=3)
    assert checkpoint.save(spark, path, "j", 0)
    assert checkpoint.start_of(spark, path, "i", 7) == 41
    assert checkpoint.start_of(spark, path, "j", 7) == 7
    assert checkpoint.finish(spark, path, "i", "failed", "timeout")
    assert not checkpoint.finish(spark, path, "i", "completed")  # an end is an end
    rows = {r.instance_id: r for r in store.current(spark, path).collect()}
    assert (rows["i"].status, rows["i"].error_message, rows["i"].last_id_processed, rows["i"].success_count, rows["i"].metadata) == ("failed", "timeout", 40, 3, {"note": "x"})
    assert rows["i"].failed_at and not rows["i"].completed_at and rows["j"].status == "running"


def test_scan_goes_on_behind_the_last_checkpoint(spark, tmp_path):
    where, seen = str(tmp_path / "scan"), []

    def process(ids):
        seen.append(ids.agg(F.min("norm_id"), F.max("norm_id")).first())
        return ids.withColumn("twice", F.col("norm_id") * 2)

    with pytest.raises(scan.Interrupted):
        scan.scan_range(spark, "i", 11, 45, 10, process, where, stop_after=1)
    assert scan.scan_range(spark, "i", 11, 45, 10, process, where) == [(21, 30), (31, 40), (41, 45)]
    assert [tuple(x) for x in seen] == [(11, 20), (21, 30), (21, 30), (31, 40), (41, 45)]  # the unsaved block again
    assert sorted(r.norm_id for r in scan.results(spark, where).collect()) == list(range(11, 46))
    state = store.current(spark, f"{where}/state").first()
    assert (state.status, state.last_id_processed) == ("completed", 40)  # completion doesn't move the last id

    def fails(ids):
        raise RuntimeError("no site")

    with pytest.raises(RuntimeError, match="no site"):
        checkpoint.save(spark, f"{where}/state", "k", 5)
        scan.scan_range(spark, "k", 1, 9, 5, fails, where)
    assert {r.instance_id: r.status for r in store.current(spark, f"{where}/state").collect()} == {"i": "completed", "k": "failed"}


def test_objects(spark, tmp_path):
    root = str(tmp_path / "o")
    assert objects.list_objects(spark, root).count() == 0
    df = spark.createDataFrame([("a/ñ 1.json", '{"t": "ñandú"}'), ("a/2.json", "{broken"), (None, "{}"), ("b/3.json", None), ("a/ñ 1.json", '{"t": "ñandú"}')], "key string, document string")
    got = sorted((r.key or "", r.ok, (r.error or "").split(":")[0]) for r in objects.put_objects(df, "key", "document", root).collect())
    assert got == [("", False, "ValueError"), ("a/2.json", False, "JSONDecodeError"), ("a/ñ 1.json", True, ""), ("a/ñ 1.json", True, ""), ("b/3.json", False, "ValueError")]
    body = (tmp_path / "o" / "a" / "ñ 1.json").read_bytes()
    assert body.decode() == json.dumps({"t": "ñandú"}, ensure_ascii=False, indent=2)
    assert [r.size_bytes for r in objects.list_objects(spark, root, "a/").collect()] == [len(body)]
    assert objects.list_objects(spark, root, "b/").count() == 0


def test_run_with_empty_norms(spark, tmp_path):
    columns = "norm_id long, norm_type string, norm_number string, title string, publication_date date, promulgation_date date, last_modified date, issuing_body string, norm_version string, official_url string, summary string, full_content string, subject_tags array<string>"
    rows = [(1, *[None] * 10, "Texto de la norma.", None), (2, *[None] * 10, " \n", None), (3, *[None] * 12)]
    got = counters.index_norms(spark.createDataFrame(rows, columns), str(tmp_path / "run"))
    assert got["pipeline"] == {"processed": 3, "chunks": 1, "vectors": 1, "indexed": 1, "stored": 1, "failed": 2}
    none = counters.index_norms(spark.createDataFrame([], columns), str(tmp_path / "none"))
    assert set(none["pipeline"].values()) == {0}


def test_maps(spark):
    df = spark.createDataFrame([(1, {"a": "1", "b": None}), (2, None)], "i int, m map<string,string>")
    other = F.create_map(F.lit("a"), F.lit("9"))
    got = df.select("i", maps.value_or("m", "a", F.lit("-")).alias("v"), maps.has_key("m", "b").alias("h"), maps.merged("m", other).alias("x"), maps.without_nulls("m").alias("n")).collect()
    assert [tuple(r)[1:] for r in got] == [("1", True, {"b": None, "a": "9"}, {"a": "1"}), ("-", False, {"a": "9"}, None)]
    assert len(spark.range(1).select(maps.now_iso().alias("t")).first().t) == 26


def test_once_per_key(spark):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (2, None), (3, "x"), (3, "x"), (4, None), (4, "y")], "k int, v string")
    want = {(1, "a"), (2, None), (3, "x"), (4, "y")}
    assert sorted(map(tuple, once_per_key(df, ["k"], "v").collect()), key=str) == sorted(want, key=str)
    assert {tuple(r) for r in once_per_key(df, ["k"], "v", buckets=1).collect()} == want
    assert once_per_key(df.limit(0), ["k"], "v").count() == 0
