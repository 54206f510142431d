from __future__ import annotations

import random

from docpipe.llm import mixing

SCHEMA = "doc string, source string, tokens int, slot int"
TARGETS = "source string, target_share double, max_repeats int"


def mixed(spark, docs, targets, block=32):
    d = spark.createDataFrame([(*x, 0) for x in docs], SCHEMA)
    t = spark.createDataFrame(targets, TARGETS)
    m = mixing.mix_sources(d, "doc", "source", "tokens", t, block)
    return m.collect(), {r.source: r for r in mixing.shares(m, d, "source", "tokens", t, "doc", block).collect()}


def corpus(sizes, seed=1):
    r = random.Random(seed)
    return [(f"{s}{i}", s, r.randint(1, 100)) for s, n in sizes.items() for i in range(n)]


def test_shares_and_repeats(spark, monkeypatch):
    monkeypatch.setattr(mixing, "DOCS_PER_CHUNK", 40)
    monkeypatch.setattr(mixing, "SLOTS_PER_CHUNK", 16)
    docs = corpus({"a": 600, "b": 300, "c": 30, "extra": 20})
    rows, share = mixed(spark, docs + docs[:50], [("a", 0.5, 1), ("b", 0.3, 2), ("c", 0.1, 6), ("gone", 0.1, 3)])
    slots = {}
    uses = {}
    size = {d: n for d, _, n in docs}
    for r in rows:
        slots.setdefault(r.slot, []).append(r)
        uses.setdefault(r.doc, []).append((r.round, r.from_token, r.to_token))
    assert sorted(slots) == list(range(len(slots)))
    assert all(sum(r.to_token - r.from_token for r in s) == 32 and len({r.source for r in s}) == 1 for s in slots.values())
    for s, want in (("a", 0.5 / 0.9), ("b", 0.3 / 0.9), ("c", 0.1 / 0.9)):
        assert abs(share[s].reached_share - want) < 0.02
    assert share["gone"].reached_share == 0
    assert share["extra"].target_share is None
    most = {"a": 1, "b": 2, "c": 6}
    for doc, parts in uses.items():
        assert len(set(parts)) == len(parts)
        assert max(p[0] for p in parts) < most[doc[0]]
        assert all(0 <= f < t <= size[doc] for _, f, t in parts)
        by_round = {}
        for n, f, t in sorted(parts):
            by_round.setdefault(n, []).append((f, t))
        for spans in by_round.values():
            assert all(x[1] == y[0] for x, y in zip(spans, spans[1:], strict=False))
    # the scarcest source is used nearly as often as it may
    c_total = sum(n for d, s, n in docs if s == "c")
    assert share["c"].tokens_used > 0.8 * 6 * c_total or share["a"].tokens_used > 0.8 * sum(n for d, s, n in docs if s == "a")


def test_every_prefix_is_near_its_target(spark):
    rows, share = mixed(spark, corpus({"a": 400, "b": 400}), [("a", 0.7, 1), ("b", 0.3, 2)])
    owner = {r.slot: r.source for r in rows}
    for n in (10, 50, 100):
        assert abs(sum(owner[i] == "a" for i in range(n)) / n - 0.7) < 0.11


def test_scarce_sources_run_out_and_leave_the_others_whole(spark, monkeypatch):
    monkeypatch.setattr(mixing, "SLOTS_PER_CHUNK", 16)
    docs = [*corpus({"a": 200, "b": 200}), ("s", "s", 20), ("t", "t", 50)]
    rows, share = mixed(spark, docs, [("a", 0.5, 1), ("b", 0.3, 2), ("s", 0.1, 1), ("t", 0.1, 1)])
    assert share["s"].tokens_used == 20 and share["t"].tokens_used == 50  # below one block; one block and a part
    assert share["a"].tokens_used > 0.95 * share["a"].tokens_available
    assert abs(share["a"].tokens_used / share["b"].tokens_used - 5 / 3) < 0.1
    assert {r.slot for r in rows} == set(range(max(r.slot for r in rows) + 1))
    assert sum(r.to_token - r.from_token for r in mixed(spark, [("s", "s", 20)], [("s", 1.0, 2)])[0]) == 40


def test_small_sources_do_not_empty_the_mixture(spark):
    docs = [*((f"big{i}", "big", 500) for i in range(400)), ("tiny", "tiny", 1500)]
    for size, uses in ((1500, 1), (1024, 1), (1000, 1), (10, 3)):  # more than a block, one block, less than a block, three uses of less
        rows, share = mixed(spark, [*docs[:-1], ("tiny", "tiny", size)], [("big", 0.9, 4), ("tiny", 0.1, uses)], block=1024)
        assert share["tiny"].tokens_used == size * uses and share["tiny"].reason == "used up"
        assert share["big"].tokens_used >= 4 * 400 * 500 - 1024
        assert {r.slot for r in rows} == set(range(max(r.slot for r in rows) + 1))


def test_exhaustion_is_exact_on_an_interval_of_high_discrepancy(spark, monkeypatch):
    monkeypatch.setattr(mixing, "SLOTS_PER_CHUNK", 1 << 12)
    # the middle source owns [0.438, 0.892), which golden-ratio points visit unevenly; every block of it must be met
    plan = spark.createDataFrame([("a", 0.438, 200_000, 200_000, 0.438), ("b", 0.454, 5000, 5001, 0.892), ("c", 0.108, 200_000, 200_000, 1.0)], "source string, weight double, whole long, blocks long, hi double")
    slots = mixing.schedule(plan)
    by = {r.source: (r.n, r.top) for r in slots.groupBy("source").agg({"rank": "count", "slot": "max"}).withColumnsRenamed({"count(rank)": "n", "max(slot)": "top"}).collect()}
    assert by["b"][0] == 5001  # used up, while a and c, more than half the weight, last much longer
    assert by["a"][0] == 200_000
    n = slots.count()
    assert slots.agg({"slot": "max"}).first()[0] == n - 1 and slots.select("slot").distinct().count() == n
    ranks = slots.groupBy("source").agg({"rank": "max"}).collect()
    assert all(r[1] == by[r[0]][0] - 1 for r in ranks)  # no hole in a source's own numbering


def test_reasons(spark):
    share = mixed(spark, [*corpus({"a": 50, "extra": 3}), ("z", "z", 0)], [("a", 0.5, 1), ("gone", 0.2, 1), ("z", 0.2, 1), ("n", 0.1, 0)])[1]
    assert {s: r.reason for s, r in share.items()} == {"a": "used up", "extra": "no target", "gone": "no documents", "z": "no tokens", "n": "no documents"}


def test_nothing_usable(spark):
    assert mixed(spark, [], [("a", 1.0, 1)])[0] == []
    assert mixed(spark, [("x", None, 5), ("y", "a", 0), ("z", "a", None), (None, "a", 9)], [("a", 1.0, 1)])[0] == []
    assert mixed(spark, corpus({"a": 5}), [("a", None, 1), (None, 0.5, 1)])[0] == []
