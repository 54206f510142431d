from __future__ import annotations

import random

from docpipe.llm import neardup

SPECS = {"body": neardup.Shingles("words", 3, 20, 0.6, rows=4), "head": neardup.Shingles("chars", 3, 20, 0.8, rows=8)}
SCHEMA = "id long, body string, head string, rep string, field string"


def edited(words, share, rnd):
    return [rnd.choice(["uno", "dos", "tres"]) + str(rnd.random()) if rnd.random() < share else w for w in words]


def corpus(n=60, seed=1):
    rnd = random.Random(seed)
    out = []
    for _ in range(n):
        words = [f"w{rnd.randrange(3000)}" for _ in range(rnd.randint(25, 120))]
        out.append(" ".join(words))
        for _ in range(rnd.randint(0, 3)):
            out.append(" ".join(edited(words, rnd.choice([0, 0.02, 0.05, 0.12]), rnd)))
    return out


def brute(texts, field):
    spec, out = SPECS[field], set()
    items = {i: spec.items(u) for i, t in texts.items() if t and (u := spec.units(t)) is not None}
    for a in items:
        for b in items:
            if a < b and len(items[a] & items[b]) / len(items[a] | items[b]) >= spec.threshold:
                out.add((field, a, b))
    return out


def found(spark, rows, **caps):
    df = spark.createDataFrame([(i, b, h, "clash", "clash") for i, b, h in rows], SCHEMA)
    members, links = neardup.near_duplicates(df, "id", SPECS, **caps)
    return members, links, {tuple(r) for r in neardup.all_pairs(members, links).collect()}


def test_pairs_equal_brute_force(spark):
    texts = corpus()
    rows = [(i, t, t[:90]) for i, t in enumerate(texts)]
    members, links, got = found(spark, rows + rows[:9])
    want = brute({i: t for i, t, _ in rows}, "body") | brute({i: h for i, _, h in rows}, "head")
    assert got <= want
    assert len(got) >= 0.99 * len(want)
    grouped = {(r.field, r.id): r.group_id for r in neardup.groups(members, links).collect()}
    assert all(grouped[f, a] == grouped[f, b] for f, a, b in got)
    assert all(g <= i for (_, i), g in grouped.items())


def test_crowded_buckets_lose_nothing(spark):
    rnd = random.Random(5)
    base = [f"w{i}" for i in range(90)]
    family = [" ".join(edited(base, 0.03, rnd)) for _ in range(40)]
    rows = [(i, t, None) for i, t in enumerate([*family, *corpus(30, seed=9)])]
    _, _, plain = found(spark, rows)
    _, _, crowded = found(spark, rows, bucket_cap=6, block=8)
    assert crowded == plain
    assert len(plain) > 300


def test_copies_form_one_class(spark):
    text = " ".join(f"palabra{i}" for i in range(40))
    rows = [(i, text.upper() if i % 2 else f"  {text}!", None) for i in range(12)]
    members, links, got = found(spark, rows)
    assert links.count() == 0
    assert {(r.rep, r.copies) for r in members.collect()} == {(0, 12)}
    assert len(got) == 66
    star = neardup.all_pairs(members, links, max_expand=5)
    assert {(r.a, r.b) for r in star.collect()} == {(0, i) for i in range(1, 12)}


def test_large_classes_are_spelled_out_with_their_links(spark):
    n = neardup.MAX_EXPAND + 5
    members = spark.createDataFrame([("body", i, 0, n) for i in range(n)] + [("body", n + i, n, 2) for i in range(2)], "field string, id long, rep long, copies long")
    links = spark.createDataFrame([("body", 0, n)], "field string, rep_a long, rep_b long")
    got = neardup.all_pairs(members, links)
    assert got.count() == got.distinct().count() == n * (n - 1) // 2 + 1 + 2 * n


def test_edges(spark):
    short, long = "uno dos tres", "palabra única " * 50_000
    rows = [(1, None, None), (None, "x " * 50, "y" * 50), (2, "", ""), (3, short, short), (4, long, "a" * 500), (5, long + "fin", "a" * 501)]
    _, _, got = found(spark, rows)
    assert got == {("body", 4, 5), ("head", 4, 5)}
    members, links, none = found(spark, [])
    assert none == set()
    assert neardup.groups(members, links).count() == 0


def test_the_stated_recall_of_the_bands():
    for s in SPECS.values():
        assert 1 - (1 - s.threshold**s.rows) ** s.bands >= s.recall


def test_an_id_with_two_texts(spark):
    """The class with the smallest hash stands for the id, and its own text is the one that is compared."""
    base, spec, seen = [f"w{i}" for i in range(60)], SPECS["body"], set()
    near = " ".join([*base[:-1], "otra"])
    for k in range(20):
        far = " ".join(f"z{k}x{i}" for i in range(60))
        wins = spec_class(spec, near) < spec_class(spec, far)
        if wins not in seen:
            seen.add(wins)
            _, _, got = found(spark, [(1, " ".join(base), None), (2, near, None), (2, far, None)])
            assert got == ({("body", 1, 2)} if wins else set())
    assert seen == {True, False}


def spec_class(spec, text):
    return neardup.class_of("body", spec, spec.units(text))


def test_verifier_equals_sets():
    rnd = random.Random(3)
    for name, spec in SPECS.items():
        texts = [t for t in corpus(12, seed=4)]
        v = neardup.Verifier(spec, room=500)
        for _ in range(200):
            a, b = rnd.randrange(len(texts)), rnd.randrange(len(texts))
            assert v.similarity(a, texts[a], b, texts[b]) == spec.similarity(spec.units(texts[a]), spec.units(texts[b])), name


def test_verifier_without_room_for_more_numbers(monkeypatch):
    texts, spec = corpus(12, seed=4), SPECS["body"]
    rnd = random.Random(6)
    for largest in (40, 150, 400):  # fewer than a text has, than two have, than all have
        monkeypatch.setattr(neardup, "LARGEST_NUMBER", largest)
        v = neardup.Verifier(spec, room=500)
        for _ in range(200):
            a, b = rnd.randrange(len(texts)), rnd.randrange(len(texts))
            assert v.similarity(a, texts[a], b, texts[b]) == spec.similarity(spec.units(texts[a]), spec.units(texts[b]))


def test_banding_for_large_collections(spark, monkeypatch):
    spec = neardup.Shingles("words", 3, 80, 0.6, rows=4)
    assert [spec.for_rows(n).rows for n in (0, 10**6, 3 * 10**7, 10**8, 3 * 10**8, 10**9)] == [4, 4, 4, 5, 5, 6]
    for n in (10**6, 10**9):
        s = spec.for_rows(n)
        assert 1 - (1 - s.threshold**s.rows) ** s.bands >= spec.recall
    monkeypatch.setattr(neardup, "EASY_ROWS", 5)
    texts = corpus()
    rows = [(i, t, t[:90]) for i, t in enumerate(texts)]
    want = brute({i: t for i, t, _ in rows}, "body") | brute({i: h for i, _, h in rows}, "head")
    got = found(spark, rows)[2]
    assert got <= want and len(got) >= 0.99 * len(want)
