"""Posting lists in blocks, against plain sets."""

import random

from casemine.operators import postings as PO


def frame(spark, pairs):
    return spark.createDataFrame(pairs, "term string, case_id long")


def make(seed=2):
    rng = random.Random(seed)
    pairs = [("hot", i) for i in range(-50, 700)]
    pairs += [(f"w{rng.randint(0, 30)}", rng.randint(0, 10 ** 12)) for _ in range(400)]
    return pairs + pairs[:60] + [(None, 3), ("w1", None)]


def wanted(pairs):
    return {(t, c) for t, c in pairs if t is not None and c is not None}


def test_blocks_hold_all_and_no_more(spark):
    pairs = make()
    lists = PO.blocks(frame(spark, pairs), "term", "case_id", 64)
    assert {tuple(r) for r in PO.pairs_of(lists, "term", "case_id", 64).collect()} == wanted(pairs)
    rows = lists.collect()
    assert len(rows) == len({(r["term"], r["block"]) for r in rows})
    for r in rows:  # no row outgrows the width, however many cases a word has
        assert r["n"] == len(r["deltas"]) <= 64 and r["deltas"] == sorted(set(r["deltas"])) and 0 <= r["deltas"][0]
    hot = {r["block"]: r["n"] for r in rows if r["term"] == "hot"}
    assert hot == {-1: 50, **{b: 64 for b in range(10)}, 10: 60}


def test_inverted_and_search(spark):
    pairs = make(5)
    want = wanted(pairs)
    lists = PO.blocks(frame(spark, pairs), "term", "case_id", 64).checkpoint()
    words = sorted({t for t, _ in want})
    numbers = spark.createDataFrame([(w, i) for i, w in enumerate(words)], "term string, term_id long")
    back = PO.inverted(lists, "term", "case_id", numbers, "term_id", 64)
    assert {tuple(r) for r in PO.pairs_of(back, "case_id", "term_id", 64).collect()} == {(c, words.index(t)) for t, c in want}
    asked = [("q1", "hot"), ("q1", "hot"), ("q2", "w1"), ("q2", "w2"), ("q3", "nowhere"), ("q4", "hot"), ("q4", "nowhere"),
             ("q4", None), (None, "hot")]
    frame_of = spark.createDataFrame(asked, "q string, term string")
    got = {tuple(r) for r in PO.holding(lists, "term", "case_id", frame_of, "q", 64).collect()}
    of = lambda w: {c for t, c in want if t == w}
    assert got == ({("q1", c, 1, 1) for c in of("hot")} | {("q4", c, 1, 2) for c in of("hot")}
                   | {("q2", c, (c in of("w1")) + (c in of("w2")), 2) for c in of("w1") | of("w2")})
    assert {tuple(r) for r in PO.holding_all(lists, "term", "case_id", frame_of, "q", 64).collect()} == {
        (q, c) for q, c, hits, n in got if hits == n}
    pair = [("hot", 699), ("hot", 700), ("hot", -50), ("nowhere", 1), ("hot", None)]
    assert {tuple(r) for r in PO.holds_pair(lists, "term", frame(spark, pair), "case_id", 64).collect()} == {
        ("hot", 699), ("hot", -50)}


def test_all_of_several(spark):
    pairs = [("a", i) for i in range(0, 900, 2)] + [("b", i) for i in range(0, 900, 3)] + [("c", i) for i in range(0, 900, 5)]
    lists = PO.blocks(frame(spark, pairs), "term", "case_id", 128)
    asked = spark.createDataFrame([("q", w) for w in "abc"], "q string, term string")
    assert {r["case_id"] for r in PO.holding_all(lists, "term", "case_id", asked, "q", 128).collect()} == set(range(0, 900, 30))


def test_empty(spark):
    assert PO.blocks(frame(spark, []), "term", "case_id").count() == 0


def test_search_sorts_no_lists_and_reads_them_once(spark, monkeypatch):
    """Neither a sort of the lists nor, for many queries, a second pass over them."""
    from casemine.operators import broadcast as BC
    pairs = make(7)
    want = wanted(pairs)
    words = sorted({t for t, _ in want})
    asked = [(f"q{i}", w) for i, pair in enumerate(zip(words, words[1:])) for w in pair]
    lists = PO.blocks(frame(spark, pairs), "term", "case_id", 64)
    monkeypatch.setattr(BC, "is_small", lambda *a, **k: False)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = PO.holding_all(lists, "term", "case_id", spark.createDataFrame(asked, "q string, term string"), "q", 64)
        plan = found._jdf.queryExecution().sparkPlan().toString()
        of = lambda w: {c for t, c in want if t == w}
        assert {tuple(r) for r in found.collect()} == {
            (f"q{i}", c) for i, (a, b) in enumerate(zip(words, words[1:])) for c in of(a) & of(b)}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("ShuffledHashJoin") == 1 and plan.count("collect_set") == 2  # partial and final
