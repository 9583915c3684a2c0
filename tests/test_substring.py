"""Substring matching of terms against lines, against the plain nested loop."""

import random

import pytest

from casemine.operators import substring as S

LINES = [("the quick fox", 1.0), ("the quick fox", 4.0), ("éa日本語 text", 2.0), ("", 9.0), (None, 9.0), ("ab", 3.0),
         ("aaaaaaaaaa", 0.5), ("x" * 3000 + "needle" + "y" * 3000, 7.0), ("fox", 0.0), ("a.b*c\n<d>", 1.5)]
TERMS = ["the", "e q", "quick fox", "uick fo", "fox", "日本語 ", "日本語 text", "ab", "a", "aaaaaa", "aaaaaaaaaaa", "needle",
         "xneedley", "needles", "zzz", "", None, "abc", "b*c\n<d", "the quick fox", "the quick foxes", "x"]


def plain(terms, lines):
    out = {}
    for t in {t for t in terms if t}:
        got = [s for l, s in lines if l is not None and t in l]
        if got:
            out[t] = max(got)
    return out


def run(spark, terms, lines, size=S.GRAM):
    rows = [("one", *x) for x in lines] + [("other", *x) for x in lines[::2]]
    got = S.contained_scores(spark.createDataFrame([(t,) for t in dict.fromkeys(terms)], "term string"),
                             spark.createDataFrame(rows, "kind string, line string, score double"), size)
    found = [tuple(r) for r in got.collect()]
    assert len(found) == len({(t, k) for t, k, _ in found})
    assert {t: s for t, k, s in found if k == "other"} == plain(terms, lines[::2])
    return {t: s for t, k, s in found if k == "one"}


@pytest.mark.parametrize("size", [1, 3, 8])
def test_fixed(spark, size, monkeypatch):
    if size == 3:  # terms across the borders of chunks
        monkeypatch.setattr(S, "CHUNK", 4)
    assert run(spark, TERMS, LINES, size) == plain(TERMS, LINES)


def test_random_with_hot_windows(spark):
    rng = random.Random(3)
    word = lambda: "".join(rng.choice(["tion", "ing", "a", "é", "ox", " "]) for _ in range(rng.randint(1, 6)))
    lines = [("commonpart " + " ".join(word() for _ in range(4)), float(rng.randint(0, 50))) for _ in range(300)]
    terms = [word() for _ in range(400)] + ["commonpart", "ommonpart t", "onpart ing"]
    assert run(spark, terms, lines) == plain(terms, lines)


def test_empty(spark):
    assert run(spark, [], LINES) == {} and run(spark, TERMS, []) == {}


def test_plan_has_no_nested_loop(spark, sf_dir):
    import __spark_entry__ as E
    p = E.queries()["term_weights_substring"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


def test_hot_window_is_dealt(spark):
    """With every line holding one window, no bucket of it gets all lines."""
    counts = spark.createDataFrame([("hotty", 900), ("other", 50), ("rares", 50)], "gram string, lines long")
    p = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = S._buckets(counts, spark)
    assert dealt["hotty"] == -(-900 * p // 1000) and 900 / dealt["hotty"] <= 1000 / p + 1
