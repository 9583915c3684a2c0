"""The nearest members of a group, against all pairs."""

import random

import pytest

from casemine.operators import nearest as N


def plain(rows, k):
    out = []
    for i, g, x, y in rows:
        if None in (i, g, x, y):
            continue
        near = sorted(((x - a) * (x - a) + (y - b) * (y - b), j) for j, h, a, b in rows
                      if j != i and h == g and None not in (j, a, b))[:k]
        out += [(i, r + 1, j, d) for r, (d, j) in enumerate(near)]
    return sorted(out)


def frame(spark, rows):
    return spark.createDataFrame(rows, "case_id long, cluster int, x double, y double")


def spread(kind, rng):
    if kind == "even":
        return [(i, i % 3, rng.uniform(-50, 50), rng.uniform(0, 9)) for i in range(300)]
    if kind == "one place":  # two thirds of all in one place, the rest on a few
        return [(1000 - i, 0, 5.0, 7.0) if i % 3 else (i, 0, float(i % 7), float(i % 5)) for i in range(240)]
    if kind == "dense and far":  # a dense spot, some far away and on its border
        return ([(i, 0, 100 + rng.random() / 1000, rng.random() / 1000) for i in range(200)]
                + [(500 + i, 0, rng.uniform(0, 99), rng.uniform(0, 1e6)) for i in range(12)])
    if kind == "line":
        return [(i, 0, float(2 ** (i % 40)), 0.0) for i in range(120)]
    return [(1, 0, 0.0, 0.0), (2, 1, 0.0, 0.0), (3, 1, 4.0, 0.0), (4, None, 1.0, 1.0), (5, 1, None, 1.0), (6, 2, 9.0, 9.0),
            (7, 2, 9.0, 9.0), (8, 2, -9.0, -1e9), (None, 1, 0.0, 0.0)]


@pytest.mark.parametrize("kind", ["even", "one place", "dense and far", "line", "few and nulls"])
def test_against_all_pairs(spark, kind):
    rows = spread(kind, random.Random(1))
    for k, depth in ((5, None), (1, 3)):
        got = sorted(tuple(r) for r in N.related(frame(spark, rows), "cluster", k, depth=depth).collect())
        assert got == plain(rows, k)


def test_empty(spark):
    assert N.related(frame(spark, []), "cluster", 5).count() == 0


def test_pairs_grow_with_the_places(spark):
    """Twice the places, about twice the pairs, though all lie in one dense spot
    with some far from it."""
    def pairs(n):
        rng = random.Random(n)
        rows = ([(i, 0, rng.gauss(0, 1), rng.gauss(0, 1)) for i in range(n)]
                + [(10 * n + i, 0, rng.uniform(-1e5, 1e5), rng.uniform(-1e5, 1e5)) for i in range(n // 10)])
        return N.candidates(N.places(frame(spark, rows), "cluster", 5).checkpoint(), 5).count()
    small, large = pairs(1000), pairs(2000)
    assert large < 2.6 * small and large < 2000 * 200


def test_no_nested_loop(spark, sf_dir):
    import __spark_entry__ as E
    p = E.queries()["related_cases"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p
