import math

import numpy as np
from pyspark.sql import functions as F

from casemine.llm import ann
from casemine.llm.ann import box_distance, chi_square_bound, exact, neighbours, split


def brute(rows, k=5, every=50):
    rows = [(i, np.array(v, dtype=float)) for i, v in rows if i is not None and v is not None and all(
        x is not None and math.isfinite(x) for x in v) and any(v)]
    ids, data = np.array([i for i, _ in rows]), np.array([v for _, v in rows])
    out = {}
    norm = np.sqrt((data * data).sum(axis=1))
    for i, v in rows:
        if i % every == 0:
            score = np.array([float(np.dot(v, x) / (math.sqrt(np.dot(v, v)) * math.sqrt(np.dot(x, x)))) for x in data])
            best = {}
            for s, x in zip(score, ids):
                if x != i:
                    best[x] = max(s, best.get(x, -2))
            out[i] = sorted((-s, x) for x, s in best.items())[:k]
    assert norm.min() > 0
    return out


def recall(got, want):
    found = {}
    for r in got:
        found.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    hit = total = 0
    for q, best in want.items():
        mine = sorted(found.get(q, []))
        assert [m[0] for m in mine] == list(range(1, len(best) + 1))
        assert [(-s, x) for _, x, s in mine] == sorted((-s, x) for _, x, s in mine)
        hit += len({x for _, x, _ in mine} & {x for _, x in best})
        total += len(best)
    assert set(found) <= set(want)
    return hit / total


def test_chi_square():
    assert abs(chi_square_bound(8, 0.95) - 15.5073) < 1e-3 and abs(chi_square_bound(2, 0.5) - 1.38629) < 1e-4


def test_leaves_and_boxes():
    p = np.random.default_rng(1).normal(size=(500, 8))
    leaves = split(p, 20)
    assert sorted(np.concatenate(leaves).tolist()) == list(range(500)) and max(map(len, leaves)) <= 20
    top = ann.Top(p, 4)
    low, high = top.boxes()
    d = box_distance(p, low, high)
    assert (d[np.arange(500), top.cell(p)] == 0).all() and ((d == 0).sum(axis=1) >= 1).all()


def test_embeddings(spark):
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"]) for r in table.collect()]
    want = brute(rows)
    asked = F.col("vec_id") % 50 == 0
    assert recall(neighbours(table, asked).collect(), want) >= 0.95
    kept = ann.CELL_ROWS, ann.QUERY_ROWS
    ann.CELL_ROWS, ann.QUERY_ROWS = 200, 3  # many cells, parts and groups of queries
    try:
        assert recall(neighbours(table, asked).collect(), want) >= 0.95
    finally:
        ann.CELL_ROWS, ann.QUERY_ROWS = kept


def test_hot_vector_and_odd_rows(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=4).tolist()) for i in range(60)] + [(100 + i, [1.0, 2.0, 0.5, 0.0]) for i in range(150)]
    rows += [(None, [1.0] * 4), (700, None), (701, [0.0] * 4), (702, [1.0, None, 0.0, 0.0]), (703, [math.nan, 0.0, 0.0, 1.0]),
             (704, [math.inf, 0.0, 0.0, 1.0]), (50, rows[50][1]), (100, [1.0, 2.0, 0.5, 0.0]), (705, [1e-200] * 4)]
    table = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], "vec_id long, embedding array<double>, cell string, v int")
    got = neighbours(table, F.col("vec_id") % 50 == 0).collect()
    want = brute([(i, [x * 1e100 for x in v] if i == 705 else v) for i, v in rows])
    assert recall(got, want) >= 0.95
    hot = sorted((r["rank"], r["vec_id"]) for r in got if r["query_id"] == 200)
    assert [x for _, x in hot] == [100, 101, 102, 103, 104]
    odd = spark.createDataFrame([(0, [1.0, 0.0]), (50, [0.5, 0.5]), (1, [1.0]), (2, [0.0, 1.0])], "vec_id long, embedding array<double>")
    assert sorted((r["query_id"], r["rank"], r["vec_id"]) for r in neighbours(odd, F.col("vec_id") % 50 == 0).collect()) \
        == [(0, 1, 50), (0, 2, 2), (50, 1, 0), (50, 2, 2)]
    assert neighbours(odd.limit(0), F.col("vec_id") % 50 == 0).count() == 0


def test_ties_of_different_vectors_go_to_smaller_ids(spark):
    """Scaled copies, vectors of signs and one-hot vectors: far more than k + 1
    different vectors have one cosine."""
    rng = np.random.default_rng(8)
    v = rng.normal(size=16)
    scaled = [(v * 2.0 ** e).tolist() for e in rng.permutation(np.arange(-60, 60))]
    signs = rng.choice([-1.0, 1.0], size=(3000, 12)).tolist()
    hot = np.eye(40).tolist()
    for vectors in (scaled, signs, hot):
        rows = list(zip(rng.permutation(len(vectors)).tolist(), vectors))
        table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
        got = neighbours(table, F.col("vec_id") % 50 == 0).collect()
        assert recall(got, brute(rows)) == 1.0


def test_repeated_ids_with_different_vectors(spark):
    """Each id asks with the least of its vectors and is found by its nearest;
    the rows don't depend on the partitioning."""
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(size=6).tolist()) for i in range(120)]
    near = np.array(rows[0][1])
    rows += [(7, (near + rng.normal(size=6) / 100).tolist()) for _ in range(30)]  # crowds the nearest of 0
    rows += [(0, rng.normal(size=6).tolist()), (50, rng.normal(size=6).tolist()), (50, rows[50][1])]
    of = {}
    for i, v in rows:
        of.setdefault(i, []).append(v)
    want = set()
    for q in (0, 50, 100):
        v = np.array(min(of[q], key=lambda x: np.array(x).tobytes()))
        best = sorted((-max(exact(v, np.array(w)) for w in ws), i) for i, ws in of.items() if i != q)[:5]
        want |= {(q, r + 1, i) for r, (_, i) in enumerate(best)}
    for parts in (1, 7):
        table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(parts)
        got = {(r["query_id"], r["rank"], r["vec_id"]) for r in neighbours(table, F.col("vec_id") % 50 == 0).collect()}
        assert got == want
