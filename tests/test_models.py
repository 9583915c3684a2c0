"""Naive Bayes closed form against Spark ML; k-means and report invariants;
FP-growth single items against the frequent-items aggregate."""

import math

from pyspark.ml.classification import NaiveBayes
from pyspark.ml.feature import CountVectorizer
from pyspark.sql import functions as F

from casemine.operators import classify as NB
from casemine.operators import cluster as CL
from casemine.operators import mining as MN
from casemine.operators import terms as TR
from casemine.plans.model import CaseModel
from casemine.sources import tables as S


def test_naive_bayes_matches_spark_ml(spark, sf_dir):
    m = CaseModel(spark, sf_dir)
    labels = S.table(spark, sf_dir, "labels").select(F.col("doc_id").alias("case_id"),
                                                      F.col("quality").alias("label"))
    arrays = m.corpus.groupBy("case_id").agg(F.collect_list("token").alias("tokens"))
    cv = CountVectorizer(inputCol="tokens", outputCol="features", binary=True, vocabSize=1 << 20).fit(arrays)
    vocab = cv.vocabulary
    train = cv.transform(arrays).join(labels, "case_id").withColumn("label", F.col("label").cast("double"))
    ml = NaiveBayes(smoothing=1.0, modelType="multinomial").fit(train)
    classes, probs = NB.fit(m.corpus, labels, len(vocab))
    pri = {r["label"]: r["prior"] for r in classes.collect()}
    for i, lab in enumerate(ml.labels if hasattr(ml, "labels") else [0.0, 1.0]):
        assert math.isclose(ml.pi[i], pri[int(lab)], rel_tol=1e-9, abs_tol=1e-12)
    theta = ml.theta.toArray()
    got = {(r["label"], r["term"]): r["log_prob"] for r in probs.collect()}
    idx = {t: j for j, t in enumerate(vocab)}
    unseen = {r["label"]: r["log_unseen"] for r in classes.collect()}
    for lab in (0, 1):
        for t, j in list(idx.items())[:2000]:
            exp = theta[lab][j]
            assert math.isclose(got.get((lab, t), unseen[lab]), exp, rel_tol=1e-9, abs_tol=1e-12)
    pred = NB.predict_cases(m.corpus, classes, probs, [0, 1])
    mlp = {r["case_id"]: int(r["prediction"]) for r in ml.transform(train).collect()}
    ours = {r["case_id"]: r["prediction"] for r in pred.collect()}
    agree = sum(ours[c] == p for c, p in mlp.items())
    assert agree == len(mlp)


def test_kmeans_invariants_and_report(spark, sf_dir):
    m = CaseModel(spark, sf_dir, centres="kmeans")
    pts = m.points
    assigned = m.assigned.cache()
    n = pts.count()
    assert assigned.count() == n and assigned.select("case_id").distinct().count() == n
    k = m.kmeans_history[-1][0]
    assert k == 25
    assert assigned.where((F.col("cluster") < 0) | (F.col("cluster") >= k)).count() == 0
    cost = assigned.agg(F.sum("dist2")).first()[0]
    assert math.isclose(cost, m.kmeans_history[-1][1], rel_tol=1e-6)
    rep = CL.report(assigned, m.dims, m.guessed)
    sizes = rep.groupBy("cluster").count()
    assert sizes.where("count < 2").count() == 0
    assert len(rep.columns) == 12
    lines = CL.report_lines(rep).collect()
    assert all(len(r["line"].split("%")) >= 12 for r in lines)


def test_fp_growth_single_items_equal_frequent_items(spark, sf_dir):
    m = CaseModel(spark, sf_dir)
    sets, _ = MN.fp_growth(m.items)
    singles = {r["items"][0]: r["freq"] for r in sets.where(F.size("items") == 1).collect()}
    freq = {r["item"]: r["support"] for r in TR.frequent_items(m.items).collect()}
    assert singles == freq
    words = {w for r in sets.collect() for w in r["items"]}
    assert words == set(freq)


def test_lda_topics_cover_vocabulary(spark, sf_dir):
    m = CaseModel(spark, sf_dir, topics="lda", lda_iterations=3)
    topics = m.lda_topics
    v = m.term_df.count()
    assert topics.count() == 2 * v
    sums = {r["topic"]: r["s"] for r in topics.groupBy("topic").agg(F.sum("weight").alias("s")).collect()}
    assert all(math.isclose(s, 1.0, rel_tol=1e-6) for s in sums.values())
    assert m.hv_terms.count() > 0


def test_fp_growth_matches_brute_force(spark):
    from itertools import combinations
    rows = [["a", "b", "c"], ["a", "b"], ["a", "c"], ["b", "c", "d"], ["a", "b", "c", "d"], [], ["d"]]
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "case_id long, items array<string>")
    sets, _ = MN.fp_growth(df, 0.25)
    got = {tuple(sorted(r["items"])): r["freq"] for r in sets.collect()}
    need = math.ceil(0.25 * len(rows))
    items = sorted({x for r in rows for x in r})
    exp = {}
    for k in range(1, len(items) + 1):
        for c in combinations(items, k):
            n = sum(set(c) <= set(r) for r in rows)
            if n >= need:
                exp[c] = n
    assert got == exp


def test_expectation_step_is_the_next_iteration(spark, tmp_path):
    """One step over (case, term) rows from a model of n iterations gives the
    counts of the model of n + 1 iterations; no weight is lost on the way."""
    import random

    from pyspark.ml.linalg import Vectors
    rng = random.Random(4)
    size, rows = 12, []
    for i in range(40):
        words = sorted(rng.sample(range(size), 5))
        rows.append((Vectors.sparse(size, words, [float(rng.randint(1, 40)) for _ in words]),))
    docs = spark.createDataFrame(rows, ["features"]).repartition(2).checkpoint()
    got = []
    for n in (2, 3):
        MN.save_lda(docs, size, str(tmp_path / f"lda{n}"), iterations=n)
        got.append(MN.lda_counts(spark, str(tmp_path / f"lda{n}")))
    by_term, by_doc, entries, totals = got[0]
    step = {r["term_id"]: r["counts"] for r in MN.expectation_step(
        entries, by_term, by_doc, totals, size, *MN.lda_priors(size)).collect()}
    later = {r["term_id"]: r["counts"] for r in got[1][0].collect()}
    assert set(step) == set(later) == set(range(size))
    assert all(math.isclose(a, b, rel_tol=1e-9) for t in step for a, b in zip(step[t], later[t]))
    mass = {t: sum(v[0][t] for v in rows) for t in range(size)}
    assert all(math.isclose(sum(step[t]), mass[t], rel_tol=1e-9) for t in step)


def test_lda_mass_shows_altered_vectors(spark, sf_dir):
    m = CaseModel(spark, sf_dir, lda_iterations=2)
    term, weight = m.weights.orderBy("weight", "term").first()
    df = m.term_df.where(F.col("term") == term).first()["df"]
    mass = m.lda_mass.where(F.col("term") == term).first()
    assert math.isclose(mass["mass"], df * weight, rel_tol=1e-9) and math.isclose(mass["mass_after"], df * weight, rel_tol=1e-9)
    other = CaseModel(spark, sf_dir, lda_iterations=2)
    other.weights = m.weights.withColumn("weight", F.when(F.col("term") == term, F.col("weight") + 1).otherwise(F.col("weight")))
    mass = other.lda_mass.where(F.col("term") == term).first()
    assert math.isclose(mass["mass"], df * (weight + 1), rel_tol=1e-9)


def test_choose_k_goes_on_until_the_cost_is_low(spark):
    import random
    rng = random.Random(2)
    pts = spark.createDataFrame([(i, float(rng.randint(0, 400)), float(rng.randint(0, 400))) for i in range(300)],
                                "case_id long, x double, y double").checkpoint()
    _, _, history = CL.choose_k(pts, start=2, step=3, max_rounds=4)
    assert [k for k, _ in history] == [5]
    all_of = CL.choose_k(pts, max_cost=0.0, start=2, step=3, max_rounds=4)[2]
    assert [k for k, _ in all_of] == [5, 8, 11, 14]
    aim = all_of[1][1] + 1e-6
    model, _, some = CL.choose_k(pts, max_cost=aim, start=2, step=3, max_rounds=4)
    assert [k for k, _ in some] == [5, 8] and some[-1][1] < aim <= some[0][1] and len(model.clusterCenters()) == 8


def test_sweep_matches_plain_lloyd(spark):
    import random
    rng = random.Random(7)
    cases = [(float(rng.randint(0, 40)), float(rng.randint(0, 9) * 100)) for _ in range(400)] + [(7.0, 7.0)] * 200
    pts = spark.createDataFrame([(i, x, y) for i, (x, y) in enumerate(cases)], "case_id long, x double, y double")

    def near(p, centres):
        return min(((p[0] - a) * (p[0] - a) + (p[1] - b) * (p[1] - b), i) for i, (a, b) in enumerate(centres))

    count = {p: cases.count(p) for p in cases}
    centres, want = [p for p in sorted(count, key=lambda p: (-count[p], p))[:5]], []
    for r in range(3):
        if r:
            far = sorted((-near(p, centres)[0], p) for p in count)
            centres = centres + [p for d, p in far if d < 0][:2]
        for _ in range(6):
            mine = [near(p, centres)[1] for p in cases]
            moved = []
            for i, c in enumerate(centres):
                got = [p for p, m in zip(cases, mine) if m == i]
                moved.append(tuple(round(sum(v) / len(got), 6) for v in zip(*got)) if got else c)
            centres = moved
        want.append((5 + 2 * r, centres, sum(near(p, centres)[0] for p in cases)))
    found = CL.sweep_k(pts, 3, start=3, step=2, iterations=6)
    assert [(k, c) for k, c, _ in found] == [(k, c) for k, c, _ in want]
    assert all(math.isclose(a[2], b[2], rel_tol=1e-9) for a, b in zip(found, want))
    assert found[0][2] > found[1][2] > found[2][2]
    assert CL.first_below(found, found[0][2]) == 7 and CL.first_below(found, 0.0) == 9
    assert CL.sweep_k(pts.limit(0), 2)[1][1:] == ([], 0.0)


def test_fp_growth_is_given_frequent_items_only(spark, monkeypatch):
    """Rare items don't reach the estimator; empty transactions still count."""
    rows = [(i, ["a", "b", f"rare{i}"] if i % 2 else [f"rare{i}"]) for i in range(20)]
    df = spark.createDataFrame(rows, "case_id long, items array<string>")
    given = []
    real = MN.FPGrowth.fit
    monkeypatch.setattr(MN.FPGrowth, "fit", lambda self, d, *a: (given.append(d), real(self, d, *a))[1])
    sets, _ = MN.fp_growth(df, 0.5)
    assert {(" ".join(sorted(r["items"])), r["freq"]) for r in sets.collect()} == {("a", 10), ("b", 10), ("a b", 10)}
    assert sorted(len(r["items"]) for r in given[0].collect()) == [0] * 10 + [2] * 10
    assert MN.fp_growth(df, 0.9)[0].count() == 0


def test_fp_growth_is_given_items_of_frequent_pairs_only(spark, monkeypatch):
    """A frequent item that no other goes with often doesn't reach the estimator,
    and still is an itemset; the estimator has no more groups than tasks."""
    rows = [(i, ["a", "b"] * (i < 12) + ["c"] * (i % 2) + ["d"] * (i >= 10)) for i in range(20)] + [(20, None), (21, [])]
    df = spark.createDataFrame(rows, "case_id long, items array<string>").repartition(9)
    given = []
    real = MN.FPGrowth.fit
    monkeypatch.setattr(MN.FPGrowth, "fit", lambda self, d, *a: (given.append((self.getNumPartitions(), d)), real(self, d, *a))[1])
    sets, model = MN.fp_growth(df, 0.45)
    want = {("a", 12), ("b", 12), ("c", 10), ("d", 10), ("a b", 12)}
    assert {(" ".join(sorted(r["items"])), r["freq"]) for r in sets.collect()} == want and sets.count() == len(want)
    groups, frame = given[0]
    assert groups == spark.sparkContext.defaultParallelism
    assert sorted(sorted(r["items"]) for r in frame.collect()) == [[]] * 9 + [["a", "b"]] * 12
    assert model.associationRules.count() == 2  # a -> b, b -> a


def test_items_with_mates_adds_up_over_batches(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 2)
    try:
        df = spark.createDataFrame([(["x", "y"],)] * 5 + [(["x", "z"],)] * 4 + [(None,), (["w"],)], "items array<string>").repartition(3)
        assert MN.items_with_mates(df, "items", ["w", "x", "y", "z"], 5) == ["x", "y"]
        assert MN.items_with_mates(df, "items", ["w", "x", "y", "z"], 4) == ["x", "y", "z"]
        assert MN.items_with_mates(df, "items", ["w"], 1) == []
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_an_item_twice_in_a_transaction_is_an_error(spark):
    import pytest
    df = spark.createDataFrame([(["x", "x"],), (["x"],), (["y"],)], "items array<string>")
    with pytest.raises(Exception, match="unique"):
        MN.fp_growth(df, 0.5)[0].count()
