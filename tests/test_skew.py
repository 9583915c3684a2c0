"""A term held by a third of all rows: it is detected as hot and its rows are
spread over several join tasks (salting); results equal the plain join."""

from casemine.operators import broadcast as BC
from casemine.operators import classify as NB
from casemine.operators import skew as SK


def fixture(spark, n=30000):
    rows = [(i, "hot" if i % 3 == 0 else f"t{i % 997}") for i in range(n)]
    return spark.createDataFrame(rows, "case_id long, token string")


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_hot_key_detection(spark):
    assert SK.hot_keys(fixture(spark), "token", partitions=8) == {"hot": 3}
    assert SK.hot_keys(fixture(spark), "token", partitions=200) == {"hot": 67}  # its share of 200 tasks


def test_salted_join_equals_plain_join(spark):
    big = fixture(spark)
    small = spark.createDataFrame([("hot", 1.0), ("t1", 2.0), ("zz", 3.0)], "token string, v double")
    for how in ("inner", "left", "left_semi", "left_anti"):
        salted = SK.salted_join(big, small, "token", how, hot={"hot": 8})
        assert "_salt" in salted._jdf.queryExecution().optimizedPlan().toString()
        assert rows(salted) == rows(big.join(small, "token", how)), how


def test_big_side_of_keys_only(spark):
    big = fixture(spark, 3000).select("token")
    small = spark.createDataFrame([("hot", 1.0), ("t1", 2.0), ("zz", 3.0)], "token string, v double")
    for how in ("inner", "left", "left_semi", "left_anti"):
        assert rows(SK.salted_join(big, small, "token", how, hot={"hot": 7})) == rows(big.join(small, "token", how)), how


def test_hot_rows_spread_over_tasks(spark):
    from pyspark.sql import functions as F
    confs = {"spark.sql.autoBroadcastJoinThreshold": "-1",
             "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k) for k in confs}
    for k, v in confs.items():
        spark.conf.set(k, v)
    try:
        big = fixture(spark)
        small = spark.createDataFrame([("hot", 1.0), ("t1", 2.0)], "token string, v double")

        def biggest_task(df):
            return max(r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect())
        plain = biggest_task(big.join(small, "token"))
        salted = biggest_task(SK.salted_join(big, small, "token", "inner", hot={"hot": 8}))
        assert plain >= 10000 and salted <= plain / 2
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_size_check_in_one_aggregation(spark):
    small = fixture(spark, 100)
    assert BC.is_small(small, 100) and not BC.is_small(small, 99) and not BC.is_small(small, 100, max_bytes=1000)
    wide = spark.createDataFrame([(1, ["x" * 1000] * 50)], "id long, words array<string>")
    assert not BC.is_small(wide, 10, max_bytes=40_000) and BC.is_small(wide, 10, max_bytes=60_000)


def test_naive_bayes_shuffle_path_with_hot_term(spark, monkeypatch):
    tokens = fixture(spark)
    labels = spark.createDataFrame([(i, i % 2) for i in range(0, 30000, 7)], "case_id long, label int")
    classes, probs = NB.fit(tokens, labels, vocab_size=998)
    broadcast = rows(NB.predict_cases(tokens, classes, probs, [0, 1]))
    monkeypatch.setattr(BC, "is_small", lambda *a, **k: False)
    assert rows(NB.predict_cases(tokens, classes, probs, [0, 1])) == broadcast


def test_hot_keys_of_known_counts(spark):
    from pyspark.sql import functions as F
    big = fixture(spark)
    counts = big.groupBy("token").agg(F.count(F.lit(1)).alias("df"))
    for p in (8, 200):
        assert SK.hot_of_counts(counts, "token", "df", partitions=p) == SK.hot_keys(big, "token", partitions=p)


def test_key_only_joins_sort_nothing(spark):
    big = fixture(spark)
    small = spark.createDataFrame([("hot", 1.0), ("t1", 2.0), ("t1", 3.0)], "token string, v double")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for how in ("left_semi", "left_anti"):
            for hot in ({}, {"hot": 8}):
                found = SK.salted_join(big, small, "token", how, hot=hot)
                plan = found._jdf.queryExecution().executedPlan().toString()
                assert "ShuffledHashJoin" in plan and "SortMergeJoin" not in plan
                assert rows(found) == rows(big.join(small, "token", how))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_frequent_keys_are_not_shuffled(spark, monkeypatch):
    """Beyond the bounds the small side's frequent keys are broadcast all the same."""
    big = fixture(spark, 3000).union(spark.createDataFrame([(-1, None)], "case_id long, token string"))
    small = spark.createDataFrame([("hot",), ("t1",), ("t2",), ("zz",), (None,)], "token string")
    frequent = spark.createDataFrame([("hot",), ("t1",)], "token string")
    plain = rows(big.join(small, "token", "left_semi").select("token", "case_id"))
    dealt = []
    monkeypatch.setattr(SK, "salted_join", lambda b, *a, f=SK.salted_join, **k: dealt.append(b) or f(b, *a, **k))
    got = BC.join_small(big, small, "token", "left_semi", 3, frequent)
    assert rows(got.select("token", "case_id")) == plain
    assert len(dealt) == 1 and {"hot", "t1", None}.isdisjoint(r["token"] for r in dealt[0].select("token").collect())
    assert rows(BC.join_small(big, small, "token", "left_semi", 1, frequent).select("token", "case_id")) == plain  # too many of them


def test_naive_bayes_far_terms(spark, monkeypatch):
    """The most frequent terms are summed up where the case lies, the others
    shuffled; the bound on the first kind doesn't show in the result."""
    tokens = fixture(spark, 6000).union(spark.createDataFrame([(5, "nobody trained"), (7, "t9")], "case_id long, token string"))
    labels = spark.createDataFrame([(i, i % 2) for i in range(0, 3000, 7)], "case_id long, label int")
    classes, probs = NB.fit(tokens, labels, vocab_size=999)
    whole = rows(NB.predict_cases(tokens, classes, probs, [0, 1]))
    known = tokens.groupBy("token").count().withColumnsRenamed({"token": "term", "count": "df"})
    for bound in (0, 1, 500):
        monkeypatch.setattr(NB, "NEAR_TERMS", bound)
        assert rows(NB.predict_cases(tokens, classes, probs, [0, 1])) == whole
        assert rows(NB.predict_cases(tokens, classes, probs, [0, 1], term_counts=known)) == whole


def test_frequent_terms_keep_the_bounds(spark):
    counts = spark.createDataFrame([("a", 9), ("b", 9), ("cc", 5), ("d", 1), ("e", 1)], "token string, df long")

    def of(*bounds):
        chosen, whole = NB.frequent_terms(counts, "df", *bounds)
        return sorted(r["token"] for r in chosen.collect()), whole
    assert of(5) == (["a", "b", "cc", "d", "e"], True) and of(4) == (["a", "b", "cc"], False)
    assert of(1) == ([], False) and of(5, 3) == (["a", "b"], False)
    assert NB.frequent_terms(counts.where("df > 9"), "df", 5)[1]


def test_class_counts_are_made_once(spark):
    """Both tables of the model come from one pass over the tokens."""
    tokens = fixture(spark, 300)
    labels = spark.createDataFrame([(i, i % 2) for i in range(300)], "case_id long, label int")
    for table in NB.fit(tokens, labels, vocab_size=998):
        assert "token" not in table._jdf.queryExecution().optimizedPlan().toString()
