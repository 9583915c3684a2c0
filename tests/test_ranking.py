"""Exact distributed row numbers equal a window row_number, also with a hot group."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from casemine.operators.ranking import row_number_within


def fixture(spark):
    # group "hot" holds a third of the rows; scores repeat so ties are broken by term
    rows = [("hot" if i % 3 == 0 else f"g{i % 7}", f"t{i:05d}", float(i % 11)) for i in range(3000)]
    return spark.createDataFrame(rows, "grp string, term string, score double")


def test_grouped_rank_matches_window(spark):
    df = fixture(spark)
    order = [F.col("score").desc(), F.col("term").asc()]
    got = row_number_within(df, ["grp"], order, num_partitions=13)
    exp = df.withColumn("rn", F.row_number().over(Window.partitionBy("grp").orderBy(*order)))
    assert sorted(map(tuple, got.select("grp", "term", "rn").collect())) == \
        sorted(map(tuple, exp.select("grp", "term", "rn").collect()))


def test_global_rank_matches_window(spark):
    df = fixture(spark)
    order = [F.col("score").desc(), F.col("term").asc()]
    got = row_number_within(df, [], order, num_partitions=7)
    exp = df.withColumn("rn", F.row_number().over(Window.orderBy(*order)))
    assert sorted(map(tuple, got.select("term", "rn").collect())) == \
        sorted(map(tuple, exp.select("term", "rn").collect()))


def test_group_sizes(spark):
    df = fixture(spark)
    got = row_number_within(df, ["grp"], [F.col("term").asc()], num_partitions=5, size_name="n")
    sizes = {r["grp"]: r["count"] for r in df.groupBy("grp").count().collect()}
    assert all(r["n"] == sizes[r["grp"]] for r in got.select("grp", "n").collect())
    g = row_number_within(df, [], [F.col("term").asc()], num_partitions=5, size_name="n")
    assert {r["n"] for r in g.select("n").collect()} == {3000}
