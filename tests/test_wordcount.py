"""Map, reduce and whole word-count job: input "cat cat dog"."""

from casemine.operators import wordcount as WC


def test_mapper(spark):
    lines = spark.createDataFrame([(1, "cat cat dog")], "key long, value string")
    got = [tuple(r) for r in WC.map_words(lines).collect()]
    assert got == [("cat", 1), ("cat", 1), ("dog", 1)]


def test_reducer(spark):
    pairs = spark.createDataFrame([("cat", 1), ("cat", 1)], "word string, one int")
    assert [tuple(r) for r in WC.reduce_counts(pairs).collect()] == [("cat", 2.0)]


def test_map_reduce(spark):
    lines = spark.createDataFrame([(1, "cat cat dog")], "key long, value string")
    got = sorted(tuple(r) for r in WC.word_count(lines).collect())
    assert got == [("cat", 2.0), ("dog", 1.0)]
