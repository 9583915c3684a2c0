"""Source and sink helpers."""

import os
import tempfile

from casemine.operators import tokens as TK
from casemine.sources import jdbc
from casemine.sources.dictionary import read_templates, read_word_list
from casemine.sources.sinks import write_text_lines


def test_jdbc_options_partitioned():
    o = jdbc.jdbc_read_options("jdbc:derby:x", "select * from t", partition_column="id",
                               lower_bound=0, upper_bound=100, num_partitions=4)
    assert o["dbtable"] == "(select * from t) t1" and o["numPartitions"] == "4"
    assert "query" not in o
    o2 = jdbc.jdbc_read_options("jdbc:derby:x", "select 1", user="u", password="p")
    assert o2["query"] == "select 1" and o2["user"] == "u"


def test_word_list_anti_join(spark):
    d = tempfile.mkdtemp(prefix="cm-dict-")
    p = os.path.join(d, "stop.txt")
    with open(p, "w") as f:
        f.write("Router\n\n  bgp \nrouter\n")
    words = read_word_list(spark, p)
    assert sorted(r["word"] for r in words.collect()) == ["bgp", "router"]
    toks = spark.createDataFrame([(1, "router"), (1, "ospf"), (2, "bgp")], "case_id long, token string")
    assert [tuple(r) for r in TK.drop_words(toks, words).collect()] == [(1, "ospf")]
    tp = os.path.join(d, "t.txt")
    with open(tp, "w") as f:
        f.write("<x> fails <y>\n<a> down <b>\n")
    assert read_templates(spark, tp) == ["<x> fails <y>", "<a> down <b>"]


def test_text_sink(spark):
    d = tempfile.mkdtemp(prefix="cm-text-")
    lines = spark.createDataFrame([("1%2.0%x",)], "line string")
    write_text_lines(lines, os.path.join(d, "out"))
    assert [r["value"] for r in spark.read.text(os.path.join(d, "out")).collect()] == ["1%2.0%x"]


def test_date_prefix_filter_equals_string_prefix(spark):
    from pyspark.sql import functions as F
    from casemine.operators.extract import date_prefix_filter
    df = spark.createDataFrame([(f"{y}-0{m}-1{d} 0{h}:00:00",) for y in (1000, 1989, 1990, 1995, 1999, 2000, 2001, 9000, 9900, 9990, 9999)
                                for m in (1, 9) for d in (0, 9) for h in (0, 5)], "s string") \
        .select(F.col("s").cast("timestamp_ntz").alias("t"))
    for prefix in ("199", "1995", "19", "1", "2", "2000", "1999-0", "9", "99", "999", "9999"):
        exp = sorted(r[0] for r in df.where(F.col("t").cast("string").startswith(prefix)).collect())
        got = sorted(r[0] for r in df.where(date_prefix_filter(df, "t", prefix)).collect())
        assert got == exp, prefix


def parts_of(df, predicates):
    """Rows per predicate, as a database would give them; every row once."""
    got = [df.where(p).count() for p in predicates]
    assert sum(got) == df.count()
    from pyspark.sql import functions as F
    hits = sum((F.when(F.expr(p), 1).otherwise(0) for p in predicates), F.lit(0))
    assert df.select(hits.alias("h")).distinct().collect() == [(1,)]
    return got


def test_balanced_predicates_on_skewed_keys(spark, tmp_path):
    from pyspark.sql import functions as F
    path = str(tmp_path / "keys")
    # most keys lie close together at the start of a wide range, some have none
    spark.range(4000).select(F.when(F.col("id") % 50 == 7, None).otherwise(
        F.pow(F.col("id") / 4000, F.lit(8)) * 1e9).cast("long").alias("k"), "id").write.parquet(path)
    keys = spark.read.parquet(path)
    got = parts_of(keys, jdbc.balanced_predicates(keys, "k", 8))
    assert len(got) == 8 and max(got) < 1.5 * 4000 / 8
    even = keys.agg(F.min("k"), F.max("k")).first()  # equal ranges, for comparison
    width = (even[1] - even[0]) / 8
    assert keys.where(F.col("k") < even[0] + width).count() > 4 * max(got)


def test_balanced_predicates_with_a_heavy_value(spark):
    from pyspark.sql import functions as F
    df = spark.range(6000).select(F.when(F.col("id") % 3 != 0, F.lit(5)).otherwise(F.col("id")).alias("k"), "id")
    got = parts_of(df, jdbc.balanced_predicates(df, "k", 10, tie="id"))
    assert max(got) <= 1.5 * 600 and len(got) >= 9
    assert max(parts_of(df, jdbc.balanced_predicates(df, "k", 10))) >= 4000  # without a tie column
    assert parts_of(df.limit(0).union(df.limit(3)), jdbc.balanced_predicates(df.limit(0), "k", 4, tie="id")) == [3]
    words = spark.createDataFrame([(1, 2)], "k long, id long")
    assert len(jdbc.balanced_predicates(words, "k", 1)) == 1
