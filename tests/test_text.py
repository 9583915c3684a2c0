"""Hand-worked cases for the text column functions."""

from pyspark.sql import functions as F

from casemine import config as C
from casemine.functions import text as T


def one(spark, expr, value, typ="string"):
    df = spark.createDataFrame([(value,)], f"v {typ}")
    return df.select(expr(F.col("v")).alias("r")).first()["r"]


def test_strip_one_affix_each(spark):
    assert one(spark, T.strip_affixes, "..a:.") == ".a"
    assert one(spark, T.strip_affixes, "a--") == "a-"
    assert one(spark, T.strip_affixes, "x.:") == "x."
    assert one(spark, T.strip_affixes, ".:,~-core-~,:.") == "core"
    assert one(spark, T.strip_affixes, "-~,:.core.:,~-") == "~,:.core.:,~"
    assert one(spark, T.strip_affixes, ".") == ""


def test_token_rules(spark):
    rows = [("2014-0202-1234", False), ("joe@example.com", False), ("555-123-4567", False),
            ("1234567890", False), ("12/25/2014", False), ("10:30:15", False), ("9:45", False),
            ("10:30:15.123", False), ("...", False), (">>>>", False), ("<tag>", False),
            ("restarted", False), ("quickly", False), ("routing", False), ("http://x", False),
            ("ftpserver", False), ("x", False), ("the", False), ("router", True), ("bgp", True),
            ("ospf", True), ("2014", True)]
    df = spark.createDataFrame([(w,) for w, _ in rows], "w string")
    dicts = [["the"]]
    got = dict(df.select("w", T.token_is_kept(F.col("w"), dicts).alias("k")).collect())
    assert got == dict(rows)


def test_clean_token_array_dedupes_and_filters(spark):
    df = spark.createDataFrame([("Router, router. The BGP session; http://a.b\ncase 2014-0202-1234",)],
                               "history string")
    got = df.select(T.clean_token_array("history", [["the", "case"]]).alias("t")).first()["t"]
    assert got == ["router", "bgp", "session"]


def test_history_lines_drop_trailing_empty(spark):
    assert one(spark, T.history_lines, "A\tb\nc\n\n") == ["a b", "c"]
    assert one(spark, T.history_lines, "\n\n") == []
    assert one(spark, T.history_lines, "") == [""]
    assert one(spark, T.history_lines, None) == ["no history"]


def test_slices(spark):
    eight = "\n".join(f"l{i}" for i in range(1, 9))
    assert one(spark, lambda c: T.leading_slice(T.history_lines(c)), eight) == ["l1", "l2"]
    assert one(spark, lambda c: T.trailing_slice(T.history_lines(c)), eight) == ["l7", "l8"]
    assert one(spark, lambda c: T.leading_slice(T.history_lines(c)), "a\nb\nc") == []


def test_pack_null_as_empty_and_unpack(spark):
    df = spark.createDataFrame([(None, "x")], "a string, b string")
    r = df.select(T.pack("a", "b").alias("p")).first()["p"]
    assert r == "--x"
    df2 = spark.createDataFrame([("series--",), ("nohw",)], "c string")
    got = [r["u"] for r in df2.select(T.unpack("c", 2).alias("u")).collect()]
    assert got == ["", None]


def test_platform(spark):
    assert one(spark, T.normalise_platform, "Please Specify") == "unknown"
    assert one(spark, T.normalise_platform, "R15.1") == "r15.1"


def test_line_words_trailing_spaces(spark):
    assert one(spark, T.line_words, "a  b  ") == ["a", "", "b"]


def test_only_tokens_that_may_match_meet_the_patterns(spark):
    samples = ["1234-5678-9012", "a@c.d", "a@b", "123-456-7890", "1234567890", "1-2-2020", "12/31.99", "12:30:45", "1:02",
               "12:30:45.123", "...", ">>>>", "---", "<a\nb>", "used", "only", "going", "ed", "_ly", "x1ing", "ing"]
    others = ["red!", "edx", "router", "été", "日本", "a-b", "x1:02", "r2d2", "née", "lying-on", "müssing", "@", "-", ""]
    rows = spark.createDataFrame([(w,) for w in samples + others], "w string")
    flags = rows.select("w", T.may_match(F.col("w")).alias("may"), F.col("w").rlike(T.any_pattern()).alias("does")).collect()
    assert all(r["may"] for r in flags if r["does"])
    assert {r["w"] for r in flags if r["does"]} >= set(samples)
    assert not {r["w"] for r in flags if r["may"]} & {"edx", "router", "été", "日本", "a-b", "r2d2", "née"}


def test_deleted_characters_and_lines_as_before(spark):
    texts = [None, "", "\n\n", "A\tb\n\n", "x,;)(}{+#*][|!`=\"?y", "\\^-&&z\n", "é😀,ü\n \n", "\n a"]
    rows = spark.createDataFrame([(t,) for t in texts], "h string")
    got = rows.select(T.delete_chars("h").alias("a"), F.translate("h", C.DELETED_CHARS, "").alias("b"),
                      T.history_lines("h").alias("lines"), "h").collect()
    assert all(r["a"] == r["b"] for r in got)
    for r in got:
        low = "no history" if r["h"] is None else r["h"].lower().replace("\t", " ")
        cut = low.rstrip("\n")
        assert r["lines"] == ([] if not cut and low else cut.split("\n"))
