"""md5 arithmetic and template alignment against plain Python versions."""

import hashlib
import random

from pyspark.sql import functions as F

from casemine import config as C
from casemine.functions import hashing as H
from casemine.functions import template as TP


def test_md5_mod_matches_bigint(spark):
    words = ["", "a", "router", "src3", "2014-0202-B123", "éçà", "x" * 200]
    df = spark.createDataFrame([(w,) for w in words], "w string")
    rows = df.select("w", *[H.md5_mod("w", m).alias(f"m{m}") for m in (100, 1000, 10000, 97)]).collect()
    for r in rows:
        big = int(hashlib.md5(r["w"].encode()).hexdigest(), 16)
        for m in (100, 1000, 10000, 97):
            assert r[f"m{m}"] == big % m


def test_md5_unit(spark):
    df = spark.createDataFrame([("failed",)], "w string")
    assert abs(df.select(H.md5_unit("w")).first()[0] - TP.unit_hash("failed")) < 1e-15


def py_align(line, template):
    L, T = line, template
    if len(L) < len(T):
        return None
    starts = {}
    for t in T:
        idx = L.index(t) if t in L else -1
        if idx != -1:
            u = T.index(L[idx])
            i, j = idx, u
            while i < len(L) and j < len(T) and L[i] == T[j]:
                i += 1
                j += 1
            starts[idx] = i - idx
    if not starts:
        return None
    s = max(starts)
    run = starts[s]
    front = "<" + "-".join(L[:s]) + ">"
    tail = "<" + "-".join(L[s + run:]) + ">"
    words = [front] + L[s:s + run] + [tail]
    if len(words) == len(T):
        a = [TP.unit_hash(w) for w in words]
        b = [TP.unit_hash(w) for w in T]
        den = sum(x * x + y * y for x, y in zip(a, b)) ** 0.5
        score = round(sum(x * y for x, y in zip(a, b)) / den, 6)
    else:
        score = 0.0
    return s + 1, run, front, " ".join(L[s:s + run]), tail, score


def test_hand_worked_alignment(spark):
    df = spark.createDataFrame([("it then failed to boot now".split(" "),)], "L array<string>")
    r = df.select(F.explode(TP.line_template_scores(F.col("L"), ["<x> failed <y>"])).alias("a")) \
        .select("a.*").first()
    assert (r["start"], r["run"], r["front"], r["middle"], r["tail"]) == \
        (3, 1, "<it-then>", "failed", "<to-boot-now>")
    assert r["score"] > 0


def test_line_shorter_than_template(spark):
    df = spark.createDataFrame([(["failed", "now"],)], "L array<string>")
    r = df.select(F.explode(TP.line_template_scores(F.col("L"), ["<x> failed <y>"])).alias("a")) \
        .select("a.*").first()
    assert not r["aligned"] and r["score"] == 0.0 and r["front"] == ""


def test_alignment_matches_python_brute_force(spark):
    rnd = random.Random(5)
    vocab = ["is", "the", "down", "link", "fails", "to", "of", "a", "<x>", "with"]
    lines = [[rnd.choice(vocab) for _ in range(rnd.randint(1, 9))] for _ in range(300)]
    templates = C.PROBLEM_TEMPLATES[:6] + ["<x> is the <y>", "<a> of the <b> with <c>"]
    df = spark.createDataFrame([(i, l) for i, l in enumerate(lines)], "i int, L array<string>")
    got = df.select("i", F.explode(TP.line_template_scores(F.col("L"), templates)).alias("a")) \
        .select("i", "a.*").collect()
    for r in got:
        exp = py_align(lines[r["i"]], templates[r["template_id"]].split(" "))
        if exp is None:
            assert not r["aligned"]
        else:
            assert r["aligned"]
            assert (r["start"], r["run"], r["front"], r["middle"], r["tail"]) == exp[:5]
            assert abs(r["score"] - exp[5]) < 1e-6


def test_dot_norms_and_cosine(spark):
    df = spark.createDataFrame([([1.0, 2.0, 3.0], [4.0, 5.0, 6.0]), ([1.0], [1.0, 2.0])],
                               "x array<double>, y array<double>")
    r = df.select(TP.dot("x", "y").alias("d"), TP.sqrt_of_pow("x", "y").alias("s"),
                  TP.true_cosine("x", "y").alias("c")).collect()
    assert r[0]["d"] == 32.0 and abs(r[0]["s"] - (1 + 4 + 9 + 16 + 25 + 36) ** 0.5) < 1e-12
    assert abs(r[0]["c"] - 32 / (14 ** 0.5 * 77 ** 0.5)) < 1e-12
    assert r[1]["d"] == 0.0 and r[1]["s"] == 0.0


def py_longest(L, T):
    """(start, run) of the longest common run, by trying every pair of starts."""
    best = None
    for i in range(len(L)):
        for u in range(len(T)):
            k = 0
            while i + k < len(L) and u + k < len(T) and L[i + k] == T[u + k]:
                k += 1
            if k and (best is None or (k, -i, -u) > best):
                best = k, -i, -u
    return (1 - best[1], best[0]) if best and len(L) >= len(T) else None


def test_longest_run_matches_python_brute_force(spark):
    rnd = random.Random(8)
    vocab = ["is", "the", "down", "link", "of", "a", "<x>"]
    lines = [[rnd.choice(vocab) for _ in range(rnd.randint(1, 12))] for _ in range(300)] + [["zz"] * 9, []]
    templates = ["<x> is the <y>", "<a> of the <b> of the <c>", "link is down", "is", "the the the is"]
    df = spark.createDataFrame([(i, l) for i, l in enumerate(lines)], "i int, L array<string>")
    for only in (False, True):
        got = df.select("i", F.explode(TP.line_template_scores(F.col("L"), templates, only, "longest")).alias("a")) \
            .select("i", "a.*").collect()
        seen = {(r["i"], r["template_id"]): (r["start"], r["run"]) for r in got if r["aligned"]}
        want = {(i, k): py_longest(l, t.split(" ")) for i, l in enumerate(lines) for k, t in enumerate(templates)}
        assert seen == {k: v for k, v in want.items() if v}
        for r in got:
            if r["aligned"]:
                L = lines[r["i"]]
                assert r["front"] == "<" + "-".join(L[:r["start"] - 1]) + ">"
                assert r["tail"] == "<" + "-".join(L[r["start"] - 1 + r["run"]:]) + ">"


def test_longest_differs_from_rightmost(spark):
    # the rightmost template word stands alone, the longest run comes before it
    df = spark.createDataFrame([("the link is down now is it".split(" "),)], "L array<string>")
    row = df.select(*[F.explode(TP.line_template_scores(F.col("L"), ["link is down it"], pick=p)).alias(p)
                      for p in ("rightmost",)], "L").first()["rightmost"]
    longest = df.select(F.explode(TP.line_template_scores(F.col("L"), ["link is down it"], pick="longest")).alias("a")).first()["a"]
    assert (row["start"], row["run"], row["middle"]) == (7, 1, "it")
    assert (longest["start"], longest["run"], longest["middle"]) == (2, 3, "link is down")


def test_scores_only_of_what_can_have_one(spark):
    """Lines without a template word, and runs that leave the line longer or
    shorter than its template, score 0 without vectors; the others as before."""
    from casemine import config as C
    from casemine.functions import template as TP
    from casemine.functions import text as T
    lines = ["", "nada de eso", "it is the fault", "a b is down now", "the core file generated on node", "is", "is down",
             "link is down since monday", "it then failed to boot now", "of the", "x of the y", " the  end"]
    df = spark.createDataFrame([(t,) for t in lines], "line string").select(T.line_words(F.col("line")).alias("w"))
    for pick in ("rightmost", "longest"):
        for templates in (C.PROBLEM_TEMPLATES, ["<x> is the <y>", "of", "a b is down now"]):
            plain = TP.line_template_scores(F.col("w"), templates, pick=pick, cosine=True)
            short = TP.line_template_scores(F.col("w"), templates, aligned_only=True, pick=pick, cosine=True)
            for r in df.select("w", plain.alias("a"), short.alias("s"), TP.line_score(F.col("w"), templates, pick).alias("best")).collect():
                assert [x for x in r["a"] if x["aligned"]] == r["s"]
                assert r["best"] == max([x["score"] for x in r["a"]], default=0.0)
                for x in r["a"]:
                    vector = [x["front"], *x["middle"].split(" "), x["tail"]] if x["run"] else [x["front"], x["tail"]]
                    units, mine = ([TP.unit_hash(w) for w in v] for v in (templates[x["template_id"]].split(" "), vector))
                    want = 0.0
                    if x["aligned"] and len(units) == len(mine):
                        want = sum(a * b for a, b in zip(mine, units)) / sum(a * a + b * b for a, b in zip(mine, units)) ** 0.5
                    assert abs(x["score"] - want) < 2e-6
    plan = df.select(TP.line_score(F.col("w"), C.PROBLEM_TEMPLATES).alias("s"))._jdf.queryExecution().optimizedPlan().toString()
    assert "arrays_overlap" in plan


def test_affixes_are_stripped_as_by_patterns(spark):
    from casemine.functions import text as T
    words = ["", ".", "a.", "..a:.", "-a-", "a", ".:,~-", "-~,:.", "a:.", "~a", ",a,b,", ":.", "a.\n", ".a\n"]
    df = spark.createDataFrame([(w,) for w in [*words, None]], "w string")
    by_pattern = F.regexp_replace(F.regexp_replace("w", T._SUFFIX_RE, ""), T._PREFIX_RE, "")
    assert all(r[0] == r[1] for r in df.select(T.strip_affixes(F.col("w")), by_pattern).collect())
