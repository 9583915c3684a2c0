import re
from itertools import permutations

import pytest
from pyspark.sql import functions as F

from casemine.llm import filter_audit as fa
from casemine.llm.queries import QUERIES


def failures(rows):
    """Per (doc_id, text, lang, source): the letters of the filters it fails."""
    out = []
    for r in rows:
        t = r[1] or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        f = {"A": len(words) < 50, "B": 100 * len(set(words)) < 65 * len(words),
             "C": 100 * len(re.findall("[A-Z]", t)) > 5 * len(t), "D": bool(re.search(r"[#$%&*|]", t)),
             "E": r[0] is not None and any(o[0] is not None and o[0] < r[0] and (o[1] or "") == t for o in rows)}
        out.append({k for k, v in f.items() if v})
    return out


def plain(rows, labels, letters="ABCDE"):
    """Every order run over every part, row by row."""
    good = {i for i, q, _ in labels if q == 1} - {None}
    toxic = {i for i, _, x in labels if x == 1} - {None}
    by_part = {}
    for r, f in zip(rows, failures(rows)):
        by_part.setdefault(r[3] or "", []).append((r[0], f & set(letters)))
    out = {}
    for part, docs in by_part.items():
        total = dict.fromkeys(letters, 0)
        for order in permutations(letters):
            left = docs
            for k, f in enumerate(order):
                gone = [d for d in left if f in d[1]]
                redundant = sum(f in d[1] for d in docs) - len(gone)
                left = [d for d in left if f not in d[1]]
                total[f] += len(gone)
                out[part, "".join(order), k + 1] = [
                    len(left), len(gone), redundant, sum(d[1] == {f} for d in docs), sum(d[0] in good for d in gone),
                    sum(d[0] in toxic for d in gone)]
        for (p, order, k), row in out.items():
            if p == part:
                row.append(total[order[k - 1]])
    return out


def check(got, want):
    got = got.collect()
    assert len(got) == len(want)
    assert {(r[0], r[1], r[2]): list(r[3:]) for r in got} == want


LONG = " ".join(f"w{i}" for i in range(60))
ROWS = [(1, LONG, None, "a"), (2, LONG, None, "a"), (2, LONG, None, "b"), (3, None, None, "a"), (4, "", None, None),
        (None, "", None, None), (None, None, None, None), (5, "AB|", None, "b"), (6, LONG + " É\x0b\x1cA" * 40, None, ""),
        (7, "x " * 80, None, "b"), (8, "A" * 9 + " " + LONG + " #", None, "c"), (9, "x\x0cx\ry  z " * 700000, None, "c"),
        (10, "x\x0cx\ry  z " * 700000, None, "a"), (3, None, None, "a"), (-1, " \t\n", None, "a")]
LABELS = [(1, 1, 0), (2, 0, 1), (2, 1, 0), (8, 1, 1), (10, None, 1), (None, 1, 1), (7, 1, None), (99, 1, 1)]


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int")


def test_odd_rows(frame, labels):
    extra = ", part string, id string, digest string, copy string, good string, failed string, n string"
    check(fa.audit_texts(frame(ROWS, extra), labels, F.col("source")), plain(ROWS, LABELS))


def test_some_filters_and_hot_text(spark, frame, labels, monkeypatch):
    monkeypatch.setattr(fa, "join_small", lambda big, small, key, how: __import__(
        "casemine.operators.skew", fromlist=["x"]).salted_join(big, small, key, how))
    rows = ROWS[:8] + [(100 + i, "same text", None, "ab"[i % 2]) for i in range(300)]
    check(fa.audit_texts(frame(rows), labels, F.col("source"), names="ADE"), plain(rows, LABELS, "ADE"))


def test_empty(frame, labels):
    assert fa.audit_texts(frame([]), labels, F.col("source")).count() == 0
    got = fa.audit_texts(frame([(1, "x", None, None)]), labels.limit(0), F.col("source"))
    assert got.count() == 600 and {r["part"] for r in got.collect()} == {""}


def test_path_counts():
    forward, backward = fa.paths(5)
    assert forward[0b10110] == 6 and backward[0b10110] == 2 and forward[-1] == backward[0] == 120
    with pytest.raises(ValueError):
        fa.audit(None, {c: None for c in "ABCDEFG"})


def test_whole_table(spark, sf_dir):
    rows = [(r["doc_id"], r["text"], r["lang"], r["source"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    labels = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality", "toxic").collect()]
    check(QUERIES["op12_filter_audit"](spark, sf_dir), plain(rows, labels))
