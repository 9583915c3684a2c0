import re

from casemine.llm.decontaminate import leaks


def grams(text):
    ws = [w for w in re.split(r"[\W_]+", (text or "").lower()) if w]
    return {" ".join(ws[i:i + 5]) for i in range(len(ws) - 4)} if len(ws) >= 5 else {" ".join(ws)} - {""}


def brute(docs, items):
    out = set()
    for i, t in items:
        q = grams(t)
        for d, body in docs:
            n = len(q & grams(body))
            if q and n >= 0.8 * len(q):
                out.add((d, i, len(q), n, round(n / len(q), 9), body or ""))
    return sorted(((a[:-1]) for a in out), key=str)


def got(df):
    return sorted(((r["doc_id"], r["item_id"], r["n_shingles"], r["n_shared"], round(r["containment"], 9))
                   for r in df.collect()), key=str)


def test_documents(spark, sf_dir):
    docs, items = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    found = got(leaks(docs, items))
    want = brute([(r["doc_id"], r["text"]) for r in docs.collect()], [(r["item_id"], r["text"]) for r in items.collect()])
    assert found == want and len(want) >= 3


def test_long_documents_and_small_items(spark, frame):
    filler = " ".join(f"w{i}" for i in range(30000))
    item = " ".join(f"q{i}" for i in range(16))
    most = " ".join(f"q{i}" for i in range(14)) + " gap"
    some = " ".join(f"q{i}" for i in range(11)) + " gap"
    rows = [(1, filler + " " + item + " " + filler), (2, "x " + most.upper() + " y"), (3, some), (4, filler), (5, item), (5, item),
            (None, item), (None, None), (6, ""), (7, "one two three"), (8, "zero one two three")]
    docs = frame(rows, ", h long, bits string, item_id long, ws string")
    for small in ([], [(2, "one two three"), (3, "alpha beta gamma delta epsilon zeta"), (4, None), (4, ""), (None, item), (1, item)]):
        items = [(1, item), *small]
        table = spark.createDataFrame([(*x, 0) for x in items], "item_id long, text string, hs int")
        assert got(leaks(docs, table)) == brute(rows, items)
    assert leaks(frame([]), table).count() == 0
    assert leaks(docs, spark.createDataFrame([], "item_id long, text string")).count() == 0
