import math

from pyspark.sql import functions as F

from casemine.llm.quality import STRONGEST, Model, classify, fit, train
from casemine.llm.queries import QUERIES


def brute(rows, model, evidence):
    """Shrunken site means, spelled out."""
    prior = min(max(model.good, 1e-3), 1 - 1e-3)
    vote = [1 / (1 + math.exp(-(e + math.log(prior / (1 - prior))))) for e in evidence]
    sites = {}
    for (_, _, host, path), v in zip(rows, vote):
        for key in ((host,), (host, path)):
            k, n = sites.get(key, (0.0, 0))
            sites[key] = (k + v, n + 1)
    mean = min(max(sum(vote) / len(vote), 1e-3), 1 - 1e-3)

    def strength(keys, parent):
        n = sum(sites[k][1] for k in keys)
        spread = sum(sites[k][1] * (sites[k][0] / sites[k][1] - parent(k)) ** 2 - parent(k) * (1 - parent(k)) for k in keys) / n
        between = max(0.0, spread)
        return STRONGEST if between <= mean * (1 - mean) / STRONGEST else max(1.0, mean * (1 - mean) / between - 1)

    a = strength([k for k in sites if len(k) == 1], lambda k: mean)
    host_mean = {k: (s[0] + mean * a) / (s[1] + a) for k, s in sites.items() if len(k) == 1}
    b = strength([k for k in sites if len(k) == 2], lambda k: host_mean[k[:1]])
    out = []
    for (i, _, host, path), v, e in zip(rows, vote, evidence):
        h = (sites[host,][0] - v + mean * a) / (sites[host,][1] - 1 + a)
        p = (sites[host, path][0] - v + h * b) / (sites[host, path][1] - 1 + b)
        out.append((str(i), round(1 / (1 + math.exp(-(e + math.log(p / (1 - p))))), 6)))
    return sorted(out)


def test_site_means(spark, frame):
    good, bad = "A calm line of prose that reads well and ends with a stop.", "BUY!! NOW!! $$$ ### WIN!! WIN!! $$$ ***"
    rows = [(i, good if i % (2 + i % 5) else bad, f"h{i % 5}", f"p{i % 3}") for i in range(90)]
    rows += [(None, None, None, None), (7, "", "h1", None), (7, good, "h1", "p1"), (7, good, "h1", "p1"), (500, "long " * 50000, "only", "one")]
    model = train([(good + str(i), 1) for i in range(20)] + [(bad + str(i), 0) for i in range(20)], 0.7)
    docs = frame([(i, t, p, h) for i, t, h, p in rows], ", score int, k string, host int, path int, vote int")
    got = classify(docs, model, F.col("source"), F.col("lang")).collect()
    by = {}
    for r in got:
        by.setdefault((r["doc_id"], r["text_hash"]), r["evidence"])
    from casemine.llm.quality import measures
    import numpy as np
    evidence = [float(np.clip(np.dot(measures(t), model.weights), -12, 12)) for _, t, _, _ in rows]
    assert sorted((str(r["doc_id"]), round(r["score"], 6)) for r in got) == brute(rows, model, evidence)


def test_documents(spark):
    sf = "/root/testdata/sf0.01"
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    got = QUERIES["op3_quality"](spark, sf).collect()
    assert len(got) == 1000
    kept = {r["doc_id"]: r["keep"] for r in got}
    good = [kept[i] for i, y in labels.items() if y and i in kept]
    bad = [kept[i] for i, y in labels.items() if not y and i in kept]
    assert sum(good) / len(good) > 0.98 and sum(bad) / len(bad) < 0.5


def test_edges(spark, frame):
    docs = frame([(1, "text", None, None), (2, None, "en", "s")])
    labels = spark.createDataFrame([], "doc_id long, quality int")
    model = fit(docs, labels)
    assert model == Model((), 0.0)
    assert all(r["keep"] for r in classify(docs, model, F.col("source"), F.col("lang")).collect())
    assert classify(frame([]), model, F.col("source"), F.col("lang")).count() == 0
