import random

from casemine.llm import toxicity
from casemine.llm.queries import QUERIES
from casemine.llm.toxicity import Model, fit, score, windows


def test_windows_cover_the_text():
    for t in ("", "a", "ab " * 100, "x" * 1000, "é" * 300 + " b"):
        assert b"".join(windows(t)) == t.encode()
        assert all(len(w) <= 128 for w in windows(t))


def test_held_out_quality(spark):
    sf = "/root/testdata/sf0.1"
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    got = QUERIES["op2_toxicity"](spark, sf).collect()
    assert len(got) == 10000
    held = [(labels[r["doc_id"]], r["predicted"]) for r in got if r["held_out"] and r["doc_id"] in labels]
    hit = sum(p for y, p in held if y) / sum(y for y, _ in held)
    wrong = sum(p for y, p in held if not y) / sum(1 for y, _ in held if not y)
    assert hit > 0.6 and wrong < 0.06  # about 200 toxic texts to learn from
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in got)


def test_edges(spark, frame):
    docs = frame([(1, None), (None, "idiot"), (2, ""), (2, ""), (3, "word " * 50000)], ", score string, toxic int")
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    model = fit(docs, labels)
    assert [r["score"] for r in score(docs, model).collect()] == [0.0] * 5
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)] + [(None, 1), (3, None), (5, 1)], "doc_id long, toxic int")
    train = frame([(i, ("you idiot " if i % 2 else "good day ") * 20 + str(i)) for i in range(40)])
    model = fit(train, labels)
    got = {r["doc_id"]: r["score"] for r in score(train, model).collect()}
    assert min(got[i] for i in range(1, 40, 2)) > max(got[i] for i in range(0, 40, 2))
    assert score(docs, model).count() == 5 and score(frame([]), model).count() == 0
    assert isinstance(fit(frame([]), labels), Model)


def test_all_windows_train_the_ordinary_dictionary(spark, monkeypatch):
    rng = random.Random(9)
    prose = lambda n: " ".join("".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(n))
    docs = spark.createDataFrame([(i, prose(2000)) for i in range(420)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i < 6)) for i in range(420)], "doc_id long, toxic int")
    seen = []
    monkeypatch.setattr(toxicity, "train_dictionary", lambda samples, *a, **b: seen.append(len(samples)) or b"abcdefgh")
    toxicity.fit(docs, labels)
    assert seen[0] > 50_000
