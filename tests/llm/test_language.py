import random

from casemine.llm import language
from casemine.llm.language import Model, fit, logits, plain, predict
from casemine.llm.queries import QUERIES


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    docs = {r["doc_id"]: r for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = QUERIES["op7_language"](spark, sf).collect()
    assert len(got) == len(docs)
    held = [(docs[r["doc_id"]], r) for r in got if r["held_out"]]
    right = sum(d["lang"] == r["lang_pred"] for d, r in held)
    assert right / len(held) > 0.97, (right, len(held))
    assert all(0 <= r["score"] <= 1 for r in got)


def test_edges(spark, frame):
    train = frame([(i, ("the house and the dog " if i % 2 else "das haus und der hund ") * 10 + str(i),
                    "en" if i % 2 else "de") for i in range(60)])
    model = fit(train)
    assert model.languages == ("de", "en")
    docs = frame([(1, None), (2, ""), (3, "123 !!"), (None, "the dog"), (4, "hund und haus " * 90000), (4, "und"),
                  (4, "und"), (5, "中文")], ", score string, lang_pred int")
    got = sorted(((r["doc_id"] or 0, r["lang_pred"]) for r in predict(docs, model).collect()))
    assert got[:4] == [(0, "en"), (1, "und"), (2, "und"), (3, "und")]
    assert got[4:7] == [(4, "de")] * 3 and got[7][1] in ("de", "en")
    assert predict(frame([]), model).count() == 0
    none = fit(frame([(1, "text", None)]))
    assert none.languages == () and [r["lang_pred"] for r in predict(train, none).collect()] == ["und"] * 60


def test_batches_do_not_matter(spark, frame):
    model = fit(frame([(i, "abc def " * (i + 1), "en" if i % 2 else "fr") for i in range(20)]))
    raws = [plain(t) for t in ("one two", "x", "", "long " * 500)]
    together = logits(raws, model)
    alone = [logits([r], model)[0] for r in raws]
    assert abs(together - alone).max() < 1e-5
    assert isinstance(Model(), Model)


def test_long_texts_are_summed_whole(spark, frame, monkeypatch):
    import casemine.llm.language as language
    model = fit(frame([(i, "abc def " * (i + 1), "en" if i % 2 else "fr") for i in range(20)]))
    raws = [plain("some longer text of words " * n) for n in (1, 7, 40)]
    whole = logits(raws, model)
    monkeypatch.setattr(language, "PIECE_BYTES", 50)
    assert abs(logits(raws, model) - whole).max() < 1e-6


def test_all_of_a_training_text_and_long_texts_teach(spark, frame):
    """A language whose texts start with 4 KB of another, and one that only
    occurs in texts above ``train_bytes``."""
    rng = random.Random(6)
    words = {x: ["".join(rng.choice(c) for _ in range(rng.randint(2, 7))) for _ in range(300)]
             for x, c in (("a", "abcdef"), ("b", "ghijkl"), ("c", "mnopqr"))}
    prose = lambda x, n: " ".join(rng.choice(words[x]) for _ in range(n))
    rows = [(i, prose("a", 300), "a") for i in range(20)] + [(100 + i, prose("c", 6000), "c") for i in range(20)]
    docs = frame(rows)
    model = language.fit(docs, train_bytes=1 << 13)
    assert model.languages == ("a", "c")
    got = language.predict(frame([(1, prose("a", 40)), (2, prose("c", 40))]), model).collect()
    assert {r["doc_id"]: r["lang_pred"] for r in got} == {1: "a", 2: "c"}
    late = language.train([prose("a", 800)[:4200] + " " + prose("b", 8000) for _ in range(40)]
                          + [prose("c", 2000) for _ in range(40)], ["b"] * 40 + ["c"] * 40)
    z = language.logits([language.plain(prose("b", 200))], late)[0]
    assert late.languages[z.argmax()] == "b" and language.softmax(z[None] / late.temperature)[0].max() > 0.9


def test_equal_rows_do_not_fill_the_sample(spark, frame, monkeypatch):
    rng = random.Random(9)
    prose = lambda c, n: " ".join("".join(rng.choice(c) for _ in range(4)) for _ in range(n))
    same, seen = prose("xyz", 9), []
    rows = [(None, same, "a")] * 3000 + [(i, prose("abcd", 12), "a") for i in range(60)] + [
        (100 + i, prose("efgh", 12), "b") for i in range(60)]
    train = language.train
    monkeypatch.setattr(language, "train", lambda texts, langs: seen.append((texts, langs)) or train(texts, langs))
    model = fit(frame(rows), per_language=40)
    texts, langs = seen[0]
    assert langs.count("a") == langs.count("b") == 40 and texts.count(same) <= 1
    got = predict(frame([(1, prose("abcd", 20)), (2, prose("efgh", 20))]), model).collect()
    assert {r["doc_id"]: r["lang_pred"] for r in got} == {1: "a", 2: "b"}
    # all together are bounded too: shorter stretches of long texts
    monkeypatch.setattr(language, "SAMPLE_BYTES", 1 << 18)
    fit(frame([(i, prose("abcd", 9000), str(i % 2)) for i in range(60)]), per_language=30)
    assert sum(len(t) for t in seen[1][0]) <= 1 << 18 and len(seen[1][0]) == 60
