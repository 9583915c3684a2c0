"""EM LDA over blocks: the counts don't depend on how documents are dealt."""

import random

from casemine.operators import mining as MN
from casemine.operators import topics as TO


def _rows():
    rng = random.Random(3)
    rows = [(None if i == 0 else i, t, float(1 + t % 7)) for i in range(60) for t in sorted(rng.sample(range(25), 6))]
    return rows + [(i, 25 + i, 3.0) for i in range(1, 40)]  # terms of one document


def _fit(spark, rows, least, monkeypatch, df=True):
    monkeypatch.setattr(TO, "LEAST_ENTRIES", least)
    count = {}
    for _, t, _ in rows:
        count[t] = count.get(t, 0) + 1
    entries = spark.createDataFrame([(c, t, n, count[t] if df else None) for c, t, n in rows],
                                    "case_id long, term_id long, n double, df long")
    return MN.fit_lda(entries, 65, k=3, iterations=4, n_entries=len(rows))


def _near(a, b):
    return set(a) == set(b) and all(abs(x - y) < 1e-9 * max(abs(y), 1) for t in a for x, y in zip(a[t], b[t]))


def test_blocks_do_not_change_the_topics(spark, monkeypatch):
    rows = _rows()
    models = [_fit(spark, rows, 1_000, monkeypatch), _fit(spark, rows, 10, monkeypatch),
              _fit(spark, rows, 10, monkeypatch, df=False)]
    assert models[0].shares == 1 and models[1].shares > 1
    terms = [{r["term_id"]: r["counts"] for r in m.terms().collect()} for m in models]
    assert sum(m.terms().count() for m in models) == 3 * 64  # every term once
    assert _near(terms[1], terms[0]) and _near(terms[2], terms[0])
    mass = {}
    for _, t, n in rows:
        mass[t] = mass.get(t, 0) + n
    assert all(abs(sum(terms[1][t]) - n) < 1e-9 * n for t, n in mass.items())
    assert max(abs(c[0] - c[1]) for c in terms[0].values()) > 0.1  # topics differ
    assert models[1].docs().count() == 60 and models[1].entries().count() == len(rows)
    assert abs(sum(models[1].totals) - sum(mass.values())) < 1e-6


def test_repeated_entries_count_once(spark, monkeypatch):
    rows = _rows()
    once, twice = (_fit(spark, r, 10, monkeypatch) for r in (rows, rows + rows[:100]))
    got, want = ({r["term_id"]: r["counts"] for r in m.terms().collect()} for m in (twice, once))
    assert _near(got, want)


def _folder_bytes(spark):
    import os
    top = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return sum(os.path.getsize(os.path.join(d, f)) for t in top for d, _, fs in os.walk(t) for f in fs if f.startswith("shuffle_"))


def _token_rows():
    rows = _rows()
    tokens = {}
    for c, t, _ in rows:
        tokens.setdefault(c, []).append(f"w{t}")
    count = {}
    for _, t, _ in rows:
        count[t] = count.get(t, 0) + 1
    return rows, tokens, [(f"w{t}", t, float(1 + t % 7) if t < 25 else 3.0, n) for t, n in count.items()]


def test_tokens_are_fitted_as_their_entries(spark, monkeypatch):
    """Documents as token lists: the model of the same entries; a repeated case
    counts once, tokens that the vocabulary lacks and empty cases don't count."""
    rows, tokens, terms = _token_rows()
    docs = spark.createDataFrame([*tokens.items(), (5, tokens[5][:3] + ["unknown"]), (99, []), (98, ["unknown"])],
                                 "case_id long, tokens array<string>").repartition(4)
    known = spark.createDataFrame(terms, "token string, term_id long, n double, df long")
    want = {r["term_id"]: r["counts"] for r in _fit(spark, rows, 10, monkeypatch).terms().collect()}
    for least in (1_000, 10):
        monkeypatch.setattr(TO, "LEAST_ENTRIES", least)
        model = MN.fit_lda(docs, 65, k=3, iterations=4, n_entries=len(rows), terms=known)
        got = {r["term_id"]: r["counts"] for r in model.terms().collect()}
        assert _near(got, want)
        assert model.docs().count() == 60 and model.entries().count() == len(rows)
    assert model.shares > 1


def test_shuffles_are_deleted_on_the_way(spark, monkeypatch):
    """What iterations move is deleted when the next step is stored: the disk a
    fit takes doesn't grow with their number; a model is gone when released."""
    import os
    rows, tokens, terms = _token_rows()
    docs = spark.createDataFrame(list(tokens.items()), "case_id long, tokens array<string>").repartition(4).checkpoint()
    known = spark.createDataFrame(terms, "token string, term_id long, n double, df long").checkpoint()
    monkeypatch.setattr(TO, "LEAST_ENTRIES", 10)
    monkeypatch.setattr(TO, "CHECKPOINT_EVERY", 3)
    left = []
    for n in (1, 8):
        before = _folder_bytes(spark)
        model = MN.fit_lda(docs, 65, k=3, iterations=n, n_entries=len(rows), terms=known)
        left.append(_folder_bytes(spark) - before)
        assert model.terms().count() == 64
    assert left[1] <= max(left[0], 0) + 1_000
    files = [model.blocks.getCheckpointFile(), model.stored]
    assert all(os.path.exists(f.removeprefix("file:")) for f in files)
    model.release()
    assert not any(os.path.exists(f.removeprefix("file:")) for f in files)


def test_slices_of_a_block_do_not_change_it(monkeypatch):
    """A block is taken up some documents at a time; the same comes out."""
    import numpy as np
    import pyarrow as pa
    rng = random.Random(8)
    texts = ["\n".join(rng.sample([f"w{i}" for i in range(30)], rng.randint(1, 9))) for _ in range(50)]
    rows = pa.record_batch([pa.array([*range(49), 7]), pa.array([*range(0, 49 * 977, 977), 7 * 977]), pa.array(texts)], names=["case_id", "key", "text"])
    outs = []
    for size in (1 << 20, 7, 1):
        monkeypatch.setattr(TO, "SLICE", size)
        packets = [b.column(1)[0].as_py() for b in TO._deal(1)(iter([rows]))]
        (d, coded), = TO._coded([(0, p) for p in packets])
        names = coded[4].to_pylist()
        ids = pa.record_batch([pa.array(np.zeros(28, np.int32)), pa.array([names.index(f"w{i}") for i in range(28)], pa.int32()),
                               pa.array(range(28)), pa.array(np.arange(28) + 1.0), pa.array([60] * 28)],
                              names=["block", "code", "term_id", "n", "df"])
        told = [b.column(1)[0].as_py() for b in TO._told_apart(iter([ids]))]
        (_, (_, block)), = TO._identified(2)([(0, coded), *[(0, ("ids", p)) for p in told]])
        assert sum(b - a for a, b in TO._cuts(np.cumsum(block["lens"]))) == len(block["lens"])
        pairs = sorted((int(block["keys"][i]), int(block["words"][j])) for i, j in zip(TO._doc(block), TO._at(block)))
        want = {((7 if i == 49 else i) * 977, int(w[1:])) for i, t in enumerate(texts) for w in t.split("\n") if int(w[1:]) < 28}
        assert pairs == sorted(want)
        outs.append((block, [x[1] for x in TO._start(3, 5)([(0, ("block", block))])]))
    for block, sent in outs[1:]:
        assert block["at"][0] == outs[0][0]["at"][0] and np.array_equal(block["lens"], outs[0][0]["lens"])
        for mine, one in zip(sent, outs[0][1]):
            assert all(np.allclose(a, b, rtol=1e-12) for a, b in zip(mine[1:], one[1:]))
