"""The join-based fallbacks (used when a word list is too large to apply in
the row) give the same results as the in-row paths."""

from pyspark.sql import functions as F

from casemine.operators import terms as TR
from casemine.operators import tokens as TK
from casemine.plans.model import CaseModel
from casemine.sources import tables as S


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_owner_filter_join_path(spark, sf_dir, monkeypatch):
    cases, notes = S.cases(spark, sf_dir), S.notes(spark, sf_dir)
    in_row = rows(TK.clean_tokens(cases, notes))
    monkeypatch.setattr(TK, "bounded_values", lambda *a, **k: None)
    joined = TK.clean_tokens(cases, notes)
    assert "Join" in joined._jdf.queryExecution().optimizedPlan().toString()
    assert rows(joined) == in_row


def test_y_values_join_path(spark, sf_dir, monkeypatch):
    m = CaseModel(spark, sf_dir)
    in_row = rows(TR.y_values(m.items, m.frequent))
    monkeypatch.setattr(TR, "bounded_values", lambda *a, **k: None)
    assert rows(TR.y_values(m.items, m.frequent)) == in_row


def test_case_model_owner_join_path(spark, sf_dir, monkeypatch):
    base = rows(CaseModel(spark, sf_dir).corpus_s)
    monkeypatch.setattr(TK, "bounded_values", lambda *a, **k: None)
    assert rows(CaseModel(spark, sf_dir).corpus_s) == base


def test_owner_fallback_keeps_cases_without_tokens(spark, sf_dir, monkeypatch):
    m = CaseModel(spark, sf_dir)
    some = S.cases(spark, sf_dir).limit(3)
    cases = some.unionByName(some.limit(1).withColumn("case_id", F.lit(-1).cast("long")).withColumn(
        "history", F.lit("the a of")))
    monkeypatch.setattr(TK, "bounded_values", lambda *a, **k: None)
    m.__dict__["cases"] = cases
    got = {r["case_id"]: r["tokens"] for r in m.corpus_arrays.collect()}
    assert len(got) == 4 and got[-1] == []


def test_dictionaries_from_files(spark, sf_dir, tmp_path):
    from casemine import config as C
    from casemine.operators import guess as G
    from casemine.sources.dictionary import read_templates, read_word_list
    base = CaseModel(spark, sf_dir)
    word = base.corpus.groupBy("token").count().orderBy("count", ascending=False).first()["token"]
    (tmp_path / "stop.txt").write_text(f"{word}\n")
    (tmp_path / "t.txt").write_text("\n".join(C.PROBLEM_TEMPLATES) + "\n")
    model = CaseModel(spark, sf_dir, extra_words=read_word_list(spark, str(tmp_path / "stop.txt")))
    assert rows(model.corpus) == [r for r in rows(base.corpus) if r[1] != word]
    templates = read_templates(spark, str(tmp_path / "t.txt"))
    assert templates == C.PROBLEM_TEMPLATES
    cases = S.cases(spark, sf_dir).limit(20)
    assert rows(G.guessed_lines(cases, templates)) == rows(G.guessed_lines(cases))
    model.release()
    base.release()


def test_items_beyond_the_broadcast_bound(spark, sf_dir, monkeypatch):
    """Too many high-value terms to broadcast: the best of each topic still are."""
    m = CaseModel(spark, sf_dir)
    base = rows(m.items)
    n = m.hv_terms.count()
    asked = []
    monkeypatch.setattr(TR, "BROADCAST_TERMS", n - 1)
    monkeypatch.setattr(TR, "join_small", lambda *a, f=TR.join_small: asked.append(a) or f(*a))
    assert rows(TR.case_items(m.corpus, m.hv_terms, m.cases, m.topic_top)) == base
    best = asked[0][5]
    assert 0 < best.count() < n and best.join(m.hv_terms.withColumnRenamed("term", "token"), "token", "left_anti").isEmpty()


def test_y_from_postings_deals_the_cases_once(spark, sf_dir):
    """The lists are made of the written items, whole cases dealt by block; two
    rows of a case, a case without id and one without items count as in ``y``."""
    from casemine.operators import postings as PO
    items = spark.createDataFrame([(5, ["a", "b"]), (5, ["a", "b"]), (700, ["a"]), (8, []), (None, ["a"])],
                                  "case_id long, items array<string>")
    dealt = items.repartition(PO.block_of(F.col("case_id").cast("long"), 128))
    lists = PO.blocks(dealt.select("case_id", F.explode("items").alias("term")), "term", "case_id", 128)
    counts = lists.select(F.explode(PO.members(128)).alias("case_id"), "term")
    assert rows(counts) == [(5, "a"), (5, "b"), (700, "a")]
    plan = lists._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1
    from casemine.plans.posting_queries import y_from_postings
    plan = y_from_postings(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "collect_set" in plan and "hashpartitioning(term" not in plan  # no list is dealt by its term
