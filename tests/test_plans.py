"""Physical plan shapes: pushdown, pruning, shuffles, no cartesian products."""

import pytest

import __spark_entry__ as E


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def formatted(df):
    return df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def test_corpus_term_df_single_shuffle(spark, sf_dir):
    df = E.queries()["corpus_term_df"](spark, sf_dir)
    p = formatted(df)
    assert p.count("hashpartitioning") == 1          # the term aggregation
    assert "partial_count" in p                        # map-side combine
    assert "Join" not in p                             # word lists applied in the row
    assert "ReadSchema: struct<text:string>" in p      # only the text column is read


def test_extract_pushdown_and_pruning(spark, sf_dir):
    p = formatted(E.queries()["case_extract"](spark, sf_dir))
    assert "EqualTo(o_orderstatus,O)" in p
    assert "GreaterThanOrEqual(o_orderdate,1990-01-01T00:00)" in p  # date prefix as a range
    assert "In(c_mktsegment, [AUTOMOBILE,BUILDING,MACHINERY])" in p
    assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int,l_returnflag:string,l_linestatus:string>" in p
    assert "LeftSemi" in p


def test_window_counts_partial_aggregation(spark, sf_dir):
    p = formatted(E.queries()["window_word_counts"](spark, sf_dir))
    # panes are counted first, so only pane counts are expanded into windows;
    # that takes one exchange for the panes and one for the windows
    assert "partial_count" in p and "partial_sum" in p and p.count("hashpartitioning") == 2


@pytest.mark.parametrize("name", ["guessed_lines", "term_weights", "y_values", "cluster_report",
                                  "nb_accuracy", "vocabulary", "topic_top_terms", "case_dimensions"])
def test_no_cartesian_or_nested_loop(spark, sf_dir, name):
    p = plan(E.queries()[name](spark, sf_dir))
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


def test_guessed_lines_no_shuffle(spark, sf_dir):
    p = formatted(E.queries()["guessed_lines"](spark, sf_dir))
    # only the round-robin spread of a single-file scan; the scoring is in-row
    assert "hashpartitioning" not in p
