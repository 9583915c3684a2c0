"""The whole batch case job, end to end, as the original program runs it:
clean -> guess problem/solution -> weights -> LDA topics -> high-value terms
-> frequent items -> (x, y) points -> k-means -> report.

    python -m casemine.plans.job --sf-dir /root/testdata/sf0.01 --out /path/out

Writes parquet tables (points, clusters, report, topics) and the ``%`` text
report below ``--out``; prints a one-line JSON summary.
"""

from __future__ import annotations

import argparse
import json
import os

from pyspark.sql import functions as F

from ..operators import cluster as CL
from ..session import get_session
from ..sources.dictionary import read_templates, read_word_list
from ..sources.sinks import write_table, write_text_lines
from .model import CaseModel


def run(spark, sf_dir: str, out: str, topics: str = "lda", centres: str = "kmeans",
        lda_iterations: int | None = None, y_mode: str = "correct", stop_words: str | None = None,
        problem_templates: str | None = None, solution_templates: str | None = None) -> dict:
    """``stop_words`` (beside the built-in lists) and templates (in place of
    the built-in ones) are paths of files with one entry per line."""
    kw = {} if lda_iterations is None else {"lda_iterations": lda_iterations}
    if stop_words:
        kw["extra_words"] = read_word_list(spark, stop_words)
    for name, path in (("problem_templates", problem_templates), ("solution_templates", solution_templates)):
        if path:
            kw[name] = read_templates(spark, path)
    m = CaseModel(spark, sf_dir, topics=topics, centres=centres, y_mode=y_mode, **kw)
    write_table(m.points, os.path.join(out, "points"))
    assigned = m.assigned.checkpoint(eager=True)
    write_table(assigned, os.path.join(out, "clusters"))
    report = CL.report(assigned, m.dims, m.guessed)
    write_table(report, os.path.join(out, "report"))
    write_text_lines(CL.report_lines(report), os.path.join(out, "report_text"))
    if topics == "lda":
        write_table(m.lda_topics, os.path.join(out, "topics"))
    summary = CL.cluster_summary(assigned).agg(
        F.count(F.lit(1)).alias("clusters"), F.sum("members").alias("cases"),
        F.sum("cost").alias("cost")).first()
    m.release()
    return {"clusters": summary["clusters"], "cases": summary["cases"], "cost": summary["cost"],
            "k_history": m.kmeans_history, "topics": topics, "centres": centres}


def main() -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf-dir", required=True)
    ap.add_argument("--out", required=True)
    ap.add_argument("--topics", default="lda", choices=["lda", "series"])
    ap.add_argument("--centres", default="kmeans", choices=["kmeans", "product"])
    ap.add_argument("--lda-iterations", type=int, default=None)
    ap.add_argument("--y-mode", default="correct", choices=["correct", "compat"])
    for name in ("stop-words", "problem-templates", "solution-templates"):
        ap.add_argument(f"--{name}", help="a file with one entry per line")
    a = ap.parse_args()
    print(json.dumps(run(get_session(), **vars(a))))


if __name__ == "__main__":
    main()
