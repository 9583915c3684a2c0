"""End-to-end batch job; the report keeps the recorded output's shape rules."""

import os
import tempfile

from casemine.plans import job


def test_job_report_shape(spark, sf_dir):
    out = tempfile.mkdtemp(prefix="cm-job-")
    summary = job.run(spark, sf_dir, out, topics="lda", centres="kmeans", lda_iterations=3,
                      y_mode="compat")
    assert summary["k_history"][0][0] == 25 and summary["cases"] > 0
    rep = spark.read.parquet(os.path.join(out, "report")).collect()
    assert rep, "report is empty"
    sizes = {}
    for r in rep:
        sizes[r["cluster"]] = sizes.get(r["cluster"], 0) + 1
        assert r["y"] % 101 == 0            # the as-coded y rule
        assert float(r["x"]).is_integer()    # x is whole
        assert 0 <= r["cluster"] < 25
    assert min(sizes.values()) >= 2
    lines = [r["value"] for r in spark.read.text(os.path.join(out, "report_text")).collect()]
    assert len(lines) == len(rep) and all(len(line.split("%")) >= 12 for line in lines)
