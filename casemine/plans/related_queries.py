"""Related cases: the nearest cases of the same cluster."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import nearest as N
from .cluster_queries import _ASSIGNED, assigned_frame
from .registry import query

RELATED = 5


@query("related_cases", f"""
WITH a AS {_ASSIGNED},
 p AS (SELECT l.case_id, l.cluster, r.case_id AS related_id,
              (l.x - r.x) * (l.x - r.x) + (l.y - r.y) * (l.y - r.y) AS dist2
       FROM a l JOIN a r ON r.cluster = l.cluster AND r.case_id <> l.case_id),
 k AS (SELECT *, row_number() OVER (PARTITION BY case_id ORDER BY dist2, related_id) AS rank FROM p)
SELECT case_id, rank, related_id, round(sqrt(dist2), 6) AS distance FROM k WHERE rank <= {RELATED}
""")
def related_cases(spark, sf_dir):
    """The five nearest cases of every case within its cluster."""
    got = N.related(assigned_frame(spark, sf_dir), "cluster", RELATED)
    return got.select("case_id", F.col("rank").cast("long").alias("rank"), "related_id",
                      F.round(F.sqrt("dist2"), 6).alias("distance"))
