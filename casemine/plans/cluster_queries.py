"""Cluster queries: points, assignment to centres made from all points (the
mean point of each product), cluster summary, the report and its text lines."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import config as C
from ..operators import cluster as CL
from . import sqlparts as P
from .case_queries import _GIVEN_SQL
from .registry import query
from .model import CaseModel
from .term_queries import _GUESSED, _Y

K = C.KMEANS_START_K + C.KMEANS_K_STEP


def points_frame(spark, sf_dir):
    return CaseModel(spark, sf_dir, K).points


def assigned_frame(spark, sf_dir):
    return CaseModel(spark, sf_dir, K).assigned


_POINTS = f"(SELECT g.case_id, g.x, y.y FROM ({_GIVEN_SQL}) g JOIN {_Y} y ON y.case_id = g.case_id)"
_ASSIGNED = f"""
(WITH p AS {_POINTS},
 m AS (SELECT coalesce(d.source, '') AS product, count(*) AS n, round(avg(x), 6) AS cx, round(avg(y), 6) AS cy
       FROM p JOIN documents d ON d.doc_id = p.case_id GROUP BY 1),
 c AS (SELECT row_number() OVER (ORDER BY product) - 1 AS cluster, cx, cy
       FROM (SELECT * FROM m ORDER BY n DESC, product LIMIT {K}) f),
 d AS (SELECT p.case_id, p.x, p.y, c.cluster, (p.x - c.cx) * (p.x - c.cx) + (p.y - c.cy) * (p.y - c.cy) AS dist2
       FROM p, c)
 SELECT case_id, x, y, cluster, dist2 FROM (
   SELECT *, row_number() OVER (PARTITION BY case_id ORDER BY dist2, cluster) AS k FROM d) z WHERE k = 1)
"""


@query("case_points", f"SELECT * FROM {_POINTS} p")
def case_points(spark, sf_dir):
    return points_frame(spark, sf_dir)


@query("cluster_assignment", f"SELECT * FROM {_ASSIGNED} a")
def cluster_assignment(spark, sf_dir):
    return assigned_frame(spark, sf_dir)


@query("cluster_summary", f"""
SELECT cluster, count(*) AS members, round(sum(dist2), 3) AS cost FROM {_ASSIGNED} a GROUP BY cluster
""")
def cluster_summary(spark, sf_dir):
    return CL.cluster_summary(assigned_frame(spark, sf_dir))


def report_frame(spark, sf_dir):
    return CaseModel(spark, sf_dir, K).report


_REPORT = f"""
(WITH a AS {_ASSIGNED},
 keep AS (SELECT * FROM a WHERE cluster IN (SELECT cluster FROM a GROUP BY cluster HAVING count(*) >= 2)),
 g AS {_GUESSED}
 SELECT keep.cluster, keep.x, keep.y, cast(keep.case_id AS VARCHAR) AS case_id,
        d.source AS customer, d.lang AS series, d.source AS product,
        CASE WHEN lower({P.PLATFORM}) = {P.q(C.PLATFORM_UNSET)} THEN {P.q(C.PLATFORM_UNKNOWN)}
             ELSE lower({P.PLATFORM}) END AS platform,
        list_min(list_filter(string_split(lower(coalesce(d.lang, '') || '--' || coalesce(d.source, '')), '--'),
                             lambda w: w <> '')) AS cause_word,
        list_min(list_filter({P.raw_tokens("string_split(d.text, chr(10))[1]")}, lambda w: w <> ''))
            AS title_word,
        g.problem, g.solution
 FROM keep LEFT JOIN documents d ON d.doc_id = keep.case_id LEFT JOIN g ON g.case_id = keep.case_id)
"""


@query("cluster_report", f"SELECT * FROM {_REPORT} r")
def cluster_report(spark, sf_dir):
    return report_frame(spark, sf_dir)


@query("report_lines", f"""
SELECT concat_ws('%', coalesce(cast(cluster AS VARCHAR), ''), coalesce(cast(x AS VARCHAR), ''),
       coalesce(cast(y AS VARCHAR), ''), coalesce(case_id, ''), coalesce(customer, ''),
       coalesce(series, ''), coalesce(product, ''), coalesce(platform, ''), coalesce(cause_word, ''),
       coalesce(title_word, ''), coalesce(problem, ''), coalesce(solution, '')) AS line
FROM {_REPORT} r
""")
def report_lines(spark, sf_dir):
    return CL.report_lines(report_frame(spark, sf_dir))


SWEEP_ROUNDS = 3
SWEEP_MEAN_COST = 30_000.0  # the mean squared distance aimed at


def _sweep_sql(rounds: int = SWEEP_ROUNDS) -> str:
    """The sweep, an iteration a step: nothing is taken over from the Spark side."""
    def nearest_of(name: str) -> str:
        return (f"(SELECT x, y, n, arg_min(id, [d2, id]) AS id, min(d2) AS d2 FROM (SELECT p.x, p.y, p.n, c.id, "
                f"(p.x - c.cx) * (p.x - c.cx) + (p.y - c.cy) * (p.y - c.cy) AS d2 FROM places p, {name} c) d "
                f"GROUP BY x, y, n)")
    k = C.KMEANS_START_K + C.KMEANS_K_STEP
    steps = [f"""places AS MATERIALIZED (SELECT x, y, count(*) AS n FROM {_POINTS} p GROUP BY x, y)""",
             f"""c0_0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY n DESC, x, y) - 1 AS id, x AS cx, y AS cy
 FROM (SELECT * FROM places ORDER BY n DESC, x, y LIMIT {k}) f)"""]
    rows = []
    for r in range(rounds):
        if r:
            steps.append(f"""c{r}_0 AS MATERIALIZED (SELECT id, cx, cy FROM {last} UNION ALL
 SELECT (SELECT count(*) FROM {last}) + row_number() OVER (ORDER BY d2 DESC, x, y) - 1, x, y
 FROM (SELECT * FROM {nearest_of(last)} f WHERE d2 > 0 ORDER BY d2 DESC, x, y LIMIT {C.KMEANS_K_STEP}) g)""")
        for i in range(C.KMEANS_ITERATIONS):
            steps.append(f"""c{r}_{i + 1} AS MATERIALIZED (SELECT c.id, coalesce(m.cx, c.cx) AS cx, coalesce(m.cy, c.cy) AS cy FROM c{r}_{i} c
 LEFT JOIN (SELECT id, round(sum(n * x) / sum(n), 6) AS cx, round(sum(n * y) / sum(n), 6) AS cy
            FROM {nearest_of(f"c{r}_{i}")} a GROUP BY id) m ON m.id = c.id)""")
        last = f"c{r}_{C.KMEANS_ITERATIONS}"
        rows.append(f"SELECT {k + r * C.KMEANS_K_STEP} AS k, sum(n * d2) / sum(n) AS cost FROM {nearest_of(last)} a")
    return (f"WITH {', '.join(steps)}, t AS ({' UNION ALL '.join(rows)}) SELECT k::BIGINT AS k, round(cost, 6) AS mean_cost, "
            f"k = (SELECT coalesce(min(k) FILTER (cost < {SWEEP_MEAN_COST}), max(k)) FROM t) AS chosen FROM t")


@query("choose_k_sweep", _sweep_sql())
def choose_k_sweep(spark, sf_dir):
    """Mean cost of k-means for rising k, and the k that the aim chooses."""
    pts = points_frame(spark, sf_dir)
    n = pts.count()
    found = CL.sweep_k(pts, SWEEP_ROUNDS)
    chosen = CL.first_below(found, SWEEP_MEAN_COST * n)
    return spark.createDataFrame([(k, cost / max(n, 1), k == chosen) for k, _, cost in found],
                                 "k long, mean_cost double, chosen boolean").withColumn("mean_cost", F.round("mean_cost", 6))
