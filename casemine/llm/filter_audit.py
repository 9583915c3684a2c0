"""How filters interact: what each removes in every order they could run in.

A row is described by the set of filters that it fails; all else follows from
the counts of those sets.  The sets of filters already applied make a lattice.
Its states are met by orders: ``forward`` counts the orders that reach a state
from the empty set, ``backward`` those that go on from it to the full set, both
by adding up over the state's edges.  An edge adds one filter to a state and
removes the rows that fail this filter and none of the state's.  An order is a
path, so its steps are read from its edges, and an edge lies on forward x
backward orders, which weighs its removals in a filter's sum over all orders.

Rows are read once, texts piece by piece; what goes on is a row per document of
some 60 bytes.  The least id of a text is found by an aggregation over digests
(sha256) that is combined before the shuffle; only texts with several ids are
joined back, hot ones (a text in a third of all rows) dealt over tasks.  After
that there is a row per part and set, so neither hot parts nor hot texts reach a
task in full.

Edge cases: a null text counts as empty, a null part as ''; rows with the same
id never count as smaller copies of each other, each of them counts; a null id
is smaller than none and has no label; of several labels of an id the largest
count; very long texts are counted in pieces of 1 MB; an empty table gives an
empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Sequence
from itertools import permutations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.broadcast import join_small
from .common import cut, map_slices

PIECE = 1 << 20
BLANK = re.compile(rb"[\x20\x09-\x0D]")
CAPITALS = bytes(range(ord("A"), ord("Z") + 1))
MARKS = b"#$%&*|"
MOST_FILTERS = 6  # 720 orders


def _words(raw: bytes) -> tuple[int, int]:
    """Words of a text, and how many are different."""
    if len(raw) <= PIECE:
        words = raw.split()  # splits bytes at exactly the six blanks
        return len(words), len(set(words))
    n, seen, at = 0, set(), 0
    while at < len(raw):
        end = BLANK.search(raw, at + PIECE)
        end = end.start() if end else len(raw)
        words = raw[at:end].split()
        n, at = n + len(words), end
        seen.update(words)
    return n, len(seen)


def _facts(batch: pa.RecordBatch) -> dict:
    texts = pc.fill_null(batch.column(batch.schema.get_field_index("text")), "")
    raw = texts.cast(pa.binary()).to_pylist()
    counts = [_words(x) for x in raw]
    return {"id": batch.column(0), "part": batch.column(1), "n_points": pc.cast(pc.utf8_length(texts), pa.int64()),
            "n_words": [n for n, _ in counts], "n_distinct": [d for _, d in counts],
            "n_capitals": [len(x) - len(x.translate(None, CAPITALS)) for x in raw],
            "marked": [len(x.translate(None, MARKS)) < len(x) for x in raw],
            "digest": [hashlib.sha256(x).digest() for x in raw]}


def facts(docs: DataFrame, part: Column, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: id, part, counts of words, different words, capitals (A-Z) and
    code points, whether it holds one of ``MARKS``, and the text's sha256."""
    rows = docs.select(F.col(doc_id).cast("long").alias("id"), F.coalesce(part.cast("string"), F.lit("")).alias("part"),
                       F.col(text).alias("text"))
    return map_slices(rows, _facts, "id long, part string, n_words long, n_distinct long, n_capitals long, "
                                    "n_points long, marked boolean, digest binary")


def copies(rows: DataFrame) -> DataFrame:
    """``rows`` with ``copy``: whether a smaller id has the same digest."""
    several = rows.groupBy("digest").agg(F.min("id").alias("first"), F.max("id").alias("last")).where("first < last")
    got = join_small(rows, cut(several.select("digest", "first")), "digest", "left")
    return got.withColumn("copy", F.coalesce(F.col("id") > F.col("first"), F.lit(False))).drop("first")


def with_labels(rows: DataFrame, labels: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """``rows`` with ``good`` and ``toxic`` by the labels of their ids."""
    known = labels.where(F.col(doc_id).isNotNull()).groupBy(F.col(doc_id).cast("long").alias("id")).agg(
        F.coalesce(F.max(F.col("quality") == 1), F.lit(False)).alias("good"),
        F.coalesce(F.max(F.col("toxic") == 1), F.lit(False)).alias("toxic")).where("good OR toxic")
    no = F.lit(False)
    met = rows.where("id IS NOT NULL").join(known, "id", "left").withColumns(
        {"good": F.coalesce("good", no), "toxic": F.coalesce("toxic", no)})
    # rows without id would all meet in one task
    return met.unionByName(rows.where("id IS NULL").withColumns({"good": no, "toxic": no}))


def paths(n: int) -> tuple[list[int], list[int]]:
    """Orders that reach, and that leave, every state of the lattice of n filters."""
    full = (1 << n) - 1
    forward, backward = [1] + [0] * full, [0] * full + [1]
    for state in range(1, full + 1):
        forward[state] = sum(forward[state ^ 1 << f] for f in range(n) if state >> f & 1)
    for state in range(full - 1, -1, -1):
        backward[state] = sum(backward[state | 1 << f] for f in range(n) if not state >> f & 1)
    return forward, backward


def audit(rows: DataFrame, fails: dict[str, Column], part: str = "part", good: str = "good",
          toxic: str = "toxic") -> DataFrame:
    """One row per part, order of all filters and step: ``kept, removed,
    redundant, unique_fails, good_lost, toxic_lost, shapley``.  ``fails``: name
    of each filter (one letter) and when a row fails it."""
    names = list(fails)
    n = len(names)
    if n > MOST_FILTERS:
        raise ValueError(f"{n} filters have too many orders to list; at most {MOST_FILTERS}")
    failed = sum((F.when(c, F.lit(1 << i)).otherwise(F.lit(0)) for i, c in enumerate(fails.values())), F.lit(0))
    sets = rows.select(F.col(part).alias("part"), failed.cast("int").alias("failed"), F.col(good).alias("good"),
                       F.col(toxic).alias("toxic"))
    counts = sets.groupBy("part", "failed").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("good").alias("good"), F.count_if("toxic").alias("toxic"))
    # at most 2^n cells a part
    cells = counts.groupBy("part").agg(F.collect_list(F.struct("failed", "n", "good", "toxic")).alias("cells"))

    forward, backward = paths(n)
    edges = F.array(*[F.struct(F.lit(s).alias("state"), F.lit(1 << f).alias("bit"), F.lit(names[f]).alias("filter"),
                               F.lit(forward[s] * backward[s | 1 << f]).alias("orders"))
                      for s in range(1 << n) for f in range(n) if not s >> f & 1])

    def total(what: str, when) -> Column:
        return F.aggregate(F.filter("cells", when), F.lit(0).cast("long"), lambda acc, c: acc + c[what])

    state, bit = F.col("edge.state"), F.col("edge.bit")

    def goes(c: Column) -> Column:
        return (c["failed"].bitwiseAND(state) == 0) & (c["failed"].bitwiseAND(bit) != 0)

    on_edge = cells.select("part", "cells", F.explode(edges).alias("edge")).select(
        "part", state.alias("state"), F.col("edge.filter").alias("filter"), F.col("edge.orders").alias("orders"),
        total("n", lambda c: c["failed"].bitwiseAND(state.bitwiseOR(bit)) == 0).alias("kept"),
        total("n", goes).alias("removed"),
        total("n", lambda c: (c["failed"].bitwiseAND(state) != 0) & (c["failed"].bitwiseAND(bit) != 0)).alias("redundant"),
        total("n", lambda c: c["failed"] == bit).alias("unique_fails"),
        total("good", goes).alias("good_lost"), total("toxic", goes).alias("toxic_lost"))
    measures = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost"]
    # n 2^(n-1) edges a part
    per_part = on_edge.groupBy("part").agg(F.collect_list(F.struct("state", "filter", "orders", *measures)).alias("edges"))
    weighed = F.transform("edges", lambda e: e.withField("shapley", F.aggregate(
        F.filter("edges", lambda o: o["filter"] == e["filter"]), F.lit(0).cast("long"),
        lambda acc, o: acc + o["orders"] * o["removed"])))
    found = per_part.select("part", F.explode(weighed).alias("e")).select("part", "e.*")

    spark = rows.sparkSession
    steps = spark.createDataFrame(  # n! orders of n steps
        [("".join(order), k + 1, sum(1 << names.index(f) for f in order[:k]), f)
         for order in permutations(names) for k, f in enumerate(order)],
        "filter_order string, step int, state int, filter string")
    return found.join(F.broadcast(steps), ["state", "filter"]).select(
        "part", "filter_order", "step", *measures, "shapley")


def text_filters() -> dict[str, Column]:
    """Five filters over the columns of ``facts`` and ``copies``: too short,
    repetitive, shouting, odd marks, copies."""
    return {"A": F.col("n_words") < 50,
            "B": 100 * F.col("n_distinct") < 65 * F.col("n_words"),
            "C": 100 * F.col("n_capitals") > 5 * F.col("n_points"),
            "D": F.col("marked"),
            "E": F.col("copy")}


def audit_texts(docs: DataFrame, labels: DataFrame, part: Column, filters: dict[str, Column] | None = None,
                names: Sequence[str] | None = None) -> DataFrame:
    """The audit of ``text_filters`` (or others over the same columns; ``names``
    picks some) over a documents table."""
    filters = filters or text_filters()
    filters = {k: c for k, c in filters.items() if names is None or k in names}
    rows = copies(cut(facts(docs, part)))
    return audit(with_labels(rows, labels), filters)
