"""Template alignment and similarity of a line to ``<required> words <optional>``
templates, written with Spark higher-order array functions (no Python UDF).

Alignment of line words ``L`` (n words) to template words ``T`` (m words):
  * nothing when n < m;
  * for every template word take its first position in L; the chosen start is
    the largest such position (the rightmost start, as in the original program,
    not the longest run);
  * the run extends while L[start+k] equals T[u+k], u being the first position
    of L[start] in T;
  * output: front = ``<`` + words before the run joined by ``-`` + ``>``,
    middle = the run joined by spaces, tail = ``<`` + words after the run + ``>``.

The other choice (``pick="longest"``) takes the longest run of words that line and
template have in common, wherever it starts in either (ties: the earliest start in
the line, then in the template).  Runs are found by a dynamic programme over the
line's words: behind every word stands, per template word, the length of the
common run that ends with both.

Similarity compares the aligned vector ``[front, run words..., tail]`` with
the template, both mapped word-by-word to the top 32 bits of md5 in [0, 1):
``sum(a*b) / sqrt(sum(a*a + b*b))`` when both have the same length, else 0.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import config as C


def unit_hash(word: str) -> float:
    """Python twin of ``hashing.md5_unit`` for fixed template words."""
    return int(hashlib.md5(word.encode("utf-8")).hexdigest()[:8], 16) / C.HASH_SCALE


def _sum(arr: Column) -> Column:
    return F.aggregate(arr, F.lit(0.0).cast("double"), lambda acc, x: acc + x)


def dot(x: Column, y: Column) -> Column:
    """Dot product; 0 when the sizes differ."""
    return F.when(F.size(x) == F.size(y), _sum(F.zip_with(x, y, lambda a, b: a * b))) \
        .otherwise(F.lit(0.0))


def sqrt_of_pow(x: Column, y: Column) -> Column:
    """sqrt(sum(x_i^2 + y_i^2)); 0 when the sizes differ."""
    return F.when(F.size(x) == F.size(y),
                  F.sqrt(_sum(F.zip_with(x, y, lambda a, b: a * a + b * b)))) \
        .otherwise(F.lit(0.0))


def true_cosine(x: Column, y: Column) -> Column:
    """Proper cosine of two equal-length vectors (0 otherwise)."""
    nx = F.sqrt(_sum(F.transform(x, lambda a: a * a)))
    ny = F.sqrt(_sum(F.transform(y, lambda a: a * a)))
    return F.when((nx > 0) & (ny > 0), dot(x, y) / (nx * ny)).otherwise(F.lit(0.0))


def template_literals(templates: Sequence[str]) -> Column:
    """array<struct<template_id:int, words:array<string>, units:array<double>>>"""
    items = []
    for i, t in enumerate(templates):
        words = t.split(" ")
        items.append(F.struct(
            F.lit(i).alias("template_id"),
            F.array(*[F.lit(w) for w in words]).alias("twords"),
            F.array(*[F.lit(unit_hash(w)) for w in words]).alias("units"),
        ))
    return F.array(*items)


def _staged(arr: Column, **fields) -> Column:
    """Add fields to every struct of ``arr``; each new field is computed once
    per element from the element's existing fields (lambda variable access is
    cheap, a repeated column expression would be evaluated again)."""
    def add(r):
        out = r
        for k, f in fields.items():
            out = out.withField(k, f(r))
        return out
    return F.transform(arr, add)


def _rightmost(a: Column, L: Column, aligned_only: bool) -> Column:
    """Adds aligned, s0 (0-based start) and run: the rightmost first position
    of a template word, and how far line and template agree from there."""
    a = _staged(a, s=lambda r: F.array_max(F.transform(
        r["twords"], lambda t: F.array_position(L, t).cast("int") - 1)))
    a = _staged(a, s0=lambda r: F.greatest(r["s"], F.lit(0)),
                aligned=lambda r: (r["n"] >= F.size(r["twords"])) & (r["s"] >= 0))
    if aligned_only:
        # most lines align with no template: skip the remaining stages for them
        a = F.filter(a, lambda r: r["aligned"])
    a = _staged(a, u=lambda r: F.array_position(r["twords"], F.try_element_at(L, r["s0"] + 1)).cast("int"))
    # the run ends with the template at the latest
    a = _staged(a, eq=lambda r: F.zip_with(
        F.slice(L, r["s0"] + 1, F.size(r["twords"]) + 1), F.slice(r["twords"], F.greatest(r["u"], F.lit(1)), F.lit(1 << 20)),
        lambda x, y: F.coalesce(x == y, F.lit(False))))
    a = _staged(a, pos=lambda r: F.array_position(r["eq"], False).cast("int"))
    return _staged(a, run=lambda r: F.when(r["pos"] == 0, F.size(r["eq"])).otherwise(r["pos"] - 1))


def longest_run(L: Column, T: Column) -> Column:
    """struct<run, neg_start, neg_u>: the longest contiguous run of words of
    ``L`` that ``T`` has too, and its 0-based starts in both, negated."""
    none = F.struct(F.lit(0).alias("run"), F.lit(0).alias("neg_start"), F.lit(0).alias("neg_u"))

    def best(acc: Column) -> Column:
        """The better of the best so far and the runs that end at word ``i``."""
        here = F.transform(acc["runs"], lambda run, j: F.struct(
            run.alias("run"), F.when(run > 0, run - acc["i"]).otherwise(0).alias("neg_start"),
            F.when(run > 0, run - 1 - j).otherwise(0).alias("neg_u")))
        return F.greatest(acc["best"], F.array_max(here))

    def step(acc: Column, word: Column) -> Column:
        # a run that ended one word earlier in both goes on
        runs = F.zip_with(F.concat(F.array(F.lit(0)), F.slice(acc["runs"], 1, F.size(T) - 1)), T,
                          lambda before, t: F.when(t == word, before + 1).otherwise(0))
        return F.struct((acc["i"] + 1).alias("i"), runs.alias("runs"), best(acc).alias("best"))

    start = F.struct(F.lit(0).alias("i"), F.transform(T, lambda _: F.lit(0)).alias("runs"), none.alias("best"))
    return F.aggregate(L, start, step, best)


def _longest(a: Column, L: Column, aligned_only: bool) -> Column:
    """Adds aligned, s0 and run of the longest common run."""
    a = _staged(a, aligned=lambda r: (r["n"] >= F.size(r["twords"])) & F.arrays_overlap(L, r["twords"]))
    if aligned_only:
        a = F.filter(a, lambda r: r["aligned"])
    a = _staged(a, found=lambda r: longest_run(L, r["twords"]))
    return _staged(a, s0=lambda r: -r["found"]["neg_start"], run=lambda r: r["found"]["run"])


PICKS = {"rightmost": _rightmost, "longest": _longest}


def _fits(r: Column) -> Column:
    """Whether ``[front, run words..., tail]`` is as long as the template; else
    the similarity is 0."""
    return r["run"] + 2 == F.size(r["twords"])


def line_template_scores(L: Column, templates: Sequence[str], aligned_only: bool = False,
                         pick: str = "rightmost", cosine: bool = False, fitting_only: bool = False) -> Column:
    """array<struct<template_id, aligned, start, run, front, middle, tail, score>>
    for one line (words ``L``, best passed as a lambda variable or plain column)
    against every template.  Computed in stages so nothing is evaluated twice.
    ``cosine``: adds the proper cosine of the two vectors.
    ``fitting_only``: leaves out what differs in length from its template and
    so has the score 0."""
    literals = template_literals(templates)
    if aligned_only:
        # a line without any word of any template aligns with none of them
        known = sorted({w for t in templates for w in t.split(" ")})
        # the words they share are looked up once per line, then the templates with one of them
        literals = F.flatten(F.transform(
            F.array(F.array_intersect(F.array(*[F.lit(w) for w in known]), L)),
            lambda common: F.filter(literals, lambda r: F.arrays_overlap(common, r["twords"]))))
    a = _staged(literals, n=lambda r: F.size(L))
    a = PICKS[pick](a, L, aligned_only)
    if fitting_only:
        a = F.filter(a, _fits)
    a = _staged(a,
                front=lambda r: F.concat(F.lit("<"), F.array_join(F.slice(L, 1, r["s0"]), "-"), F.lit(">")),
                mid=lambda r: F.slice(L, r["s0"] + 1, r["run"]),
                tail=lambda r: F.concat(F.lit("<"), F.array_join(
                    F.slice(L, r["s0"] + r["run"] + 1, r["n"]), "-"), F.lit(">")))
    a = _staged(a, wunits=lambda r: F.when(_fits(r), F.transform(
        F.concat(F.array(r["front"]), r["mid"], F.array(r["tail"])),
        lambda w: F.conv(F.substring(F.md5(w), 1, 8), 16, 10).cast("long") / F.lit(C.HASH_SCALE)))
        .otherwise(F.array().cast("array<double>")))
    a = _staged(a, dt=lambda r: dot(r["wunits"], r["units"]),
                dn=lambda r: sqrt_of_pow(r["wunits"], r["units"]))

    def out(r):
        ok = r["aligned"]
        return F.struct(
            r["template_id"].alias("template_id"), ok.alias("aligned"),
            F.when(ok, r["s0"] + 1).otherwise(0).alias("start"),
            F.when(ok, r["run"]).otherwise(0).alias("run"),
            F.when(ok, r["front"]).otherwise("").alias("front"),
            F.when(ok, F.array_join(r["mid"], " ")).otherwise("").alias("middle"),
            F.when(ok, r["tail"]).otherwise("").alias("tail"),
            F.when(ok & (r["dn"] > 0), F.round(r["dt"] / r["dn"], 6)).otherwise(F.lit(0.0)).alias("score"),
            *([F.when(ok, F.round(true_cosine(r["wunits"], r["units"]), 6)).otherwise(F.lit(0.0)).alias("cosine")]
              if cosine else []),
        )
    return F.transform(a, out)


def line_score(L: Column, templates: Sequence[str], pick: str = "rightmost") -> Column:
    """Best similarity of a line over all templates (0 when none aligns)."""
    scores = F.transform(line_template_scores(
        L, templates, aligned_only=True, pick=pick, fitting_only=True), lambda r: r["score"])
    return F.coalesce(F.array_max(scores), F.lit(0.0))
