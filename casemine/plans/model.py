"""The batch case job as a set of lazily built, reusable intermediates.

Intermediates that several later steps read (the cleaned corpus, the guessed
lines, the per-case items, the points) are written once as tables of the shared
checkpoint folder: the CPU-heavy text work runs once, lineage is cut, and a
lost executor only costs re-reading the written files.  ``release`` deletes them.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config as C
from ..operators import cases as CS
from ..operators import cluster as CL
from ..operators import guess as G
from ..operators import mining as MN
from ..operators import terms as TR
from ..operators import tokens as TK
from ..session import drop_path, ensure_checkpoint_dir, scratch_path
from ..sources import tables as S


class CaseModel:
    def __init__(self, spark: SparkSession, sf_dir: str, k: int = C.KMEANS_START_K + C.KMEANS_K_STEP,
                 topics: str = "series", centres: str = "product", lda_iterations: int = C.LDA_ITERATIONS,
                 y_mode: str = "correct", match: str = "token", extra_words: DataFrame | None = None,
                 problem_templates: Sequence[str] = C.PROBLEM_TEMPLATES,
                 solution_templates: Sequence[str] = C.SOLUTION_TEMPLATES):
        """topics: "series" (each product series is a topic; deterministic) or
        "lda" (EM LDA over weighted vectors, as the original program).
        centres: "product" (the mean of all points of each product, for the k
        products with most cases; deterministic) or "kmeans" (Spark ML k-means).
        y_mode: "correct" or "compat" (the as-coded 101 * max(n, 1)).
        match: how a term is found in a guessed line, as a "token" or a "substring".
        extra_words, problem_templates, solution_templates: dictionaries beside
        or in place of the built-in ones."""
        self.spark, self.sf_dir, self.k = spark, sf_dir, k
        self.topics, self.centres, self.lda_iterations = topics, centres, lda_iterations
        self.y_mode, self.match = y_mode, match
        self.kmeans_history: list[tuple[int, float]] = []
        self.extra_words = extra_words
        self.problem_templates, self.solution_templates = problem_templates, solution_templates
        ensure_checkpoint_dir(spark)
        self.folder = scratch_path(spark, f"model-{uuid.uuid4().hex}")

    def _keep(self, df: DataFrame, name: str) -> DataFrame:
        """Write an intermediate to the shared folder and go on from there."""
        path = f"{self.folder}/{name}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def release(self) -> None:
        """Delete what the model wrote; its frames can't be read any more."""
        drop_path(self.spark, self.folder)

    @cached_property
    def cases(self) -> DataFrame:
        return S.cases(self.spark, self.sf_dir)

    @cached_property
    def notes(self) -> DataFrame:
        return S.notes(self.spark, self.sf_dir)

    @cached_property
    def corpus_arrays(self) -> DataFrame:
        """(case_id, series, tokens): the cleaned token set of every case,
        written once; both the long form and the ML vectors derive from it
        without a shuffle."""
        arrays, rest = TK.clean_arrays(self.cases, self.notes, keep=("series",))
        if self.extra_words is not None:
            rest = self.extra_words.select("word").unionByName(rest) if rest is not None else self.extra_words
        if rest is not None:  # word lists too large for the row: join on the long form
            long = TK.drop_words(TK.explode_tokens(arrays, ("series",)), rest)
            found = long.groupBy("case_id").agg(F.collect_list("token").alias("tokens"))
            arrays = arrays.drop("tokens").join(found, "case_id", "left").withColumn(
                "tokens", F.coalesce("tokens", F.array().cast("array<string>")))
        return self._keep(arrays, "corpus")

    @cached_property
    def corpus_s(self) -> DataFrame:
        """(case_id, series, token)."""
        return TK.explode_tokens(self.corpus_arrays, ("series",))

    @cached_property
    def corpus(self) -> DataFrame:
        return self.corpus_s.select("case_id", "token")

    @cached_property
    def term_df(self) -> DataFrame:
        """(term, df), written once."""
        return self._keep(TK.term_document_frequency(self.corpus), "term_df")

    @cached_property
    def dims(self) -> DataFrame:
        return CS.case_dimensions(self.cases, self.notes)

    @cached_property
    def guessed(self) -> DataFrame:
        return self._keep(G.guessed_lines(self.cases, self.problem_templates, self.solution_templates), "guessed")

    @cached_property
    def weights(self) -> DataFrame:
        return TR.term_weights(self.term_df, self.dims, self.guessed, self.match)

    @cached_property
    def vocabulary(self) -> DataFrame:
        return TR.vocabulary(self.term_df)

    @cached_property
    def lda_vectors(self) -> tuple[DataFrame, DataFrame, DataFrame, int, int]:
        """(the cases' tokens, what the vectors hold for each, vocabulary, its
        size, number of entries)."""
        vocabulary = self._keep(self.vocabulary, "vocabulary")
        size, n_entries = vocabulary.agg(F.count(F.lit(1)), F.coalesce(F.sum("df"), F.lit(0))).first()
        terms = MN.weighted_terms(vocabulary, self.weights)
        return self.corpus_arrays.select("case_id", "tokens"), terms, vocabulary, size, n_entries

    @cached_property
    def lda_topics(self) -> DataFrame:
        """(topic, term, weight) of the EM LDA over weighted case vectors."""
        docs, terms, vocabulary, size, n = self.lda_vectors
        return MN.lda_topics(docs, vocabulary, size, iterations=self.lda_iterations, n_entries=n, terms=terms)

    @cached_property
    def lda_mass(self) -> DataFrame:
        """(term, mass, mass_after): what all topics together hold of a term, in
        the fitted model and after one more expectation step.  By definition
        both are the term's summed weight over all cases."""
        docs, terms, vocabulary, size, n = self.lda_vectors
        path = f"{self.folder}/lda"
        MN.save_lda(docs, size, path, iterations=self.lda_iterations, n_entries=n, terms=terms)
        by_term, by_doc, entries, totals = MN.lda_counts(self.spark, path)
        after = MN.expectation_step(entries, by_term, by_doc, totals, size, *MN.lda_priors(size))
        total = F.aggregate("counts", F.lit(0.0), lambda a, b: a + b)
        return vocabulary.select("term", "term_id").join(by_term.select("term_id", total.alias("mass")), "term_id").join(
            after.select("term_id", total.alias("mass_after")), "term_id").select("term", "mass", "mass_after")

    @cached_property
    def topic_scores(self) -> DataFrame:
        if self.topics == "lda":
            return self.lda_topics.select("topic", "term", F.col("weight").alias("score"))
        return TR.series_topic_scores(self.corpus_s)

    @cached_property
    def topic_top(self) -> DataFrame:
        """Top terms per topic (read by the hv set, its size check and the
        items): written once."""
        return self._keep(TR.topic_top_terms(self.topic_scores), "topic_top")

    @cached_property
    def hv_terms(self) -> DataFrame:
        return TR.high_value_terms(self.topic_top)

    @cached_property
    def item_pairs(self) -> DataFrame:
        """(case_id, term): the items of the cases as pairs, not written."""
        return TR.item_pairs(self.corpus, self.hv_terms)

    @cached_property
    def items(self) -> DataFrame:
        return self._keep(TR.case_items(self.corpus, self.hv_terms, self.cases, self.topic_top), "items")

    @cached_property
    def frequent(self) -> DataFrame:
        return TR.frequent_items(self.items)

    @cached_property
    def y(self) -> DataFrame:
        return TR.y_values(self.items, self.frequent)

    @cached_property
    def given(self) -> DataFrame:
        return CS.given_value(self.cases)

    @cached_property
    def points(self) -> DataFrame:
        y = self.y
        if self.y_mode == "compat":
            y = y.select("case_id", F.col("y_compat").alias("y"))
        return self._keep(CL.points(self.given, y), "points")

    @cached_property
    def assigned(self) -> DataFrame:
        if self.centres == "kmeans":
            model, _, self.kmeans_history = CL.choose_k(self.points)
            return CL.kmeans_assign(self.points, model)
        return CL.assign(self.points, CL.product_centres(self.points, self.cases, self.k))

    @cached_property
    def report(self) -> DataFrame:
        return CL.report(self.assigned, self.dims, self.guessed)

    def items_text(self) -> DataFrame:
        return self.items.select("case_id", F.array_join("items", " ").alias("items"), "n_items")
