"""Registered queries of this subpackage and their DuckDB oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import table
from . import (ann, bpe, decontaminate, filter_audit, language, lattice_lm, merkle, pieces, quality, sharding, simhash,
               suffix_dedup, toxicity)
from .common import remainder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

SHARDS = 24
TOXIC_SCORE = 0.3


def query(name: str, sql: str | None = None):
    def wrap(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return wrap


def bpe_path() -> str:
    """The vocabulary file that the encoding queries use."""
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


@query("op1_bpe")
def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = bpe.encode(table(spark, sf_dir, "documents"), bpe_path(), decoded=True)
    return got.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                      F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"))


@query("op2_toxicity")
def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held_out = table(spark, sf_dir, "documents"), remainder("doc_id", 4) == 2
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), learn_from=~held_out)
    got = toxicity.score(docs, model)
    return got.select("doc_id", held_out.alias("held_out"), "score",
                      (F.col("score") >= TOXIC_SCORE).cast("int").alias("predicted"))


@query("op3_quality")
def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.classify(docs, model, host=F.col("source"), path=F.col("lang")).drop("text_hash")


@query("op4_sharding")
def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents"), SHARDS)


@query("op6_simhash")
def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, max_bits=3)
    return got.select("doc_id", "fingerprint", "component_id")


@query("op7_language")
def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held_out = table(spark, sf_dir, "documents"), remainder("doc_id", 5) == 0
    model = language.fit(docs, learn_from=~held_out)
    return language.predict(docs, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "rejected")


@query("op5_suffix_array", """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
-- every string of 100 bytes (200 hex digits) and where it starts
w AS (SELECT doc_id, i AS place, substr(h, 2 * i + 1, 200) AS s
      FROM (SELECT doc_id, h, unnest(range(0, greatest(len(h) // 2 - 99, 0))) AS i FROM d) x),
f AS (SELECT s, min(struct_pack(doc_id := doc_id, place := place)) AS first FROM w GROUP BY s HAVING count(*) > 1),
r AS (SELECT w.doc_id, w.place FROM w JOIN f USING (s)
      WHERE w.doc_id <> f.first.doc_id OR w.place <> f.first.place),
-- covered bytes: runs of starts no more than 100 apart
g AS (SELECT doc_id, place, lag(place) OVER (PARTITION BY doc_id ORDER BY place) AS before FROM r),
n AS (SELECT doc_id, place, sum(CASE WHEN place <= before + 100 THEN 0 ELSE 1 END)
        OVER (PARTITION BY doc_id ORDER BY place ROWS UNBOUNDED PRECEDING) AS run FROM g),
sp AS (SELECT doc_id, min(place) AS lo, max(place) + 100 AS hi FROM n GROUP BY doc_id, run),
-- what is kept before each run, and behind the last one
k AS (SELECT sp.doc_id, lo, hi, h, coalesce(lag(hi) OVER (PARTITION BY sp.doc_id ORDER BY lo), 0) AS kept_from
      FROM sp JOIN d USING (doc_id)),
a AS (SELECT doc_id, sum(hi - lo) AS n_removed, count(*) AS n_spans, max(hi) AS last,
             string_agg(substr(h, 2 * kept_from + 1, 2 * (lo - kept_from)), '' ORDER BY lo) AS kept
      FROM k GROUP BY doc_id)
SELECT d.doc_id, len(h) // 2 AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed,
       coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(CASE WHEN a.doc_id IS NULL THEN h ELSE kept || substr(h, 2 * last + 1) END)) AS kept_sha256
FROM d LEFT JOIN a ON a.doc_id = d.doc_id
""")
def op5_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = suffix_dedup.dedup(table(spark, sf_dir, "documents"))
    return got.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def piece_path() -> str:
    """The subword vocabulary of the lattices and of SentencePiece encoding."""
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


@query("op9_lattice_lm")
def op9_lattice_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = remainder("doc_id", 7) == 2
    got = lattice_lm.score(table(spark, sf_dir, "documents"), piece_path(), learn_from=~held_out)
    return got.select("doc_id", (~F.col("learn")).alias("held_out"), "n_tokens", "n_known", "train_tokens",
                      "base_score", "score")


# words of a text, and its distinct shingles of five words
_WORDS = r"list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda w: w <> '')"
_SHINGLES = """list_distinct(CASE WHEN len(ws) >= 5
    THEN list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' '))
    WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END)"""


@query("op10_decontamination", f"""
WITH items AS (SELECT item_id, {_SHINGLES} AS s FROM (SELECT DISTINCT item_id, text, {_WORDS} AS ws FROM benchmark)),
item_rows AS (SELECT item_id, len(s) AS n_shingles, unnest(s) AS g FROM items),
docs AS (SELECT doc_id, {_SHINGLES} AS s FROM (SELECT DISTINCT doc_id, text, {_WORDS} AS ws FROM documents)),
doc_rows AS (SELECT doc_id, unnest(s) AS g FROM docs)
SELECT doc_id, item_id, n_shingles, count(*) AS n_shared, count(*) / n_shingles::DOUBLE AS containment
FROM doc_rows JOIN item_rows USING (g)
GROUP BY doc_id, item_id, n_shingles HAVING count(*) >= 0.8 * n_shingles
""")
def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("text_hash")


@query("op8_neighbours")
def op8_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.neighbours(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


@query("op11_sentencepiece")
def op11_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = pieces.encode(table(spark, sf_dir, "documents"), piece_path(), decoded=True)
    return got.select("doc_id", "n_tokens",
                      F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
                      F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"),
                      F.element_at("bounds", -1).cast("long").alias("n_bytes"))


@query("op12_filter_audit", r"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws, min(doc_id) OVER (PARTITION BY t) AS first FROM d),
f AS (SELECT doc_id, part, CASE WHEN len(ws) < 50 THEN 'A' ELSE '' END
        || CASE WHEN 100 * len(list_distinct(ws)) < 65 * len(ws) THEN 'B' ELSE '' END
        || CASE WHEN 100 * len(regexp_extract_all(t, '[A-Z]')) > 5 * length(t) THEN 'C' ELSE '' END
        || CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END
        || CASE WHEN doc_id > first THEN 'E' ELSE '' END AS failed FROM w),
l AS (SELECT doc_id, max(quality = 1) AS good, max(toxic = 1) AS toxic FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
c AS (SELECT part, failed, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
      FROM f LEFT JOIN l ON l.doc_id = f.doc_id GROUP BY part, failed),
x AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS k),
o AS (SELECT a.k || b.k || c.k || d.k || e.k AS filter_order FROM x a, x b, x c, x d, x e
      WHERE len(list_distinct([a.k, b.k, c.k, d.k, e.k])) = 5),
s AS (SELECT filter_order, step::INTEGER AS step, filter_order[step] AS k, filter_order[1:step - 1] AS earlier
      FROM o, range(1, 6) r(step)),
-- every order run over every set of failures: nothing is shared between orders
m AS (SELECT c.part, filter_order, step, k, n, good, toxic, contains(failed, k) AS hit, failed = k AS alone,
             earlier <> '' AND regexp_matches(failed, '[' || earlier || 'z]') AS gone FROM c, s),
t AS (SELECT part, filter_order, step, k, sum(CASE WHEN NOT hit AND NOT gone THEN n ELSE 0 END)::BIGINT AS kept,
             sum(CASE WHEN hit AND NOT gone THEN n ELSE 0 END)::BIGINT AS removed,
             sum(CASE WHEN hit AND gone THEN n ELSE 0 END)::BIGINT AS redundant,
             sum(CASE WHEN alone THEN n ELSE 0 END)::BIGINT AS unique_fails,
             sum(CASE WHEN hit AND NOT gone THEN good ELSE 0 END)::BIGINT AS good_lost,
             sum(CASE WHEN hit AND NOT gone THEN toxic ELSE 0 END)::BIGINT AS toxic_lost FROM m GROUP BY ALL)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       (sum(removed) OVER (PARTITION BY part, k))::BIGINT AS shapley FROM t
""")
def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit_texts(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), F.col("source"))


# crc32 of a decimal id: one step per byte (>= 0) and eight shifts (-1) behind it
_CRC = """xor(list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(
    string_split(doc_id::VARCHAR, ''), lambda c: [ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
    lambda a, e: CASE WHEN e >= 0 THEN xor(a, e) ELSE xor(a >> 1, 3988292384 * (a & 1)) END), 4294967295)"""


def _field(c: str) -> str:
    return f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen({c}::VARCHAR) || ':' || {c}::VARCHAR END"


_LEAF = "sha256(" + " || ".join(map(_field, ("doc_id", "source", "lang", "n_chars"))) + " || {text})"


@query("op13_merkle", f"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, {_LEAF.format(text=_field("text"))} AS leaf,
         CASE WHEN {_CRC} % 2 = 0 THEN {_LEAF.format(text=_field("replace(text, chr(10), '')"))}
              ELSE {_LEAF.format(text=_field("text"))} END AS fresh
  FROM documents),
l AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx,
             count(*) OVER (PARTITION BY source) AS n, coalesce(source, chr(1)) AS tree FROM d),
up(tree, level, idx, n, h) AS (
  SELECT tree, 0, idx, n, leaf FROM l
  UNION ALL
  SELECT tree, level + 1, idx // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY idx))
  FROM up WHERE n > 1 GROUP BY tree, level, idx // 3, n),
s AS (SELECT tree, h, row_number() OVER (ORDER BY tree <> chr(1), encode(tree)) - 1 AS idx, count(*) OVER () AS n
      FROM up WHERE n = 1),
over(level, idx, n, h) AS (
  SELECT 0, idx, n, h FROM s
  UNION ALL
  SELECT level + 1, idx // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY idx))
  FROM over WHERE n > 1 GROUP BY level, idx // 3, n),
-- both trees as runs (tree, level, run), and every leaf's place in them
nodes AS (SELECT tree, level, idx, h FROM up WHERE n > 1 UNION ALL SELECT '', 100 + level, idx, h FROM over WHERE n > 1),
sides AS (SELECT a.tree, a.level, a.idx, coalesce(string_agg(b.h, '' ORDER BY b.idx) FILTER (b.idx < a.idx), '') AS lhs,
                 coalesce(string_agg(b.h, '' ORDER BY b.idx) FILTER (b.idx > a.idx), '') AS rhs
          FROM nodes a JOIN nodes b ON b.tree = a.tree AND b.level = a.level AND b.idx // 3 = a.idx // 3
          GROUP BY a.tree, a.level, a.idx),
met AS (SELECT l.tree AS home, l.idx AS place, sides.level, lhs, rhs
       FROM l JOIN sides ON sides.tree = l.tree AND sides.idx = l.idx // (3 ** sides.level)::BIGINT
       UNION ALL
       SELECT l.tree, l.idx, sides.level, lhs, rhs
       FROM l JOIN s ON s.tree = l.tree JOIN sides ON sides.tree = '' AND sides.idx = s.idx // (3 ** (sides.level - 100))::BIGINT),
steps AS (SELECT *, row_number() OVER (PARTITION BY home, place ORDER BY level) AS k FROM met),
folded(home, place, k, h) AS (
  SELECT tree, idx, 0, fresh FROM l
  UNION ALL
  SELECT f.home, f.place, f.k + 1, sha256(lhs || h || rhs)
  FROM folded f JOIN steps ON steps.home = f.home AND steps.place = f.place AND steps.k = f.k + 1),
ends AS (SELECT home, place, arg_max(h, k) AS h FROM folded GROUP BY home, place),
proofs AS (SELECT home, place, string_agg(lhs || rhs, '' ORDER BY k) AS p FROM steps GROUP BY home, place)
SELECT l.doc_id, l.leaf, s.h AS subroot, o.h AS root, sha256(coalesce(p.p, '')) AS proof_sha256, e.h AS folded_root,
       e.h = o.h AS verified
FROM l JOIN s ON s.tree = l.tree JOIN ends e ON e.home = l.tree AND e.place = l.idx
LEFT JOIN proofs p ON p.home = l.tree AND p.place = l.idx, (SELECT h FROM over WHERE n = 1) o
""")
def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    tampered = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(2)) == 0
    got = merkle.manifest(table(spark, sf_dir, "documents"), ["doc_id", "source", "lang", "n_chars", "text"], "source",
                          changed=tampered, today={"text": F.replace("text", F.lit("\n"), F.lit(""))})
    return got.select("doc_id", "leaf", "subroot", "root", merkle.proof(F.col("path")).alias("proof_sha256"),
                      "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))
