"""Benchmark decontamination: size-partitioned MinHash containment search.

Documents and test items become sets of hashed shingles of five words.  A
document's sketch is a one-permutation MinHash: the top bits of the hash are the
bin, the least hash of each bin stays.  How many bits depends on the document's
size (at least two bins per shingle), so a short item inside a long document
still finds most of its shingles among the minima: each of them is one with a
chance of at least 0.78, and an item of ``q`` shingles held to 0.8 is missed
with a chance of 0.22 ** (0.8 q) at most, below one in a million for ``SMALL``
shingles or more.  If the benchmark has smaller items, all shingles of a
document are its sketch and none is missed.

Sorted hashes give all sizes at once: a hash is the least of its bin exactly if
its predecessor has other top bits.  So the item side needs no copy per size:
each item hash carries the number of bits from which on it is a minimum of the
item, and a plain equi-join on the hash, with the bits compared, finds bins that
agree.  Items larger than a document could hold are no candidates.  Candidate
pairs are then verified by exact containment of the shingle texts.

Only built-in column functions.  The item side is broadcast after a check of
its size (rows of 24 bytes), beyond it Spark joins by shuffle.

Edge cases: words are runs of letters and digits, lower-cased; a text of one to
four words is one shingle of them all; null and word-less texts have no shingle
and never match; documents with the same id and text count as one, also null
ids; repeated items likewise; empty tables give an empty result; other columns
are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.broadcast import bounded_broadcast

SHINGLE = 5
SIMILARITY = 0.8
SMALL = 11        # 0.22 ** (0.8 * 11) is below 2 in a million
BITS_BEYOND = 1   # bins: twice the shingles, rounded up to a power of two
ITEM_ROWS = 1_000_000


def words(text: str) -> Column:
    return F.filter(F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def shingle_texts(ws: Column, k: int = SHINGLE) -> Column:
    """Distinct shingles as texts."""
    many = F.transform(F.sequence(F.lit(1), F.size(ws) - k + 1), lambda i: F.array_join(F.slice(ws, i, k), " "))
    return F.array_distinct(F.when(F.size(ws) >= k, many).when(F.size(ws) > 0, F.array(F.array_join(ws, " ")))
                            .otherwise(F.array().cast("array<string>")))


def shingle_hashes(ws: Column, k: int = SHINGLE) -> Column:
    """Distinct shingle hashes in ascending order.  A hash of word hashes: no
    text is built; the sign bit is cleared so that bits shift as expected."""
    codes = F.transform(ws, lambda w: F.xxhash64(w))

    def of_codes(c):
        many = F.transform(F.sequence(F.lit(0), F.size(c) - k),
                           lambda i: F.xxhash64(*[F.get(c, i + j) for j in range(k)]))
        some = F.when(F.size(c) >= k, many).when(F.size(c) > 0, F.array(F.xxhash64(F.array_join(
            F.transform(c, lambda x: x.cast("string")), " ")))).otherwise(F.array().cast("array<long>"))
        return F.array_sort(F.array_distinct(F.transform(some, lambda h: F.shiftrightunsigned(h, 1))))

    # evaluated once: the codes are bound to a variable of the outer lambda
    return F.transform(F.array(codes), of_codes)[0]


def bits_for(n: Column) -> Column:
    """Bin bits for a set of n shingles, of 63."""
    return F.least(F.lit(63), F.ceil(F.log2(F.greatest(n, F.lit(1)).cast("double"))).cast("int") + BITS_BEYOND)


def sketch(hashes: Column, bits: Column) -> Column:
    """The least hash of each bin: those whose predecessor has other top bits."""
    shift = F.lit(63) - bits
    return F.filter(hashes, lambda h, i: (i == 0) | (F.call_function("shiftright", h, shift) != F.call_function(
        "shiftright", F.get(hashes, i - 1), shift)))


def item_sketches(items: DataFrame) -> DataFrame:
    """``ik, q, h, least_bits``: every hash of an item with the number of bits
    from which on it is the least of its bin."""
    h = items.select("ik", F.size("hs").alias("q"), "hs", F.posexplode("hs").alias("i", "h"))
    # top bits shared with the predecessor, of 63
    other = F.col("h").bitwiseXOR(F.get("hs", F.col("i") - 1))
    least = F.when(F.col("i") == 0, F.lit(0)).otherwise(F.lit(64) - F.length(F.bin(other)))
    return h.select("ik", "q", "h", least.cast("int").alias("least_bits"))


def leaks(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text",
          item_id: str = "item_id", item_text: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """``doc_id, item_id, n_shingles, n_shared, containment, text_hash``: the
    documents that hold at least ``similarity`` of an item's shingles."""
    items = (items.select(F.col(item_id).alias("item_id"), F.xxhash64(item_text).alias("_th"), words(item_text).alias("ws"))
             .where(F.size("ws") > 0).dropDuplicates(["item_id", "_th"])
             .select("item_id", F.xxhash64("item_id", "_th").alias("ik"), shingle_texts(F.col("ws")).alias("texts"),
                     shingle_hashes(F.col("ws")).alias("hs")))
    small = not items.where(F.size("hs") < SMALL).isEmpty()
    wanted = item_sketches(items)
    key = [F.col(doc_id).cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash")]
    sized = (docs.select(*key, F.explode(F.array(shingle_hashes(words(text)))).alias("hs"))
             .select("doc_id", "text_hash", "hs", F.size("hs").alias("m")))
    bits = F.lit(63) if small else bits_for(F.col("m"))
    minima = F.col("hs") if small else sketch(F.col("hs"), F.col("bits"))
    sketches = (sized.withColumn("bits", bits)
                .select("doc_id", "text_hash", "m", "bits", F.explode(minima).alias("h")))
    found = (sketches.join(bounded_broadcast(wanted, ITEM_ROWS), "h")
             .where((F.col("least_bits") <= F.col("bits")) & (F.ceil(F.col("q") * similarity) <= F.col("m")))
             .select("doc_id", "text_hash", "ik").distinct())
    texts = items.select("ik", "item_id", "texts")
    candidates = found.join(bounded_broadcast(texts, ITEM_ROWS // 50), "ik")
    bodies = docs.select(*key, F.col(text).alias("body"))
    shared = F.size(F.array_intersect(shingle_texts(F.col("ws")), F.col("texts")))
    c, b = candidates.alias("c"), bodies.alias("b")
    checked = (b.join(c, F.col("b.doc_id").eqNullSafe(F.col("c.doc_id")) & (F.col("b.text_hash") == F.col("c.text_hash")))
               .select("b.doc_id", "b.text_hash", "c.item_id", "c.ik", "c.texts", F.explode(F.array(words("b.body"))).alias("ws"))
               .select("doc_id", "text_hash", "item_id", "ik", F.size("texts").cast("long").alias("n_shingles"),
                       shared.cast("long").alias("n_shared"))
               .where(F.col("n_shared") >= F.col("n_shingles") * similarity)
               .dropDuplicates(["doc_id", "text_hash", "ik"]))
    return checked.select("doc_id", "item_id", "n_shingles", "n_shared",
                          (F.col("n_shared") / F.col("n_shingles")).alias("containment"), "text_hash")
