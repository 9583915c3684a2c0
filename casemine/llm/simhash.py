"""SimHash near-duplicates with pivot distance tables.

1. Fingerprint: words of the lower-cased (A-Z) text, shingles of ``shingle``
   words with repeats, XXH64 (seed 42) of each; a bit is 1 if it is set in over
   half of the hashes.  Vectorised per text inside ``mapInArrow``.
2. Equal fingerprints collapse to one node (partial aggregation), so copies
   never meet in pairs.
3. Two fingerprints that differ in at most k bits agree on at least two of
   k + 2 bit blocks.  Each fingerprint goes to one bucket per pair of blocks;
   a bucket holds what agrees on both.  Buckets above ``BUCKET_ROWS`` are dealt
   again by further blocks of the remaining bits, of which at least one of
   k + 1 must agree.
4. Inside a bucket every fingerprint has its row of Hamming distances to the
   reference fingerprints.  By the triangle inequality two fingerprints are at
   least as far apart as their rows differ in any coordinate: pairs whose
   largest difference exceeds k are discarded, the others are verified bit by
   bit.  Larger buckets are sorted by the first coordinate and compared in
   blocks of rows within its reach.
5. Links of a task fold into a forest (at most one edge per row) before they
   leave it; connected components join them.

Edge cases: null and word-less texts have fingerprint zero and link like any
other; null doc_ids never name a component (null only if no member has an id);
repeated rows come out once per row; an empty table gives an empty result;
columns other than the id and text are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, map_slices
from .components import components

SEED = 42
BITS = 64
REFERENCES = 32
BUCKET_ROWS = 20_000
NEAR = 48   # rows of a bucket up to which all its pairs are formed at once
BLOCK = 256  # rows of a larger bucket that are compared at a time
HASHES = 1 << 16  # shingle hashes expanded to bits at a time
PIECE_BYTES = 4 << 20
BLANK = re.compile(rb"[\x20\x09-\x0d]")


def fingerprint(text: str | None, shingle: int = 3) -> int:
    from xxhash import xxh64_intdigest
    raw = (text or "").encode("utf-8", "replace")
    ones, n, last = np.zeros(BITS, dtype=np.int64), 0, []
    for words in _words(raw):
        words = last + words
        last = words[max(0, len(words) - shingle + 1):] if shingle > 1 else []
        grams = map(b" ".join, zip(*(words[i:] for i in range(shingle))))
        hashes = np.fromiter(map(xxh64_intdigest, grams, repeat(SEED)), dtype=">u8")
        n += len(hashes)
        for at in range(0, len(hashes), HASHES):
            some = hashes[at:at + HASHES]
            ones += np.unpackbits(some.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    if not n:  # fewer words than a shingle has
        return xxh64_intdigest(b" ".join(last), SEED) if last else 0
    return int.from_bytes(np.packbits(ones * 2 > n).tobytes(), "big")


def _words(raw: bytes) -> Iterator[list[bytes]]:
    """Lower-cased words, some megabytes of text at a time, cut after a word.
    bytes.lower and bytes.split know ASCII letters and the six blanks only."""
    at = 0
    while at < len(raw):
        end = at + PIECE_BYTES
        if end < len(raw):
            blank = BLANK.search(raw, end)
            end = blank.start() if blank else len(raw)
        yield raw[at:end].lower().split()
        at = end


def fingerprints(docs: DataFrame, shingle: int = 3, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, text_hash, fp`` (the fingerprint as a signed long) per row."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"),
                       F.xxhash64(F.col(text)).alias("text_hash"), F.col(text).alias("text"))

    def run(batch: pa.RecordBatch) -> dict:
        fps = np.array([fingerprint(t, shingle) for t in batch.column(2).to_pylist()], dtype=np.uint64)
        return {"doc_id": batch.column(0), "text_hash": batch.column(1), "fp": pa.array(fps.view(np.int64))}

    return map_slices(rows, run, "doc_id long, text_hash long, fp long")


def references(n: int = REFERENCES) -> np.ndarray:
    """Reference fingerprints, far from each other by chance."""
    return np.random.default_rng(SEED).integers(0, 1 << 63, n, dtype=np.uint64) << np.uint64(1) ^ \
        np.random.default_rng(SEED + 1).integers(0, 1 << 63, n, dtype=np.uint64)


def distance_table(fps: np.ndarray, refs: np.ndarray) -> np.ndarray:
    """Hamming distance of every fingerprint to every reference."""
    return np.bitwise_count(fps[:, None] ^ refs[None, :]).astype(np.int8)


def _fold(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Give linked rows the smallest label among them, in place."""
    while len(a):
        la, lb = labels[a], labels[b]
        differ = la != lb
        if not differ.any():
            return
        a, b, la, lb = a[differ], b[differ], la[differ], lb[differ]
        low, high = np.minimum(la, lb), np.maximum(la, lb)
        np.minimum.at(labels, high, low)
        while True:  # every label points to a root
            up = labels[labels]
            if (up == labels).all():
                break
            labels[:] = up


def _survivors(fps: np.ndarray, table: np.ndarray, a: np.ndarray, b: np.ndarray, k: int):
    """Pairs left after the pivot test, verified."""
    for c in range(0, table.shape[1], 4):
        ok = (np.abs(table[a, c:c + 4] - table[b, c:c + 4]) <= k).all(axis=1)
        a, b = a[ok], b[ok]
        if not len(a):
            return a, b
    ok = np.bitwise_count(fps[a] ^ fps[b]) <= k
    return a[ok], b[ok]


def link_sorted(keys: np.ndarray, fps: np.ndarray, k: int, refs: np.ndarray) -> np.ndarray:
    """Label of each row (the first row it is linked to) among rows sorted by
    bucket key; rows of different buckets are never compared."""
    n = len(keys)
    labels = np.arange(n)
    start = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if n else np.zeros(0, dtype=int)
    size = np.diff(np.r_[start, n])
    table = np.zeros((n, len(refs)), dtype=np.int8)
    busy = np.repeat(size > 1, size)
    table[busy] = distance_table(fps[busy], refs)
    left = np.repeat(start + size, size) - np.arange(n)  # rows to the bucket's end
    small = np.repeat(size <= NEAR, size)
    for d in range(1, min(NEAR, int(size.max(initial=1)))):
        a = np.flatnonzero(small & (left > d))
        if not len(a):
            break
        _fold(labels, *_survivors(fps, table, a, a + d, k))
    for s, m in zip(start[size > NEAR], size[size > NEAR]):
        rows = s + np.argsort(table[s:s + m, 0], kind="stable")
        first = table[rows, 0]
        for at in range(0, m, BLOCK):
            end = min(m, at + BLOCK)
            stop = int(np.searchsorted(first, first[end - 1] + k, side="right"))
            mine, others = rows[at:end], rows[at:stop]
            for o in range(0, len(others), 4096):
                part = others[o:o + 4096]
                near = np.ones((len(mine), len(part)), dtype=bool)
                for c in range(4):
                    near &= np.abs(table[mine, c][:, None] - table[part, c][None, :]) <= k
                i, j = np.nonzero(near)
                ok = mine[i] != part[j]
                _fold(labels, *_survivors(fps, table, mine[i[ok]], part[j[ok]], k))
    return labels


def _block_masks(bits: list[int], blocks: int) -> list[int]:
    """Deal bit positions into ``blocks`` runs of near-equal length."""
    edge = [len(bits) * i // blocks for i in range(blocks + 1)]
    return [sum(1 << b for b in bits[edge[i]:edge[i + 1]]) for i in range(blocks)]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _buckets(nodes: DataFrame, k: int) -> DataFrame:
    """``key, fp``: a row per fingerprint and pair of blocks."""
    masks = _block_masks(list(range(BITS)), k + 2)
    pairs = [_signed(a | b) for a, b in combinations(masks, 2)]
    keys = F.array(*[F.xxhash64(F.lit(i), F.col("fp").bitwiseAND(F.lit(m))) for i, m in enumerate(pairs)])
    out = nodes.select("fp", F.posexplode(keys).alias("pair", "key"))
    hot = out.groupBy("pair", "key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > BUCKET_ROWS)
    hot = cut(hot.select("pair", "key"))
    if hot.isEmpty():
        return out.select("key", "fp")
    calm = out.join(hot, ["pair", "key"], "left_anti")
    # the other bits of a pair's bucket, in k + 1 blocks: one of them agrees
    rest = [[_signed(m) for m in _block_masks([b for b in range(BITS) if not (p >> b) & 1], k + 1)]
            for p in (x & ((1 << 64) - 1) for x in pairs)]
    table = F.array(*[F.array(*[F.lit(m) for m in r]) for r in rest])
    finer = (out.join(hot, ["pair", "key"]).select("key", "fp", F.posexplode(table[F.col("pair")]).alias("i", "m"))
             .select(F.xxhash64("key", "i", F.col("fp").bitwiseAND(F.col("m"))).alias("key"), "fp"))
    return calm.select("key", "fp").unionByName(finer)


def links(nodes: DataFrame, max_bits: int = 3) -> DataFrame:
    """``a, b``: links between distinct fingerprints (column ``fp``), a forest
    per task that connects whatever lies within ``max_bits``."""
    refs = references()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = fps = np.zeros(0, dtype=np.int64)

        def emit(keys, fps):
            label = link_sorted(keys, fps.view(np.uint64), max_bits, refs)
            moved = label != np.arange(len(label))
            return pa.RecordBatch.from_arrays([pa.array(fps[moved]), pa.array(fps[label[moved]])], ["a", "b"])

        for batch in batches:
            keys = np.r_[keys, batch.column(0).to_numpy()]
            fps = np.r_[fps, batch.column(1).to_numpy()]
            done = int(np.searchsorted(keys, keys[-1])) if len(keys) else 0  # the last bucket may go on
            if done:
                yield emit(keys[:done], fps[:done])
                keys, fps = keys[done:], fps[done:]
        if len(keys):
            yield emit(keys, fps)

    dealt = _buckets(nodes, max_bits).repartition("key").sortWithinPartitions("key", "fp")
    return dealt.mapInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, shingle: int = 3, max_bits: int = 3, doc_id: str = "doc_id",
                    text: str = "text") -> DataFrame:
    """``doc_id, fingerprint, component_id, text_hash, group`` per row; the
    last two (hash of the text, a fingerprint of the component) name rows and
    components that have no id."""
    rows = cut(fingerprints(docs, shingle, doc_id, text))
    nodes = cut(rows.groupBy("fp").agg(F.min("doc_id").alias("least")))
    found = components(links(nodes, max_bits))
    named = nodes.join(found.withColumnRenamed("node", "fp"), "fp", "left") \
        .select("fp", F.coalesce("root", "fp").alias("group"), "least")
    named = cut(named)
    ids = cut(named.groupBy("group").agg(F.min("least").alias("component_id")))
    of_fp = cut(named.select("fp", "group").join(ids, "group"))
    return rows.join(of_fp, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", "text_hash", "group")
