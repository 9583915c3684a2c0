"""EM LDA over blocks of documents.

The same expectation-maximisation as Spark ML's ``em`` optimizer: every entry
(document, term, n) is dealt over the topics in proportion to (the term's count
+ beta - 1) (the document's count + alpha - 1) / (the topic's total + (beta - 1) V),
and the counts are the sums of what was dealt, the first time at random.  Spark
ML keeps a graph with a vertex per document and term and sends messages along
every entry in every iteration; here the entries of a range of documents are one
block of columns that stays where it is:

* documents are dealt by hash into blocks of about ``BLOCK_ENTRIES`` entries; a
  block holds its documents' counts and those of the terms that occur nowhere
  else (its entries are as many as the term's document frequency);
* documents given as token lists are moved once, compressed; a block numbers its
  different tokens, and only those are joined with the vocabulary.  An entry is
  kept as the place of its term in the block (4 bytes);
* of the other terms a block sends one sum per term and iteration to the term's
  share of the vocabulary, which adds up and sends back: two shuffles of sums,
  none of entries; to the driver come the topics' totals.  What a shuffle wrote
  is deleted as soon as the step that read it is stored; the blocks are in the
  checkpoint folder, so that what is lost can be made again.

The random start is a hash of document, term and seed: it doesn't depend on
the partitioning.  Neither vocabulary nor counts are ever whole in one task.
"""

from __future__ import annotations

import math
import pickle
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import StorageLevel, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import clean_shuffles, collect_garbage, drop_path, ensure_checkpoint_dir

BLOCK_ENTRIES = 4_000_000
LEAST_ENTRIES = 100_000  # smaller blocks only cost messages
CHECKPOINT_EVERY = 10
ROWS = 500_000  # of a written batch
SLICE = 1 << 20  # entries that a block's task takes up at a time
HELD = 64 << 20  # bytes of tokens a task holds before it sends them on
BETWEEN = "\n"  # tokens that are moved as one text; none has a line end


def _same(key: int) -> int:
    return key


def _mixed(x: np.ndarray) -> np.ndarray:
    """Well-mixed 64 bits of 64 bits (splitmix64)."""
    x = x + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _block(lens: np.ndarray, keys: np.ndarray, words: np.ndarray, at: np.ndarray, n: np.ndarray, df: np.ndarray,
           shares: int) -> dict:
    """A block of entries in the order of their documents: ``at`` is the place of
    an entry's term in ``words`` (ascending), ``n`` a number per term or entry."""
    here = np.zeros(len(words), np.int64)
    for i in range(0, len(at), SLICE):
        here += np.bincount(at[i:i + SLICE], minlength=len(words))
    shared = np.flatnonzero(here < df)
    shared = shared[np.argsort(words[shared] % shares, kind="stable")]
    return {"lens": lens.astype(np.int32), "at": _shrunk(at), "n": n, "words": words,
            "keys": keys, "own": np.flatnonzero(here >= df), "shared": shared,
            "ends": np.searchsorted(words[shared] % shares, np.arange(shares + 1))}


def _shrunk(at: np.ndarray) -> tuple[int, bytes]:
    """Places, which rise within a document, as compressed differences."""
    return len(at), pa.compress(np.diff(at.astype(np.int32, copy=False), prepend=np.int32(0)), "zstd", asbytes=True)


def _at(block: dict) -> np.ndarray:
    n, data = block["at"]
    return np.cumsum(np.frombuffer(pa.decompress(data, 4 * n, "zstd"), np.int32), dtype=np.int32)


def _doc(block: dict) -> np.ndarray:
    return np.repeat(np.arange(len(block["lens"]), dtype=np.int32), block["lens"])


def _n(block: dict, at: np.ndarray) -> np.ndarray:
    return block["n"] if len(block["n"]) == len(at) else block["n"][at]


def _cuts(ends: np.ndarray):
    """Ranges of documents, which end at these entries, of about ``SLICE`` entries."""
    a = 0
    while a < len(ends):
        b = min(int(np.searchsorted(ends, (ends[a - 1] if a else 0) + SLICE)) + 1, len(ends))
        yield a, b
        a = b


def _slices(block: dict):
    """(range of documents, documents and terms of their entries, numbers)."""
    at, ends = _at(block), np.cumsum(block["lens"], dtype=np.int64)
    for a, b in _cuts(ends):
        first, last = int(ends[a - 1]) if a else 0, int(ends[b - 1])
        mine = at[first:last].astype(np.int64)
        yield (a, b, np.repeat(np.arange(a, b), block["lens"][a:b]), mine,
               block["n"][first:last] if len(block["n"]) == len(at) else block["n"][mine])


def _pack(shares: int):
    """Function from the rows of a partition to its block."""
    def run(batches):
        got = [b for b in batches if b.num_rows]
        if not got:
            return
        case, key, term, n, df = (pa.concat_arrays([b.column(i) for b in got]) for i in range(5))
        doc = case.dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
        key, term, n, df = (x.to_numpy(zero_copy_only=False) for x in (key, term, n, df))
        order = np.lexsort((term, doc))
        doc, key, term, n, df = (x[order] for x in (doc, key, term, n, df))
        new = np.ones(len(doc), bool)  # a term counts once per document
        new[1:] = (doc[1:] != doc[:-1]) | (term[1:] != term[:-1])
        doc, key, term, n, df = (x[new] for x in (doc, key, term, n, df))
        words, first, at = np.unique(term, return_index=True, return_inverse=True)
        if len(words) < len(n) and np.array_equal(n[first][at], n):
            n = n[first]
        first_of, lens = np.unique(doc, return_index=True, return_counts=True)[1:]
        block = _block(lens, key[first_of], words, at, n, df[first], shares)
        yield pa.RecordBatch.from_arrays(
            [pa.array([TaskContext.get().partitionId()], pa.int32()),
             pa.array([pickle.dumps(block, protocol=5)], pa.binary())], names=["block", "payload"])
    return run


def _packets(held: dict):
    """A row (block, payload) of Arrow rows for each block."""
    for d, rows in held.items():
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, rows[0].schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
            out.write_table(pa.Table.from_batches(rows).combine_chunks())
        yield pa.RecordBatch.from_arrays([pa.array([d], pa.int32()), pa.array([sink.getvalue().to_pybytes()], pa.binary())],
                                         names=["block", "payload"])


def _unpacked(payloads: list[bytes]) -> list[pa.Array]:
    """The columns of packets, the same whatever order they came in."""
    rows = pa.concat_tables([pa.ipc.open_stream(p).read_all() for p in sorted(payloads)])
    return [c.chunk(0) if c.num_chunks == 1 else pa.concat_arrays(c.chunks) for c in rows.columns]


def _sorted_out(batch: pa.RecordBatch, block: np.ndarray, held: dict) -> None:
    """Adds a batch's rows to those held for their blocks."""
    order = np.argsort(block, kind="stable")
    rows, block = batch.take(pa.array(order)), block[order]
    starts = np.flatnonzero(np.r_[True, block[1:] != block[:-1]])
    for a, b in zip(starts, [*starts[1:], len(block)]):
        held[int(block[a])].append(rows.slice(a, b - a))


def _deal(shares: int):
    """Function from (case_id, key, text) to packets of the blocks."""
    def run(batches):
        held, size = defaultdict(list), 0
        for batch in batches:
            if batch.num_rows:
                key = batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64)
                _sorted_out(batch, (_mixed(key) % np.uint64(shares)).astype(np.int32), held)
                size += batch.nbytes
            if size > HELD:
                yield from _packets(held)
                held, size = defaultdict(list), 0
        yield from _packets(held)
    return run


def _told_apart(batches):
    """From (block, code, term_id, n, df) to packets of the blocks."""
    held, rows = defaultdict(list), 0
    for batch in batches:
        if batch.num_rows:
            _sorted_out(batch.select(batch.schema.names[1:]), batch.column(0).to_numpy(zero_copy_only=False), held)
            rows += batch.num_rows
        if rows > ROWS:
            yield from _packets(held)
            held, rows = defaultdict(list), 0
    yield from _packets(held)


def _coded(items):
    """The documents of a block with their tokens numbered."""
    for d, payloads in _by_key(items).items():
        case, key, text = _unpacked(payloads)
        payloads.clear()
        of_row = case.dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
        tokens = pc.split_pattern(text, BETWEEN)
        del text
        lens = tokens.value_lengths().to_numpy(zero_copy_only=False)
        flat = tokens.flatten().dictionary_encode()
        del tokens
        found = flat.dictionary
        pair = np.repeat(of_row.astype(np.int64) * len(found), lens)
        pair += flat.indices.to_numpy(zero_copy_only=False)
        del flat
        pa.default_memory_pool().release_unused()
        pair.sort()
        new = np.ones(len(pair), bool)  # a token counts once per document
        np.not_equal(pair[1:], pair[:-1], out=new[1:])
        if not new.all():
            pair = pair[new]
        keys = np.zeros(int(of_row.max()) + 1, np.int64)
        keys[of_row] = key.to_numpy(zero_copy_only=False)
        lens = np.diff(np.searchsorted(pair, np.arange(len(keys) + 1) * len(found)))
        pair %= len(found)
        yield d, ("coded", lens, pair.astype(np.int32), keys, found)


def _identified(shares: int):
    """Function from a block's numbered tokens and what the vocabulary says of
    them to the block."""
    def run(items):
        for d, got in _by_key(items).items():
            _, lens, code, keys, found = next(x for x in got if x[0] == "coded")
            ids = [x[1] for x in got if x[0] == "ids"]
            got.clear()
            if not ids:
                continue
            mine, term, n, df = (c.to_numpy(zero_copy_only=False) for c in _unpacked(ids))
            order = np.argsort(term)
            place = np.full(len(found), -1, np.int32)
            place[mine[order]] = np.arange(len(order), dtype=np.int32)
            at = place[code]
            del code
            known = at >= 0
            if not known.all():
                ends = np.r_[0, np.cumsum(known)][np.r_[0, np.cumsum(lens)]]
                at, lens = at[known], np.diff(ends)
            there = lens > 0  # documents without terms aren't counted
            lens, keys = lens[there], keys[there]
            ends = np.cumsum(lens)
            for a, b in _cuts(ends):  # a document's places rise
                first = int(ends[a - 1]) if a else 0
                pair = np.repeat(np.arange(b - a) * len(order), lens[a:b]) + at[first:ends[b - 1]]
                pair.sort()
                at[first:ends[b - 1]] = pair % len(order)
            n = n[order]
            if len(n) == len(at):  # as many as entries: by entry
                n = n[at]
            block = _block(lens, keys, term[order], at, n, df[order], shares)
            pa.default_memory_pool().release_unused()
            yield d, ("block", block)
    return run


def _by_key(items) -> dict:
    found: dict = defaultdict(list)
    for key, item in items:
        found[key].append(item)
    return found


def _dealt(d: int, block: dict, k: int, shares_of):
    """What a block makes of its entries' shares (``shares_of`` documents and
    terms, a column per topic): its state, its part of the topics' totals and the
    sums it sends out."""
    of_doc, of_word = np.zeros((len(block["keys"]), k)), np.zeros((len(block["words"]), k))
    for first, last, doc, at, n in _slices(block):
        share = shares_of(doc, at)
        whole = share[0].copy()
        for s in share[1:]:
            whole += s
        np.divide(n, whole, out=whole)
        doc -= first
        for j, s in enumerate(share):
            s *= whole
            of_doc[first:last, j] = np.bincount(doc, s, last - first)
            of_word[:, j] += np.bincount(at, s, len(of_word))
    yield d, ("state", of_doc, of_word[block["own"]])
    yield d, ("total", of_word.sum(axis=0))
    for t, (a, b) in enumerate(zip(block["ends"], block["ends"][1:])):
        if a < b:
            at = block["shared"][a:b]
            yield t, ("sums", d, (block["words"][at] // len(block["ends"][1:])).astype(np.int32), of_word[at])


def _start(k: int, seed: int):
    def run(items):
        for d, (_, block) in items:
            keys = _mixed(block["keys"].view(np.uint64) + np.uint64(seed))
            words = block["words"].astype(np.uint64)

            def shares_of(doc, at):
                base = _mixed(keys[doc] ^ words[at])
                return [(_mixed(base + np.uint64(j + 1)) >> np.uint64(11)) * 2.0 ** -53 + 1e-12 for j in range(k)]

            yield from _dealt(d, block, k, shares_of)
    return run


def _iterate(k: int, totals: list[float], vocab_size: int, alpha: float, beta: float):
    below = np.array(totals) + (beta - 1) * vocab_size

    def run(items):
        for d, got in _by_key(items).items():
            block = next(x[1] for x in got if x[0] == "block")
            of_doc, own = next(x[1:] for x in got if x[0] == "state")
            of_word = np.zeros((len(block["words"]), k))
            of_word[block["own"]] = own
            for x in got:
                if x[0] == "told":
                    t = x[1]
                    of_word[block["shared"][block["ends"][t]:block["ends"][t + 1]]] = x[2]
            got.clear()
            for_words = [of_word[:, j] + (beta - 1) for j in range(k)]
            for_docs = [(of_doc[:, j] + (alpha - 1)) / below[j] for j in range(k)]
            yield from _dealt(d, block, k, lambda doc, at: [w[at] * f[doc] for w, f in zip(for_words, for_docs)])
    return run


def _added(sums: list):
    """(blocks' parts in the order of blocks, places in the share, sums there)."""
    sums = sorted(sums, key=lambda x: x[1])
    at = np.concatenate([x[2] for x in sums])
    counts = np.concatenate([x[3] for x in sums])
    return sums, at, np.stack([np.bincount(at, counts[:, j]) for j in range(counts.shape[1])], axis=1)


def _answer(items):
    for t, got in _by_key(items).items():
        sums, _, whole = _added(got)
        for _, d, at, _ in sums:
            yield d, ("told", t, whole[at])


def _only(kind: str):
    return lambda item: item[1][0] == kind


def _sent(step):
    """The sums of a step, which are keyed by share and lie at their block."""
    return step.mapPartitions(lambda items: filter(_only("sums"), items), preservesPartitioning=False)


def _table(spark, rdd, schema: str) -> DataFrame:
    """Rows of an RDD of lists of columns."""
    def run(batches):
        for batch in batches:
            for payload in batch.column(0):
                cols = pickle.loads(payload.as_py())
                for i in range(0, len(cols[0]), ROWS):
                    yield pa.RecordBatch.from_arrays([_column(c[i:i + ROWS]) for c in cols], names=names)

    def _column(c):
        if isinstance(c, pa.Array) or c.ndim == 1:
            return pa.array(c)
        return pa.ListArray.from_arrays(pa.array(np.arange(len(c) + 1, dtype=np.int32) * c.shape[1]), pa.array(c.ravel()))

    names = [f.split()[0] for f in schema.split(", ")]
    rows = rdd.map(lambda cols: (bytearray(pickle.dumps(cols, protocol=5)),))
    return spark.createDataFrame(rows, "payload binary", verifySchema=False).mapInArrow(run, schema)


class Fitted:
    """A fitted model: its blocks, the last counts and the topics' totals."""

    def __init__(self, spark, blocks, last, totals: list[float], shares: int, stored: str | None = None):
        """stored: the checkpoint that ``last`` rests on."""
        self.spark, self.blocks, self.last, self.totals, self.shares, self.stored = spark, blocks, last, totals, shares, stored

    def _with_state(self):
        return _met(self.blocks, self.last.filter(_only("state")))

    def terms(self) -> DataFrame:
        """(term_id, counts)."""
        shares = self.shares

        def settled(items):
            for t, got in _by_key(items).items():
                _, at, whole = _added(got)
                seen = np.unique(at)
                yield [seen.astype(np.int64) * shares + t, whole[seen]]

        def own(items):
            for got in _by_key(items).values():
                block, state = (next(x for x in got if x[0] == kind) for kind in ("block", "state"))
                yield [block[1]["words"][block[1]["own"]], state[2]]

        met = _sent(self.last).partitionBy(shares, _same).mapPartitions(settled)
        schema = "term_id long, counts array<double>"
        return _table(self.spark, met, schema).unionByName(_table(self.spark, self._with_state().mapPartitions(own), schema))

    def docs(self) -> DataFrame:
        """(doc, counts); doc: the block's number and the place in it."""
        def run(items):
            for d, got in _by_key(items).items():
                of_doc = next(x for x in got if x[0] == "state")[1]
                yield [(d << 33) + np.arange(len(of_doc), dtype=np.int64), of_doc]
        return _table(self.spark, self.last.filter(_only("state")).mapPartitions(run), "doc long, counts array<double>")

    def entries(self) -> DataFrame:
        """(doc, term_id, n): what the model was fitted on."""
        def run(items):
            for d, (_, b) in items:
                at = _at(b)
                yield [(d << 33) + _doc(b).astype(np.int64), b["words"][at], _n(b, at)]
        return _table(self.spark, self.blocks.mapPartitions(run), "doc long, term_id long, n double")

    def packed(self) -> DataFrame:
        """(block, size, payload): the same entries, a row a block, to be opened
        by ``unpacked``."""
        def run(items):
            for d, (_, b) in items:
                raw = pickle.dumps({name: b[name] for name in ("lens", "at", "n", "words")}, protocol=5)
                yield d, len(raw), bytearray(pa.compress(raw, "zstd", asbytes=True))
        return self.spark.createDataFrame(self.blocks.mapPartitions(run), "block long, size long, payload binary", verifySchema=False)

    def release(self) -> None:
        self.last.unpersist()
        self.blocks.unpersist()
        for path in (self.stored, self.blocks.getCheckpointFile()):
            if path:
                drop_path(self.spark, path)


def unpacked(size: int, payload: bytes) -> dict:
    """A block's entries: ``doc`` (their documents' places), ``at`` (the places of
    their terms in ``words``) and ``n``."""
    b = pickle.loads(pa.decompress(payload, size, "zstd", asbytes=True))
    at = _at(b)
    return {"doc": _doc(b), "at": at, "n": _n(b, at), "words": b["words"]}


def _met(blocks, *others):
    """Blocks and what is keyed by them, by partition; nothing is moved."""
    met = blocks
    for other in others:
        met = met.union(other)
        if met.partitioner != blocks.partitioner:
            met = met.partitionBy(blocks.getNumPartitions(), _same)
    return met


def _shares(spark, n_entries: int) -> int:
    slots = spark.sparkContext.defaultParallelism
    return max(math.ceil(n_entries / BLOCK_ENTRIES), min(slots, math.ceil(n_entries / LEAST_ENTRIES)), 1)


def _stored(blocks):
    blocks.persist(StorageLevel.DISK_ONLY)
    blocks.checkpoint()
    blocks.count()
    return blocks


def fit(entries: DataFrame, n_entries: int, vocab_size: int, alpha: float, beta: float, k: int, iterations: int,
        seed: int) -> Fitted:
    """EM LDA of ``entries`` (case_id, term_id, n, df): a case's terms with their
    weights and the number of cases with the term (null: unknown)."""
    spark = entries.sparkSession
    ensure_checkpoint_dir(spark)
    shares = _shares(spark, n_entries)
    rows = entries.select("case_id", F.xxhash64("case_id").alias("key"), F.col("term_id").cast("long").alias("term_id"),
                          F.col("n").cast("double").alias("n"),
                          F.coalesce(F.col("df").cast("long"), F.lit(1 << 62)).alias("df")).repartition(shares, "case_id")
    packed = rows.mapInArrow(_pack(shares), "block int, payload binary").rdd
    moved = packed.map(lambda r: (r[0], ("block", bytes(r[1])))).partitionBy(shares, _same)
    blocks = _stored(moved.mapPartitions(
        lambda items: ((d, (kind, pickle.loads(payload))) for d, (kind, payload) in items), True))
    clean_shuffles(moved)
    return _fitted(spark, blocks, shares, vocab_size, alpha, beta, k, iterations, seed)


def fit_tokens(docs: DataFrame, terms: DataFrame, n_entries: int, vocab_size: int, alpha: float, beta: float, k: int,
               iterations: int, seed: int) -> Fitted:
    """EM LDA of ``docs`` (case_id, tokens without line ends): a token is an entry
    where ``terms`` (token, term_id, n, df) has it, with its weight ``n``."""
    spark = docs.sparkSession
    ensure_checkpoint_dir(spark)
    shares = _shares(spark, n_entries)
    texts = docs.where(F.size("tokens") > 0).select("case_id", F.xxhash64("case_id").alias("key"),
                                                    F.array_join("tokens", BETWEEN).alias("text"))
    dealt = texts.mapInArrow(_deal(shares), "block int, payload binary")
    moved = dealt.rdd.map(lambda r: (r[0], bytes(r[1]))).partitionBy(shares, _same)
    coded = moved.mapPartitions(_coded, True).persist(StorageLevel.DISK_ONLY)
    tokens = _table(spark, coded.map(lambda item: [np.full(len(item[1][4]), item[0], np.int32),
                                                   np.arange(len(item[1][4]), dtype=np.int32), item[1][4].cast("string")]),
                    "block int, code int, token string")
    known = tokens.join(terms, "token").select(
        "block", "code", F.col("term_id").cast("long").alias("term_id"), F.col("n").cast("double").alias("n"),
        F.coalesce(F.col("df").cast("long"), F.lit(1 << 62)).alias("df"))
    ids = known.mapInArrow(_told_apart, "block int, payload binary").rdd.map(
        lambda r: (r[0], ("ids", bytes(r[1])))).partitionBy(shares, _same)
    met = _met(coded, ids)
    blocks = _stored(met.mapPartitions(_identified(shares), True))
    clean_shuffles(met)
    clean_shuffles(moved)
    coded.unpersist()
    return _fitted(spark, blocks, shares, vocab_size, alpha, beta, k, iterations, seed)


def _fitted(spark, blocks, shares: int, vocab_size: int, alpha: float, beta: float, k: int, iterations: int,
            seed: int) -> Fitted:
    collect_garbage(spark)

    def kept(step, i: int):
        step.persist(StorageLevel.DISK_ONLY)
        if i and i % CHECKPOINT_EVERY == 0:
            step.checkpoint()
        parts = step.filter(_only("total")).map(lambda item: (item[0], item[1][1].tolist())).collect()  # k numbers a block
        return step, [math.fsum(p[j] for _, p in sorted(parts)) for j in range(k)]

    last, totals = kept(blocks.mapPartitions(_start(k, seed), True), 0)
    stored = None
    for i in range(1, iterations + 1):
        told = _sent(last).partitionBy(shares, _same).mapPartitions(_answer).partitionBy(
            shares, _same).mapPartitions(lambda items: items, True)
        met = _met(blocks, last.filter(_only("state")), told)
        now, totals = kept(met.mapPartitions(_iterate(k, totals, vocab_size, alpha, beta), True), i)
        clean_shuffles(met)
        last.unpersist()
        if now.getCheckpointFile():  # what came before isn't needed any more
            if stored:
                drop_path(spark, stored)
            stored = now.getCheckpointFile()
        last = now
    return Fitted(spark, blocks, last, totals, shares, stored)
