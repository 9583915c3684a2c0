"""Language-model scores from a subword lattice.

A word's lattice holds every way to write it (with its word-start mark) as
pieces of an existing subword vocabulary; characters that no piece covers go as
byte pieces.  A forward recursion in log space sums the probabilities of all
segmentations.  The vocabulary's scores are merge ranks, so they enter as Zipf
weights; one expectation step over all distinct training words (forward and
backward over the lattices) turns them into piece probabilities.  A training
word is also an arc of its own, over the whole word, with its relative
frequency; the share of the pieces is the Good-Turing estimate of unseen words
(words seen once / all words), and as they write unseen words, each distinct
word teaches them once.  A document's probability is the product
over its words and its end.

Counts cover all training documents and no vocabulary of the corpus is ever in
one place: documents are dealt into blocks by a hash, each block asks for its
distinct words, once, in packed rows dealt by word; the tasks that own
the words sum their counts over the blocks, score their lattices once and answer
each block in the order it asked.  A word in every document costs one entry a
block.  Only the piece probabilities (the size of the vocabulary file) and four
totals pass through the driver.

Edge cases: null text counts as empty (only the end); no training document:
the lattice alone scores words; repeated and null ids row by row; an empty
table gives an empty result; words of any length; other columns are not read.
"""

from __future__ import annotations

import math
import zlib
from array import array
from collections import Counter, deque
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, slots, text_size

BLOCK_BYTES = 12 << 20
OWNER_BYTES = 16 << 20  # text whose words one task owns
MARK = "▁"
ZIPF_OFFSET = 2.7
PRIOR_SHARE = 1e-3  # weight of the vocabulary's own scores after the expectation step
TOGETHER = 4096     # words of one length that are scored at a time
VECTOR_CHARS = 40   # longer words are scored one by one
LN10 = math.log(10)


class Lattice:
    """Pieces and their log probabilities."""

    def __init__(self, path: str, logp: np.ndarray | None = None):
        self.ids, self.bytes, self.prior = _vocabulary(path)
        self.logp = self.prior if logp is None else logp
        self.longest = max(map(len, self.ids), default=1)

    def byte_ids(self, char: str) -> list[int]:
        return [self.bytes[b] for b in char.encode("utf-8", "surrogateescape")]

    def _arcs(self, words: list[str]):
        """For words of one length: ids (-1 none, -2 bytes) and log
        probabilities of the arcs, by start and length."""
        n, get, out = len(words[0]), self.ids.get, {}
        for i in range(n):
            for size in range(1, min(self.longest, n - i) + 1):
                ids = np.fromiter((get(w[i:i + size], -1) for w in words), dtype=np.int32, count=len(words))
                if size > 1 and (ids < 0).all():
                    continue
                lp = np.where(ids >= 0, self.logp[ids], -np.inf)
                if size == 1 and (ids < 0).any():
                    for k in np.flatnonzero(ids < 0):
                        ids[k] = -2
                        lp[k] = self.logp[self.byte_ids(words[k][i])].sum()
                out[i, size] = ids, lp
        return out

    @staticmethod
    def _sum(terms: list[np.ndarray]) -> np.ndarray:
        stack = np.array(terms)
        top = stack.max(axis=0)
        return top + np.log(np.exp(stack - top).sum(axis=0))

    def _forward(self, arcs, n: int, count: int) -> list[np.ndarray]:
        alpha = [np.zeros(count)]
        for j in range(1, n + 1):
            alpha.append(self._sum([alpha[j - s] + arcs[j - s, s][1] for s in range(1, min(self.longest, j) + 1)
                                    if (j - s, s) in arcs]))
        return alpha

    def _long(self, word: str) -> float:
        """One long word; only the last few positions are kept."""
        alpha = [0.0]
        for j in range(1, len(word) + 1):
            terms = []
            for s in range(1, min(self.longest, j) + 1):
                k = self.ids.get(word[j - s:j])
                if k is not None:
                    terms.append(alpha[-s] + self.logp[k])
                elif s == 1:
                    terms.append(alpha[-1] + self.logp[self.byte_ids(word[j - 1])].sum())
            top = max(terms)
            alpha.append(top + math.log(sum(math.exp(t - top) for t in terms)))
            del alpha[:-self.longest]
        return float(alpha[-1])

    def _long_uses(self, word: str, weight: float, out: np.ndarray) -> None:
        """Add one long word's expected uses; all forward sums are stored, but
        only the last few backward ones."""
        n, alpha = len(word), array("d", [0.0])

        def arc(i: int, s: int) -> tuple[int | None, float] | None:
            k = self.ids.get(word[i:i + s])
            if k is not None:
                return k, float(self.logp[k])
            return (None, float(self.logp[self.byte_ids(word[i])].sum())) if s == 1 else None

        def total(terms: list[float]) -> float:
            top = max(terms)
            return top + math.log(sum(math.exp(t - top) for t in terms))

        for j in range(1, n + 1):
            arcs = ((s, arc(j - s, s)) for s in range(1, min(self.longest, j) + 1))
            alpha.append(total([alpha[j - s] + a[1] for s, a in arcs if a]))
        beta = deque([0.0], maxlen=self.longest)  # of the places after i
        for i in range(n - 1, -1, -1):
            arcs = [(s, a) for s in range(1, min(self.longest, n - i) + 1) if (a := arc(i, s))]
            for s, (k, lp) in arcs:
                share = weight * math.exp(alpha[i] + lp + beta[s - 1] - alpha[n])
                if k is None:
                    np.add.at(out, self.byte_ids(word[i]), share)
                else:
                    out[k] += share
            beta.appendleft(total([lp + beta[s - 1] for s, (_, lp) in arcs]))

    def _batches(self, words: list[bytes]):
        """Marked words of one length, some thousand at a time, with places."""
        marked = [MARK + w.decode("utf-8", "surrogateescape") for w in words]
        order = sorted(range(len(words)), key=lambda k: len(marked[k]))
        at = 0
        while at < len(order):
            n, end = len(marked[order[at]]), at
            while end < len(order) and end - at < TOGETHER and len(marked[order[end]]) == n:
                end += 1
            yield n, np.array(order[at:end]), [marked[k] for k in order[at:end]]
            at = end

    def marginals(self, words: list[bytes]) -> np.ndarray:
        """Natural log of the sum over all segmentations of each word."""
        out = np.zeros(len(words))
        for n, where, some in self._batches(words):
            out[where] = [self._long(w) for w in some] if n > VECTOR_CHARS else \
                self._forward(self._arcs(some), n, len(some))[n]
        return out

    def expected(self, words: list[bytes], counts: np.ndarray) -> np.ndarray:
        """Expected uses of each piece over all segmentations of the words."""
        out = np.zeros(len(self.logp))
        for n, where, some in self._batches(words):
            c = counts[where].astype(float)
            if n > VECTOR_CHARS:
                for w, x in zip(some, c):
                    self._long_uses(w, float(x), out)
                continue
            arcs = self._arcs(some)
            alpha, beta = self._forward(arcs, n, len(some)), {n: np.zeros(len(some))}
            for i in range(n - 1, -1, -1):
                beta[i] = self._sum([arcs[i, s][1] + beta[i + s] for s in range(1, min(self.longest, n - i) + 1)
                                     if (i, s) in arcs])
            for (i, s), (ids, lp) in arcs.items():
                share = np.exp(alpha[i] + lp + beta[i + s] - alpha[n]) * c
                known = ids >= 0
                out += np.bincount(ids[known], weights=share[known], minlength=len(out))
                for k in np.flatnonzero(ids == -2):
                    np.add.at(out, self.byte_ids(some[k][i]), share[k])
        return out


@lru_cache(maxsize=2)
def _vocabulary(path: str):
    """Piece -> id, byte -> id, and Zipf log weights from the file's scores
    (minus the merge rank; pieces without one come after all others)."""
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    size = model.get_piece_size()
    rank, ids, of_byte = np.full(size, float(size)), {}, {}
    for i in range(size):
        if model.is_byte(i):
            of_byte[int(model.id_to_piece(i)[3:5], 16)] = i
        elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
            ids[model.id_to_piece(i)] = i
            rank[i] = -model.get_score(i)
    weight = 1 / (rank + ZIPF_OFFSET)
    return ids, of_byte, np.log(weight / weight.sum())


# packed requests and answers ------------------------------------------------

def _pack(*parts: bytes) -> bytes:
    import zstandard as zs
    head = b"".join(len(p).to_bytes(8, "little") for p in parts)
    return zs.ZstdCompressor(level=1).compress(head + b"".join(parts))


def _unpack(payload: bytes, n: int) -> list[bytes]:
    import zstandard as zs
    body, out, at = zs.ZstdDecompressor().decompress(payload), [], 8 * n
    for i in range(n):
        size = int.from_bytes(body[8 * i:8 * i + 8], "little")
        out.append(body[at:at + size])
        at += size
    return out


def words_of(raw: bytes | None) -> list[bytes]:
    """ASCII lower case, split at the six ASCII blanks."""
    return (raw or b"").lower().split()


def _by_owner(words, owners: int) -> dict[int, list[bytes]]:
    """Distinct words by the task that owns them, each list sorted."""
    out: dict[int, list[bytes]] = {}
    for w in words:
        out.setdefault(zlib.crc32(w) % owners, []).append(w)
    for v in out.values():
        v.sort()
    return out


def _ask(docs: pa.Table, owners: int) -> pa.Table:
    """A block's distinct words with their counts in its training documents."""
    count, rest = Counter(), set()
    for raw, learn in zip(docs.column("text").to_pylist(), docs.column("learn").to_pylist()):
        (count if learn else rest).update(words_of(raw))
    rest.difference_update(count)
    block = docs.column("block")[0].as_py()
    rows = [(owner, block, _pack(b"\n".join(ws), np.array([count.get(w, 0) for w in ws], dtype="<i8").tobytes()))
            for owner, ws in _by_owner([*count, *rest], owners).items()]
    return pa.table({"owner": pa.array([r[0] for r in rows], pa.int64()),
                     "block": pa.array([r[1] for r in rows], pa.int64()),
                     "payload": pa.array([r[2] for r in rows], pa.binary())})


def _totals(group: pa.Table) -> tuple[list[list[bytes]], dict[bytes, int]]:
    asked, total = [], {}
    for payload in group.column("payload").to_pylist():
        ws, cs = _unpack(payload, 2)
        ws = ws.split(b"\n")  # a word holds no blank
        asked.append(ws)
        for w, c in zip(ws, np.frombuffer(cs, dtype="<i8").tolist()):
            total[w] = total.get(w, 0) + c
    return asked, total


def _expect(group: pa.Table, path: str) -> pa.Table:
    """Token, type and single counts of an owner's words, and the expected
    uses of the pieces (as one packed row)."""
    _, total = _totals(group)
    words = [w for w, c in total.items() if c]
    counts = np.array([total[w] for w in words], dtype=np.int64)
    uses = Lattice(path).expected(words, np.ones(len(words))) if words else np.zeros(0)
    return pa.table({"tokens": [int(counts.sum())], "types": [len(words)], "singles": [int((counts == 1).sum())],
                     "uses": pa.array([uses.astype("<f8").tobytes()], pa.binary())})


def _fold_uses(batches):
    """Sum the packed rows of a partition; one row per piece."""
    held, numbers = None, np.zeros(3, dtype=np.int64)
    for batch in batches:
        for t, v, s, uses in zip(*(batch.column(i).to_pylist() for i in range(4))):
            numbers += (t, v, s)
            if uses:
                got = np.frombuffer(uses, dtype="<f8")
                held = got if held is None else held + got
    held = np.zeros(0) if held is None else held
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.r_[-3, -2, -1, np.arange(len(held))], pa.int64()), pa.array(np.r_[numbers, held], pa.float64())],
        ["piece", "uses"])


def _answer(group: pa.Table, path: str, logp: np.ndarray, tokens: int, keep: float, spell: float) -> pa.Table:
    """Count and log10 probability of the words each block asked for: a share of
    ``keep`` by their frequency, one of ``spell`` by their lattices."""
    asked, total = _totals(group)
    words = list(total)
    counts = np.array([total[w] for w in words], dtype=np.float64)
    score = math.log(spell) + Lattice(path, logp).marginals(words)
    known = counts > 0
    score[known] = np.logaddexp(score[known], math.log(keep) + np.log(counts[known] / tokens)) if keep > 0 else score[known]
    place = {w: i for i, w in enumerate(words)}
    payloads = []
    for ws in asked:
        i = np.fromiter((place[w] for w in ws), dtype=np.int64, count=len(ws))
        payloads.append(_pack(counts[i].astype("<i8").tobytes(), (score[i] / LN10).astype("<f8").tobytes()))
    return pa.table({"block": group.column("block"), "owner": group.column("owner"),
                     "payload": pa.array(payloads, pa.binary())})


def _score(docs: pa.Table, answers: pa.Table, owners: int, tokens: int, types: int, end_count: int,
           end_score: float) -> pa.Table:
    ids, texts = docs.column("doc_id"), docs.column("text").to_pylist()
    distinct = set()
    for raw in texts:
        distinct.update(words_of(raw))
    answer = dict(zip(answers.column("owner").to_pylist(), answers.column("payload").to_pylist()))
    place, counts, scores = {}, [], []
    for owner, ws in _by_owner(distinct, owners).items():
        c, s = _unpack(answer[owner], 2)
        for w in ws:
            place[w] = len(place)
        counts.append(np.frombuffer(c, dtype="<i8"))
        scores.append(np.frombuffer(s, dtype="<f8"))
    counts = np.concatenate(counts) if counts else np.zeros(0, dtype=np.int64)
    scores = np.concatenate(scores) if scores else np.zeros(0)
    floor = math.log10(tokens + types + 1)
    base, get = np.log10(counts + 1.0) - floor, place.__getitem__
    out = {"n_tokens": [], "n_known": [], "base_score": [], "score": []}
    for raw in texts:
        i = np.fromiter(map(get, words_of(raw)), dtype=np.int64)
        out["n_tokens"].append(len(i) + 1)
        out["n_known"].append(int((counts[i] > 0).sum()) + (end_count > 0))
        out["base_score"].append(float(base[i].sum()) + math.log10(end_count + 1) - floor)
        out["score"].append(float(scores[i].sum()) + end_score)
    return pa.table({"doc_id": ids, "learn": docs.column("learn"), "n_tokens": pa.array(out["n_tokens"], pa.int64()),
                     "n_known": pa.array(out["n_known"], pa.int64()),
                     "train_tokens": pa.array([tokens] * len(texts), pa.int64()),
                     "base_score": pa.array(out["base_score"], pa.float64()),
                     "score": pa.array(out["score"], pa.float64())})


def score(docs: DataFrame, path: str, learn_from: Column, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, learn, n_tokens, n_known, train_tokens, base_score, score`` per
    row; ``learn_from`` says which rows the model learns from."""
    spark = docs.sparkSession
    learn = F.coalesce(learn_from, F.lit(False))
    total, end_count = docs.agg(F.sum(text_size(text)), F.sum(learn.cast("long"))).first()
    total, end_count = total or 0, end_count or 0
    blocks = max(slots(spark), math.ceil(total / BLOCK_BYTES))
    owners = max(slots(spark), math.ceil(total / OWNER_BYTES))
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("binary").alias("text"),
                       learn.alias("learn"),
                       F.pmod(F.xxhash64(F.col(doc_id), F.col(text)), F.lit(blocks)).alias("block"))
    asked = cut(rows.groupBy("block").applyInArrow(lambda t: _ask(t, owners),
                                                   "owner long, block long, payload binary"))
    uses = (asked.groupBy("owner").applyInArrow(lambda t: _expect(t, path),
                                                "tokens long, types long, singles long, uses binary")
            .mapInArrow(_fold_uses, "piece long, uses double")
            .groupBy("piece").agg(F.sum("uses").alias("uses")).collect())  # a row per piece
    uses = {r["piece"]: r["uses"] for r in uses}
    words, types, singles = (int(uses.get(k, 0)) for k in (-3, -2, -1))
    prior = np.exp(Lattice(path).prior)
    found = np.array([uses.get(i, 0.0) for i in range(len(prior))])
    weight = found + max(1.0, PRIOR_SHARE * found.sum()) * prior
    logp = np.log(weight / weight.sum())
    tokens, types = words + end_count, types + (end_count > 0)
    keep = min(1 - max(singles, 1) / tokens, 1 - 1 / (tokens + 1)) if tokens else 0.0
    keep = max(keep, 0.0)
    # the end takes part in both shares; what is left of the second one spells words
    ends = (end_count + 1) / (tokens + 2)
    spell = (1 - keep) * (1 - ends)
    end_score = math.log10(keep * end_count / max(tokens, 1) + (1 - keep) * ends)
    answers = asked.groupBy("owner").applyInArrow(lambda t: _answer(t, path, logp, max(tokens, 1), keep, spell),
                                                  "block long, owner long, payload binary")
    return rows.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
        lambda d, a: _score(d, a, owners, tokens, types, end_count, end_score),
        "doc_id long, learn boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
