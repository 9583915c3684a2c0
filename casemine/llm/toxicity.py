"""Toxicity by compression distance.

Two zstandard dictionaries are trained, one on ordinary and one on toxic text.
A text is lower-cased and cut at blanks into windows of about 64 bytes; each
window is compressed with the ordinary dictionary and with the ordinary and
toxic dictionaries together.  The gap between the two lengths is how much the
window is like toxic text beyond what ordinary text explains.  A window hits
when its gap reaches a calibrated threshold; a logistic model, calibrated on
labelled texts that trained no dictionary, turns the hits, the largest gaps
and the number of windows into a probability.

A toxic text is mostly ordinary words, so the toxic dictionary is trained on
the passages that toxic texts repeat in more contexts than chance allows given
the ordinary texts.  A context (the words on both sides) counts once, so copied
texts don't pass as evidence.

Training uses a bounded sample of labelled rows (``per_class`` toxic and twice
as many ordinary ones, each of at most ``train_bytes`` bytes, chosen by a hash
of the id); the two dictionaries (kilobytes) travel with the tasks.  Scoring
reads every whole text and never shuffles.

Edge cases: null and empty texts have no window and get the score of a text
without evidence; without toxic or ordinary training rows every score is the
share of toxic labels (0.0 without any label); rows come out one for one,
whatever their id; other columns are not read.
"""

from __future__ import annotations

import math
import random
import string
from collections import Counter
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import map_slices

WINDOW = 64
LEVEL = 3
ORDINARY_BYTES, TOXIC_BYTES = 32768, 2048
STRIP = string.punctuation + string.whitespace
LEAST_CONTEXTS, LEAST_SURPRISE = 5, 6.0
GAPS = (4, 5, 6, 7, 8)


@dataclass(frozen=True)
class Model:
    ordinary: bytes
    toxic: bytes
    gap: int
    weights: tuple[float, ...]
    prior: float


def windows(text: str, size: int = WINDOW) -> list[bytes]:
    """The whole text, lower-cased, cut at the first blank after ``size``
    bytes (or at twice that, where there is none)."""
    raw = text.lower().encode("utf-8", "replace")
    out, at, n = [], 0, len(raw)
    while at < n:
        end = n
        if at + size < n:
            end = raw.find(b" ", at + size, at + 2 * size)
            end = min(n, at + 2 * size) if end < 0 else end
        out.append(raw[at:end])
        at = end
    return out


def _contexts(texts: list[str]) -> Counter:
    """Distinct contexts of each word; no context is counted twice."""
    seen, count = set(), Counter()
    for t in texts:
        words = t.lower().split()
        for i, w in enumerate(words):
            key = hash((words[i - 1] if i else "", w, words[i + 1] if i + 1 < len(words) else ""))
            if key not in seen:
                seen.add(key)
                count[w.strip(STRIP)] += 1
    return count


def passages(toxic: list[str], ordinary: list[str]) -> list[bytes]:
    """Words of toxic texts that occur there in surprisingly many contexts."""
    a, b = _contexts(toxic), _contexts(ordinary)
    share = sum(a.values()) / max(1, sum(b.values()))
    marked = {w for w, n in a.items() if w and n >= LEAST_CONTEXTS
              and (n - (b[w] + 0.5) * share) / math.sqrt((b[w] + 0.5) * share + 1) > LEAST_SURPRISE}
    return [f" {w}".encode() for t in toxic for w in (x.strip(STRIP) for x in t.lower().split()) if w in marked]


def train_dictionary(samples: list[bytes], size: int, k: int = 64, d: int = 8) -> bytes:
    """A zstandard dictionary of segments of ``k`` bytes, judged by how often
    their strings of ``d`` bytes occur; too few samples to train on are one
    themselves."""
    import zstandard as zs
    try:
        return zs.train_dictionary(size, samples, k=k, d=d, steps=4).as_bytes()
    except zs.ZstdError:
        return b"".join(samples)[-size:]


@lru_cache(maxsize=8)
def _compressor(content: bytes):
    import zstandard as zs
    # a trained dictionary keeps its entropy tables when content is appended
    d = zs.ZstdCompressionDict(content or b" ", dict_type=zs.DICT_TYPE_AUTO)
    d.precompute_compress(level=LEVEL)
    return zs.ZstdCompressor(level=LEVEL, dict_data=d, write_content_size=False,
                             write_checksum=False, write_dict_id=False)


def gaps(text: str, ordinary: bytes, toxic: bytes) -> np.ndarray:
    """By how many bytes each window is shorter with the toxic dictionary."""
    plain, both = _compressor(ordinary).compress, _compressor(ordinary + toxic).compress
    return np.array([len(plain(w)) - len(both(w)) for w in windows(text)], dtype=np.int32)


def _features(g: np.ndarray, gap: int) -> list[float]:
    hits = int((g >= gap).sum())
    top = np.sort(g)[-3:] if len(g) else np.zeros(1)
    return [1.0, min(float(top[-1]), 12.0) / 8, float(np.clip(top, -4, 12).mean()) / 8,
            math.log1p(hits), hits / max(1, len(g)) * 10, math.log1p(len(g)) / 5]


def _logistic(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, float]:
    """Weighted ridge logistic regression by Newton steps; weights and loss."""
    beta = np.zeros(x.shape[1])
    ridge = np.full(x.shape[1], 0.05)
    ridge[0] = 1e-6
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        step = np.linalg.solve((x * (w * p * (1 - p) + 1e-9)[:, None]).T @ x + np.diag(ridge),
                               x.T @ (w * (y - p)) - ridge * beta)
        beta = beta + np.clip(step, -4, 4)
    p = np.clip(1 / (1 + np.exp(-np.clip(x @ beta, -30, 30))), 1e-6, 1 - 1e-6)
    return beta, float(-(w * (y * np.log(p) + (1 - y) * np.log(1 - p))).sum())


def fit(docs: DataFrame, labels: DataFrame, learn_from: Column | None = None, per_class: int = 1200,
        train_bytes: int = 1 << 16, doc_id: str = "doc_id", text: str = "text",
        toxic: str = "toxic") -> Model:
    """Train on a bounded sample of the labelled rows that ``learn_from`` (a
    condition on ``doc_id``) allows; an id with several labels counts as toxic
    if one of them says so."""
    known = labels.where(F.col(toxic).isNotNull() & F.col(doc_id).isNotNull())
    if learn_from is not None:
        known = known.where(learn_from)
    known = known.groupBy(F.col(doc_id).alias("_id")).agg(F.max(F.col(toxic).cast("int")).alias("_y"))
    total = {r["_y"]: r["n"] for r in known.groupBy("_y").agg(F.count(F.lit(1)).alias("n")).collect()}
    prior = total.get(1, 0) / max(1, total.get(0, 0) + total.get(1, 0))
    wanted = [known.where(F.col("_y") == y).orderBy(F.xxhash64("_id")).limit(n)
              for y, n in ((1, per_class), (0, 2 * per_class))]
    wanted = wanted[0].unionByName(wanted[1])  # at most 3 * per_class rows
    rows = (docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("_t"))
            .where(F.octet_length("_t").between(1, train_bytes))
            .join(F.broadcast(wanted), "_id").dropDuplicates(["_id"]).collect())
    rows = sorted((r["_id"], r["_t"], r["_y"]) for r in rows)
    random.Random(5).shuffle(rows)
    texts = {y: [t for _, t, x in rows if x == y] for y in (0, 1)}
    if min(map(len, texts.values())) < 3:
        return Model(b"", b"", 1, (), prior)
    learn, check = ({y: [t for i, t in enumerate(v) if (i % 3 == 2) == late] for y, v in texts.items()}
                    for late in (False, True))
    plain = [w for t in learn[0] for w in windows(t)]
    random.Random(7).shuffle(plain)
    ordinary = train_dictionary(plain, ORDINARY_BYTES)
    marked = passages(learn[1], learn[0]) or [w for t in learn[1] for w in windows(t)]
    # short passages, mixed and joined, so that one segment can hold several
    mixed = random.Random(3).sample(marked * 3, 3 * len(marked))
    poison = train_dictionary([b"".join(mixed[i:i + 16]) for i in range(0, len(mixed), 16)], TOXIC_BYTES, d=6)
    g = [(gaps(t, ordinary, poison), y) for y in (0, 1) for t in check[y]]
    y = np.array([float(b) for _, b in g])
    weight = np.where(y == 1, prior / max(1, len(check[1])), (1 - prior) / max(1, len(check[0]))) * len(y)
    best = min(((*_logistic(np.array([_features(a, k) for a, _ in g]), y, weight), k) for k in GAPS),
               key=lambda b: b[1])
    return Model(ordinary, poison, best[2], tuple(map(float, best[0])), prior)


def score_text(text: str | None, model: Model) -> float:
    if not model.weights:
        return model.prior
    z = float(np.dot(_features(gaps(text or "", model.ordinary, model.toxic), model.gap), model.weights))
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def score(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, score`` per row: the probability of label 1."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))

    def run(batch: pa.RecordBatch) -> dict:
        return {"doc_id": batch.column(0),
                "score": [score_text(t, model) for t in batch.column(1).to_pylist()]}

    return map_slices(rows, run, "doc_id long, score double")
