"""Language identification: averaged hashed subword embeddings, linear softmax.

A text is lower-cased, every ASCII character but letters becomes a blank, and its byte
n-grams (2 to 4, blanks mark word edges) are hashed into a table of embeddings.
The mean of a text's embeddings goes through a linear layer and a softmax.  The
model is trained by stochastic gradient descent in numpy, on pieces of the
training texts of many lengths, so that short texts are known too.  The
probabilities are calibrated on texts that took no part in training
(temperature), and a prediction is rejected when its probability is below what
all but ``REJECT`` of the right calibration predictions reach.

Training uses a bounded sample: about ``per_language`` labelled rows of each
language, chosen by a hash of the id; all of a text of at most ``train_bytes``
bytes, and a stretch of ``train_bytes // 4`` characters of a longer one, from a
place chosen by that hash.  As the
model is linear, embeddings and output layer fold into one table (hash bucket x
language, under a megabyte) that travels with the tasks; predicting a whole
text is a gather and a sum, without a shuffle.

Edge cases: null text, or text without a letter: ``und``, score 0; no labelled
row at all: every row is ``und``; repeated and null ids row by row; an empty
table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import map_slices

GRAMS = (2, 3, 4)
BUCKET_BITS = 14
DIMENSIONS = 16
EPOCHS, BATCH, RATE = 6, 64, 0.5
REJECT = 0.01
UNKNOWN = "und"
PAD = b" " * (max(GRAMS) - 1)
NONE = 1 << BUCKET_BITS  # bucket of no gram; its embedding stays zero
LETTERS = bytes(c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
MOST_LANGUAGES = 1000
SAMPLE_BYTES = 256 << 20  # of all training texts together
LEAST_BYTES = 1 << 10     # of one of them
PIECE_BYTES = 1 << 20
TRAIN_PIECE = 4096  # a training text is dealt whole in pieces of so many bytes


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...] = ()
    table: np.ndarray = field(default_factory=lambda: np.zeros((1, 0), dtype=np.float32))
    bias: np.ndarray = field(default_factory=lambda: np.zeros(0, dtype=np.float32))
    temperature: float = 1.0
    threshold: float = 0.0


def plain(text: str) -> bytes:
    """Lower-case bytes with a blank for every ASCII character but letters."""
    return text.lower().encode("utf-8", "replace").translate(LETTERS)


def pieces(raw: bytes) -> list[bytes]:
    """A text between blanks in pieces of about ``PIECE_BYTES``; each carries
    the first bytes of the next, in which none of its own grams start."""
    whole = b" " + raw + PAD
    return [whole[a:a + PIECE_BYTES + len(PAD)] for a in range(0, len(raw) + 1, PIECE_BYTES)]


def buckets(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hash buckets of the n-grams of pieces, one row per n: (n, bytes) with
    the last bucket for none or for blanks only; and where pieces start."""
    joined = np.frombuffer(b"".join(parts), dtype=np.uint8).astype(np.uint32)
    ends = np.cumsum([len(p) for p in parts])
    blank = joined == 32
    out = np.empty((len(GRAMS), len(joined)), dtype=np.int32)
    for row, n in enumerate(GRAMS):
        value, empty = np.zeros(len(joined), dtype=np.uint32), np.ones(len(joined), dtype=bool)
        for i in range(n):
            value = value * np.uint32(257) + np.roll(joined, -i) + np.uint32(n)
            empty &= np.roll(blank, -i)
        out[row] = value * np.uint32(2654435761) >> np.uint32(32 - BUCKET_BITS)
        out[row][empty] = NONE
    out[:, (ends[:, None] - np.arange(1, len(PAD) + 1)).ravel()] = NONE
    return out, np.r_[0, ends[:-1]]


def sums(ids: np.ndarray, starts: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sum of the table's rows over each piece's grams, and their number."""
    total = sum(np.add.reduceat(table[row], starts, axis=0, dtype=np.float64) for row in ids)
    return total, np.add.reduceat((ids != NONE).sum(axis=0), starts)


def logits(raws: list[bytes], model: Model) -> np.ndarray:
    """Scores of each text, about ``PIECE_BYTES`` at a time."""
    total, count = np.zeros((len(raws), len(model.languages))), np.zeros(len(raws), dtype=np.int64)
    queue = [(i, p) for i, raw in enumerate(raws) for p in pieces(raw)]
    at = 0
    while at < len(queue):
        end, held = at, 0
        while end < len(queue) and (end == at or held + len(queue[end][1]) <= PIECE_BYTES):
            held += len(queue[end][1])
            end += 1
        owner = [i for i, _ in queue[at:end]]
        part, n = sums(*buckets([p for _, p in queue[at:end]]), model.table)
        np.add.at(total, owner, part)
        np.add.at(count, owner, n)
        at = end
    return total / np.maximum(count, 1)[:, None] + model.bias


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def train(texts: list[str], names: list[str], seed: int = 11) -> Model:
    """Stochastic gradient descent on pieces of the texts."""
    rng = np.random.default_rng(seed)
    languages = tuple(sorted(set(names)))
    at = {x: i for i, x in enumerate(languages)}
    parts, label, late = [], [], []
    for t, name in zip(texts, names):
        raw, held = plain(t), rng.random() < 0.15
        for size in (12, 40, 150, 600, 1 << 30):
            start = int(rng.integers(0, max(1, len(raw) - size)))
            piece = raw[start:start + size].strip()
            for a in range(0, len(piece), TRAIN_PIECE):
                parts.append(piece[a:a + TRAIN_PIECE])
                label.append(at[name])
                late.append(held)
    y, late = np.array(label, dtype=np.int64), np.array(late, dtype=bool)
    if not len(y):
        return Model()
    order = np.flatnonzero(~late)
    if not len(order):
        order, late = np.arange(len(y)), np.ones(len(y), dtype=bool)
    balance = len(order) / (len(languages) * np.maximum(1, np.bincount(y[order], minlength=len(languages))))
    e = rng.normal(0, 0.1, (1 + NONE, DIMENSIONS)).astype(np.float32)
    w = rng.normal(0, 0.3, (DIMENSIONS, len(languages))).astype(np.float32)
    b = np.zeros(len(languages), dtype=np.float32)
    e[-1] = 0
    step, steps = 0, EPOCHS * -(-len(order) // BATCH)
    for _ in range(EPOCHS):
        rng.shuffle(order)
        for i in range(0, len(order), BATCH):
            some = order[i:i + BATCH]
            ids, starts = buckets([b" " + parts[j] + PAD for j in some])
            x, count = sums(ids, starts, e)
            back = 1 / np.maximum(count, 1)[:, None]
            x = (x * back).astype(np.float32)
            p = softmax(x @ w + b)
            g = p
            g[np.arange(len(some)), y[some]] -= 1
            g *= balance[y[some]][:, None] / len(some)
            rate = np.float32(RATE * (1 - step / steps) * 4)
            step += 1
            back = ((g @ w.T) * back).astype(np.float32)
            size = np.diff(np.r_[starts, ids.shape[1]])
            spread = np.repeat(back * (rate * 30), size, axis=0)
            for row in ids:
                hit, where = np.unique(row, return_inverse=True)
                for d in range(DIMENSIONS):
                    e[hit, d] -= np.bincount(where, weights=spread[:, d], minlength=len(hit)).astype(np.float32)
            e[-1] = 0
            w -= rate * (x.T @ g).astype(np.float32)
            b -= rate * g.sum(axis=0).astype(np.float32)
    model = Model(languages, (e @ w).astype(np.float32), b)
    check = np.flatnonzero(late) if late.any() else np.arange(len(y))
    z, yy = logits([parts[j] for j in check], model), y[check]
    loss = {t: -np.log(np.maximum(softmax(z / t)[np.arange(len(yy)), yy], 1e-9)).mean()
            for t in np.geomspace(0.1, 4, 40)}
    temperature = float(min(loss, key=loss.get))
    p = softmax(z / temperature)
    right = np.sort(p.max(axis=1)[p.argmax(axis=1) == yy])
    threshold = float(right[int(REJECT * len(right))]) if len(right) else 0.0
    return Model(languages, model.table, b, temperature, threshold)


def fit(docs: DataFrame, learn_from: Column | None = None, per_language: int = 400, train_bytes: int = 1 << 16,
        doc_id: str = "doc_id", text: str = "text", lang: str = "lang",
        most_languages: int = MOST_LANGUAGES) -> Model:
    """Train on at most ``per_language`` different texts of each language among
    the rows that ``learn_from`` allows, those with the smallest hashes, and on
    ``SAMPLE_BYTES`` of them in all: with very many languages long texts give
    shorter stretches.  The model takes 64 KB a language; more than
    ``most_languages`` are an error."""
    known = docs.where(F.col(lang).isNotNull() & (F.octet_length(text) > 0))
    if learn_from is not None:
        known = known.where(learn_from)
    known = known.select(F.col(lang).alias("_l"), F.col(text).alias("_t"), F.xxhash64(F.col(doc_id), F.col(text)).alias("_h"))
    n = known.select("_l").distinct().count()
    if n > most_languages:
        raise ValueError(f"more than {most_languages} languages")
    train_bytes = max(LEAST_BYTES, min(train_bytes, SAMPLE_BYTES // max(1, per_language * n)))
    # repeated rows are one; the limit is applied in every task before the shuffle
    order = Window.partitionBy("_l").orderBy(F.pmod("_h", F.lit(1 << 30)), "_h")
    few = (known.select("_l", "_h").distinct().withColumn("_r", F.row_number().over(order))
           .where(F.col("_r") <= per_language).select("_l", "_h"))
    stretch = train_bytes // 4
    place = F.pmod(F.shiftright("_h", 30), F.length("_t") - stretch + 1).cast("int") + 1
    part = F.when(F.octet_length("_t") <= train_bytes, F.col("_t")).otherwise(F.substring("_t", place, F.lit(stretch)))
    chosen = (known.join(F.broadcast(few), ["_l", "_h"])  # at most per_language x most_languages keys
              .select("_l", part.alias("_t"), "_h").dropDuplicates(["_l", "_h"]).collect())
    chosen = sorted((r["_h"], r["_l"], r["_t"]) for r in chosen)
    return train([t for _, _, t in chosen], [x for _, x, _ in chosen])


def predict(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, lang_pred, score, rejected`` per row."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))

    def run(batch: pa.RecordBatch) -> dict:
        texts = [t or "" for t in batch.column(1).to_pylist()]
        told = np.array([bool(model.languages) and any(map(str.isalpha, t)) for t in texts], dtype=bool)
        names, score = np.full(len(texts), UNKNOWN, dtype=object), np.zeros(len(texts))
        at = np.flatnonzero(told)
        if len(at):
            p = softmax(logits([plain(texts[i]) for i in at], model) / model.temperature)
            names[at] = np.array(model.languages, dtype=object)[p.argmax(axis=1)]
            score[at] = p.max(axis=1)
        return {"doc_id": batch.column(0), "lang_pred": names.tolist(), "score": score,
                "rejected": ~told | (score < model.threshold)}

    return map_slices(rows, run, "doc_id long, lang_pred string, score double, rejected boolean")
