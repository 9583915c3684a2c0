import math
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
from pyspark.sql import functions as F

from casemine.llm import lattice_lm as lm
from casemine.llm.common import remainder
from casemine.llm.lattice_lm import MARK, Lattice, score

PATH = public_tokenizers.path("piece_bpe_32k.model")


def all_segmentations(lattice, word):
    """Sum over segmentations, spelled out."""
    if not word:
        return 1.0
    total = 0.0
    for n in range(1, len(word) + 1):
        k = lattice.ids.get(word[:n])
        if k is not None:
            total += math.exp(lattice.logp[k]) * all_segmentations(lattice, word[n:])
        elif n == 1:
            total += math.exp(lattice.logp[lattice.byte_ids(word[0])].sum()) * all_segmentations(lattice, word[1:])
    return total


def test_marginals_and_expected_uses():
    lattice = Lattice(PATH)
    words = [w.encode() for w in ("a", "the", "thing", "ération", "日本", "x͸y", "they're", "zq")] + [b"\xff\x00"]
    got = lattice.marginals(words)
    for w, g in zip(words, got):
        want = math.log(all_segmentations(lattice, MARK + w.decode("utf-8", "surrogateescape")))
        assert abs(g - want) < 1e-9
    long = b"abcthe" * 40
    assert abs(lattice._long(MARK + long.decode()) - lattice._forward(
        lattice._arcs([MARK + long.decode()]), len(long) + 1, 1)[-1][0]) < 1e-7
    # expected uses are the derivative of the log marginal by the log weight
    uses = lattice.expected([b"thing"], np.array([3]))
    for piece in (MARK + "thing", "ing", "th", "h"):
        k = lattice.ids[piece]
        moved = lattice.logp.copy()
        moved[k] += 1e-6
        slope = (Lattice(PATH, moved).marginals([b"thing"])[0] - lattice.marginals([b"thing"])[0]) / 1e-6
        assert abs(uses[k] - 3 * slope) < 1e-4


def check(rows, got):
    low = lambda t: [w for w in __import__("re").split(r"[\x20\x09-\x0d]+", "".join(
        c.lower() if "A" <= c <= "Z" else c for c in t or "")) if w]
    learn = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 7 != 2
    count = Counter()
    for i, t in rows:
        if learn(i):
            count.update(low(t))
            count[None] += 1
    n, v = sum(count.values()), len(count)
    want = sorted((str(i), learn(i), len(low(t)) + 1, sum(count[w] > 0 for w in [*low(t), None]), n,
                   round(sum(math.log10((count[w] + 1) / (n + v + 1)) for w in [*low(t), None]), 6)) for i, t in rows)
    assert sorted((str(r["doc_id"]), r["learn"], r["n_tokens"], r["n_known"], r["train_tokens"],
                   round(r["base_score"], 6)) for r in got) == want


def test_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = score(docs, PATH, remainder("doc_id", 7) != 2).collect()
    check([(r["doc_id"], r["text"]) for r in docs.collect()], got)
    assert all(r["score"] < 0 and math.isfinite(r["score"]) for r in got)


def test_edges(spark, frame):
    rows = [(1, None), (None, "Some words"), (2, ""), (2, ""), (3, "word " * 30000), (4, "x" * 5000), (5, "É ͸ 中文 words")]
    docs = frame(rows, ", learn string, score int, block string, payload string")
    check(rows, score(docs, PATH, remainder("doc_id", 7) != 2).collect())
    none = score(docs, PATH, F.lit(False)).collect()
    assert all(r["n_known"] == 0 and r["train_tokens"] == 0 and math.isfinite(r["score"]) for r in none)
    assert score(frame([]), PATH, F.lit(True)).count() == 0


def test_long_words_teach_pieces_as_short_ones_do(monkeypatch):
    words = [w.encode() for w in ("internationalization", "reading", "a", "déjàvu", "日本語のテキスト", "\U0001f9ff" * 3, "x" * 30)]
    lattice, counts = Lattice(PATH), np.arange(1, 8)
    want = lattice.expected(words, counts)
    monkeypatch.setattr(lm, "VECTOR_CHARS", 3)
    assert np.allclose(lattice.expected(words, counts), want, rtol=1e-9, atol=1e-12)


def test_score_by_a_plain_version(spark, frame):
    """Every score from its definition, and shares that add up to 1."""
    rows = [(i, t) for i, t in enumerate(["router", "router", "the printer", "printer", "link down", "reading", "zz", None, "the"])]
    docs, learn = frame(rows), F.col("doc_id") < 5
    for learn_from, taught in ((learn, rows[:5]), (F.lit(False), [])):
        count, n_ends = Counter(w for _, t in taught for w in (t or "").split()), len(taught)
        n = sum(count.values()) + n_ends
        keep = max(min(1 - max(sum(c == 1 for c in count.values()), 1) / n, 1 - 1 / (n + 1)), 0.0) if n else 0.0
        ends = (n_ends + 1) / (n + 2)
        end = keep * n_ends / max(n, 1) + (1 - keep) * ends
        spell = (1 - keep) * (1 - ends)
        assert abs(end + spell + keep * sum(count.values()) / max(n, 1) - 1) < 1e-12
        # piece weights: the vocabulary's and the uses in the distinct training words
        prior, words = Lattice(PATH), [w.encode() for w in sorted(count)]
        uses = prior.expected(words, np.ones(len(words))) if words else np.zeros(len(prior.logp))
        weight = uses + max(1.0, lm.PRIOR_SHARE * uses.sum()) * np.exp(prior.prior)
        lattice = Lattice(PATH, np.log(weight / weight.sum()))
        for r in score(docs, PATH, learn_from).collect():
            want = math.log10(end)
            for w in (rows[r["doc_id"]][1] or "").split():
                want += math.log10(spell * all_segmentations(lattice, MARK + w) + (keep * count[w] / n if n else 0.0))
            assert abs(r["score"] - want) < 1e-6, (r, want)
