import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from casemine.llm import suffix_dedup as sd
from casemine.llm.suffix_dedup import dedup, two_stage


def brute(rows):
    """Every 100-byte string's first place over all documents."""
    import hashlib
    from collections import defaultdict
    docs = sorted({(i is None, i or 0, t or "") for i, t in rows})
    by = defaultdict(list)
    for null, i, t in docs:
        by[null, i].append(t)
    first, out = {}, {}
    for null, i, t in docs:
        assert len(by[null, i]) == 1 or len({x for x in by[null, i] if len(x.encode()) >= 100}) <= 1
        raw = t.encode()
        gone = np.zeros(len(raw), dtype=bool)
        for p in range(len(raw) - 99):
            s = raw[p:p + 100]
            if s in first:
                gone[p:p + 100] = True
            else:
                first[s] = (null, i, p)
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        spans = int((gone & ~np.r_[False, gone[:-1]]).sum()) if len(gone) else 0
        out[null, i, t] = (len(raw), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest())
    return sorted(((i, *out[i is None, i or 0, t or ""]) for i, t in rows), key=str)


def got(df):
    import hashlib
    return sorted(((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], hashlib.sha256(r["kept"]).hexdigest())
                   for r in df.collect()), key=str)


def test_two_stage_order():
    rng = np.random.default_rng(2)
    for alphabet in (2, 3, 40):
        body = rng.integers(1, alphabet + 1, 900).astype(np.uint8)
        text = np.r_[np.uint8(0), body, np.zeros(8 * sd.WORDS + 8, dtype=np.uint8)]
        active = np.r_[False, np.ones(len(body), dtype=bool), np.ones(1, dtype=bool)]
        active = np.r_[active, np.zeros(len(text) - len(active), dtype=bool)]
        rows = two_stage(text, active, sd._words(text))
        assert sorted(rows.tolist()) == np.flatnonzero(active).tolist()
        keys = [text[i:i + sd.LENGTH].tobytes() for i in rows]
        assert keys == sorted(keys)
        shared = sd.common_prefixes(rows, sd._words(text))
        for a, b, n in zip(keys, keys[1:], shared[1:]):
            assert n == next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), 100)


def corpus(seed=1):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefé") for _ in range(rng.randint(1, 9)))
    prose = lambda n: " ".join(word() for _ in range(n))
    shared = [prose(60) for _ in range(6)]
    rows = []
    for i in range(120):
        parts = [prose(rng.randint(0, 60))]
        for _ in range(rng.randint(0, 3)):
            s = rng.choice(shared)
            a = rng.randrange(len(s) // 2)
            parts += [s[a:a + rng.randint(60, 400)], prose(rng.randint(0, 20))]
        rows.append((i * 3 % 361, " ".join(parts)))
    rows += [(1000 + i, rows[5][1]) for i in range(4)]
    rows += [(2000, "ab" * 400), (2001, "x" + "ab" * 70), (2002, "For " * 300), (2003, "For " * 30), (2004, "z" * 99),
             (2005, "z" * 100), (2006, "z" * 101), (2007, "\0" * 150), (2008, "a" + "\0" * 120)]
    return rows


def test_long_texts_in_pieces(monkeypatch):
    raw = np.random.default_rng(5).integers(97, 101, 5000).astype(np.uint8)
    whole = sd.seeds(raw)
    starts = lambda s: [(int(a) + i, int(h)) for a, n, h in zip(s["at"], s["n"], s["h"]) for i in range(n)]
    monkeypatch.setattr(sd, "PIECE_BYTES", 700)
    assert starts(sd.seeds(raw)) == starts(whole) and len(starts(whole)) == 4901


@pytest.mark.parametrize("hot", [10_000, 2])
def test_against_brute_force(spark, frame, hot):
    rows = corpus()
    docs = frame([(i, t) for i, t in rows], ", dk string, th int, block string, payload string").repartition(5)
    assert got(dedup(docs, hot=hot)) == brute(rows)


def test_hot_seed_reaches_no_task_whole(spark, frame):
    """A passage that all documents share: its edges differ from document to
    document but have one seed."""
    rng = random.Random(4)
    noise = lambda: "".join(rng.choice("ghijkl ") for _ in range(150))
    shared = "".join(rng.choice("mnopqr ") for _ in range(300))
    rows = [(i, noise() + shared + noise()) for i in range(400)]
    docs = frame(rows).select(F.col("doc_id").alias("dk"), F.xxhash64("text").alias("th"),
                              F.col("text").cast("binary").alias("text")).repartition(4).cache()
    hot = sd.hot_seeds(docs, sum(len(t) for _, t in rows), 50)
    batches = docs.toArrow().to_batches()
    dealt = {}
    for batch in sd._seed_rows(batches, 16, 4, hot):
        for bucket, block, payload in zip(*(batch.column(i).to_pylist() for i in range(3))):
            for h in sd.unpack(sd.SEEDS, payload)[0]["h"].tolist() if block < 0 else ():
                dealt.setdefault(h, []).append(bucket)
    most = max(dealt.values(), key=len)
    assert len(most) >= 400 and max(most.count(b) for b in set(most)) <= 50
    assert got(dedup(frame(rows), hot=50)) == brute(rows)


def test_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert got(dedup(docs)) == brute([(r["doc_id"], r["text"]) for r in docs.collect()])


def test_edges(spark, frame):
    base = "one long line that goes on and on without an end in sight, number after number " + " ".join(map(str, range(80)))
    rows = [(5, base), (5, base), (9, base), (None, base), (None, None), (6, None), (7, ""), (5, "short"),
            (8, base + " tail"), (10, " ".join(map(str, range(40000))))]
    assert got(dedup(frame(rows))) == brute(rows)
    assert dedup(frame([])).count() == 0
