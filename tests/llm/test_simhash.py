import random

import numpy as np
from xxhash import xxh64_intdigest

from casemine.llm import simhash
from casemine.llm.components import components
from casemine.llm.simhash import fingerprint, link_sorted, links, near_duplicates, references


def plain_fingerprint(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    grams = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def plain_components(rows):
    fps = [plain_fingerprint(t) for _, t in rows]
    group = list(range(len(rows)))
    arr = np.array(fps, dtype=np.uint64)
    for i in range(len(rows)):
        for j in np.flatnonzero(np.bitwise_count(arr ^ arr[i]) <= 3):
            a, b = group[i], group[j]
            if a != b:
                group = [min(a, b) if g in (a, b) else g for g in group]
    ids = {}
    for (i, _), g in zip(rows, group):
        ids[g] = min((x for x in (i, ids.get(g)) if x is not None), default=None)
    return sorted(((i, f"{f:016x}", ids[g]) for (i, _), f, g in zip(rows, fps, group)), key=str)


def got(df):
    return sorted(((r["doc_id"], r["fingerprint"], r["component_id"]) for r in df.collect()), key=str)


def test_fingerprint():
    for t in (None, "", " \t", "One", "one two", "A b C", "a b c d", "É a\x0bB\x85c d", "x y z " * 50):
        assert fingerprint(t) == plain_fingerprint(t)


def test_long_texts_in_pieces(monkeypatch):
    text = " ".join(f"W{i * 7 % 31}" + "\t\n"[i % 2] * (i % 3) for i in range(500)) + " end"
    monkeypatch.setattr(simhash, "PIECE_BYTES", 40)
    for t in (text, "one two", "one", "a" * 200, " " * 100, "a b " + " " * 90 + "c"):
        assert fingerprint(t) == plain_fingerprint(t)


def test_links_against_all_pairs(spark):
    rng = random.Random(4)
    base = [rng.getrandbits(64) for _ in range(60)]
    fps = {b ^ sum(1 << rng.randrange(64) for _ in range(rng.randrange(7))) & (2 ** 64 - 1)
           for b in base for _ in range(12)}
    centre = base[0]
    fps |= {centre ^ (1 << i) ^ (1 << j) for i in range(20) for j in range(20)}  # one dense bucket
    arr = np.array(sorted(fps), dtype=np.uint64)
    want = np.arange(len(arr))
    simhash._fold(want, *np.nonzero(np.bitwise_count(arr[:, None] ^ arr[None, :]) <= 3))
    one = link_sorted(np.zeros(len(arr), dtype=np.int64), arr, 3, references())
    assert (one == want).all()
    for limit in (20_000, 5):  # the second deals nearly all buckets again
        simhash.BUCKET_ROWS, kept = limit, simhash.BUCKET_ROWS
        nodes = spark.createDataFrame([(int(x),) for x in arr.view(np.int64)], "fp long")
        root = {r["node"]: r["root"] for r in components(links(nodes)).collect()}
        simhash.BUCKET_ROWS = kept
        signed = arr.view(np.int64)
        group = {}
        for i, x in enumerate(signed):
            group.setdefault(root.get(int(x), int(x)), set()).add(want[i])
        assert all(len(g) == 1 for g in group.values()) and len(group) == len(set(want))


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7)]
    got_ = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got_ == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(30)}}


def test_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert got(near_duplicates(docs)) == plain_components(rows)


def test_edges(spark, frame):
    rows = [(5, None), (4, ""), (None, " \n"), (None, "solo text with several words here"), (9, "same words in here now"),
            (9, "same words in here now"), (2, "same words in here now"), (7, "w " * 30000)]
    docs = frame(rows, ", fp long, component_id string, fingerprint int")
    assert got(near_duplicates(docs)) == plain_components(rows)
    assert near_duplicates(frame([])).count() == 0
