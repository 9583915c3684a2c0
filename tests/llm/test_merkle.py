import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from casemine.llm import merkle
from casemine.llm.queries import QUERIES


def h(s):
    return hashlib.sha256(s.encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def tree(leaves):
    """Root, and per leaf its path of (left, right)."""
    paths, nodes = [[] for _ in leaves], [(x, [i]) for i, x in enumerate(leaves)]
    while len(nodes) > 1:
        up = []
        for at in range(0, len(nodes), 3):
            run = nodes[at:at + 3]
            for j, (_, under) in enumerate(run):
                for i in under:
                    paths[i].append(("".join(d for d, _ in run[:j]), "".join(d for d, _ in run[j + 1:])))
            up.append((h("".join(d for d, _ in run)), sum((u for _, u in run), [])))
        nodes = up
    return nodes[0][0], paths


def plain(rows):
    """The whole manifest over (doc_id, text, lang, source, n_chars) rows."""
    def leaf(r, text):
        return h("".join(map(field, (r[0], r[3], r[2], r[4], text))))
    groups = {}
    for r in rows:
        groups.setdefault(r[3], []).append(r)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    made = []
    for g in order:
        groups[g].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r, r[1])))
        made.append(tree([leaf(r, r[1]) for r in groups[g]]))
    if not made:
        return []
    root, above = tree([m[0] for m in made])
    out = []
    for g, (sub, paths), up in zip(order, made, above):
        for r, path in zip(groups[g], paths):
            tampered = r[0] is not None and r[1] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0
            now = leaf(r, r[1].replace("\n", "") if tampered else r[1])
            for left, right in path + up:
                now = h(left + now + right)
            out.append((r[0], leaf(r, r[1]), sub, root, h("".join(a + b for a, b in path + up)), now, now == root))
    return out


def run(docs):
    hit = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(2)) == 0
    got = merkle.manifest(docs, ["doc_id", "source", "lang", "n_chars", "text"], "source", changed=hit,
                          today={"text": F.replace("text", F.lit("\n"), F.lit(""))})
    return got.select("doc_id", "leaf", "subroot", "root", merkle.proof(F.col("path")), "folded_root",
                      F.col("folded_root") == F.col("root"))


def key(r):
    return tuple((x is not None, x) for x in r)


def same(docs, rows):
    assert sorted(map(tuple, run(docs).collect()), key=key) == sorted(plain(rows), key=key)


@pytest.mark.parametrize("sizes", [[1], [3], [4], [28, 1, 3], [1] * 11, [82, 27, 5, 4, 2]])
def test_shapes(frame, sizes):
    rows = [(1000 * g + i, f"a\nb{i}" * (i % 3), "en", f"s{g}", i) for g, n in enumerate(sizes) for i in range(n)]
    same(frame(rows), rows)


def test_odd_rows(frame):
    rows = [(1, None, None, None, None), (None, "x\n", "de", None, 2), (None, None, None, None, None),
            (None, None, None, None, None), (2, "", "", "", 0), (2, "", "", "", 0), (2, "b\nä", "-", "é", 3),
            (-5, "1:a" * 200000, "fr", "z", 1), (7, "\n\n", "en", "ée", 2), (10, "t", "en", "é", 1)]
    extra = ", leaf string, lo string, tree string, size string, bucket string, `group` string, path string"
    same(frame(rows, extra), rows)
    assert run(frame([])).count() == 0 and run(frame([])).columns[:2] == ["doc_id", "leaf"]


def test_whole_table(spark, sf_dir):
    rows = [(r["doc_id"], r["text"], r["lang"], r["source"], r["n_chars"])
            for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    got = [tuple(r) for r in QUERIES["op13_merkle"](spark, sf_dir).collect()]
    assert sorted(got, key=key) == sorted(plain(rows), key=key)
    assert {r[-1] for r in got} == {True, False}
