import random

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline as cp
from casemine.llm import quality, simhash
from tests.llm.test_decontaminate import grams
from tests.llm.test_simhash import plain_fingerprint
from tests.llm.test_suffix_dedup import brute


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    """Every stage's output, each computed from the written one before."""
    sf_dir = "/root/testdata/sf0.001"
    docs, out = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    for name, stage in cp.STAGES:
        path = str(tmp_path_factory.mktemp("stage") / name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        out.append(docs)
    return sf_dir, out


def rows(df):
    return {r["doc_id"]: r["text"] for r in df.collect()}


def test_schemas(spark, steps):
    sf_dir, out = steps
    first = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert [d.dtypes for d in out[:-1]] == [first.dtypes] * 4
    assert [n for n, _ in cp.STAGES] == ["quality", "near_duplicates", "repeated_passages", "decontamination", "encoding"]


def test_stages(spark, steps):
    sf_dir, out = steps
    first = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = quality.fit(first, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    good = quality.classify(first, model, F.col("source"), F.col("lang")).where("keep")
    assert set(rows(out[0])) == {r["doc_id"] for r in good.collect()}
    # one document of each component of fingerprints within three bits
    fps = {i: plain_fingerprint(t) for i, t in rows(out[0]).items()}
    kept, left = set(), dict(fps)
    while left:
        group, front = set(), [min(left)]
        while front:
            i = front.pop()
            group.add(i)
            near = [j for j in left if j not in group and j not in front and bin(fps[i] ^ fps[j]).count("1") <= 3]
            front += near
        kept.add(min(group))
        left = {i: f for i, f in left.items() if i not in group}
    assert set(rows(out[1])) == kept
    before = {i: t for i, t in rows(out[1]).items()}
    want = {r[0]: r[1] - r[2] for r in brute(list(before.items()))}
    after = rows(out[2])
    assert set(after) == set(before)
    for i, t in after.items():
        assert want[i] - 6 <= len(t.encode()) <= want[i]
        assert want[i] != len(before[i].encode()) or t == before[i]
    items = [grams(r["text"]) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    clean = {i for i, t in after.items() if not any(q and len(q & grams(t)) >= 0.8 * len(q) for q in items)}
    assert set(rows(out[3])) == clean
    lib = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    ids = {r["doc_id"]: bytes(r["ids"]) for r in out[4].collect()}
    assert set(ids) == clean
    for i, t in rows(out[3]).items():
        assert ids[i] == b"".join(x.to_bytes(4, "little") for x in lib.encode(t, add_special_tokens=False).ids)


def test_run(spark, steps):
    sf_dir, out = steps
    got = {r["doc_id"]: bytes(r["ids"]) for r in cp.run(spark, sf_dir).collect()}
    assert got == {r["doc_id"]: bytes(r["ids"]) for r in out[4].collect()}


def test_odd_rows(spark, frame, tmp_path):
    prose = lambda k: " ".join(f"word{(k * 7919 + j * 31) % 997}" for j in range(60)) + "."
    data = [(1, prose(1)), (1, prose(1)), (None, prose(2)), (None, prose(2)), (None, None), (2, None), (3, ""), (4, "é" * 200),
            (5, "a" + "é" * 200), (6, prose(6) + " " + prose(7)), (7, prose(7) + " " + prose(8))]
    docs = frame([(i, t, "fr", "s", 1) for i, t in data], ", text_hash string, h int, row string, kept string")
    spark.createDataFrame([], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, prose(6))], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for k, (name, stage) in enumerate(cp.STAGES[:-1]):
        stage(spark, docs, str(tmp_path)).write.parquet(f"{tmp_path}/{name}")
        after = spark.read.parquet(f"{tmp_path}/{name}")
        assert after.columns == docs.columns
        docs = after
    left = sorted(((r["doc_id"], r["text"], r["n_chars"]) for r in docs.collect()), key=str)
    assert [i for i, _, _ in left] == [1, 2, 4, 5, 7, None]
    assert all(t is None and n is None or len(t) == n for _, t, n in left)
    empty = frame([])
    for _, stage in cp.STAGES:
        assert stage(spark, empty, str(tmp_path)).count() == 0
    assert simhash.fingerprint(None) == 0


def test_cut_inside_characters(spark, frame):
    """The passage starts and ends inside characters; both go, and no other
    character, nor do their halves make a new one."""
    rng = random.Random(5)
    shared = "".join(rng.choice("abcdefgh ") for _ in range(300))
    data = [(1, "one é" + shared + "é end"), (2, "\ufffd two ĩ" + shared + "è \ufffd end")]
    got = {r["doc_id"]: (r["text"], r["n_chars"]) for r in cp.cut_repeats(spark, frame(data), "").collect()}
    assert got == {1: (data[0][1], len(data[0][1])), 2: ("\ufffd two  \ufffd end", 12)}


def test_a_column_with_a_helpers_name_stays(spark, frame):
    docs = frame([(1, "one two three four", None, None, 18, "a"), (1, "one two three four", None, None, 18, "a"),
                  (2, "something else entirely here", None, None, 28, "b")], ", `_H` string")
    got = cp.keep_one_of_near_copies(spark, docs, None)
    assert got.columns == docs.columns and sorted((r["doc_id"], r["_H"]) for r in got.collect()) == [(1, "a"), (2, "b")]
