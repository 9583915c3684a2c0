import zlib

from pyspark.sql import functions as F

from casemine.llm.sharding import permute, shard


def test_permutation_is_a_bijection(spark):
    for n in (1, 2, 3, 5, 24, 97, 1000, 1025, 10007):
        got = sorted(r[0] for r in spark.range(n).select(permute(F.col("id"), n, 5)).collect())
        assert got == list(range(n))


def test_shards_slots_and_sizes(spark, frame):
    rows = [(i, "t" * (i % 7)) for i in range(200)] + [(None, None), (3, "ttt"), (3, "ttt"), (4, ""), (5, None), (6, "é")]
    got = shard(frame(rows, ", size long, slot string, _row string"), 24).collect()
    assert len(got) == len(rows)
    by = {}
    for r in got:
        by.setdefault(r["shard"], []).append(r["slot"])
    assert sorted(by) == list(range(24))
    assert all(sorted(v) == list(range(len(v))) for v in by.values())
    assert max(map(len, by.values())) - min(map(len, by.values())) <= 1
    texts = {(i, t) for i, t in rows}
    want = {(i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in texts}
    assert {(r["doc_id"], r["size"], r["text_crc32"]) for r in got} == want
    assert {r["law"] for r in got} == {"rows"} and {r["grown_shard"] for r in got} == {None}


def test_reproducible_and_empty(spark, frame):
    docs = frame([(i, str(i)) for i in range(50)])
    once = sorted(map(tuple, shard(docs, 4).collect()), key=str)
    again = sorted(map(tuple, shard(docs.repartition(5), 4).collect()), key=str)
    assert once == again
    assert shard(frame([]), 24).count() == 0
