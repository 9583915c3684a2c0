import hashlib

import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from casemine.llm.bpe import decode, encode, load

PATH = public_tokenizers.path("word_bpe_49k.json")
LIB = Tokenizer.from_file(PATH)


def same(text):
    want = LIB.encode(text, add_special_tokens=False).ids
    ids = load(PATH).encode(text)
    assert [int.from_bytes(ids[i:i + 4], "little") for i in range(0, len(ids), 4)] == want, text[:200]
    assert load(PATH).decode(ids) == LIB.decode(want, skip_special_tokens=False)


def test_fixed_texts():
    for t in ["", " ", "a", "Hello, World's don't  we'll 123\n\t<|endoftext|>x<|startoftext|>", "ΑΣ ΣΑΣ İstanbul ǅ ß",
              "a" * 3000, "abc" * 2000, "é ẛ̣ ﬁ Å", "\x1c\x1d\x85\xa0 x　y​z", "日本語 ١٢٣ ½ ⅷ 𝔘 👩‍👩‍👧",
              "!!!???...'s 's'S ''ll", "x<|endoftext|><|endoftext|> <|EndOfText|>", "﻿\x00\x01 à́"]:
        same(t)


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_any_text(t):
    same(t)


def test_table(spark, frame, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in encode(docs, PATH, decoded=True).collect():
        want = LIB.encode(texts[r["doc_id"]], add_special_tokens=False).ids
        assert r["n_tokens"] == len(want)
        assert bytes(r["ids"]) == b"".join(i.to_bytes(4, "little") for i in want)
        assert r["decoded"] == LIB.decode(want, skip_special_tokens=False)


def test_edges(spark, frame):
    docs = frame([(1, None), (None, "x"), (2, ""), (2, ""), (3, "word " * 60000)], ", ids string, n_tokens string")
    enc = encode(docs, PATH)
    got = {(r["doc_id"], r["n_tokens"]) for r in enc.collect()}
    assert got == {(1, 0), (None, 1), (2, 0), (3, 60000)}
    assert {r["decoded"][:6] for r in decode(enc, PATH).collect()} == {"", "x</w>", "word</"}
    assert encode(frame([]), PATH).count() == 0


def test_query_digests(spark, sf_dir):
    from casemine.llm.queries import QUERIES
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    got = QUERIES["op1_bpe"](spark, sf_dir).collect()
    assert len(got) == len(docs)
    for r in got[:50]:
        ids = LIB.encode(docs[r["doc_id"]], add_special_tokens=False).ids
        raw = b"".join(i.to_bytes(4, "little") for i in ids)
        assert r["ids_sha256"] == hashlib.sha256(raw).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(LIB.decode(ids, skip_special_tokens=False).encode()).hexdigest()
