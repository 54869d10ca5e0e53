"""Byte-level BPE against tiktoken, stitching of chunks, round trips."""
import base64
import hashlib
import random

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

import __spark_entry__ as E
from veilspark.llm import bpe


@pytest.fixture(scope="module")
def reference():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path("byte_bpe_50k.tiktoken"), "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def encoder():
    return bpe.Tokenizer(P.path("byte_bpe_50k.tiktoken"), P.PATTERN).encoder()


def ids(raw):
    return np.frombuffer(raw, dtype="<u4").tolist()


TEXTS = st.text(st.sampled_from("ab  \n\t'sretml.,!?12²\xa0é\x1c一 ́😀") | st.characters(codec="utf-8"), max_size=80)


@settings(max_examples=60, deadline=None)
@given(st.lists(TEXTS, min_size=1, max_size=40))
def test_ids_are_tiktokens(reference, encoder, texts):
    got = encoder.encode_many(texts)
    assert [ids(x) for x in got] == [reference.encode_ordinary(t) for t in texts]
    assert [encoder.decode(x) for x in got] == [t.encode() for t in texts]


@pytest.mark.parametrize("text", ["a" * 700, " " * 500 + "x", "ab" * 300, "é" * 100, "<|endoftext|>", "x \n\n y  z ", ""])
def test_long_runs_and_specials(reference, encoder, text):
    assert ids(encoder.encode_many([text])[0]) == reference.encode_ordinary(text)


def _hard_texts():
    rng = random.Random(3)
    out = ["".join(rng.choice("abc  \n\t's're!?1é ") for _ in range(rng.randint(0, 900))) for _ in range(60)]
    return [*out, "a" * 1000, " " * 400 + "b" * 300, "'s" * 300, "don't " * 100, "!'" * 250 + "re" * 50, None, "", "a"]


def test_chunks_stitch_to_the_same_ids(spark, reference):
    """Small chunks, so that cuts fall everywhere; runs longer than the overlap take the whole-text way."""
    tok = bpe.Tokenizer(P.path("byte_bpe_50k.tiktoken"), P.PATTERN, chunk_chars=64, overlap=16)
    texts = _hard_texts()
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(4)
    got = {r["doc_id"]: (ids(bytes(r["ids"])), bytes(r["decoded"])) for r in tok.decode(tok.encode(docs)).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        assert got[i] == (reference.encode_ordinary(t or ""), (t or "").encode()), i
    long = spark.createDataFrame([("k", "word and " * 60)], "key string, text string")
    assert tok.pieces(long).count() > 3  # stitched, not taken whole


def test_round_trip_column_agrees_with_both_ways(spark, reference):
    tok = bpe.Tokenizer(P.path("byte_bpe_50k.tiktoken"), P.PATTERN, chunk_chars=64, overlap=16)
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(_hard_texts())], "doc_id long, text string").repartition(3)
    rows = tok.encode(docs, decoded="back").collect()
    assert len(rows) == len(_hard_texts())
    for r in rows:
        assert ids(bytes(r["ids"])) == reference.encode_ordinary(r["text"] or "") and bytes(r["back"]).decode() == (r["text"] or "")


def test_token_list(encoder):
    raw = open(P.path("byte_bpe_50k.tiktoken"), "rb").read()
    assert bpe.token_list(raw) == encoder.tokens and len(encoder.tokens) == 50_256
    assert bpe.token_list(b"YQ== 0\nYg== 2\n") == [b"a", b"", b"b"]


def test_query_against_tiktoken(spark, sf_dir, reference):
    """op1 by the library itself: counts and digests of ids and of decoded bytes."""
    want = {}
    for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect():
        found = np.array(reference.encode_ordinary(r["text"] or ""), dtype="<u4")
        want[r["doc_id"]] = (len(found), hashlib.sha256(found.tobytes()).hexdigest(), hashlib.sha256((r["text"] or "").encode()).hexdigest())
    got = E.queries()["op1_byte_bpe"](spark, sf_dir)
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert {r[0]: tuple(r)[1:] for r in got.collect()} == want


def test_repeats_nulls_and_clashing_names(spark):
    tok = bpe.Tokenizer(P.path("byte_bpe_50k.tiktoken"), P.PATTERN, chunk_chars=64, overlap=16)
    rows = [(1, "long text " * 30, "x", 1), (1, "long text " * 30, "x", 1), (None, "long text " * 30, "y", 2), (2, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, key_ string, ids long")
    out = tok.encode(docs, out="tokens")
    assert out.columns == ["doc_id", "text", "key_", "ids", "tokens"]
    assert out.count() == 4 and out.select("tokens").distinct().count() == 2
    empty = tok.decode(tok.encode(docs.limit(0)))
    assert empty.count() == 0
