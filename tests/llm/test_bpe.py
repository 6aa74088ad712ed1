import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from sparkpanel.llm import queries
from sparkpanel.llm.bpe import Bpe, bpe_decode, bpe_encode, read_ranks

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=read_ranks(PATH), special_tokens={})


def test_ids_are_the_library_s(library):
    bpe, rng = Bpe(read_ranks(PATH), public_tokenizers.PATTERN), random.Random(2)
    texts = ["".join(rng.choice("abcdeé thé!  \n12¡中文") for _ in range(rng.choice([0, 1, 3, 50, 300]))) for _ in range(500)]
    texts += ["a" * 300 + "b" * 257, "ab" * 5000, "x" * 70, " " * 900, "thethethe" * 40, "\x00é" * 20, "Donaudampfschifffahrt" * 30, "<|endoftext|>", "z" * 40_000]
    for text, ids in zip(texts, bpe.encode(texts), strict=True):
        want = library.encode_ordinary(text)
        assert np.frombuffer(ids, "<u4").tolist() == want
        assert bpe.decode(want) == text.encode()


def test_leftmost_least_rank_where_merges_overlap():
    # xab has a lower rank than ab, so a merge makes a pair that goes before later equal ones.
    ranks = {bytes([b]): b for b in range(256)} | {b"xab": 256, b"ab": 257, b"abab": 258, b"ba": 259}
    bpe = Bpe(ranks, r"[\s\S]+")
    library = tiktoken.Encoding("own", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={})
    rng = random.Random(4)
    for _ in range(300):
        text = "".join(rng.choice("xab") for _ in range(rng.choice([5, 30, 400])))
        assert np.frombuffer(bpe.encode([text])[0], "<u4").tolist() == library.encode_ordinary(text)


def test_round_trip_with_clashing_columns(documents, corpus, library):
    encoded = bpe_encode(documents.withColumnRenamed("kept", "ids"), "text", PATH, public_tokenizers.PATTERN)
    got = {r.doc_id: r for r in bpe_decode(encoded, "ids", PATH, out="score").collect()}
    for i, text in corpus:
        assert got[i].ids == library.encode_ordinary(text or "") and bytes(got[i].score) == (text or "").encode() and got[i].n_words == 7


def test_empty_table_and_null_ids(spark):
    df = spark.createDataFrame([], "id long, text string")
    assert bpe_decode(bpe_encode(df, "text", PATH, public_tokenizers.PATTERN), "ids", PATH).count() == 0
    null = spark.createDataFrame([(1, None)], "id long, ids array<int>")
    assert bpe_decode(null, "ids", PATH).collect()[0].decoded is None


def test_query(spark, library):
    sf = "/root/testdata/sf0.001"
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    for r in queries.op5_bpe(spark, sf).collect():
        ids = library.encode_ordinary(docs[r.doc_id])
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(docs[r.doc_id].encode()).hexdigest()
