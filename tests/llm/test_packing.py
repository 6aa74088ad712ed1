import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from sparkpanel.llm import queries
from sparkpanel.llm.packing import OpenWindows, WordIds, pack

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def test_ids_are_the_library_s(tokenizer, corpus):
    rng = random.Random(3)
    texts = ["".join(rng.choice("abcS'stdé  __-!.,²Ⅷ5½\n\t\xa0́eΣİ中文ßǅ😀𐐀\x1c") for _ in range(rng.choice([0, 1, 5, 60]))) for _ in range(2000)]
    texts += [t or "" for _, t in corpus] + ["<|endoftext|> x", "x <|endoftext|> y", "a<|STARTOFTEXT|>b", "<| endoftext |>", "DON'T we'll !'s ''s _'s"]
    for text, ids in zip(texts, WordIds(PATH).encode(texts), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids, text


def alternating(n, a, b):
    """The word of n letters that alternates by the parity of the place's bits: its polynomial hashes collide with those of its complement."""
    return "".join(a if bin(i).count("1") % 2 == 0 else b for i in range(n))


@pytest.mark.parametrize("n", [1024, 2048])
def test_words_that_alternate_by_bit_parity_are_told_apart(tokenizer, n):
    texts = [f"{alternating(n, 'a', 'b')} {alternating(n, 'b', 'a')}"]
    assert np.frombuffer(WordIds(PATH).encode(texts)[0], "<u4").tolist() == tokenizer.encode(texts[0], add_special_tokens=False).ids


def test_equal_hashes_and_a_full_memory_do_no_harm(tokenizer, corpus, monkeypatch):
    from sparkpanel.llm import packing

    texts = [t or "" for _, t in corpus if len(t or "") < 3000]
    want = [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    full = packing.run_hashes
    for most, hashes in ((5, full), (40, full), (250_000, lambda h, a, b: full(h, a, b) & np.uint64(0xF << 50))):
        monkeypatch.setattr(packing, "REMEMBERED", most)
        monkeypatch.setattr(packing, "run_hashes", hashes)
        words = WordIds(PATH)
        for k in range(0, len(texts), 7):
            assert [np.frombuffer(x, "<u4").tolist() for x in words.encode(texts[k : k + 7])] == want[k : k + 7]


def check(rows, want, length):
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    assert set(by_doc) == set(want)
    for doc, pieces in by_doc.items():
        at = 0
        for r in sorted(pieces, key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(want[doc]) and bytes(r.ids) == want[doc][at : at + r.length].tobytes()
            at += r.length
        assert at == len(want[doc])
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= length and at & (at - 1) == 0
    return by_sequence


@pytest.mark.parametrize("length, windows", [(4096, 32), (64, 3), (1, 1)])
def test_pieces_and_sequences(documents, corpus, tokenizer, length, windows):
    want = {i: np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 2], "<u4") for i, t in corpus}
    rows = pack(documents, "doc_id", "text", PATH, 2, length, windows).collect()
    sequences = check(rows, want, length)
    total = sum(map(len, want.values()))
    assert sum(sum(r.length for r in s) < length for s in sequences.values()) <= 12 and sum(r.length for r in rows) == total


def test_best_fit_and_fullest():
    packer = OpenWindows(10, 2)
    piece = lambda doc, n: (doc, 0, bytes(4 * n), n)
    assert list(packer.add(piece(1, 4))) == [] and list(packer.add(piece(2, 7))) == []
    # 3 fits both; it goes where the least space is left, and fills it.
    assert [[p[0] for p in s] for s in packer.add(piece(3, 3))] == [[2, 3]]
    assert list(packer.add(piece(4, 8))) == []
    # 7 fits neither: the fullest takes its first two, the rest needs a new sequence.
    assert [[(p[0], len(p[2]) // 4) for p in s] for s in packer.add(piece(5, 7))] == [[(4, 8), (5, 2)]]
    assert [(p[0], p[1], len(p[2]) // 4) for p in packer.rest()] == [(1, 0, 4), (5, 2, 5)] or len(packer.rest()) == 2


def test_null_ids_repeated_rows_and_empty_table(spark):
    df = spark.createDataFrame([(None, "a b"), (1, "c"), (1, "c"), (2, None)], "id long, text string")
    rows = pack(df, "id", "text", PATH, 2).collect()
    assert sorted((str(r.doc_id), r.doc_tokens) for r in rows if r.start == 0) == [("1", 2), ("1", 2), ("2", 1), ("None", 3)]
    assert pack(df.limit(0), "id", "text", PATH, 2).count() == 0


def test_query(spark, tokenizer):
    sf = "/root/testdata/sf0.001"
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    for r in queries.op1_packing(spark, sf).collect():
        ids = np.array([*tokenizer.encode(docs[r.doc_id] or "", add_special_tokens=False).ids, 2], "<u4")
        assert r.ids_crc32 == zlib.crc32(ids[r.start : r.start + r.length].tobytes())
