import random

import numpy as np
import pyarrow as pa
import pytest

from sparkpanel.llm import repeats
from sparkpanel.llm.substrings import drop_repeated_words
from sparkpanel.llm.suffixes import _inward, cover, drop_repeated_bytes, equal_windows
from sparkpanel.llm.units import Bytes, Runs, Words, sliding_min


def words_left(rows, window):
    """Brute force: {row: (words, words that stay)} for (id, text) rows, by rows since ids may repeat."""
    split = [(i, (t or "").encode().split()) for i, t in rows]
    least = {}
    for i, w in split:
        for a in range(len(w) - window + 1):
            k = tuple(w[a : a + window])
            least[k] = min(least.get(k, i), i)
    out = {}
    for i, w in split:
        gone = [False] * len(w)
        for a in range(len(w) - window + 1):
            if least[tuple(w[a : a + window])] < i:
                gone[a : a + window] = [True] * window
        out[i] = (len(w), b" ".join(x for x, g in zip(w, gone, strict=True) if not g).decode())
    return out


def spans_left(rows, length):
    """Brute force: {id: (removed spans, bytes that stay)}."""
    seen = {}
    for _, t in rows:
        b = (t or "").encode()
        for a in range(len(b) - length + 1):
            seen[b[a : a + length]] = seen.get(b[a : a + length], 0) + 1
    out = {}
    for i, t in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for a in range(len(b) - length + 1):
            if seen[b[a : a + length]] > 1:
                gone[a : a + length] = b"\1" * length
        edge = np.flatnonzero(np.diff(np.concatenate([[0], np.frombuffer(bytes(gone), np.uint8), [0]])))
        out[i] = (list(zip(edge[0::2].tolist(), edge[1::2].tolist(), strict=True)), bytes(x for x, g in zip(b, gone, strict=True) if not g))
    return out


@pytest.mark.parametrize("hot, copies", [(5000, 200), (1, 10**6), (5000, 2), (1, 2)])
def test_words_against_brute_force(documents, corpus, monkeypatch, hot, copies):
    monkeypatch.setattr(repeats, "HOT", hot)
    monkeypatch.setattr(repeats, "COPIES", copies)
    want = words_left(corpus, 20)
    got = drop_repeated_words(documents, "doc_id", "text", window=20).collect()
    assert len(got) == len(corpus)
    for r in got:
        n, kept = want[r.doc_id]
        assert (r.n_words, r.kept_text, r.n_removed) == (n, kept, n - len(kept.encode().split())) and r.score == "s"


@pytest.mark.parametrize("hot, copies", [(5000, 200), (1, 10**6), (5000, 2), (1, 2)])
def test_bytes_against_brute_force(documents, corpus, monkeypatch, hot, copies):
    monkeypatch.setattr(repeats, "HOT", hot)
    monkeypatch.setattr(repeats, "COPIES", copies)
    want = spans_left(corpus, 200)
    got = drop_repeated_bytes(documents, "doc_id", "text", length=200).collect()
    assert len(got) == len(corpus)
    for r in got:
        spans, kept = want[r.doc_id]
        assert [(s["from"], s["to"]) for s in r.spans] == spans and bytes(r.kept) == kept and r.n_removed == r.n_bytes - len(kept)


def test_windows_are_judged_on_the_input(spark):
    rng = random.Random(1)
    letters = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    a, b = letters(500), letters(500)
    # b stands in a text of which a covers a part, so both go although removal of one breaks the other.
    rows = [(1, a + b), (2, a[100:] + b[:300]), (3, letters(50) + a[200:] + letters(30)), (4, "xy" * 400), (5, letters(199))]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    want = spans_left(rows, 160)
    for r in drop_repeated_bytes(df, "doc_id", "text", length=160).collect():
        assert [(s["from"], s["to"]) for s in r.spans] == want[r.doc_id][0]


def test_null_ids_repeated_rows_and_empty_tables(spark):
    long = " ".join(f"w{i}" for i in range(60))
    rows = [(None, long), (2, long), (2, long), (3, long), (4, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((str(r.doc_id), r.n_words, r.n_removed) for r in drop_repeated_words(df, "doc_id", "text").collect())
    assert got == [("2", 60, 0), ("2", 60, 0), ("3", 60, 60), ("4", 0, 0), ("None", 60, 0)]
    bytes_ = sorted((str(r.doc_id), r.n_bytes, r.n_removed) for r in drop_repeated_bytes(df, "doc_id", "text", 160).collect())
    n = len(long)
    assert bytes_ == [("2", n, n), ("2", n, n), ("3", n, n), ("4", 0, 0), ("None", n, 0)]
    assert drop_repeated_words(df.limit(0), "doc_id", "text").count() == 0
    assert drop_repeated_bytes(df.limit(0), "doc_id", "text").count() == 0


def test_whole_characters(spark):
    shared = "é" * 100
    rows = [(1, "aé" + shared + "è"), (2, "b" + shared + "ê")]
    got = {r.doc_id: r for r in drop_repeated_bytes(spark.createDataFrame(rows, "doc_id long, text string"), "doc_id", "text", 160, True).collect()}
    assert {i: bytes(r.kept).decode() for i, r in got.items()} == {1: "aè", 2: "bê"}
    assert _inward("aéb".encode(), 2, 3) == (3, 3) and _inward("aéb".encode(), 0, 2) == (0, 1)


def test_segments_cover_every_window(monkeypatch):
    monkeypatch.setattr(repeats, "SEGMENT", 50)
    text = "".join(chr(97 + i % 26) for i in range(333))
    batch = pa.RecordBatch.from_arrays([pa.array([7]), pa.array([text])], names=["doc", "text"])
    ((units, docs, bases),) = repeats._slices(iter([batch]), Bytes, 20)
    starts = sorted(b + i for b, n in zip(bases, np.diff(units.first), strict=True) for i in range(n - 19))
    assert starts == list(range(333 - 19)) and set(docs) == {7}


def test_sliding_min_and_words():
    x = np.random.default_rng(0).integers(0, 99, 200)
    assert sliding_min(x, 7).tolist() == [x[i : i + 7].min() for i in range(194)]
    texts = [b"", b" a  bb\n", b"\x0b", b"c"]
    w = Words(texts)
    assert w.first.tolist() == [0, 0, 2, 2, 3] and [w.packed(i, i + 1) for i in range(3)] == [b"a", b"bb", b"c"]
    assert w.packed(0, 2) == b"a bb"


def test_runs_cover_each_window_once_and_tell_ties():
    text = bytes(np.random.default_rng(1).integers(97, 101, 900).astype(np.uint8))
    runs = Runs(Bytes([text, b"short", b"z" * 500]), 100, 16)
    covered = sorted(s + i for s, c in zip(runs.start.tolist(), runs.count.tolist(), strict=True) for i in range(c))
    assert covered == [*range(801), *range(905, 905 + 401)]
    assert runs.tied[runs.text == 2].all()


def test_difference_cover_brings_any_two_residues_together():
    sampled, shift = cover()
    for a in range(64):
        for b in range(64):
            assert sampled[(a + shift[a, b]) % 64] and sampled[(b + shift[a, b]) % 64]


@pytest.mark.parametrize("length", [160, 200, 400, 1000])
def test_classes_of_windows(length):
    rng = np.random.default_rng(2)
    piece = bytes(rng.integers(97, 99, 3 * length).astype(np.uint8))
    text = piece + b"q" * 10 + piece[5:] + b"ab" * length + piece[: 2 * length]
    at = np.arange(len(text) - length + 1)
    classes = equal_windows(text, at, np.zeros(len(at), np.int64), length)
    want = {}
    for i in at.tolist():
        want.setdefault(text[i : i + length], set()).add(i)
    got = {}
    for i, c in enumerate(classes.tolist()):
        got.setdefault(c, set()).add(i)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


def test_repeated_rows_with_a_hot_minimiser(spark, monkeypatch):
    monkeypatch.setattr(repeats, "HOT", 0)
    monkeypatch.setattr(repeats, "COPIES", 10**6)
    words = lambda c, n: " ".join(f"{c}{i}" for i in range(n))
    # Runs of 100 windows that begin 250 words apart.
    rows = [(1, f"{words('a', 119)} {words('b', 119)}")] + [(2, f"{words('a', 119)} {words('x', 131)} {words('b', 119)}")] * 3
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = [(r.doc_id, r.kept_text) for r in drop_repeated_words(df, "doc_id", "text", window=20).collect()]
    assert sorted(got) == [(1, rows[0][1])] + [(2, words("x", 131))] * 3
