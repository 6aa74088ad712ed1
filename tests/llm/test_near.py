import math
import random

import numpy as np
import pytest

from sparkpanel.llm import minhash, vectors
from sparkpanel.llm.components import components
from sparkpanel.llm.minhash import near_duplicates, superminhash
from sparkpanel.llm.vectors import calibrated, near_vectors

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def word_sets(texts, words):
    out = []
    for t in texts:
        w = (t or "").translate(LOWER).encode().split()
        out.append({tuple(w[i : i + words]) for i in range(len(w) - words + 1)} if len(w) >= words else {tuple(w)} if w else set())
    return out


def alike(sets):
    return [
        (i, j) for i in range(len(sets)) for j in range(i)
        if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])
    ]


@pytest.mark.parametrize("words, block, rounds", [(2, 1000, 3), (5, 1000, 3), (2, 2, 1)])
def test_texts_against_brute_force(documents, corpus, components_of, monkeypatch, words, block, rounds):
    monkeypatch.setattr(minhash, "BLOCK", block)
    monkeypatch.setattr(minhash, "ROUNDS", rounds)
    sets = word_sets([t for _, t in corpus], words)
    want = components_of(len(corpus), alike(sets))
    got = {r.doc_id: r for r in near_duplicates(documents, "doc_id", "text", words).collect()}
    for i, _ in corpus:
        assert (got[i].n_shingles, got[i].component_id, got[i].kept) == (len(sets[i]), want[i], want[i] == i) and got[i].n_words == 7


def test_chain_of_near_copies(spark, components_of):
    """Neighbours are alike, ends are not; no member is like all others."""
    rng = random.Random(1)
    words = [str(rng.randrange(10**6)) for _ in range(100)]
    texts = []
    for _ in range(40):
        texts.append(" ".join(words))
        words[rng.randrange(100)] = str(rng.randrange(10**6))
    rng.shuffle(texts)
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string").repartition(4)
    want = components_of(40, alike(word_sets(texts, 2)))
    assert {r.id: r.component_id for r in near_duplicates(df, "id", "text", 2).collect()} == dict(enumerate(want))


def test_null_ids_repeated_rows_and_empty_table(spark):
    rows = [(None, "a b c"), (5, "a b c"), (5, "a b c"), (3, "A B C"), (6, None), (7, "")]
    df = spark.createDataFrame(rows, "id long, text string")
    got = sorted((str(r.id), r.n_shingles, str(r.component_id), r.kept) for r in near_duplicates(df, "id", "text", 2).collect())
    assert got == [("3", 2, "3", True), ("5", 2, "3", False), ("5", 2, "3", False), ("6", 0, "6", True), ("7", 0, "7", True), ("None", 0, "None", True)]
    assert near_duplicates(df.limit(0), "id", "text").count() == 0


def test_signatures_estimate_similarity_with_little_variance():
    rng = np.random.default_rng(3)
    errors = []
    for _ in range(60):
        pool = rng.integers(0, 2**63, 30).astype(np.uint64)
        a, b = np.sort(pool[:25]), np.sort(pool[5:])
        h, text = np.concatenate([a, b]), np.repeat([0, 1], 25)
        s = superminhash(h, text, 2)
        errors.append((s[0] == s[1]).mean() - 20 / 30)
    assert abs(np.mean(errors)) < 0.02
    # Plain MinHash has a deviation of sqrt(J (1 - J) / 160) = 0.037; small sets have much less here.
    assert np.std(errors) < 0.03
    assert np.isinf(superminhash(np.zeros(0, np.uint64), np.zeros(0, np.int64), 1)).all()


@pytest.mark.parametrize("block", [4096, 40])
def test_vectors_against_brute_force(spark, components_of, monkeypatch, block):
    monkeypatch.setattr(vectors, "BLOCK", block)
    rng = np.random.default_rng(0)
    base = rng.standard_normal((150, 16))
    near = base[:60] + 0.05 * rng.standard_normal((60, 16))
    x = np.concatenate([base, near, near[:20], 3 * base[100:110], 1e-30 * base[:5]])
    odd = [None, [], [0.0] * 16, [float("nan")] * 16, [float("inf")] + [0.0] * 15, [None] + [1.0] * 15, [1.0, 2.0]]
    rows = [(i, v.tolist(), "k", i) for i, v in enumerate(x)] + [(1000 + i, v, "k", 0) for i, v in enumerate(odd)] + [(None, x[0].tolist(), "k", 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, kept string, n_links int").repartition(4)
    unit = x / np.linalg.norm(x, axis=1)[:, None]
    close = unit @ unit.T >= 0.9
    np.fill_diagonal(close, False)
    want = components_of(len(x), zip(*(a.tolist() for a in np.nonzero(close)), strict=True))
    got = near_vectors(df, "vec_id", "embedding").collect()
    assert len(got) == len(rows)
    for r in got:
        if r.vec_id is not None and r.vec_id < len(x):
            i = r.vec_id
            assert (r.n_links, r.component_id, r.kept) == (close[i].sum(), want[i], want[i] == i)
        else:
            assert (r.n_links, r.component_id, r.kept) == (0, r.vec_id, True)
    assert near_vectors(df.limit(0), "vec_id", "embedding").count() == 0


def test_calibration_finds_pairs_at_the_threshold():
    rng = np.random.default_rng(5)
    half, need = calibrated(0.9)
    a = rng.standard_normal((20_000, 32)) * math.sqrt(2 - 1.8)
    assert ((np.abs(a) <= half).sum(axis=1) >= need).mean() > 0.999


def test_components_of_paths_stars_and_loops(spark, components_of):
    rng = random.Random(1)
    links = [(i, i + 1) for i in range(120)] + [(1000 + rng.randrange(300), 1000 + rng.randrange(300)) for _ in range(200)]
    links += [(5000, 5000 + i) for i in range(100)] + [(7, 7), (None, 3)]
    rng.shuffle(links)
    got = components(spark.createDataFrame(links, "u long, v long").repartition(6)).collect()
    real = [(a, b) for a, b in links if a is not None and a != b]
    want = components_of(5200, real)
    nodes = {x for link in real for x in link}
    assert len(got) == len(nodes) and {r.id: r.component for r in got} == {x: want[x] for x in nodes}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_words_that_alternate_by_bit_parity_are_different(spark):
    word = lambda a, b, n: "".join(a if bin(i).count("1") % 2 == 0 else b for i in range(n))
    rows = [(2 * k + j, f"{word(*pair, n)} x") for k, n in enumerate((1024, 2048)) for j, pair in enumerate(("ab", "ba"))]
    rows.append((9, f"{word('a', 'b', 2048)} {word('b', 'a', 2048)} {word('a', 'b', 2048)}"))
    out = near_duplicates(spark.createDataFrame(rows, "id long, text string"), "id", "text", words=2, percent=80).collect()
    assert {r.id: (r.component_id, r.n_shingles) for r in out} == {i: (i, 1 if i < 9 else 2) for i, _ in rows}
