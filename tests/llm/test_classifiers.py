import zlib

import numpy as np
import pytest

from sparkpanel.llm import queries
from sparkpanel.llm.language import fit_ftrl, fit_language, fit_temperature, predict_language, softmax
from sparkpanel.llm.quality import fit_non_negative, fit_quality, predict_quality, shapes

SF = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def truth(spark):
    docs = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang").collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    return docs, labels


def test_language_on_held_out_rows(spark, truth):
    rows = queries.op8_language_id(spark, SF).collect()
    assert len(rows) == len(truth[0])
    held = [r for r in rows if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    right = [r.lang_pred == truth[0][r.doc_id] for r in held]
    assert np.mean(right) > 0.99 and all(0 <= r.score <= 1 for r in rows)
    # Calibrated: the mean probability is near the share that is right.
    assert abs(np.mean([r.score for r in held]) - np.mean(right)) < 0.03


def test_quality_on_held_out_rows(spark, truth):
    rows = [r for r in queries.op10_quality(spark, SF).collect()]
    assert len(rows) == len(truth[0]) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    held = [(r.score, truth[1][r.doc_id]) for r in rows if r.held_out and r.doc_id in truth[1]]
    good, bad = [s for s, y in held if y == 1], [s for s, y in held if y == 0]
    assert np.mean([g > b for g in good for b in bad]) > 0.99
    assert np.mean(np.array(good) >= 0.3) > 0.98


def test_language_of_odd_texts(spark, documents):
    train = spark.createDataFrame(
        [(i, "the cat and the dog " * (1 + i % 3) if i % 2 else "der hund und die katze " * (1 + i % 3), "en" if i % 2 else "de") for i in range(60)]
        + [(100, None, "en"), (101, "ohne sprache", None)], "doc_id long, text string, lang string",
    )
    model = fit_language(train, "doc_id", "text", "lang")
    assert model.languages == ["de", "en"]
    rows = [(1, None), (2, ""), (3, "12 !!"), (4, "the the"), (5, "UND DIE"), (5, "UND DIE"), (6, "𐐀"), (7, "the " * 100_000)]
    got = predict_language(spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, score string"), "text", model).collect()
    assert [r.lang_pred for r in got[:6]] == ["und", "und", "und", "en", "de", "de"] and got[7].lang_pred == "en"
    assert got[6].lang_pred in ("de", "en") and [r.score for r in got[:3]] == [0.0] * 3
    assert fit_language(train.limit(0), "doc_id", "text", "lang") is None
    assert {r.lang_pred for r in predict_language(documents, "text", None).collect()} == {"und"}
    assert predict_language(documents.limit(0), "text", model).count() == 0


def test_quality_of_odd_texts(spark, documents, corpus):
    good = [(i, f"quiet prose number {i} goes on for a while and ends", 1) for i in range(80)]
    bad = [(100 + i, "BUY!! NOW!! " * (2 + i % 4), 0) for i in range(20)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in good + bad] + [(500, None), (None, "x")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, q) for i, _, q in good + bad] + [(501, 1), (None, 0), (3, None)], "doc_id long, quality int")
    model = fit_quality(docs, labels, "doc_id", "text", "quality")
    assert 0.75 < model.prior < 0.85
    scores = {r.doc_id: r.score for r in predict_quality(docs, "text", model).collect()}
    assert min(scores[i] for i, *_ in good) > max(scores[i] for i, *_ in bad)
    got = predict_quality(documents, "text", model).collect()
    assert len(got) == len(corpus) and all(0 <= r.score <= 1 and r.n_words == 7 for r in got)
    assert fit_quality(docs, labels.limit(0), "doc_id", "text", "quality") is None
    assert {r.score for r in predict_quality(docs, "text", None).collect()} == {0.5}
    assert predict_quality(docs.limit(0), "text", model).count() == 0


def test_shares_of_a_text():
    s = shapes(["a a a b", "", "AB c! 1", "x y x y"])
    assert s[0].tolist() == [0.5, 0, 0, 0] and s[1].tolist() == [0.25, 0, 0, 0.5]
    assert np.allclose(s[3], [0, 0, 2 / 3, 0]) and np.allclose(s[4], [0, 0, 0.2, 0]) and np.allclose(s[5], [0, 0, 0.2, 0])


def test_l1_gives_zeros_and_temperature_sharpens():
    rng = np.random.default_rng(0)
    examples = [(y, np.array([y, 10 + rng.integers(20)]), np.array([0.9, 0.4])) for y in rng.integers(0, 3, 600)]
    w = fit_ftrl(examples, 3, l1=1.0)
    assert (w[:3].argmax(axis=1) == [0, 1, 2]).all() and (w[10:30] == 0).mean() > 0.3
    logits = rng.standard_normal((3000, 3))
    truth = np.array([rng.choice(3, p=p) for p in softmax(logits / 0.5)])
    assert abs(fit_temperature(logits, truth) - 0.5) < 0.06


def test_non_negative_risk_separates_without_negatives():
    rng = np.random.default_rng(1)
    row = lambda good: (0, np.array([0 if good else 1, 2 + rng.integers(50)]), np.array([0.8, 0.6]))
    positive = [row(True) for _ in range(500)]
    unlabelled = [row(rng.random() < 0.7) for _ in range(1500)]
    w, b = fit_non_negative(positive, unlabelled, 0.7)
    assert 0.8 * w[0] + b > 1 and 0.8 * w[1] + b < -1
