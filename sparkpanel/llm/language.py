"""Language of texts: sparse multinomial logistic regression on character n-grams."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sparkpanel.llm.arrow import released
from sparkpanel.llm.ngrams import DIMS, inverse_frequencies, texts_of, tfidf, vectors

#: Labelled rows of each language that the model is fitted on, and of these the share that calibrates it.
SAMPLE = 2000
CALIBRATION = 0.2
EPOCHS = 3


@dataclass
class LanguageModel:
    languages: list[str]
    weights: np.ndarray
    idf: np.ndarray
    temperature: float


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def fit_ftrl(examples: list, classes: int, alpha: float = 1.0, beta: float = 1.0, l1: float = 0.02, l2: float = 1e-3, epochs: int = EPOCHS) -> np.ndarray:
    """Follow the regularised leader, one example (class, numbers, values) at a time.

    A weight is the closed-form minimum of the linearised loss so far plus both penalties,
    and exactly zero where the sum of gradients stays within ``l1``.
    """
    z, n = np.zeros((DIMS, classes)), np.zeros((DIMS, classes))

    def weights(at):
        shrunk = np.sign(z[at]) * np.maximum(np.abs(z[at]) - l1, 0)
        return -shrunk / ((beta + np.sqrt(n[at])) / alpha + l2)

    for _ in range(epochs):
        for y, at, x in examples:
            x = x.astype(np.float64)
            w = weights(at)
            p = softmax(x @ w)
            p[y] -= 1
            g = x[:, None] * p
            step = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / alpha
            z[at] += g - step * w
            n[at] += g * g
    return weights(slice(None))


def fit_temperature(logits: np.ndarray, truth: np.ndarray) -> float:
    """Temperature of least log loss, by golden section over its logarithm.

    The targets leave to each other class what one more row of it would have, so that
    rows which are all right don't make the model certain.
    """
    n, classes = logits.shape
    target = np.full((n, classes), 1 / (n + classes))
    target[np.arange(n), truth] = (n + 1) / (n + classes)

    def loss(t):
        return -(target * np.log(np.maximum(softmax(logits / np.exp(t)), 1e-12))).sum(axis=1).mean()

    low, high, ratio = -4.0, 4.0, (5**0.5 - 1) / 2
    for _ in range(50):
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        if loss(a) < loss(b):
            high = b
        else:
            low = a
    return float(np.exp((low + high) / 2))


def fit_language(docs: DataFrame, id_col: str, text_col: str, lang_col: str, sample: int = SAMPLE) -> LanguageModel | None:
    """Model from rows with a language. Frequencies cover all of them, weights a sample.

    The sample takes the ``sample`` rows of each language whose id has the least hash, so
    it does not depend on the partitions. Rows without text or language are left out;
    without any row there is no model.
    """
    known = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).filter(
        "text is not null and lang is not null"
    )
    # About twice the sample passes the bound on the hash, so that no task ranks a whole
    # language. The broadcast has a row for each language.
    sizes = known.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    hashed = known.select("id", "lang", F.pmod(F.xxhash64("id"), F.lit(1 << 30)).alias("h"))
    near = hashed.join(F.broadcast(sizes), "lang").filter(F.col("h") * F.col("n") <= 2 * sample * (1 << 30))
    order = Window.partitionBy("lang").orderBy("h", "id")
    chosen = near.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= sample).select("id").distinct()
    idf = inverse_frequencies(known, lower=True)
    # At most ``sample`` ids for each language.
    picked = known.join(F.broadcast(chosen), "id", "left_semi")
    examples = vectors(picked, "lang", lambda texts: tfidf(texts, idf, lower=True))
    if not examples:
        return None
    languages = sorted({y for y, _, _ in examples})
    number = {y: i for i, y in enumerate(languages)}
    np.random.default_rng(0).shuffle(examples)
    examples = [(number[y], at, x) for y, at, x in examples]
    cut = int(len(examples) * CALIBRATION)
    weights = fit_ftrl(examples[cut:], len(languages))
    temperature = 1.0
    if cut:
        logits = np.stack([x @ weights[at] for _, at, x in examples[:cut]])
        temperature = fit_temperature(logits, np.array([y for y, _, _ in examples[:cut]]))
    return LanguageModel(languages, weights, idf, temperature)


def predict_language(docs: DataFrame, text_col: str, model: LanguageModel | None) -> DataFrame:
    """Add lang_pred and score (calibrated probability of that language, 0 to 1) to all rows.

    Whole texts are read. A text that is null or has no letter gets ``und`` and score 0,
    and so does every text if there is no model. Columns named like an added one are
    replaced, all others may have any name. Repeated rows are alike.
    """
    source = docs.drop("lang_pred", "score")
    schema = source.withColumns({"lang_pred": F.lit(None).cast("string"), "score": F.lit(None).cast("double")}).schema
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = held.value
        for batch, texts in texts_of(batches, text_col):
            names, scores = [], []
            for some, x, letter in tfidf(texts, model.idf if model else np.ones(DIMS), lower=True):
                if model is None or not letter:
                    names.append("und")
                    scores.append(0.0)
                    continue
                p = softmax(x @ model.weights[some] / model.temperature)
                best = int(p.argmax())
                names.append(model.languages[best])
                scores.append(float(p[best]))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(names, pa.string()), pa.array(scores, pa.float64())], names=[*batch.schema.names, "lang_pred", "score"])

    return source.mapInArrow(released(run), schema)

