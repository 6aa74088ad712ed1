"""Quality of texts from positive and unlabelled examples."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkpanel.llm.arrow import released
from sparkpanel.llm import ngrams
from sparkpanel.llm.ngrams import inverse_frequencies, texts_of, tfidf, vectors
from sparkpanel.llm.units import DIGIT, LETTER, SPACE, Words, characters

#: Rows that the model is fitted on: trusted positives, and texts of unknown quality.
POSITIVES = 2000
UNLABELLED = 4000
EPOCHS = 30
BATCHES = 10
#: Shares of a text that are told apart by sixteenths, as further features of this value.
SHAPES = 6
STEPS = 16
SHAPE_VALUE = 0.3
DIMS = ngrams.DIMS + SHAPES * (STEPS + 1)


@dataclass
class QualityModel:
    weights: np.ndarray
    bias: float
    idf: np.ndarray
    prior: float


def shapes(texts: list[str]) -> np.ndarray:
    """Shares, 0 to 1, of a text: words like the one before, words like the one before that, repeated
    words among the last sixteen, upper-case letters, symbols and digits among its characters."""
    units = Words([t.encode() for t in texts])
    size, h = np.diff(units.first), units.h
    text = np.repeat(np.arange(len(texts)), size)
    again = np.zeros((3, len(texts)))
    seen = np.zeros(len(h), bool)
    for back in range(1, 17):
        same = np.zeros(len(h), bool)
        same[back:] = (h[back:] == h[:-back]) & (text[back:] == text[:-back])
        seen |= same
        if back < 3:
            again[back - 1] = np.bincount(text[same], minlength=len(texts))
    again[2] = np.bincount(text[seen], minlength=len(texts))
    code = np.minimum(np.frombuffer("\n".join([*texts, ""]).encode("utf-32-le"), np.uint32), 65535)
    classes, folded = characters()
    kind = classes[code]
    lower = np.arange(65536) == _lowered()
    ends = np.cumsum([len(t) + 1 for t in texts])
    starts = ends - [len(t) + 1 for t in texts]

    def count(which):
        total = np.concatenate([[0], np.cumsum(which)])
        return total[ends - 1] - total[starts]

    full = np.maximum(count(kind != SPACE), 1)
    letters = np.maximum(count(kind == LETTER), 1)
    upper = count((kind == LETTER) & ~lower[code])
    symbols = count((kind != SPACE) & (kind != LETTER) & (kind != DIGIT))
    return np.stack([*(again / np.maximum(size, 1)), upper / letters, symbols / full, count(kind == DIGIT) / full])


@cache
def _lowered() -> np.ndarray:
    return np.array([ord(c.lower()) if len(c.lower()) == 1 else i for i, c in enumerate(map(chr, range(65536)))])


def features(texts: list[str], idf: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, bool]]:
    """TF-IDF of the n-grams, case kept, and one feature for the step that each share falls in."""
    step = np.ceil(shapes(texts) * STEPS).astype(np.int64) + np.arange(SHAPES)[:, None] * (STEPS + 1) + ngrams.DIMS
    for i, (some, x, letter) in enumerate(tfidf(texts, idf, lower=False)):
        yield np.concatenate([some, step[:, i]]), np.concatenate([x, np.full(SHAPES, SHAPE_VALUE)]), letter


class _Sparse:
    def __init__(self, examples: list):
        self.at = np.concatenate([at for _, at, _ in examples])
        self.x = np.concatenate([x for _, _, x in examples]).astype(np.float32)
        self.size = np.array([len(at) for _, at, _ in examples])

    def part(self, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        size = self.size[chosen]
        begin = (np.cumsum(self.size) - self.size)[chosen]
        flat = np.arange(size.sum()) + np.repeat(begin - (np.cumsum(size) - size), size)
        return self.at[flat], self.x[flat], np.repeat(np.arange(len(chosen)), size)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(z / 2))


def fit_non_negative(positive: list, unlabelled: list, prior: float, rate: float = 0.05, l2: float = 1e-6, epochs: int = EPOCHS) -> tuple[np.ndarray, float]:
    """Weights and bias that minimise the non-negative unbiased risk with sigmoid loss.

    The risk is prior x loss(positives as 1) plus the larger of 0 and loss(unlabelled as
    0) - prior x loss(positives as 0). Where a batch makes that difference negative the
    step goes against its gradient, so that the model unlearns what it has overfitted.
    """
    sets, generator = (_Sparse(positive), _Sparse(unlabelled)), np.random.default_rng(0)
    w, b = np.zeros(DIMS), 0.0
    m, v, moved = np.zeros(DIMS + 1), np.zeros(DIMS + 1), 0
    for _ in range(epochs):
        cuts = [np.array_split(generator.permutation(len(s.size)), BATCHES) for s in sets]
        for p_part, u_part in zip(*cuts, strict=True):
            if not len(p_part) or not len(u_part):
                continue
            (p_at, p_x, p_row), (u_at, u_x, u_row) = sets[0].part(p_part), sets[1].part(u_part)
            p = _sigmoid(np.bincount(p_row, p_x * w[p_at], len(p_part)) + b)
            u = _sigmoid(np.bincount(u_row, u_x * w[u_at], len(u_part)) + b)
            p_slope, u_slope = prior * p * (1 - p) / len(p), u * (1 - u) / len(u)
            if u.mean() - prior * p.mean() >= 0:
                p_pull, u_pull = -2 * p_slope, u_slope  # as 1, and less as 0
            else:
                p_pull, u_pull = p_slope, -u_slope
            g = np.bincount(p_at, p_x * p_pull[p_row], DIMS) + np.bincount(u_at, u_x * u_pull[u_row], DIMS) + l2 * w
            g = np.append(g, p_pull.sum() + u_pull.sum())
            moved += 1
            m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
            step = rate * (m / (1 - 0.9**moved)) / (np.sqrt(v / (1 - 0.999**moved)) + 1e-8)
            w -= step[:-1]
            b -= step[-1]
    return w, b


def _least_hash(df: DataFrame, n: int) -> DataFrame:
    """The ``n`` rows whose id has the least hash."""
    return df.orderBy(F.xxhash64("id"), "id").limit(n)


def fit_quality(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, quality_col: str, positives: int = POSITIVES, unlabelled: int = UNLABELLED) -> QualityModel | None:
    """Model from documents and (id, quality) rows; only quality 1 marks examples.

    Frequencies cover all documents. The class prior is estimated as the share of quality
    1 among all labelled rows that the call gets. The fit takes at most ``positives``
    trusted positives and ``unlabelled`` documents, drawn by the hash of their ids.
    Null text, id or quality is left out; without positives there is no model.
    """
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).filter("id is not null and text is not null")
    marks = labels.select(F.col(id_col).alias("id"), F.col(quality_col).cast("int").alias("quality")).filter("id is not null and quality is not null")
    total = marks.agg(F.count(F.lit(1)).alias("n"), F.sum("quality").alias("good")).first()
    if not total["good"]:
        return None
    prior = min(max(total["good"] / total["n"], 0.02), 0.98)
    idf = inverse_frequencies(texts, lower=False)
    ids = {
        1: _least_hash(marks.filter("quality = 1").select("id").distinct().join(texts.select("id"), "id", "left_semi"), positives),
        0: _least_hash(texts.select("id"), unlabelled),
    }
    # At most ``positives`` or ``unlabelled`` ids.
    parts = [vectors(texts.join(F.broadcast(ids[y].distinct()), "id", "left_semi").withColumn("y", F.lit(y)), "y", lambda texts: features(texts, idf)) for y in (1, 0)]
    if not parts[0]:
        return None
    weights, bias = fit_non_negative(*parts, prior)
    return QualityModel(weights, bias, idf, prior)


def predict_quality(docs: DataFrame, text_col: str, model: QualityModel | None) -> DataFrame:
    """Add score (0 to 1, higher for better texts) to all rows.

    Whole texts are read. Null and empty texts have no n-grams and shares of 0;
    without a model every score is 0.5. A column named score is replaced, all others may
    have any name. Repeated rows are alike.
    """
    source = docs.drop("score")
    schema = source.withColumn("score", F.lit(None).cast("double")).schema
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = held.value
        for batch, texts in texts_of(batches, text_col):
            scores = [
                0.5 if model is None else float(_sigmoid(x @ model.weights[some] + model.bias))
                for some, x, _ in features(texts, model.idf if model else np.ones(ngrams.DIMS))
            ]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64())], names=[*batch.schema.names, "score"])

    return source.mapInArrow(released(run), schema)
