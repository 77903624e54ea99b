"""Quality classifier from positive and unlabelled documents.

A linear model on features of the whole text minimises the non-negative unbiased risk: trusted
positives give the positive risk, all unlabelled documents less the expected share of positives
among them give the negative risk.  Every unlabelled document takes part in every step; Spark
sums the gradient and the curvature, and only those sums reach the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.tables import stored

#: Newton steps, weight of the ridge, and length of a step that undoes a negative risk.
STEPS, RIDGE, BACK_STEP = 12, 0.03, 0.5

#: A document is good from this score on.
THRESHOLD = 0.3

FOLDS = 5

SYMBOLS = b"#$%&*<>{}|~^=_@\\+"
GROUPS = {
    "upper": range(65, 91), "lower": range(97, 123), "digit": range(48, 58), "end": b".?", "comma": b",;:",
    "shout": b"!", "symbol": SYMBOLS, "bar": b"|", "wide": range(128, 256), "space": b" \t\n\r\v\f",
}
GROUP_OF = np.zeros((256, len(GROUPS)))
for _column, _members in enumerate(GROUPS.values()):
    GROUP_OF[list(_members), _column] = 1
N_FEATURES = len(GROUPS) + 10


def text_features(text: bytes) -> np.ndarray:
    """Rates of character groups, repetition, and shapes of words and lines of a whole text."""
    characters = np.bincount(np.frombuffer(text, np.uint8), minlength=256) @ GROUP_OF
    words = text.split()
    lines = [line for line in text.split(b"\n") if line.strip()]
    n_words, n_lines = max(1, len(words)), max(1, len(lines))
    repeats = sum(map(bytes.__eq__, words, words[1:]))
    letters = max(1.0, characters[0] + characters[1])
    rates = np.minimum(characters / n_words, 4.0)
    rates[0] = characters[0] / letters
    shape = [
        repeats / n_words,
        len(set(words)) / n_words,
        len(set(words)) / n_words**0.75,
        sum(map(bytes.isupper, words)) / n_words,
        sum(map(bytes.istitle, words)) / n_words,
        1.0 - sum(map(bytes.isalpha, words)) / n_words,
        min(len(text) / n_words, 20.0) / 10,
        np.log1p(len(words)) / 10,
        len(set(lines)) / n_lines,
        np.log1p(n_words / n_lines) / 5,
    ]
    return np.concatenate([rates, shape]).astype(np.float32)


def held_out(doc_id: Column, folds: int = FOLDS) -> Column:
    """Rows never learned from: the CRC of the id as text divides by ``folds``; null ids too."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == 0, F.lit(True))


def feature_table(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Stored ``doc_id``, ``held_out``, ``x`` (32-bit floats) of every row; null texts are empty."""

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pc.cast(batch.column(2), pa.binary())
            x = [text_features(text.as_py() or b"").tobytes() for text in texts]
            columns = [batch.column(0), batch.column(1), pa.array(x, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "held_out", "x"])

    rows = docs.select(F.col(id_col).alias("doc_id"), held_out(F.col(id_col)).alias("held_out"), text_col)
    schema = f"doc_id {docs.schema[id_col].dataType.simpleString()}, held_out boolean, x binary"
    return stored(rows.mapInArrow(features, schema), "quality-features")


def matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.float32).reshape(-1, N_FEATURES).astype(float)


def summed(rows: DataFrame, part) -> np.ndarray:
    """The sum over all rows of the vector ``part(positive, x)`` gives for a batch of rows."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                value = part(batch.column(0).to_numpy(zero_copy_only=False).astype(bool), matrix(batch.column(1)))
                total = value if total is None else total + value
        if total is not None:
            columns = [pa.array(range(len(total)), pa.int32()), pa.array(total, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, ["k", "value"])

    found = rows.mapInArrow(sums, "k int, value double").groupBy("k").agg(F.sum("value").alias("value"))
    return np.array([row["value"] for row in found.orderBy("k").collect()])


@dataclass(frozen=True)
class QualityModel:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray  # the last is the constant
    prior: float

    def inputs(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -8, 8)
        return np.hstack([z, np.ones((len(z), 1))])

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.inputs(x) @ self.weights, -500, 500)))


def class_prior(features: DataFrame, labels: DataFrame, label: str) -> float:
    """The share of label 1 among the labelled rows that may be learned from."""
    known = features.where("not held_out").select("doc_id").join(labels.where(F.col(label).isNotNull()), "doc_id")
    share = known.agg(F.avg((F.col(label) == 1).cast("double"))).first()[0]
    return float(np.clip(0.5 if share is None else share, 0.01, 0.99))


def train(
    features: DataFrame, labels: DataFrame, label: str = "quality", prior: float | None = None, steps: int = STEPS
) -> QualityModel:
    """Fit on rows that are not held out: those labelled 1 are the positives, all are unlabelled.

    Without positives every weight stays zero and all scores are one half.
    """
    prior = class_prior(features, labels, label) if prior is None else prior
    positives = labels.where(F.col(label) == 1).select("doc_id").distinct().withColumn("positive", F.lit(True))
    rows = stored(
        features.where("not held_out")
        .join(positives, "doc_id", "left")
        .select(F.coalesce("positive", F.lit(False)).alias("positive"), "x"),
        "quality-train",
    )
    first = summed(rows, lambda p, x: np.concatenate([[len(x), p.sum()], x.sum(0), (x**2).sum(0)]))
    d = N_FEATURES + 1
    if not len(first) or not first[1]:
        return QualityModel(np.zeros(d - 1), np.ones(d - 1), np.zeros(d), prior)
    n, n_positive, mean = first[0], first[1], first[2 : d + 1] / first[0]
    spread = np.sqrt(np.maximum(first[d + 1 :] / n - mean**2, 0))
    model = QualityModel(mean, np.where(spread > 1e-6, spread, 1.0), np.zeros(d), prior)
    best = (np.inf, model)
    for _ in range(steps):
        total = summed(rows, lambda p, x, model=model: risk_sums(model, p, x))
        loss_u, loss_p, gain_p = total[0] / n, total[1] / n_positive, total[2] / n_positive
        slope_u, slope_p, mean_p = total[3 : 3 + d] / n, total[3 + d : 3 + 2 * d] / n_positive, total[3 + 2 * d : 3 + 3 * d] / n_positive
        negative = loss_u - prior * loss_p
        risk = prior * gain_p + max(0.0, negative) + RIDGE / 2 * model.weights @ model.weights
        if risk < best[0]:
            best = (risk, model)
        if negative < 0:  # the model has learned the positives by heart: step back
            move = BACK_STEP * (slope_u - prior * slope_p)
        else:
            curve = total[3 + 3 * d :].reshape(d, d) / n + RIDGE * np.eye(d)
            # With the logistic loss the positive terms are linear: their slope is the mean.
            move = -np.linalg.solve(curve, slope_u - prior * mean_p + RIDGE * model.weights)
            move *= min(1.0, 4.0 / max(1e-9, np.abs(move).max()))
        model = QualityModel(mean, model.scale, model.weights + move, prior)
        if np.abs(move).max() < 1e-4:
            break
    return best[1]


def risk_sums(model: QualityModel, positive: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Losses as negative of all and of positives, losses as positive, slopes and curvature."""
    inputs = model.inputs(x)
    z = inputs @ model.weights
    loss, chance = np.logaddexp(0, z), 1 / (1 + np.exp(-np.clip(z, -500, 500)))
    curve = inputs.T @ (inputs * (chance * (1 - chance))[:, None])
    p = positive
    return np.concatenate([
        [loss.sum(), loss[p].sum(), (loss[p] - z[p]).sum()],
        chance @ inputs, chance[p] @ inputs[p], inputs[p].sum(0), curve.ravel(),
    ])


def score_documents(
    docs: DataFrame,
    labels: DataFrame,
    threshold: float = THRESHOLD,
    id_col: str = "doc_id",
    text_col: str = "text",
    label: str = "quality",
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``held_out``, ``score``, ``predicted``.

    Only the text enters a score, and only labels of rows that are not held out are learned.  A
    null text is scored as an empty one; repeated rows are scored alike; an empty table gives an
    empty result; null labels are unknown; several labels of an id count as 1 if one is 1.
    """
    features = feature_table(docs, id_col, text_col)
    model = train(features, labels.select(F.col(id_col).alias("doc_id"), label), label)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = model.score(matrix(batch.column(2)))
            columns = [batch.column(0), batch.column(1), pa.array(scores, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "held_out", "score"])

    id_type = docs.schema[id_col].dataType.simpleString()
    scores = features.mapInArrow(scored, f"doc_id {id_type}, held_out boolean, score double")
    return scores.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def keep_good(
    docs: DataFrame,
    labels: DataFrame,
    threshold: float = THRESHOLD,
    id_col: str = "doc_id",
    text_col: str = "text",
    label: str = "quality",
) -> DataFrame:
    """The rows of ``docs`` that score ``threshold`` or more, with all their columns.

    Learns like ``score_documents``; the texts are then scored where they lie, without a join.
    """
    features = feature_table(docs, id_col, text_col)
    model = train(features, labels.select(F.col(id_col).alias("doc_id"), label), label)

    # Of a batch of texts, one at a time is taken out of Arrow's memory.
    def scores(texts: pa.Array) -> pa.Array:
        x = [text_features(text.as_py() or b"") for text in pc.cast(texts, pa.binary())]
        return pa.array(model.score(np.array(x, float).reshape(-1, N_FEATURES)), pa.float64())

    score = F.arrow_udf(scores, "double")
    return docs.where(score(F.col(text_col)) >= threshold)
