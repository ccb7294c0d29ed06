"""Quality classifier by positive-unlabelled learning.

Trusted positives are the documents labelled 1; everything else is unlabelled
web text, and no negative label is used. A small network over text statistics
minimises the non-negative unbiased PU risk

    prior * E_p[l(g)] + max(0, E_u[l(-g)] - prior * E_p[l(-g)])

with the logistic loss, so its output is a posterior. The class prior is
estimated from the data: the best bin of a positive-versus-unlabelled
classifier bounds the share of positives among the unlabelled rows.

Defined cases: null text counts as empty; an empty text has all statistics 0
and still gets a score; without trusted positives or without unlabelled rows
every score is 0.5. Repeated rows are scored each, ties get equal scores.
Only doc_id and text of the documents are read, so further columns of any
name do no harm.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from .common import hash_fraction, held_out, labelled_texts, logistic_fit, sigmoid, text_slices

THRESHOLD = 0.3
MAX_POSITIVE = 15_000      # trusted positives that train, about
MAX_UNLABELLED = 15_000    # unlabelled rows that train, about
MARKS = b"#*$%&|!?;:=<>[]{}@_~^\\/"


@dataclass
class QualityModel:
    mean: np.ndarray
    scale: np.ndarray
    layers: list
    prior: float


def text_statistics(text: str) -> list[float]:
    """Numbers that describe a whole text; all 0 for an empty one."""
    raw = np.frombuffer(text.encode("utf-8", "replace"), dtype=np.uint8)
    words = text.split()
    if not words:
        return [0.0] * (16 + len(MARKS))
    n, counts = len(raw), np.bincount(raw, minlength=256)
    lower, upper = counts[97:123].sum(), counts[65:91].sum()
    letters = lower + upper + counts[128:].sum()
    lines = [x for x in text.split("\n") if x.strip()]
    unique_lines = set(lines)
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    distinct = len(set(words))
    return [
        upper / max(letters, 1), counts[48:58].sum() / n, counts[128:].sum() / n,
        counts[32] / n, counts[10] / n, counts[46] / n, counts[44] / n,
        1 - letters / n, distinct / len(words), distinct / len(words) ** 0.75,
        len(unique_lines) / len(lines), sum(map(len, unique_lines)) / sum(map(len, lines)),
        np.log1p(len(words)), np.log1p(n / len(lines)), float(lengths.mean()),
        np.log1p(float(lengths.max())),
    ] + [min(1.0, 20 * counts[b] / n) for b in MARKS]


def _forward(layers, x):
    (w1, b1), (w2, b2) = layers
    hidden = np.tanh(x @ w1 + b1)
    return hidden, (hidden @ w2 + b2)[:, 0]


def estimate_prior(positive: np.ndarray, unlabelled: np.ndarray) -> float:
    """Smallest ratio of the unlabelled to the positive share above a
    threshold, over thresholds that keep a stable part of the positives."""
    x = np.vstack([positive, unlabelled])
    y = np.r_[np.ones(len(positive)), np.zeros(len(unlabelled))]
    weight = np.r_[np.full(len(positive), 0.5 / len(positive)),
                   np.full(len(unlabelled), 0.5 / len(unlabelled))] * len(y)
    w = logistic_fit(x, y, weight, l2=1.0)
    score = x @ w[:-1] + w[-1]
    p, u = np.sort(score[:len(positive)]), np.sort(score[len(positive):])
    cuts = np.quantile(p, np.linspace(0.0, 0.8, 81))
    p_share = 1 - np.searchsorted(p, cuts) / len(p)
    u_share = 1 - np.searchsorted(u, cuts) / len(u)
    slack = np.sqrt(1 / len(p)) + np.sqrt(1 / len(u))
    best = np.argmin((u_share + slack) / np.maximum(p_share, 1e-9))
    return float(np.clip(u_share[best] / p_share[best], 0.02, 0.98))


def fit_arrays(positive: np.ndarray, unlabelled: np.ndarray, prior: float | None = None,
               hidden: int = 24, epochs: int = 120, seed: int = 5) -> QualityModel:
    """Train on statistics of trusted positives and unlabelled rows."""
    mean, scale = unlabelled.mean(0), unlabelled.std(0) + 1e-6
    p, u = np.clip((positive - mean) / scale, -6, 6), np.clip((unlabelled - mean) / scale, -6, 6)
    prior = estimate_prior(p, u) if prior is None else prior
    rng = np.random.default_rng(seed)
    params = [rng.normal(0, 1 / np.sqrt(p.shape[1]), (p.shape[1], hidden)), np.zeros(hidden),
              rng.normal(0, 1 / np.sqrt(hidden), (hidden, 1)), np.zeros(1)]
    m, v, t = [np.zeros_like(a) for a in params], [np.zeros_like(a) for a in params], 0
    for _ in range(epochs):
        order_p, order_u = rng.permutation(len(p)), rng.permutation(len(u))
        chunks = max(1, min(30, len(u) // 200))
        for cp, cu in zip(np.array_split(order_p, chunks), np.array_split(order_u, chunks)):
            if not len(cp) or not len(cu):
                continue
            x = np.vstack([p[cp], u[cu]])
            is_p = np.arange(len(x)) < len(cp)
            h, g = _forward([params[:2], params[2:]], x)
            s = sigmoid(g)
            # l(g) = log(1 + e^-g): d/dg = s - 1;  l(-g): d/dg = s
            negative = np.logaddexp(0, g[~is_p]).mean() - prior * np.logaddexp(0, g[is_p]).mean()
            d = np.zeros(len(x))
            if negative >= 0:
                d[is_p] = prior * (s[is_p] - 1) / len(cp) - prior * s[is_p] / len(cp)
                d[~is_p] = s[~is_p] / len(cu)
            else:  # below the bound: step back up the negative part only
                d[is_p] = prior * s[is_p] / len(cp)
                d[~is_p] = -s[~is_p] / len(cu)
            back = d[:, None] @ params[2].T * (1 - h * h)
            grads = [x.T @ back, back.sum(0), h.T @ d[:, None], d.sum(0, keepdims=True)]
            t += 1
            for i, grad in enumerate(grads):
                grad = grad + 1e-4 * params[i]
                m[i] = 0.9 * m[i] + 0.1 * grad
                v[i] = 0.999 * v[i] + 0.001 * grad * grad
                params[i] = params[i] - 4e-3 * (m[i] / (1 - 0.9 ** t)) / (
                    np.sqrt(v[i] / (1 - 0.999 ** t)) + 1e-8)
    return QualityModel(mean, scale, [params[:2], params[2:]], prior)


def predict(model: QualityModel | None, stats: np.ndarray) -> np.ndarray:
    if model is None:
        return np.full(len(stats), 0.5)
    x = np.clip((stats - model.mean) / model.scale, -6, 6)
    return sigmoid(_forward(model.layers, x)[1])


def _stats(frames):
    for frame in frames:
        yield pd.DataFrame({"x": [text_statistics(t) for t in frame["text"]]})


def fit(documents: DataFrame, labels: DataFrame, max_positive: int = MAX_POSITIVE,
        max_unlabelled: int = MAX_UNLABELLED) -> QualityModel | None:
    """Fit on bounded samples: about `max_positive` trusted positives outside
    the held out fold and about `max_unlabelled` documents taken as
    unlabelled text (their labels are not looked at)."""
    positive = (labelled_texts(documents, labels.where("quality = 1"), "quality", max_positive)
                .select("text"))
    total = documents.count()
    unlabelled = (documents.where(hash_fraction(F.col("doc_id"), max_unlabelled, total, 11))
                  .select(F.coalesce("text", F.lit("")).alias("text")))
    got = [np.array(df.mapInPandas(_stats, "x array<double>").toPandas()["x"].tolist())
           for df in (positive, unlabelled)]  # statistics of the bounded samples only
    if not len(got[0]) or not len(got[1]):
        return None
    return fit_arrays(*got)


def _predictions(model, texts: list[str]) -> np.ndarray:
    return predict(model, np.array([text_statistics(t) for t in texts]))


def score(documents: DataFrame, model: QualityModel | None) -> DataFrame:
    """All columns of `documents` plus quality_score."""
    def run(batches):
        for part, texts in text_slices(batches):
            yield pa.RecordBatch.from_arrays(
                [*part.columns, pa.array(_predictions(model, texts))],
                names=[*part.schema.names, "quality_score"])

    documents = documents.drop("quality_score")
    out = StructType([*documents.schema.fields, StructField("quality_score", DoubleType())])
    return documents.mapInArrow(run, out)


def quality_scores(documents: DataFrame, labels: DataFrame,
                   threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document."""
    model = fit(documents, labels)
    scored = score(documents.select("doc_id", "text"), model)
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"),
        F.col("quality_score").alias("score"),
        (F.col("quality_score") >= threshold).cast("int").alias("predicted"))


def keep_good(documents: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that the classifier accepts, with their own columns."""
    model = fit(documents, labels)

    def run(batches):
        for part, texts in text_slices(batches):
            yield part.filter(pa.array(_predictions(model, texts) >= threshold))

    return documents.mapInArrow(run, documents.schema)
