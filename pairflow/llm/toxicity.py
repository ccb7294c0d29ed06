"""Toxicity by maximum-scoring segments.

Every token (a word, and its leading stems of 4 to 7 letters, which carry
inflected and compound forms) gets a log-odds score between toxic and clean
documents with an informative Dirichlet prior (the pooled distribution). A
word scores the highest of its significantly toxic tokens, less one standard
error; every other word scores a constant negative amount, so a segment gains
only where toxic words are dense. One linear scan per text finds all maximal scoring segments. Scores
are put on one scale by extreme-value statistics: in clean text the best
segment of n words follows a Gumbel law with parameters lambda (the root of
E[e^(lambda s)] = 1) and K (the rate of positive segments), so
lambda*S - ln(K*n) is comparable between short and long texts. A logistic
curve over that evidence, fitted on labelled rows, gives the score.

Defined cases: null text counts as empty; an empty text has no segment and
gets the curve's value at no evidence; without labels of both classes every
score is 0.5. Repeated rows are scored each. Only doc_id and text are read.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import held_out, labelled_texts, logistic_fit, sigmoid, staged, text_slices

THRESHOLD = 0.5
MAX_LABELLED = 30_000   # labelled documents that train, about
MAX_WORDS = 50_000      # scored words, the most significant first
PRIOR_STRENGTH = 0.1    # weight of the Dirichlet prior, as a share of all counts
Z_MIN = 3.0
MIN_LOG_ODDS = 1.5
STEMS = (4, 5, 6, 7)
CACHED_WORDS = 400_000
OTHER = -0.4            # of every word that is not significantly toxic
WORD = re.compile(r"\w+")
PASSAGES = pa.list_(pa.struct([("first_word", pa.int32()), ("last_word", pa.int32()),
                               ("score", pa.float64()), ("evidence", pa.float64()),
                               ("text", pa.string())]))


@dataclass
class ToxicModel:
    scores: dict
    lam: float
    log_k: float
    curve: np.ndarray
    mean: np.ndarray
    scale: np.ndarray


def words_of(text: str) -> list[str]:
    return WORD.findall(text.lower())


def tokens_of(word: str) -> list[str]:
    return [word] + ["^" + word[:k] for k in STEMS if len(word) >= k]


def scorer(scores: dict):
    """word -> score or None, with a bounded memo per task."""
    memo: dict = {}

    def score(word):
        if word not in memo:
            if len(memo) >= CACHED_WORDS:
                memo.clear()
            memo[word] = max((scores[t] for t in tokens_of(word) if t in scores), default=None)
        return memo[word]

    return score


def segments(values: list[tuple[int, float]], n: int, other: float = OTHER):
    """All maximal scoring segments of a text of n words.

    `values` holds (position, score) of its positive words in order; all
    other positions score `other`. Returns (first, last, score), disjoint
    and in order. Linear: each candidate is pushed and merged once.
    """
    found: list[list[float]] = []  # first, last, sum before it, sum after it
    total, at = 0.0, 0
    for position, value in values:
        total += other * (position - at)
        before = total
        total += value
        at = position + 1
        new = [position, position, before, total]
        while True:
            j = len(found) - 1
            while j >= 0 and found[j][2] >= new[2]:
                j = found[j][4]
            if j < 0 or found[j][3] >= new[3]:
                new = new[:4] + [j]
                found.append(new)
                break
            new = [found[j][0], new[1], found[j][2], new[3]]
            del found[j:]
    return [(int(a), int(b), end - begin) for a, b, begin, end, _ in found]


def evidence(words: list[str], score, lam: float, log_k: float):
    """(segments with their normalised score, the text's three features)."""
    values = [(i, s) for i, s in enumerate(map(score, words)) if s is not None]
    if not values:
        return [], (0.0, 0.0, 0.0)
    n = len(words)
    found = [(a, b, s, lam * s - log_k - np.log(n)) for a, b, s in segments(values, n)]
    above = [max(0.0, x[3]) for x in found]
    # best passage, sum of all significant passages, share of toxic evidence
    return found, (max(above), float(np.log1p(sum(above))),
                   float(np.log1p(100 * sum(x[2] for x in found) / n)))


def _count(frames):
    toxic, clean, n = Counter(), Counter(), [0, 0]
    for frame in frames:
        for text, label in zip(frame["text"], frame["label"]):
            seen = {t for w in set(words_of(text)) for t in tokens_of(w)}
            (toxic if label else clean).update(seen)
            n[int(label)] += len(seen)
    if n[0] or n[1]:
        keys = list(toxic.keys() | clean.keys())
        yield pd.DataFrame({"word": keys, "y1": [toxic[k] for k in keys],
                            "y0": [clean[k] for k in keys]})
        yield pd.DataFrame({"word": [None], "y1": [n[1]], "y0": [n[0]]})


def word_scores(labelled: DataFrame, max_words: int = MAX_WORDS) -> dict | None:
    """Log-odds with a Dirichlet prior of the significantly toxic tokens; a
    token counts once per document."""
    counts = staged(labelled.mapInPandas(_count, "word string, y1 long, y0 long")
                    .groupBy("word").agg(F.sum("y1").alias("y1"), F.sum("y0").alias("y0")),
                    "toxic-counts")
    total = counts.where("word IS NULL").first()
    if total is None or not total["y1"] or not total["y0"]:
        return None
    n1, n0 = float(total["y1"]), float(total["y0"])
    a0 = PRIOR_STRENGTH * (n1 + n0)
    alpha = (F.col("y1") + F.col("y0")) * F.lit(a0 / (n1 + n0))
    one, zero = F.col("y1") + alpha, F.col("y0") + alpha
    error = F.sqrt((one + zero) / (one * zero))
    delta = (F.log(F.try_divide(one, F.lit(n1 + a0) - one))
             - F.log(F.try_divide(zero, F.lit(n0 + a0) - zero)))
    kept = (counts.where("word IS NOT NULL AND y1 >= 2")
            .select("word", (delta - error).alias("delta"), (delta / error).alias("z"))
            .where((F.col("z") >= Z_MIN) & (F.col("delta") >= MIN_LOG_ODDS))
            .orderBy(F.desc("z"), "word").limit(max_words))
    rows = kept.toPandas()  # at most max_words rows
    return dict(zip(rows["word"], rows["delta"]))


def _solve_lambda(shares: np.ndarray, values: np.ndarray) -> float:
    """Positive root of sum(share * e^(lambda*value)) = 1; the mean is negative."""
    low, high = 1e-6, 20.0
    for _ in range(80):
        mid = (low + high) / 2
        if np.sum(shares * np.exp(mid * values)) > 1:
            high = mid
        else:
            low = mid
    return (low + high) / 2


def _null_law(frames, scores):
    hits, words, runs = Counter(), 0, 0
    score = scorer(scores)
    for frame in frames:
        for text, label in zip(frame["text"], frame["label"]):
            if label:
                continue
            w = words_of(text)
            values = [(i, s) for i, s in enumerate(map(score, w)) if s is not None]
            hits.update(round(s, 1) for _, s in values)
            words += len(w)
            runs += len(segments(values, len(w)))
    yield pd.DataFrame({"value": list(hits) + [None, -1e9], "n": list(hits.values()) + [words, runs]})


def fit(documents: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED):
    """Fit on about `max_labelled` labelled documents outside the held out fold."""
    labelled = staged(labelled_texts(documents, labels, "toxic", max_labelled), "toxic-labelled")
    scores = word_scores(labelled)
    if not scores:
        return None
    law = (labelled.mapInPandas(lambda f: _null_law(f, scores), "value double, n long")
           .groupBy("value").agg(F.sum("n").alias("n")).toPandas())  # one row per tenth of a score
    words = float(law.loc[law["value"].isna(), "n"].sum()) + 1
    runs = float(law.loc[law["value"] == -1e9, "n"].sum())
    hits = law[law["value"] > 0]
    share = np.r_[hits["n"].to_numpy(float), 0.5] / words
    value = np.r_[hits["value"].to_numpy(float), float(np.mean(list(scores.values())))]
    lam = _solve_lambda(np.r_[share, max(1e-9, 1 - share.sum())], np.r_[value, OTHER])
    log_k = float(np.log((runs + 0.5) / words))

    def features(frames):
        score = scorer(scores)
        for frame in frames:
            rows = [evidence(words_of(t), score, lam, log_k)[1] for t in frame["text"]]
            yield pd.DataFrame({"x": [list(r) for r in rows], "label": frame["label"].to_numpy()})

    got = labelled.mapInPandas(features, "x array<double>, label int").toPandas()
    x, y = np.array(got["x"].tolist()), got["label"].to_numpy(float)
    mean, scale = x.mean(0), x.std(0) + 1e-9
    return ToxicModel(scores, lam, log_k, logistic_fit((x - mean) / scale, y, l2=0.5), mean, scale)


def passages(documents: DataFrame, model: ToxicModel | None) -> DataFrame:
    """(doc_id, score, passages): each passage is (first_word, last_word,
    score, evidence, text), where evidence above 0 means rarer in clean text
    than one such segment per document."""
    def run(batches):
        score = scorer(model.scores) if model else None
        for part, texts in text_slices(batches):
            found, rows = [], []
            for text in texts if model else []:
                words = words_of(text)
                segs, x = evidence(words, score, model.lam, model.log_k)
                found.append([{"first_word": a, "last_word": b, "score": float(s),
                               "evidence": float(e), "text": " ".join(words[a:b + 1])}
                              for a, b, s, e in segs if e > 0])
                rows.append(x)
            if model:
                z = (np.array(rows) - model.mean) / model.scale
                value = sigmoid(z @ model.curve[:-1] + model.curve[-1])
            else:
                found, value = [[] for _ in texts], np.full(len(texts), 0.5)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(value), pa.array(found, PASSAGES)],
                names=["doc_id", "score", "passages"])

    kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, score double, passages array<struct<first_word: int, "
             "last_word: int, score: double, evidence: double, text: string>>")


def toxicity_scores(documents: DataFrame, labels: DataFrame,
                    threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, held_out, score, predicted, n_passages) of every document."""
    scored = passages(documents, fit(documents, labels))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"),
                         F.size("passages").alias("n_passages"))
