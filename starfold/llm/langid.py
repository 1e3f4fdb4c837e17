"""Language identification: averaged hashed subword embeddings and a linear softmax.

A text is the mean of the embeddings of its subwords (runs of two to four
letters, word edges counted as a character), hashed into ``BUCKETS`` rows. A
linear layer on the mean gives one score for each language. Both are trained
by stochastic gradient descent in numpy on a bounded sample of labelled rows;
a held-back part of the sample calibrates the softmax by one temperature and
sets the score below which a text is rejected.

After training, embedding and linear layer are one table of scores for each
subword, so a text costs a few look-ups for each character.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, functions as F

from .words import add_columns, code_points, letters, windows

BUCKETS = 1 << 16
SIZES = (2, 3, 4)
WIDTH = 16
FIT_ROWS = 4000        # labelled texts that the model is fitted on, about, in equal parts for each language
UNKNOWN = "und"


@dataclass
class Model:
    languages: list[str]
    table: np.ndarray          # BUCKETS x languages: scores of each subword
    bias: np.ndarray
    temperature: float
    reject_below: float


def _subwords(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, bucket) of every subword, and which texts have a letter."""
    points, at = code_points([t.lower() for t in texts])
    is_letter = letters(points)
    own, buckets = [], []
    for n in SIZES:
        place, h = windows(points, is_letter, n)
        own.append(np.searchsorted(at, place, side="right") - 1)
        buckets.append((h >> np.uint64(40)).astype(np.int64) % BUCKETS)
    seen = np.concatenate([[0], np.cumsum(is_letter)])
    return np.concatenate(own), np.concatenate(buckets), seen[at[1:]] > seen[at[:-1]]


def _bags(texts: list[str]) -> list[tuple[bytes, bytes]]:
    own, bucket, _ = _subwords(texts)
    key, counts = np.unique(own * BUCKETS + bucket, return_counts=True)
    edge = np.searchsorted(key, np.arange(len(texts) + 1) * BUCKETS)
    return [((key[a:b] % BUCKETS).astype("<u4").tobytes(), counts[a:b].astype("<u4").tobytes()) for a, b in zip(edge[:-1], edge[1:])]


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def train(bags: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, languages: list[str], epochs: int = 6, rate: float = 0.5,
          seed: int = 1) -> Model:
    """Fit on (buckets, counts) of each text; every tenth text is held back for the calibration."""
    rng = np.random.default_rng(seed)
    k = len(languages)
    emb = rng.uniform(-1 / WIDTH, 1 / WIDTH, (BUCKETS, WIDTH)).astype(np.float32)
    lin, bias = np.zeros((WIDTH, k), np.float32), np.zeros(k, np.float32)
    use = np.array([i for i, (b, _) in enumerate(bags) if len(b)], dtype=np.int64)
    order = rng.permutation(use)
    held, fit = order[::10], np.setdiff1d(order, order[::10]) if len(order) >= 20 else order
    steps, done = epochs * max(len(fit), 1), 0
    for _ in range(epochs):
        for i in rng.permutation(fit):
            idx, c = bags[i]
            share = (c / c.sum()).astype(np.float32)
            mean = share @ emb[idx]
            error = _softmax(mean @ lin + bias)
            error[labels[i]] -= 1
            lr = rate * (1 - done / steps)
            back = lin @ error
            lin -= lr * np.outer(mean, error)
            bias -= lr * error * 0.1
            emb[idx] -= (lr * len(idx) * share)[:, None].clip(max=lr * 10) * back[None, :]
            done += 1
    table = emb @ lin
    scores = np.array([(bags[i][1] / bags[i][1].sum()) @ table[bags[i][0]] + bias for i in held]).reshape(-1, k)
    best, temperature = np.inf, 1.0
    for t in np.geomspace(0.05, 20, 60):
        loss = -np.log(np.maximum(_softmax(scores / t)[np.arange(len(held)), labels[held]], 1e-12)).mean() if len(held) else 0.0
        if loss < best:
            best, temperature = loss, float(t)
    right = scores.argmax(axis=1) == labels[held] if len(held) else np.zeros(0, bool)
    sure = np.sort(_softmax(scores / temperature).max(axis=1)[right]) if right.any() else np.ones(1)
    reject = min(0.5, float(sure[int(0.002 * len(sure))]))      # at most 0.2 % of the rightly labelled fall below
    return Model(languages, table.astype(np.float32), bias, temperature, reject)


def fit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", fit_rows: int = FIT_ROWS) -> Model | None:
    """Fit on about ``fit_rows`` of the distinct labelled texts of ``docs``, picked by a hash of the text; None without any.

    Rows with a null language or text aren't used. A text with many copies is
    one of its language's texts, so copies neither fill the sample nor reach
    the driver; a text under two languages counts once for each. The sample is
    all that reaches the driver; numbers of distinct texts by language are
    estimated over all rows (within some five per cent). Languages are few: one
    score column each.
    """
    rows = docs.select(F.col(text_col).cast("string").alias("_text"), F.col(lang_col).cast("string").alias("lang")).where("_text IS NOT NULL AND lang IS NOT NULL")
    rows = rows.withColumn("_hash", F.xxhash64("_text"))
    counts = {r.lang: r.n for r in rows.groupBy("lang").agg(F.approx_count_distinct("_hash", 0.02).alias("n")).collect()}
    if not counts:
        return None
    languages = sorted(counts)
    part = F.lit(0.0)
    for lang, n in counts.items():
        part = F.when(F.col("lang") == lang, fit_rows / len(counts) / n).otherwise(part)
    chosen = rows.where(F.pmod("_hash", F.lit(1 << 30)) < part * float(1 << 30))
    chosen = chosen.groupBy("lang", "_hash").agg(F.min("_text").alias("_text"))
    bags = add_columns(chosen, "_text", ["lang"], [("buckets", "binary"), ("counts", "binary")],
                       lambda: lambda texts: list(zip(*_bags(texts)))).toPandas()
    bags = bags.assign(buckets=bags["buckets"].map(bytes), counts=bags["counts"].map(bytes)).sort_values(["lang", "buckets", "counts"])
    pairs = [(np.frombuffer(b, "<u4").astype(np.int64), np.frombuffer(c, "<u4")) for b, c in zip(bags["buckets"], bags["counts"])]
    return train(pairs, np.array([languages.index(x) for x in bags["lang"]], dtype=np.int64), languages)


def predict(docs: DataFrame, model: Model | None, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns (all if None) and ``lang_pred``, ``score`` (calibrated, 0..1) and ``rejected``.

    A null text or one without a letter is ``und`` with score 0 and rejected;
    so is every text if there is no model. A text is also rejected if its
    score is below the calibrated threshold. Columns of ``docs`` with the names
    of the three are replaced.
    """
    def make():
        if model is None:
            return lambda texts: ([UNKNOWN] * len(texts), [0.0] * len(texts), [True] * len(texts))
        names = np.array([*model.languages, UNKNOWN], dtype=object)

        def run(texts):
            own, bucket, lettered = _subwords(texts)
            n = np.bincount(own, minlength=len(texts))
            scores = np.stack([np.bincount(own, weights=model.table[bucket, k], minlength=len(texts)) for k in range(len(model.languages))], axis=1)
            scores = _softmax((scores / np.maximum(n, 1)[:, None] + model.bias) / model.temperature)
            best = np.where(lettered, scores.argmax(axis=1), len(model.languages))
            score = np.where(lettered, scores.max(axis=1), 0.0)
            return names[best].tolist(), score, score < model.reject_below if len(texts) else []
        return run

    return add_columns(docs, text_col, docs.columns if keep is None else keep,
                       [("lang_pred", "string"), ("score", "double"), ("rejected", "boolean")], make)
