"""Quality classifier: hashed word n-gram logistic regression trained with
follow-the-regularised-leader updates, scored as sparse dot products.

Tokens are runs of word bytes and runs of punctuation of the whole text. Two
n-gram streams are hashed into ``buckets`` weights: the tokens themselves
(1- and 2-grams) and their shapes (1- to 3-grams). A shape says whether a word
is lower case, capitalised, upper case or has digits, whether it repeats the
word before it, and keeps punctuation as it is; it carries what invented or
rare words can't. A feature's value is its share of the document's n-grams, so
the score is one mean of gathered weights and does not depend on the length.

Training rows are a bounded sample (``max_train_rows`` and ``max_train_bytes``,
smallest hash of the id first) of the labelled rows; everything else runs over
all rows.

Edge cases: null and empty texts have no n-gram and get the bias alone; very
long texts are scored whole, and don't train if they take over a 16th of
``max_train_bytes``; rows with a null label or a doc_id that labels don't name
do not train; repeated rows are scored one by one; with no usable label, or one
class only, every score is the smoothed share of label 1 (0.5 without any row);
an empty table gives an empty result; extra columns are ignored by ``classify``
and kept by ``keep_good``.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tirepulse.llm import textscan as ts
from tirepulse.llm.sample import bounded
from tirepulse.llm.ship import shipped

PUNCTUATION = ~ts.WORD_BYTES & ts.SOLID_BYTES


@dataclass(frozen=True)
class QualityParams:
    buckets_log2: int = 18
    max_train_rows: int = 6000
    max_train_bytes: int = 32 << 20
    epochs: int = 4
    alpha: float = 0.5
    beta: float = 1.0
    l1: float = 1e-4
    l2: float = 1e-3
    seed: int = 17


def _tokens(data: np.ndarray, cut: np.ndarray):
    """Token starts, ends and hashes, shape codes, and each document's first token."""
    ws, we = ts.runs(ts.WORD_BYTES[data], cut)
    ps, pe = ts.runs(PUNCTUATION[data], cut)
    start = np.concatenate([ws, ps])
    order = np.argsort(start, kind="stable")
    start, end = start[order], np.concatenate([we, pe])[order]
    is_word = order < ws.size
    hashes = ts.word_hashes(data, start, end)
    upper = np.concatenate([[0], np.cumsum((data >= 0x41) & (data <= 0x5A))])
    digit = np.concatenate([[0], np.cumsum((data >= 0x30) & (data <= 0x39))])
    length = end - start
    n_upper = upper[end] - upper[start]
    shape = np.where(n_upper == 0, 1, np.where((n_upper == 1) & (length > 1), 2, 3))
    shape = np.where(digit[end] > digit[start], 4, shape)
    first = np.searchsorted(start, cut)          # token index of each document's start
    # the previous word, skipping punctuation
    idx = np.flatnonzero(is_word)
    again = np.zeros(start.size, bool)
    if idx.size > 1:
        same = hashes[idx[1:]] == hashes[idx[:-1]]
        same &= ts.owners(cut, start[idx[1:]]) == ts.owners(cut, start[idx[:-1]])
        again[idx[1:]] = same
    code = np.where(again, shape + 8, shape).astype(np.uint64)
    code = np.where(is_word, code, hashes)
    return hashes, ts.mix(code + np.uint64(99)), first


def _ngrams(data: np.ndarray, cut: np.ndarray, buckets_log2: int):
    """Yields (bucket of each n-gram, n-grams before each document) per n-gram kind."""
    hashes, shapes, first = _tokens(data, cut)
    n = hashes.size
    shift = np.uint64(64 - buckets_log2)
    for salt, stream, order in ((1, hashes, 1), (2, hashes, 2), (3, shapes, 1), (4, shapes, 2), (5, shapes, 3)):
        m = n - order + 1
        if m <= 0:
            yield np.zeros(0, np.int64), np.zeros(cut.size, np.int64)
            continue
        h = np.full(m, salt, np.uint64)
        for k in range(order):
            h = ts.mix(h * np.uint64(0x9E3779B97F4A7C15) + stream[k:k + m])
        inside = np.ones(m, bool)
        for k in range(1, order):                # n-grams must not cross a document's end
            over = first[1:-1] - k
            inside[over[(over >= 0) & (over < m)]] = False
        counts = np.concatenate([[0], np.cumsum(inside)])
        yield (h[inside] >> shift).astype(np.int64), counts[np.minimum(first, m)]


def features(texts: pa.Array, buckets_log2: int):
    """Sparse rows (buckets, shares) of a text column."""
    for lo, hi, data, cut in ts.slices(texts):
        kinds = list(_ngrams(data, cut, buckets_log2))
        for d in range(hi - lo):
            own = [b[c[d]:c[d + 1]] for b, c in kinds]
            where = [np.unique(x, return_counts=True) for x in own if x.size]
            if not where:
                yield np.zeros(0, np.int64), np.zeros(0)
                continue
            yield (np.concatenate([w[0] for w in where]),
                   np.concatenate([w[1] / x.size for w, x in zip(where, [x for x in own if x.size])]))


def train(rows, labels: np.ndarray, params: QualityParams) -> tuple[np.ndarray, float]:
    """Weights and bias by per-coordinate FTRL-proximal over the sparse rows."""
    size = (1 << params.buckets_log2) + 1        # the last one is the bias
    z, g2 = np.zeros(size), np.zeros(size)
    share = (labels.sum() + 1) / (labels.size + 2) if labels.size else 0.5
    prior = float(np.log(share / (1 - share)))
    if labels.size == 0 or labels.min() == labels.max():
        return np.zeros(size - 1, np.float32), prior
    rng = np.random.default_rng(params.seed)

    def weights(i):
        zi = z[i]
        return np.where(np.abs(zi) <= params.l1, 0.0,
                        -(zi - np.sign(zi) * params.l1)
                        / ((params.beta + np.sqrt(g2[i])) / params.alpha + params.l2))

    for _ in range(params.epochs):
        for k in rng.permutation(labels.size):
            i, x = rows[k]
            i, x = np.append(i, size - 1), np.append(x, 1.0)
            w = weights(i)
            p = 1 / (1 + np.exp(-np.clip(prior + w @ x, -30, 30)))
            g = (p - labels[k]) * x
            sigma = (np.sqrt(g2[i] + g * g) - np.sqrt(g2[i])) / params.alpha
            z[i] += g - sigma * w                # buckets are unique within a kind and rarely meet across kinds
            g2[i] += g * g
    final = weights(np.arange(size))
    return final[:-1].astype(np.float32), prior + float(final[-1])


def score_texts(texts: pa.Array, weights: np.ndarray, bias: float) -> pa.Array:
    """Probability of label 1 for each text."""
    out = np.empty(len(texts))
    buckets_log2 = int(weights.size).bit_length() - 1
    for lo, hi, data, cut in ts.slices(texts):
        total = np.full(hi - lo, bias)
        for bucket, count in _ngrams(data, cut, buckets_log2):
            sums = np.concatenate([[0.0], np.cumsum(weights[bucket], dtype=np.float64)])
            n = np.diff(count)
            total += np.diff(sums[count]) / np.maximum(n, 1)
        out[lo:hi] = 1 / (1 + np.exp(-np.clip(total, -30, 30)))
    return pa.array(out)


def held_out(doc_id: str = "doc_id", folds: int = 3) -> Column:
    """crc32 of the id as text, modulo ``folds``, is 1; a null id is not held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % folds == 1, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, params: QualityParams = QualityParams(),
        label: str = "quality") -> tuple[np.ndarray, float]:
    """Trains on at most ``max_train_rows`` labelled rows, and ``max_train_bytes`` of
    their texts, outside the held-out fold."""
    chosen = (labels.select("doc_id", F.col(label).cast("double").alias("_label"))
              .filter(F.col("_label").isin(0.0, 1.0) & F.col("doc_id").isNotNull() & ~held_out())
              .orderBy(F.xxhash64("doc_id"), "doc_id", "_label").limit(params.max_train_rows))
    # the side that is broadcast holds max_train_rows rows of two numbers at most
    labelled = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(F.broadcast(chosen), "doc_id")
    sample = (bounded(labelled, F.xxhash64("doc_id"), params.max_train_rows, params.max_train_bytes)
              .select("text", "_label").toArrow())
    rows = [r for chunk in sample["text"].chunks for r in features(chunk, params.buckets_log2)]
    return train(rows, sample["_label"].to_numpy(), params)


def score(df: DataFrame, model: tuple[np.ndarray, float], column: str = "text") -> Column:
    """Column with the probability of label 1 of ``column``."""
    shared = shipped(df.sparkSession).sparkContext.broadcast(model)   # 2**buckets_log2 floats

    @F.arrow_udf("double")
    def quality_score(texts: pa.Array) -> pa.Array:
        return score_texts(texts, *shared.value)

    return quality_score(F.col(column).cast("string"))


def classify(docs: DataFrame, labels: DataFrame, params: QualityParams = QualityParams()) -> DataFrame:
    """doc_id, held_out, score and predicted (score >= 0.5) of every row of ``docs``."""
    scored = docs.select("doc_id", score(docs, fit(docs, labels, params)).alias("score"))
    return scored.select("doc_id", held_out().alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, params: QualityParams = QualityParams()) -> DataFrame:
    """The rows of ``docs`` whose score is at least 0.5, all columns unchanged."""
    return docs.filter(score(docs, fit(docs, labels, params)) >= 0.5)
