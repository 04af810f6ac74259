"""Language identification by averaged hashed subword embeddings with a linear
softmax, trained by stochastic gradient descent, with calibrated rejection.

Subwords are the byte n-grams (``orders``) of the lower-cased text in which
everything but letters is a space. Each hashes to an embedding; a document is
the mean of its embeddings; a linear layer and softmax give the languages.
Because the layer is linear, scoring gathers each bucket's logits instead of
its embedding. A temperature and a rejection threshold are fitted on a part of
the sample that the descent does not see.

Training texts are a bounded sample: about ``max_rows_per_lang`` rows of each
language, chosen by a hash of the id, and ``max_train_bytes`` of text in all
(every language gives way alike); everything else runs over all rows. More
than ``max_langs`` languages are an error: the model has a row of logits for
each, and none is left out silently.

Edge cases: null texts and texts without a letter are ``und`` with score 0;
very long texts are judged whole, and don't train if they take over a 16th of
``max_train_bytes``;
rows with a null language or a null id do not train; a language that the sample
has never seen is not predicted; without any training row all are ``und``;
repeated rows are scored one by one; extra columns are ignored; an empty table
gives an empty result.
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

UNDETERMINED = "und"
_LETTERS = ts.byte_set((0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF))
_ASCII_LETTERS = ts.byte_set((0x41, 0x5A), (0x61, 0x7A))
#: Byte to byte: letters lower-cased, everything else a space.
_FOLD = np.where(_LETTERS, ts.LOWER, 0x20).astype(np.uint8)


@dataclass(frozen=True)
class LanguageParams:
    orders: tuple[int, ...] = (3, 4)
    buckets_log2: int = 16
    dim: int = 16
    max_rows_per_lang: int = 800
    max_langs: int = 400
    max_train_bytes: int = 32 << 20
    epochs: int = 5
    rate: float = 0.5
    calibration_share: float = 0.2
    accepted_accuracy: float = 0.999     # share of right ones among the accepted, on the calibration part
    seed: int = 5


@dataclass(frozen=True)
class LanguageModel:
    langs: list[str]
    logits: np.ndarray                   # one row a language, one column a bucket
    bias: np.ndarray
    temperature: float
    threshold: float
    params: LanguageParams


def _ngrams(data: np.ndarray, cut: np.ndarray, params: LanguageParams):
    """Per order: bucket of each n-gram, and the n-grams before each document."""
    folded = _FOLD[data].astype(np.uint32)
    for order in params.orders:
        m = data.size - order + 1
        if m <= 0:
            yield np.zeros(0, np.int64), np.zeros(cut.size, np.int64)
            continue
        h = np.full(m, order, np.uint32)
        for k in range(order):
            h = h * np.uint32(0x01000193) ^ folded[k:k + m]
        h *= np.uint32(0x9E3779B1)
        h ^= h >> np.uint32(15)
        h *= np.uint32(0x85EBCA77)
        bucket = (h >> np.uint32(32 - params.buckets_log2)).astype(np.int64)
        # a document of n bytes has n - order + 1 n-grams; those across its end are skipped
        own = np.maximum(np.diff(cut) - order + 1, 0)
        inside = np.ones(m, bool)
        for k in range(1, order):
            over = cut[1:-1] - k
            inside[over[(over >= 0) & (over < m)]] = False
        short = np.flatnonzero((np.diff(cut) > 0) & (np.diff(cut) < order))
        for d in short:                   # shorter than one n-gram
            inside[cut[d]:min(cut[d + 1], m)] = False
        yield bucket[inside], np.concatenate([[0], np.cumsum(own)])


def has_letter(texts: pa.Array) -> np.ndarray:
    """Whether each text has a Unicode letter."""
    out = np.zeros(len(texts), bool)
    for lo, hi, data, cut in ts.slices(texts):
        for table, test in ((_ASCII_LETTERS, None), (ts.byte_set((0x80, 0xFF)), str.isalpha)):
            found = np.concatenate([[0], np.cumsum(table[data])])
            for d in np.flatnonzero((np.diff(found[cut]) > 0) & ~out[lo:hi]):
                out[lo + d] = test is None or any(map(test, data[cut[d]:cut[d + 1]].tobytes().decode("utf-8", "replace")))
    return out


def _sparse_rows(texts: pa.Array, params: LanguageParams):
    for lo, hi, data, cut in ts.slices(texts):
        kinds = list(_ngrams(data, cut, params))
        for d in range(hi - lo):
            own = np.concatenate([b[c[d]:c[d + 1]] for b, c in kinds])
            bucket, count = np.unique(own, return_counts=True)
            yield bucket, count / max(1, own.size)


def train(rows: list, labels: np.ndarray, langs: list[str], params: LanguageParams) -> LanguageModel:
    """Descends on all rows but the calibration part, then calibrates."""
    rng = np.random.default_rng(params.seed)
    n, k = len(rows), len(langs)
    embedding = rng.uniform(-1, 1, (1 << params.buckets_log2, params.dim)) / params.dim
    layer, bias = np.zeros((params.dim, k)), np.zeros(k)
    order = rng.permutation(n)
    held, fit = np.split(order, [int(n * params.calibration_share)])
    steps = max(1, params.epochs * fit.size)
    t = 0
    for _ in range(params.epochs):
        for r in rng.permutation(fit):
            bucket, share = rows[r]
            rate = params.rate * (1 - t / steps)
            t += 1
            mean = share @ embedding[bucket]
            z = mean @ layer + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[labels[r]] -= 1
            back = layer @ p
            layer -= rate * np.outer(mean, p)
            bias -= 0.1 * rate * p
            embedding[bucket] -= (50 * rate * share)[:, None] * back
    z = np.array([share @ embedding[bucket] @ layer + bias for bucket, share in (rows[r] for r in held)]).reshape(-1, k)
    temperature, threshold = _calibrate(z, labels[held], params)
    return LanguageModel(langs, np.ascontiguousarray((embedding @ layer).T.astype(np.float32)), bias,
                         temperature, threshold, params)


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def _calibrate(z: np.ndarray, labels: np.ndarray, params: LanguageParams) -> tuple[float, float]:
    """Temperature of least log loss (each label smoothed by one row in all, so
    that a faultless sample isn't taken for certainty); least score above which
    enough are right."""
    if not labels.size:
        return 1.0, 0.0
    rows = np.arange(labels.size)
    grid = np.geomspace(0.1, 100, 61)
    blur = 1 / (labels.size + 2)
    target = np.full(z.shape, blur / max(1, z.shape[1] - 1))
    target[rows, labels] = 1 - blur
    loss = [-(target * np.log(np.maximum(_softmax(z / t), 1e-300))).sum(axis=1).mean() for t in grid]
    temperature = float(grid[int(np.argmin(loss))])
    p = _softmax(z / temperature)
    order = np.argsort(-p.max(axis=1), kind="stable")
    right = np.cumsum(p.argmax(axis=1)[order] == labels[order]) / (rows + 1)
    good = np.flatnonzero(right >= params.accepted_accuracy)
    return temperature, float(p.max(axis=1)[order[good[-1]]]) if good.size else 1.0


def predict(texts: pa.Array, model: LanguageModel) -> tuple[np.ndarray, np.ndarray]:
    """Index of the likeliest language (-1: undetermined) and its calibrated probability."""
    best, score = np.full(len(texts), -1), np.zeros(len(texts))
    if not model.langs:
        return best, score
    for lo, hi, data, cut in ts.slices(texts):
        sums, n = np.zeros((hi - lo, len(model.langs))), np.zeros(hi - lo)
        for bucket, first in _ngrams(data, cut, model.params):
            n += np.diff(first)
            for k, table in enumerate(model.logits):
                sums[:, k] += np.diff(np.concatenate([[0.0], np.cumsum(table[bucket], dtype=np.float64)])[first])
        p = _softmax((sums / np.maximum(n, 1)[:, None] + model.bias) / model.temperature)
        best[lo:hi], score[lo:hi] = p.argmax(axis=1), p.max(axis=1)
    letters = has_letter(texts)
    return np.where(letters, best, -1), np.where(letters, score, 0.0)


def fit(docs: DataFrame, usable: Column, params: LanguageParams = LanguageParams()) -> LanguageModel:
    """Trains on a bounded sample of the rows that are ``usable`` and have text, lang and id."""
    known = docs.filter(usable & F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull())
    counts = (known.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
              .orderBy(F.desc("n"), "lang").limit(params.max_langs + 1).collect())  # max_langs + 1 rows
    if len(counts) > params.max_langs:
        raise ValueError(f"more than max_langs = {params.max_langs} languages: raise the bound or map lang to fewer values")
    langs = sorted(r["lang"] for r in counts)
    if not langs:
        return LanguageModel([], np.zeros((0, 1 << params.buckets_log2), np.float32), np.zeros(0), 1.0, 1.0, params)
    chance = F.create_map(*[F.lit(x) for r in counts for x in (r["lang"], min(1.0, params.max_rows_per_lang / r["n"]))])
    draw = F.pmod(F.xxhash64("doc_id", F.lit(params.seed)), F.lit(1 << 52)) / float(1 << 52)
    drawn = known.filter(draw < chance[F.col("lang")]).select("doc_id", "lang", F.col("text").cast("string").alias("text"))
    sample = (bounded(drawn, draw / chance[F.col("lang")], 2 * params.max_rows_per_lang * len(langs), params.max_train_bytes)
              .orderBy("doc_id", "lang", "text").toArrow())
    rows = [r for chunk in sample["text"].chunks for r in _sparse_rows(chunk, params)]
    labels = np.array([langs.index(x) for x in sample["lang"].to_pylist()], np.int64)
    return train(rows, labels, langs, params)


def identify(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """doc_id, lang_pred, score and rejected (score below the calibrated threshold) of every row."""
    shared = shipped(docs.sparkSession).sparkContext.broadcast(model)     # langs * 2**buckets_log2 floats

    @F.arrow_udf("lang string, score double")
    def language(texts: pa.Array) -> pa.Array:
        best, score = predict(texts, shared.value)
        names = np.array([*shared.value.langs, UNDETERMINED], object)
        return pa.StructArray.from_arrays([pa.array(names[best], pa.string()), pa.array(score)], ["lang", "score"])

    found = docs.select("doc_id", language(F.col("text").cast("string")).alias("found"))
    return found.select("doc_id", F.col("found.lang").alias("lang_pred"), F.col("found.score").alias("score"),
                        (F.col("found.score") < model.threshold).alias("rejected"))
