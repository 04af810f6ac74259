"""The registered queries against brute force over whole tables, the training
samples' bounds, and the life of intermediate tables."""

from __future__ import annotations

import math
import os
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tests.conftest import SF_SMALL
from tests.llm.helpers import SCHEMA, some_texts, table
from tests.llm.test_scan import MARKED, NOTICES, WRAPPED
from tirepulse.llm import catalog, language_id, license_scan, quality, store
from tirepulse.llm import textscan as ts
from tirepulse.llm.oracle import ORACLE
from tirepulse.llm.sample import bounded
from tirepulse.llm.tokens import default_tokenizer

WORD = rb"[0-9A-Za-z\x80-\xff]+"
PUNCTUATION = rb"[^\x20\x09-\x0D0-9A-Za-z\x80-\xff]+"
GOLDEN = 0x9E3779B97F4A7C15


def _table(spark, name):
    return spark.read.parquet(f"{SF_SMALL}/{name}.parquet")


def _texts(spark):
    return {r.doc_id: r.text for r in _table(spark, "documents").collect()}


def _held(doc_id) -> bool:
    return zlib.crc32(str(doc_id).encode()) % 3 == 1


# ---------------------------------------------------------------- quality


def _mix(x: int) -> int:
    return int(ts.mix(np.array([x % 2**64], np.uint64))[0])


def _quality_grams(text: str | None, buckets_log2: int) -> list[list[int]]:
    """Buckets of each n-gram kind, n-gram by n-gram, from the docstring's rules."""
    raw = (text or "").encode()
    tokens = [m.group() for m in re.finditer(WORD + rb"|" + PUNCTUATION, raw)]
    hashes = [int(ts.word_hashes(np.frombuffer(t, np.uint8), np.zeros(1, np.int64), np.full(1, len(t)))[0]) for t in tokens]
    shapes, last = [], None
    for t, h in zip(tokens, hashes):
        if not re.match(WORD, t):
            shapes.append(_mix(h + 99))
            continue
        upper = sum(65 <= c <= 90 for c in t)
        shape = 4 if re.search(rb"[0-9]", t) else 1 if not upper else 2 if upper == 1 and len(t) > 1 else 3
        shapes.append(_mix(shape + 8 * (t == last) + 99))
        last = t
    kinds = []
    for salt, stream, order in ((1, hashes, 1), (2, hashes, 2), (3, shapes, 1), (4, shapes, 2), (5, shapes, 3)):
        kind = []
        for k in range(len(stream) - order + 1):
            h = salt
            for x in stream[k:k + order]:
                h = _mix(h * GOLDEN + x)
            kind.append(h >> (64 - buckets_log2))
        kinds.append(kind)
    return kinds


def _quality_score(text, weights, bias) -> float:
    log2 = weights.size.bit_length() - 1
    total = bias + sum(sum(float(weights[b]) for b in kind) / len(kind) for kind in _quality_grams(text, log2) if kind)
    return 1 / (1 + math.exp(-min(30.0, max(-30.0, total))))


def test_op10_query_equals_scores_gram_by_gram(spark):
    docs, labels = _table(spark, "documents"), _table(spark, "labels")
    weights, bias = quality.fit(docs, labels)
    texts = _texts(spark)
    out = catalog.op10_quality(spark, SF_SMALL).collect()
    assert sorted(r.doc_id for r in out) == sorted(texts)
    for r in out:
        assert r.held_out == _held(r.doc_id) and r.predicted == int(r.score >= 0.5)
        assert abs(r.score - _quality_score(texts[r.doc_id], weights, bias)) < 1e-9


def test_quality_of_very_long_and_awkward_texts_equals_brute_force(spark):
    rng = np.random.default_rng(1)
    weights = rng.normal(size=1 << 12).astype(np.float32)
    texts = [t for _, t in some_texts()] + ["One two. Two TWO 2wo!! " * 120_000, "word", "\x00\x01 a"]     # 2.8 MB
    got = quality.score_texts(pa.array(texts), weights, 0.1).to_pylist()
    assert got[-1] != got[-2]
    for g, t in zip(got, texts):
        if t is not None and len(t) > 1_000_000:
            t, whole = t[:23 * 2000], True       # periodic: a long stretch has nearly the shares of the whole
        else:
            whole = False
        assert abs(g - _quality_score(t, weights, 0.1)) < (1e-3 if whole else 1e-9)


def test_training_equals_plain_follow_the_regularised_leader():
    rng = np.random.default_rng(2)
    params = quality.QualityParams(buckets_log2=6, epochs=3)
    rows = [(np.sort(rng.choice(64, 5, replace=False)), rng.uniform(0.1, 1, 5)) for _ in range(60)]
    labels = rng.integers(0, 2, 60).astype(float)
    weights, bias = quality.train(rows, labels, params)
    share = (labels.sum() + 1) / 62
    prior = math.log(share / (1 - share))
    z, n = [0.0] * 65, [0.0] * 65

    def w(i):
        if abs(z[i]) <= params.l1:
            return 0.0
        return -(z[i] - math.copysign(params.l1, z[i])) / ((params.beta + math.sqrt(n[i])) / params.alpha + params.l2)

    order = np.random.default_rng(params.seed)
    for _ in range(params.epochs):
        for k in order.permutation(60):
            x = [*zip(rows[k][0].tolist(), rows[k][1].tolist()), (64, 1.0)]
            old = {i: w(i) for i, _ in x}
            p = 1 / (1 + math.exp(-(prior + sum(old[i] * v for i, v in x))))
            for i, v in x:
                g = (p - labels[k]) * v
                z[i] += g - (math.sqrt(n[i] + g * g) - math.sqrt(n[i])) / params.alpha * old[i]
                n[i] += g * g
    assert np.allclose(weights, [w(i) for i in range(64)], atol=1e-6) and abs(bias - prior - w(64)) < 1e-9


# ---------------------------------------------------------------- language


def _language(text, model) -> tuple[str, float]:
    """Language and score from the mean of the logits of all byte n-grams, one by one."""
    if text is None or not any(c.isalpha() for c in text):
        return "und", 0.0
    folded = [(b | 0x20 if 0x41 <= b <= 0x5A else b) if 0x41 <= b <= 0x5A or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in text.encode()]
    total, n = [0.0] * len(model.langs), 0
    for order in model.params.orders:
        for k in range(len(folded) - order + 1):
            h = order
            for b in folded[k:k + order]:
                h = (h * 0x01000193 % 2**32) ^ b
            h = h * 0x9E3779B1 % 2**32
            h = (h ^ (h >> 15)) * 0x85EBCA77 % 2**32
            bucket = h >> (32 - model.params.buckets_log2)
            total = [t + float(row[bucket]) for t, row in zip(total, model.logits)]
            n += 1
    z = [(t / max(n, 1) + float(b)) / model.temperature for t, b in zip(total, model.bias)]
    e = [math.exp(x - max(z)) for x in z]
    best = max(range(len(e)), key=lambda k: (e[k], -k))
    return model.langs[best], e[best] / sum(e)


def test_op7_query_equals_scores_gram_by_gram(spark):
    docs = _table(spark, "documents")
    model = language_id.fit(docs, ~quality.held_out())
    assert model.langs == sorted({r.lang for r in docs.collect() if not _held(r.doc_id) and r.lang is not None})
    texts = _texts(spark)
    out = catalog.op7_language_id(spark, SF_SMALL).collect()
    assert sorted(r.doc_id for r in out) == sorted(texts)
    for r in out:
        lang, score = _language(texts[r.doc_id], model)
        assert r.lang_pred == lang and abs(r.score - score) < 1e-6
        assert r.held_out == _held(r.doc_id) and r.rejected == (r.score < model.threshold)


def test_language_of_awkward_and_very_long_texts_equals_brute_force(spark):
    rows = [(k, "le la les des " * 5, "fr") for k in range(40)] + [(100 + k, "der die das und " * 5, "de") for k in range(40)]
    model = language_id.fit(table(spark, rows), F.lit(True))
    odd = [t for _, t in some_texts()] + ["é", "A", "12", "die der " * 3, "LE La les", "x" * 3, "ab"]
    best, score = language_id.predict(pa.array(odd), model)
    for b, s, t in zip(best, score, odd):
        lang, want = _language(t, model)
        assert (model.langs[b] if b >= 0 else "und") == lang and abs(s - want) < 1e-6
    long, short = "der die das und " * 300_000, "der die das und " * 3000              # 4.8 MB
    best, score = language_id.predict(pa.array([long, short]), model)
    assert best[0] == best[1] and abs(score[0] - score[1]) < 1e-3
    empty = language_id.identify(spark.createDataFrame([], SCHEMA), model)
    assert empty.collect() == []


# ---------------------------------------------------------------- the training samples


def test_samples_keep_to_rows_and_bytes_in_the_order_of_the_key(spark):
    rows = [(k, "é" * (1 + k % 7) * 10) for k in range(300)] + [(1000, None), (1001, "x" * 5000), (1, "again"), (1, "again")]
    df = table(spark, rows)
    key = F.xxhash64("doc_id")
    keys = {r.doc_id: r.k for r in df.select("doc_id", key.alias("k")).collect()}
    size = lambda t: len((t or "").encode())
    ranked = sorted(((keys[i], size(t), i) for i, t in rows if size(t) <= 4000 // 16))
    for max_rows, max_bytes in ((50, 10**6), (10**4, 4000), (60, 4000), (10**4, 10**6)):
        fits = [r for r in sorted((keys[i], size(t), i) for i, t in rows if size(t) <= max_bytes // 16)][:max_rows]
        total, want = 0, []
        for r in fits:
            total += r[1]
            if total > max_bytes:
                break
            want.append(r)
        got = bounded(df, key, max_rows, max_bytes)
        assert got.columns == df.columns
        assert Counter((keys[r.doc_id], size(r.text), r.doc_id) for r in got.collect()) == Counter(want)
    assert len(ranked) == len(rows) - 1
    assert bounded(spark.createDataFrame([], SCHEMA), key, 5, 5).collect() == []


def test_models_train_within_their_bytes(spark):
    rows = [(k, ("good words here " if k % 2 else "BAD !! ** ") * 20, "en" if k % 2 else "de") for k in range(200)]
    rows += [(k, "huge " * 200_000, "en") for k in range(200, 204)]
    docs, labels = table(spark, rows), spark.createDataFrame([(r[0], r[0] % 2) for r in rows], "doc_id long, quality int")
    few = quality.QualityParams(max_train_bytes=8000)
    out = {r.doc_id: r for r in quality.classify(docs, labels, few).collect()}
    assert sum(out[k].predicted == k % 2 for k in range(200)) >= 190 and len(out) == len(rows)
    model = language_id.fit(docs, F.lit(True), language_id.LanguageParams(max_train_bytes=16_000))
    assert model.langs == ["de", "en"]
    none = quality.classify(docs, labels, quality.QualityParams(max_train_bytes=0)).collect()
    assert len(none) == len(rows) and len({r.score for r in none}) == 1


# ---------------------------------------------------------------- license scan, packing, nearest neighbours


def test_op4_sql_and_operator_agree_on_awkward_rows(spark):
    rows = some_texts() + NOTICES + [(i, t) for i, t, _ in WRAPPED] + [(k, t) for k, (t, _) in enumerate(MARKED)]
    got = Counter(tuple(r) for r in license_scan.summary(license_scan.scan(table(spark, rows))).collect())
    with duckdb.connect() as con:
        con.register("documents", pa.table({"doc_id": [r[0] for r in rows], "text": [r[1] for r in rows]}))
        assert got == Counter(con.execute(ORACLE["op4_license_scan"]).fetchall())


def test_op8_query_equals_the_tokenizer(spark):
    plain, pieces, used = Tokenizer.from_file(default_tokenizer()), defaultdict(list), defaultdict(list)
    for r in catalog.op8_packing(spark, SF_SMALL).collect():
        pieces[r.doc_id].append(r)
        used[r.sequence_id].append((r.offset, r.length))
    texts = _texts(spark)
    assert set(pieces) == set(texts)
    for doc, text in texts.items():
        ids, at = [*plain.encode(text or "", add_special_tokens=False).ids, 1], 0
        for r in sorted(pieces[doc], key=lambda r: r.start):
            assert r.start == at and r.length > 0 and r.doc_tokens == len(ids)
            assert r.ids_crc32 == zlib.crc32(np.array(ids[at:at + r.length], "<u4").tobytes())
            at += r.length
        assert at == len(ids)
    for places in used.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 2048


def test_op9_query_equals_inner_products_of_what_it_finds(spark):
    vectors = {r.vec_id: np.array(r.embedding, np.float64) for r in _table(spark, "embeddings").collect()
               if r.embedding is not None and all(x is not None and math.isfinite(x) for x in r.embedding) and any(r.embedding)}
    found = defaultdict(list)
    for r in catalog.op9_nearest_neighbours(spark, SF_SMALL).collect():
        found[r.query_id].append(r)
    assert set(found) == {v for v in vectors if v % 20 == 0}
    hits = asked = 0
    for query, rows in found.items():
        rows.sort(key=lambda r: r.rank)
        assert [r.rank for r in rows] == list(range(1, min(20, len(vectors) - 1) + 1))
        assert len({r.vec_id for r in rows}) == len(rows) and query not in {r.vec_id for r in rows}
        assert [(-r.score, r.vec_id) for r in rows] == sorted((-r.score, r.vec_id) for r in rows)
        assert all(r.score == pytest.approx(float(vectors[query] @ vectors[r.vec_id]), rel=1e-12) for r in rows)
        best = sorted((-float(vectors[query] @ v), k) for k, v in vectors.items() if k != query)[:len(rows)]
        hits, asked = hits + len({k for _, k in best} & {r.vec_id for r in rows}), asked + len(best)
    assert hits >= 0.9 * asked


# ---------------------------------------------------------------- intermediate tables


def test_the_pipeline_leaves_only_its_result(spark):
    import corpus_pipeline
    with store.recorded() as made:
        inner = store.written(spark.range(3).toDF("x"), "recorded")
    assert len(made) == 1 and inner.count() == 3
    store.discard_all(spark, made)
    assert not os.path.exists(made[0].removeprefix("file:"))

    seen, written = [], corpus_pipeline.written

    def watched(df, name):
        out = written(df, name)
        seen.append(out)
        return out

    corpus_pipeline.written = watched
    try:
        out = corpus_pipeline.run(spark, SF_SMALL)
    finally:
        corpus_pipeline.written = written
    assert len(seen) == len(corpus_pipeline.STAGES) and out.count() > 0
    left = [os.path.exists(df.inputFiles()[0].removeprefix("file://")) for df in seen]
    assert left == [False] * (len(seen) - 1) + [True]
