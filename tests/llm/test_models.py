"""Quality classifier, language identification, packing, nearest neighbours, and the pipeline."""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tests.conftest import SF_MID, SF_SMALL
from tests.llm import brute
from tests.llm.helpers import SCHEMA, some_texts, table
from tirepulse.llm import collision_ann, language_id, packing, quality
from tirepulse.llm.tokens import PieceEncoder, default_tokenizer

# ---------------------------------------------------------------- quality


def _labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def test_quality_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{SF_MID}/{t}.parquet") for t in ("documents", "labels"))
    out = quality.classify(docs, labels)
    assert out.count() == docs.count()
    scored = out.filter("held_out").join(labels, "doc_id").select("predicted", "quality").collect()
    assert sum(r.predicted == r.quality for r in scored) / len(scored) >= 0.97
    for r in out.limit(30).collect():
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)


def test_quality_takes_awkward_rows(spark):
    rows = some_texts() + [(None, "text"), (1, "again")]
    labels = [(i, int(i is not None and i % 2), 0) for i, _ in rows] + [(2, None, 0), (None, 1, 0), (999, 1, 0), (2, 1, 0)]
    out = quality.classify(table(spark, rows), _labels(spark, labels)).collect()
    assert len(out) == len(rows) and all(0 <= r.score <= 1 for r in out)
    assert len({r.score for r in out if r.doc_id in (7, 8, 9, 19)}) == 1       # no words: the bias alone


def test_quality_without_or_with_one_sided_labels(spark):
    docs = table(spark, [(k, f"text {k}") for k in range(9)])
    assert {r.score for r in quality.classify(docs, _labels(spark, [])).collect()} == {0.5}
    one = quality.classify(docs, _labels(spark, [(k, 1, 0) for k in range(9)])).collect()
    assert len({r.score for r in one}) == 1 and one[0].score > 0.5
    assert quality.classify(spark.createDataFrame([], SCHEMA), _labels(spark, [])).collect() == []


def test_quality_score_equals_a_dot_product():
    texts = pa.array(["Good words here. Good words!", "", "BAD!! BAD!! ***", None, "Good"])
    rng = np.random.default_rng(3)
    weights = rng.normal(size=1 << 10).astype(np.float32)
    got = quality.score_texts(texts, weights, 0.25).to_numpy()
    for g, (bucket, share) in zip(got, quality.features(texts, 10)):
        assert abs(g - 1 / (1 + np.exp(-(0.25 + weights[bucket].astype(float) @ share)))) < 1e-9


# ---------------------------------------------------------------- language


def test_language_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    out = language_id.identify(docs, language_id.fit(docs, ~quality.held_out())).join(docs.select("doc_id", "lang"), "doc_id")
    held = out.filter(quality.held_out()).collect()
    assert sum(r.lang_pred == r.lang for r in held) / len(held) >= 0.97
    assert all(0 <= r.score <= 1 for r in held)


def test_language_undetermined_and_awkward_rows(spark):
    rows = [(k, "le la les des " * 5, "fr") for k in range(40)] + [(100 + k, "der die das und " * 5, "de") for k in range(40)]
    rows += [(200, None, "fr"), (201, "", "fr"), (202, "123 ... 45", "fr"), (203, "—…", "de"), (204, "é", "fr"), (205, "der die", None),
             (None, "le la", "fr"), (0, "le la les des " * 5, "fr")]
    docs = table(spark, rows)
    out = language_id.identify(docs, language_id.fit(docs, F.lit(True))).collect()
    assert len(out) == len(rows)
    got = {r.doc_id: r for r in out}
    assert all(got[i].lang_pred == "und" and got[i].score == 0 for i in (200, 201, 202, 203))
    assert got[204].lang_pred in ("fr", "de") and got[205].lang_pred == "de" and got[0].lang_pred == "fr"
    empty = language_id.identify(docs, language_id.fit(docs, F.lit(False))).collect()
    assert {r.lang_pred for r in empty} == {"und"}


def test_language_ngrams_stay_inside_documents():
    params = language_id.LanguageParams()
    texts = ["", "ab", "abc", "abcd", "héllo wörld", "x" * 10, "", "a b", "q"]
    whole = [np.concatenate([b for b, _ in language_id._ngrams(*_slice(t), params)]) for t in texts]
    kinds = list(language_id._ngrams(*_slice(*texts), params))
    for d in range(len(texts)):
        assert np.concatenate([b[f[d]:f[d + 1]] for b, f in kinds]).tolist() == whole[d].tolist()


def _slice(*texts):
    raw = [t.encode() for t in texts]
    return np.frombuffer(b"".join(raw), np.uint8), np.concatenate([[0], np.cumsum([len(r) for r in raw])])


# ---------------------------------------------------------------- packing

ODD = ["it's don't 'RE x's", "<|endoftext|> a<|startoftext|>b", "É é ÉÈ× a×b ÷", "naïve café's 12345 3.14 ½ ²",
       "éa ́x a b c\u0085d\x1ce", "—!!— …. 中文 テスト 😀😀!! a😀b", "ſ K ß ẞ İi", "a_b-c.d,e;f", "''ll 'll",
       "\x00\x01 a\x00b", "Ünï'cöde'S Œuvre œ", "x" * 5000, "ªº µ Ǆ ŉ"]


@pytest.fixture(scope="module")
def encoder():
    return PieceEncoder(default_tokenizer())


def _encoded(encoder, texts):
    ids, bounds, _ = encoder.encode(*_slice(*texts), 1)
    return [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:])]


def test_ids_equal_the_tokenizer(encoder):
    plain = Tokenizer.from_file(default_tokenizer())
    texts = ODD + ["", "  "] + [t or "" for _, t in some_texts()]
    want = [plain.encode(t, add_special_tokens=False).ids + [1] for t in texts]
    assert _encoded(encoder, texts) == want
    assert _encoded(encoder, texts) == want                      # from the cache


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("abZ É é'.!?<|> \n\t3½́×çñ中😀_-"), max_size=30), min_size=1, max_size=4))
def test_ids_equal_the_tokenizer_on_any_text(encoder, texts):
    plain = Tokenizer.from_file(default_tokenizer())
    assert _encoded(encoder, texts) == [plain.encode(t, add_special_tokens=False).ids + [1] for t in texts]


def _check_packing(out, rows, size=2048):
    plain = Tokenizer.from_file(default_tokenizer())
    ids = defaultdict(dict)
    sequences = defaultdict(list)
    for r in out:
        ids[r.doc_id][r.start] = np.frombuffer(bytes(r.ids), "<u4").tolist()
        sequences[r.sequence_id].append(r)
    for doc, text in rows:
        want = plain.encode(text or "", add_special_tokens=False).ids + [1]
        got = []
        for start in sorted(ids[doc]):
            assert start == len(got)
            got += ids[doc][start]
        assert got == want
    padding = total = 0
    for pieces in sequences.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= size and {r.padding for r in pieces} == {0 if at & (at - 1) == 0 else size - at}
        padding, total = padding + pieces[0].padding, total + at
    return padding / total


def test_packing_round_trip(spark):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert _check_packing(packing.pack(docs).collect(), rows) < 0.02
    small = packing.PackingParams(block_ids=20_000)             # many blocks a partition
    assert _check_packing(packing.pack(docs, small).collect(), rows) < 0.03


def test_packing_awkward_rows(spark):
    rows = [(k, t) for k, t in enumerate(ODD)] + [(50, None), (51, "")]
    out = packing.pack(table(spark, rows).coalesce(1)).collect()
    _check_packing(out, rows)
    assert packing.pack(table(spark, [(None, "a"), (1, "b"), (1, "b")]).coalesce(1)).count() == 3
    assert packing.pack(spark.createDataFrame([], SCHEMA)).collect() == []


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 9), st.integers(0, 6)), min_size=1, max_size=25))
def test_window_cuts_are_the_cheapest(steps):
    ends = np.concatenate([[0], np.cumsum([s for s, _ in steps])])
    penalty = np.array([0] + [p for _, p in steps])
    size = 12

    def cost(cuts):
        where = {int(e): int(p) for e, p in zip(ends, penalty)}
        return sum(size - (b - a) + where[b] for a, b in zip([0, *cuts], cuts))

    best = [0.0] + [float("inf")] * (len(ends) - 1)
    for j in range(1, len(ends)):
        best[j] = min(best[i] + size - (ends[j] - ends[i]) + penalty[j] for i in range(j) if ends[j] - ends[i] <= size)
    cuts = packing.window_cuts(ends, penalty, size)
    assert cost(cuts) == best[-1] and all(b - a <= size for a, b in zip([0, *cuts], cuts))


def test_too_many_languages_are_an_error(spark):
    df = table(spark, [(k, "some words of a text", f"l{k % 4}") for k in range(40)])
    with pytest.raises(ValueError, match="max_langs"):
        language_id.fit(df, F.lit(True), language_id.LanguageParams(max_langs=3))
    assert language_id.fit(df, F.lit(True), language_id.LanguageParams(max_langs=4)).langs == ["l0", "l1", "l2", "l3"]


def test_every_sentence_end_may_be_cut():
    rng = np.random.default_rng(3)
    sentences = np.cumsum(rng.integers(1, 20, 300))
    sentences = np.concatenate([sentences, sentences[-1] + 100 + np.cumsum(rng.integers(1, 20, 100))])
    documents, stop = sentences[9::10], int(sentences[-1]) + 70
    ends, penalty = packing.candidates(stop, documents, sentences, packing.PackingParams())
    given = dict(zip(ends.tolist(), penalty.tolist()))
    assert ends.tolist() == sorted(given) and ends[0] == 0 and ends[-1] == stop
    assert all(given[k] == 0 for k in documents.tolist())
    assert all(given[k] == 6 for k in set(sentences.tolist()) - set(documents.tolist()))
    assert np.diff(ends).max() <= 32
    marks = sorted({0, stop, *sentences.tolist()})
    inner = [k for a, b in zip(marks, marks[1:]) for k in range(a + 32, b, 32)]
    assert sorted(set(given) - set(marks)) == inner and all(given[k] == 20 for k in inner)
    # the cuts are the cheapest over all sentence ends
    size, best = 64, {0: 0}
    for j in ends.tolist()[1:]:
        best[j] = min(best[i] + size - (j - i) + given[j] for i in best if j - i <= size)
    cuts = packing.window_cuts(ends, penalty, size)
    assert sum(size - (b - a) + given[b] for a, b in zip([0, *cuts], cuts)) == best[stop]


# ---------------------------------------------------------------- nearest neighbours

VECTORS = "vec_id long, embedding array<float>, label int, score int, rank int"


def test_nearest_recall(spark):
    rng = np.random.default_rng(4)
    vectors = rng.normal(size=(4000, 24)).astype(np.float32)
    vectors *= rng.uniform(0.3, 2, (4000, 1)).astype(np.float32)          # inner product is not the angle
    df = spark.createDataFrame([(k, v.tolist(), 0, 1, 2) for k, v in enumerate(vectors)], VECTORS)
    for params in (collision_ann.CollisionParams(), collision_ann.CollisionParams(block_rows=1500, chunk_rows=50)):
        out = collision_ann.nearest(df, F.col("vec_id") % 40 == 0, params=params).collect()
        wide = vectors.astype(np.float64)
        found = defaultdict(dict)
        for r in out:
            found[r.query_id][r.rank] = (r.vec_id, r.score)
        hit = 0
        for q in range(0, 4000, 40):
            score = (wide * wide[q]).sum(axis=1)
            best = [k for k in np.lexsort((np.arange(4000), -score)) if k != q][:20]
            got = [found[q][k] for k in range(1, 21)]
            assert all(s == score[v] for v, s in got) and sorted(got, key=lambda x: (-x[1], x[0])) == got
            hit += len({v for v, _ in got} & set(best))
        assert hit / 2000 >= 0.9


def test_nearest_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [0.5, 2.0]), (4, None), (5, []), (6, [0.0, 0.0]), (7, [nan, 1.0]),
            (8, [inf, 1.0]), (9, [None, 1.0]), (None, [1.0, 1.0]), (20, [3.0]), (20, [2.0]), (40, [0.0, 0.0])]
    df = spark.createDataFrame([(*r, 0, 0, 0) for r in rows], VECTORS)
    out = collision_ann.nearest(df, F.col("vec_id") % 20 == 0).orderBy("query_id", "rank").collect()
    assert [(r.query_id, r.rank, r.vec_id, r.score) for r in out] == [
        (0, 1, 20, 2.0), (0, 2, 1, 1.0), (0, 3, 2, 1.0), (0, 4, 3, 0.5),
        (20, 1, 0, 2.0), (20, 2, 1, 2.0), (20, 3, 2, 2.0), (20, 4, 3, 1.0)]
    assert collision_ann.nearest(df.limit(0), F.lit(True)).collect() == []


def test_nearest_of_vectors_whose_squares_vanish_or_overflow(spark):
    rows = [(20 * k, [x * 1e-200, 1e-200], 0) for k, x in enumerate((1.0, 2.0, 3.0))] + [(1, [-1e-200, 0.0], 0)]
    schema = "vec_id long, embedding array<double>, label int"
    out = collision_ann.nearest(spark.createDataFrame(rows, schema), F.col("vec_id") % 20 == 0).collect()
    assert len(out) == 9 and {r.score for r in out} == {0.0, -0.0}            # all products vanish: ties by id
    huge = [(v, [x * 1e200 for x in e], lab) for v, e, lab in rows]
    out = collision_ann.nearest(spark.createDataFrame(huge, schema), F.col("vec_id") == 0).orderBy("rank").collect()
    assert [(r.vec_id, r.score) for r in out] == [(40, 4.0), (20, 3.0), (1, -1.0)]
    big = [(v, [x * 1e300 for x in e], lab) for v, e, lab in huge[:3]] + [(1, [1.0, 0.0], 0)]
    assert collision_ann.nearest(spark.createDataFrame(big, schema), F.col("vec_id") == 0).count() == 3


def test_windows_expand_over_blocks_of_any_size():
    """Candidates collide on enough lines, no other vector does; one path for small and large blocks."""
    rng = np.random.default_rng(8)
    for n in (30, 500, 3000):
        vectors = rng.normal(size=(n, 16))
        longest = float(np.sqrt((vectors ** 2).sum(axis=1).max()))
        p = collision_ann.CollisionParams(k=2, verified=0.1)
        index = collision_ann.BlockIndex(vectors, longest, p)
        compared = 0
        for q, rows in index.candidates(vectors[:20]):
            assert min(n, 20 + n // 10) <= rows.size <= n
            compared += rows.size
            centre, gap = index._centres(vectors[q:q + 1])[0], np.sqrt(np.maximum(longest ** 2 - (vectors ** 2).sum(axis=1), 0))
            away = np.abs(vectors @ index.lines[:-1] + gap[:, None] * index.lines[-1] - centre)
            # the windows' half width at which this many vectors collide on enough lines
            reach = np.sort(away, axis=1)[:, int(np.ceil(p.threshold * p.lines)) - 1]
            assert set(rows.tolist()) == set(np.argsort(reach, kind="stable")[:rows.size].tolist())
        assert n < 500 or compared < 0.4 * 20 * n


# ---------------------------------------------------------------- the pipeline


def test_pipeline_equals_brute_force(spark):
    import corpus_pipeline
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    labels = spark.read.parquet(f"{SF_SMALL}/labels.parquet")
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    good = {r.doc_id for r in quality.classify(docs, labels).filter("predicted = 1").collect()}
    rows = [(r.doc_id, r.text) for r in docs.collect() if r.doc_id in good]
    groups = brute.simhash_groups(rows)
    rows = [(i, t) for i, t in rows if groups[i][1] == i]
    kept = brute.byte_repeats(rows)
    rows = [(i, kept[i][3].decode("utf-8", "ignore")) for i, _ in rows]
    hit = brute.decontamination(rows, items)
    rows = [(i, t) for i, t in rows if hit[i][1] == 0]
    out = corpus_pipeline.run(spark, SF_SMALL).collect()
    assert Counter(r.doc_id for r in out if r.start == 0) == Counter(i for i, _ in rows)
    _check_packing(out, rows)


def test_pipeline_takes_awkward_documents(spark, tmp_path):
    import corpus_pipeline
    rows = some_texts() + [(None, "no id here"), (None, None), (2, "said twice"), (2, "said twice")]
    docs = table(spark, rows, clash=False)
    spark.createDataFrame([(1, 1, 0), (3, None, 0), (None, 0, 1)], "doc_id long, quality int, toxic int") \
        .write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, None), (None, "x y")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == SCHEMA.replace(" long", "").replace(" string", "").split(", ")
    assert corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).count() > 0
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, spark.createDataFrame([], SCHEMA), str(tmp_path)).collect() == []
