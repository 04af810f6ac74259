"""Suffix-array, difference-cover and SimHash dedup against brute force."""

from __future__ import annotations

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm import brute
from tests.llm.helpers import SCHEMA, some_texts, table
from tirepulse.llm import components, keyed, simhash_near_dup, substring_dedup, suffix_dedup


@pytest.fixture(scope="module")
def rows():
    return some_texts()


def _suffix(df, **params):
    out = suffix_dedup.remove_repeats(df, suffix_dedup.SuffixParams(**params)).collect()
    return {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in out}, out


def test_suffix_dedup_equals_brute_force(spark, rows):
    got, out = _suffix(table(spark, rows))
    assert len(out) == len(rows) and got == brute.byte_repeats(rows)
    small, _ = _suffix(table(spark, rows), bucket_rows=4)       # many chunks a bucket
    assert small == got


def test_suffix_dedup_other_window(spark, rows):
    got, _ = _suffix(table(spark, rows), window=40, lead=16)
    assert got == brute.byte_repeats(rows, 40)


def test_suffix_dedup_null_and_repeated_ids(spark):
    text = "".join(chr(97 + k * k * k % 997 % 26) for k in range(300))
    out = suffix_dedup.remove_repeats(table(spark, [(None, text), (3, text), (3, text), (5, "x" + text)])).collect()
    kept = sorted((r.doc_id is None, r.doc_id or 0, r.n_removed) for r in out)
    assert kept == [(False, 3, 0), (False, 3, 0), (False, 5, 300), (True, 0, 0)]


def test_suffix_dedup_empty_table(spark):
    assert suffix_dedup.remove_repeats(spark.createDataFrame([], SCHEMA)).collect() == []


def test_keep_first_text_keeps_columns_and_rows(spark, rows):
    df = table(spark, rows)
    out = suffix_dedup.keep_first_text(df)
    assert out.columns == df.columns and out.dtypes == df.dtypes
    want = {i: kept.decode("utf-8", "ignore") for i, (_, _, _, kept) in brute.byte_repeats(rows).items()}
    got = {r.doc_id: r for r in out.collect()}
    assert {i: r.text for i, r in got.items()} == want
    assert all(r.n_chars == len(r.text) for r in got.values())


@settings(max_examples=40, deadline=None)
@given(st.lists(st.binary(min_size=20, max_size=20), min_size=1, max_size=40))
def test_multikey_sort_is_a_sort(keys):
    rows = np.array([list(k) for k in keys], np.uint8)
    assert [bytes(rows[i]) for i in suffix_dedup.multikey_sort(rows)] == sorted(keys)


def test_later_ones_marks_all_but_the_first_place():
    key = np.array([5, 5, 5, 6, 5])
    doc, at = np.array([2, 1, 1, 1, 1]), np.array([0, 7, 3, 0, 3])
    assert keyed.later_ones([key], doc, at).tolist() == [True, True, False, False, False]


def _substring(df, **params):
    out = substring_dedup.remove_repeats(df, substring_dedup.CoverParams(**params)).collect()
    return {r.doc_id: (r.n_words, r.n_removed, bytes(r.kept)) for r in out}, out


def test_substring_dedup_equals_brute_force(spark, rows):
    got, out = _substring(table(spark, rows))
    assert len(out) == len(rows) and got == brute.word_repeats(rows)
    short, _ = _substring(table(spark, rows), run_limit=3, run_mask=1)
    assert short == got


def test_substring_dedup_other_cover(spark, rows):
    got, _ = _substring(table(spark, rows), window=9, period=7, cover=(1, 2, 4))
    assert got == brute.word_repeats(rows, 9)


def test_cover_must_have_every_difference(spark, rows):
    assert substring_dedup.is_cover(substring_dedup.CoverParams())
    with pytest.raises(ValueError):
        _substring(table(spark, rows), cover=(0, 1, 2))


def test_substring_dedup_null_and_repeated_ids(spark):
    text = " ".join(f"w{k * k % 97}" for k in range(60))
    out = substring_dedup.remove_repeats(table(spark, [(None, text), (3, text), (3, text), (5, "x " + text)])).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.n_removed) for r in out) == [
        (False, 3, 0), (False, 3, 0), (False, 5, 60), (True, 0, 0)]
    assert substring_dedup.remove_repeats(spark.createDataFrame([], SCHEMA)).collect() == []


def _simhash(df, **params):
    out = simhash_near_dup.near_duplicates(df, simhash_near_dup.SimHashParams(**params)).collect()
    return {r.doc_id: (r.fingerprint, r.component_id) for r in out}, out


def test_simhash_equals_brute_force(spark, rows):
    got, out = _simhash(table(spark, rows))
    assert len(out) == len(rows) and got == brute.simhash_groups(rows)
    sharded, _ = _simhash(table(spark, rows), shard_rows=4, leaf_rows=2)
    assert sharded == got
    wide, _ = _simhash(table(spark, rows), shard_rows=4, leaf_rows=2, max_bits=20)
    assert wide == brute.simhash_groups(rows, 20)


def test_simhash_null_ids_and_empty_table(spark):
    out = simhash_near_dup.near_duplicates(table(spark, [(None, "a b c"), (None, "q w e r"), (4, "a b c"), (4, "a b c")])).collect()
    assert sorted(str(r.component_id) for r in out) == ["4", "4", "4", "None"]
    assert simhash_near_dup.near_duplicates(spark.createDataFrame([], SCHEMA)).collect() == []


def test_keep_first_leaves_one_of_each_group(spark, rows):
    groups = brute.simhash_groups(rows)
    df = table(spark, rows)
    out = simhash_near_dup.keep_first(df)
    assert out.columns == df.columns
    assert sorted(r.doc_id for r in out.collect()) == sorted(i for i, (_, c) in groups.items() if i == c)


@settings(max_examples=25, deadline=None)
@given(st.integers(0, 2 ** 32), st.integers(0, 6))
def test_close_pairs_are_all_pairs(seed, bits):
    rng = np.random.default_rng(seed)
    base = rng.integers(0, 2 ** 63, 6, dtype=np.uint64)
    points = np.unique(np.concatenate([base, *[base ^ np.uint64(1 << int(k)) ^ np.uint64(1 << int(j))
                                              for k, j in rng.integers(0, 63, (8, 2))]]))
    want = {(int(a), int(b)) for a in points for b in points if a != b and (int(a) ^ int(b)).bit_count() <= bits}

    def pairs(ordered):
        return {(int(a), int(b)) for x, y in simhash_near_dup.close_pairs(points, points, bits, 3, ordered) for a, b in zip(x, y)}

    assert pairs(False) == want and pairs(True) == {(a, b) for a, b in want if a < b}
    row, shard, asks = simhash_near_dup.route(points, simhash_near_dup.grow_upper(points, 3), bits)
    assert sorted(row[~asks].tolist()) == list(range(points.size))     # each point has one shard
    assert len(set(zip(row.tolist(), shard.tolist()))) == row.size     # and asks no shard twice
    home = dict(zip(row[~asks].tolist(), shard[~asks].tolist()))
    reach = set(zip(row.tolist(), shard.tolist()))
    place = {int(p): k for k, p in enumerate(points)}
    assert all((place[a], home[place[b]]) in reach or (place[b], home[place[a]]) in reach for a, b in want)


def test_shards_grow_with_the_table_and_queries_stay_few():
    params = simhash_near_dup.SimHashParams()
    depth = [simhash_near_dup.upper_depth(n, params) for n in (0, 1, 4096, 4097, 10 ** 6, 10 ** 7, 10 ** 8, 10 ** 10)]
    assert depth == [0, 0, 0, 1, 8, 8, 10, 17]
    points = np.random.default_rng(3).integers(0, 2 ** 64, 20_000, dtype=np.uint64)
    sent = []
    for levels in (4, 8):
        tree = simhash_near_dup.grow_upper(points[:2 ** levels * params.sample_per_shard], levels)
        row, _, _ = simhash_near_dup.route(points, tree, 2)
        sent.append(row.size / points.size)
    assert sent[0] < 3 and sent[1] < 4 * sent[0]   # 16 times the shards: under four times the rows


def test_keep_first_drops_unnamed_copies_of_named_rows(spark):
    rows = [(None, "a b c"), (4, "a b c"), (9, "a b c"), (None, "q w e r"), (None, "q w e r"), (5, "other words stand here")]
    df = table(spark, rows)
    out = simhash_near_dup.keep_first(df)
    assert out.columns == df.columns
    assert sorted((str(r.doc_id), r.text) for r in out.collect()) == [
        ("4", "a b c"), ("5", "other words stand here"), ("None", "q w e r"), ("None", "q w e r")]


def test_simhash_of_a_very_long_text_and_the_query(spark):
    from tests.conftest import SF_SMALL
    from tirepulse.llm.catalog import op6_simhash_near_dup
    rows = [(1, "some words again " * 60_000 + "end"), (2, "some words again " * 60_000 + "fin"), (3, "x")]
    assert _simhash(table(spark, rows))[0] == brute.simhash_groups(rows)
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in op6_simhash_near_dup(spark, SF_SMALL).collect()}
    assert got == brute.simhash_groups(docs)


def test_components_of_a_long_chain(spark):
    chain = [(k, k + 1) for k in range(60)] + [(100, 101), (102, 101), (7, 7), (None, 3)]
    roots = components.component_roots(spark.createDataFrame(chain, "a long, b long")).collect()
    assert {(r.u, r.v) for r in roots} == {(k, 0) for k in range(1, 61)} | {(101, 100), (102, 100)}


def _edges(n: int) -> list[tuple[int, str]]:
    """Documents that share a passage between words of their own, and some that also share what stands around it."""
    rng = np.random.default_rng(5)
    own = lambda: "".join(chr(97 + c) for c in rng.integers(0, 26, 150))
    passage, pair = own() + own(), (own(), own())
    return [(k, (pair[0] if k % 7 == 0 else own()) + passage + (pair[1] if k % 5 == 0 else own())) for k in range(n)]


def test_edges_of_a_shared_passage_are_split_over_tasks(spark):
    rows = _edges(600)
    params = suffix_dedup.SuffixParams(bucket_rows=64)
    heavy = suffix_dedup.heavy_leads(table(spark, rows), params)
    assert heavy.size
    docs = [np.frombuffer(t.encode(), np.uint8) for _, t in rows]

    def largest(heavy):
        """Most rows that one lead sends to a task, with every document a slice of its own."""
        leads = {}
        for (doc, text), data in zip(rows, docs):
            at, near, far, _ = suffix_dedup._elect(data, np.array([0, data.size]), 100, 24)
            batch = suffix_dedup.pa.RecordBatch.from_arrays(
                [suffix_dedup.pa.array([doc]), suffix_dedup.pa.array([text]),
                 suffix_dedup.pa.array([suffix_dedup._pack(at, at - far, at - near).tolist()])], ["doc_id", "text", "ats"])
            for out in suffix_dedup._suffix_rows(params, heavy)([batch]):
                for lead, context in zip(out.column(0).to_pylist(), out.column(1).to_pylist()):
                    leads.setdefault(lead, set()).add(context)
        return max(len(contexts) for contexts in leads.values())

    assert largest(np.zeros(0, np.uint64)) > 400      # one bucket for a row a document
    assert largest(heavy) <= 64
    got, _ = _suffix(table(spark, rows), bucket_rows=64)
    assert got == brute.byte_repeats(rows)
    whole, _ = _suffix(table(spark, rows))
    assert whole == got


def test_heavy_leads_of_repeated_and_null_ids(spark):
    rows = _edges(120) + _edges(120)[20:50] + [(None, _edges(3)[2][1])]
    apart = suffix_dedup.remove_repeats(table(spark, rows), suffix_dedup.SuffixParams(bucket_rows=8)).collect()
    whole = suffix_dedup.remove_repeats(table(spark, rows)).collect()
    assert sorted((str(r.doc_id), bytes(r.kept)) for r in apart) == sorted((str(r.doc_id), bytes(r.kept)) for r in whole)
