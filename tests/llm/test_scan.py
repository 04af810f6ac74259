"""Decontamination, sharding and license scans against brute force."""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections import Counter, defaultdict

import pytest

from tests.llm import brute
from tests.llm.helpers import SCHEMA, some_texts, table
from tirepulse.llm import decontaminate, license_scan, sharding

ITEM = "Quo vadis 12 the RIVER runs, deep and the éclair sings; over nine hills again"


@pytest.fixture(scope="module")
def rows():
    texts = some_texts()
    longer = "start " + ITEM.replace(" ", "  \n") + " end " + ITEM
    return texts + [(50, longer), (51, "THE river RUNS deep and the éclair sings over nine hills"), (52, "short item!"),
                    (53, "x short-ITEM y short item short"), (54, "the river runs deep and the ÉCLAIR sings over nine hills")]


ITEMS = [(1, ITEM), (2, "short item"), (10, ITEM), (3, None), (4, ""), (5, "..."), (None, "short item"), (1, ITEM),
         (6, "the river runs deep and the éclair sings over")]


def _items(spark, items=ITEMS):
    return spark.createDataFrame([(*x, "z") for x in items], "item_id long, text string, phrase string")


def test_contamination_equals_brute_force(spark, rows):
    got = decontaminate.contamination(table(spark, rows), _items(spark)).collect()
    assert len(got) == len(rows)
    want = brute.decontamination(rows, ITEMS)
    assert {r.doc_id: (r.n_words, r.n_hit, r["items"]) for r in got} == want
    assert sum(w[1] > 0 for w in want.values()) >= 4


def test_contamination_without_broadcasts(spark, rows):
    params = decontaminate.DecontaminationParams(broadcast_rows=0, rarest=3, window=4)
    got = decontaminate.contamination(table(spark, rows), _items(spark), params).collect()
    assert {r.doc_id: (r.n_words, r.n_hit, r["items"]) for r in got} == brute.decontamination(rows, ITEMS, 4)


def test_contamination_of_awkward_tables(spark):
    docs = table(spark, [(None, ITEM), (1, ITEM), (1, ITEM), (2, None)])
    got = sorted((str(r.doc_id), r.n_words, r.n_hit) for r in decontaminate.contamination(docs, _items(spark)).collect())
    n = len(brute.words(ITEM))
    assert got == [("1", n, n), ("1", n, n), ("2", 0, 0), ("None", n, 0)]
    none = decontaminate.contamination(docs, _items(spark, []))
    assert {r.n_hit for r in none.collect()} == {0}
    assert decontaminate.contamination(spark.createDataFrame([], SCHEMA), _items(spark)).collect() == []


def test_keep_clean_drops_hit_documents_only(spark, rows):
    want = brute.decontamination(rows, ITEMS)
    out = decontaminate.keep_clean(table(spark, rows), _items(spark))
    assert sorted(r.doc_id for r in out.collect()) == sorted(i for i, w in want.items() if w[1] == 0)


def test_proximity_finds_reordered_windows(spark):
    docs = table(spark, [(1, "zeta beta one alpha gamma"), (2, "alpha beta gamma zeta"), (3, "alpha x x x x x x x x x x x x beta gamma zeta"),
                         (4, "alpha beta gamma")])
    items = _items(spark, [(1, "alpha beta gamma zeta")])
    params = decontaminate.DecontaminationParams(window=4)
    assert {r.doc_id for r in decontaminate.proximity_matches(docs, items, 2, params).collect()} == {1, 2}
    assert {r.doc_id for r in decontaminate.phrase_matches(docs, items, params).collect()} == {2}


def test_main_path_has_no_python(spark, rows):
    plan = decontaminate.contamination(table(spark, rows), _items(spark))._jdf.queryExecution().executedPlan().toString()
    plan += sharding.shard(table(spark, rows))._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas"))


def _check_shards(out, rows, shards):
    sizes, slots = Counter(), defaultdict(list)
    for r in out:
        sizes[r.shard] += r.size
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert set(sizes) <= set(range(shards))
    want = Counter((i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in rows)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in out) == want
    return sizes


def test_shards_are_near_equal_and_keep_copies_together(spark):
    rows = [(k, f"text {k} " + "x" * (k * 37 % 400)) for k in range(3000)]
    rows += [(5000 + k, "copied " * 20) for k in range(30)] + [(9000 + k, None) for k in range(10)] + [(None, "none")] * 3
    out = sharding.shard(table(spark, rows), sharding.ShardingParams(shards=6, ranges_per_shard=8)).collect()
    sizes = _check_shards(out, rows, 6)
    mean = sum(sizes.values()) / 6
    assert max(sizes.values()) < 1.03 * mean and min(sizes.values()) > 0.97 * mean
    assert len({r.shard for r in out if r.doc_id and 5000 <= r.doc_id < 5030}) == 1
    assert {r.law for r in out} == {"bytes"}


def test_a_text_with_a_third_of_the_rows_is_split(spark):
    rows = [(k, "hot text " * 8) for k in range(1000)] + [(2000 + k, f"cold {k} " * 6) for k in range(2000)]
    out = sharding.shard(table(spark, rows), sharding.ShardingParams(shards=8, ranges_per_shard=8)).collect()
    sizes = _check_shards(out, rows, 8)
    mean = sum(sizes.values()) / 8
    assert max(sizes.values()) < 1.05 * mean and min(sizes.values()) > 0.95 * mean


def test_every_overfull_range_is_subdivided(spark):
    """A poor first sample leaves ranges of many light keys; none stays over 1.5 shares."""
    params = sharding.ShardingParams(shards=4, ranges_per_shard=16, sample_per_range=1)
    rows = [(k, f"text {k} " + "x" * (k * 37 % 90)) for k in range(4000)] + [(9000 + k, "hot text " * 8) for k in range(1500)]
    records = sharding._records(table(spark, rows), params)
    total, ranges = records.agg({"size": "sum"}).first()[0], 64
    share = total / ranges

    def light(cuts):
        sums, keys = Counter(), Counter()
        for r in records.collect():
            keys[r.key] += r.size
        for key, n in keys.items():
            if n <= 0.5 * share:
                sums[bisect_right(cuts, key)] += n
        return max(sums.values()) / share

    first = sharding.splitters(records, total, ranges, params)
    assert light(first) > 2
    cuts = sharding.refined(records, first, total, ranges, params)
    assert set(first) <= set(cuts) and light(cuts) <= 1.5
    sizes = _check_shards(sharding.shard(table(spark, rows), params).collect(), rows, 4)
    assert max(sizes.values()) - min(sizes.values()) < 2 * share


def test_repeated_rows_of_one_document_are_dealt_over_cells(spark):
    params = sharding.ShardingParams(shards=4, ranges_per_shard=8)
    rows = [(7, "hot text " * 8)] * 1500 + [(k, f"cold {k} " * 6) for k in range(100, 1600)]
    records = sharding._records(table(spark, rows), params)
    total = records.agg({"size": "sum"}).first()[0]
    ranged = sharding._with_ranges(records, sharding.splitters(records, total, 32, params), params)
    cells = sharding._subdivide(ranged, total, 32).filter("heavy IS NOT NULL").groupBy("part").count().collect()
    assert len(cells) > 20 and max(r["count"] for r in cells) < 150
    sizes = _check_shards(sharding.shard(table(spark, rows), params).collect(), rows, 4)
    assert max(sizes.values()) < 1.05 * min(sizes.values())


def test_one_very_long_text_beside_short_ones(spark):
    rows = [(1, "long " * 400_000)] + [(k, f"short {k}") for k in range(2, 400)]
    _check_shards(sharding.shard(table(spark, rows)).collect(), rows, 24)


def test_op2_query_equals_its_tables_rows(spark):
    from tests.conftest import SF_SMALL
    from tirepulse.llm.catalog import op2_sharding
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    out = op2_sharding(spark, SF_SMALL).collect()
    sizes = _check_shards(out, [(r.doc_id, r.text) for r in docs.collect()], 24)
    mean = sum(sizes.values()) / 24
    assert max(abs(n - mean) for n in sizes.values()) < max(mean / 16, 2 * max(r.size for r in out))
    assert {r.grown_shard for r in out} == {None}


def test_sharding_of_small_tables(spark):
    _check_shards(sharding.shard(table(spark, [(1, "a"), (1, "a"), (2, None)])).collect(), [(1, "a"), (1, "a"), (2, None)], 24)
    assert sharding.shard(spark.createDataFrame([], SCHEMA)).collect() == []


NOTICES = [(1, "Intro\nReleased under the MIT License.\nmore"), (2, "UNDER the mit\tlicense under the MIT license"),
           (3, "This work is licensed, under the GNU General Public License version 3 or later"),
           (4, "apache license. version 2"), (5, "license apache version 2 under the licensed mit"), (6, None), (7, ""),
           (8, "cc by-nc " * 40), (None, "cc by nc"), (9, "word " * 200 + "released under the mit license " + "word " * 200),
           (9, "under the mit license")]


def _expected(text, params=license_scan.LicenseParams()):
    w = brute.words(text)
    places = [(k, label) for p, label in params.phrases for k in range(len(w)) if w[k:k + len(p.split())] == p.split()]
    labels, best = {x for _, x in places}, 1.0 if places else 0.0
    for line in (text or "").split("\n"):
        lw = brute.words(line)
        for k in [0] if len(lw) <= params.block_words else range(0, len(lw), params.block_words // 2):
            block = set(lw[k:k + params.block_words])
            for t, label in params.templates:
                share = len(block & set(brute.words(t))) / len(set(brute.words(t)))
                if share >= params.threshold:
                    labels.add(label)
                    best = max(best, share)
    starts = [k for k, _ in places]
    return (len(w), len(places), min(starts, default=None), max(starts, default=None),
            ",".join(sorted({x for _, x in places})), ",".join(sorted(labels)), best)


def test_license_scan_equals_brute_force(spark):
    rows = some_texts() + NOTICES
    out = license_scan.summary(license_scan.scan(table(spark, rows))).collect()
    got = Counter((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels, r.score) for r in out)
    assert got == Counter((i, *_expected(t)) for i, t in rows)


def test_license_scan_low_threshold_and_empty(spark):
    params = license_scan.LicenseParams(threshold=0.4, block_words=8)
    out = license_scan.summary(license_scan.scan(table(spark, NOTICES), params)).collect()
    assert Counter((r.doc_id, r.labels, r.score) for r in out) == Counter(
        (i, _expected(t, params)[5], _expected(t, params)[6]) for i, t in NOTICES)
    assert license_scan.scan(spark.createDataFrame([], SCHEMA)).collect() == []
    bare = license_scan.LicenseParams(templates=(), phrases=())
    assert {r.n_base for r in license_scan.summary(license_scan.scan(table(spark, NOTICES), bare)).collect()} == {0}


WRAPPED = [(1, "Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided that", "bsd"),
           (2, "/* You can redistribute it and/or modify\n * it under the terms of the GNU General Public License. */", "gpl"),
           (3, "the terms of the GNU Lesser General Public\nLicense as published by\nthe Free Software Foundation", "lgpl"),
           (4, "word\n" * 130 + "Redistribution and use in source\r\n\r\nand binary forms, with or without\r\nmodification, are permitted\n" + "word\n" * 130, "bsd"),
           (5, "Released under the MIT License.\n" + "word " * 200, "mit"), (6, "redistribution and use\n" + "word\n" * 70 + "modification are permitted", "")]


def _document_blocks(text, params=license_scan.LicenseParams()):
    """Labels and best containment over the windows of the whole document and of each line."""
    labels, best = set(), 0.0
    for part in [text, *text.split("\n")]:
        w = brute.words(part)
        for k in [0] if len(w) <= params.block_words else range(0, len(w), params.block_words // 2):
            for t, label in params.templates:
                share = len(set(w[k:k + params.block_words]) & set(brute.words(t))) / len(set(brute.words(t)))
                if share >= params.threshold:
                    labels.add(label)
                    best = max(best, share)
    return ",".join(sorted(labels)), best


def test_wrapped_notices_are_found(spark):
    rows = [(i, t) for i, t, _ in WRAPPED]
    rows += [(100 + k, "\n".join(t.split(" "))) for k, (t, _) in enumerate(license_scan.TEMPLATES)]
    out = license_scan.summary(license_scan.scan(table(spark, rows), license_scan.LicenseParams(phrases=()))).collect()
    got = {r.doc_id: (r.labels, r.score) for r in out}
    assert got == {i: _document_blocks(t) for i, t in rows}
    assert all(label in got[i][0].split(",") for i, _, label in WRAPPED)
    assert all(label in got[100 + k][0].split(",") for k, (_, label) in enumerate(license_scan.TEMPLATES))


MARKED = [("Released under the Apache License", ""), ("Licensed under CC BY 4.0", ""), ("Released under the MIT License", "mit"),
          ("GNU General Public License as published by the Free Software Foundation", ""),
          ("GNU Library General Public License as published by the Free Software Foundation", "lgpl"),
          ("redistribute it and/or modify it under the terms of the GNU\nLesser General Public License, you can", ""),
          ("You can redistribute it and/or modify it under the terms of the GNU General Public License", "gpl"),
          ("This work is licensed under the GNU General Public License, version 2.", ""),
          ("This work is licensed under the GNU General Public License v3", "gpl-3"),
          ("Licensed under the Apache License, Version 1.0", ""), ("Licensed under the Apache License, 2.0", "apache-2"),
          ("Licensed under CC BY-NC 3.0", "cc-by-nc"), ("the license " + "word " * 20 + "was released under", ""),
          ("This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License", ""),
          ("This work is licensed under a Creative Commons Attribution 3.0 International License", "cc-by"),
          ("Permission is hereby granted, free of charge, to any person or organization obtaining a copy of this software", ""),
          ("This Source Code Form is subject to the terms of the Eclipse Public License", "")]


def test_labels_need_the_words_that_tell_licenses_apart(spark):
    rows = [(k, t) for k, (t, _) in enumerate(MARKED)] + [(100 + k, t) for k, (t, _) in enumerate(license_scan.TEMPLATES)]
    out = {r.doc_id: r for r in license_scan.summary(license_scan.scan(table(spark, rows))).collect()}
    assert [out[k].labels for k in range(len(MARKED))] == [label for _, label in MARKED]
    assert all((out[k].score > 0) == (label != "") for k, (_, label) in enumerate(MARKED))
    assert all(label in out[100 + k].labels.split(",") for k, (_, label) in enumerate(license_scan.TEMPLATES))
    assert len(license_scan.MARKS) == len(license_scan.TEMPLATES)
