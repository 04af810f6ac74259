"""The filter audit against counting every order document by document."""

import re
from itertools import permutations

import numpy as np
from pyspark.sql import functions as F

from tests.llm.helpers import table
from tirepulse.llm import filter_audit


def _fails(rows):
    """Failed filters of (doc_id, text, lang) rows, as sets of letters."""
    out = []
    for doc, text, _ in rows:
        t = text or ""
        words = [w for w in re.split("[\x20\x09-\x0d]+", t) if w]
        f = set()
        if len(words) < 200:
            f.add("A")
        if 100 * len(set(words)) < 50 * len(words):
            f.add("B")
        if 100 * sum("A" <= c <= "Z" for c in t) > 3 * len(t):
            f.add("C")
        if any(c in "#$%&*|" for c in t):
            f.add("D")
        if doc is not None and any(d is not None and d < doc and (u or "") == t for d, u, _ in rows):
            f.add("E")
        out.append(f)
    return out


def _brute(rows, labels):
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, x in labels if x == 1 and d is not None}
    fails = _fails(rows)
    report = {}
    for part in {lang or "" for _, _, lang in rows}:
        own = [(d, f) for (d, _, lang), f in zip(rows, fails) if (lang or "") == part]
        shapley = dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left = own
            for step, k in enumerate(order, 1):
                gone = [x for x in left if k in x[1]]
                left = [x for x in left if k not in x[1]]
                shapley[k] += len(gone)
                report[part, "".join(order), step] = [
                    len(left), len(gone), sum(k in f for _, f in own) - len(gone), sum(f == {k} for _, f in own),
                    sum(d in good for d, _ in gone), sum(d in toxic for d, _ in gone), k]
    # the same filter has one value in each part: its removals in all orders
        for key, v in report.items():
            if key[0] == part:
                v[6] = shapley[v[6]]
    return report


def _rows():
    rng = np.random.default_rng(5)
    words = [f"w{k}" for k in range(150)]
    long = lambda n, kinds=150: " ".join(rng.choice(words[:kinds], n))
    texts = [long(230), long(230) + " #", long(210).upper(), long(199), long(200, 60), long(250, 110), "", None, "  \n", "AB cd", "é" * 40 + " A",
             "x " * 400, "a|b", "\x0bq\x0c" * 201, "日本 " * 220 + "A", long(5000)]
    rows = [(k, t, ["en", "de", None, ""][k % 4]) for k, t in enumerate(texts)]
    rows += [(100 + k, texts[k % 6], "en") for k in range(20)]                        # copies in one part
    rows += [(200 + k, texts[0], "fr") for k in range(5)]                             # copies of another part's text
    rows += [(3, texts[3], "en"), (3, texts[3], "en"), (0, texts[0], "en"), (None, texts[0], "en"), (None, None, None)]
    return rows


def test_audit_equals_counting_every_order(spark):
    rows = _rows()
    labels = [(k, k % 2, int(k % 3 == 0)) for k in range(0, 120, 2)] + [(3, 0, 0), (3, 1, None), (3, None, 1), (None, 1, 1), (9999, 1, 1)]
    clash = {c: F.lit(1) for c in ("part", "failed", "digest", "first", "good", "toxic", "quality", "all")}
    docs = table(spark, rows).withColumns(clash).repartition(5)
    marked = spark.createDataFrame(labels, "doc_id long, quality int, toxic int").withColumns({"part": F.lit("x"), "text": F.lit("y")})
    out = filter_audit.audit(docs, marked)
    expected = _brute(rows, labels)
    got = {(r.part, r.filter_order, r.step): [r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley] for r in out.collect()}
    assert out.count() == len(got) == len(expected) == 600 * 4
    assert got == expected


def test_every_order_removes_what_its_set_of_filters_removes(spark):
    out = filter_audit.audit(table(spark, _rows()), spark.createDataFrame([], "doc_id long, quality int, toxic int")).toPandas()
    n = {p: sum((lang or "") == p for _, _, lang in _rows()) for p in ("en", "de", "fr", "")}
    for part, own in out.groupby("part"):
        total = own.groupby("filter_order").removed.sum()
        assert total.nunique() == 1
        last = own[own.step == 5]
        assert (last.kept == n[part] - total.iloc[0]).all()
        # the filters' shares add up to what all of them remove, in each of 120 orders
        assert own[own.filter_order == "ABCDE"].shapley.sum() == 120 * total.iloc[0]
    assert (out.good_lost == 0).all() and (out.toxic_lost == 0).all()


def test_empty_tables(spark):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.audit(table(spark, []), labels).count() == 0


def test_positional_counts_are_bit_counts():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 3, 4, 7, 1000, 4097):
        words = rng.integers(0, 1 << 32, n, dtype=np.uint64).astype(np.uint32)
        assert filter_audit.positional_counts(words).tolist() == [int(((words >> np.uint32(k)) & 1).sum()) for k in range(32)]


def test_words_hold_the_subsets_that_a_document_survives():
    for failed in range(32):
        for subset in range(32):
            assert bool(int(filter_audit.WORDS[failed]) >> subset & 1) == (subset & failed == 0)
