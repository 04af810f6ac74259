"""Substring dedup by difference-cover anchors: removes every word that a window
of ``window`` words covers whose word sequence also starts earlier.

Positions of a document are taken modulo ``period``; ``cover`` holds a set of
residues in which every difference occurs. Two equal windows, wherever they
stand, therefore share an offset at which both have a cover position, and the
``period`` - 1 words before the windows' last positions leave
``window - period + 1`` words for a hash there.

1. Short hashes are taken at cover positions only. Those that occur once can't
   be in a repeat.
2. A shared anchor extends to the windows that contain it. Adjacent windows
   form runs, cut where a word's hash says so, hence alike in all copies. A run
   that stands as a whole at an earlier place is settled at once.
3. The windows of the other runs (first copies, and ends of matches) are
   compared one by one over all their words.

Words are told by two independent 64-bit keys (see ``textscan.word_keys``), and
sequences by two hashes over different rings, of 64 bits modulo 2^64 and 61 bits modulo
a prime. Anchors carry 48 bits: a chance meeting there only costs a comparison.

Edge cases: null and empty texts have no words; documents shorter than a window
keep all; a row whose doc_id is null keeps all and takes no part; rows that
repeat a doc_id are one document told several times, a position is no earlier
copy of itself, and a span covered in one of them is removed from each; extra
columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tirepulse.llm import keyed
from tirepulse.llm import textscan as ts
from tirepulse.llm.ship import shipped

# what differs from row to row stands side by side, which the shuffle compresses best
_ROWS = "key long, key2 long, at long, doc_id long, settled boolean"


@dataclass(frozen=True)
class CoverParams:
    window: int = 20
    period: int = 13
    cover: tuple[int, ...] = (0, 1, 3, 9)    # every difference modulo 13 occurs
    run_mask: int = 15                       # a run ends about every 16 words
    run_limit: int = 64


def is_cover(params: CoverParams) -> bool:
    """Whether every difference modulo the period occurs among the cover's residues."""
    return {(a - b) % params.period for a in params.cover for b in params.cover} == set(range(params.period))


class _Words:
    """Words of the documents of one slice, with hashes of any range of them."""

    def __init__(self, data: np.ndarray, cut: np.ndarray):
        self.start, self.end = ts.runs(ts.SOLID_BYTES[data], cut)
        self.first = np.searchsorted(self.start, cut)
        self.count = np.diff(self.first)
        self.hash, self._second = ts.word_keys(data, self.start, self.end)
        self._one = ts.Prefix(self.hash)
        self._two = None

    def key(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        return self._one.of(lo, hi)

    def key2(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        if self._two is None:
            self._two = ts.Ring(self._second)
        return self._two.of(lo, hi)


def _rows(key, key2, doc, at, settled) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(key.view(np.int64)), pa.array(key2.view(np.int64)), pa.array(at), pa.array(doc), pa.array(settled)],
        ["key", "key2", "at", "doc_id", "settled"])


def _anchors(params: CoverParams):
    words = params.window - params.period + 1
    residue = np.zeros(params.period, bool)
    residue[list(params.cover)] = True

    def run(batches):
        for batch in batches:
            doc_ids = keyed.ids(batch.column(0))
            for lo, hi, data, cut in ts.slices(batch.column(1)):
                w = _Words(data, cut)
                own = np.repeat(np.arange(hi - lo), w.count)
                place = np.arange(w.start.size) - w.first[own]
                pick = residue[place % params.period] & (place + words <= w.count[own]) & (w.count[own] >= params.window)
                at = np.flatnonzero(pick)
                key, doc = w.key(at, at + words), doc_ids[lo + own[at]]
                _, index, inverse, count = np.unique(key, return_index=True, return_inverse=True, return_counts=True)
                settled = count[inverse] > 1                   # repeated within the slice
                later = settled & (index[inverse] != np.arange(at.size))
                key = np.where(later, keyed.spread(doc, place[at]), key) & ~np.uint64(0xFFFF)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key.view(np.int64)), pa.array(place[at] << 1 | settled), pa.array(doc)],
                    ["key", "at", "doc_id"])
    return run


def _repeated(batches):
    """(doc_id, at) of anchors whose hash occurs more than once."""
    key, at, doc = keyed.collected(batches, 0, 1, 2)
    order = np.argsort(key)
    key = key[order]
    same = np.zeros(key.size, bool)
    same[1:] = key[1:] == key[:-1]
    same[:-1] |= same[1:]
    keep = order[same | ((at[order] & 1) > 0)]
    yield pa.RecordBatch.from_arrays([pa.array(doc[keep]), pa.array(at[keep] >> 1)], ["doc_id", "at"])


def _listed(batch: pa.RecordBatch, column: int):
    lists = batch.column(column)
    return lists.offsets.to_numpy().astype(np.int64), keyed.ids(lists.values)


def _emit(w: _Words, doc_ids, own, begin, length, window, settled=None):
    """Rows of the runs of windows [begin, begin + length); local copies are settled."""
    if not begin.size:
        return
    doc, at = doc_ids[own], ((begin - w.first[own]) << 16) | length
    stop = begin + length + window - 1
    key, key2 = w.key(begin, stop), w.key2(begin, stop)
    if settled is None:
        settled = keyed.later_ones([key, key2], doc, at)
    yield _rows(np.where(settled, keyed.spread(doc, at), key), np.where(settled, np.uint64(0), key2), doc, at, settled)


def _runs(params: CoverParams):
    """Rows of the runs of windows that contain a repeated anchor."""
    reach = params.period - 1

    def run(batches):
        for batch in batches:
            doc_ids = keyed.ids(batch.column(0))
            bounds, values = _listed(batch, 2)
            for lo, hi, data, cut in ts.slices(batch.column(1)):
                w = _Words(data, cut)
                own = np.repeat(np.arange(hi - lo), np.diff(bounds[lo:hi + 1]))
                at = values[bounds[lo]:bounds[hi]]
                last = w.count[own] - params.window
                fits = (last >= 0) & (at <= w.count[own])      # always so, but for repeated ids
                own, at, last = own[fits], at[fits], last[fits]
                n = w.start.size
                mark = np.zeros(n + 1, np.int64)               # windows [at - reach, at], by their start
                np.add.at(mark, w.first[own] + np.maximum(at - reach, 0), 1)
                np.add.at(mark, w.first[own] + np.minimum(at, last) + 1, -1)
                asked = np.cumsum(mark[:-1]) > 0
                if not asked.any():
                    continue
                head, tail = ts.runs(asked, w.first)
                cuts = np.flatnonzero(asked & ((w.hash & np.uint64(params.run_mask)) == 0))
                edges = np.unique(np.concatenate([head, tail, cuts]))
                begin, length = edges[:-1], np.diff(edges)
                inside = asked[np.minimum(begin, n - 1)]
                begin, length = begin[inside], length[inside]
                parts = -(-length // params.run_limit)         # long stretches without a cut
                step = np.arange(int(parts.sum())) - np.repeat(np.cumsum(parts) - parts, parts)
                begin = np.repeat(begin, parts) + step * params.run_limit
                length = np.minimum(np.repeat(length, parts) - step * params.run_limit, params.run_limit)
                yield from _emit(w, doc_ids[lo:hi], ts.owners(w.first, begin), begin, length, params.window)
    return run


def _verdicts(batches):
    """(doc_id, at, covered) of each run: whether it also stands at an earlier place."""
    table = list(batches)
    key, key2, at, doc = (np.concatenate([keyed.ids(b.column(c)) for b in table]) if table else np.zeros(0, np.int64)
                          for c in range(4))
    settled = np.concatenate([b.column(4).to_numpy(zero_copy_only=False) for b in table]) if table else np.zeros(0, bool)
    covered = settled.astype(bool)
    rest = np.flatnonzero(~covered)
    covered[rest] = keyed.later_ones([key[rest], key2[rest]], doc[rest], at[rest])
    yield pa.RecordBatch.from_arrays([pa.array(doc), pa.array(at), pa.array(covered)], ["doc_id", "at", "covered"])


def _windows(params: CoverParams):
    """Settled rows of covered runs, and a row for each window of the others."""

    def run(batches):
        for batch in batches:
            doc_ids = keyed.ids(batch.column(0))
            bounds, values = _listed(batch, 2)
            for lo, hi, data, cut in ts.slices(batch.column(1)):
                w = _Words(data, cut)
                own = np.repeat(np.arange(hi - lo), np.diff(bounds[lo:hi + 1]))
                packed = values[bounds[lo]:bounds[hi]]
                covered, begin, length = (packed & 1) > 0, packed >> 17, (packed >> 1) & 0xFFFF
                fits = begin + length + params.window - 1 <= w.count[own]
                own, covered, begin, length = own[fits], covered[fits], begin[fits] + w.first[own[fits]], length[fits]
                yield from _emit(w, doc_ids[lo:hi], own[covered], begin[covered], length[covered], params.window,
                                 np.ones(int(covered.sum()), bool))
                own, begin, length = own[~covered], begin[~covered], length[~covered]
                step = np.arange(int(length.sum())) - np.repeat(np.cumsum(length) - length, length)
                begin = np.repeat(begin, length) + step
                yield from _emit(w, doc_ids[lo:hi], np.repeat(own, length), begin, np.ones(begin.size, np.int64), params.window)
    return run


def _kept(window: int):
    def run(batches):
        for batch in batches:
            bounds, values = _listed(batch, 2)
            n_words, n_removed, kept = [], [], []
            for lo, hi, data, cut in ts.slices(batch.column(1)):
                w = _Words(data, cut)
                own = np.repeat(np.arange(hi - lo), np.diff(bounds[lo:hi + 1]))
                packed = values[bounds[lo]:bounds[hi]]
                begin = np.minimum(packed >> 16, w.count[own]) + w.first[own]
                stop = np.minimum((packed >> 16) + (packed & 0xFFFF) + window - 1, w.count[own]) + w.first[own]
                mark = np.zeros(w.start.size + 1, np.int64)
                np.add.at(mark, begin, 1)
                np.add.at(mark, stop, -1)
                stays = np.cumsum(mark[:-1]) == 0
                before = np.concatenate([[0], np.cumsum(stays)])[w.first]
                start, end = w.start[stays], w.end[stays]
                room = end - start + 1                          # one space after each word
                to = np.concatenate([[0], np.cumsum(room)])
                source = np.repeat(start - to[:-1], room) + np.arange(int(to[-1]))
                joined = data[np.minimum(source, max(0, data.size - 1))] if source.size else np.zeros(0, np.uint8)
                joined[to[1:] - 1] = 0x20
                raw = joined.tobytes()
                edge = to[before]
                kept.extend(raw[a:max(a, b - 1)] for a, b in zip(edge[:-1].tolist(), edge[1:].tolist()))
                n_words.append(w.count)
                n_removed.append(w.count - np.diff(before))
            empty = [np.zeros(0, np.int64)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.concatenate(n_words or empty)), pa.array(np.concatenate(n_removed or empty)),
                 pa.array(kept, pa.binary())], ["doc_id", "n_words", "n_removed", "kept"])
    return run


def remove_repeats(docs: DataFrame, params: CoverParams = CoverParams()) -> DataFrame:
    """doc_id, n_words, n_removed and kept (the remaining words joined by one
    space, UTF-8) of every row of ``docs``."""
    if not is_cover(params):
        raise ValueError("cover lacks a difference modulo the period")
    shipped(docs.sparkSession)
    texts = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    placed = texts.filter("doc_id IS NOT NULL")        # one shuffle by doc_id serves the joins below
    anchors = placed.mapInArrow(ts.released(_anchors(params)), "key long, at long, doc_id long")
    repeated = anchors.repartition("key").mapInArrow(ts.released(_repeated), "doc_id long, at long")
    lists = repeated.groupBy("doc_id").agg(F.collect_list("at").alias("ats"))
    runs = placed.join(lists, "doc_id").select("doc_id", "text", "ats").mapInArrow(ts.released(_runs(params)), _ROWS)
    verdicts = runs.repartition("key").mapInArrow(ts.released(_verdicts), "doc_id long, at long, covered boolean")
    judged = (verdicts.select("doc_id", (F.col("at") * 2 + F.col("covered").cast("long")).alias("at"))
              .groupBy("doc_id").agg(F.collect_list("at").alias("ats")))
    windows = placed.join(judged, "doc_id").select("doc_id", "text", "ats").mapInArrow(ts.released(_windows(params)), _ROWS)
    covered = (windows.repartition("key").mapInArrow(ts.released(_verdicts), "doc_id long, at long, covered boolean")
               .filter("covered").groupBy("doc_id").agg(F.collect_list("at").alias("ats")))
    none = F.array().cast("array<bigint>")
    ready = placed.join(covered, "doc_id", "left").select("doc_id", "text", F.coalesce("ats", none).alias("ats"))
    unplaced = texts.filter("doc_id IS NULL").select("doc_id", "text", none.alias("ats"))
    return ready.union(unplaced).mapInArrow(ts.released(_kept(params.window)), "doc_id long, n_words long, n_removed long, kept binary")
