"""Suffix-array dedup: removes every byte that a ``window``-byte string covers
whose content also starts earlier in the corpus.

Sorting all suffixes would ship the corpus a hundred times. The suffix array is
sparse instead: suffixes start at content-defined positions only. Each window
elects the position inside it whose ``lead`` bytes have the smallest hash (the
leftmost of equals). The election depends on the window's bytes alone, so equal
windows elect the same offset, and about one position in forty is elected.

1. ``_elect`` finds the elected positions; positions whose leading bytes hash
   differently from all others can't be in a repeat and go no further.
2. The suffixes that remain, with the bytes before them, are range-partitioned
   by their leading bytes with sampled splitters (``repartitionByRange``).
   Equal leading bytes never part, so no equal pair straddles a boundary.
3. Each bucket sorts its suffixes, and the reversed text before them, by
   multikey quicksort over 8-byte symbols. Neighbouring lengths in common turn
   "the same o bytes before and window - o bytes after" into a pair of class
   numbers. The earliest start of each class stays, the others are covered.
4. Leading bytes that more than ``bucket_rows`` suffixes share aren't sorted in
   one bucket: at the edges of a passage that a third of all documents share,
   each document has a suffix of its own, as the windows that start before the
   passage (or end behind it) elect positions inside it. ``heavy_leads`` counts
   a sample of the elected positions. Suffixes with such leading bytes are
   dealt by a 128-bit hash of their whole context; of equal ones the earliest
   goes on as single windows, merged in a task and dealt by their 128-bit hash.
   Equal windows have equal leading bytes, so both ways give the same spans and
   the sample decides where rows are compared, not what is found.

Equal texts are found first by their digest: the copy with the smallest doc_id
stands for all. Suffixes of one slice with equal contexts are merged before
they are sent, so the inside of a shared passage sends a row a slice, not a row
a document, to the task that compares it.

Edge cases: null counts as empty text; a row whose doc_id is null is returned
whole and takes no part, having no place in the order; rows that repeat a
doc_id are one document told several times: the same position is no earlier
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
from tirepulse.llm.keyed import collected, spread
from tirepulse.llm.keyed import ids as _ids
from tirepulse.llm.ship import shipped

_LOCAL = 24                                  # bits of a position inside a block
_BLOCK = 1 << 22                             # window starts handled at once
_KNOWN = 0x80
_KEY = 16                                    # leading bytes that suffixes are dealt by
_HEAVY = 1 << 20                             # most leads that are sent to all tasks
_EXPLODE = 1 << 13                           # suffixes told as single windows at once
_SUFFIX, _DONE, _WHOLE = 0, 1, 2             # kinds of rows that leave _suffix_rows


@dataclass(frozen=True)
class SuffixParams:
    window: int = 100
    lead: int = 24
    bucket_rows: int = 1 << 15               # suffixes sorted at once in a bucket


# ---------------------------------------------------------------- electing suffixes

def _elect(data: np.ndarray, cut: np.ndarray, window: int, lead: int):
    """(elected position, nearest and farthest window start before it, hash of its leading bytes)."""
    out = []
    n = data.size
    stay = np.uint64(((1 << 64) - 1) ^ ((1 << _LOCAL) - 1))
    width = window - lead + 1
    for lo in range(0, max(0, n - window + 1), _BLOCK):
        block = data[lo:min(n, lo + _BLOCK + window - 1)]
        at = np.arange(block.size - lead + 1)
        h = ts.Prefix(ts._VALUES[1][block]).of(at, at + lead)
        v = (h & stay) | at.astype(np.uint64)
        size = 1
        while size * 2 <= width:
            v = np.minimum(v[:-size], v[size:])
            size *= 2
        if size < width:
            v = np.minimum(v[:-(width - size)], v[width - size:])
        chosen = (v & ~stay).astype(np.int64)          # for each window start of the block
        starts = np.arange(chosen.size) + lo
        doc_end = cut[np.searchsorted(cut, starts, side="right")]
        inside = starts + window <= doc_end
        fresh = np.empty(chosen.size, bool)
        fresh[0] = True
        fresh[1:] = (chosen[1:] != chosen[:-1]) | ~inside[:-1]
        first = np.flatnonzero(inside & fresh)
        last = np.empty(chosen.size, bool)
        last[-1] = True
        last[:-1] = fresh[1:] | ~inside[1:]
        end = np.flatnonzero(inside & last)
        out.append((chosen[first] + lo, first + lo, end + lo, h[chosen[first]]))
    if not out:
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),)
    return tuple(np.concatenate(x) for x in zip(*out))


def _pack(position: np.ndarray, least: np.ndarray, most: np.ndarray) -> np.ndarray:
    """Position in the document with the least and most bytes before it that its windows use."""
    return (position << 16) | (most << 8) | least


def _unpack(at: np.ndarray):
    return at >> 16, at & 0x7F, (at >> 8) & 0xFF


def _sampled_leads(params: SuffixParams, rate: int):
    """Hash of the leading bytes of one elected position in ``rate``."""
    size = min(_KEY, params.lead)

    def run(batches):
        for batch in batches:
            ids = _ids(batch.column(0))
            for lo, hi, data, cut in ts.slices(batch.column(1)):
                at = _elect(data, cut, params.window, params.lead)[0]
                doc = ts.owners(cut, at)
                at = at[spread(ids[lo + doc], at - cut[doc]) % np.uint64(rate) == 0]
                h = ts.Prefix(ts._VALUES[1][data]).of(at, at + size)
                yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64))], ["key"])
    return run


def heavy_leads(placed: DataFrame, params: SuffixParams) -> np.ndarray:
    """Sorted hashes of the leading bytes that more than about ``bucket_rows`` elected
    positions share (the most frequent 2^20 of them; the others stay in their buckets)."""
    rate = max(1, params.bucket_rows >> 9)
    counts = (placed.select("doc_id", "text").mapInArrow(ts.released(_sampled_leads(params, rate)), "key long")
              .groupBy("key").count().filter(F.col("count") * rate > params.bucket_rows))
    top = counts.orderBy(F.desc("count"), "key").limit(_HEAVY).select("key").collect()
    return np.sort(np.array([r["key"] for r in top], np.int64).view(np.uint64))


def _elected_rows(params: SuffixParams):
    def run(batches):
        for batch in batches:
            ids = _ids(batch.column(0))
            for lo, hi, data, cut in ts.slices(batch.column(1)):
                at, near, far, h = _elect(data, cut, params.window, params.lead)
                doc = ts.owners(cut, at)
                packed = _pack(at - cut[doc], at - far, at - near)
                # one row of each hash goes to the hash's task; its local repeats are known already
                _, index, inverse, count = np.unique(h, return_index=True, return_inverse=True, return_counts=True)
                known = count[inverse] > 1
                later = known & (index[inverse] != np.arange(h.size))
                key = np.where(later, spread(ids[lo + doc], packed), h)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key.view(np.int64)), pa.array(ids[lo + doc]),
                     pa.array(packed | np.where(known, _KNOWN, 0))], ["key", "doc_id", "at"])
    return run


def _repeated_rows(batches):
    """Rows whose key another row has too, or that are known to be repeated."""
    key, doc, at = collected(batches, 0, 1, 2)
    order = np.argsort(key)
    key = key[order]
    same = np.zeros(key.size, bool)
    same[1:] = key[1:] == key[:-1]
    same[:-1] |= same[1:]
    keep = order[same | ((at[order] & _KNOWN) > 0)]
    yield pa.RecordBatch.from_arrays([pa.array(doc[keep]), pa.array(at[keep] & ~_KNOWN)], ["doc_id", "at"])


# ---------------------------------------------------------------- suffixes with what stands before them

def _digests(rows: np.ndarray, row: np.ndarray, start: np.ndarray, size: int) -> list[np.ndarray]:
    """Two 64-bit hashes of ``size`` bytes from a place of a row of a byte matrix."""
    flat = np.ascontiguousarray(rows).reshape(-1)
    at = row * rows.shape[1] + start
    return [ts.Prefix(ts._VALUES[seed][flat]).of(at, at + size) for seed in (1, 2)]


def _suffix_rows(params: SuffixParams, heavy: np.ndarray):
    window, before = params.window, params.window - params.lead

    def run(batches):
        for batch in batches:
            ids = _ids(batch.column(0))
            lists = batch.column(2)
            bounds = lists.offsets.to_numpy().astype(np.int64)
            values = _ids(lists.values)
            for lo, hi, data, cut in ts.slices(batch.column(1)):
                at = values[bounds[lo]:bounds[hi]]
                doc = np.repeat(np.arange(hi - lo), np.diff(bounds[lo:hi + 1]))
                position, least, most = _unpack(at)
                fits = position - least + window <= np.diff(cut)[doc]      # always so, but for repeated ids
                order = np.lexsort((position, ids[lo + doc]))
                order = order[fits[order]]
                doc, position, least, most = doc[order], position[order], least[order], most[order]
                if not order.size:
                    continue
                step = np.arange(-before, window)
                source = (cut[doc] + position)[:, None] + step
                rows = data[np.clip(source, 0, data.size - 1)]
                rows[(step < -most[:, None]) | (step >= window - least[:, None])] = 0
                tagged = np.concatenate([rows, (least[:, None] + 1).astype(np.uint8),
                                         (most[:, None] + 1).astype(np.uint8)], axis=1)
                keys = tagged.view(f"S{tagged.shape[1]}").reshape(-1)
                _, index, inverse = np.unique(keys, return_index=True, return_inverse=True)
                first, own = index[inverse], ids[lo + doc]
                later = (own != own[first]) | (position != position[first])    # a place is no copy of itself
                flat = np.ascontiguousarray(rows)
                noise = spread(ids[lo + doc], position)
                # local copies are covered already: they only pass through, spread over all buckets
                contexts = pa.FixedSizeBinaryArray.from_buffers(
                    pa.binary(flat.shape[1]), flat.shape[0], [None, pa.py_buffer(flat)]).cast(pa.binary())
                anywhere = pa.FixedSizeBinaryArray.from_buffers(
                    pa.binary(8), noise.size, [None, pa.py_buffer(noise)]).cast(pa.binary())
                leads = pa.FixedSizeBinaryArray.from_buffers(
                    pa.binary(16), flat.shape[0],
                    [None, pa.py_buffer(np.ascontiguousarray(flat[:, before:before + _KEY]))]).cast(pa.binary())
                whole, digests = np.zeros(position.size, bool), leads
                if heavy.size:
                    at = cut[doc] + position
                    h = ts.Prefix(ts._VALUES[1][data]).of(at, at + min(_KEY, params.lead))
                    whole = ~later & (heavy[np.minimum(np.searchsorted(heavy, h), heavy.size - 1)] == h)
                    both = np.zeros((position.size, 2), np.uint64)
                    row = np.arange(int(whole.sum()))
                    both[whole] = np.stack(_digests(tagged[whole], row, np.zeros(row.size, np.int64), tagged.shape[1]), axis=1)
                    digests = pa.FixedSizeBinaryArray.from_buffers(
                        pa.binary(16), position.size, [None, pa.py_buffer(both)]).cast(pa.binary())
                for pick, lead, context, kind in ((~later & ~whole, leads, contexts, _SUFFIX), (later, anywhere, None, _DONE),
                                                  (whole, digests, contexts, _WHOLE)):
                    if not pick.any():
                        continue
                    mask = pa.array(pick)
                    n = int(pick.sum())
                    yield pa.RecordBatch.from_arrays(
                        [lead.filter(mask), context.filter(mask) if context is not None else pa.nulls(n, pa.binary()),
                         pa.array(ids[lo + doc[pick]]),
                         pa.array(_pack(position[pick], least[pick], most[pick])),
                         pa.array(np.full(n, kind, np.int8))], ["lead", "context", "doc_id", "at", "kind"])
    return run


# ---------------------------------------------------------------- sorting buckets

def _symbols(rows: np.ndarray) -> np.ndarray:
    """Rows of bytes as rows of big-endian 8-byte symbols."""
    padded = np.zeros((rows.shape[0], -(-rows.shape[1] // 8) * 8), np.uint8)
    padded[:, :rows.shape[1]] = rows
    return padded.view(">u8").astype(np.uint64)


def multikey_sort(rows: np.ndarray) -> np.ndarray:
    """Order of the rows of a byte matrix: quicksort by one symbol at a time,
    where only rows that are equal so far go on to the next symbol."""
    symbols = _symbols(rows)
    order = np.arange(rows.shape[0])
    group = np.zeros(order.size, np.int64)            # number of each place's class of equals
    tied = np.arange(order.size)
    for depth in range(symbols.shape[1]):
        own = order[tied]
        key = symbols[own, depth]
        sub = np.lexsort((key, group[tied]))
        order[tied] = own[sub]
        key, label = key[sub], group[tied]
        differs = np.ones(tied.size, bool)
        differs[1:] = (key[1:] != key[:-1]) | (label[1:] != label[:-1])
        group[tied] = tied[np.maximum.accumulate(np.where(differs, np.arange(tied.size), 0))]
        alone = differs.copy()
        alone[:-1] &= differs[1:]
        tied = tied[~alone]
        if not tied.size:
            break
    return order


def _common(rows: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Length in common of each sorted row with the one before it (0 for the first)."""
    out = np.zeros(order.size, np.int64)
    for k in range(1, order.size, 1 << 14):
        stop = min(order.size, k + (1 << 14))
        differs = rows[order[k:stop]] != rows[order[k - 1:stop - 1]]
        out[k:stop] = np.where(differs.any(axis=1), differs.argmax(axis=1), rows.shape[1])
    return out


def _classes(common: np.ndarray, order: np.ndarray, length: int) -> np.ndarray:
    """Number of the class of each row under equality of its first ``length`` bytes."""
    out = np.empty(order.size, np.int64)
    out[order] = np.cumsum(common < length)
    return out


def covered(rows: np.ndarray, least: np.ndarray, most: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Smallest and largest offset of a covered window of each suffix (large, -1: none).

    ``rows`` come in the order of their places; offset o is the window of the o
    bytes before the suffix and its first window - o bytes.
    """
    before = rows.shape[1] - window
    after, ahead = rows[:, before:], np.ascontiguousarray(rows[:, :before][:, ::-1])
    by_suffix, by_prefix = multikey_sort(after), multikey_sort(ahead)
    lcp, lcs = _common(after, by_suffix), _common(ahead, by_prefix)
    low, high = np.full(least.size, window), np.full(least.size, -1)
    for o in range(int(least.min()), int(most.max()) + 1):
        active = np.flatnonzero((least <= o) & (o <= most))
        if active.size < 2:
            continue
        right = _classes(lcp, by_suffix, window - o)[active]
        left = _classes(lcs, by_prefix, o)[active]
        both = right * (least.size + 1) + left
        order = np.argsort(both, kind="stable")       # keeps the order of places in a class
        again = np.zeros(active.size, bool)
        again[1:] = both[order[1:]] == both[order[:-1]]
        hit = active[order[again]]
        low[hit] = np.minimum(low[hit], o)
        high[hit] = o
    return low, high


def _contexts(column: pa.Array) -> np.ndarray:
    """A binary column of equal lengths as a byte matrix."""
    raw, cut = column.buffers()[2], np.frombuffer(column.buffers()[1], np.int32)[column.offset:]
    n = len(column)
    return np.frombuffer(raw, np.uint8)[cut[0]:cut[n]].reshape(n, -1)


def _spans(params: SuffixParams):
    """Covered spans, and the windows that are still open: those of suffixes that came whole."""
    window = params.window

    def rows_of(doc, start, end, keys=None):
        settled = np.ones(doc.size, bool) if keys is None else keyed.later_ones(keys, doc, start)
        key, key2 = keys or (np.zeros(doc.size, np.uint64),) * 2
        return pa.RecordBatch.from_arrays(
            [pa.array(np.where(settled, spread(doc, start), key).view(np.int64)),
             pa.array(np.where(settled, np.uint64(0), key2).view(np.int64)),
             pa.array(doc), pa.array(start), pa.array(end), pa.array(settled)],
            ["key", "key2", "doc_id", "start", "end", "settled"])

    def emit(doc, position, low, high):
        return rows_of(doc, position - high, position - low + window)

    def firsts(rows, doc, at):
        """Spans of all but the earliest of equal contexts, and the earliest ones."""
        row = np.arange(doc.size)
        _, least, most = _unpack(at)
        keys = _digests(rows, row, np.zeros(doc.size, np.int64), rows.shape[1])
        later = keyed.later_ones([*keys, (least << 8 | most).astype(np.uint64)], doc, at)
        position, least, most = _unpack(at[later])
        return emit(doc[later], position, least, most), (rows[~later], doc[~later], at[~later])

    def windows(rows, doc, at):
        position, least, most = _unpack(at)
        n = most - least + 1
        row = np.repeat(np.arange(doc.size), n)
        offset = np.arange(row.size) - np.repeat(np.cumsum(n) - n - least, n)
        start = position[row] - offset
        return rows_of(doc[row], start, start + window, _digests(rows, row, rows.shape[1] - window - offset, window))

    def run(batches):
        parts, open_, held, limit = [], [], 0, params.bucket_rows
        for batch in batches:
            kind = batch.column(4).to_numpy(zero_copy_only=False)
            doc, at = _ids(batch.column(2)), _ids(batch.column(3))
            done = kind == _DONE
            if done.any():
                position, least, most = _unpack(at[done])
                yield emit(doc[done], position, least, most)
            for code, to in ((_SUFFIX, parts), (_WHOLE, open_)):
                pick = kind == code
                if pick.any():
                    to.append((_contexts(batch.column(1).filter(pa.array(pick))), doc[pick], at[pick]))
                    held += int(pick.sum()) if code == _WHOLE else 0
            if held > limit:                          # only the earliest of equal contexts are held
                spans, rest = firsts(*(np.concatenate(x) for x in zip(*open_)))
                yield spans
                open_, held = [rest], rest[1].size
                limit = max(params.bucket_rows, 2 * held)
        if open_:
            spans, rest = firsts(*(np.concatenate(x) for x in zip(*open_)))
            yield spans
            open_.clear()
            for k in range(0, rest[1].size, _EXPLODE):
                yield windows(*(x[k:k + _EXPLODE] for x in rest))
            del spans, rest
        if not parts:
            return
        rows, doc, at = (np.concatenate(x) for x in zip(*parts))
        parts.clear()
        lead = _symbols(rows[:, window - params.lead:][:, :16])
        order = np.lexsort((at, doc, lead[:, 1], lead[:, 0]))
        lead = lead[order]
        heads = np.flatnonzero(np.r_[True, (lead[1:] != lead[:-1]).any(axis=1)])
        ends = np.r_[heads[1:], order.size]
        start = 0
        while start < heads.size:                     # whole classes of equal leading bytes at a time
            stop = max(start + 1, int(np.searchsorted(ends, heads[start] + params.bucket_rows, side="right")))
            some = order[heads[start]:ends[stop - 1]]
            start = stop
            some = some[np.lexsort((at[some], doc[some]))]
            twin = np.zeros(some.size, bool)          # rows that repeat a doc_id
            twin[1:] = (doc[some[1:]] == doc[some[:-1]]) & (at[some[1:]] == at[some[:-1]]) \
                & (rows[some[1:]] == rows[some[:-1]]).all(axis=1)
            some = some[~twin]
            position, least, most = _unpack(at[some])
            low, high = covered(rows[some], least, most, window)
            hit = high >= 0
            if hit.any():
                yield emit(doc[some[hit]], position[hit], low[hit], high[hit])
    return run


def _verdicts(batches):
    """The settled spans, and those of open windows that also stand at an earlier place."""
    table = list(batches)
    if not table:
        return
    key, key2, doc, start, end = (np.concatenate([_ids(b.column(c)) for b in table]) for c in range(5))
    covered = np.concatenate([b.column(5).to_numpy(zero_copy_only=False) for b in table]).astype(bool)
    rest = np.flatnonzero(~covered)
    covered[rest] = keyed.later_ones([key[rest], key2[rest]], doc[rest], start[rest])
    yield pa.RecordBatch.from_arrays([pa.array(x[covered]) for x in (doc, start, end)], ["doc_id", "start", "end"])


# ---------------------------------------------------------------- removing

def merge_spans(start: np.ndarray, end: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs covered by the spans, clipped to ``size``."""
    order = np.argsort(start, kind="stable")
    start, end = start[order], np.minimum(end[order], size)
    start, end = start[start < end], end[start < end]
    if not start.size:
        return start, end
    reach = np.maximum.accumulate(end)
    fresh = np.r_[True, start[1:] > reach[:-1]]
    return start[fresh], np.r_[reach[:-1][fresh[1:]], reach[-1]]


def _removed(window: int):
    def run(batches):
        for batch in batches:
            copies = batch.column(2).to_numpy(zero_copy_only=False).astype(bool)
            spans = batch.column(3)
            bounds = spans.offsets.to_numpy().astype(np.int64)
            starts, ends = (_ids(spans.values.field(k)) for k in (0, 1))
            raw, cut = ts.utf8(batch.column(1))
            kept, counts = [], []
            for k in range(batch.num_rows):
                text = raw[cut[k]:cut[k + 1]]
                if copies[k] and text.size >= window:
                    s, e = np.zeros(1, np.int64), np.full(1, text.size)
                elif copies[k]:
                    s = e = np.zeros(0, np.int64)
                else:
                    s, e = merge_spans(starts[bounds[k]:bounds[k + 1]], ends[bounds[k]:bounds[k + 1]], text.size)
                pieces = zip(np.r_[0, e].tolist(), np.r_[s, text.size].tolist())
                kept.append(b"".join(text[a:b].tobytes() for a, b in pieces))
                counts.append((text.size, int((e - s).sum()), s.size))
            n_bytes, n_removed, n_spans = (np.array(c, np.int64) for c in zip(*counts)) if counts else (np.zeros(0, np.int64),) * 3
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n_bytes), pa.array(n_removed), pa.array(n_spans), pa.array(kept, pa.binary()),
                 batch.column(4)], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept", "row"])
    return run


def remove_repeats(docs: DataFrame, params: SuffixParams = SuffixParams(), carry: list[str] | None = None) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept (the remaining bytes) of every row
    of ``docs``, and the columns named in ``carry`` as fields of ``row``."""
    shipped(docs.sparkSession)
    texts = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
                        F.struct(*[F.col(c) for c in carry or []], F.lit(None).cast("boolean").alias("_")).alias("row"))
    placed = texts.filter("doc_id IS NOT NULL")       # one shuffle by doc_id serves both joins below
    firsts = (placed.groupBy(F.sha2("text", 256).alias("digest"))
              .agg(F.min("doc_id").alias("doc_id")).select("doc_id").distinct())
    elected = placed.select("doc_id", "text").mapInArrow(ts.released(_elected_rows(params)), "key long, doc_id long, at long")
    repeated = elected.repartition("key").mapInArrow(ts.released(_repeated_rows), "doc_id long, at long")
    lists = (repeated.groupBy("doc_id").agg(F.collect_list("at").alias("ats"))
             .join(firsts, "doc_id", "left_semi"))    # a copy of an earlier text is covered already
    heavy = heavy_leads(placed, params)
    suffixes = (placed.join(lists, "doc_id").select("doc_id", "text", "ats", "row")
                .mapInArrow(ts.released(_suffix_rows(params, heavy)), "lead binary, context binary, doc_id long, at long, kind byte"))
    found = suffixes.repartitionByRange("lead").mapInArrow(
        ts.released(_spans(params)), "key long, key2 long, doc_id long, start long, end long, settled boolean")
    if heavy.size:
        found = found.repartition("key").mapInArrow(ts.released(_verdicts), "doc_id long, start long, end long")
    spans = found.groupBy("doc_id").agg(F.collect_list(F.struct("start", "end")).alias("spans"))
    none = F.array().cast("array<struct<start:bigint,end:bigint>>")
    ready = (placed.join(firsts.withColumn("first", F.lit(True)), "doc_id", "left").join(spans, "doc_id", "left")
             .select("doc_id", "text", F.col("first").isNull().alias("copy"), F.coalesce("spans", none).alias("spans"), "row"))
    unplaced = (texts.filter("doc_id IS NULL")
                .select("doc_id", "text", F.lit(False).alias("copy"), none.alias("spans"), "row"))
    schema = f"doc_id long, n_bytes long, n_removed long, n_spans long, kept binary, row {texts.schema['row'].dataType.simpleString()}"
    return ready.union(unplaced).mapInArrow(ts.released(_removed(params.window)), schema)


def keep_first_text(docs: DataFrame, params: SuffixParams = SuffixParams()) -> DataFrame:
    """``docs`` with repeated passages cut out of ``text`` and ``n_chars`` recounted.

    A character that a cut leaves incomplete goes too. Rows of which nothing is
    left stay, with an empty text, as do rows with a null text.
    """
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    kept = remove_repeats(docs, params, others)
    raw = F.col("kept").cast("string")
    text = F.coalesce(F.try_validate_utf8(raw), F.regexp_replace(F.make_valid_utf8(raw), "\uFFFD", ""))
    out = kept.select("doc_id", text.alias("text"), *[F.col("row")[c].alias(c) for c in others])
    if "n_chars" in others:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)
