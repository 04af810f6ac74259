"""Order-preserving packing of documents into training sequences.

Documents are tokenised in stored order, each closed by one id, and laid end to
end. Window cuts are chosen by dynamic programming over the ends of documents
and sentences: a window costs its padding, and a cut inside a document costs a
truncation penalty. The cheapest predecessor within reach of a cut is kept in a
monotone queue, so each candidate is handled once. Sentences longer than
``stride`` ids get candidates at every ``stride`` ids, at a higher penalty.

Each input partition packs its own documents, with no shuffle: a partition
costs at most one padded window more, and its last window is cut into unpadded powers
of two where that is cheaper. Within a partition the stream is handled
in blocks; the last windows of a block are left open and decided with the next
one, so memory stays bounded by the block and the longest document.

Edge cases: null counts as empty text; a text without tokens is its closing id
alone; a null doc_id stays null; repeated rows are packed one by one; extra
columns are ignored; an empty table gives no pieces.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from tirepulse.llm import textscan as ts
from tirepulse.llm.ship import shipped
from tirepulse.llm.tokens import PieceEncoder, default_tokenizer

SCHEMA = ("doc_id long, start long, length long, ids binary, doc_tokens long, "
          "sequence_id long, offset long, padding long")


@dataclass(frozen=True)
class PackingParams:
    size: int = 2048
    last_id: int = 1
    tokenizer: str | None = None        # path of the vocabulary file; None: the public word-level one
    sentence_penalty: int = 6
    word_penalty: int = 20
    stride: int = 32
    block_ids: int = 1 << 18


def candidates(stop: int, documents: np.ndarray, sentences: np.ndarray, params: PackingParams):
    """Sorted positions at which a window may end, 0 first, and the penalty of each.

    All document and sentence ends; every ``stride`` ids between two that are further apart.
    """
    worth = np.full(stop + 1, params.word_penalty, np.int32)
    worth[sentences] = params.sentence_penalty
    worth[documents] = 0
    chosen = np.zeros(stop + 1, bool)
    chosen[sentences] = chosen[documents] = True
    chosen[[0, stop]] = True
    marks = np.flatnonzero(chosen)
    inner = (np.diff(marks) - 1) // params.stride
    step = np.arange(int(inner.sum())) - np.repeat(np.cumsum(inner) - inner, inner) + 1
    chosen[np.repeat(marks[:-1], inner) + step * params.stride] = True
    ends = np.flatnonzero(chosen)
    penalty = worth[ends]
    return ends, penalty


def window_cuts(ends: np.ndarray, penalty: np.ndarray, size: int) -> list[int]:
    """Positions of the cheapest cuts, the last end included.

    cost(j) = penalty(j) + size - end(j) + min of cost(i) + end(i) over the
    candidates i at most ``size`` ids before j.
    """
    at, fine = ends.tolist(), (penalty + size).tolist()
    back = [0] * len(at)
    # the queue: index, position and cost + end of the candidates from head to tail
    which, where, value, head, tail = [0] * len(at), [0] * len(at), [0] * len(at), 0, 0
    for j in range(1, len(at)):
        end = at[j]
        while where[head] < end - size:
            head += 1
        back[j] = which[head]
        v = value[head] + fine[j]                     # cost(j) + end(j)
        while tail >= head and value[tail] >= v:
            tail -= 1
        tail += 1
        which[tail], where[tail], value[tail] = j, end, v
    cuts, j = [], len(at) - 1
    while j > 0:
        cuts.append(at[j])
        j = back[j]
    return cuts[::-1]


class _Packer:
    """Packs the stream of one partition; positions count from the partition's first id."""

    def __init__(self, params: PackingParams, partition: int):
        self.params, self.next_sequence = params, partition << 32
        self.base, self.stop = 0, 0                   # first id still open, end of the stream
        self.ids: list[np.ndarray] = []
        self.sentences: list[np.ndarray] = []
        self.doc_ids: list = []
        self.doc_start: list[np.ndarray] = []
        self.doc_stop: list[np.ndarray] = []

    def add(self, doc_ids: list, ids: np.ndarray, bounds: np.ndarray, sentences: np.ndarray) -> None:
        self.ids.append(ids)
        self.sentences.append(sentences + self.stop)
        self.doc_ids.extend(doc_ids)
        self.doc_start.append(bounds[:-1] + self.stop)
        self.doc_stop.append(bounds[1:] + self.stop)
        self.stop += ids.size

    def flush(self, last: bool) -> pa.RecordBatch | None:
        """Pieces of the windows that are decided: all of them at the end of the partition."""
        size = self.params.size
        if self.stop == self.base or not last and self.stop - self.base < self.params.block_ids:
            return None
        ids, sentences = np.concatenate(self.ids), np.concatenate(self.sentences)
        starts, stops = np.concatenate(self.doc_start), np.concatenate(self.doc_stop)
        base = self.base
        ends, penalty = candidates(self.stop - base, stops[stops > base] - base, sentences[sentences > base] - base, self.params)
        cuts = np.array(window_cuts(ends, penalty, size)) + base
        if last:
            cuts = np.concatenate([cuts[:-1], self._tail(int(cuts[-2]) if cuts.size > 1 else base)])
        else:
            cuts = cuts[cuts <= self.stop - 8 * size]
        done = int(cuts[-1])
        edges = np.unique(np.concatenate([[base], cuts, stops[(stops > base) & (stops < done)]]))
        begin, end = edges[:-1], edges[1:]
        doc = np.searchsorted(stops, begin, side="right")
        sequence = np.searchsorted(cuts, begin, side="right")
        sequence_start = np.concatenate([[base], cuts])[sequence]
        used = cuts - np.concatenate([[base], cuts[:-1]])
        padding = np.where(used & (used - 1) == 0, 0, size - used)
        raw = ids.astype("<u4").tobytes()
        out = pa.RecordBatch.from_arrays([
            pa.array([self.doc_ids[k] for k in doc.tolist()], pa.int64()), pa.array(begin - starts[doc]),
            pa.array(end - begin),
            pa.array([raw[4 * (a - base):4 * (b - base)] for a, b in zip(begin.tolist(), end.tolist())], pa.binary()),
            pa.array(stops[doc] - starts[doc]), pa.array(sequence + self.next_sequence),
            pa.array(begin - sequence_start), pa.array(padding[sequence])],
            ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset", "padding"])
        self.next_sequence += cuts.size
        keep = int(np.searchsorted(stops, done, side="right"))
        self.ids, self.sentences = [ids[done - base:]], [sentences[sentences > done]]
        self.doc_ids, self.doc_start, self.doc_stop = self.doc_ids[keep:], [starts[keep:]], [stops[keep:]]
        self.base = done
        return out

    def _tail(self, start: int) -> np.ndarray:
        """Cuts of the last window: whole and padded, or in unpadded powers of two if that costs less."""
        used = self.stop - start
        powers = [1 << k for k in range(used.bit_length() - 1, -1, -1) if used >> k & 1]
        if (len(powers) - 1) * self.params.word_penalty < self.params.size - used:
            return start + np.cumsum(powers)
        return np.array([self.stop])


_ENCODERS: dict[str, PieceEncoder] = {}              # one per worker process


def pack(docs: DataFrame, params: PackingParams = PackingParams()) -> DataFrame:
    """Pieces of documents: doc_id, start, length, ids (little-endian 32-bit),
    doc_tokens, sequence_id, offset in the sequence, and the sequence's padding."""

    def run(batches):
        path = params.tokenizer or default_tokenizer()
        encoder = _ENCODERS.setdefault(path, None) or PieceEncoder(path)
        _ENCODERS[path] = encoder
        packer = _Packer(params, TaskContext.get().partitionId())
        for batch in batches:
            doc_ids = batch.column(0).to_pylist()
            for lo, hi, data, cut in ts.slices(batch.column(1), ts.SLICE_BYTES // 4):
                packer.add(doc_ids[lo:hi], *encoder.encode(data, cut, params.last_id))
                if (out := packer.flush(last=False)) is not None:
                    yield out
        if (out := packer.flush(last=True)) is not None:
            yield out

    shipped(docs.sparkSession)
    return docs.selectExpr("CAST(doc_id AS BIGINT) AS doc_id", "CAST(text AS STRING) AS text").mapInArrow(ts.released(run), SCHEMA)
