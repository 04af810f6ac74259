"""SimHash near-duplicates: 64-bit fingerprints linked at a small Hamming
distance, found exactly with vantage-point trees.

1. Fingerprints are computed in Arrow batches; equal ones are one node.
2. The upper levels of one vantage-point tree are grown from a bounded sample
   of fingerprints. Each leaf is a shard. Every fingerprint is stored in the
   one shard where it falls. One that lies inside a vantage point's radius by
   less than ``max_bits`` is also sent outside as a query, and from there to
   every shard that its ball of ``max_bits`` reaches: a branch is left out only
   where the triangle inequality excludes it. Of two close fingerprints that a
   radius parts, the inner one is always sent, so one side's queries suffice.
3. Each shard grows its own vantage-point tree, compares its fingerprints and
   answers its queries. What it has found is reduced to a spanning forest
   before it leaves the task.
4. Components of the links come from alternating star steps.

Fingerprints of unlike texts are spread like random ones, whose distances to
any point crowd around 32: each level sends on about two in five queries. So
shards grow with the table (from ``shard_rows`` to ``full_shard_rows``), which
keeps the upper tree low.

Edge cases: a null or empty text or one without words has the fingerprint zero
and links like any other; a document of fewer words than a shingle is one
shingle; all words of a very long text count; repeated rows and equal texts
share a node, each row is returned; a row whose doc_id is null is returned with
its fingerprint, gives no component its name and gets the smallest doc_id that
it reaches, or null; extra columns are ignored; an empty table gives an empty
result.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tirepulse.llm import textscan as ts
from tirepulse.llm.components import component_roots
from tirepulse.llm.ship import shipped
from tirepulse.llm.store import written


@dataclass(frozen=True)
class SimHashParams:
    shingle_words: int = 3
    max_bits: int = 2
    seed: int = 42
    shard_rows: int = 4096          # distinct fingerprints a shard should hold at least,
    full_shard_rows: int = 131072   # and at most; between them, a table has this many shards:
    shards: int = 256
    sample_per_shard: int = 32      # fingerprints a shard from which the upper tree is grown
    max_depth: int = 20             # the driver holds 2**20 vantage points at most; then shards grow on
    leaf_rows: int = 96             # leaf size of the trees inside shards


# ---------------------------------------------------------------- fingerprints

def _joined_words(data: np.ndarray, cut: np.ndarray):
    """Lower-cased words with one space after each: bytes, starts, ends, first word of each document."""
    start, end = ts.runs(ts.SOLID_BYTES[data], cut)
    if start.size == 0:
        return b"", start, end, np.zeros(cut.size, np.int64)
    room = end - start + 1
    to = np.cumsum(room) - room
    source = np.repeat(start - to, room) + np.arange(int(room.sum()))
    joined = ts.LOWER[data[np.minimum(source, data.size - 1)]]
    joined[to + room - 1] = 0x20
    return joined.tobytes(), to, to + room - 1, np.searchsorted(start, cut)


def fingerprints(texts: pa.Array, words: int, seed: int) -> np.ndarray:
    """SimHash of each text as an unsigned 64-bit integer."""
    out = np.zeros(len(texts), np.uint64)
    digest = xxhash.xxh64_intdigest
    for lo, hi, data, cut in ts.slices(texts, ts.SLICE_BYTES // 2):
        joined, start, end, first = _joined_words(data, cut)
        n_words = np.diff(first)
        n = np.where(n_words == 0, 0, np.maximum(n_words - words + 1, 1))
        at = np.cumsum(n) - n
        total = int(n.sum())
        if total == 0:
            continue
        head = np.repeat(first[:-1] - at, n) + np.arange(total)
        tail = np.minimum(head + words - 1, np.repeat(first[1:] - 1, n))
        h = np.fromiter((digest(joined[s:e], seed) for s, e in zip(start[head].tolist(), end[tail].tolist())),
                        np.uint64, total)
        bits = np.unpackbits(h.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        has = np.flatnonzero(n)
        sums = np.add.reduceat(bits, at[has], axis=0, dtype=np.int32)
        packed = np.packbits(sums * 2 > n[has][:, None], axis=1, bitorder="little")
        out[lo + has] = packed.reshape(-1).view("<u8")
    return out


def fingerprint(column: str, params: SimHashParams) -> Column:
    """The fingerprint of a text column as a (signed) long."""
    words, seed = params.shingle_words, params.seed

    @F.arrow_udf("long")
    def simhash(texts: pa.Array) -> pa.Array:
        return pa.array(fingerprints(texts, words, seed).view(np.int64))

    return simhash(F.col(column).cast("string"))


# ---------------------------------------------------------------- vantage-point trees

def _distance(a, b) -> np.ndarray:
    return np.bitwise_count(a ^ b)


#: A radius that no distance passes: the node isn't split.
WHOLE = 127


def grow_upper(sample: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Upper tree as a heap: node k splits by distance <= radius[k] to vantage[k]."""
    vantage, radius = np.zeros(2 ** depth - 1, np.uint64), np.full(2 ** depth - 1, WHOLE, np.int64)
    parts = {0: sample}
    for k in range(vantage.size):
        points = parts.pop(k, np.zeros(0, np.uint64))
        if points.size >= 2:
            vantage[k] = points[0]
            d = _distance(points, points[0])
            radius[k] = _even_radius(d)
            near = d <= radius[k]
            parts[2 * k + 1], parts[2 * k + 2] = points[near], points[~near]
    return vantage, radius


def _even_radius(d: np.ndarray) -> int:
    """Radius that leaves about half of the points on either side."""
    below = np.cumsum(np.bincount(d, minlength=65))
    return int(np.argmin(np.abs(below - d.size / 2)))


def route(points: np.ndarray, tree: tuple[np.ndarray, np.ndarray], slack: int):
    """Arrays (row, shard, asks): each point's own shard once, and as a query every other shard where
    a point within ``slack`` may lie that doesn't itself ask in a shard of this one."""
    vantage, radius = tree
    row, node = np.arange(points.size), np.zeros(points.size, np.int64)
    asks = np.zeros(points.size, bool)
    for _ in range((vantage.size + 1).bit_length() - 1):
        d, r = _distance(points[row], vantage[node]).astype(np.int64), radius[node]
        near = d <= np.where(asks, r + slack, r)
        far = d > r - slack
        asked = asks | (d <= r)                       # outside, what falls inside only asks
        row = np.concatenate([row[near], row[far]])
        node = np.concatenate([2 * node[near] + 1, 2 * node[far] + 2])
        asks = np.concatenate([asks[near], asked[far]])
    return row, node - vantage.size, asks


def close_pairs(points: np.ndarray, queries: np.ndarray, max_bits: int, leaf: int, ordered: bool):
    """Yields arrays (a, b) of all pairs with a in queries, b in points, within max_bits: of those
    with a < b, or of all but a = b."""
    stack = [(points, queries)]
    while stack:
        own, asked = stack.pop()
        if not own.size or not asked.size:
            continue
        if own.size > leaf:
            d = _distance(own, own[own.size // 2])
            radius = _even_radius(d)
            near = d <= radius
            if near.any() and not near.all():
                q = _distance(asked, own[own.size // 2]).astype(np.int64)
                stack.append((own[near], asked[q <= radius + max_bits]))
                stack.append((own[~near], asked[q > radius - max_bits]))
                continue
        step = max(1, (1 << 20) // own.size)
        for k in range(0, asked.size, step):
            block = asked[k:k + step]
            i, j = np.nonzero(_distance(block[:, None], own[None, :]) <= max_bits)
            keep = block[i] < own[j] if ordered else block[i] != own[j]
            if keep.any():
                yield block[i[keep]], own[j[keep]]


def _forest(pairs) -> list[tuple[int, int]]:
    """(node, root) rows that connect what the pairs connect."""
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in pairs:
        for x, y in zip(a.tolist(), b.tolist()):
            x, y = find(x), find(y)
            if x != y:
                parent[max(x, y)] = min(x, y)
    return [(x, find(x)) for x in parent if find(x) != x]


def _unsigned(fp) -> np.ndarray:
    """A column of longs as unsigned numbers."""
    return np.asarray(fp.to_numpy(**({} if isinstance(fp, pa.ChunkedArray) else {"zero_copy_only": False}))).astype(np.int64).view(np.uint64)


def upper_depth(count: int, params: SimHashParams) -> int:
    """Levels of the upper tree: shards of ``shard_rows`` while there are at most ``shards``, then larger ones."""
    rows = min(max(count / params.shards, params.shard_rows), max(params.shard_rows, params.full_shard_rows))
    return min(params.max_depth, max(0, int(np.ceil(np.log2(max(1, count) / rows)))))


def link_forest(nodes: DataFrame, params: SimHashParams) -> DataFrame:
    """(a, b) links that connect exactly the distinct fingerprints (column fp) within ``max_bits``."""
    spark = nodes.sparkSession
    count = nodes.count()
    depth = upper_depth(count, params)
    # a draw of sample_per_shard fingerprints a shard comes to the driver
    draw = F.pmod(F.xxhash64("fp"), F.lit(1 << 52)) / float(1 << 52)
    sample = nodes.filter(draw < 2 ** depth * params.sample_per_shard / max(1, count)).select("fp").toArrow()
    points = np.random.default_rng(params.seed).permutation(np.sort(_unsigned(sample["fp"])))
    tree = spark.sparkContext.broadcast(grow_upper(points, depth))
    max_bits, leaf = params.max_bits, params.leaf_rows

    def send(batches):
        for batch in batches:
            own = _unsigned(batch.column(0))
            for lo in range(0, own.size, 4096):
                rows, shard, asks = route(own[lo:lo + 4096], tree.value, max_bits)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(shard.astype(np.int32)), pa.array(own[lo + rows].view(np.int64)), pa.array(asks)],
                    ["shard", "fp", "asks"])

    def answer(table: pa.Table) -> pa.Table:
        fp, asks = _unsigned(table["fp"]), table["asks"].to_numpy()
        own = fp[~asks]
        pairs = chain(close_pairs(own, own, max_bits, leaf, True), close_pairs(own, fp[asks], max_bits, leaf, False))
        links = np.array(_forest(pairs), np.uint64).reshape(-1, 2)
        return pa.table({"a": links[:, 0].copy().view(np.int64), "b": links[:, 1].copy().view(np.int64)})

    return (nodes.select("fp").mapInArrow(send, "shard int, fp long, asks boolean")
            .groupBy("shard").applyInArrow(answer, "a long, b long"))


def near_duplicates(docs: DataFrame, params: SimHashParams = SimHashParams()) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id of every row of ``docs``."""
    shipped(docs.sparkSession)
    marked = written(docs.select("doc_id", fingerprint("text", params).alias("fp")), "simhash-fingerprints")
    nodes = marked.groupBy("fp").agg(F.min("doc_id").alias("least"))
    roots = component_roots(link_forest(nodes, params))
    # fingerprints without a link are their own component
    rooted = nodes.join(roots.select(F.col("u").alias("fp"), F.col("v").alias("root")), "fp", "left")
    rooted = rooted.select("fp", "least", F.coalesce("root", "fp").alias("root"))
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = rooted.join(named, "root").select("fp", "component_id")
    return (marked.join(classes, "fp")
            .select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"))


def keep_first(docs: DataFrame, params: SimHashParams = SimHashParams()) -> DataFrame:
    """The rows of ``docs`` whose doc_id names their component: one document of each group stays.

    A row without a doc_id goes if its component has one. A component without
    any doc_id keeps its rows, as nothing tells them apart, and so do rows that
    share the doc_id that stays.
    """
    classes = written(near_duplicates(docs, params), "simhash-classes")
    gone = classes.filter("doc_id != component_id").select("doc_id")
    unnamed = classes.filter("doc_id IS NULL AND component_id IS NOT NULL").select("fingerprint").distinct()
    named = docs.join(gone, "doc_id", "left_anti").select(docs.columns)
    if unnamed.isEmpty():
        return named
    # the rows without a doc_id once more, told by their fingerprints
    own = F.lpad(F.lower(F.hex(fingerprint("text", params))), 16, "0")
    rest = (docs.filter("doc_id IS NULL").select(F.struct(docs.columns).alias("_row"), own.alias("fingerprint"))
            .join(unnamed, "fingerprint", "left_anti").select("_row.*"))
    return named.filter("doc_id IS NOT NULL").unionByName(rest)
