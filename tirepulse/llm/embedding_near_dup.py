"""Embedding near-duplicates by sorted projection passes.

1. Rows with one and the same vector and label are one node that weighs as many
   rows (grouped by a 128-bit digest of the components, pre-aggregated).
2. In each pass every node gets a code of 64 concatenated random hashes (the
   signs of random projections). Nodes are ordered by (pass, label, code); close
   vectors share long prefixes of their codes and so stand near each other.
   Each is compared with the ``window`` nodes after it, in double precision.
   The order is global: rows get their rank, blocks of ranks are tasks, and the
   last ``window`` rows of a block are sent along with the next one.
3. Links of all passes are united: a task reduces what it has found to a
   spanning forest, components come from alternating star steps.
4. Windows are bounded, so in a component with more nodes than a window not all
   links stand next to each other in some pass. All nodes of each component are
   therefore compared with each other, in blocks, and each gets the number of
   its links; no pairs leave the tasks.

The number of passes follows from the number of vectors, so that a pair of
vectors exactly at the threshold is found with probability ``recall`` at every
size: it meets in a pass if its codes agree in the log2(n / window) bits that
part the table into pieces of a window (``passes_for``). Nearer pairs are found
far more often.

Edge cases: rows whose label or vector is null, whose vector is empty, zero, or
holds a null or a non-finite component link with nothing and are their own
component; vectors of other lengths count as padded with zeros; rows that
repeat a vec_id count once, with the smallest of their (label, vector); rows
without vec_id are returned, link with nothing and are kept; very small and very
large components are scaled before they are squared; extra columns are ignored;
an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tirepulse.llm.components import component_roots
from tirepulse.llm.ship import shipped
from tirepulse.llm.store import written


@dataclass(frozen=True)
class PassParams:
    threshold: float = 0.93
    window: int = 64              # nodes after each one that it is compared with in a pass
    recall: float = 0.99          # probability that a pair at the threshold meets in some pass
    block_rows: int = 1024
    seed: int = 17


def passes_for(n: int, params: PassParams) -> int:
    """Passes that find a pair at the threshold with probability ``recall`` among n vectors."""
    agree = 1 - math.acos(max(-1.0, min(1.0, params.threshold))) / math.pi
    meets = agree ** max(0.0, math.log2(max(1, n) / params.window))
    return 1 if meets >= params.recall else math.ceil(math.log(1 - params.recall) / math.log(1 - meets))


# ---------------------------------------------------------------- vectors in tasks

def unit_rows(column, dim: int) -> np.ndarray:
    """A column of lists as unit vectors in double precision, padded with zeros to ``dim``."""
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    bounds = lists.offsets.to_numpy().astype(np.int64)
    values = lists.values.to_numpy(zero_copy_only=False)[bounds[0]:bounds[-1]].astype(np.float64)
    size = np.diff(bounds)
    out = np.zeros((len(lists), dim))
    out[np.repeat(np.arange(size.size), size), np.arange(values.size) - np.repeat(bounds[:-1] - bounds[0], size)] = values
    if dim:
        peak = np.abs(out).max(axis=1, keepdims=True)
        out /= np.where(peak > 0, peak, 1)
        length = np.sqrt((out * out).sum(axis=1, keepdims=True))
        out /= np.where(length > 0, length, 1)
    return out


def codes_of(units: np.ndarray, number: int, seed: int) -> np.ndarray:
    """64 concatenated one-bit hashes of each vector for one pass, the first one on top."""
    planes = np.random.default_rng([seed, number]).standard_normal((units.shape[1], 64))
    bits = np.packbits(units @ planes >= 0, axis=1, bitorder="big")
    return bits.view(">u8").reshape(-1).astype(np.uint64).view(np.int64)


def window_links(units: np.ndarray, group: np.ndarray, window: int, threshold: float):
    """Pairs (i, j), i < j <= i + window, of one group whose cosine reaches the threshold."""
    first, second = [], []
    for step in range(1, min(window, len(units) - 1) + 1):
        same = np.flatnonzero(group[:-step] == group[step:])
        near = same[np.einsum("ij,ij->i", units[same], units[same + step]) >= threshold]
        first.append(near)
        second.append(near + step)
    none = np.zeros(0, np.int64)
    return (np.concatenate(first), np.concatenate(second)) if first else (none, none)


def _forest(a: np.ndarray, b: np.ndarray) -> tuple[list[int], list[int]]:
    """(node, smaller node) links that connect what the pairs connect."""
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for x, y in zip(a.tolist(), b.tolist()):
        x, y = find(x), find(y)
        if x != y:
            parent[max(x, y)] = min(x, y)
    linked = [x for x in parent if find(x) != x]
    return linked, [find(x) for x in linked]


# ---------------------------------------------------------------- passes

def _nodes(table: DataFrame, column: str) -> tuple[DataFrame, DataFrame, int]:
    """(vec_id and node of every row that can link, the nodes with label, vector and weight, largest length).

    A node is named by the smallest vec_id of its rows."""
    fine = F.forall(column, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = F.col("label").isNotNull() & F.col(column).isNotNull() & fine & F.exists(column, lambda x: x != 0)
    rows = (table.filter(F.col("vec_id").isNotNull() & usable)
            .groupBy("vec_id").agg(F.min(F.struct(F.col("label"), F.col(column).alias("vector"))).alias("v"))
            .select("vec_id", "v.label", "v.vector"))
    wide = dict(rows.dtypes)["vector"]

    def digests(batches):
        for batch in batches:
            lists = batch.column("vector")
            bounds = lists.offsets.to_numpy()
            values = lists.values.to_numpy(zero_copy_only=False).astype(np.float64) + 0.0     # no negative zero
            keys = []
            for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
                own = np.trim_zeros(values[lo:hi], "b")
                keys.append(hashlib.blake2b(own.tobytes(), digest_size=16).digest())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(keys, pa.binary())], [*batch.schema.names, "digest"])

    label = dict(rows.dtypes)["label"]
    kept = written(rows.mapInArrow(digests, f"vec_id long, label {label}, vector {wide}, digest binary"), "embedding-vectors")
    named = kept.groupBy("label", "digest").agg(F.min("vec_id").alias("node"), F.count(F.lit(1)).alias("weight"))
    members = kept.select("vec_id", "label", "digest").join(named, ["label", "digest"]).select("vec_id", "node", "weight")
    members = written(members, "embedding-members")
    nodes = (kept.join(members.filter("vec_id = node").select("vec_id", "weight"), "vec_id")
             .select(F.col("vec_id").alias("node"), "label", "vector", "weight"))
    dim = kept.agg(F.max(F.size("vector"))).first()[0] or 0
    return members, written(nodes, "embedding-nodes"), dim


def ranked(nodes: DataFrame, dim: int, passes: int, params: PassParams) -> DataFrame:
    """pass, label, node and rank of every node in every pass, in one global order."""
    seed, label = params.seed, dict(nodes.dtypes)["label"]

    def send(batches):
        for batch in batches:
            units = unit_rows(batch.column("vector"), dim)
            for number in range(passes):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(units), number, np.int32)), batch.column("label"),
                     pa.array(codes_of(units, number, seed)), batch.column("node")], ["pass", "label", "code", "node"])

    order = ["pass", "label", "code", "node"]
    codes = nodes.select("node", "label", "vector").mapInArrow(send, f"pass int, label {label}, code long, node long")
    # the id holds the partition above bit 33 and the place in it below
    placed = written(codes.repartitionByRange(*order).sortWithinPartitions(*order)
                     .withColumn("_id", F.monotonically_increasing_id()).drop("code"), "embedding-order")
    part, place = F.shiftright("_id", 33), F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))       # one row a partition
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    return (placed.withColumn("_part", part).join(starts, "_part")
            .select("pass", "label", "node", (F.col("_start") + place).alias("rank")))


def pass_links(nodes: DataFrame, dim: int, params: PassParams) -> DataFrame:
    """(a, b) links that connect all nodes whose link was found in some pass."""
    order = ranked(nodes, dim, passes_for(nodes.count(), params), params)
    size, window, threshold = params.block_rows, params.window, params.threshold
    block = F.floor(F.col("rank") / size)
    tail = F.col("rank") % size >= size - window
    cells = (order.withColumn("cell", F.explode(F.when(tail, F.array(block, block + 1)).otherwise(F.array(block))))
             .withColumn("own", F.col("cell") == block)
             .join(nodes.select("node", "vector"), "node"))

    def compare(cell: pa.Table) -> pa.Table:
        cell = cell.sort_by("rank")
        units = unit_rows(cell["vector"], dim)
        kind = cell["label"].combine_chunks().dictionary_encode()
        kind = kind.combine_chunks() if isinstance(kind, pa.ChunkedArray) else kind
        group = cell["pass"].to_numpy().astype(np.int64) * (len(kind.dictionary) + 1) + kind.indices.to_numpy(zero_copy_only=False)
        i, j = window_links(units, group, window, threshold)
        mine = cell["own"].to_numpy()[j]             # pairs of two rows sent along belong to the block before
        node = cell["node"].to_numpy()
        a, b = _forest(node[i[mine]], node[j[mine]])
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return cells.groupBy("cell").applyInArrow(compare, "a long, b long").distinct()


# ---------------------------------------------------------------- all links of a component

def link_counts(nodes: DataFrame, grouped: DataFrame, dim: int, params: PassParams) -> DataFrame:
    """node and n, the rows of other nodes of its component that it links with.

    ``grouped``: node and component of all components of two nodes or more.
    Components up to a block share tasks; larger ones are dealt to blocks by a
    hash of the node, each pair of blocks being one task.
    """
    size, threshold = params.block_rows, params.threshold
    sizes = grouped.groupBy("component").agg(F.count(F.lit(1)).alias("m"))
    buckets = max(1, -(-grouped.count() // size))
    blocks = F.ceil(F.col("m") / size).cast("int")
    own = F.pmod(F.xxhash64("node"), blocks).cast("int")
    others = F.transform(F.sequence(F.lit(0), blocks - 1), lambda x: F.struct(
        F.col("component").alias("key"), F.least(x, own).alias("i"), F.greatest(x, own).alias("j"), own.alias("own")))
    alone = F.array(F.struct(F.pmod(F.xxhash64("component"), F.lit(buckets)).alias("key"), F.lit(-1).alias("i"),
                             F.lit(-1).alias("j"), F.lit(-1).alias("own")))
    cells = (grouped.join(sizes, "component")
             .withColumn("cell", F.explode(F.when(blocks == 1, alone).otherwise(others)))
             .select("component", "node", "cell.*")
             .join(nodes.select("node", "vector", "weight"), "node"))

    def count(cell: pa.Table) -> pa.Table:
        cell = cell.sort_by([("component", "ascending"), ("own", "ascending")])
        units, weight = unit_rows(cell["vector"], dim), cell["weight"].to_numpy()
        component, block = cell["component"].to_numpy(), cell["own"].to_numpy()
        within = cell["i"][0] == cell["j"][0]
        out = np.zeros(len(units), np.int64)
        cut = np.flatnonzero(np.diff(component, prepend=component[:1] - 1))
        for lo, hi in zip(cut.tolist(), [*cut[1:].tolist(), len(units)]):
            if within:
                near = units[lo:hi] @ units[lo:hi].T >= threshold
                np.fill_diagonal(near, False)
                out[lo:hi] += near @ weight[lo:hi]
            else:                                    # rows of two blocks of one component
                middle = lo + int(np.searchsorted(block[lo:hi], cell["i"][0].as_py(), side="right"))
                near = units[lo:middle] @ units[middle:hi].T >= threshold
                out[lo:middle] += near @ weight[middle:hi]
                out[middle:hi] += near.T @ weight[lo:middle]
        return pa.table({"node": cell["node"], "n": out})

    return (cells.groupBy("key", "i", "j").applyInArrow(count, "node long, n long")
            .groupBy("node").agg(F.sum("n").alias("n")))


def near_duplicates(table: DataFrame, column: str = "embedding", params: PassParams = PassParams()) -> DataFrame:
    """vec_id, n_links, component_id and kept, one row per vector."""
    shipped(table.sparkSession)
    members, nodes, dim = _nodes(table, column)
    roots = component_roots(pass_links(nodes, dim, params))
    grouped = written(roots.select(F.col("u").alias("node"), F.col("v").alias("component"))
                      .union(roots.select("v", "v").distinct()), "embedding-components")
    counts = written(link_counts(nodes, grouped, dim, params), "embedding-links")
    classes = grouped.join(counts, "node")
    linked = (members.join(classes, "node", "left")
              .select("vec_id", (F.col("weight") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"),
                      F.coalesce("component", "node").alias("component_id")))
    every = table.filter(F.col("vec_id").isNotNull()).select("vec_id").distinct()
    told = every.join(linked, "vec_id", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"))
    unnamed = table.filter(F.col("vec_id").isNull()).select("vec_id", F.lit(0).cast("long"), F.col("vec_id"))
    return told.union(unnamed).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
