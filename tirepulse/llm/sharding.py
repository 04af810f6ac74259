"""Sharding by sampled splitters: shards of near equal bytes, equal texts together.

Everything is DataFrame functions; there is no Python on the executors.

1. One pass over the texts writes a narrow record table: size, checksum and the
   64-bit hash of the text, which is the key that records are ordered by.
2. A sample in which a record's chance grows with its size gives the quantiles
   of the key. They cut the key range into many more ranges than shards, so no
   task handles more than a small range.
3. The exact size of every range is summed. Ranges that came out overfull are
   subdivided: further cuts, from the weights of the keys inside, part them until
   none is overfull; a key that alone fills over half a range (a text with very
   many copies, or a very long one) gets cells of its own, dealt by document and row.
4. Running sums of the cells' sizes, and inside a cell of its records' sizes,
   give each record its place in the byte order; the shard is its place times
   the number of shards over the total. Equal texts take the place of their
   middle, so they stay together unless they fill more than half a range.

Law: ``bytes``. A shard differs from the mean by less than the size of a range
or of one document, whichever is larger.

Edge cases: null and empty texts weigh the overhead only and are equal texts;
very long texts are read once, for size and hash, and move no further; null
doc_ids are sharded like others; repeated rows each get a slot; with fewer
records than shards some shards stay empty; an empty table gives an empty
result; extra columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_left
from dataclasses import dataclass
from itertools import count

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tirepulse.llm.store import written


@dataclass(frozen=True)
class ShardingParams:
    shards: int = 24
    ranges_per_shard: int = 32
    rows_per_range: int = 1_000_000      # more ranges than that if the table is large
    sample_per_range: int = 40
    inner_sample: int = 64               # keys drawn from a share of an overfull range
    overhead_bytes: int = 8
    cells_log2: int = 12                 # cells of the table that finds a key's range


def _records(docs: DataFrame, params: ShardingParams) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return written(docs.select(
        "doc_id", (F.octet_length(text) + params.overhead_bytes).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"), F.xxhash64(text).alias("key"),
        F.monotonically_increasing_id().alias("row")), "sharding-records")


def splitters(records: DataFrame, total: int, ranges: int, params: ShardingParams) -> list[int]:
    """Sorted distinct keys that cut the records into about ``ranges`` parts of equal bytes."""
    chance = F.col("size") * float(ranges * params.sample_per_range) / float(total)
    draw = F.pmod(F.xxhash64("key", "doc_id", "row"), F.lit(1 << 52)) / float(1 << 52)
    cuts = F.percentile_approx("key", [k / ranges for k in range(1, ranges)], 16 * ranges)
    found = records.filter(draw < chance).agg(cuts.alias("cuts")).first()["cuts"]   # one row, ``ranges`` numbers
    return sorted(set(found or []))


def _with_ranges(records: DataFrame, cuts: list[int], params: ShardingParams) -> DataFrame:
    """Adds ``range``: the number of cuts at or below the key."""
    shift = 64 - params.cells_log2
    half = 1 << (params.cells_log2 - 1)
    rows = []
    for cell in range(-half, half):          # 2**cells_log2 rows
        lo, hi = bisect_left(cuts, cell << shift), bisect_left(cuts, (cell + 1) << shift)
        rows.append((cell, lo, cuts[lo:hi]))
    cells = records.sparkSession.createDataFrame(rows, "cell long, base long, own array<bigint>")
    found = records.join(F.broadcast(cells), F.shiftright("key", shift) == F.col("cell"))
    at = F.col("base") + F.size(F.filter("own", lambda c: c <= F.col("key")))
    return found.withColumn("range", at).drop("cell", "base", "own")


def refined(records: DataFrame, cuts: list[int], total: int, ranges: int, params: ShardingParams) -> list[int]:
    """``cuts`` and more of them, until no range holds over 1.5 shares of light keys (those of up to half a share).

    A round parts each overfull range in four by the weights of its light keys, of
    which it has at least four, so rounds are few. Each draws its keys anew.
    """
    share = total / ranges
    weight = F.col("bytes") * params.inner_sample / share
    for turn in count():
        draw = F.pmod(F.xxhash64(F.col("key"), F.lit(turn)), F.lit(1 << 52)) / float(1 << 52)
        ranged = _with_ranges(records, cuts, params)
        full = _overfull(ranged.groupBy("range").agg(F.sum("size").alias("bytes")), share)
        light = (ranged.join(F.broadcast(full), "range", "left_semi").groupBy("range", "key")
                 .agg(F.sum("size").alias("bytes")).filter(F.col("bytes") <= 0.5 * share))
        # a key is drawn with the chance of its weight, and counts as its weight where that is more than one
        drawn = light.withColumn("weight", F.greatest(F.lit(1), F.round(weight)).cast("long"))
        inner = F.percentile(F.when(draw < weight, F.col("key")), [0.25, 0.5, 0.75], F.col("weight"))
        found = (drawn.groupBy("range").agg(F.sum("bytes").alias("bytes"), inner.alias("inner"))
                 .filter(F.col("bytes") > 1.5 * share).select("inner").collect())      # three numbers an overfull range
        if not found:
            return cuts
        cuts = sorted(set(cuts).union(min(int(cut), 2 ** 63 - 1) for row in found for cut in row["inner"] or []))


def _overfull(sums: DataFrame, share: float) -> DataFrame:
    """The ranges of ``sums`` (range, bytes) with over 1.5 shares: fewer of them than there are shares."""
    return sums.filter(F.col("bytes") > 1.5 * share).select("range")


def _subdivide(ranged: DataFrame, total: int, ranges: int) -> DataFrame:
    """Adds ``heavy`` (the key, if it alone fills over half a share) and ``part`` (its cell)."""
    share = total / ranges
    full = _overfull(ranged.groupBy("range").agg(F.sum("size").alias("bytes")), share)
    # at most 2 * ranges keys weigh more than half a share
    heavy = (ranged.join(F.broadcast(full), "range", "left_semi").groupBy("key").agg(F.sum("size").alias("bytes"))
             .filter(F.col("bytes") > 0.5 * share)
             .select(F.col("key").alias("heavy"), F.ceil(2 * F.col("bytes") / share).alias("parts")))
    mark = F.pmod(F.xxhash64("doc_id", "row"), F.col("parts"))
    return (ranged.join(F.broadcast(heavy), F.col("key") == F.col("heavy"), "left")
            .withColumn("part", F.coalesce(mark, F.lit(0))).drop("parts"))


def shard(docs: DataFrame, params: ShardingParams = ShardingParams()) -> DataFrame:
    """doc_id, size, text_crc32, law, shard and slot (gapless in the shard) of every row."""
    records = _records(docs, params)
    rows, total = records.agg(F.count(F.lit(1)), F.sum("size")).first()
    if not rows:
        return records.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"),
                              F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot"))
    ranges = max(params.shards * params.ranges_per_shard, -(-rows // params.rows_per_range))
    cuts = refined(records, splitters(records, total, ranges, params), total, ranges, params)
    ranged = _with_ranges(records, cuts, params)
    celled = written(_subdivide(ranged, total, ranges), "sharding-cells")
    # a few times ``ranges`` rows: the only window over all of something
    in_order = Window.orderBy("range", F.col("heavy").asc_nulls_first(), "part")
    before = in_order.rowsBetween(Window.unboundedPreceding, -1)
    cells = (celled.groupBy("range", "heavy", "part").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n"))
             .select("range", "heavy", "part", F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("bytes_before"),
                     F.coalesce(F.sum("n").over(before), F.lit(0)).alias("rows_before")))
    same_cell = (celled["range"] == cells["range"]) & celled["heavy"].eqNullSafe(cells["heavy"]) & (celled["part"] == cells["part"])
    joined = celled.join(F.broadcast(cells), same_cell).select(celled["*"], "bytes_before", "rows_before")
    inside = Window.partitionBy("range", "heavy", "part").orderBy("key", "doc_id", "row")
    equal = Window.partitionBy("range", "heavy", "part", "key")
    own = F.col("upto") - F.col("size") / 2                       # middle of the record
    group = F.min(F.col("upto") - F.col("size")).over(equal) + F.sum("size").over(equal) / 2
    place = F.col("bytes_before") + F.when(F.col("heavy").isNull(), group).otherwise(own)
    placed = (joined.withColumn("upto", F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0)))
              .withColumn("index", F.col("rows_before") + F.row_number().over(inside) - 1)
              .withColumn("shard", F.least(F.lit(params.shards - 1), F.floor(place * params.shards / float(total))).cast("int"))
              .select("doc_id", "size", "text_crc32", "shard", "index"))
    placed = written(placed, "sharding-placed")
    starts = placed.groupBy("shard").agg(F.min("index").alias("first"))            # one row a shard
    return (placed.join(F.broadcast(starts), "shard")
            .select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
                    (F.col("index") - F.col("first")).alias("slot")))
