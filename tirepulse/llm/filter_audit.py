"""Filter interaction audit with truth-table survival words.

Five filters can be applied in 120 orders. Which documents any order keeps after
any step depends only on the *set* of filters applied so far, so every document
becomes one 32-bit word: bit S is set if the document survives all filters of
subset S (S read as a 5-bit mask). Counting the set bits at each of the 32
positions over all documents gives the survivors of every subset at once.

1. ``marks`` reads each text once: the filters that depend on the text alone and
   a 256-bit digest of the text, written as a narrow table.
2. The smallest doc_id of each distinct text comes from a pre-aggregated
   grouping, so a text that a third of all rows share sends one row a task. A
   document is identical to an earlier one exactly if its (doc_id, digest) isn't
   among these; that join and the one with the labels are on doc_id, not on the
   shared text.
3. Inside Arrow tasks the words of each part and label are summed by carry-save
   adders: three words become one word of sums and one of carries, until a few
   words are left at each power of two (``positional_counts``).
4. The counts of the batches add up per part, and all orders and steps are read
   off the 32 survivor counts of the part.

Edge cases: a null text is empty (and identical to other empty ones); a text
without words has 0 distinct of 0 words and so passes B; texts of any length
are read whole; repeated rows count each, and rows of one doc_id are not
earlier than each other; a row without doc_id is never identical to an earlier
one and has no label; repeated label rows count once, 1 winning; a null lang is
the part of the empty string; extra columns are ignored; an empty table has no
part and gives an empty result.
"""

from __future__ import annotations

from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tirepulse.llm.ship import shipped
from tirepulse.llm.store import written

# The five filters and their limits.
FILTERS = "ABCDE"
MIN_WORDS = 200
DISTINCT_PERCENT = 50
CAPITAL_PERCENT = 3
SYMBOLS = "[#$%&*|]"
SPACE = r"[\x20\x09-\x0D]+"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

SUBSETS = 1 << len(FILTERS)
EVERY = SUBSETS - 1
#: Word of a document by the mask of the filters that it fails: bit S is set if S has none of them.
WORDS = np.array([sum(1 << s for s in range(SUBSETS) if not s & failed) for failed in range(SUBSETS)], np.uint32)
LABELS = ("all", "good", "toxic")


# ---------------------------------------------------------------- marks

def failures(text: Column) -> Column:
    """Mask of the filters A to D that a (non-null) text fails."""
    words = F.array_remove(F.split(text, SPACE), "")
    n = F.size(words)
    capitals = F.length(text) - F.length(F.translate(text, CAPITALS, ""))
    fails = [n < MIN_WORDS,
             F.size(F.array_distinct(words)) * 100 < n * DISTINCT_PERCENT,
             capitals * 100 > F.length(text) * CAPITAL_PERCENT,
             text.rlike(SYMBOLS)]
    return sum((F.when(x, 1 << k).otherwise(0) for k, x in enumerate(fails)), F.lit(0)).cast("int")


def marks(docs: DataFrame) -> DataFrame:
    """doc_id, part, failed (mask of A to D) and digest of every row."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select("doc_id", F.coalesce("lang", F.lit("")).alias("part"), failures(text).alias("failed"),
                       F.unhex(F.sha2(text, 256)).alias("digest"))


def with_repeats(marked: DataFrame) -> DataFrame:
    """``marked`` with filter E in the mask: the text is identical to one of a smaller doc_id."""
    known = marked.filter(F.col("doc_id").isNotNull())
    first = (known.groupBy("digest").agg(F.min("doc_id").alias("doc_id")).withColumn("first", F.lit(True)))
    repeated = F.when(F.col("first"), 0).otherwise(1 << FILTERS.index("E"))
    told = (known.join(first, ["doc_id", "digest"], "left")
            .select("doc_id", "part", F.col("failed").bitwiseOR(repeated).alias("failed")))
    return told.union(marked.filter(F.col("doc_id").isNull()).select("doc_id", "part", "failed"))


def with_labels(told: DataFrame, labels: DataFrame) -> DataFrame:
    """``told`` with the booleans good and toxic."""
    of = lambda c: F.coalesce(F.max(F.col(c) == 1), F.lit(False)).alias(c)
    known = (labels.filter(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(of("quality"), of("toxic"))
             .select("doc_id", F.col("quality").alias("good"), "toxic"))
    none = F.lit(False)
    some = told.filter(F.col("doc_id").isNotNull()).join(known, "doc_id", "left")
    return (some.select("part", "failed", F.coalesce("good", none).alias("good"), F.coalesce("toxic", none).alias("toxic"))
            .union(told.filter(F.col("doc_id").isNull()).select("part", "failed", none, none)))


# ---------------------------------------------------------------- counting

def positional_counts(words: np.ndarray) -> np.ndarray:
    """How many of the 32-bit words have each bit set, by carry-save addition.

    A full adder turns three words of one weight into one word of that weight
    (the sums of the 32 columns) and one of twice the weight (the carries). It
    is applied to whole arrays until fewer than three words of a weight are
    left; only these few are counted bit by bit.
    """
    out = np.zeros(32, np.int64)
    level, weight = words.astype(np.uint32), 1
    while level.size:
        carries = []
        while level.size >= 3:
            n = level.size // 3
            a, b, c, rest = level[:n], level[n:2 * n], level[2 * n:3 * n], level[3 * n:]
            both = a ^ b
            carries.append((a & b) | (both & c))
            level = np.concatenate([both ^ c, rest])
        for word in level.tolist():
            out += weight * ((word >> np.arange(32)) & 1)
        level = np.concatenate(carries) if carries else level[:0]
        weight *= 2
    return out


_COUNTS = "part string, " + ", ".join(f"{label} array<long>" for label in LABELS)


def _count_batches(batches):
    """Survivor counts of each part and label in each Arrow batch."""
    for batch in batches:
        parts = batch.column("part").dictionary_encode()
        code = parts.indices.to_numpy(zero_copy_only=False)
        word = WORDS[batch.column("failed").to_numpy(zero_copy_only=False)]
        flags = [np.ones(word.size, bool), *(batch.column(c).to_numpy(zero_copy_only=False).astype(bool) for c in LABELS[1:])]
        order = np.argsort(code, kind="stable")
        cut = np.searchsorted(code[order], np.arange(len(parts.dictionary) + 1))
        rows = [order[lo:hi] for lo, hi in zip(cut[:-1], cut[1:])]
        yield pa.RecordBatch.from_arrays(
            [parts.dictionary.cast(pa.string()),
             *(pa.array([positional_counts(word[r[flag[r]]]) for r in rows], pa.list_(pa.int64())) for flag in flags)],
            ["part", *LABELS])


def survivors(labelled: DataFrame) -> DataFrame:
    """Per part: the survivors of each of the 32 subsets, in all, among good and among toxic documents."""
    counts = labelled.mapInArrow(_count_batches, _COUNTS)
    sums = [F.sum(F.col(label)[s]).alias(f"{label}_{s}") for label in LABELS for s in range(SUBSETS)]
    added = counts.groupBy("part").agg(*sums)
    return added.select("part", *[F.array(*[f"{label}_{s}" for s in range(SUBSETS)]).alias(label) for label in LABELS])


# ---------------------------------------------------------------- the report

_REPORT = ("part string, filter_order string, step int, kept long, removed long, redundant long, "
           "unique_fails long, good_lost long, toxic_lost long, shapley long")


def _steps(alive: dict[str, np.ndarray]):
    """Rows of the report for one part."""
    every = alive["all"]
    total, n = every[0], len(FILTERS)
    alone = [int(every[EVERY ^ (1 << k)] - every[EVERY]) for k in range(n)]
    # all orders in which exactly the filters of s stand before filter k
    shapley = [sum(factorial(s.bit_count()) * factorial(n - 1 - s.bit_count()) * int(every[s] - every[s | (1 << k)])
                   for s in range(SUBSETS) if not s >> k & 1) for k in range(n)]
    for order in permutations(range(n)):
        before = 0
        for step, k in enumerate(order, 1):
            after = before | (1 << k)
            removed = int(every[before] - every[after])
            yield ("".join(FILTERS[x] for x in order), step, int(every[after]), removed,
                   int(total - every[1 << k]) - removed, alone[k],
                   *(int(alive[label][before] - alive[label][after]) for label in LABELS[1:]), shapley[k])
            before = after


def _report_batches(batches):
    """600 rows for each part: a part's row holds all that they need."""
    names = [c.split()[0] for c in _REPORT.split(", ")]
    kinds = {"string": pa.string(), "int": pa.int32(), "long": pa.int64()}
    types = [kinds[c.split()[1]] for c in _REPORT.split(", ")]
    for batch in batches:
        for row in batch.to_pylist():
            rows = [(row["part"], *r) for r in _steps({label: np.array(row[label], np.int64) for label in LABELS})]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, order of the five filters and step, with what the step keeps,
    removes and repeats (see ``_REPORT`` for the columns)."""
    shipped(docs.sparkSession)
    marked = written(marks(docs), "filter-audit-marks")
    alive = survivors(with_labels(with_repeats(marked), labels))
    return alive.mapInArrow(_report_batches, _REPORT)
