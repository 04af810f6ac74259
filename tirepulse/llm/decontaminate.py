"""Benchmark decontamination with a distributed positional inverted index.

Everything is DataFrame functions; there is no Python on the executors.

1. Benchmark texts are cut into windows of ``window`` consecutive words. One
   pass over the corpus counts every benchmark word (pre-aggregated).
2. Each window picks its ``rarest`` corpus words. A second pass stores the
   postings (term, doc_id, pos) of the picked terms as a table in the shared
   folder; a reserved term holds each document's length.
3. For each window the posting list of its rarest term, moved by the term's offset
   in the window, gives places where the window may start; the lists of its next
   picked terms are only met for the documents that are left, and what doesn't fit is dropped.
4. Only documents with such places are read again; a place counts if all words
   of the window stand there (phrase), or, for ``proximity``, if all of them
   stand near the rarest one in any order.

A list of terms or ids is broadcast only after it was counted and found within
``broadcast_rows``; beyond that Spark joins by shuffle.

Edge cases: null and empty texts, on either side, have no words; an item of
fewer words than a window is one window; an item without words matches
nothing; a window of several items counts for each of them; an item_id that is
null is hit but not named; equal benchmark rows count once; rows that repeat a
doc_id get one result row each, and an occurrence in one of them counts for the
others as far as their words go; a row whose doc_id is null is returned with
its word count and no hits; empty tables give no hits or an empty result;
extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tirepulse.llm.store import written

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: What stands between words, before A-Z is lower-cased.
_BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Reserved term whose posting is a document's number of words.
_LENGTH = ""


@dataclass(frozen=True)
class DecontaminationParams:
    window: int = 10
    rarest: int = 2
    broadcast_rows: int = 200_000


def _lower(word: Column) -> Column:
    """A-Z to a-z and nothing else; the fast function serves ASCII words."""
    return F.when(F.octet_length(word) == F.char_length(word), F.lower(word)).otherwise(
        F.translate(word, _UPPER, _LOWER))


def _raw_words(text: str) -> Column:
    return F.array_remove(F.split(F.coalesce(F.col(text).cast("string"), F.lit("")), _BETWEEN), "")


def words_of(text: str) -> Column:
    """Array of the lower-cased words of a text."""
    return F.transform(_raw_words(text), _lower)


def windows_of(items: DataFrame, size: int) -> DataFrame:
    """Distinct windows: phrase, its words, and the sorted ids of its items."""
    w, n = F.col("w"), F.size("w")
    starts = F.sequence(F.lit(1), F.greatest(F.lit(1), n - size + 1))
    return (items.select("item_id", words_of("text").alias("w")).filter(n > 0)
            .select("item_id", F.explode(F.transform(starts, lambda i: F.slice(w, i, F.least(F.lit(size), n)))).alias("words"))
            .groupBy(F.array_join("words", " ").alias("phrase"))
            .agg(F.first("words").alias("words"), F.sort_array(F.collect_set("item_id")).alias("items")))


def _bounded(df: DataFrame, limit: int) -> DataFrame:
    """``df`` marked for broadcast if it has at most ``limit`` rows."""
    return F.broadcast(df) if df.limit(limit + 1).count() <= limit else df


def _term_counts(docs: DataFrame, windows: DataFrame, params: DecontaminationParams) -> DataFrame:
    """Corpus count of every word of the windows."""
    vocabulary = windows.select(F.explode("words").alias("term")).distinct()
    return (docs.select(F.explode(_raw_words("text")).alias("w")).select(_lower(F.col("w")).alias("term"))
            .join(_bounded(vocabulary, params.broadcast_rows), "term")
            .groupBy("term").agg(F.count(F.lit(1)).alias("n")))


def _picks(windows: DataFrame, counts: DataFrame, rarest: int) -> DataFrame:
    """phrase, and per picked word its term and offset, rarest first. Windows
    with a word that the corpus lacks can't occur and are left out."""
    spread = windows.select("phrase", "items", F.size("words").alias("size"), F.posexplode("words").alias("offset", "term"))
    return (spread.join(counts, "term").groupBy("phrase", "size")
            .agg(F.sort_array(F.collect_list(F.struct("n", "offset", "term"))).alias("by_count"))
            .filter(F.size("by_count") == F.col("size"))
            .select("phrase", F.slice("by_count", 1, rarest).alias("picked")))


def build_index(docs: DataFrame, terms: DataFrame, params: DecontaminationParams) -> DataFrame:
    """Stored postings (term, doc_id, pos) of ``terms``, and each row's length under the reserved term."""
    wanted = _bounded(terms.select("term").union(terms.sparkSession.createDataFrame([(_LENGTH,)], "term string")).distinct(),
                      params.broadcast_rows)
    places = F.posexplode(F.concat(_raw_words("text"), F.array(F.lit(_LENGTH)))).alias("pos", "w")
    postings = (docs.select("doc_id", places).select("doc_id", "pos", _lower(F.col("w")).alias("term"))
                .join(wanted, "term").select("term", "doc_id", "pos"))
    return written(postings, "decontamination-index")


def _starts(picks: DataFrame, postings: DataFrame, near: int | None, rarest_terms: int) -> DataFrame:
    """(phrase, doc_id, places) after intersecting the picked terms' lists.

    ``near`` None: places are starts at which all picked terms fit. Otherwise
    they are positions of the rarest term with the other ones within ``near`` words.
    """
    lists = (postings.filter((F.col("term") != _LENGTH) & F.col("doc_id").isNotNull())
             .groupBy("term", "doc_id").agg(F.sort_array(F.collect_set("pos")).alias("list")))
    rarest = picks.select("phrase", "picked", F.col("picked")[0]["term"].alias("term"))
    moved = lambda k: F.transform("list", lambda x: x - F.col("picked")[k]["offset"]) if near is None else F.col("list")
    left = rarest.join(lists, "term").select("phrase", "picked", "doc_id", moved(0).alias("places"))
    for k in range(1, rarest_terms):
        asked = left.withColumn("term", F.get("picked", F.lit(k))["term"])     # null if the window has no such word
        met = asked.join(lists, ["term", "doc_id"], "left")
        other = F.coalesce(moved(k), F.array().cast("array<int>"))
        fits = F.array_intersect("places", other) if near is None else F.filter(
            "places", lambda x: F.exists(other, lambda y: F.abs(x - y) <= near))
        left = (met.select("phrase", "picked", "doc_id", F.when(F.size("picked") <= k, F.col("places")).otherwise(fits).alias("places"))
                .filter(F.size("places") > 0))
    return left.select("phrase", "doc_id", "places")


def _candidate_docs(docs: DataFrame, candidates: DataFrame, params: DecontaminationParams) -> DataFrame:
    """Words of the documents that have candidates, with those candidates."""
    ids = _bounded(candidates.select("doc_id").distinct(), params.broadcast_rows)
    texts = docs.select("doc_id", "text").join(ids, "doc_id", "left_semi")
    grouped = candidates.groupBy("doc_id").agg(F.collect_list(F.struct("phrase", "places")).alias("asked"))
    return texts.join(grouped, "doc_id").select("doc_id", words_of("text").alias("w"), "asked")


def _prepared(docs: DataFrame, items: DataFrame, params: DecontaminationParams):
    windows = written(windows_of(items, params.window), "decontamination-windows")
    counts = written(_term_counts(docs, windows, params), "decontamination-counts")
    picks = _picks(windows, counts, params.rarest)
    terms = picks.select(F.explode("picked.term").alias("term")).distinct()
    return windows, picks, build_index(docs, terms, params)


def phrase_matches(docs: DataFrame, items: DataFrame, params: DecontaminationParams = DecontaminationParams(),
                   prepared=None) -> DataFrame:
    """(doc_id, start, size, phrase) of every occurrence of a window, words counted from 0."""
    windows, picks, postings = prepared or _prepared(docs, items, params)
    candidates = written(_starts(picks, postings, None, params.rarest), "decontamination-candidates")
    def real(a: Column) -> Column:
        """The window's places at which all its words stand; tested in the document's own row."""
        size = F.size(F.split(a["phrase"], " "))
        there = F.filter(a["places"], lambda p: (p >= 0) & (
            F.array_join(F.slice(F.col("w"), F.greatest(p + 1, F.lit(1)), size), " ") == a["phrase"]))
        return F.struct(a["phrase"].alias("phrase"), size.alias("size"), there.alias("starts"))

    return (_candidate_docs(docs, candidates, params)
            .select("doc_id", F.explode(F.transform("asked", real)).alias("a"))
            .select("doc_id", F.explode("a.starts").alias("start"), "a.size", "a.phrase").distinct())


def proximity_matches(docs: DataFrame, items: DataFrame, slop: int = 5,
                      params: DecontaminationParams = DecontaminationParams()) -> DataFrame:
    """(doc_id, pos, phrase): positions of a window's rarest word around which, within
    its size plus ``slop`` words to either side, all words of the window stand in any order."""
    windows, picks, postings = _prepared(docs, items, params)
    reach = params.window - 1 + slop
    candidates = written(_starts(picks, postings, reach, params.rarest), "decontamination-candidates")
    held = (_candidate_docs(docs, candidates, params)
            .select("doc_id", "w", F.explode("asked").alias("a")).select("doc_id", "w", "a.phrase", "a.places"))
    around = lambda p: F.slice(F.col("w"), F.greatest(p - reach + 1, F.lit(1)),
                               reach + 1 + F.least(p, F.lit(reach)))
    real = F.filter("places", lambda p: F.size(F.array_except(F.split("phrase", " "), around(p))) == 0)
    return held.select("doc_id", "phrase", F.explode(real).alias("pos")).select("doc_id", "pos", "phrase").distinct()


def contamination(docs: DataFrame, items: DataFrame,
                  params: DecontaminationParams = DecontaminationParams()) -> DataFrame:
    """doc_id, n_words, n_hit (words inside any occurrence), items (ids of the items
    with occurring windows, sorted as strings) of every row of ``docs``."""
    prepared = _prepared(docs, items, params)
    windows, _, postings = prepared
    matches = phrase_matches(docs, items, params, prepared).join(windows.select("phrase", "items"), "phrase")
    spans = F.transform(F.collect_set(F.struct("start", "size")), lambda s: F.sequence(s["start"], s["start"] + s["size"] - 1))
    ids = F.array_distinct(F.flatten(F.collect_set("items")))
    hits = matches.groupBy("doc_id").agg(
        F.size(F.array_distinct(F.flatten(spans))).cast("long").alias("n_hit"),
        F.array_sort(F.transform(ids, lambda x: x.cast("string"))).alias("items"))
    lengths = postings.filter(F.col("term") == _LENGTH).select("doc_id", F.col("pos").cast("long").alias("n_words"))
    return lengths.join(hits, "doc_id", "left").select(
        "doc_id", "n_words", F.least(F.coalesce("n_hit", F.lit(0)), "n_words").cast("long").alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"))


def keep_clean(docs: DataFrame, items: DataFrame,
               params: DecontaminationParams = DecontaminationParams()) -> DataFrame:
    """The rows of ``docs`` in which no window of a benchmark item occurs."""
    hit = phrase_matches(docs, items, params).select("doc_id").distinct()
    return docs.join(_bounded(written(hit, "decontamination-hit"), params.broadcast_rows), "doc_id", "left_anti").select(*docs.columns)
