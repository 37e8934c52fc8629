"""Phrases of two to four words that stand together often, mined per language by SON partitioning.

1. The documents fall into ``SHARDS`` shards of input partitions. Each shard is mined completely at the support
   lowered in proportion, ``least / SHARDS``: a phrase that is frequent overall reaches that in at least one shard.
   Mining goes level by level: single words and pairs first, then the longer phrases of which every pair of
   neighbouring words is locally frequent.
2. The union of the locally frequent phrases becomes a bit set of at most 64 MB. What it lets through is a superset
   of them at any size.
3. All phrases let through are counted exactly over all documents, by their words, and those below ``least`` go.

Steps 1 and 3 count within a chunk of text before anything is shuffled, so a phrase that every document has costs a
row for each chunk. Step 1 groups by 64-bit hashes: equal hashes add up and can only let more phrases into step 3.

A null text has no words; a null language is ``und``, as is that name itself. Repeated rows count each time; ids and
further columns are never looked at. An empty table gives no phrases."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fixedrecon.llm.arrays import bit_set, strings
from fixedrecon.llm.shared import stored
from fixedrecon.llm.words import Words, chunks, mixed, single_spaced, split_words, text_bytes, window_hashes, word_hashes

LEAST, LONGEST, TOP = 30, 4, 2000
SHARDS = 6
CHUNK_BYTES = 2 << 20
SALTS = 256

PIECE_END = np.zeros(256, dtype=bool)
PIECE_END[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
IN_WORD = ~PIECE_END
IN_WORD[[0x20, 0x09]] = False


class Grams:
    """Phrases of a chunk of texts: their hashes by size, at every word where one starts within a piece."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, lang: np.ndarray):
        """``lang``: a hash of each text's language."""
        self.words: Words = split_words(data, offsets, IN_WORD, lower=True)
        self.text = self.words.text
        ends = np.cumsum(PIECE_END[self.words.data], dtype=np.int32)
        self.piece = ends[self.words.start] + self.text  # both only grow: equal sums are equal pairs
        self.hashes, self.lang = word_hashes(self.words), lang

    def starts(self, size: int) -> np.ndarray:
        n = max(0, len(self.piece) - size + 1)
        return np.flatnonzero(self.piece[:n] == self.piece[size - 1 :][:n])

    def keys(self, size: int, starts: np.ndarray) -> np.ndarray:
        return mixed(window_hashes(self.hashes, size)[starts] ^ self.lang[self.text[starts]])


def _batches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Grams, pa.Array, np.ndarray]]:
    """Grams of each chunk with the distinct languages and each text's number among them."""
    for batch in batches:
        langs = batch.column(1).dictionary_encode()
        names, codes = langs.dictionary, langs.indices.to_numpy(zero_copy_only=False)
        data, at = text_bytes(names)
        hashes = word_hashes(Words(data, at[:-1], at[1:], np.arange(len(at))), seed=1)
        for row, end, data, offsets in chunks(batch.column(0), CHUNK_BYTES):
            yield Grams(data, offsets, hashes[codes[row:end]]), names, codes[row:end]


def _counted(keys: list[np.ndarray]) -> pa.RecordBatch:
    found, count = np.unique(np.concatenate(keys), return_counts=True)
    return pa.record_batch({"key": pa.array(found.view(np.int64)), "count": pa.array(count.astype(np.int64))})


def _short(batches):
    for grams, _, _ in _batches(batches):
        yield _counted([grams.keys(k, grams.starts(k)) for k in (1, 2)])


def _long(pairs, longest):
    def count(batches):
        for grams, _, _ in _batches(batches):
            starts = grams.starts(2)
            pair = np.zeros(len(grams.text), dtype=bool)
            pair[starts] = pairs.value.holds(grams.keys(2, starts))
            keys = []
            for size in range(3, longest + 1):
                starts = grams.starts(size)
                for k in range(size - 1):
                    starts = starts[pair[starts + k]]
                keys.append(grams.keys(size, starts))
            yield _counted(keys)

    return count


def _exact(candidates, longest):
    def count(batches):
        for grams, names, codes in _batches(batches):
            words = single_spaced(grams.words)
            again = word_hashes(grams.words, seed=2)
            lang, phrase, n = [], [], []
            for size in range(1, longest + 1):
                starts = grams.starts(size)
                keys = grams.keys(size, starts)
                kept = candidates.value.holds(keys)
                starts, keys = starts[kept], keys[kept]
                other = window_hashes(again, size)[starts]
                order = np.lexsort((other, keys))
                new = np.ones(len(order), dtype=bool)
                new[1:] = (np.diff(keys[order]) != 0) | (np.diff(other[order]) != 0)
                first = starts[order[new]]
                lang.append(codes[grams.text[first]])
                phrase.append(strings(words.data, words.start[first], words.end[first + size - 1]))
                n.append(np.diff(np.append(np.flatnonzero(new), len(order))))
            total = np.bincount(codes, weights=grams.words.counts, minlength=len(names)).astype(np.int64)
            present = np.unique(codes)
            lang, n = np.concatenate([*lang, present]), np.concatenate([*n, total[present]])
            phrase = pa.chunked_array([*phrase, pa.nulls(len(present), pa.large_string())]).combine_chunks().cast(pa.string())
            yield pa.record_batch({"lang": names.take(pa.array(lang)).cast(pa.string()), "phrase": phrase, "n": pa.array(n.astype(np.int64))})

    return count


def _locally_frequent(counted: DataFrame, least: int, shards: int) -> DataFrame:
    """Keys that reach their share of the support in some shard."""
    shard = counted.withColumn("shard", F.spark_partition_id() % shards)
    total = shard.groupBy("shard", "key").agg(F.sum("count").alias("count"))
    return total.where(F.col("count") >= -(-least // shards)).select("key").distinct()


def frequent_phrases(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, shards: int = SHARDS) -> DataFrame:
    """(lang, phrase, f): every phrase of 1 to ``longest`` words with ``f >= least`` occurrences in its language, and
    one row with a null phrase for each language: the number of its words."""
    spark = docs.sparkSession
    texts = docs.select(F.col("text"), F.coalesce("lang", F.lit("und")).alias("lang"))
    key = "key long, count long"
    short = stored(_locally_frequent(texts.mapInArrow(_short, key), least, shards), "phrases-short")
    pairs = spark.sparkContext.broadcast(bit_set(short, short.count()))
    long = stored(_locally_frequent(texts.mapInArrow(_long(pairs, longest), key), least, shards), "phrases-long")
    pairs.destroy()
    either = short.union(long)
    candidates = spark.sparkContext.broadcast(bit_set(either, either.count()))
    found = texts.mapInArrow(_exact(candidates, longest), "lang string, phrase string, n long")
    total = found.groupBy("lang", "phrase").agg(F.sum("n").alias("f"))
    counts = stored(total.where((F.col("f") >= least) | F.col("phrase").isNull()), "phrases-all")
    candidates.destroy()
    return counts


def _part(first: int | Column, size: Column) -> Column:
    return F.array_join(F.slice(F.col("w"), first, size), " ")


def _exact_number(c: str | Column, digits: int = 19) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast(f"decimal({digits},0)")


def score_phrases(found: DataFrame) -> DataFrame:
    """(lang, phrase, a, l, r, score) of the phrases of ``frequent_phrases`` with two words or more: the cut of lowest
    score counts, the leftmost of several. All products are exact decimals."""
    counts = found.where("phrase IS NOT NULL")
    phrases = counts.withColumn("w", F.split("phrase", " ")).where(F.size("w") > 1)
    cuts = phrases.withColumn("k", F.explode(F.sequence(F.lit(1), F.size("w") - 1)))
    cuts = cuts.select("lang", "phrase", F.col("f").alias("a"), "k", _part(1, F.col("k")).alias("first"), _part(F.col("k") + 1, F.size("w")).alias("rest"))
    left = counts.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l"))
    right = counts.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r"))
    both = cuts.join(left, ["lang", "first"]).join(right, ["lang", "rest"])
    both = both.withColumn("product", _exact_number("a") * F.lit(2_000_000).cast("decimal(7,0)"))
    both = both.withColumn("score", F.expr("product div (cast(l AS decimal(19,0)) + cast(r AS decimal(19,0)))"))
    best = both.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("best"))
    return best.select("lang", "phrase", "a", "best.l", "best.r", "best.score")


def within_longer(found: DataFrame) -> DataFrame:
    """(lang, phrase, longer): the largest count among the longer phrases that hold it."""
    phrases = found.where("phrase IS NOT NULL").withColumn("w", F.split("phrase", " ")).where(F.size("w") > 2)
    sizes = phrases.withColumn("k", F.explode(F.sequence(F.lit(2), F.size("w") - 1)))
    parts = sizes.withColumn("i", F.explode(F.sequence(F.lit(1), F.size("w") - F.col("k") + 1)))
    return parts.groupBy("lang", _part(F.col("i"), F.col("k")).alias("phrase")).agg(F.max("f").alias("longer"))


def collocations(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, top: int = TOP, covered: int = 80) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's first ``top`` phrases by score, count and bytes, without
    those that a longer phrase holds in ``covered`` percent of their occurrences or more."""
    found = frequent_phrases(docs, least, longest)
    scored = score_phrases(found).join(within_longer(found), ["lang", "phrase"], "left")
    kept = scored.where(F.col("longer").isNull() | (_exact_number("longer") * 100 < _exact_number("a") * covered))
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # each salted part keeps its first rows, so that one language is never sorted as a whole by one task
    part = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(SALTS))).orderBy(*order)
    few = kept.withColumn("rank", F.row_number().over(part)).where(F.col("rank") <= top)
    ranked = few.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    n = found.where("phrase IS NULL").select("lang", F.col("f").alias("n"))
    return ranked.join(n, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
