"""Quality selection by importance resampling.

Two generative models over hashed word n-grams (single words and pairs, ``BUCKETS`` buckets): one of
the target text, one of the raw text. A document's weight is the log ratio of its probability
under the two, summed over its n-grams. Gumbel noise, drawn from a hash of the id and a seed, is
added, and the documents with the ``k`` highest sums are taken: that samples ``k`` documents without
replacement in proportion to their weights.

The raw model counts all documents. The target model counts the target texts among them, which are
named by at most ``TARGETS`` ids (a bounded sample by a hash, hence a bounded broadcast).
Counts are summed in each task first; the two models are ``BUCKETS`` numbers each. The k-th highest
sum is found by counting in bins and narrowing them, so nothing is sorted or gathered.

Defined results: a null, empty or wordless text has weight 0; ties on the sum are broken by the
id, then nothing: rows with equal ids and texts are taken or left together, and count each. A null id draws the
noise of the number 0; without any target or document the weights are 0."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fixedrecon.llm.shared import stored
from fixedrecon.llm.words import chunks, split_words, whole_windows, window_hashes, word_hashes

BUCKETS, TARGETS, SEED = 1 << 14, 20_000, 17
BINS = 1024


def ngram_buckets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text, bucket) of every word and word pair."""
    words = split_words(data, offsets, lower=True)
    hashes = word_hashes(words)
    pairs = whole_windows(words, 2)
    text = words.text
    both = np.concatenate((hashes, window_hashes(hashes, 2)[pairs]))
    owner = np.concatenate((text, text[: len(pairs)][pairs]))
    return owner, (both % np.uint64(BUCKETS)).astype(np.int64)


def _counts(docs: DataFrame) -> DataFrame:
    """(bucket, raw, target) summed over documents with the columns (target, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, BUCKETS), dtype=np.int64)
        for batch in batches:
            target = batch.column(0).to_numpy(zero_copy_only=False)
            for row, end, data, offsets in chunks(batch.column(1)):
                owner, bucket = ngram_buckets(data, offsets)
                total[0] += np.bincount(bucket, minlength=BUCKETS)
                total[1] += np.bincount(bucket[target[row:end][owner]], minlength=BUCKETS)
        columns = [pa.array(np.arange(BUCKETS)), pa.array(total[0]), pa.array(total[1])]
        yield pa.RecordBatch.from_arrays(columns, ["bucket", "raw", "target"])

    found = docs.mapInArrow(run, "bucket long, raw long, target long")
    return found.groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))


def target_ids(labels: DataFrame, quality_col: str = "quality", id_col: str = "doc_id", most: int = TARGETS) -> DataFrame:
    """(doc_id): at most ``most`` ids of good documents, those of least hash."""
    good = labels.where((F.col(quality_col) == 1) & F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("doc_id")).distinct()
    return good.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)


def fit(docs: DataFrame, targets: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> np.ndarray:
    """Log ratio of target to raw probability of each bucket, with one count added to each."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    marked = F.broadcast(targets.select("doc_id").withColumn("target", F.lit(True)))  # TARGETS ids at most
    flagged = rows.join(marked, "doc_id", "left").select(F.coalesce("target", F.lit(False)).alias("target"), "text")
    raw, target = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for r in _counts(flagged).collect():  # a row for each bucket
        raw[r["bucket"]], target[r["bucket"]] = r["raw"], r["target"]
    if not target.sum():
        return np.zeros(BUCKETS)
    return np.log((target + 1) / (target.sum() + BUCKETS)) - np.log((raw + 1) / (raw.sum() + BUCKETS))


def weigh(docs: DataFrame, ratio: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, log_weight) for each row of ``docs``."""
    sent = docs.sparkSession.sparkContext.broadcast(ratio)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, end, data, offsets in chunks(batch.column(1)):
                owner, bucket = ngram_buckets(data, offsets)
                weight = np.bincount(owner, weights=sent.value[bucket], minlength=end - row).astype(float)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(row, end - row), pa.array(weight)], ["doc_id", "log_weight"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_id long, log_weight double")


def gumbel(doc_id: Column, seed: int = SEED) -> Column:
    """Gumbel noise drawn from the id: -log(-log(u))."""
    u = (F.pmod(F.xxhash64(F.coalesce(doc_id, F.lit(0)), F.lit(seed)), F.lit(1 << 52)) + 0.5) / float(1 << 52)
    return -F.log(-F.log(u))


def kth_highest(rows: DataFrame, k: int, value_col: str = "sample_key") -> float | None:
    """The k-th highest value, exactly; None if there are fewer rows or k is 0. Each round counts the
    rows in ``BINS`` bins of the range that holds it, down to a range of one value."""
    value = F.col(value_col)
    low, high, n = rows.agg(F.min(value), F.max(value), F.count(value)).first()
    if k < 1 or n < k:
        return None
    above = 0
    while low < high:
        width = (high - low) / BINS
        if low + width == low:  # neighbouring numbers: few values are left
            for v, c in sorted(rows.where(value.between(low, high)).groupBy(value).count().collect(), reverse=True):
                above += c
                if above >= k:
                    return v
        slot = F.least(F.floor((value - low) / width), F.lit(BINS - 1))
        found = rows.where(value.between(low, high)).groupBy(slot.alias("slot")).agg(F.count("*").alias("n"), F.min(value).alias("low"), F.max(value).alias("high"))
        for r in sorted(found.collect(), key=lambda r: -r["slot"]):  # BINS rows at most
            if above + r["n"] >= k:
                low, high = r["low"], r["high"]
                break
            above += r["n"]
    return low


def resample(
    docs: DataFrame, targets: DataFrame, share: float, seed: int = SEED, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, log_weight, sample_key, selected): ``share`` of the rows (rounded) selected; rows that
    tie with the last of them on the key as well."""
    weights = weigh(docs, fit(docs, targets, id_col, text_col), id_col, text_col)
    keyed = stored(weights.withColumn("sample_key", F.col("log_weight") + gumbel(F.col("doc_id"), seed)), "weights")
    least = kth_highest(keyed, round(share * keyed.count()))
    return keyed.withColumn("selected", F.lit(False) if least is None else F.col("sample_key") >= F.lit(least))
