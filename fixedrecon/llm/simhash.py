"""Near-duplicates by SimHash fingerprints and a Gray-order hierarchical index.

A fingerprint has 64 bits, each the majority of that bit over the hashes of the text's word
shingles. Two texts link when their fingerprints differ in at most ``distance`` bits.

Partitioning. 64 bits are cut into ``distance + 2`` blocks. Two fingerprints within the distance
agree on at least two whole blocks, so each pair meets in the group of some two blocks and of
their bits, and pairs in no common group need no look. Only *distinct* fingerprints are dealt
out, so thousands of copies weigh as much as one text. A group of more than ``GROUP`` fingerprints is cut
into chunks by their hash, and every two chunks are searched as a group of their own, so a task holds at most
about two chunks of a group, however frequent its bits are, and no pair is left out.

Index. In a group the fingerprints are sorted by Gray rank, which puts those of few differing bits
side by side. Runs of them form leaves, runs of leaves form nodes. A node holds the bits on which
all below it agree; the part that its parent holds already is left out. A search goes down from
the top, adds up the differences on each node's own bits and drops the node with all below it
beyond the distance. A node whose members are all in the searching fingerprint's component is
dropped as well: only components are wanted, and dense groups so take linear time.

Defined results: a null, empty or wordless text has fingerprint zero and links like any other;
equal texts share a fingerprint and hence a component; a row with a null id keeps its row and fingerprint, but links
to nothing and has a null component."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fixedrecon.llm.components import components
from fixedrecon.llm.shared import lean, stored
from fixedrecon.llm.words import chunks, single_spaced, split_words

DISTANCE, SHINGLE, SEED = 4, 4, 42
LEAF, FAN, STEP = 16, 8, 512
GROUP, SALTS = 20_000, 64  # fingerprints searched as one group; parts in which a key is counted
CHUNK = 1 << 19  # bytes of texts at a time: a shingle takes some 150 bytes beside them


def chunk_fingerprints(data: np.ndarray, offsets: np.ndarray, shingle: int = SHINGLE) -> np.ndarray:
    """Fingerprints (uint64) of the texts of one chunk."""
    words = single_spaced(split_words(data, offsets, lower=True))
    count = words.counts
    shingles = np.where(count > 0, np.maximum(count - shingle + 1, 1), 0)
    owner = np.repeat(np.arange(len(count)), shingles)
    within = np.arange(len(owner)) - np.repeat(np.cumsum(shingles) - shingles, shingles)
    first = words.first[:-1][owner] + within
    last = first + np.minimum(count, shingle)[owner] - 1
    raw = words.data.tobytes()
    hashes = np.fromiter(
        (xxhash.xxh64_intdigest(raw[s:e], SEED) for s, e in zip(words.start[first].tolist(), words.end[last].tolist())),
        dtype=np.uint64,
        count=len(first),
    )
    bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    result = np.zeros(len(count), dtype=np.uint64)
    some = np.flatnonzero(shingles)
    if len(some):
        starts = (np.cumsum(shingles) - shingles)[some]
        sums = np.add.reduceat(bits, starts, axis=0, dtype=np.int32)
        major = 2 * sums > shingles[some][:, None]
        result[some] = np.packbits(major, axis=1, bitorder="little").view("<u8").ravel()
    return result


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp): one row for each row of ``docs``; ``fp`` holds the 64 bits as a long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [chunk_fingerprints(d, o, shingle) for _, _, d, o in chunks(batch.column(1), CHUNK)]
            found = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], ["doc_id", "fp"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(lean(run), "doc_id long, fp long")


def gray_rank(values: np.ndarray) -> np.ndarray:
    """Place of each value in the order in which neighbours differ in one bit."""
    rank = values.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


class GrayIndex:
    """The hierarchical index over ``values`` (uint64), which are in Gray order."""

    def __init__(self, values: np.ndarray) -> None:
        self.values = values
        self.levels: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # starts, pattern, agreed bits
        starts, low, high = np.arange(len(values)), values, values
        while not self.levels or len(starts) > FAN:
            cut = np.arange(0, len(starts), LEAF if not self.levels else FAN)
            low, high = np.bitwise_and.reduceat(low, cut), np.bitwise_or.reduceat(high, cut)
            starts = starts[cut]
            self.levels.append((starts, low, ~(low ^ high)))

    def linked(self, distance: int) -> np.ndarray:
        """For each value the smallest place in its component of values within the distance."""
        label, n, done, step = np.arange(len(self.values)), len(self.values), 0, 1
        while done < n:
            step = min(2 * step, STEP)
            query = np.arange(done, min(n, done + step))
            label = _joined(label, *self._search(query, label, distance))
            done += step
        return label

    def _search(self, query: np.ndarray, label: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
        """Links (query, place) from each query to later places of other components."""
        n, top = len(self.values), len(self.levels) - 1
        node = np.tile(np.arange(len(self.levels[top][0])), len(query))
        query = np.repeat(query, len(self.levels[top][0]))
        differs, known = np.zeros(len(query), np.uint8), np.zeros(len(query), np.uint64)
        for level in range(top, -1, -1):
            starts, pattern, agreed = self.levels[level]
            ends = np.append(starts[1:], n)
            differs = differs + np.bitwise_count((self.values[query] ^ pattern[node]) & agreed[node] & ~known)
            least, most = np.minimum.reduceat(label, starts), np.maximum.reduceat(label, starts)
            same = (least == most)[node] & (least[node] == label[query])
            live = (differs <= distance) & ~same & (ends[node] > query)
            query, node, differs, known = query[live], node[live], differs[live], agreed[node[live]]
            fan = FAN if level else LEAF
            below = len(self.levels[level - 1][0]) if level else n
            node = (node[:, None] * fan + np.arange(fan)).ravel()
            query, differs, known = (np.repeat(x, fan) for x in (query, differs, known))
            inside = node < below
            query, node, differs, known = query[inside], node[inside], differs[inside], known[inside]
        differs = differs + np.bitwise_count((self.values[query] ^ self.values[node]) & ~known)
        near = (differs <= distance) & (node > query)
        return query[near], node[near]


def _joined(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels after the links (a, b): always the smallest place of a component."""
    while True:
        x, y = label[a], label[b]
        apart = x != y
        if not apart.any():
            return label
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        least = np.minimum(x, y)
        label = label.copy()
        np.minimum.at(label, x, least)
        np.minimum.at(label, y, least)
        while (label[label] != label).any():
            label = label[label]


def group_links(key: np.ndarray, fp: np.ndarray, rep: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (larger rep, smaller rep) that connect what is near within each run of equal keys."""
    order = np.lexsort((gray_rank(fp), key))
    key, fp, rep = key[order], fp[order], rep[order]
    starts = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, int)
    size = np.diff(np.append(starts, len(key)))
    label = np.arange(len(key))
    small = np.repeat(size <= LEAF, size)
    place = np.arange(len(key))
    end = np.repeat(starts + size, size)
    for step in range(1, LEAF):  # groups of one leaf: straight comparison
        a = place[small & (place + step < end)]
        if not len(a):
            break
        near = np.bitwise_count(fp[a] ^ fp[a + step]) <= distance
        label = _joined(label, a[near], a[near] + step)
    for s, n in zip(starts[size > LEAF].tolist(), size[size > LEAF].tolist()):
        label[s : s + n] = s + GrayIndex(fp[s : s + n]).linked(distance)
    least = rep.copy()
    np.minimum.at(least, label, rep)
    least = least[label]
    linked = rep != least
    return rep[linked], least[linked]


def block_masks(distance: int) -> list[int]:
    """The bits of every two of ``distance + 2`` blocks, as signed longs."""
    edges = np.linspace(0, 64, distance + 3).astype(int).tolist()
    blocks = [((1 << b) - 1) & ~((1 << a) - 1) for a, b in zip(edges, edges[1:])]
    return [int(np.array([x | y], dtype=np.uint64).view(np.int64)[0]) for x, y in combinations(blocks, 2)]


def in_groups(distinct: DataFrame, distance: int = DISTANCE, group: int = GROUP) -> DataFrame:
    """(key, fp, rep): every distinct fingerprint once for each two blocks, with the key of its group. In a group of more
    than ``group`` rows each has a chunk and a copy for every other chunk; the two chunks make the key.

    Rows of a key are counted in parts, so that a frequent key is met by many tasks; only keys above the bound
    are joined back. Their table has no broadcast hint: its measured size decides."""
    masks = block_masks(distance)
    tables = F.array(*[F.struct(F.lit(i).cast("long").alias("t"), F.lit(m).alias("mask")) for i, m in enumerate(masks)])
    dealt = (
        distinct.select("fp", "rep", F.explode(tables).alias("x"))
        .select(F.xxhash64("x.t", F.col("fp").bitwiseAND(F.col("x.mask"))).alias("key"), "fp", "rep")
        .withColumn("salt", F.pmod(F.xxhash64("fp"), F.lit(SALTS)))
    )
    parts = dealt.groupBy("key", "salt").agg(F.count("*").alias("n"))
    crowded = parts.withColumn("n", F.sum("n").over(Window.partitionBy("key"))).where(F.col("n") > group)
    chunks = F.ceil(F.col("n") / F.lit(float(group))).cast("long")
    known = dealt.join(crowded, ["key", "salt"], "left").withColumn("chunk", F.pmod(F.xxhash64("fp", F.lit(1)), chunks))
    others = F.filter(F.sequence(F.lit(0).cast("long"), chunks - 1), lambda c: c != F.col("chunk"))
    pairs = F.transform(others, lambda c: F.xxhash64("key", F.least(c, "chunk"), F.greatest(c, "chunk")))
    return known.select(F.explode(F.coalesce(pairs, F.array("key"))).alias("key"), "fp", "rep")


def near_links(distinct: DataFrame, distance: int = DISTANCE, group: int = GROUP) -> DataFrame:
    """(a, b), a > b: links that connect the ``rep`` of distinct (fp, rep) with near fingerprints."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def links(rows: np.ndarray) -> pa.RecordBatch:
            a, b = group_links(rows[0].view(np.uint64), rows[1].view(np.uint64), rows[2], distance)
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

        for batch in batches:
            rows = np.stack([c.to_numpy() for c in batch.columns])
            held.append(rows)
            change = np.flatnonzero(rows[0, 1:] != rows[0, :-1])
            if len(change):  # all groups but the last are whole
                whole = np.concatenate(held, axis=1)
                cut = whole.shape[1] - rows.shape[1] + int(change[-1]) + 1
                yield links(whole[:, :cut])
                held = [whole[:, cut:]]
        if held:
            yield links(np.concatenate(held, axis=1))

    dealt = in_groups(distinct, distance, group)
    parts = int(dealt.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return dealt.repartition(parts, "key").sortWithinPartitions("key").mapInArrow(lean(run), "a long, b long")


def near_duplicates(
    docs: DataFrame, distance: int = DISTANCE, shingle: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, fp, component_id): each document's fingerprint and the smallest id that can be
    reached from it over links. One row for each row of ``docs``, also for repeated and null ids."""
    prints = stored(fingerprints(docs, shingle, id_col, text_col), "fingerprints")
    distinct = stored(prints.where("doc_id IS NOT NULL").groupBy("fp").agg(F.min("doc_id").alias("rep")), "distinct")
    stars = components(near_links(distinct, distance).distinct())
    classes = distinct.join(stars, distinct.rep == stars.a, "left").select(
        "fp", F.coalesce("b", "rep").alias("component_id")
    )
    component = F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id")
    return prints.join(classes, "fp", "left").select("doc_id", "fp", component)


def keep_rows(docs: DataFrame, distance: int = DISTANCE, shingle: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each near-duplicate component of the rows of ``docs``, with all columns. Rows are told apart by
    a number of their own, so repeated ids join nothing and rows with a null id are documents too. The row of smallest
    id stays (null last), of equal ids that of the smallest hash of the text, then of the whole row."""
    row = "_row_number"
    while row in {c.lower() for c in docs.columns}:
        row += "_"
    rows = stored(docs.withColumn(row, F.monotonically_increasing_id()), "rows")
    found = near_duplicates(rows, distance, shingle, row, text_col).select(F.col("doc_id").alias(row), "component_id")
    place = F.struct(
        F.col(id_col).isNull(), F.col(id_col), F.xxhash64(text_col), F.xxhash64(*docs.columns), F.col(row).alias("row")
    )
    first = rows.select(row, place.alias("place")).join(found, row).groupBy("component_id").agg(F.min("place").alias("place"))
    return rows.join(first.select(F.col("place.row").alias(row)), row).select(*docs.columns)
