"""Passages that repeat across documents, found by level-wise doubling of window lengths.

A window of ``words`` words can only repeat if its shorter windows do. Levels start at ``start`` words
and double up to ``words``; windows that repeat at one length alone are looked at on the next,
and the search ends when none is left. On the short levels not every window is counted: each
``words``-window is represented by the short window of least hash in it, which is the same wherever
the ``words``-window occurs. That leaves about 2 / (words - start + 2) of all positions, and misses
nothing. The last level compares 128-bit hashes of all ``words``-windows that are left.

Shuffles. Counts are combined in each chunk of texts and again before the shuffle, so a passage in
a third of all documents is a handful of rows. On the last level each batch settles what repeats
in it, and sends the occurrences of its smallest document alone. The one join that carries a row
for each document of a frequent window is an inner join, which the adaptive planner splits.

Defined results: a word is removed if it lies in a window whose word sequence also starts in a
document with a smaller id; windows are judged on the input. Null, empty and shorter texts keep
all words. Rows with equal ids are one document: they remove nothing from each other. A row with a
null id is compared with nothing and kept whole."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fixedrecon.llm.shared import removed, stored
from fixedrecon.llm.words import chunks, single_spaced, split_words, whole_windows, window_hashes, word_hashes

WORDS, START = 13, 7
#: Seeds of the two independent halves of a window's hash.
SEEDS = (1, 2)


def levels(words: int, start: int) -> list[int]:
    """Lengths before the last: start, twice that, and so on below ``words``."""
    found = []
    while start < words:
        found.append(start)
        start *= 2
    return found


def _least(values: np.ndarray, size: int) -> np.ndarray:
    """The least of each ``size`` consecutive values."""
    n = max(0, len(values) - size + 1)
    least = values[:n]
    for k in range(1, size):
        least = np.minimum(least, values[k : n + k])
    return least


def _known(text: np.ndarray, values: np.ndarray, known: pa.Array | None) -> np.ndarray:
    """Whether each value is among those known of its text; all are where nothing is known."""
    if known is None:
        return np.ones(len(values), dtype=bool)
    ends = np.append(0, np.cumsum(np.diff(known.offsets.to_numpy())))
    flat, inside = known.flatten().to_numpy(zero_copy_only=False).view(np.uint64), np.zeros(len(values), dtype=bool)
    cuts = np.searchsorted(text, np.arange(len(ends)))
    for i in np.flatnonzero(np.diff(ends)).tolist():
        part = slice(cuts[i], cuts[i + 1])
        inside[part] = np.isin(values[part], flat[ends[i] : ends[i + 1]])
    return inside


def _surviving(hashes, words, size: int, total: int, known, known_size: int):
    """(text, anchor of ``size`` words) of each whole ``total``-window whose anchor of the level
    before is known."""
    whole = np.flatnonzero(whole_windows(words, total))
    text = words.text[whole]
    if known is not None:
        before = _least(window_hashes(hashes, known_size), total - known_size + 1)[whole]
        live = _known(text, before, known)
        whole, text = whole[live], text[live]
    return whole, text, _least(window_hashes(hashes, size), total - size + 1)[whole]


def _anchors(docs: DataFrame, size: int, total: int, known_size: int, counted: bool) -> DataFrame:
    """The distinct anchors of each document, or of each chunk with their number of documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            for row, end, data, offsets in chunks(batch.column(1)):
                words = split_words(data, offsets)
                known = batch.column(2).slice(row, end - row) if known_size else None
                _, text, anchor = _surviving(word_hashes(words), words, size, total, known, known_size)
                fresh = np.append(True, (text[1:] != text[:-1]) | (anchor[1:] != anchor[:-1])) if len(text) else []
                text, anchor = text[fresh], anchor[fresh]
                order = np.lexsort((anchor, text))
                text, anchor = text[order], anchor[order]
                fresh = np.append(True, (text[1:] != text[:-1]) | (anchor[1:] != anchor[:-1])) if len(text) else []
                text, anchor = text[fresh], anchor[fresh]
                if counted:
                    values, count = np.unique(anchor, return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(values.view(np.int64)), pa.array(count)], ["anchor", "n"])
                else:
                    owner = ids.slice(row, end - row).take(pa.array(text))
                    yield pa.RecordBatch.from_arrays([pa.array(anchor.view(np.int64)), owner], ["anchor", "doc_id"])

    return docs.mapInArrow(run, "anchor long, n long" if counted else "anchor long, doc_id long")


def _windows(docs: DataFrame, total: int, known_size: int) -> DataFrame:
    """Occurrences of the ``total``-windows left. What a batch settles is a run of window starts to
    remove (pos, n), without hash; of its other windows the smallest document's go on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts: list[tuple[np.ndarray, ...]] = []
            for row, end, data, offsets in chunks(batch.column(2)):
                words = split_words(data, offsets)
                first, second = word_hashes(words, SEEDS[0]), word_hashes(words, SEEDS[1])
                known = batch.column(3).slice(row, end - row) if known_size else None
                place, text, _ = _surviving(word_hashes(words), words, total, total, known, known_size)
                parts.append((
                    window_hashes(first, total)[place], window_hashes(second, total)[place],
                    row + text, place - words.first[text],
                ))
            if not parts:
                continue
            w1, w2, text, pos = (np.concatenate(x) for x in zip(*parts))
            ids = batch.column(0).to_numpy()[text]
            order = np.lexsort((pos, ids, w2, w1))
            w1, w2, text, pos, ids = w1[order], w2[order], text[order], pos[order], ids[order]
            starts = _heads(w1, w2)
            least = np.repeat(ids[starts], np.diff(np.append(starts, len(ids))))
            yield _settled(batch, text[ids > least], pos[ids > least])
            open_ = np.flatnonzero(ids == least)
            yield _unsettled(batch, w1[open_], w2[open_], text[open_], pos[open_])

    return docs.mapInArrow(run, WINDOW_ROWS)


WINDOW_ROWS = "w1 long, w2 long, doc_id long, version long, pos int, more array<int>"
LISTS = pa.list_(pa.int32())


def _heads(*columns: np.ndarray) -> np.ndarray:
    """Where a run of equal rows begins."""
    if not len(columns[0]):
        return np.zeros(0, dtype=np.int64)
    return np.flatnonzero(np.append(True, np.any([c[1:] != c[:-1] for c in columns], axis=0)))


def _window_rows(batch: pa.RecordBatch, w1, w2, text: np.ndarray, pos, more: pa.Array) -> pa.RecordBatch:
    rows = pa.array(text)
    columns = [w1, w2, batch.column(0).take(rows), batch.column(1).take(rows), pos, more]
    return pa.RecordBatch.from_arrays(columns, ["w1", "w2", "doc_id", "version", "pos", "more"])


def _settled(batch: pa.RecordBatch, text: np.ndarray, pos: np.ndarray) -> pa.RecordBatch:
    """One row for each text: the runs (start, number) of windows to remove, in ``more``."""
    order = np.lexsort((pos, text))
    text, pos = text[order], pos[order]
    heads = _heads(text, pos - np.arange(len(pos)))
    runs = np.stack([pos[heads], np.diff(np.append(heads, len(pos)))], axis=1).astype(np.int32).ravel()
    owners, size = np.unique(text[heads], return_counts=True)
    more = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(2 * size)), pa.int32()), pa.array(runs))
    return _window_rows(batch, pa.nulls(len(owners), pa.int64()), pa.nulls(len(owners), pa.int64()), owners, pa.nulls(len(owners), pa.int32()), more)


def _unsettled(batch: pa.RecordBatch, w1, w2, text: np.ndarray, pos: np.ndarray) -> pa.RecordBatch:
    """One row for each window of each text: its first start and, in ``more``, the others. Rows come
    in the order of the texts, in which they are written small."""
    heads = _heads(w1, w2, text)
    size = np.diff(np.append(heads, len(text))) - 1
    order = np.lexsort((pos[heads], text[heads]))
    offsets = np.append(0, np.cumsum(size[order]))
    taken = np.repeat(heads[order] + 1 - offsets[:-1], size[order]) + np.arange(offsets[-1])
    more = pa.ListArray.from_arrays(
        pa.array(offsets, pa.int32(), mask=np.append(size[order] == 0, False)), pa.array(pos[taken].astype(np.int32))
    )
    at = heads[order]
    return _window_rows(batch, pa.array(w1[at].view(np.int64)), pa.array(w2[at].view(np.int64)), text[at], pa.array(pos[at].astype(np.int32)), more)


def repeated_windows(docs: DataFrame, words: int = WORDS, start: int = START, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, version, runs, points): for each document with windows that also start in one of
    smaller id, the starts of such windows: runs (start, number), flattened, and single ones.
    version: a hash of the text, which tells rows of equal ids apart."""
    text = F.col(text_col)
    rows = docs.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("version"), text.alias("text")
    )
    left, known_size, table = rows, 0, None
    for size in levels(words, start):
        plain = left.select("doc_id", "text", *(["known"] if known_size else []))
        often = _anchors(plain, size, words, known_size, True).groupBy("anchor").agg(F.sum("n").alias("n")).where("n > 1")
        found = _anchors(plain, size, words, known_size, False).join(often.select("anchor"), "anchor")
        following = stored(found.groupBy("doc_id").agg(F.collect_set("anchor").alias("known")), "anchors")
        if table is not None:
            removed(table)
        table, known_size = following, size
        left = rows.join(table, "doc_id")
    windows = stored(_windows(left, words, known_size), "windows")
    rank = F.rank().over(Window.partitionBy("w1", "w2").orderBy("doc_id"))
    later = windows.where("w1 IS NOT NULL").withColumn("rank", rank).where("rank > 1")
    none = F.array().cast("array<int>")
    points = F.concat(F.array("pos"), F.coalesce("more", none))
    settled = windows.where("w1 IS NULL").select("doc_id", "version", F.col("more").alias("runs"), none.alias("points"))
    starts = later.select("doc_id", "version", none.alias("runs"), points.alias("points")).union(settled)
    return starts.groupBy("doc_id", "version").agg(
        F.flatten(F.collect_list("runs")).alias("runs"), F.flatten(F.collect_list("points")).alias("points")
    )


def remove_repeats(docs: DataFrame, words: int = WORDS, start: int = START, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, n_removed, kept, removed) for each row of ``docs``: the words kept, joined
    by one space, and the runs of removed words (first word, word after the last)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, end, data, offsets in chunks(batch.column(1)):
                split = single_spaced(split_words(data, offsets))
                edges = np.zeros(len(split.start) + 1, dtype=np.int64)
                runs, points = (batch.column(c).slice(row, end - row) for c in (2, 3))
                for i in np.flatnonzero(runs.is_valid()).tolist():
                    pairs = np.array(runs[i].as_py(), dtype=np.int64).reshape(-1, 2)
                    ones = np.array(points[i].as_py(), dtype=np.int64)
                    begin = np.concatenate((pairs[:, 0], ones)) + split.first[i]
                    size = np.concatenate((pairs[:, 1], np.ones_like(ones))) + words - 1
                    np.add.at(edges, begin, 1)
                    np.add.at(edges, begin + size, -1)
                gone, raw, kept, cut = np.cumsum(edges[:-1]) > 0, split.data.tobytes(), [], []
                ends, starts = split.end, split.start
                for a, b in zip(split.first[:-1].tolist(), split.first[1:].tolist()):
                    change = np.flatnonzero(np.diff(np.concatenate(([1], gone[a:b], [1])))).reshape(-1, 2)
                    kept.append(b" ".join([raw[starts[a + s] : ends[a + e - 1]] for s, e in change.tolist()]))
                    away = np.flatnonzero(np.diff(np.concatenate(([0], gone[a:b], [0])))).reshape(-1, 2)
                    cut.append([{"s": s, "e": e} for s, e in away.tolist()])
                total = np.append(0, np.cumsum(gone))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(row, end - row),
                        pa.array(split.counts.astype(np.int64)),
                        pa.array(total[split.first[1:]] - total[split.first[:-1]]),
                        pa.array(kept, pa.binary()).cast(pa.string()),
                        pa.array(cut, pa.list_(pa.struct([("s", pa.int64()), ("e", pa.int64())]))),
                    ],
                    ["doc_id", "n_words", "n_removed", "kept", "removed"],
                )

    found = stored(repeated_windows(docs, words, start, id_col, text_col), "repeats")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    rows = rows.withColumn("version", F.xxhash64("text"))
    joined = rows.join(found, ["doc_id", "version"], "left").select("doc_id", "text", "runs", "points")
    return joined.mapInArrow(run, "doc_id long, n_words long, n_removed long, kept string, removed array<struct<s:long,e:long>>")
