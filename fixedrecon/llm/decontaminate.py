"""Benchmark passages in documents, by Wu-Manber search over words.

Symbols are words, a block is two of them (one, for patterns of one word). Patterns are the windows
of ``window`` consecutive words of a benchmark item, or the whole of a shorter item; those of one
length share a table. The shift table says for the hash of a block how far the search may go on
without missing a pattern; a block of no pattern skips all but one word of a window. A shift of zero
points to the bucket of the patterns that end with this block. Their window hash singles out
the candidates, and their bytes, compared with the document's, decide.

Up to ``table_bytes`` of benchmark text, measured before, the table is sent to the executors. It is a few flat arrays:
words' bytes, positions, hashes. Of a larger benchmark nothing grows with it on the driver or in a broadcast:
its windows are a table in the shared folder, and three bit sets of at most 64 MB each say which blocks occur, which
end a pattern (shift zero) and which window hashes exist. One pass over the documents finds the candidate windows
with them; only these, with a digest of the text instead of the text, are joined with the patterns on their
words. The result is the same, since whatever the bit sets let through is compared.

Defined results: null and wordless texts have no words, no hits and no items; an item without words
has no pattern; an item with a null id marks words but is not listed; equal items are all listed;
rows of ``docs`` with equal or null ids stay rows of their own, whatever the size of the benchmark."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fixedrecon.llm.arrays import BitSet, bit_set, strings
from fixedrecon.llm.shared import lean, stored
from fixedrecon.llm.words import ALPHANUMERIC, STEP, Words, chunks, mixed, single_spaced, split_words, word_hashes

WINDOW, TABLE_BYTES, LANE, ROWS = 10, 4 << 20, 256, 1 << 16
_PAIR = np.uint64(0xD6E8FEB86659FD93)


def _ranges(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """first[0], first[0] + 1, ... (size[0] numbers), first[1], ..."""
    return np.repeat(first - np.cumsum(size) + size, size) + np.arange(size.sum())


class PatternTable:
    """Patterns of one length in words. Equal windows are one pattern with several owners."""

    def __init__(self, length: int, words: Words, hashes: np.ndarray, first: np.ndarray, owner: np.ndarray) -> None:
        """first: number of the first word of each window; owner: number of its item."""
        self.length, self.block, self.raw = length, min(2, length), words.data.tobytes()
        whole = mixed(sum_hashes(hashes, first, length))
        suffix = _block_at(hashes, first + length - 1, self.block)
        order = np.lexsort((owner, whole, suffix))
        first, whole, suffix, owner = first[order], whole[order], suffix[order], owner[order]
        start, end = words.start[first], words.end[first + length - 1]
        new = np.ones(len(first), dtype=bool)
        new[1:] = (whole[1:] != whole[:-1]) | (suffix[1:] != suffix[:-1])
        pattern = np.cumsum(new) - 1
        lead = np.flatnonzero(new)[pattern]
        other = [i for i in np.flatnonzero(~new).tolist() if self.raw[start[i] : end[i]] != self.raw[start[lead[i]] : end[lead[i]]]]
        for p in np.unique(pattern[np.array(other, dtype=int)]).tolist():  # equal hashes of different words: patterns side by side
            at = np.flatnonzero(pattern == p)
            texts = [self.raw[s:e] for s, e in zip(start[at].tolist(), end[at].tolist())]
            by_text = sorted(range(len(at)), key=lambda i: (texts[i], owner[at[i]]))
            new[at] = [k == 0 or texts[i] != texts[by_text[k - 1]] for k, i in enumerate(by_text)]
            for x in (first, owner, start, end):
                x[at] = x[at[by_text]]
        self.start, self.end, self.whole, self.suffix = start[new], end[new], whole[new], suffix[new]
        keep = np.ones(len(owner), dtype=bool)  # an item that holds the pattern twice owns it once
        keep[1:] = new[1:] | (owner[1:] != owner[:-1])
        self.owner = owner[keep].astype(np.int32)
        self.owned = np.append(np.flatnonzero(new[keep]), len(self.owner))
        size = 1 << max(12, int(len(first) * 8 - 1).bit_length())
        self.slot, blocks = np.uint64(size - 1), length - self.block + 1
        self.shift = np.full(size, blocks, dtype=np.uint8)
        for k in range(blocks):
            np.minimum.at(self.shift, _block_at(hashes, first + k + self.block - 1, self.block) & self.slot, np.uint8(blocks - 1 - k))

    def shifts(self, block: np.ndarray) -> np.ndarray:
        return self.shift[block & self.slot]

    def owners(self, pattern: int) -> list[int]:
        return self.owner[self.owned[pattern] : self.owned[pattern + 1]].tolist()

    def search(self, words: Words, hashes: np.ndarray, raw: bytes) -> tuple[np.ndarray, np.ndarray]:
        """(first word, pattern) of every occurrence."""
        first, block, target = candidates(words, hashes, self.length, self.shifts)
        low, high = np.searchsorted(self.suffix, block, "left"), np.searchsorted(self.suffix, block, "right")
        place, stop = low, high
        while (open_ := place < stop).any():  # within the bucket, patterns stand by the hash of the whole window
            middle = (place + stop) >> 1
            less = open_ & (self.whole[np.minimum(middle, len(self.whole) - 1)] < target)
            place, stop = np.where(less, middle + 1, place), np.where(open_ & ~less, middle, stop)
        found, patterns = [], []
        while len(place):
            likely = (place < high) & (self.whole[np.minimum(place, len(self.whole) - 1)] == target)
            first, place, high, target = first[likely], place[likely], high[likely], target[likely]
            spans = zip(words.start[first].tolist(), words.end[first + self.length - 1].tolist(), self.start[place].tolist(), self.end[place].tolist())
            same = np.fromiter((raw[s:e] == self.raw[a:b] for s, e, a, b in spans), dtype=bool, count=len(first))
            found.append(first[same])
            patterns.append(place[same])
            first, place, high, target = first[~same], place[~same] + 1, high[~same], target[~same]
        return np.concatenate([np.zeros(0, int), *found]), np.concatenate([np.zeros(0, int), *patterns])


def sum_hashes(hashes: np.ndarray, first: np.ndarray, length: int) -> np.ndarray:
    total = np.zeros(len(first), dtype=np.uint64)
    for k in range(length):
        total = total * STEP + hashes[first + k]
    return total


def _block_at(hashes: np.ndarray, last: np.ndarray, block: int) -> np.ndarray:
    """Hash of the block of words that ends at each of ``last``."""
    return hashes[last] if block == 1 else mixed(hashes[last - 1] * _PAIR + hashes[last])


def candidates(words: Words, hashes: np.ndarray, length: int, shifts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first word, hash of the last block, hash of the window) where the shift is zero, of windows within one text. Words
    are cut into lanes, searched side by side."""
    n, back, block = len(hashes), length - 1, min(2, length)
    ends = np.arange(0, n, LANE)
    place, stop = np.maximum(ends, back), np.minimum(ends + LANE, n)
    place, stop = place[place < stop], stop[place < stop]
    found = [np.zeros(0, int)]
    while len(place):
        shift = shifts(_block_at(hashes, place, block))
        found.append(place[shift == 0])
        place = place + np.maximum(shift, 1)
        live = place < stop
        place, stop = place[live], stop[live]
    last, text = np.concatenate(found), words.text
    last = last[text[last - back] == text[last]]
    return last - back, _block_at(hashes, last, block), mixed(sum_hashes(hashes, last - back, length))


def _split(data: np.ndarray, offsets: np.ndarray) -> Words:
    return single_spaced(split_words(data, offsets, ALPHANUMERIC, lower=True))


def _windows(counts: np.ndarray, first: np.ndarray, window: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length in words, first words, texts) of the patterns of each length."""
    size = np.minimum(counts, window)
    for length in np.unique(size[size > 0]).tolist():
        items = np.flatnonzero(size == length)
        number = counts[items] - length + 1
        yield length, _ranges(first[items], number), np.repeat(items, number)


def pattern_tables(texts: list[str | None] | pa.Array | pa.ChunkedArray, window: int = WINDOW) -> list[PatternTable]:
    """A table for each length of pattern among the items; items are numbered as listed."""
    column = pa.array(texts, pa.large_string()) if isinstance(texts, list) else texts.cast(pa.large_string())
    tables = []
    for _, _, data, offsets in chunks(column, 1 << 62):
        words = _split(data, offsets)
        hashes = word_hashes(words)
        for length, first, owner in _windows(words.counts, words.first[:-1], window):
            tables.append(PatternTable(length, words, hashes, first, owner))
    return tables


def _runs(covered: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edge = np.diff(np.concatenate(([0], covered.astype(np.int8), [0])))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def _hits(column: pa.Array, tables: list[PatternTable]):
    """For each chunk: first row, end row, words, whether each word is hit, items of each row."""
    for row, end, data, offsets in chunks(column):
        words = _split(data, offsets)
        hashes, raw, text = word_hashes(words), words.data.tobytes(), words.text
        edges, items = np.zeros(len(hashes) + 1, dtype=np.int64), [set() for _ in range(end - row)]
        for table in tables:
            first, pattern = table.search(words, hashes, raw)
            np.add.at(edges, first, 1)
            np.add.at(edges, first + table.length, -1)
            for t, p in zip(text[first].tolist(), pattern.tolist()):
                items[t].update(table.owners(p))
        yield row, end, words, np.cumsum(edges[:-1]) > 0, items


SPANS = pa.list_(pa.struct([("s", pa.int64()), ("e", pa.int64())]))
FOUND = "doc_id long, n_words long, spans array<struct<s:long,e:long>>, items array<string>"


def _search_table(rows: DataFrame, texts: pa.ChunkedArray, names: list[str | None], window: int) -> DataFrame:
    """The result for ``rows`` (doc_id, text) by one table of patterns."""
    sent = rows.sparkSession.sparkContext.broadcast((pattern_tables(texts, window), names))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables, names = sent.value
        for batch in batches:
            for row, end, words, covered, items in _hits(batch.column(1), tables):
                spans, listed = [], []
                for a, b, found in zip(words.first[:-1].tolist(), words.first[1:].tolist(), items):
                    s, e = _runs(covered[a:b]) if found else ((), ())
                    spans.append([{"s": int(x), "e": int(y)} for x, y in zip(s, e)])
                    listed.append(sorted({names[i] for i in found if names[i] is not None}))
                columns = [
                    batch.column(0).slice(row, end - row), pa.array(words.counts.astype(np.int64)),
                    pa.array(spans, SPANS), pa.array(listed, pa.list_(pa.string())),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "spans", "items"])

    return rows.mapInArrow(lean(run), FOUND)


def _items(benchmark: DataFrame, table_bytes: int) -> tuple[DataFrame, pa.Table | None]:
    """(name, passage) of the benchmark, and its rows on the driver if they hold ``table_bytes`` of text at most."""
    items = benchmark.select(F.col("item_id").cast("string").alias("name"), F.col("text").alias("passage"))
    small = items.agg(F.coalesce(F.sum(F.octet_length("passage") + F.coalesce(F.octet_length("name"), F.lit(0)) + 16), F.lit(0))).first()[0] <= table_bytes
    return items, items.where("passage IS NOT NULL").orderBy("name", "passage").toArrow() if small else None


PATTERNS = "digest binary, length long, window string, hash long, blocks array<long>, suffix long"


def _pattern_rows(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, _, data, offsets in chunks(batch.column(1)):
                words = _split(data, offsets)
                hashes = word_hashes(words)
                for length, first, owner in _pieces(_windows(words.counts, words.first[:-1], window)):
                    block = min(2, length)
                    blocks = [_keyed(_block_at(hashes, first + k, block), length) for k in range(block - 1, length)]
                    edges = np.arange(0, len(first) * len(blocks) + 1, len(blocks), dtype=np.int32)
                    columns = [
                        batch.column(0).take(pa.array(row + owner)), pa.array(np.full(len(first), length)),
                        strings(words.data, words.start[first], words.end[first + length - 1]).cast(pa.string()),
                        pa.array(_keyed(mixed(sum_hashes(hashes, first, length)), length).view(np.int64)),
                        pa.ListArray.from_arrays(pa.array(edges), pa.array(np.stack(blocks, axis=1).ravel().view(np.int64))),
                        pa.array(blocks[-1].view(np.int64)),
                    ]
                    yield pa.RecordBatch.from_arrays(columns, ["digest", "length", "window", "hash", "blocks", "suffix"])

    return run


def _pieces(windows: Iterator[tuple[int, np.ndarray, np.ndarray]]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    for length, first, owner in windows:
        for at in range(0, len(first), ROWS):
            yield length, first[at : at + ROWS], owner[at : at + ROWS]


def _keyed(hashes: np.ndarray, length: int) -> np.ndarray:
    return mixed(hashes + np.uint64(length))


def _distinct_set(patterns: DataFrame, key: Column) -> BitSet:
    keys = patterns.select(key.alias("key")).distinct()
    return bit_set(keys, keys.count())


def _candidate_rows(rows: DataFrame, patterns: DataFrame) -> DataFrame:
    """(doc_id, digest, n_words, windows) for each row of (doc_id, digest, text): windows that may be patterns."""
    lengths = sorted(r["length"] for r in patterns.select("length").distinct().collect())  # one for each length up to the window
    sets = [_distinct_set(patterns, c) for c in (F.explode("blocks"), F.col("suffix"), F.col("hash"))]
    sent = rows.sparkSession.sparkContext.broadcast((lengths, sets))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths, (blocks, suffixes, wholes) = sent.value

        def shifts(length: int):
            def look(block: np.ndarray) -> np.ndarray:
                keys, most = _keyed(block, length), length - min(2, length) + 1
                return np.where(suffixes.holds(keys), 0, np.where(blocks.holds(keys), 1, most))

            return look

        for batch in batches:
            for row, end, data, offsets in chunks(batch.column(2)):
                words = _split(data, offsets)
                hashes, found = word_hashes(words), []
                for length in lengths:
                    first, _, whole = candidates(words, hashes, length, shifts(length))
                    first = first[wholes.holds(_keyed(whole, length))]
                    found.append(np.stack([first, np.full(len(first), length)]))
                first, length = np.concatenate([np.zeros((2, 0), np.int64), *found], axis=1)
                order = np.argsort(first, kind="stable")
                first, length, text = first[order], length[order], words.text
                edges = np.searchsorted(text[first], np.arange(end - row + 1)).astype(np.int32)
                window = strings(words.data, words.start[first], words.end[first + length - 1]).cast(pa.string())
                parts = [pa.array(first - words.first[:-1][text[first]]), pa.array(length), window]
                listed = pa.ListArray.from_arrays(pa.array(edges), pa.StructArray.from_arrays(parts, ["first", "length", "window"]))
                columns = [batch.column(i).slice(row, end - row) for i in (0, 1)]
                columns += [pa.array(words.counts.astype(np.int64)), listed]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "digest", "n_words", "windows"])

    schema = "doc_id long, digest binary, n_words long, windows array<struct<first:long,length:long,window:string>>"
    return rows.mapInArrow(lean(run), schema)


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Windows of a text as runs of hit words."""
    for batch in batches:
        spans = []
        for places in batch.column(1).to_pylist():
            runs: list[dict[str, int]] = []
            for x in sorted(places, key=lambda x: x["first"]):
                if runs and x["first"] <= runs[-1]["e"]:
                    runs[-1]["e"] = max(runs[-1]["e"], x["first"] + x["length"])
                else:
                    runs.append({"s": x["first"], "e": x["first"] + x["length"]})
            spans.append(runs)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, SPANS), batch.column(2)], ["digest", "spans", "items"])


def _digest(text: str) -> Column:
    return F.unhex(F.sha2(F.coalesce(F.col(text), F.lit("")).cast("binary"), 256))


def _search_join(rows: DataFrame, items: DataFrame, window: int) -> tuple[DataFrame, DataFrame]:
    """For (doc_id, text): (doc_id, digest, n_words) of each row, and (digest, spans, items) of each text with a hit.
    Equal texts are joined once, equal items have their windows once, and a window met by many texts is split by the
    adaptive planner, as it can for this join."""
    items = items.where("passage IS NOT NULL").withColumn("digest", _digest("passage"))
    texts = items.groupBy("digest").agg(F.first("passage").alias("passage"))
    patterns = stored(texts.mapInArrow(_pattern_rows(window), PATTERNS), "patterns")
    found = stored(_candidate_rows(rows.select("doc_id", _digest("text").alias("digest"), "text"), patterns), "windows")
    places = found.where("size(windows) > 0").select("digest", F.explode("windows").alias("x")).select("digest", "x.*").distinct()
    hits = stored(
        places.join(patterns.select("window", F.col("digest").alias("item")).distinct(), "window").select("digest", "first", "length", "item"), "hits"
    )
    spans = hits.select("digest", "first", "length").distinct().groupBy("digest").agg(F.collect_list(F.struct("first", "length")).alias("spans"))
    owners = items.where("name IS NOT NULL").select(F.col("digest").alias("item"), "name").distinct()
    names = hits.select("digest", "item").distinct().join(owners, "item").groupBy("digest").agg(F.sort_array(F.collect_set("name")).alias("items"))
    listed = F.coalesce("items", F.array().cast("array<string>")).alias("items")
    schema = "digest binary, spans array<struct<s:long,e:long>>, items array<string>"
    return found.drop("windows"), spans.join(names, "digest", "left").select("digest", "spans", listed).mapInArrow(_merged, schema)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, table_bytes: int = TABLE_BYTES, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` in whose text no window of the benchmark occurs. With a benchmark beyond ``table_bytes`` the
    rows are matched with the texts to drop by their digest, and are not written anywhere."""
    items, small = _items(benchmark, table_bytes)
    if small is None:
        _, hits = _search_join(docs.select(F.lit(None).cast("long").alias("doc_id"), F.col(text_col).alias("text")), items, window)
        name = "digest__hit"
        while name in {c.lower() for c in docs.columns}:
            name += "_"
        return docs.join(hits.select(F.col("digest").alias(name)), _digest(text_col) == F.col(name), "left_anti")
    at = docs.columns.index(text_col)
    sent = docs.sparkSession.sparkContext.broadcast(pattern_tables(small["passage"], window))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hit = np.zeros(batch.num_rows, dtype=bool)
            for row, _, words, covered, _ in _hits(batch.column(at), sent.value):
                hit[row + np.unique(words.text[covered])] = True
            yield batch.filter(pa.array(~hit))

    return docs.mapInArrow(lean(run), docs.schema)


def find_passages(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, table_bytes: int = TABLE_BYTES,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """(doc_id, n_words, spans, items) for each row of ``docs``: runs of hit words (first word, word
    after the last) and the ids, as sorted strings, of the items with an occurrence."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    items, small = _items(benchmark, table_bytes)
    if small is not None:
        return _search_table(rows, small["passage"], small["name"].to_pylist(), window)
    found, hits = _search_join(rows, items, window)
    none = (F.array().cast("array<struct<s:long,e:long>>"), F.array().cast("array<string>"))
    spans, listed = (F.coalesce(c, e).alias(c) for c, e in zip(("spans", "items"), none))
    return found.join(hits, "digest", "left").select("doc_id", "n_words", spans, listed)


def n_hit(spans: Column) -> Column:
    return F.aggregate(spans, F.lit(0).cast("long"), lambda total, x: total + x["e"] - x["s"])
