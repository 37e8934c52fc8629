"""Token ids as Arrow files of equal-length sequences.

A file is in Arrow's random-access file format. Its batches have two columns of fixed-size lists:
``tokens`` (unsigned, 16 bits where the vocabulary allows, else 32) and ``mask`` (true for a token,
false for padding). Documents follow each other without gaps, each with an end id; the last
sequence of a file is padded. So any sequence is one slice of a memory-mapped buffer, without a
copy. Beside it stands ``<name>.index``, an Arrow file too, with each document's id, first token
and number of tokens.

Documents are dealt out by ranges of their id and sorted within, so files in the order of the
manifest hold ascending ids. A task writes under a name of its own and reports it with its last row;
what a lost or repeated task wrote is in no manifest. The files go to any place that pyarrow's file
systems reach (local, HDFS, object stores).

The tokenizer runs on pieces between blanks, where its own rules always cut, and keeps a bounded
number of their ids; tests hold the result against whole texts. Strings of special tokens in a
text are ordinary text.

Defined results: a null or empty text is the end id alone; equal ids stand side by side, in the
order of their texts; null ids come first."""

from __future__ import annotations

import os
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fixedrecon.llm.shared import shared_folder, stored
from fixedrecon.llm.words import chunks

LENGTH, BATCH, END_ID, KEPT_PIECES = 2048, 256, 2, 400_000
PART_BYTES = 4 << 20
MANIFEST = "file string, first_id long, n_docs long, n_tokens long"
#: White space beside a blank or line end, or of another kind: there the tokenizer's cuts depend on more.
UNEVEN_ASCII = ("  ", " \n", "\n ", "\n\n", "\t", "\r", "\x0b", "\x0c", "\x1c", "\x1d", "\x1e", "\x1f")
UNEVEN_WIDE = re.compile("[\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")


def _uneven(text: str) -> bool:
    if any(x in text for x in UNEVEN_ASCII) or text[:1] in " \n":
        return True
    return not text.isascii() and UNEVEN_WIDE.search(text) is not None


class PieceStore:
    """Ids of pieces in one flat array, each piece with a number, its first place there and its length."""

    def __init__(self) -> None:
        self.number: dict[str, int] = {}
        self.ids, self.first, self.size = np.zeros(1 << 16, np.uint32), np.zeros(1 << 12, np.int64), np.zeros(1 << 12, np.int64)
        self.used = 0

    def add(self, pieces: list[str], ids: np.ndarray, size: np.ndarray) -> None:
        """Pieces that are not in yet, with their ids one after another."""
        at, n = len(self.number), len(pieces)
        while self.used + len(ids) > len(self.ids):
            self.ids = np.concatenate((self.ids, np.zeros_like(self.ids)))
        while at + n > len(self.first):
            self.first, self.size = (np.concatenate((x, np.zeros_like(x))) for x in (self.first, self.size))
        self.ids[self.used : self.used + len(ids)] = ids
        self.size[at : at + n] = size
        self.first[at : at + n] = self.used + np.cumsum(size) - size
        self.used += len(ids)
        self.number.update(zip(pieces, range(at, at + n)))

    def places(self, pieces: list[str]) -> np.ndarray:
        """Numbers of the pieces, -1 for those that are not in."""
        return np.fromiter(map(self.number.get, pieces, repeat(-1)), np.int64, len(pieces))


def _gathered(ids: np.ndarray, first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The ranges of ``ids`` one after another."""
    end = np.cumsum(size)
    return ids[np.repeat(first - end + size, size) + np.arange(end[-1] if len(end) else 0)]


class PieceEncoder:
    """Ids of whole texts by the tokenizers library. Cuts texts before a lone blank or line end, encodes each distinct
    piece of a batch once and gathers the ids of all pieces."""

    _made: dict[str, PieceEncoder] = {}

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.kept, self.older = PieceStore(), PieceStore()

    @classmethod
    def of(cls, path: str) -> PieceEncoder:
        """One encoder for a worker process."""
        if path not in cls._made:
            cls._made[path] = cls(path)
        return cls._made[path]

    def whole(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the texts one after another, and how many each has."""
        found = [x.ids for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        size = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter(chain.from_iterable(found), np.uint32, int(size.sum())), size

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the texts one after another, and how many each has."""
        cut = pa.array(["" if _uneven(t) else t for t in texts], pa.large_string())
        pieces = pc.split_pattern(pc.replace_substring(cut, "\n", " \n"), " ")
        start = pieces.offsets.to_numpy()[:-1]  # of each text's first piece, which stands after no blank
        flat = pieces.flatten()
        alone = [f or t for f, t in zip(flat.take(pa.array(start)).to_pylist(), texts)]  # a text that is not cut is one piece
        ids, size = self.whole(alone)
        coded = flat.dictionary_encode()
        number = self._numbers(coded.dictionary.to_pylist())[coded.indices.to_numpy()]
        first, length = self.kept.first[number] + len(ids), self.kept.size[number]
        first[start], length[start] = np.cumsum(size) - size, size
        total = np.add.reduceat(length, start) if len(start) else length
        return _gathered(np.concatenate((ids, self.kept.ids[: self.kept.used])), first, length), total

    def _numbers(self, used: list[str]) -> np.ndarray:
        """Numbers of the pieces in ``kept``. What was not used for ``KEPT_PIECES`` other pieces goes."""
        if len(self.kept.number) > KEPT_PIECES:
            self.kept, self.older = PieceStore(), self.kept
        missing = [used[i] for i in np.flatnonzero(self.kept.places(used) < 0)]
        place = self.older.places(missing)
        again = place[place >= 0]
        size = self.older.size[again]
        self.kept.add([missing[i] for i in np.flatnonzero(place >= 0)], _gathered(self.older.ids, self.older.first[again], size), size)
        fresh = [missing[i] for i in np.flatnonzero(place < 0)]
        self.kept.add(fresh, *self.whole([p if p[:1] == "\n" else " " + p for p in fresh]))
        return self.kept.places(used)


def _place(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(re.sub(r"^file:/(?!/)", "file:///", uri))


@dataclass
class _Writer:
    """One file: fills sequences, writes them in batches."""

    place: fs.FileSystem
    path: str
    length: int
    kind: pa.DataType

    def __post_init__(self) -> None:
        self.schema = pa.schema([("tokens", pa.list_(self.kind, self.length)), ("mask", pa.list_(pa.bool_(), self.length))])
        self.out = self.place.open_output_stream(self.path)
        self.writer = pa.ipc.new_file(self.out, self.schema)
        self.open, self.n, self.index = np.zeros(0, dtype=self.kind.to_pandas_dtype()), 0, []

    @property
    def documents(self) -> int:
        return sum(batch.num_rows for batch in self.index)

    def add(self, doc_ids: pa.Array, ids: np.ndarray, size: np.ndarray) -> None:
        """Documents with their ids one after another."""
        first = self.n + np.cumsum(size) - size
        self.index.append(pa.record_batch([doc_ids.cast(pa.int64()), pa.array(first), pa.array(size)], ["doc_id", "first", "n_tokens"]))
        self.n += len(ids)
        self.open = np.concatenate((self.open, ids.astype(self.open.dtype)))
        while len(self.open) >= self.length * BATCH:
            self._write(self.open[: self.length * BATCH], self.length * BATCH)
            self.open = self.open[self.length * BATCH :]

    def _write(self, tokens: np.ndarray, real: int) -> None:
        mask = np.arange(len(tokens)) < real
        self.writer.write_batch(pa.RecordBatch.from_arrays(
            [pa.FixedSizeListArray.from_arrays(pa.array(x), self.length) for x in (tokens, mask)], schema=self.schema
        ))

    def close(self) -> None:
        if len(self.open):
            real = len(self.open)
            self._write(np.pad(self.open, (0, -real % self.length)), real)
        self.writer.close()
        self.out.close()
        index = pa.Table.from_batches(self.index).combine_chunks()
        with self.place.open_output_stream(self.path + ".index") as out, pa.ipc.new_file(out, index.schema) as writer:
            writer.write_table(index, max_chunksize=1 << 16)


def write_token_files(
    docs: DataFrame, folder: str, tokenizer: str, end_id: int = END_ID, length: int = LENGTH,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """Write ``docs`` below ``folder``; returns the manifest: a row (file, first_id, n_docs, n_tokens,
    start) for each file, start being the number of tokens before it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, writer, first = PieceEncoder.of(tokenizer), None, None
        kind = pa.uint16() if encoder.tokenizer.get_vocab_size() <= 1 << 16 and end_id < 1 << 16 else pa.uint32()
        place, root = _place(folder)
        for batch in batches:
            for row, end, _, _ in chunks(batch.column(1), PART_BYTES):
                part = batch.slice(row, end - row)
                if writer is None:
                    place.create_dir(root, recursive=True)
                    name, first = f"tokens-{uuid.uuid4().hex}.arrow", part.column(0)[0].as_py()
                    writer = _Writer(place, f"{root}/{name}", length, kind)
                ids, size = encoder.encode([t or "" for t in part.column(1).to_pylist()])
                writer.add(part.column(0), np.insert(ids, np.cumsum(size), end_id), size + 1)
        if writer is not None:
            writer.close()
            row = [[name], [first], [writer.documents], [writer.n]]
            types = (pa.string(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(row, types)], ["file", "first_id", "n_docs", "n_tokens"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    ranged = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    manifest = stored(ranged.mapInArrow(run, MANIFEST), "manifest")
    before = Window.orderBy(F.col("first_id").asc_nulls_first(), "file").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.withColumn("start", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))  # a row for each file


def open_sequences(folder: str, file: str) -> pa.ipc.RecordBatchFileReader:
    """The batches of a file; memory-mapped where it is local, so that slices are no copies."""
    place, root = _place(folder)
    path = f"{root}/{file}"
    return pa.ipc.open_file(pa.memory_map(path) if isinstance(place, fs.LocalFileSystem) else place.open_input_file(path))


def sequence(reader: pa.ipc.RecordBatchFileReader, number: int) -> tuple[np.ndarray, np.ndarray]:
    """Tokens and mask of one sequence of a file."""
    batch = reader.get_batch(number // BATCH)
    tokens, mask = (batch.column(c).slice(number % BATCH, 1).flatten() for c in (0, 1))
    return tokens.to_numpy(), mask.to_numpy(zero_copy_only=False)


def _documents(folder: str, file: str) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    """Index batches of a file with the tokens of their documents; holds no more than these."""
    reader, held, begin, following = open_sequences(folder, file), np.zeros(0, np.uint16), 0, 0
    with open_sequences(folder, file + ".index") as index:
        for k in range(index.num_record_batches):
            rows = index.get_batch(k)
            for at in range(0, rows.num_rows, 1024):
                part = rows.slice(at, 1024)
                first, size = part.column(1).to_numpy(), part.column(2).to_numpy()
                parts, end = [held], int(first[-1] + size[-1])
                have = begin + len(held)
                while have < end:
                    batch = reader.get_batch(following)
                    real = batch.column(0).flatten().to_numpy()
                    parts.append(real)
                    have, following = have + len(real), following + 1
                tokens = np.concatenate(parts) if len(parts) > 1 else held
                yield part, [tokens[f - begin : f - begin + n] for f, n in zip(first.tolist(), size.tolist())]
                held, begin = tokens[end - begin :], end


def read_token_files(manifest: DataFrame, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files of the manifest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for rows, documents in _documents(folder, file):
                    check = [zlib.crc32(ids.astype("<u4").tobytes()) for ids in documents]
                    yield pa.RecordBatch.from_arrays(
                        [rows.column(0), pa.array(rows.column(1).to_numpy() + start), rows.column(2), pa.array(check, pa.int64())],
                        ["doc_id", "start", "n_tokens", "ids_crc32"],
                    )

    parts = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    files = manifest.select("file", F.col("start").cast("long").alias("start")).repartition(parts)
    return files.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def round_trip(docs: DataFrame, tokenizer: str, folder: str | None = None) -> DataFrame:
    """``docs`` written to token files, by default in the shared folder, and read back."""
    folder = folder or shared_folder(docs.sparkSession, "tokens")
    return read_token_files(write_token_files(docs, folder, tokenizer), folder)
