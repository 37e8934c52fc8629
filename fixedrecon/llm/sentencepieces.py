"""SentencePiece encoding and decoding by a streaming Viterbi search.

The search goes over the characters of a text. At each boundary it holds the best last piece and
the boundary before it. Boundaries further back than the longest piece can be no one's
predecessor; what is held beyond them is only the way back. Once a window is full and the ways back
from all boundaries in it meet in one boundary, the ids up to there are final and leave. So memory
follows the longest piece and not the text.

The model decides what is best. For a unigram model it is the sum of scores. For a BPE model it is
the segmentation that its merges would make: a last piece is admissible only if it and the piece
before it are what the merges make of their joined text, and exactly one is. (Tests compare
both with the library; of segmentations with equal sums either may come.)

A text is cut where no piece can reach across: before a run of blanks, before signs that follow no
letter in any piece, and around characters that occur in no longer piece. Parts recur, so the ids of a bounded number of them are kept.

Defined results: a null or empty text has no ids and decodes to ''; every text comes back
unchanged, but for the sign that stands for a blank, which comes back as a blank; each row is encoded by
itself."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fixedrecon.llm.shared import held, return_memory
from fixedrecon.llm.words import chunks

BLANK = "▁"
UNIGRAM, BPE = 1, 2
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNKNOWN_PENALTY = 10.0  # below the lowest score, as in the library
KEPT_BYTES, PART_BYTES = 64 << 20, 4 << 20
KEPT_ENTRY = 160  # bytes of a kept part beside its characters and ids


def _class(characters: set[str]) -> str:
    return f"[{''.join(map(re.escape, sorted(characters)))}]" if characters else "(?!)"


class PieceModel:
    """Pieces and settings of a model file. Models without a normaliser only."""

    def __init__(self, serialized: bytes) -> None:
        from sentencepiece import sentencepiece_model_pb2 as pb

        proto = pb.ModelProto()
        proto.ParseFromString(serialized)
        self.kind = proto.trainer_spec.model_type
        if self.kind not in (UNIGRAM, BPE) or any(p.type == USER for p in proto.pieces):
            raise ValueError("unigram and BPE models without user symbols are supported")
        spec = proto.normalizer_spec
        if spec.precompiled_charsmap or spec.remove_extra_whitespaces or not spec.escape_whitespaces:
            raise ValueError("models that normalise text are not supported")
        self.prefix = BLANK if spec.add_dummy_prefix else ""
        self.pieces = [p.piece for p in proto.pieces]
        self.ids = {p.piece: i for i, p in enumerate(proto.pieces) if p.type == NORMAL}
        self.score = {p.piece: p.score for p in proto.pieces if p.type == NORMAL}
        self.unknown = next(i for i, p in enumerate(proto.pieces) if p.type == UNKNOWN)
        self.bytes = {int(p.piece[1:-1], 16): i for i, p in enumerate(proto.pieces) if p.type == BYTE}
        self.longest = max(map(len, self.ids), default=1)
        self.unknown_score = min(self.score.values(), default=0.0) - UNKNOWN_PENALTY
        ends: dict[str, set[int]] = {}
        for p in self.ids:
            ends.setdefault(p[-2:], set()).add(len(p))
        #: Lengths of the longer pieces by their last two characters, longest first: it wins a tie.
        self.ends = {c: sorted(n - {1}, reverse=True) for c, n in ends.items() if len(c) == 2}
        self.admissible = lru_cache(1 << 17)(self._admissible)
        self.merges = lru_cache(1 << 16)(self._merges)
        long = [p for p in self.ids if len(p) > 1]
        joined = {c for p in long for c in p}
        leading = {c for c in joined if all(c not in p.lstrip(c) for p in long)}
        tails = self._tails(joined - leading, {p[i : i + 2] for p in long for i in range(len(p) - 1)})
        run, body, tail, any_ = (_class(x) for x in (leading, joined - leading - tails, tails, joined - leading))
        self.parts = re.compile(f"{run}*{body}+|{run}*{tail}{any_}*|{run}+|.", re.DOTALL)
        self.surface = [self._surface(p) for p in proto.pieces]

    @classmethod
    def of(cls, path: str) -> PieceModel:
        """One model for a worker process."""

        def make() -> PieceModel:
            with open(path, "rb") as file:
                return cls(file.read())

        return held(f"model {path}", make)

    @staticmethod
    def _tails(inner: set[str], pairs: set[str]) -> set[str]:
        """Signs that follow none of the other characters in any piece: a part ends before them."""
        tails = {c for c in inner if not c.isalpha()}
        while True:
            follow = {b for a, b in pairs if a in inner and a not in tails}
            if not tails & follow:
                return tails
            tails -= follow

    @staticmethod
    def _surface(piece) -> bytes:
        if piece.type == BYTE:
            return bytes([int(piece.piece[1:-1], 16)])
        if piece.type == CONTROL:
            return b""
        return " ⁇ ".encode() if piece.type == UNKNOWN else piece.piece.replace(BLANK, " ").encode()

    def _merges(self, text: str) -> tuple[list[tuple[float, str, str]], bool]:
        """The merges of a short text in order, best score first, then leftmost: (score, first part
        and last part after it); and whether one part is left."""
        parts, done, score = list(text), [], self.score
        while len(parts) > 1:
            pairs = [(-score[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in score]
            if not pairs:
                break
            worst, i = min(pairs)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            done.append((-worst, parts[0], parts[-1]))
        return done, len(parts) == 1

    def _admissible(self, before: str, piece: str) -> bool:
        """Whether the merges of the joined text make these two pieces. They run through the merges of
        both in the order of scores; a merge across the border may at no time come first."""
        right, whole = self.merges(piece)
        if not whole or not before:
            return whole
        left = self.merges(before)[0]
        i, j, edge, start = 0, 0, before[-1], piece[0]
        while True:
            across = self.score.get(edge + start)
            a = left[i][0] if i < len(left) else -np.inf
            b = right[j][0] if j < len(right) else -np.inf
            if across is not None and across > a and across >= b:
                return False
            if i == len(left) and j == len(right):
                return True
            if a >= b:
                edge, i = left[i][2], i + 1
            else:
                start, j = right[j][1], j + 1

    def id_list(self, piece: str) -> list[int]:
        """The id of a piece; the ids of its bytes, or the unknown id, where it is none."""
        if piece in self.ids:
            return [self.ids[piece]]
        return [self.bytes[b] for b in piece.encode()] if self.bytes else [self.unknown]


class StreamingEncoder:
    """Ids of a text that comes bit by bit. ``feed`` returns what is final, ``finish`` the rest."""

    def __init__(self, model: PieceModel) -> None:
        self.model = model
        self.text = ""  # from the last final boundary on
        self.before = ""  # the piece before it
        self.back: list[tuple[int, float]] = [(0, 0.0)]  # per boundary: the one before it, score
        self.tail_unknown = False

    def feed(self, text: str) -> list[int]:
        done: list[int] = []
        step = self.model.longest
        for at in range(0, len(text), step):
            self.text += text[at : at + step]
            self._extend()
            if len(self.back) > 2 * step:
                done += self._converged()
        return done

    def finish(self) -> list[int]:
        done = self._commit(len(self.text))
        self.before, self.tail_unknown = "", False
        return done

    def _extend(self) -> None:
        """Find the best last piece at every new boundary."""
        text, back, model = self.text, self.back, self.model
        ends, ids, admissible, bpe = model.ends, model.ids, model.admissible, model.kind == BPE
        for end in range(len(back), len(text) + 1):
            best: tuple[int, float] | None = None
            for n in (*ends.get(text[end - 2 : end], ()), 1) if end > 1 else (1,):
                start = end - n
                if start < 0:
                    continue
                piece = text[start:end]
                if n > 1 and piece not in ids:
                    continue
                if bpe:
                    if admissible(text[back[start][0] : start] if start else self.before, piece):
                        best = (start, 0.0)
                        break
                else:
                    score = back[start][1] + model.score.get(piece, model.unknown_score)
                    if best is None or score > best[1]:
                        best = (start, score)
            if best is None:
                raise ValueError(f"the model has no segmentation of {text!r}")
            back.append(best)

    def _converged(self) -> list[int]:
        """Commit up to the last boundary on which the ways back from the whole window meet."""
        live = set(range(len(self.back) - self.model.longest, len(self.back)))
        while len(live) > 1:
            last = max(live)
            live.remove(last)
            live.add(self.back[last][0])
        return self._commit(live.pop())

    def _commit(self, boundary: int) -> list[int]:
        cuts, at = [], boundary
        while at:
            cuts.append(at)
            at = self.back[at][0]
        done: list[int] = []
        for start, end in zip([0, *reversed(cuts)], reversed(cuts)):
            piece = self.text[start:end]
            ids = self.model.id_list(piece)
            unknown = ids == [self.model.unknown]
            if not (unknown and self.tail_unknown):  # neighbouring unknowns are one
                done += ids
            self.before, self.tail_unknown = piece, unknown
        if boundary:
            self.text = self.text[boundary:]
            self.back = [(max(0, b - boundary), s) for b, s in self.back[boundary:]]
        return done


class PartEncoder:
    """Encodes and decodes whole texts; keeps the ids of parts in two generations of some ``kept_bytes``, as a worker
    holds them beside the work of other stages."""

    def __init__(self, model: PieceModel, kept_bytes: int | None = None) -> None:
        self.model, self.limit = model, KEPT_BYTES if kept_bytes is None else kept_bytes
        self.kept: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.kept_bytes = 0

    def _stream(self, part: str) -> bytes:
        encoder = StreamingEncoder(self.model)
        return np.array(encoder.feed(part) + encoder.finish(), dtype="<i4").tobytes()

    def _of(self, part: str) -> bytes:
        if self.kept_bytes > self.limit:
            self.kept, self.older, self.kept_bytes = {}, self.kept, 0
        found = self.kept.get(part)
        if found is None:
            found = self.older.get(part) or self._stream(part)
            self.kept[part] = found
            self.kept_bytes += KEPT_ENTRY + 2 * len(part) + len(found)
        return found

    def encode(self, text: str) -> np.ndarray:
        if not text:
            return np.zeros(0, dtype="<i4")
        parts = self.model.parts.findall(self.model.prefix + text.replace(" ", BLANK))
        get, kept = self._of, self.kept
        ids = np.frombuffer(b"".join([kept.get(p) or get(p) for p in parts]), dtype="<i4")
        if not self.model.bytes:  # neighbouring unknowns of different parts
            again = (ids == self.model.unknown) & np.append(False, ids[:-1] == self.model.unknown)
            ids = ids[~again]
        return ids

    def decode(self, ids: np.ndarray) -> str:
        text = b"".join(map(self.model.surface.__getitem__, ids.tolist())).decode("utf-8", "replace")
        return text[1:] if self.model.prefix and text[:1] == " " else text


def encode(
    docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text", kept_bytes: int | None = None
) -> DataFrame:
    """(doc_id, ids, n_tokens, ids_crc32, round_trip) for each row: the ids, their number, the crc32 of
    the ids as little-endian 32-bit integers, and whether they decode to the text. ``kept_bytes`` bounds each of the two
    generations of parts that a worker keeps (``KEPT_BYTES``): fewer take less memory and more time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return_memory()
        encoder = _worker_encoder(model_path, kept_bytes)
        for batch in batches:
            for row, end, _, _ in chunks(batch.column(1), PART_BYTES):
                texts = [t or "" for t in batch.column(1).slice(row, end - row).to_pylist()]
                ids = [encoder.encode(t) for t in texts]
                offsets = np.append(0, np.cumsum([len(x) for x in ids]))
                same = [encoder.decode(x) == t.replace(BLANK, " ") for x, t in zip(ids, texts)]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(row, end - row),
                        pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.concatenate(ids), pa.int32())),
                        pa.array(np.diff(offsets), pa.int64()),
                        pa.array([zlib.crc32(x.tobytes()) for x in ids], pa.int64()),
                        pa.array(same),
                    ],
                    ["doc_id", "ids", "n_tokens", "ids_crc32", "round_trip"],
                )
        return_memory()

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_id long, ids array<int>, n_tokens long, ids_crc32 long, round_trip boolean")


def decode(encoded: DataFrame, model_path: str) -> DataFrame:
    """(doc_id, text) of rows with ``doc_id`` and ``ids``; null ids decode to ''."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _worker_encoder(model_path)
        for batch in batches:
            texts = [encoder.decode(np.array(x.as_py() or [], dtype=np.int32)) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return encoded.select(F.col("doc_id").cast("long").alias("doc_id"), "ids").mapInArrow(run, "doc_id long, text string")


def _worker_encoder(path: str, kept_bytes: int | None = None) -> PartEncoder:
    """One encoder, with the parts it keeps, for a worker process."""
    return held(f"encoder {path} {kept_bytes}", lambda: PartEncoder(PieceModel.of(path), kept_bytes))
