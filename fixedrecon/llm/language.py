"""Language identification by nearest centroids of TF-IDF n-gram vectors.

A text is a vector over hashed byte pairs and triples (UTF-8, ASCII letters lower-cased, all else
but letters of other scripts taken as a blank), weighted by inverse document frequency and normalised.
Each language has several centroids, found by spherical k-means over its training vectors, as
one language can hold several kinds of text. The nearest centroid by cosine names the language.

Rejection is by distance, and length-aware: short texts lie further from any centroid than long ones. Each
training text also gives its own pieces of 32, 128, 512 ... bytes; per length, the distance that
nearly all of them keep (``QUANTILE``), with room of ``ROOM``, is the limit; for the shortest texts it
widens further.

Fitting takes at most ``SAMPLE`` distinct labelled texts, an equal share of each language, chosen by a hash
of the text. Of more than ``SAMPLE`` languages those with the most distinct texts are learned (ties: the first in the
alphabet). Only the vectors of these texts reach the driver (``SAMPLE`` x pieces x ``DIMENSIONS`` numbers of 2 bytes at most).
Prediction looks at every whole text, in one pass without a shuffle.

Defined results: a null text and one without a letter are ``und`` with score 0 and rejected, as is every
text where nothing could be learned; equal texts get equal results; ties go to the language
first in the alphabet. Rows without a language or text are not learned from."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fixedrecon.llm.shared import lean
from fixedrecon.llm.words import LOWER, chunks

UND = "und"
DIMENSIONS, CENTROIDS, ROUNDS, SAMPLE = 4096, 3, 12, 1200
QUANTILE, ROOM, SHORTEST = 0.005, 0.75, 32
#: ASCII letters in lower case and bytes of other characters; a blank for the rest.
FOLD = np.where((LOWER >= 0x61) & (LOWER <= 0x7A) | (LOWER >= 0x80), LOWER, 0x20).astype(np.uint32)


def ngram_counts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Counts (texts x DIMENSIONS, float32) of hashed byte pairs and triples within each text."""
    n = len(offsets) - 1
    folded = FOLD[data]
    owner = np.repeat(np.arange(n), np.diff(offsets))
    counts = np.zeros(n * DIMENSIONS, dtype=np.float32)
    for size in (2, 3):
        if len(folded) < size:
            continue
        m = len(folded) - size + 1
        gram = folded[:m] + (folded[1:][:m] << np.uint32(8)) + np.uint32(size << 24)
        if size == 3:
            gram = gram + (folded[2:][:m] << np.uint32(16))
        slot = (gram * np.uint32(2654435761)) >> np.uint32(20)
        blank = (folded[:m] == 0x20) & (folded[size - 1 :][:m] == 0x20)
        keep = (owner[:m] == owner[size - 1 :][:m]) & ~blank
        counts += np.bincount(owner[:m][keep] * DIMENSIONS + slot[keep], minlength=n * DIMENSIONS).astype(np.float32)
    return counts.reshape(n, DIMENSIONS)


def _unit(vectors: np.ndarray) -> np.ndarray:
    norm = np.linalg.norm(vectors, axis=1, keepdims=True)
    return np.divide(vectors, norm, out=np.zeros_like(vectors), where=norm > 0)


def length_class(n_bytes: np.ndarray) -> np.ndarray:
    """0 for up to SHORTEST bytes, one more for each factor of 4."""
    return np.maximum(0, np.ceil(np.log2(np.maximum(n_bytes, 1) / SHORTEST) / 2)).astype(np.int64)


@dataclass
class LanguageModel:
    languages: list[str]  # of each centroid
    centroids: np.ndarray
    idf: np.ndarray
    floor: np.ndarray  # least cosine by length class; the last holds for all longer texts

    def vectors(self, counts: np.ndarray) -> np.ndarray:
        return _unit(np.log1p(counts) * self.idf)

    def predict(self, counts: np.ndarray, n_bytes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Number of the nearest centroid, cosine, and whether it is too far."""
        cosine = self.vectors(counts) @ self.centroids.T
        best = cosine.argmax(axis=1)
        score = cosine[np.arange(len(best)), best]
        floor = self.floor[np.minimum(length_class(n_bytes), len(self.floor) - 1)] * np.minimum(1, n_bytes / SHORTEST)
        return best, np.clip(score, 0, 1), score < floor


def _clusters(vectors: np.ndarray, k: int) -> np.ndarray:
    """Spherical k-means from mutually distant starting vectors."""
    chosen = [int((vectors @ _unit(vectors.mean(axis=0, keepdims=True))[0]).argmax())]
    while len(chosen) < min(k, len(vectors)):
        chosen.append(int((vectors @ vectors[chosen].T).max(axis=1).argmin()))
    centroids = vectors[chosen]
    for _ in range(ROUNDS):
        nearest = (vectors @ centroids.T).argmax(axis=1)
        centroids = _unit(np.stack([vectors[nearest == i].mean(axis=0) if (nearest == i).any() else c for i, c in enumerate(centroids)]))
    return centroids


def training_sample(labelled: DataFrame, sample: int, lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """(lang, text): up to ``sample`` distinct texts, an equal share of each language, by a hash of the text.
    A first cut by the hash alone keeps the ranking small for a language with very many texts; copies of
    a text count once in it and in the ranking. The driver reads ``sample`` rows (language, count) at most, whatever
    the number of languages, and they come back as a table to join."""
    rows = labelled.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text")).where("lang IS NOT NULL AND text IS NOT NULL")
    draw = F.xxhash64("text", F.lit(7))
    texts = rows.select("lang", draw.alias("draw")).distinct()
    sizes = texts.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(sample).collect()
    share = max(1, sample // max(1, len(sizes)))
    bounds = [(r["lang"], int(min(1.0, 2 * (share + 50) / r["n"]) * (1 << 30)) + 1) for r in sizes]
    bounds = labelled.sparkSession.createDataFrame(bounds, "lang string, bound long")
    near = rows.withColumn("draw", draw).join(F.broadcast(bounds), "lang").where(F.pmod("draw", F.lit(1 << 30)) < F.col("bound"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("draw", "text"))
    return near.select("lang", "text", "draw").distinct().withColumn("rank", rank).where(F.col("rank") <= share).select("lang", "text")


@lean
def _piece_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, n_bytes, whole, logs of the counts) of each text and of its pieces."""
    for batch in batches:
        for row, _, data, offsets in chunks(batch.column(1)):
            for i, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
                size, cuts = SHORTEST, [(a, b)]
                while size < b - a:
                    middle = (a + b - size) // 2
                    cuts.append((middle, middle + size))
                    size *= 4
                logs = [np.log1p(ngram_counts(data[s:e], np.array([0, e - s]))).astype(np.float16) for s, e in cuts]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([batch.column(0)[row + i].as_py()] * len(cuts), pa.string()),
                        pa.array([e - s for s, e in cuts], pa.int64()),
                        pa.array([k == 0 for k in range(len(cuts))]),
                        pa.array([v.tobytes() for v in logs], pa.binary()),
                    ],
                    ["lang", "n_bytes", "whole", "logs"],
                )


def fit(labelled: DataFrame, sample: int = SAMPLE, lang_col: str = "lang", text_col: str = "text") -> LanguageModel | None:
    """A model from a bounded sample of labelled rows; None without any."""
    chosen = training_sample(labelled, sample, lang_col, text_col)
    found = chosen.mapInArrow(_piece_rows, "lang string, n_bytes long, whole boolean, logs binary").toArrow()
    if not found.num_rows:
        return None
    found = found.sort_by([("lang", "ascending"), ("n_bytes", "ascending"), ("logs", "ascending")])
    whole, n_bytes = found["whole"].to_numpy(), found["n_bytes"].to_numpy()
    langs = np.array(found["lang"].to_pylist())[whole]

    def logs(rows: pa.Table) -> np.ndarray:
        joined = b"".join(rows["logs"].to_pylist())
        return np.frombuffer(joined, dtype=np.float16).reshape(rows.num_rows, DIMENSIONS).astype(np.float32)

    texts = logs(found.filter(pa.array(whole)))
    idf = np.log((1 + len(texts)) / (1 + (texts > 0).sum(axis=0))).astype(np.float32) + 1
    model = LanguageModel([], np.zeros((0, DIMENSIONS), np.float32), idf, np.zeros(1))
    texts = _unit(texts * idf)
    parts = []
    for lang in sorted(set(langs)):
        parts.append(_clusters(texts[langs == lang], CENTROIDS))
        model.languages += [str(lang)] * len(parts[-1])
    model.centroids = np.concatenate(parts)
    near = [_unit(logs(found.slice(i, 256)) * idf) @ model.centroids.T for i in range(0, found.num_rows, 256)]
    cosine, kind = np.concatenate(near).max(axis=1), length_class(n_bytes)
    floor, least = [], np.inf
    for k in range(kind.max(), -1, -1):  # a shorter text may be as far as a longer one
        at = cosine[kind == k]
        least = min(least, np.quantile(at, QUANTILE) * ROOM if len(at) else np.inf)
        floor.append(least)
    model.floor = np.array(floor[::-1])
    return model


def identify(docs: DataFrame, model: LanguageModel | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score, rejected) for each row of ``docs``."""
    return with_language(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")), model).drop("text")


def with_language(docs: DataFrame, model: LanguageModel | None, text_col: str = "text") -> DataFrame:
    """``docs`` with lang_pred, score and rejected; existing columns of these names, in any case, are replaced."""
    fields = [f for f in docs.schema.fields if f.name.lower() not in ("lang_pred", "score", "rejected")]
    kept, text = [f.name for f in fields], f"c{docs.columns.index(text_col)}"
    numbered = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    rows = numbered.select(*[f"c{docs.columns.index(c)}" for c in kept], F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False)).alias("rejected"))
    at, sent = kept.index(text_col), docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        names = np.array([*(model.languages if model else []), UND])
        for batch in batches:
            letters = batch.column(len(kept)).to_numpy(zero_copy_only=False)
            best, score = np.full(batch.num_rows, len(names) - 1), np.zeros(batch.num_rows)
            far = np.ones(batch.num_rows, dtype=bool)
            for row, end, data, offsets in chunks(batch.column(at), 1 << 20) if model else ():
                for s in range(0, end - row, 512):
                    e = min(s + 512, end - row)
                    a, b = offsets[s], offsets[e]
                    found = model.predict(ngram_counts(data[a:b], offsets[s : e + 1] - a), np.diff(offsets[s : e + 1]))
                    best[row + s : row + e], score[row + s : row + e], far[row + s : row + e] = found
            best, score, far = np.where(letters, best, len(names) - 1), np.where(letters, score, 0.0), far | ~letters
            more = [pa.array(names[best].tolist(), pa.string()), pa.array(score, pa.float64()), pa.array(far)]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(kept)], *more], names=[*kept, "lang_pred", "score", "rejected"])

    more = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("rejected", T.BooleanType())]
    return rows.mapInArrow(lean(run), T.StructType([*fields, *more]))
