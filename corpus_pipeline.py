"""A training-text pipeline of five stages over ``documents``.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before kept. All but the last return the
columns of ``documents``; other columns of the input are not carried. Nulls are allowed in every
column: a null text has no letter and goes with the first stage; ids may be null or repeated."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fixedrecon.llm import decontaminate, language, secret_scan, sentencepieces, simhash
from fixedrecon.llm.shared import stored

#: Bytes of a generation of parts that a worker of the last stage keeps: its executor has the heap of all stages beside it.
KEPT_BYTES = 24 << 20
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: SQL cannot express the stages; tests/llm holds the pipeline against a plain version.
ORACLE_SQL = None


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents near enough to a language that their own labels teach; those rejected go."""
    rows = docs.select(*COLUMNS)
    return language.with_language(rows, language.fit(rows)).where("NOT rejected").select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row, that of smallest id, of each group of near-duplicates (null ids last). Groups are those of op3: 4-word
    shingles, links at up to 4 differing bits, and no test of the similarity itself."""
    return simhash.keep_rows(docs.select(*COLUMNS))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontaminate.drop_contaminated(docs.select(*COLUMNS), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets in the text replaced by a mask; ``n_chars`` follows the text."""
    return secret_scan.mask_secrets(docs.select(*COLUMNS)).withColumn("n_chars", F.char_length("text").cast("long")).select(*COLUMNS)


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, ids, n_tokens, ids_crc32, round_trip) of every document that is left."""
    return sentencepieces.encode(docs, public_tokenizers.path("piece_bpe_32k.model"), kept_bytes=KEPT_BYTES)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("secret_scans", secret_scans),
    ("sentencepiece", sentencepiece),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; what the others return is written to the shared folder in between."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
