"""Registered queries at the smallest scale: against SQL, or against a plain version."""

import zlib

import numpy as np
import public_tokenizers
import pytest

import corpus_pipeline
from fixedrecon.llm import quality_model, secret_scan
from fixedrecon.llm.queries import ORACLE, QUERIES
from tests.llm import plain
from tests.oracle_check import compare, duck

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    rows = spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()
    return sorted(rows, key=lambda r: r["doc_id"])


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, name):
    assert compare(spark, duck(SF_DIR), name, QUERIES[name], ORACLE[name], SF_DIR) is None


def rows_of(spark, name):
    return {r["doc_id"]: r for r in QUERIES[name](spark, SF_DIR).collect()}


def test_secret_scan(spark, docs):
    found = rows_of(spark, "op2_secret_scan")
    assert len(found) == len(docs)
    for d in docs:
        spans = plain.base_spans(d["text"])
        r = found[d["doc_id"]]
        assert r["base_sha256"] == plain.sha(spans)
        assert set(filter(None, spans.split(","))) <= set(r["spans"].split(","))
        assert r["n_hex"] == spans.count("hex") and r["n_assign"] == spans.count("assign")


def test_simhash(spark, docs):
    found = rows_of(spark, "op3_simhash")
    classes = plain.near_classes([(d["doc_id"], d["text"]) for d in docs])
    assert {i: r["component_id"] for i, r in found.items()} == classes
    assert all(r["fingerprint"] == f"{plain.fingerprint(d['text']):016x}" for d in docs for r in [found[d["doc_id"]]])


def test_language_held_out(spark, docs):
    found = rows_of(spark, "op4_language")
    held = {d["doc_id"]: d["lang"] for d in docs if zlib.crc32(str(d["doc_id"]).encode()) % 3 == 1}
    assert {i for i, r in found.items() if r["held_out"]} == set(held)
    assert sum(found[i]["lang_pred"] == lang for i, lang in held.items()) >= 0.97 * len(held)
    assert all(0 <= r["score"] <= 1 for r in found.values())


def test_token_files(spark, docs):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    found, start = rows_of(spark, "op6_token_files"), 0
    for d in docs:
        ids = np.array([*tokenizer.encode(d["text"] or "", add_special_tokens=False).ids, 2], dtype="<u4")
        r = found[d["doc_id"]]
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


def test_quality_sampling(spark, docs):
    found = rows_of(spark, "op8_quality_sampling")
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}
    import pyarrow as pa

    from fixedrecon.llm.words import text_bytes

    counts = {}
    for d in docs:
        owner, bucket = quality_model.ngram_buckets(*text_bytes(pa.array([d["text"]])))
        counts[d["doc_id"]] = np.bincount(bucket, minlength=quality_model.BUCKETS)
    raw = sum(counts.values())
    target = sum(counts[i] for i, q in labels.items() if q == 1 and i in counts)
    ratio = np.log((target + 1) / (target.sum() + quality_model.BUCKETS)) - np.log((raw + 1) / (raw.sum() + quality_model.BUCKETS))
    for i, r in found.items():
        assert r["log_weight"] == pytest.approx(float(counts[i] @ ratio), abs=1e-6)
    k = round(sum(labels.values()) / len(labels) * len(docs))
    best = sorted(found.values(), key=lambda r: -r["sample_key"])[:k]
    assert {r["doc_id"] for r in best} == {i for i, r in found.items() if r["selected"]}


def test_sentencepiece(spark, docs):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    found = rows_of(spark, "op10_sentencepiece")
    assert all(found[d["doc_id"]]["ids"] == library.encode(d["text"] or "") for d in docs)
    assert all(r["round_trip"] and r["n_tokens"] == len(r["ids"]) for r in found.values())


def test_pipeline(spark, docs):
    """All stages but the learned first, plainly; the first keeps what has a language."""
    import sentencepiece

    first = corpus_pipeline.language_id(spark, spark.read.parquet(f"{SF_DIR}/documents.parquet"), SF_DIR).collect()
    assert {r["doc_id"] for r in first} >= {d["doc_id"] for d in docs if d["lang"] and len(d["text"]) > 100 and plain.words(d["text"])} - {
        d["doc_id"] for d in docs if len(set(plain.words(d["text"]))) < 0.3 * len(plain.words(d["text"]))
    }
    left = sorted((r["doc_id"], r["text"]) for r in first)
    classes = plain.near_classes(left)
    left = [(i, t) for i, t in left if classes[i] == i]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    left = [(i, t) for i, t in left if not plain.contaminated(t, items)[0]]
    left = [(i, secret_scan.masked_text(t, "<secret>")) for i, t in left]
    assert all(plain.base_spans(t) == "" for _, t in left)
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    found = {r["doc_id"]: r["ids"] for r in corpus_pipeline.run(spark, SF_DIR).collect()}
    assert found == {i: library.encode(t) for i, t in left}


def test_stages_return_the_columns_of_documents(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF_DIR).columns == docs.columns
