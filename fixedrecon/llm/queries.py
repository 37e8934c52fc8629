"""Queries ``opN_<name>`` over the given tables, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fixedrecon.llm import (
    decontaminate,
    language,
    license_scan,
    phrases,
    quality_model,
    quality_rules,
    secret_scan,
    sentencepieces,
    simhash,
    spelling,
    substring,
    token_files,
    topk,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(function):
        QUERIES[name] = function
        if sql is not None:
            ORACLE[name] = sql
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query(
    "op1_quality_rules",
    r"""
    WITH d AS (
        SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
               list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
        FROM documents
    ), s AS (
        SELECT doc_id, i, array_to_string(w[i : i + 4], ' ') AS seq
        FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM d WHERE len(w) >= 5)
    ), r AS (
        SELECT doc_id, count(DISTINCT word) AS n
        FROM (SELECT doc_id, unnest(range(i, i + 5)) AS word FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, seq) AS c FROM s) WHERE c > 1)
        GROUP BY doc_id
    ), m AS (
        SELECT d.doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars, len(regexp_extract_all(t, '[#*$%&|<>]')) AS n_symbols,
               len(lines) AS n_lines, len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words,
               len(list_filter(w, lambda x: list_contains(string_split('STOP', ' '), lower(x)))) AS n_stop
        FROM d LEFT JOIN r USING (doc_id)
    ), b AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m)
    SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols,
           CAST(n_dup_lines AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
           NOT base_failed AND n_words <= 1000000 AND word_chars / n_words BETWEEN 2 AND 20 AND n_symbols / n_words <= 0.1
           AND n_dup_lines / n_lines <= 0.5 AND (n_words < 50 OR n_stop / n_words >= 0.02) AS kept
    FROM b
    """.replace("STOP", " ".join(quality_rules.STOP_WORDS)),
)
def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metrics and verdict of every document."""
    found = quality_rules.judge(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


@query("op2_secret_scan")
def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document."""
    found = secret_scan.scan(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda x: x["kind"] != "random")
    return found.select(
        "doc_id", *[secret_scan.count_of(k).alias(f"n_{k}") for k in secret_scan.KINDS],
        F.sha2(secret_scan.joined(base), 256).alias("base_sha256"), secret_scan.joined(F.col("spans")).alias("spans"),
    )


@query("op3_simhash")
def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    digits = F.lpad(F.lower(F.hex("fp")), 16, "0")
    return found.select("doc_id", digits.alias("fingerprint"), "component_id")


ALPHABET = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"


@query(
    "op5_decontamination",
    rf"""
    WITH d AS (
        SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), {ALPHABET}), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
        FROM documents
    ), b AS (
        SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), {ALPHABET}), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
        FROM benchmark
    ), p AS (
        SELECT DISTINCT item_id, n, array_to_string(w[i : i + n - 1], ' ') AS pattern
        FROM (SELECT item_id, w, least(len(w), 10) AS n, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM b WHERE len(w) > 0)
    ), s AS (
        SELECT doc_id, n, i, array_to_string(w[i : i + n - 1], ' ') AS pattern
        FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM p) WHERE len(w) >= n)
    ), o AS (SELECT doc_id, item_id, s.n, i FROM s JOIN p ON s.pattern = p.pattern AND s.n = p.n),
    h AS (SELECT doc_id, count(DISTINCT word) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS word FROM o) GROUP BY doc_id),
    t AS (
        SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed
        FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM o WHERE item_id IS NOT NULL) GROUP BY doc_id
    )
    SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
           sha256(coalesce(listed, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
    FROM d LEFT JOIN h USING (doc_id) LEFT JOIN t USING (doc_id)
    """,
)
def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows in every document."""
    found = decontaminate.find_passages(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    hits = decontaminate.n_hit(F.col("spans"))
    return found.select(
        "doc_id", "n_words", hits.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (hits > 0).alias("contaminated"),
    )


@query(
    "op7_substring_dedup",
    r"""
    WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
    s AS (
        SELECT doc_id, i, array_to_string(w[i : i + 12], ' ') AS seq
        FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d WHERE len(w) >= 13)
    ), r AS (SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY seq) AS least FROM s) WHERE least < doc_id),
    g AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS i FROM r),
    x AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM d),
    k AS (SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY i) AS kept FROM x ANTI JOIN g USING (doc_id, i) GROUP BY doc_id)
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
    FROM d LEFT JOIN k USING (doc_id)
    """,
)
def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the passages that a document of smaller id has."""
    found = substring.remove_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query("op6_token_files")
def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's place in the token files, as read back from them."""
    return token_files.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query("op10_sentencepiece")
def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Piece ids of every document, and whether they decode to its text."""
    return sentencepieces.encode(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def held_out(doc_id: str = "doc_id"):
    """The third of the documents whose labels are never learned from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


@query("op4_language")
def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document."""
    docs = table(spark, sf_dir, "documents")
    model = language.fit(docs.where(~held_out()))
    found = language.identify(docs, model)
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "rejected")


@query("op8_quality_sampling")
def op8_quality_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Importance weight of every document, and the sample of as large a share as the labels call good."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    share = labels.agg(F.avg((F.col("quality") == 1).cast("double"))).first()[0] or 0.0
    return quality_model.resample(docs, quality_model.target_ids(labels), share)


def _license_sql() -> str:
    """Dice by explicit bigram sets, every line and block against every template."""
    rows = ", ".join(f"({i}, '{name}', '{text.replace(chr(39), chr(39) * 2)}')" for i, (name, text) in enumerate(license_scan.TEMPLATES))
    grams = "SELECT DISTINCT {key}, w[i] || ' ' || w[i + 1] AS g FROM (SELECT {key}, w, unnest(range(1, len(w))) AS i FROM {source})"
    words = "list_filter(string_split_regex(lower({text}), '[^a-z0-9]+'), lambda x: x <> '')"
    return rf"""
    WITH t(place, license, body) AS (VALUES {rows}),
    tw AS (SELECT place, {words.format(text="body")} AS w FROM t), tg AS ({grams.format(key="place", source="tw")}),
    tn AS (SELECT place, count(*) AS n FROM tg GROUP BY place),
    s AS (
        SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS segment FROM documents
        UNION ALL
        SELECT doc_id, segment FROM (SELECT doc_id, unnest(string_split_regex(text, '\n\s*\n')) AS segment FROM documents WHERE regexp_matches(text, '\n\s*\n'))
        WHERE contains(segment, chr(10))
    ),
    sw AS (SELECT row_number() OVER () AS sid, doc_id, {words.format(text="segment")} AS w FROM s),
    sg AS ({grams.format(key="sid", source="sw")}), sn AS (SELECT sid, count(*) AS n FROM sg GROUP BY sid),
    c AS (SELECT sid, place, count(*) AS n FROM sg JOIN tg USING (g) GROUP BY sid, place),
    d AS (SELECT sid, place, 2.0 * c.n / (sn.n + tn.n) AS dice FROM c JOIN sn USING (sid) JOIN tn USING (place)),
    m AS (SELECT sid, max((dice, -place)) AS best FROM d WHERE dice >= {license_scan.LEAST} GROUP BY sid),
    f AS (SELECT doc_id, count(*) AS n, max(best) AS best FROM m JOIN sw USING (sid) GROUP BY doc_id)
    SELECT x.doc_id, coalesce(f.n, 0) AS n_licenses, license, f.best[1] AS dice
    FROM documents x LEFT JOIN f USING (doc_id) LEFT JOIN t ON t.place = -f.best[2]
    """


@query("op9_license_scan", _license_sql())
def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License notices of every document and the likeliest of them."""
    found = license_scan.scan(table(spark, sf_dir, "documents"))
    first = license_scan.best(F.col("licenses"))
    return found.select(
        "doc_id", F.size("licenses").cast("long").alias("n_licenses"), first["license"].alias("license"), first["dice"].alias("dice")
    )


@query(
    "op11_phrases",
    rf"""
    WITH p AS (
        SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), {ALPHABET}), '[.,;:!?\x0A-\x0D]')) AS piece
        FROM documents
    ), w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
    g AS (
        SELECT lang, k, phrase, count(*) AS f
        FROM (SELECT lang, k, array_to_string(w[i : i + k - 1], ' ') AS phrase
              FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM w, (SELECT unnest([1, 2, 3, 4]) AS k) WHERE len(w) >= k))
        GROUP BY lang, k, phrase HAVING count(*) >= 30
    ), n AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM w GROUP BY lang),
    c AS (
        SELECT lang, phrase, f AS a, k, cut, string_split(phrase, ' ') AS w
        FROM (SELECT *, unnest(range(1, k)) AS cut FROM g WHERE k > 1)
    ), s AS (
        SELECT c.lang, c.phrase, a, c.k, cut, x.f AS l, y.f AS r, CAST(floor(CAST(a AS HUGEINT) * 2000000 // (x.f + y.f)) AS BIGINT) AS score
        FROM c JOIN g x ON x.lang = c.lang AND x.phrase = array_to_string(w[1 : cut], ' ')
        JOIN g y ON y.lang = c.lang AND y.phrase = array_to_string(w[cut + 1 :], ' ')
    ), b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
    d AS (
        SELECT DISTINCT b.lang, b.phrase FROM b JOIN g ON g.lang = b.lang AND g.k > b.k AND 100 * g.f >= 80 * b.a
        AND contains(' ' || g.phrase || ' ', ' ' || b.phrase || ' ')
    ), o AS (
        SELECT b.*, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, b.phrase) AS rank FROM b ANTI JOIN d USING (lang, phrase)
    )
    SELECT lang, rank, phrase, a, l, r, n, score FROM o JOIN n USING (lang) WHERE rank <= 2000
    """,
)
def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each language's phrases of two to four words that stand together most."""
    return phrases.collocations(table(spark, sf_dir, "documents"))


def _spelling_sql() -> str:
    """CRC-32 by its table; near words by what is left when a letter is hidden or taken out."""
    crc = ", ".join(str(c) for c in spelling.CRC)
    return rf"""
    WITH t AS (SELECT [{crc}] AS t),
    r AS (SELECT doc_id, unnest(regexp_extract_all(translate(text, {ALPHABET}), '[A-Za-z\x{{C0}}-\x{{FF}}]+')) AS run FROM documents),
    u AS (SELECT doc_id, run, count(*) AS n FROM r GROUP BY doc_id, run),
    b AS (
        SELECT *, list_transform(string_split(coalesce(CAST(doc_id AS VARCHAR), '') || ':', ''), lambda c: unicode(c))
               || flatten(list_transform(string_split(run, ''), lambda c: CASE WHEN unicode(c) < 128 THEN [unicode(c)] ELSE [195, unicode(c) - 64] END)) AS bytes
        FROM u
    ), h AS (
        SELECT run, n, xor(4294967295, list_reduce(list_concat([CAST(4294967295 AS BIGINT)], bytes),
               lambda s, x: xor(s >> 8, t[1 + (xor(s, CAST(x AS BIGINT)) & 255)]))) AS h FROM b, t
    ), w AS (
        SELECT word, CAST(sum(n) AS BIGINT) AS n
        FROM (SELECT n, CASE WHEN h % 199 = 0 THEN substr(run, 1, CAST(h % length(run) AS INT)) || substr(run, CAST(h % length(run) AS INT) + 2) ELSE run END AS word FROM h)
        WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5
    ), i AS (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM w),
    m AS (SELECT word, n, i, substr(word, 1, i - 1) || '*' || substr(word, i + 1) AS hidden, substr(word, 1, i - 1) || substr(word, i + 1) AS out FROM i),
    p AS (
        SELECT x.word, y.word AS near, y.n FROM m x JOIN m y ON x.hidden = y.hidden AND x.word <> y.word
        UNION SELECT m.word, w.word, w.n FROM m JOIN w ON m.out = w.word
        UNION SELECT w.word, m.word, m.n FROM m JOIN w ON m.out = w.word
    ), c AS (SELECT word, count(*) AS n_near FROM p GROUP BY word),
    f AS (
        SELECT p.word, near AS form, p.n AS form_n FROM p JOIN w USING (word)
        QUALIFY row_number() OVER (PARTITION BY p.word ORDER BY p.n DESC, near) = 1 AND p.n >= 5 * w.n
    ), chain AS (
        WITH RECURSIVE chain AS (SELECT word, word AS root, 0 AS step FROM w UNION ALL SELECT c.word, f.form, step + 1 FROM chain c JOIN f ON f.word = c.root)
        SELECT word, arg_max(root, step) AS root FROM chain GROUP BY word
    )
    SELECT w.word, form, root, w.n, coalesce(n_near, 0) AS n_near, form_n
    FROM w LEFT JOIN c USING (word) LEFT JOIN f USING (word) JOIN chain USING (word)
    """


@query("op12_spelling", _spelling_sql())
def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every frequent word with the commoner word it is a variant of."""
    return spelling.spelling_groups(spelling.word_counts(table(spark, sf_dir, "documents"), dropped=199))


@query(
    "op13_topk",
    """
    WITH v AS (
        SELECT vec_id, row_number() OVER () AS row, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS e FROM embeddings
        WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    ), s AS (
        SELECT q.vec_id AS query_id, q.row, c.vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
        FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.row <> c.row
    )
    SELECT query_id, rank, vec_id, score
    FROM (SELECT *, CAST(row_number() OVER (PARTITION BY row ORDER BY score DESC, vec_id) AS INT) AS rank FROM s) WHERE rank <= 20
    """,
)
def op13_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 other vectors of largest inner product of every twentieth vector."""
    return topk.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)
