"""Phrase mining, spelling variants and top-k search against plain versions, with the edges of their inputs."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from fixedrecon.llm import phrases, spelling, topk
from fixedrecon.llm.arrays import BitSet, bit_set, strings
from fixedrecon.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, key long, phrase string, word string, n long, rank int"


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, g, 1, "p", "w", 2, 3) for i, t, g in rows], DOCS)


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


# phrases


def plain_collocations(rows, least, top=2000):
    f, n = {}, Counter()
    for _, text, lang in rows:
        lang = lang or "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", lowered(text)):
            w = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, 5):
                for i in range(len(w) - k + 1):
                    f[lang, tuple(w[i : i + k])] = f.get((lang, tuple(w[i : i + k])), 0) + 1
    out = []
    for lang in n:
        mine = {p: c for (g, p), c in f.items() if g == lang and c >= least}
        found = []
        for p, a in mine.items():
            longer = [q for q in mine if len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))]
            if len(p) > 1 and not any(100 * mine[q] >= 80 * a for q in longer):
                score, _, l, r = min((2_000_000 * a // (mine[p[:k]] + mine[p[k:]]), k, mine[p[:k]], mine[p[k:]]) for k in range(1, len(p)))
                found.append((-score, -a, " ".join(p).encode(), l, r))
        for rank, (score, a, p, l, r) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, p.decode(), -a, l, r, n[lang], -score))
    return sorted(out)


def drawn_docs(seed, count, names=("alpha", "beta", "Gamma", "delta", "é", "the", "of")):
    draw = random.Random(seed)
    rows = []
    for i in range(count):
        words = [draw.choice(names) + draw.choice([" ", "  ", "\t", ". ", ",", "\n", "\x0b", " "]) for _ in range(draw.randrange(60))]
        rows.append((i, "".join(words), draw.choice(["en", "de", None, "und"])))
    return rows


@pytest.mark.parametrize("least", [1, 5, 30])
def test_collocations_equal_a_plain_version(spark, least):
    rows = [*drawn_docs(7, 120), (1, None, "en"), (None, "", "fr"), (5, "only, one. word", None), (6, " .;\t", "en")]
    found = phrases.collocations(docs_of(spark, rows).repartition(5), least=least)
    assert sorted(tuple(r) for r in found.collect()) == plain_collocations(rows, least)


def test_collocations_with_ties_repeated_rows_and_a_long_text(spark):
    rows = [(1, "a b. c d. " * 40, "x"), (1, "a b. c d. " * 40, "x"), (2, "y" * 300_000 + " " + "long text here " * 9000, "x")]
    found = phrases.collocations(docs_of(spark, rows), least=30, top=3)
    expected = plain_collocations(rows, 30, 3)
    assert sorted(tuple(r) for r in found.collect()) == expected and [r[2] for r in expected[:2]] == ["a b", "c d"]


def test_collocations_of_nothing(spark):
    assert phrases.collocations(docs_of(spark, [])).count() == 0
    assert phrases.collocations(docs_of(spark, [(1, None, None), (2, "", "en")])).count() == 0


def test_a_shard_misses_no_frequent_phrase(spark):
    """A phrase spread evenly over all partitions is locally as rare as it can be."""
    rows = [(i, "rare pair here" if i % 10 == 0 else f"w{i} x{i}", "en") for i in range(300)]
    found = phrases.frequent_phrases(docs_of(spark, rows).repartition(30), least=30)
    assert {r["phrase"] for r in found.collect() if r["f"] == 30} >= {"rare pair here", "rare pair", "pair here", "rare"}


def test_bit_set(spark):
    keys = [random.Random(2).getrandbits(64) for _ in range(3000)]
    df = spark.createDataFrame([(k - (1 << 64) if k >> 63 else k,) for k in keys], "key long")
    found = bit_set(df, 3000)
    assert found.holds(np.array(keys, dtype=np.uint64)).all() and keys[0] in found
    others = np.random.default_rng(1).integers(0, 1 << 63, 10_000, dtype=np.uint64)
    assert found.holds(others).mean() < 0.01
    assert not bit_set(df.limit(0), 0).holds(others).any()
    assert BitSet(np.full(1 << 17, 255, np.uint8)).holds(others).all()


def test_strings_of_byte_ranges():
    data = np.frombuffer("añb c".encode(), np.uint8)
    assert strings(data, np.array([0, 3, 5]), np.array([3, 3, 6])).to_pylist() == ["añ", "", "c"]


# spelling


def plain_words(rows, least_length, least, dropped):
    n = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = lowered(run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if dropped and h % dropped == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= least_length:
                n[run] += 1
    return {w: c for w, c in n.items() if c >= least}


def one_apart(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_groups(n, ratio=5):
    forms, out = {}, {}
    for w in n:
        near = [x for x in n if abs(len(x) - len(w)) < 2 and one_apart(w, x)]
        best = min(((-n[x], x) for x in near), default=None)
        forms[w] = best[1] if best and -best[0] >= ratio * n[w] else None
        out[w] = len(near)
    def root(w):
        return root(forms[w]) if forms[w] else w
    return {(w, forms[w], root(w), n[w], out[w], n[forms[w]] if forms[w] else None) for w in n}


SPELL = "doc_id long, text string, word string, near string, key long, n long, form string"


def spell_docs(spark, rows):
    return spark.createDataFrame([(i, t, "w", "x", 1, 2, "f") for i, t in rows], SPELL)


def variants(draw, word, letters):
    at = draw.randrange(len(word) + 1)
    kind = draw.randrange(3)
    return word[:at] + ("" if kind == 0 else draw.choice(letters)) + word[at + (kind != 1) :]


@pytest.mark.parametrize("dropped", [None, 7, 199])
def test_words_equal_a_plain_count(spark, dropped):
    draw = random.Random(4)
    letters = "abcXYZéÉÿß÷×"
    rows = [(draw.choice([1, 2, 30, None]), " ".join("".join(draw.choice(letters) for _ in range(draw.randrange(1, 9))) for _ in range(80)) + "漢a_b1c") for _ in range(40)]
    rows += [(9, None), (9, ""), (10, "a" * 70_000), (10, "ab" * 40), (11, "Straße's ÿÿÿÿÿÿ")]
    found = spelling.word_counts(spell_docs(spark, rows), 3, 2, dropped)
    assert {r["word"]: r["n"] for r in found.collect()} == plain_words(rows, 3, 2, dropped)


@pytest.mark.parametrize("letters, size", [("ab", 6), ("abcdefghij", 6), ("éabc", 9), ("abcdefghijklmnopqrstuvwxyzéàü", 12)])
def test_groups_equal_all_pairs(spark, letters, size):
    draw = random.Random(size)
    words = {"".join(draw.choice(letters) for _ in range(size + draw.randrange(2))) for _ in range(60)}
    for _ in range(3):
        words |= {v for w in sorted(words) for v in [variants(draw, w, letters)] if len(v) >= 6}
    n = {w: draw.choice([5, 5, 6, 25, 30, 150, 800]) for w in sorted(words)}
    found = spelling.spelling_groups(spark.createDataFrame(list(n.items()), "word string, n long").repartition(4))
    assert {tuple(r) for r in found.collect()} == plain_groups(n)


def test_groups_with_a_grown_dictionary(spark, monkeypatch):
    """Few words make frequent grams when the floor is low: longer grams, the same groups."""
    monkeypatch.setattr(spelling, "LEAST_FLOOR", 1)
    draw = random.Random(11)
    n = {"".join(draw.choice("abc") for _ in range(draw.randrange(6, 10))): draw.choice([5, 30, 200]) for _ in range(500)}
    n |= {"x" * 40: 5, "x" * 41: 9, "x" * 42: 70, "y" * 9000: 5, "y" * 8999 + "z": 5}
    words = spark.createDataFrame(list(n.items()), "word string, n long")
    assert len(spelling.gram_dictionary(words).grams) > 20
    assert {tuple(r) for r in spelling.spelling_groups(words).collect()} == plain_groups(n)


def test_chains_lead_to_one_root(spark):
    n = {"aaaaaa" + "b" * k: 5 ** (k + 1) for k in range(14)}
    found = {r["word"]: r for r in spelling.spelling_groups(spark.createDataFrame(list(n.items()), "word string, n long")).collect()}
    assert {r["root"] for r in found.values()} == {"aaaaaa" + "b" * 13}
    assert found["aaaaaa" + "b" * 13]["form"] is None and found["aaaaaa"]["form_n"] == 25


def test_probed_grams_lie_apart():
    for length, _, matrix in spelling._by_length(pa.array(["thaner", "thaners", "ÀÉîõüý", "a" * 25])):
        for floor in (0, 5):
            dictionary = spelling.GramDictionary(np.zeros(0, np.uint64), np.zeros(0, np.int64), floor)
            size, _, places = spelling.decompose(matrix, spelling.longest_gram(length), dictionary)
            first, second = spelling.probes(size, places)
            assert (first + size[np.arange(len(size)), first] <= second).all()


def test_spelling_of_nothing(spark):
    assert spelling.spelling_groups(spelling.word_counts(spell_docs(spark, []))).count() == 0
    assert spelling.spelling_groups(spelling.word_counts(spell_docs(spark, [(1, None)] * 9 + [(2, "")]))).count() == 0


# top-k


VECTORS = "vec_id long, embedding array<double>, label int, row long, v string, norm double, shard int, is_query string"


def vectors_of(spark, rows):
    return spark.createDataFrame([(i, v, 1, 2, "v", 0.5, 3, "q") for i, v in rows], VECTORS)


def plain_top(rows, k):
    whole = [(i, [math.floor(64 * x) for x in v]) for i, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for a, (i, q) in enumerate(whole):
        if i is not None and i % 20 == 0:
            scored = [(-sum(x * y for x, y in zip(q, c)), j is None, j) for b, (j, c) in enumerate(whole) if a != b]
            out += [(i, rank, j, -s) for rank, (s, _, j) in enumerate(sorted(scored, key=lambda x: (x[0], x[1], x[2] or 0))[:k], 1)]
    return sorted(out, key=repr)


def found_top(spark, rows, k=20):
    from pyspark.sql import functions as F

    found = topk.search(vectors_of(spark, rows), F.col("vec_id") % 20 == 0, k)
    return sorted((tuple(r) for r in found.collect()), key=repr)


def test_top_k_equals_all_products(spark, monkeypatch):
    monkeypatch.setattr(topk, "LEAST_ROWS", 50)
    monkeypatch.setattr(topk, "SLICE", 16)
    monkeypatch.setattr(topk, "SEEDS", 40)
    draw = np.random.default_rng(5)
    rows = [(i, (draw.normal(size=8) * draw.choice([0.1, 1, 4])).tolist()) for i in range(400)]
    rows += [(400, None), (401, [None] * 8), (402, [math.nan] * 8), (403, [math.inf] + [0.0] * 7), (420, []), (421, [1.0]), (440, [1.0] * 12)]
    rows += [(20, rows[20][1]), (20, rows[21][1]), (None, rows[0][1]), (None, [9.0] * 8)]
    assert found_top(spark, rows, 5) == plain_top(rows, 5)


def test_top_k_of_ties_and_copies(spark, monkeypatch):
    monkeypatch.setattr(topk, "LEAST_ROWS", 30)
    monkeypatch.setattr(topk, "SLICE", 8)
    rows = [(i, [0.5, -0.25, 0.0]) for i in range(200)] + [(i, [-1.0, -1.0, 2.0]) for i in range(200, 230)]
    assert found_top(spark, rows, 20) == plain_top(rows, 20)


@pytest.mark.parametrize("count", [0, 1, 3])
def test_top_k_of_few(spark, count):
    rows = [(20 * i, [float(i), 1.0]) for i in range(count)]
    assert found_top(spark, rows) == plain_top(rows, 20)


def test_top_k_of_zeros_and_of_no_query(spark):
    rows = [(i, [0.0, 0.0]) for i in range(60)]
    assert found_top(spark, rows, 3) == plain_top(rows, 3)
    assert found_top(spark, [(1, [1.0]), (2, [2.0])]) == []


def test_products_beyond_doubles_are_exact(spark):
    rows = [(i, [float(2**24 + i), float(2**25 - i)]) for i in range(41)]
    assert found_top(spark, rows) == plain_top(rows, 20)
    top = found_top(spark, [(0, [1e300, 1.0]), (1, [1e300, 1.0]), (2, [-1e300, 1.0])])
    assert [(r[2], r[3]) for r in top] == [(1, 2**63 - 1), (2, -(2**63))]


def test_bounds_hold_for_every_pair():
    draw = np.random.default_rng(8)
    q, c = draw.integers(-60, 60, (50, 16)), draw.integers(-60, 60, (80, 16))
    turn = topk.svd_turn(c)
    assert np.allclose(turn.T @ turn, np.eye(16))
    qb, cb = (topk.Bounds(x, np.sqrt((x**2).sum(axis=1)), turn) for x in (q, c))
    assert (qb.above(np.arange(50), cb, slice(0, 80)) + 1e-6 >= q @ c.T).all()


def test_registered_queries_have_results(spark):
    assert QUERIES["op12_spelling"](spark, SF_DIR).count() > 100
    assert QUERIES["op13_topk"](spark, SF_DIR).where("rank = 20").count() > 0
