"""Quality rules: a threshold table compiled into one projection of native expressions.

Metrics of a text (a word is a run of characters other than blanks, tabs and line ends):
``n_words``, ``word_chars`` (code points in words), ``n_symbols``, ``n_lines`` (lines with a word),
``n_dup_lines`` (of them, equal to an earlier one), ``n_stop_words``, and ``n_repeat_words`` (words
in five-word windows that occur twice or more). A rule bounds the ratio of two metrics, from a
number of words on. No row leaves its task: there is no shuffle, no Python and no explode.

Repeated windows are found within the row: each window's hash shares one long with its position,
the longs are sorted, and neighbours with equal hashes are compared word by word.

Defined results: a null text is empty, has no words and fails the base rule; a ratio whose
denominator is zero passes its rule; rows are judged each by itself, so repeated rows get
equal verdicts; other columns are not looked at."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLANK = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]"
WINDOW = 5
# Frequent function words of English, German, French and Spanish.
STOP_WORDS = (
    "the of and to in is it that for with as was on are be this from or an by "
    "der die das und in zu den ist mit von für auf ein eine im dem nicht des sich auch "
    "le la les de des et en un une du est que qui dans pour par sur pas au ce "
    "el los las y del que en un una por con para se no es su al lo como más"
).split()


@dataclass(frozen=True)
class Rule:
    """``low`` <= numerator / denominator <= ``high`` for texts of ``from_words`` words or more."""

    name: str
    numerator: str
    denominator: str | None
    low: float | None
    high: float | None
    from_words: int = 0


RULES = (
    Rule("length", "n_words", None, None, 1_000_000),
    Rule("word_length", "word_chars", "n_words", 2.0, 20.0),
    Rule("symbols", "n_symbols", "n_words", None, 0.1),
    Rule("duplicate_lines", "n_dup_lines", "n_lines", None, 0.5),
    Rule("stop_words", "n_stop_words", "n_words", 0.02, None, 50),
)


def verdict(rules: tuple[Rule, ...] = RULES) -> Column:
    """Whether a row of metrics passes all rules."""
    return reduce(lambda a, b: a & b, [_passes(r) for r in rules], F.lit(True))


def failed_rules(rules: tuple[Rule, ...] = RULES) -> Column:
    """The names of the rules that a row of metrics breaks."""
    return F.array_compact(F.array(*[F.when(~_passes(r), F.lit(r.name)) for r in rules]))


def _passes(rule: Rule) -> Column:
    value = F.col(rule.numerator).cast("double")
    if rule.denominator is not None:
        value = F.try_divide(value, F.col(rule.denominator).cast("double"))
    ok = F.lit(True)
    if rule.low is not None:
        ok &= value >= rule.low
    if rule.high is not None:
        ok &= value <= rule.high
    return F.coalesce(ok, F.lit(True)) | (F.col("n_words") < rule.from_words)


def text_metrics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_stop_words, n_repeat_words),
    one row for each row of ``docs``."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    trimmed = F.btrim(text, F.lit(" \t\n\x0b\x0c\r"))
    split = docs.select(
        F.col(id_col).alias("doc_id"),
        F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, BLANK)).alias("words"),
        F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]")).alias("lines"),
        F.regexp_count(text, F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
    )
    hashed = split.select(
        "doc_id", "n_symbols", "words",
        F.size("words").alias("size"),
        F.char_length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.size(F.filter("words", lambda w: F.lower(w).isin(STOP_WORDS))).cast("long").alias("n_stop_words"),
        F.transform("words", lambda w: F.xxhash64(w)).alias("hashes"),
    )
    kept = ["doc_id", "n_symbols", "size", "word_chars", "n_lines", "n_dup_lines", "n_stop_words", "words"]
    # the low bits, enough for any position, hold the position; the rest the window's hash
    packed = hashed.select(
        *kept,
        F.expr("shiftleft(1L, length(bin(size))) - 1").alias("low"),
        F.expr(
            f"""CASE WHEN size < {WINDOW} THEN CAST(array() AS array<bigint>) ELSE
            transform(sequence(0, size - {WINDOW}),
                      i -> (xxhash64({", ".join(f"get(hashes, i + {k})" for k in range(WINDOW))})
                            & ~(shiftleft(1L, length(bin(size))) - 1)) | i) END"""
        ).alias("packed"),
    )
    ordered = packed.select(*kept, "low", F.sort_array("packed").alias("packed"))
    same = f"""(x ^ get(packed, k + {{0}})) BETWEEN 0 AND low AND slice(words, CAST(x & low AS int) + 1, {WINDOW})
               = slice(words, CAST(get(packed, k + {{0}}) & low AS int) + 1, {WINDOW})"""
    places = ordered.select(
        *kept[:-1],
        F.expr(
            f"""sort_array(transform(filter(packed, (x, k) ->
                coalesce({same.format("1")}, false) OR (k > 0 AND coalesce({same.format("-1")}, false))), x -> x & low))"""
        ).alias("places"),
    )
    return places.select(
        "doc_id", F.col("size").cast("long").alias("n_words"), "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_stop_words",
        F.expr(
            f"""aggregate(transform(places, (p, k) -> least({WINDOW}L, coalesce(get(places, k + 1) - p, {WINDOW}L))),
                          0L, (a, b) -> a + b)"""
        ).alias("n_repeat_words"),
    )


def base_failed() -> Column:
    """The rule that comes before the table: ten words at least, a fifth of them repeated at most."""
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def judge(docs: DataFrame, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The metrics with ``base_failed``, ``failed`` (names of broken rules) and ``kept``."""
    return text_metrics(docs, id_col, text_col).select(
        "*", base_failed().alias("base_failed"), failed_rules(rules).alias("failed"), (~base_failed() & verdict(rules)).alias("kept")
    )
