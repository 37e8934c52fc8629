"""Secrets in texts: three patterns, and a battery of randomness tests for other strings.

Patterns find assignments to names of secrets, access keys and hexadecimal runs. Besides, every
run of 20 or more characters of the usual encodings is a candidate. Its encoding is inferred
(hexadecimal of one case, base32, base36 of one case, base62, base64 with either pair of signs) and three tests ask whether
its characters may be uniform over that alphabet: chi-squared over the whole alphabet and over its parts,
Wald-Wolfowitz runs about its middle, and serial correlation of neighbours. Their joint p-value is one factor of the
controlled one: what it rejects at ``BATTERY_LEVEL`` is no random string, and what it half believes needs more evidence. The
other factor grows with the length: the probability of the string as *ordinary text* (changes between cases, digits
and signs; pairs of letters, see ``letter_model.py``) against that of uniform characters of the encoding, a ratio that
bounds a p-value. Parts between signs are candidates of their own. Of a
text's candidates those are taken that Benjamini and Hochberg's procedure accepts at ``FALSE_DISCOVERY``; of
nested ones the longest, unless what a part leaves out of it is ordinary.

Positions count code points, ends are exclusive. Defined results: a null or empty text has no spans;
each row is scanned by itself, so repeated rows get equal spans; other columns are not looked at."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fixedrecon.llm.shared import lean

KINDS = ("assign", "access", "hex", "random")
ASSIGN = re.compile(
    r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # the runs of 24 and more are the long ones among all runs
CANDIDATE = re.compile(r"[A-Za-z0-9+/_-]{20,}={0,2}")
BATTERY_LEVEL, FALSE_DISCOVERY = 0.001, 1e-3
PARTS = tuple(re.compile(rf"[^={signs}]{{20,}}={{0,2}}") for signs in ("/", "_-", "/_-"))

#: Ordinary strings, fixed values that ``letter_model.py`` counts in the interpreter's standard library: how often a
#: lower-case letter, an upper-case letter, a digit and a sign are followed by each of these; the last row is for the
#: first character.
FOLLOWS = (
    (0.88, 0.026, 0.019, 0.075),
    (0.175, 0.711, 0.02, 0.095),
    (0.11, 0.027, 0.766, 0.097),
    (0.641, 0.2, 0.053, 0.106),
    (0.543, 0.243, 0.058, 0.157),
)
#: Quarter bits (base 36) of each letter after each letter, a to z, either case, and of first letters: from the same count.
LETTER_PAIRS = """
    ukggurjvkvodgfwjwcfbmkrpov colqestsejvbprflvihodvvvhs duopdrtekvfhqs9ruindktvwrv fqpi7nstbtuhsqfrwkinfsstov
    hrgfnlotrvtikdrlpbcesnoiov funmgert8wwgssbtvflkhvtwow krqr6tlhewwinglqwfemjsuvus 7usr9tvtewspoqbtwiohmvuvrv
    llgjkmjwuvsgi8ekvkfevmwnwl dwpr8swskwhuuwcjwufs9wswrw irmn5lmrcwuirlnpsmepoujusv eqqj8qtubwtftscowtkikruwju
    aktq8uvufwsmkqcdwtkokvvwqw etgdekctivnosngpusfblnuvsv nmheunnvpvnigakhwbiihnkqvu atppbrtohwteusehuclglstwjw
    qstssvwtwwwiukwqqimr2vuwww dtml8qkvewookmdqwjfgmosvkw kuisarqievnmrsihtqf9hssvlv esmo9qufbwtnorgnveijktrvjt
    lilofmowjwvcgbogwdfdsvwswv assv4rsvdwquqsnswrttuvsvvv atooesuiawvmngeqwdgqttoqwv krdodkuofwvmispcwqm8rstkhu
    onlnjntrkwviien8ulcbrqmuoq euqt4svocwwnlthpwsqtrwtvqs
""".split()
FIRST_LETTERS = "hjehhhkjhtoihjkgshdhlnlots"

DIGITS, UPPER, LOWER = "0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Alphabets in the order of inference, each in parts for the chi-squared test.
ENCODINGS = {
    "hex": (DIGITS, "abcdef"),
    "hex_upper": (DIGITS, "ABCDEF"),
    "base32": (UPPER[:13], UPPER[13:], "234567"),
    "base36": (DIGITS, LOWER[:13], LOWER[13:]),
    "base36_upper": (DIGITS, UPPER[:13], UPPER[13:]),
    "base62": (DIGITS, UPPER[:13], UPPER[13:], LOWER[:13], LOWER[13:]),
    "base64": (UPPER[:13], UPPER[13:], LOWER[:13], LOWER[13:], DIGITS + "+/"),
    "base64url": (UPPER[:13], UPPER[13:], LOWER[:13], LOWER[13:], DIGITS + "-_"),
}
ORDER = {name: {c: i for i, c in enumerate("".join(parts))} for name, parts in ENCODINGS.items()}


def encoding_of(token: str) -> str | None:
    """The narrowest encoding whose alphabet holds all characters but the padding."""
    used = set(token.rstrip("="))
    return next((name for name, order in ORDER.items() if used and used <= order.keys()), None)


def chi_squared_tail(x: float, freedom: int) -> float:
    """P(chi-squared >= x), by Wilson and Hilferty's normal approximation."""
    spread = 2 / (9 * freedom)
    return 0.5 * math.erfc((((x / freedom) ** (1 / 3)) - (1 - spread)) / math.sqrt(2 * spread))


def _two_sided(z: float) -> float:
    return math.erfc(abs(z) / math.sqrt(2))


def _uneven(token: str, parts: tuple[str, ...]) -> float:
    """Chi-squared tail of the counts of ``parts``. Mean and variance are those of the multinomial, so that
    few expected counts do not matter as much."""
    counts, n, total = Counter(token), len(token), sum(map(len, parts))
    x = sum((sum(counts[c] for c in p) - n * len(p) / total) ** 2 * total / (n * len(p)) for p in parts)
    inverse = sum(total / len(p) for p in parts)
    mean, k = len(parts) - 1, len(parts)
    variance = 2 * mean + (inverse - k * k - 2 * k + 2) / n
    return chi_squared_tail(2 * mean * x / variance, 2 * mean * mean / variance) if variance > 0 else 1.0


def uniformity(token: str, encoding: str) -> float:
    """Over all characters of the alphabet, and over its parts (digits against letters)."""
    parts = ENCODINGS[encoding]
    return min(1.0, 2 * min(_uneven(token, tuple("".join(parts))), _uneven(token, parts)))


def runs(token: str, encoding: str) -> float:
    order = ORDER[encoding]
    high = [2 * order[c] >= len(order) for c in token]
    above, n = sum(high), len(high)
    below = n - above
    if not above or not below:
        return 0.0
    mean = 2 * above * below / n + 1
    spread = (mean - 1) * (mean - 2) / (n - 1)
    return _two_sided((1 + sum(a != b for a, b in zip(high, high[1:])) - mean) / math.sqrt(spread)) if spread > 0 else 0.0


def serial_correlation(token: str, encoding: str) -> float:
    values = [ORDER[encoding][c] for c in token]
    n, mean = len(values), sum(values) / len(values)
    power = sum((v - mean) ** 2 for v in values)
    if not power:
        return 0.0
    r = sum((a - mean) * (b - mean) for a, b in zip(values, values[1:])) / power
    return _two_sided((r + 1 / n) * math.sqrt(n))


def battery(token: str) -> float:
    """p-value of the three tests together for uniform characters of the inferred encoding; 0 without an encoding."""
    encoding, token = encoding_of(token), token.rstrip("=")
    if encoding is None:
        return 0.0
    return min(1.0, 3 * min(t(token, encoding) for t in (uniformity, runs, serial_correlation)))


def looks_random(token: str) -> bool:
    """Whether no test of the battery rejects uniform characters, at ``BATTERY_LEVEL`` in all."""
    return battery(token) > BATTERY_LEVEL


def _class(c: str) -> int:
    return 0 if c.islower() else 1 if c.isupper() else 2 if c.isdigit() else 3


def ordinary_bits(token: str) -> float:
    """Minus the binary logarithm of the probability that the model of ordinary strings gives ``token``."""
    bits, before, letter = 0.0, 4, None
    for c in token:
        kind = _class(c)
        bits -= math.log2(FOLLOWS[before][kind])
        if kind < 2:
            place = ord(c.lower()) - 97
            bits += int((FIRST_LETTERS if letter is None else LETTER_PAIRS[letter])[place], 36) / 4
        else:
            place = None
            bits += math.log2(10 if kind == 2 else 4)
        before, letter = kind, place
    return bits


def surprise(token: str) -> float:
    """Minus the binary logarithm of the p-value against an ordinary string; 0 where the battery rejects.
    An ordinary string is 2**b times likelier as uniform characters with a probability of at most 2**-b, for each
    encoding. The battery's p-value counts against the string: as it is at most 1, the bound stays one."""
    fits = battery(token)
    if fits <= BATTERY_LEVEL:
        return 0.0
    encoding, token = encoding_of(token), token.rstrip("=")
    uniform = len(token) * math.log2(len(ORDER[encoding]))
    return max(0.0, ordinary_bits(token) - uniform + math.log2(fits) - math.log2(len(ENCODINGS)))


def candidates(text: str) -> list[tuple[int, int]]:
    """Spans of the runs of the encodings' characters, and of their parts between signs."""
    spans = set()
    for run in CANDIDATE.finditer(text):
        spans.add(run.span())
        for part in PARTS:
            spans.update(m.span() for m in part.finditer(text, *run.span()))
    return sorted(spans)


def random_strings(text: str) -> list[tuple[int, int]]:
    """Spans of the candidates that stay after the false-discovery control."""
    found = sorted((-surprise(text[s:e]), s, e) for s, e in candidates(text))
    accepted = max((i for i, (b, _, _) in enumerate(found, 1) if b <= math.log2(FALSE_DISCOVERY * i / len(found))), default=0)
    nested = sorted(found[:accepted], key=lambda x: (x[1], -x[2]))
    wide, around = set(), []  # around: spans that enclose the one in turn
    for b, s, e in nested:
        around = [x for x in around if x[2] > s]
        wide.update((a, z) for whole, a, z in around if e <= z and b <= whole + math.log2(FALSE_DISCOVERY))
        around.append((b, s, e))
    kept: list[tuple[int, int]] = []
    for _, s, e in nested:
        if (s, e) not in wide and not (kept and e <= kept[-1][1]):
            kept.append((s, e))
    return kept


def scan_text(text: str | None) -> list[tuple[int, int, int]]:
    """(start, number of the kind, end) in order; random strings within a pattern's span are left out."""
    if not text:
        return []
    base = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[1]) >= 6]
    base += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    base += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    more = [(s, 3, e) for s, e in random_strings(text) if not any(a <= s and e <= b for a, _, b in base)]
    return sorted(base + more)


SPAN = pa.list_(pa.struct([("kind", pa.string()), ("s", pa.int64()), ("e", pa.int64())]))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, spans): spans (kind, s, e) of each row's text by start, then kind."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = [[{"kind": KINDS[k], "s": s, "e": e} for s, k, e in scan_text(t.as_py())] for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, SPAN)], ["doc_id", "spans"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(lean(run), "doc_id long, spans array<struct<kind:string,s:long,e:long>>")


def masked_text(text: str | None, mask: str) -> str | None:
    """The text with every span, overlapping ones as one, replaced by the mask."""
    spans = scan_text(text)
    if not spans:
        return text
    parts, at = [], 0
    for s, _, e in spans:
        if s >= at:
            parts += [text[at:s], mask]
        at = max(at, e)
    return "".join(parts) + text[at:]


def mask_secrets(docs: DataFrame, mask: str = "<secret>", text_col: str = "text") -> DataFrame:
    """``docs`` with secrets in the text replaced; all columns and rows stay."""
    schema, at = docs.schema, docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pa.array([masked_text(t.as_py(), mask) for t in batch.column(at)], pa.string())
            columns = batch.columns
            columns[at] = texts
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return docs.mapInArrow(lean(run), schema)


def joined(spans: Column) -> Column:
    """kind:start:end of all spans, comma-joined."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["s"].cast("string"), x["e"].cast("string"))), ",")


def count_of(kind: str) -> Column:
    return F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("long")
