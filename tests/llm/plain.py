"""Plain versions of the operators, for small tables."""

import hashlib
import re

import xxhash

SPACE = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return SPACE.findall(text or "")


def fingerprint(text):
    found = words(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not found:
        return 0
    shingles = [" ".join(found[i : i + 4]) for i in range(max(1, len(found) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(ids, linked):
    parent = {i: i for i in ids}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in linked:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {i: root(i) for i in ids}


def near_classes(rows, distance=4):
    """doc_id -> smallest id of its class, of (doc_id, text) rows."""
    prints = [(i, fingerprint(t)) for i, t in rows]
    pairs = [(a, b) for a, x in prints for b, y in prints if a > b and (x ^ y).bit_count() <= distance]
    return components({i for i, _ in prints}, pairs)


def base_spans(text):
    text = text or ""
    keyword = "|".join("".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in k) for k in ("password", "passwd", "secret", "token"))
    assign = rf"""(?:{keyword}|[aA][pP][iI]_?[kK][eE][yY])["']? *[:=] *["']?([A-Za-z0-9+/_.=-]+)"""
    found = [(m.start(), 0, "assign", m.end()) for m in re.finditer(assign, text) if len(m[1]) >= 6]
    found += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return ",".join(f"{k}:{s}:{e}" for s, _, k, e in sorted(found))


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def benchmark_words(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lowered)


def contaminated(text, items, window=10):
    """(hit words, items) of a text, for (item_id, text) rows."""
    found, hit, listed = benchmark_words(text), set(), set()
    for item, passage in items:
        w = benchmark_words(passage)
        size = min(window, len(w))
        patterns = {tuple(w[i : i + size]) for i in range(len(w) - size + 1)} if size else set()
        for i in range(len(found) - size + 1):
            if tuple(found[i : i + size]) in patterns:
                hit.update(range(i, i + size))
                listed.add(item)
    return hit, listed


def without_repeats(rows, size=13):
    """doc_id -> (words, removed words, kept text) of (doc_id, text) rows."""
    first, out = {}, {}
    for i, t in rows:
        w = words(t)
        for k in range(len(w) - size + 1):
            key = tuple(w[k : k + size])
            first[key] = min(first.get(key, i), i)
    for i, t in rows:
        w, gone = words(t), set()
        for k in range(len(w) - size + 1):
            if first[tuple(w[k : k + size])] < i:
                gone.update(range(k, k + size))
        out[i] = (len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone))
    return out
