"""Small tables with awkward rows, and brute-force versions of the contracts."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

from pyspark.sql import functions as F  # noqa: F401  (for the tests)

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n_removed string, words string, fp long"


def words(text, pattern=r"[^\x20\x09-\x0D]+"):
    return re.findall(pattern, text or "")


def texts(seed=0, n=60):
    """Invented prose with copies, near copies, shared passages, and odd texts."""
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcdeéñ") for _ in range(rng.randint(1, 7))) for _ in range(300)]

    def prose(k):
        out = []
        for _ in range(k):
            out.append(rng.choice(vocabulary))
            out.append(rng.choice([" "] * 9 + ["\n", ". ", " \t"]))
        return "".join(out)

    shared = prose(60)
    lines = "\n".join(prose(6).replace("\n", " ") for _ in range(5))
    out = []
    for i in range(n):
        text = prose(rng.randint(1, 200))
        if i % 5 == 1:
            text = prose(10) + shared[: rng.randint(60, len(shared))] + text
        if i % 7 == 2:
            text = text + "\n" + lines + "\n" + prose(5)
        if i % 6 == 3 and out:
            text = rng.choice(out)
        if i % 6 == 4 and out:
            ws = rng.choice(out).split(" ")
            ws[rng.randrange(len(ws))] = "edited"
            text = " ".join(ws)
        out.append(text)
    odd = ["", " ", "\n\n\n", "A", "one two", "ab" * 400, "x " * 300, "\n\n\n\n", "é", "a\x00b \x1f c", lines, shared]
    return out + odd


def documents(spark, seed=0, n=60, extra=()):
    """The texts as documents, with a null text, a null id, a repeated row and clashing columns."""
    found = [*texts(seed, n), None, *extra]
    rows = [(i, t, ["en", "fr"][i % 2], "s", len(t or ""), "x", "y", 1) for i, t in enumerate(found)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def awkward(spark, seed=0):
    """Documents plus rows with null ids and rows that repeat."""
    docs = documents(spark, seed, 20)
    again = docs.where("doc_id in (3, 4, 7)")
    nulls = spark.createDataFrame(
        [(None, "null id text here", None, None, None, None, None, None), (None, None, None, None, None, None, None, None)],
        SCHEMA,
    )
    return docs.unionByName(again).unionByName(nulls)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def base_rules(text):
    ws = words(text)
    windows = Counter(tuple(ws[i : i + 8]) for i in range(len(ws) - 7))
    inside = set()
    for i in range(len(ws) - 7):
        if windows[tuple(ws[i : i + 8])] > 1:
            inside.update(range(i, i + 8))
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if words(line):
            dup += line in seen
            seen.add(line)
    failed = len(ws) < 20 or 100 * len(inside) > 30 * len(ws)
    return (len(ws), sum(map(len, ws)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(inside), failed)


def line_dedup(rows):
    """doc_id -> text after removing later three-line windows; rows are (doc_id, text)."""
    seen, gone = set(), {}
    for doc, text in sorted(set((d, t or "") for d, t in rows)):
        ls = text.split("\n")
        for i in range(len(ls) - 2):
            key = tuple(ls[i : i + 3])
            if words("".join(key)):
                if key in seen:
                    gone.setdefault(doc, set()).update((i, i + 1, i + 2))
                seen.add(key)
    return {
        d: "\n".join(x for i, x in enumerate((t or "").split("\n")) if i not in gone.get(d, ()))
        for d, t in rows
    }


def simhash(text):
    import xxhash

    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    ws = words(lowered)
    if not ws:
        return 0
    shingles = [" ".join(ws[i : i + 3]) for i in range(max(1, len(ws) - 2))]
    hs = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def groups(values, near):
    """value -> representative index under the transitive closure of ``near``."""
    up = list(range(len(values)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in range(len(values)):
        for j in range(i):
            if near(values[i], values[j]):
                a, b = sorted((root(i), root(j)))
                up[b] = a
    return [root(i) for i in range(len(values))]


FOLDED = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def folded_words(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(FOLDED, lowered)


def contamination(rows, items, size=10):
    """doc_id -> (n_words, n_hit, sorted items)."""
    needles = []
    for item, text in items:
        ws = folded_words(text)
        n = min(size, len(ws))
        needles += [(str(item), ws[i : i + n]) for i in range(len(ws) - n + 1) if n]
    out = {}
    for doc, text in rows:
        ws = folded_words(text)
        hit, found = set(), set()
        for item, needle in needles:
            for i in range(len(ws) - len(needle) + 1):
                if ws[i : i + len(needle)] == needle:
                    hit.update(range(i, i + len(needle)))
                    found.add(item)
        out[doc] = (len(ws), len(hit), sorted(found))
    return out


def alike_under_powers(k):
    """Two different texts of 2**k letters that any polynomial modulo 2**64 with an odd base takes for equal, from k = 10 on."""
    one, swap = "a", str.maketrans("ab", "ba")
    for _ in range(k):
        one += one.translate(swap)
    return one, one.translate(swap)
