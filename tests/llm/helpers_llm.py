"""Brute-force versions of the operators, in plain Python."""

from __future__ import annotations

import hashlib
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")

LONG = " ".join(f"w{i * 7919 % 40009}" for i in range(30_000))

#: Nulls, empty and odd texts, repeated rows, a very long text, near copies.
BASE = " ".join(f"word{i}" for i in range(60))
TEXTS = [
    (1, BASE),
    (2, BASE.replace("word30 ", "other ")),
    (3, BASE.upper()),
    (4, None),
    (5, ""),
    (6, " \t\n "),
    (7, "one two three"),
    (8, "One  two\nTHREE"),
    (9, "one two four"),
    (10, "zzz " + BASE + " tail"),
    (11, LONG),
    (12, LONG + " extra words at the end"),
    (12, LONG + " extra words at the end"),
    (None, BASE),
    (None, None),
    (13, "a a a a a a a a a a a a a a a a a a a a"),
    (14, "a a a a a a a a a a a a a a a a"),
    (15, "日本語 テキスト é ﬁ 😀 " * 5),
    (-3, "start " + " ".join(f"x{i}" for i in range(20)) + " end"),
    (16, "other " + " ".join(f"x{i}" for i in range(20)) + " rest"),
]


def documents(spark, rows=TEXTS):
    """As a table with columns whose names the operators use inside."""
    wide = [(i, t, "en", "s", None if t is None else len(t), 1, "r", None, 7) for i, t in rows]
    return spark.createDataFrame(wide, "doc_id long, text string, lang string, source string, n_chars long, n int, row string, z string, component long")


def shingles(text: str | None, k: int = 5) -> set:
    low = (text or "").translate({c: c + 32 for c in range(65, 91)})
    w = WORD.findall(low)
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def brute_components(rows):
    """{doc_id: (n_shingles, component)} by comparing all pairs."""
    sets = {i: shingles(t) for i, t in rows if i is not None}
    label = {i: i for i in sets}

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b]:
                common = len(sets[a] & sets[b])
                if 100 * common >= 75 * len(sets[a] | sets[b]):
                    x, y = sorted((find(a), find(b)))
                    label[y] = x
    return {i: (len(sets[i]), find(i)) for i in ids}


def brute_repeats(rows, window: int = 13):
    """{doc_id: (n_words, n_removed, sha256)}."""
    words = {i: WORD.findall(t or "") for i, t in rows if i is not None}
    first = {}
    for i in sorted(words):
        for j in range(len(words[i]) - window + 1):
            first.setdefault(tuple(words[i][j : j + window]), i)
    out = {}
    for i, w in words.items():
        gone = set()
        for j in range(len(w) - window + 1):
            if first[tuple(w[j : j + window])] < i:
                gone.update(range(j, j + window))
        kept = [x for j, x in enumerate(w) if j not in gone]
        out[i] = (len(w), len(gone), hashlib.sha256(" ".join(kept).encode()).hexdigest())
    return out
