"""Small tables with the awkward cases, and brute-force versions of the operators."""

from __future__ import annotations

import re
import string
from collections import Counter, defaultdict

import public_tokenizers

JSON_BPE = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
SPACE_WORD = re.compile("[^\x20\x09-\x0d]+")

DOC_SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    # names that operators use themselves
    "kept boolean, n_words long, spans string, n_lines int, key string, h1 int, digest string, ids string"
)


def doc_rows(texts, langs=None):
    """Rows of DOC_SCHEMA; the columns after n_chars only clash in name."""
    langs = langs or ["en"] * len(texts)
    return [
        (i, t, lang, "s", len(t or ""), None, 7, "x", 1, "k", 2, "d", "i")
        for i, (t, lang) in enumerate(zip(texts, langs))
    ]


def documents(spark, texts, langs=None):
    return spark.createDataFrame(doc_rows(texts, langs), DOC_SCHEMA)


def awkward(spark):
    """Null, empty, white and very long texts, ties, repeated rows, null ids, clashing column names."""
    long = "x" * 40_000 + " " + "many words and more " * 3_000
    texts = [None, "", " \n\t ", "One line\nOne line\nOne line", long, "né 中文 😀 <|endoftext|>'s", "a b", "A B"]
    rows = doc_rows(texts)
    rows += [rows[3], rows[4], rows[0], (None, "One line\nOne line\nOne line", None, None, None, *rows[0][5:])]
    return spark.createDataFrame(rows, DOC_SCHEMA)


def empty(spark):
    return spark.createDataFrame([], DOC_SCHEMA)


def words(text):
    return SPACE_WORD.findall(text or "")


def shingles(text, size):
    w = words((text or "").translate(LOWER))
    if len(w) >= size:
        return frozenset(tuple(w[i : i + size]) for i in range(len(w) - size + 1))
    return frozenset([tuple(w)]) if w else frozenset()


def components(rows, size, percent):
    """Smallest id of the component of each row (id, text)."""
    sets = [shingles(t, size) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    holders = defaultdict(list)
    for i, s in enumerate(sets):
        shared = Counter(j for g in s for j in holders[g])
        for j, n in shared.items():
            if 100 * n >= percent * (len(s) + len(sets[j]) - n):
                a, b = sorted((find(i), find(j)))
                root[b] = a
        for g in s:
            holders[g].append(i)
    lowest = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            r = find(i)
            lowest[r] = min(doc, lowest.get(r, doc))
    return [lowest.get(find(i)) for i in range(len(rows))]
