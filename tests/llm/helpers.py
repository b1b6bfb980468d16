"""Small documents with every case that each operator must define, and brute-force versions."""

from __future__ import annotations

import collections
import random
import re

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, texts, **extra):
    """Documents numbered from 0 with the columns of the driver's table, and ``extra`` constant columns."""
    from pyspark.sql import functions as F

    rows = [(t if isinstance(t, tuple) else (i, t)) for i, t in enumerate(texts)]
    df = spark.createDataFrame([(i, t, "en", "src0", len(t or "")) for i, t in rows], DOCUMENTS)
    for name, value in extra.items():
        df = df.withColumn(name, F.lit(value))
    return df


def prose(seed: int, words: int, vocabulary: int = 400) -> str:
    r = random.Random(seed)
    return " ".join(f"w{r.randrange(vocabulary)}x" for _ in range(words))


def lowered(text: str) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def roots(n: int, links) -> list[int]:
    parent = list(range(n))

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in links:
        parent[root(a)] = root(b)
    return [root(x) for x in range(n)]


def brute_components(rows) -> list[tuple]:
    """(doc_id, n_shingles, component_id) of (doc_id, text) rows by comparing all pairs."""
    sets = []
    for _, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", lowered(text))
        sets.append({tuple(w[k : k + 3]) for k in range(max(1, len(w) - 2))} if w else set())
    links = [(i, j) for i in range(len(rows)) for j in range(i)
             if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 90 * len(sets[i] | sets[j])]
    root = roots(len(rows), links)
    low = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            low[root[k]] = min(low.get(root[k], i), i)
    return [(i, len(sets[k]), low.get(root[k]) if sets[k] else i) for k, (i, _) in enumerate(rows)]


def brute_contamination(rows, items, width=13) -> dict:
    """(n_words, n_hit, items) by doc_id."""
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered(t))
    windows = collections.defaultdict(set)
    for item, text in items:
        w = split(text)
        for k in range(len(w) - min(width, len(w)) + 1 if w else 0):
            windows[tuple(w[k : k + min(width, len(w))])].add(str(item))
    out = {}
    for doc_id, text in rows:
        w = split(text)
        hit, found = [0] * len(w), set()
        for size in {len(x) for x in windows}:
            for k in range(len(w) - size + 1):
                if own := windows.get(tuple(w[k : k + size])):
                    found |= own
                    hit[k : k + size] = [1] * size
        out[doc_id] = (len(w), sum(hit), sorted(found))
    return out
