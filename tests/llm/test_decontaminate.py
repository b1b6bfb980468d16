import hashlib
import random

import numpy as np
from helpers import brute_contamination, documents, prose

from visitflow.llm import decontaminate as d


def test_search_and_locate():
    r = np.random.default_rng(4)
    for _ in range(30):
        n = int(r.integers(1, 200))
        text = r.integers(1, 5, n)  # 1 separates
        text[-1] = 1
        index = d.FmIndex(np.append(text, 0), 5)
        windows = np.array([[a, b, 0] for a in range(2, 5) for b in range(2, 5)] + [[2, 3, 4], [3, 0, 0]])
        which, low, high = index.search(windows, (windows > 0).sum(axis=1))
        got = {int(w): sorted(index.locate(np.arange(a, b)).tolist()) for w, a, b in zip(which, low, high)}
        for k, w in enumerate(windows):
            w = w[w > 0]
            want = [i for i in range(n - len(w) + 1) if (text[i : i + len(w)] == w).all()]
            assert got.get(k, []) == want


def test_like_brute_force(spark):
    r = random.Random(7)
    items = [(k, prose(1000 + k, r.randrange(1, 40), 30)) for k in range(25)] + [(90, None), (91, ""), (92, "..!"), (93, "W1X"), (3, prose(1003, 20, 30)), (None, "w5x w6x")]
    texts = [prose(k, r.randrange(0, 200), 30) for k in range(60)] + [None, "", "...", prose(5, 30_000, 3000)]
    for k in range(0, 60, 3):
        texts[k] += " " + items[k % 25][1].upper() + ", " + prose(k, 9, 30)
    rows = list(enumerate(texts))
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    want = brute_contamination(rows, [i for i in items if i[0] is not None])
    for settings in ({}, {"shard_words": 50}, {"block_chars": 300}):
        got = d.contamination(documents(spark, texts, n_hit="x", items=1), benchmark, **settings).collect()
        assert len(got) == len(rows)
        for g in got:
            n_words, n_hit, found = want[g.doc_id]
            assert (g.n_words, g.n_hit, g.n_items) == (n_words, n_hit, len(found))
            assert g.items_sha256 == hashlib.sha256(",".join(found).encode()).hexdigest()
            assert g.contaminated == (n_hit > 0 and 20 * n_hit >= n_words)
            raw = (texts[g.doc_id] or "").encode()
            assert sum(len(d.words_of(d.pa.array([raw[s.begin : s.end].decode()]))[0]) for s in g.spans) == n_hit


def test_empty_tables_and_repeated_rows(spark):
    docs = documents(spark, [(1, prose(1, 30)), (1, prose(1, 30)), (None, prose(1, 30))])
    none = spark.createDataFrame([], "item_id long, text string")
    assert [r.n_hit for r in d.contamination(docs, none).collect()] == [0, 0, 0]
    assert d.contamination(docs.limit(0), none).count() == 0
    all_ = spark.createDataFrame([(5, prose(1, 30))], "item_id long, text string")
    assert [(r.n_hit, r.contaminated) for r in d.contamination(docs, all_).collect()] == [(30, True)] * 3
    assert d.clean(docs, all_).count() == 0 and d.clean(docs, none).columns == docs.columns and d.clean(docs, none).count() == 3
