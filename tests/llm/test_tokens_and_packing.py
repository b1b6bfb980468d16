import os
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from helpers import documents
from tokenizers import Tokenizer

from visitflow.llm import packing, tokens

PATH = public_tokenizers.path("byte_bpe_50k.json")
PIECES = ["a", "'", "s", "ll", " ", "  ", "\n", "\n\n", "é", "12", "!!", "...", "<|endoftext|>", "the", "ing", "\t", "日", "🙂", " ", "\x1c", "\x85", "ⅷ", "²", "'re", "_", " of"]
TEXTS = [None, "", " ", "x", "it's  we'll\n\nthey've 's", "<|endoftext|> a<|endoftext|><|endof", "one two  three \n four", "é" * 300, "a" * 5000, "word " * 3000]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def ids(library, text):
    return library.encode(text, add_special_tokens=False).ids


def test_every_prefix_has_the_librarys_count(library):
    r = random.Random(3)
    own = tokens.counter(PATH)
    for text in TEXTS[1:7] + ["".join(r.choice(PIECES) for _ in range(r.randrange(1, 25))) for _ in range(150)]:
        steps = own.steps_of(text)
        assert [tokens.tokens_at(steps, k) for k in range(len(text) + 1)] == [len(ids(library, text[:k])) for k in range(len(text) + 1)], text


def test_longest_prefix_within_a_budget(library):
    text = "some words that are long enough to be cut somewhere, aren't they?"
    steps = tokens.counter(PATH).steps_of(text)
    for budget in range(0, 16):
        assert tokens.longest_within(steps, budget) == max(k for k in range(len(text) + 1) if len(ids(library, text[:k])) <= budget)


def test_counts(spark, library):
    docs = documents(spark, TEXTS + [(3, "x"), (None, "y z")], n_tokens=1, n_bytes="a", over_limit=True)
    got = sorted(tokens.prefix_token_counts(docs, PATH, keep_steps=False).collect(), key=str)
    want = [(i, len((t or "").encode()), len(ids(library, t or "")), len(ids(library, t or "")) > 512) for i, t in [*enumerate(TEXTS), (3, "x"), (None, "y z")]]
    assert [tuple(r) for r in got] == sorted(want, key=lambda w: str(tokens_row(w)))
    assert tokens.prefix_token_counts(docs.limit(0), PATH).count() == 0


def tokens_row(w):
    from pyspark.sql import Row

    return Row(doc_id=w[0], n_bytes=w[1], n_tokens=w[2], over_limit=w[3])


def check_packing(rows, texts, library, size=1024):
    """Every id is in exactly one place; only documents that are too long are cut."""
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    for i, t in texts.items():
        all_ids = ids(library, t or "") + [2]
        pieces = sorted(by_doc[i], key=lambda r: r.piece)
        assert [p.piece for p in pieces] == list(range(-(-len(all_ids) // size)))
        at = 0
        for p in pieces:
            assert p.start == at and (p.length == size or p.piece == 0)
            assert p.ids_crc32 == zlib.crc32(np.array(all_ids[at : at + p.length], "<u4").tobytes())
            at += p.length
        assert at == len(all_ids)
    for members in by_sequence.values():
        at = 0
        for r in sorted(members, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= size
    return len(by_sequence)


def test_packing(spark, library):
    r = random.Random(5)
    texts = TEXTS + ["tok " * r.randrange(0, 1500) for _ in range(300)]
    rows = packing.pack_documents(documents(spark, texts, sequence_id=1, offset="x", length=2), PATH).collect()
    n = check_packing(rows, dict(enumerate(texts)), library)
    assert n <= 1.02 * sum(x.length for x in rows) / 1024 + 1
    assert packing.pack_documents(documents(spark, texts).limit(0), PATH).count() == 0


def test_repeated_rows_are_packed_once_each(spark, library):
    rows = packing.pack_documents(documents(spark, [(1, "a b")] * 700 + [(None, None)]), PATH).collect()
    assert len(rows) == 701 and len({(r.sequence_id, r.offset) for r in rows}) == 701


@pytest.mark.parametrize("histogram", [{1: 5}, {1024: 3}, {512: 1, 513: 4}, {400: 1000, 300: 700, 324: 1000, 1: 10**9}, {7: 10**6, 1000: 3}])
def test_plan_deals_out_every_rank_once(histogram):
    size = 1024
    h = np.zeros(size + 1, np.int64)
    for length, n in histogram.items():
        h[length] = n
    slots = packing.plan(h, size)
    dealt = {}
    for length, first, n, _, offset in sorted(slots):
        assert first == dealt.get(length, 0) and n > 0 and offset + length <= size
        dealt[length] = first + n
    assert dealt == {k: v for k, v in histogram.items() if v}
    sequences = max(s + n for _, _, n, s, _ in slots)
    assert sequences <= 1.1 * (h * np.arange(size + 1)).sum() / size + sum(v for k, v in histogram.items() if 2 * k > size) + 1


def sequences_of(slots):
    return max(s + n for _, _, n, s, _ in slots)


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.01"), reason="needs the driver's tables")
def test_patterns_cost_no_sequence_on_the_given_tables(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    h = np.zeros(1025, np.int64)
    for row in packing.token_pieces(docs, PATH).groupBy("length").count().collect():
        h[row["length"]] = 200 * row["count"]
    alone = packing.Seats(h, 1024)
    alone.best_fit()
    n = sequences_of(packing.plan(h, 1024))
    least = -(-int((h * np.arange(1025)).sum()) // 1024)
    print(f"sequences: patterns {n}, best fit {alone.sequences}, at least {least}")
    assert n <= alone.sequences and n <= 1.01 * least


def test_plan_is_never_worse_than_best_fit():
    r = np.random.default_rng(4)
    for k in range(6):
        h = np.bincount(np.minimum(r.lognormal(5 + k / 3, 1, 3000).astype(int) + 1, 1024), minlength=1025).astype(np.int64)
        alone = packing.Seats(h, 1024)
        alone.best_fit()
        assert sequences_of(packing.plan(h, 1024)) <= alone.sequences
