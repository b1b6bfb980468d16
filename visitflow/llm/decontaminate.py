"""Operator 4: benchmark decontamination with one FM-index per shard of training text.

Words are numbered by the benchmark's vocabulary.  What no test phrase can touch (a word outside
the vocabulary, a pair of words that no item has) splits a document's words into runs, and runs
shorter than the shortest phrase are left out; this loses no occurrence.  A shard's runs, one
separator behind each, are sorted by suffix; the Burrows-Wheeler text is kept as a wavelet matrix
with sampled bit ranks, and the suffix positions are kept for every 16th place and every run's
start.  All phrases are searched backward at once; their rows step through the text until a
sampled position; overlapping occurrences merge into spans.

Nothing is shuffled: a shard is consecutive documents of one task.  The benchmark goes to the
executors in blocks of bounded size, one held at a time.
"""

from __future__ import annotations

import hashlib
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ALNUM, LOWER, flat, steps, word_hashes, word_spans

WINDOW = 13
SHARD_WORDS = 500_000
SAMPLE_EVERY = 16
#: Characters of benchmark text in one block.
BLOCK_CHARS = 8_000_000
END, BREAK, FIRST = 0, 1, 2

SCHEMA = ("doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean, "
          "items array<string>, spans array<struct<begin:long,end:long>>")
_ARROW = pa.schema([
    ("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_hit", pa.int64()), ("n_items", pa.int64()),
    ("items_sha256", pa.string()), ("contaminated", pa.bool_()), ("items", pa.list_(pa.string())),
    ("spans", pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())])))])


class Phrases(NamedTuple):
    """The distinct windows of a block of benchmark items, longest width first in columns."""

    vocabulary: np.ndarray  # sorted word hashes
    pairs: np.ndarray  # sorted codes of neighbouring words
    windows: np.ndarray  # symbols, filled up on the right with END
    widths: np.ndarray
    item_starts: np.ndarray  # items of window w: items[item_starts[w]:item_starts[w + 1]]
    items: np.ndarray  # numbers into names
    names: list[str]


def words_of(text: pa.Array):
    data, offsets = flat(text)
    data = LOWER[data]
    starts, ends, ranges = word_spans(data, offsets, ALNUM)
    return word_hashes(data, starts, ends), starts, ends, ranges, offsets


def phrases(names: list[str], texts: list[str], width: int = WINDOW) -> Phrases | None:
    """The windows of the items; None if no item has a word."""
    hashes, _, _, ranges, _ = words_of(pa.array(texts, pa.string()))
    if not len(hashes):
        return None
    vocabulary, symbols = np.unique(hashes, return_inverse=True)
    symbols = symbols.astype(np.int64) + FIRST
    pairs, found, owners = [], [], []
    for k in range(len(names)):
        own = symbols[ranges[k]:ranges[k + 1]]
        if not len(own):
            continue
        pairs.append(own[:-1] * (len(vocabulary) + FIRST) + own[1:])
        w = min(width, len(own))
        rows = np.zeros((len(own) - w + 1, width), np.int64)
        rows[:, :w] = np.lib.stride_tricks.sliding_window_view(own, w)
        found.append(rows)
        owners.append(np.full(len(rows), k))
    windows, which = np.unique(np.concatenate(found), axis=0, return_inverse=True)
    both = np.unique(np.stack([which.ravel(), np.concatenate(owners)], axis=1), axis=0)
    return Phrases(vocabulary, np.unique(np.concatenate(pairs)), windows, (windows > 0).sum(axis=1),
                   np.searchsorted(both[:, 0], np.arange(len(windows) + 1)), both[:, 1], names)


def suffix_order(text: np.ndarray) -> np.ndarray:
    """Suffix array by prefix doubling; every separator counts as a symbol of its own, so the
    rounds are bounded by the longest run."""
    n = len(text)
    key = text * np.int64(n + 1) + np.where(text < FIRST, np.arange(n), 0)
    order = np.argsort(key, kind="stable")
    rank = np.empty(n, np.int64)
    rank[order] = np.cumsum(np.diff(key[order], prepend=key[order[0]]) != 0)
    k = 1
    while rank[order[-1]] < n - 1:
        behind = np.zeros(n, np.int64)
        behind[: n - k] = rank[k:] + 1
        key = rank * np.int64(n + 1) + behind
        order = np.argsort(key, kind="stable")
        rank[order] = np.cumsum(np.diff(key[order], prepend=key[order[0]]) != 0)
        k *= 2
    return order


class Bits:
    """A bit vector with ranks: a running count for every 64 bits."""

    def __init__(self, bits: np.ndarray):
        padded = np.zeros(-(-(len(bits) + 1) // 64) * 64, np.uint8)
        padded[: len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view(np.uint64)
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)])

    def rank(self, at: np.ndarray) -> np.ndarray:
        mask = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[at >> 6] + np.bitwise_count(self.words[at >> 6] & mask)

    def get(self, at: np.ndarray) -> np.ndarray:
        return (self.words[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) != 0


class FmIndex:
    def __init__(self, text: np.ndarray, alphabet: int):
        """``text``: symbols, each run closed by BREAK, END last."""
        order = suffix_order(text)
        last = text[order - 1]  # the symbol before each suffix; END stands before the first
        self.n = len(text)
        self.depth = max(1, int(alphabet - 1).bit_length())
        self.levels: list[tuple[Bits, int]] = []
        row = last
        for level in reversed(range(self.depth)):
            bits = (row >> level) & 1
            self.levels.append((Bits(bits), int(self.n - bits.sum())))
            row = np.concatenate([row[bits == 0], row[bits == 1]])
        self.smaller = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=alphabet))])
        self.zero = self.descend(np.arange(alphabet), np.zeros(alphabet, np.int64))
        kept = (order % SAMPLE_EVERY == 0) | (last < FIRST)
        self.kept, self.positions = Bits(kept), order[kept]

    def descend(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        for level, (bits, zeros) in zip(reversed(range(self.depth)), self.levels):
            ones = bits.rank(at)
            at = np.where((symbol >> level) & 1, zeros + ones, at - ones)
        return at

    def step(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        return self.smaller[symbol] + self.descend(symbol, at) - self.zero[symbol]

    def search(self, windows: np.ndarray, widths: np.ndarray):
        """The windows that occur and their rows [low, high), all searched backward at once."""
        which = np.arange(len(windows))
        low, high = np.zeros(len(windows), np.int64), np.full(len(windows), self.n, np.int64)
        for column in reversed(range(windows.shape[1])):
            live = widths[which] > column
            symbol = windows[which[live], column]
            low[live], high[live] = self.step(symbol, low[live]), self.step(symbol, high[live])
            found = low < high
            which, low, high = which[found], low[found], high[found]
        return which, low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """The text positions of suffix rows: steps back until a row whose position is kept."""
        out = np.empty(len(rows), np.int64)
        left, at, walked = np.arange(len(rows)), rows.copy(), 0
        while len(left):
            known = self.kept.get(at)
            out[left[known]] = self.positions[self.kept.rank(at[known])] + walked
            left, at = left[~known], at[~known]
            symbol, place = np.zeros(len(at), np.int64), at
            for bits, zeros in self.levels:
                one, ones = bits.get(place), bits.rank(place)
                symbol = symbol * 2 + one
                place = np.where(one, zeros + ones, place - ones)
            at = self.smaller[symbol] + place - self.zero[symbol]
            walked += 1
        return out


def occurrences(hashes: np.ndarray, ranges: np.ndarray, ph: Phrases) -> tuple[np.ndarray, np.ndarray]:
    """(window, first word) of every occurrence of a window inside one document."""
    none = np.zeros(0, np.int64)
    if not len(hashes):
        return none, none
    place = np.minimum(np.searchsorted(ph.vocabulary, hashes), len(ph.vocabulary) - 1)
    symbol = np.where(ph.vocabulary[place] == hashes, place + FIRST, BREAK)
    joined = np.zeros(len(symbol), bool)  # with the word behind it
    if len(ph.pairs):
        pair = symbol[:-1] * (len(ph.vocabulary) + FIRST) + symbol[1:]
        at = np.minimum(np.searchsorted(ph.pairs, pair), len(ph.pairs) - 1)
        joined[:-1] = ph.pairs[at] == pair
    ends = ranges[1:][ranges[1:] > ranges[:-1]]
    joined[ends - 1] = False
    starts = np.flatnonzero(np.concatenate([[True], ~joined[:-1]]))
    lengths = np.diff(np.append(starts, len(symbol)))
    good = (lengths >= ph.widths.min()) & (symbol[starts] != BREAK)
    starts, lengths = starts[good], lengths[good]
    if not len(starts):
        return none, none
    # the runs one behind the other, a separator after each
    begin = np.concatenate([[0], np.cumsum(lengths + 1)])
    run = np.repeat(np.arange(len(starts)), lengths + 1)
    word = starts[run] + np.arange(begin[-1]) - begin[run]
    text = symbol[np.minimum(word, len(symbol) - 1)]
    text[begin[1:] - 1] = BREAK
    index = FmIndex(np.append(text, END), len(ph.vocabulary) + FIRST)
    which, low, high = index.search(ph.windows, ph.widths)
    times = high - low
    rows = np.repeat(low - np.cumsum(times) + times, times) + np.arange(times.sum())
    return np.repeat(which, times), word[index.locate(rows)]


def judge_shard(ids: list, hashes, starts, ends, ranges, doc_begins, blocks) -> pa.RecordBatch:
    """The result rows of one shard's documents; ``blocks`` gives one Phrases at a time."""
    change = np.zeros(len(hashes) + 1, np.int64)
    pairs: list[set] = [set() for _ in ids]
    for ph in blocks():
        window, first = occurrences(hashes, ranges, ph)
        if not len(window):
            continue
        np.add.at(change, first, 1)
        np.add.at(change, first + ph.widths[window], -1)
        doc = np.searchsorted(ranges, first, side="right") - 1
        for d, w in np.unique(np.stack([doc, window], axis=1), axis=0).tolist():
            pairs[d].update(ph.names[i] for i in ph.items[ph.item_starts[w]:ph.item_starts[w + 1]])
    hit = np.cumsum(change[:-1]) > 0
    counted = np.concatenate([[0], np.cumsum(hit)])
    edge = np.diff(hit.view(np.int8), prepend=0, append=0)
    begins, stops = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    columns: list[list] = [[] for _ in _ARROW]
    for d, doc_id in enumerate(ids):
        a, b = int(ranges[d]), int(ranges[d + 1])
        n_hit, items = int(counted[b] - counted[a]), sorted(pairs[d])
        spans = []
        if n_hit:
            for k in range(np.searchsorted(stops, a, side="right"), np.searchsorted(begins, b)):
                p, q = max(a, int(begins[k])), min(b, int(stops[k]))
                spans.append({"begin": int(starts[p] - doc_begins[d]), "end": int(ends[q - 1] - doc_begins[d])})
        for column, value in zip(columns, (
                doc_id, b - a, n_hit, len(items), hashlib.sha256(",".join(items).encode()).hexdigest(),
                n_hit > 0 and 20 * n_hit >= b - a, items, spans)):
            column.append(value)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _ARROW)], schema=_ARROW)


def benchmark_blocks(benchmark: DataFrame, width: int, chars: int) -> list:
    """Broadcast variables of at most about ``chars`` characters of items each (one item at least)."""
    sc = benchmark.sparkSession.sparkContext
    out, names, texts, size = [], [], [], 0

    def close():
        if names and (ph := phrases(names, texts, width)) is not None:
            out.append(sc.broadcast(ph))

    rows = benchmark.where("item_id is not null and text is not null").select(F.col("item_id").cast("string"), F.col("text").cast("string"))
    for item, text in rows.toLocalIterator():
        names.append(item)
        texts.append(text)
        size += len(text)
        if size >= chars:
            close()
            names, texts, size = [], [], 0
    close()
    return out


def contamination(docs: DataFrame, benchmark: DataFrame, width: int = WINDOW, shard_words: int = SHARD_WORDS,
                  block_chars: int = BLOCK_CHARS) -> DataFrame:
    """Per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated, the items and the
    merged spans to remove, in bytes of the text.

    Null and empty texts have no words and are clean; items without id or words are ignored;
    repeated items and rows count once each; empty tables give no rows (of documents) or only
    clean rows (of the benchmark); other columns are not read.  Items shorter than ``width``
    words are one window."""
    judge = judged_shards(benchmark_blocks(benchmark, width, block_chars), shard_words, 0, 1)
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return plain.mapInArrow(lambda batches: (found for _, found in judge(batches)), SCHEMA)


def clean(docs: DataFrame, benchmark: DataFrame, width: int = WINDOW, shard_words: int = SHARD_WORDS,
          block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, with all their columns."""
    judge = judged_shards(benchmark_blocks(benchmark, width, block_chars), shard_words, docs.columns.index("doc_id"), docs.columns.index("text"))

    def keep(batches):
        for held, found in judge(batches):
            kept = pa.Table.from_batches(held).filter(pc.invert(found.column("contaminated")))
            yield from kept.to_batches()

    return docs.mapInArrow(keep, docs.schema)


def judged_shards(shared: list, shard_words: int, id_index: int, text_index: int):
    """A function from record batches to (the batches of a shard, the result row of each of their rows)."""

    def blocks():
        for one in shared:
            yield one.value
            if len(shared) > 1:  # hold one block at a time
                one.__dict__.pop("_value", None)

    def close(held):
        ids, parts, shift, word_shift = [], [], 0, 0
        for batch, (h, s, e, r, o) in held:
            ids += batch.column(id_index).to_pylist()
            parts.append((h, s + shift, e + shift, r[:-1] + word_shift, o[:-1] + shift))
            shift, word_shift = shift + int(o[-1]), word_shift + len(h)
        h, s, e, r, o = (np.concatenate(p) for p in zip(*parts))
        return [batch for batch, _ in held], judge_shard(ids, h, s, e, np.append(r, len(h)), o, blocks)

    def judge(batches):
        held, words = [], 0
        for batch in steps(batches, text_index):
            found = words_of(batch.column(text_index))
            held.append((batch, found))
            words += len(found[0])
            if words >= shard_words:
                yield close(held)
                held, words = [], 0
        if held:
            yield close(held)

    return judge
