"""Operator 2: token counts of every prefix of a text.

A byte-level BPE tokenizer splits a text into pretokens and merges bytes inside each of them.
Whether a token may follow another depends on these two alone, so the last token of every prefix
of a pretoken is unique and a left-to-right dynamic program finds it: the last token ends at the
prefix's end and is allowed behind the last token of what is left.  The counts of all prefixes
are kept as one signed byte per character (the step from the prefix before), so later questions,
the tokens of any prefix or the longest prefix within a budget, are a cumulative sum.

Only the split at white space looks ahead; a white-space run is therefore joined with the
pretoken behind it into one unit, and counts inside a unit are those of the unit's prefix.
"""

from __future__ import annotations

import json
from itertools import accumulate

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import steps

#: Fixed value: how the tokenizer splits a text before merging.
PRETOKEN = r"'(?:[stmd]|re|ve|ll)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_KINDS = r"\p{L}+|\p{N}+|[^\s\p{L}\p{N}]+"
_CONTRACTED = r"'(?:[stmd]|re|ve|ll)"
#: A pretoken, or a white-space run with the pretoken behind it.
UNIT = rf"{_CONTRACTED}| ?\p{{L}}+| ?\p{{N}}+| ?[^\s\p{{L}}\p{{N}}]+|\s+ (?:{_KINDS})|\s+(?:{_CONTRACTED}|{_KINDS})|\s+"
#: Units and words of up to so many characters are remembered, so many of them at a time.
KEPT_CHARS, KEPT_UNITS = 40, 900_000


def byte_letters() -> dict[str, int]:
    """The vocabulary file writes a byte as a printable letter: itself, or the next one free from 256."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class Memory(dict):
    """Results of ``make`` by key; short keys are kept, all are forgotten when there are too many."""

    def __init__(self, make, kept: int = KEPT_UNITS):
        super().__init__()
        self.make, self.kept = make, kept

    def __missing__(self, key):
        value = self.make(key)
        if len(key) <= KEPT_CHARS:
            if len(self) >= self.kept:
                self.clear()
            self[key] = value
        return value


class WordBytes:
    """What ``make`` gives for a whole text, put together from what it gives for its words.

    Between words that are divided by one space each nothing looks across: a space belongs to the
    word behind it.  A text with other white space beside a space is made as a whole."""

    def __init__(self, make, make_pretoken, special: list[str], kept: int = KEPT_UNITS):
        self.make, self.make_pretoken, self.special = make, make_pretoken, special
        self.words = Memory(self.word, kept)

    def word(self, word: str) -> bytes:
        if word.isalpha():
            return self.make_pretoken(" " + word)
        if not word or word[0].isspace() or word[-1].isspace():
            raise ValueError("white space meets a space")
        return self.make(" " + word)

    def __call__(self, text: str) -> bytes:
        words = text.split(" ")
        if any(s in text for s in self.special) or len(words) < 3 or words[0] == "" or words[0][-1].isspace() or words[-1] == "" or words[-1][0].isspace():
            return self.make(text)
        try:
            inner = b"".join(map(self.words.__getitem__, words[1:-1]))
        except ValueError:
            return self.make(text)
        return self.make(words[0]) + inner + self.make(" " + words[-1])


class PrefixCounter:
    """Prefix token counts under one vocabulary file (byte-level BPE, .json)."""

    def __init__(self, path: str):
        spec = json.load(open(path, encoding="utf-8"))
        letters = byte_letters()
        ids = spec["model"]["vocab"]
        as_bytes = {t: bytes(letters[c] for c in t) for t in ids if all(c in letters for c in t)}
        #: every token, and every beginning of one that is none itself (-1)
        self.pieces = {t[:k]: -1 for t in as_bytes.values() for k in range(1, len(t))}
        self.pieces.update((as_bytes[t], i) for t, i in ids.items() if t in as_bytes)
        self.merge: dict[tuple[int, int], int] = {}
        self.born: dict[int, int] = {}
        self.parts: dict[int, tuple[int, int]] = {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            left, right, whole = ids[a], ids[b], ids[a + b]
            self.merge[left, right] = rank
            if whole not in self.parts:
                self.parts[whole], self.born[whole] = (left, right), rank
        self.special = [t["content"] for t in spec.get("added_tokens", [])]
        self.cut_special = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        self.units = regex.compile(UNIT).findall
        self.blank = regex.compile(r"\s*").match
        self.pretokens = regex.compile(PRETOKEN).findall
        self.allowed: dict[int, bool] = {}
        self.stands: dict[int, bool] = {}
        self.table = Memory(lambda unit: self.packed(self.unit_counts(unit)))
        self.steps_of = WordBytes(self.stretch_steps, lambda p: self.packed(self.char_counts(p)), self.special)

    def kept_apart(self, a: int, b: int, until: float) -> bool:
        """No merge joins the end of token ``a`` with the start of ``b`` before time ``until``.

        The right edge of ``a`` and the left edge of ``b`` are followed back in time, the younger
        one first; a piece lives from its own merge to the merge that takes it in.  Equal pairs
        merge from the left, so a tie spares the piece on the left and takes the one on the right."""
        a_until = b_until = until
        while True:
            rank = self.merge.get((a, b))
            if rank is not None and rank < a_until and (rank <= b_until if b_until != until else rank < until):
                return False
            a_born, b_born = self.born.get(a, -1), self.born.get(b, -1)
            if a_born < 0 and b_born < 0:
                return True
            if a_born > b_born:
                a, a_until = self.parts[a][1], min(a_born, a_until)
            else:
                b, b_until = self.parts[b][0], min(b_born, b_until)

    def whole(self, t: int) -> bool:
        """The token's bytes are encoded as this token alone."""
        known = self.stands.get(t)
        if known is None:
            known = t not in self.parts or (
                all(map(self.whole, self.parts[t])) and self.kept_apart(*self.parts[t], self.born[t]))
            self.stands[t] = known
        return known

    def judge(self, key: int) -> bool:
        """Whether token key % 2**20 may stand behind token (key >> 20) - 1, or first in a pretoken."""
        before, t = (key >> 20) - 1, key & 0xFFFFF
        return self.whole(t) and (before < 0 or self.kept_apart(before, t, float("inf")))

    def byte_counts(self, raw: bytes) -> list[int]:
        """Tokens of raw[:i] for every i, raw being one pretoken: the dynamic program."""
        n = len(raw)
        last, count = [-1] * (n + 1), [0] * (n + 1)
        pieces, allowed = self.pieces, self.allowed
        if len(allowed) > 400_000:
            allowed.clear()
        for start in range(n):
            before = last[start] + 1 << 20
            counted = count[start] + 1
            for end in range(start + 1, n + 1):
                known = pieces.get(raw[start:end])
                if known is None:
                    break
                if known >= 0 and last[end] < 0:
                    fits = allowed.get(before + known)
                    if fits is None:
                        fits = allowed[before + known] = self.judge(before + known)
                    if fits:
                        last[end], count[end] = known, counted
        return count

    def char_counts(self, pretoken: str) -> list[int]:
        count = self.byte_counts(pretoken.encode("utf-8"))
        if pretoken.isascii():
            return count
        return [0, *(count[at] for at in accumulate(len(c.encode("utf-8")) for c in pretoken))]

    def plain_counts(self, unit: str) -> list[int]:
        """Tokens of unit[:i] for every i where the unit's prefixes split as the unit does."""
        out = [0]
        for p in self.pretokens(unit):
            base = out[-1]
            out += [base + k for k in self.char_counts(p)[1:]]
        return out

    def unit_counts(self, unit: str) -> list[int]:
        """Tokens of unit[:i] for every i.  Inside a contraction and inside a white-space run with
        its follower the prefix may split otherwise than the unit, so there it is split anew."""
        if unit[0] == " " and len(unit) > 1 and not unit[1].isspace():
            return self.char_counts(unit)
        blank = self.blank(unit).end()
        if not blank and unit[0] != "'":
            return self.char_counts(unit)
        if blank <= 1 and unit[blank : blank + 1] != "'":
            return self.plain_counts(unit)
        run = self.char_counts(unit[:blank]) if blank else [0]
        rest = self.plain_counts(unit)
        out = run + rest[blank + 1 :]
        for k in range(blank + 1, min(len(unit), blank + 3)):
            out[k] = self.plain_counts(unit[:k])[-1]
        return out

    @staticmethod
    def packed(counts: list[int]) -> bytes:
        """The steps between counts as signed bytes.  A step beyond 127 would need a vocabulary
        under which one more character changes a pretoken by that many tokens."""
        step = [b - a for a, b in zip(counts, counts[1:])]
        if step and (max(step) > 127 or min(step) < -128):
            raise OverflowError("one more character changes the count by over 127 tokens")
        return bytes([d & 255 for d in step])

    def stretch_steps(self, text: str) -> bytes:
        """One signed byte for each character: the tokens that the prefix ending there has more
        than the prefix before.  Special strings are one token when they are complete.
        ``steps_of`` gives the same by way of remembered words."""
        if self.cut_special is None or not any(s in text for s in self.special):
            return b"".join(map(self.table.__getitem__, self.units(text)))
        out, pieces = [], self.cut_special.split(text)
        for k in range(0, len(pieces), 2):
            if k + 1 == len(pieces):
                out.append(b"".join(map(self.table.__getitem__, self.units(pieces[k]))))
                break
            # up to the last character of the special string it is text like any other
            open_part = np.frombuffer(b"".join(map(self.table.__getitem__, self.units(pieces[k] + pieces[k + 1][:-1]))), np.int8)
            before = sum(np.frombuffer(self.table[u], np.int8).sum(dtype=np.int64) for u in self.units(pieces[k]))
            out += [open_part.tobytes(), self.packed([0, int(before) + 1 - int(open_part.sum(dtype=np.int64))])]
        return b"".join(out)


def tokens_at(prefix_steps: bytes, n_chars: int) -> int:
    """Tokens of the first ``n_chars`` characters."""
    return int(np.frombuffer(prefix_steps, np.int8)[: max(0, n_chars)].sum(dtype=np.int64))


def longest_within(prefix_steps: bytes, budget: int) -> int:
    """The most characters that a prefix of at most ``budget`` tokens has."""
    fits = np.flatnonzero(np.cumsum(np.frombuffer(prefix_steps, np.int8), dtype=np.int64) <= budget)
    return int(fits[-1]) + 1 if len(fits) else 0


_counters: dict[str, PrefixCounter] = {}


def counter(path: str) -> PrefixCounter:
    """The counter of a vocabulary file, loaded once in a Python worker."""
    if path not in _counters:
        _counters[path] = PrefixCounter(path)
    return _counters[path]


def prefix_token_counts(docs: DataFrame, vocabulary: str, limit: int = 512, keep_steps: bool = True) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit and, with ``keep_steps``, prefix_steps: the token
    count of every prefix as one signed byte per character (see tokens_at, longest_within).

    Null text counts as empty (0 bytes, 0 tokens); a null doc_id is kept; repeated rows give
    repeated results; an empty table gives none; other columns are not read."""

    def count(batches):
        own = counter(vocabulary)
        for batch in steps(batches):
            ids, sizes, totals, kept = batch.column(0), [], [], []
            for text in batch.column(1).to_pylist():
                found = own.steps_of(text or "")
                sizes.append(len((text or "").encode("utf-8")))
                totals.append(int(np.frombuffer(found, np.int8).sum(dtype=np.int64)))
                kept.append(found)
            columns = [ids, pa.array(sizes, pa.int64()), pa.array(totals, pa.int64()), pa.array([t > limit for t in totals])]
            yield pa.RecordBatch.from_arrays(
                columns + ([pa.array(kept, pa.binary())] if keep_steps else []),
                ["doc_id", "n_bytes", "n_tokens", "over_limit"] + (["prefix_steps"] if keep_steps else []))

    schema = "doc_id long, n_bytes long, n_tokens long, over_limit boolean" + (", prefix_steps binary" if keep_steps else "")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(count, schema)
