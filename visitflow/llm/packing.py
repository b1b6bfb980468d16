"""Operator 3: sequence packing by length patterns fitted with non-negative least squares.

Only the histogram of piece lengths (one number for each length up to the sequence length) goes
to the driver.  All patterns of one, two or three lengths that fill a sequence exactly are
enumerated; repeat counts that explain the histogram are fitted by non-negative least squares,
rounded down to what the histogram holds, and what is left over is packed best-fit on the
histogram; of the fits with patterns of up to one, two and three lengths the best is taken.  The plan says, for every length, which ranks of its pieces go to which sequences and
offsets; ranks are dealt out in parallel, in buckets, so that a length that a third of the pieces
share is spread over many tasks.
"""

from __future__ import annotations

import json
import zlib
from array import array
from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, steps
from .tokens import KEPT_UNITS, PRETOKEN, Memory, WordBytes, byte_letters

PIECE_SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long"
#: Pieces that one bucket of a length's ranks holds on average.
BUCKET_ROWS = 200_000
MIN_BUCKETS = 16
FIT_ROUNDS = 300


class Encoder:
    """Ids of whole texts by the tokenizers library, whose model is asked once for each pretoken."""

    def __init__(self, path: str, kept: int = KEPT_UNITS):
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path).model
        self.letters = str.maketrans({chr(b): c for c, b in byte_letters().items()})
        self.space = self.letters[ord(" ")]
        added = json.load(open(path, encoding="utf-8")).get("added_tokens", [])
        self.special = {t["content"]: array("I", [t["id"]]).tobytes() for t in added}
        self.cut_special = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if added else None
        self.split = regex.compile(PRETOKEN).findall
        self.known = Memory(self.pretoken_ids, kept)
        self.ids_of = WordBytes(self.stretch_ids, self.pretoken_ids, list(self.special), kept)

    def pretoken_ids(self, pretoken: str) -> bytes:
        if pretoken.isascii() and pretoken.isprintable():
            written = pretoken.replace(" ", self.space)  # other printable ASCII is written as itself
        else:
            written = pretoken.encode("utf-8").decode("latin-1").translate(self.letters)
        return array("I", [t.id for t in self.model.tokenize(written)]).tobytes()

    def stretch_ids(self, text: str) -> bytes:
        if not any(s in text for s in self.special):
            return b"".join(map(self.known.__getitem__, self.split(text)))
        return b"".join(self.special[part] if part in self.special else b"".join(map(self.known.__getitem__, self.split(part)))
                        for part in self.cut_special.split(text))

    def __call__(self, text: str) -> bytes:
        """The text's ids as little-endian unsigned 32-bit numbers."""
        return self.ids_of(text)


_encoders: dict[tuple[str, int], Encoder] = {}


def encoder(path: str, kept: int) -> Encoder:
    if (path, kept) not in _encoders:
        _encoders[path, kept] = Encoder(path, kept)
    return _encoders[path, kept]


def token_pieces(docs: DataFrame, vocabulary: str, size: int = 1024, end_id: int = 2, kept: int = KEPT_UNITS) -> DataFrame:
    """Each document's ids and the end id, cut into pieces of ``size`` where there are more; the
    first piece of a cut document is the shorter one.  Null text is empty and gives the end id alone."""
    ending = array("I", [end_id]).tobytes()

    def cut_up(batches):
        encode = encoder(vocabulary, kept)
        for batch in steps(batches):
            rows: list[tuple] = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = encode(text or "") + ending
                n = len(ids) // 4
                start, stop = 0, (n - 1) % size + 1
                for piece in range(-(-n // size)):
                    rows.append((doc_id, piece, start, stop - start, zlib.crc32(ids[4 * start : 4 * stop])))
                    start, stop = stop, stop + size
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))],
                ["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(cut_up, PIECE_SCHEMA)


def full_patterns(size: int, present: np.ndarray) -> np.ndarray:
    """All patterns of up to three of the present lengths with the sum ``size``; 0 fills up."""
    lengths = np.flatnonzero(present)
    lengths = lengths[lengths > 0]
    a, b = np.meshgrid(lengths, np.concatenate([[0], lengths]), indexing="ij")
    a, b = a.ravel(), b.ravel()
    c = size - a - b
    fits = (a >= b) & (b >= c) & (c >= 0)
    a, b, c = a[fits], b[fits], c[fits]
    fits = (c == 0) | present[c]
    return np.stack([a[fits], b[fits], c[fits]], axis=1)


def fit(patterns: np.ndarray, histogram: np.ndarray, rounds: int = FIT_ROUNDS) -> np.ndarray:
    """Non-negative least squares by accelerated projected gradients on the sparse patterns."""
    scale = max(1.0, float(histogram.max()))
    target = histogram / scale
    size = len(histogram)

    def made(x):
        out = sum(np.bincount(patterns[:, k], x, size) for k in range(3))
        out[0] = 0
        return out

    def back(r):
        r = r.copy()
        r[0] = 0
        return r[patterns].sum(axis=1)

    v = np.ones(len(patterns))
    for _ in range(20):  # the largest eigenvalue bounds the step
        v = back(made(v))
        bound = float(np.linalg.norm(v))
        v /= bound
    x = y = np.zeros(len(patterns))
    t = 1.0
    for _ in range(rounds):
        after = np.maximum(0, y - back(made(y) - target) / (1.05 * bound))
        t_after = (1 + (1 + 4 * t * t) ** 0.5) / 2
        y = after + (t - 1) / t_after * (after - x)
        x, t = after, t_after
    return x * scale


class Seats:
    """Sequences that fill up: slots (length, first rank, ranks, first sequence, offset), the ranks of a length that
    go one by one to consecutive sequences at one offset."""

    def __init__(self, histogram: np.ndarray, size: int):
        self.size = size
        self.left = histogram.astype(np.int64).copy()
        self.used = np.zeros(size + 1, np.int64)  # ranks dealt out of each length
        self.slots: list[tuple[int, int, int, int, int]] = []
        self.sequences = 0

    def place(self, length: int, n: int, first: int, offset: int) -> None:
        self.slots.append((length, int(self.used[length]), n, first, offset))
        self.used[length] += n
        self.left[length] -= n

    def fill(self, patterns: np.ndarray, times: np.ndarray) -> None:
        """The patterns as often as their times, rounded, and what is left allow; those with the largest part first,
        which have the fewest ways to be filled."""
        wanted = np.flatnonzero(times >= 0.5)
        for k in wanted[np.lexsort((-times[wanted], -patterns[wanted, 0]))].tolist():
            parts = [int(v) for v in patterns[k] if v]
            n = min(int(round(times[k])), *(int(self.left[v]) // parts.count(v) for v in parts))
            if n <= 0:
                continue
            offset = 0
            for v in parts:
                self.place(v, n, self.sequences, offset)
                offset += v
            self.sequences += n

    def best_fit(self) -> None:
        """What is left, longest first, each into the fullest sequence that has room; many equal ones at a time."""
        room: dict[int, list[tuple[int, int]]] = {}  # by free space: (first sequence, how many)
        spaces: list[int] = []

        def open_up(space: int, first: int, n: int) -> None:
            if space and n:
                if space not in room:
                    room[space] = []
                    insort(spaces, space)
                room[space].append((first, n))

        for length in range(self.size, 0, -1):
            while self.left[length]:
                at = bisect_left(spaces, length)
                if at < len(spaces):
                    space = spaces[at]
                    first, n = room[space].pop()
                    take = min(n, int(self.left[length]))
                    if take < n:
                        room[space].append((first + take, n - take))
                    elif not room[space]:
                        del room[space]
                        spaces.pop(at)
                    self.place(length, take, first, self.size - space)
                    open_up(space - length, first, take)
                    continue
                each = self.size // length
                for n, several in ((int(self.left[length]) // each, each), (1, int(self.left[length]) % each)):
                    if n and several:
                        for k in range(several):
                            self.place(length, n, self.sequences, k * length)
                        open_up(self.size - several * length, self.sequences, n)
                        self.sequences += n


def plan(histogram: np.ndarray, size: int) -> list[tuple[int, int, int, int, int]]:
    """The slots of all pieces (see ``Seats``).

    Patterns of three lengths use up the short pieces that the long ones need, so the fit is made with patterns of
    up to one, two and three lengths, each is filled up by best fit, and the one of the fewest sequences is
    taken (of several, the one whose patterns place most pieces); best fit alone is among them."""
    whole = np.zeros(size + 1, np.int64)
    whole[size] = histogram[size]
    patterns = full_patterns(size, (histogram - whole) > 0) if (histogram - whole).sum() else np.zeros((0, 3), np.int64)
    best = None
    for parts in (3, 2, 1, 0):
        some = patterns[(patterns > 0).sum(axis=1) <= parts]
        if parts and not len(some):
            continue
        seats = Seats(histogram, size)
        if whole[size]:
            seats.place(size, int(whole[size]), 0, 0)
            seats.sequences = int(whole[size])
        if parts:
            seats.fill(some, fit(some, seats.left.astype(float)))
        placed = int(histogram.sum() - seats.left.sum())
        seats.best_fit()
        if best is None or (seats.sequences, -placed) < best[:2]:
            best = (seats.sequences, -placed, seats.slots)
    return best[2]


def pack(pieces: DataFrame, size: int = 1024) -> DataFrame:
    """sequence_id and offset for each piece.  The pieces are read three times and must not change
    between the reads: give a written table or a checkpoint."""
    counts = pieces.groupBy("length").count().collect()  # one row for each length, size at most
    histogram = np.zeros(size + 1, np.int64)
    for row in counts:
        histogram[row["length"]] = row["count"]
    slots = sorted(plan(histogram, size))
    table = np.array(slots, np.int64).reshape(-1, 5)
    begins = table[:, 0] << 48 | table[:, 1]
    shared = pieces.sparkSession.sparkContext.broadcast((begins, table))  # a few slots for each length and pattern

    buckets = max(MIN_BUCKETS, -(-int(histogram.sum()) // BUCKET_ROWS))
    dealt = pieces.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(buckets)))
    before = (
        dealt.groupBy("length", "bucket").agg(F.count(F.lit(1)).alias("n"))
        .withColumn("base", F.sum("n").over(Window.partitionBy("length").orderBy("bucket")) - F.col("n"))
        .select("length", "bucket", "base"))
    ranked = dealt.withColumn(
        "nth", F.row_number().over(Window.partitionBy("length", "bucket").orderBy("doc_id", "piece"))
    ).join(before, ["length", "bucket"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("base") + F.col("nth") - 1).alias("rank"))

    def seat(batches):
        begins, table = shared.value
        for batch in batches:
            length, rank = (batch.column(k).to_numpy(zero_copy_only=False) for k in (3, 5))
            slot = table[np.searchsorted(begins, length << 48 | rank, side="right") - 1]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], pa.array(slot[:, 3] + rank - slot[:, 1]), pa.array(slot[:, 4])],
                ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return ranked.mapInArrow(seat, PIECE_SCHEMA + ", sequence_id long, offset long")


def pack_documents(docs: DataFrame, vocabulary: str, size: int = 1024, end_id: int = 2, kept: int = KEPT_UNITS) -> DataFrame:
    """One row for each piece of each document: doc_id, piece, start, length, ids_crc32,
    sequence_id, offset (see token_pieces for the cutting).

    Null and empty texts are one piece of the end id; repeated rows are packed once each; a null
    doc_id is kept; an empty table gives no row; other columns are not read.  ``kept``: words whose ids
    a Python worker remembers, about 250 bytes each."""
    return pack(cut(token_pieces(docs, vocabulary, size, end_id, kept)), size)
