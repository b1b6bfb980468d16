"""Helpers shared by the text operators: reliable checkpoints, Arrow text buffers, word hashes."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from ..config import checkpoint_root

ARCHIVE = "visitflow_package.zip"
#: Bytes of text that one vectorised step works on; a longer document is one step of its own.
STEP_BYTES = 1 << 20


def ship(spark: SparkSession) -> None:
    """Send this package to the executors of a session whose Python workers lack it (once)."""
    sc = spark.sparkContext
    if any(os.path.basename(f) == ARCHIVE for f in sc.listFiles):
        return
    package = Path(__file__).resolve().parent.parent
    path = os.path.join(tempfile.mkdtemp(prefix="visitflow-package-"), ARCHIVE)
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as archive:
        for source in sorted(package.rglob("*.py")):
            archive.write(source, source.relative_to(package.parent))
    sc.addPyFile(path)


def cut(df: DataFrame) -> DataFrame:
    """``df`` written to the shared checkpoint folder and read back: later stages neither
    recompute it nor depend on an executor that may be lost."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame) -> DataFrame:
    """``df`` as a Parquet table in the shared checkpoint folder, read back: as ``cut``, but packed, and
    later stages read the columns that they need."""
    path = f"{checkpoint_root(df.sparkSession)}/table-{uuid.uuid4()}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def steps(batches, text_index: int = 1, most: int = STEP_BYTES):
    """Record batches cut to at most ``most`` bytes of text (one row at least); null text is empty."""
    for batch in batches:
        text = batch.column(text_index)
        sizes = pc.fill_null(pc.binary_length(text), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes)
        at = 0
        while at < batch.num_rows:
            base = ends[at - 1] if at else 0
            stop = max(at + 1, int(np.searchsorted(ends, base + most, side="right")))
            yield batch.slice(at, stop - at)
            at = stop


def flat(text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All texts in one byte array, a line feed behind each, and the places where each begins
    (one more at the end).  Null is empty."""
    text = pc.fill_null(text.cast(pa.large_string()), "")
    joined = pc.binary_join_element_wise(text, pa.scalar("\n", pa.large_string()), pa.scalar("", pa.large_string()))
    offsets = np.frombuffer(joined.buffers()[1], np.int64, len(joined) + 1, joined.offset * 8)
    data = joined.buffers()[2]
    if data is None:
        return np.zeros(0, np.uint8), offsets - offsets[0]
    return np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]], offsets - offsets[0]


def lower_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    return table


#: Word characters of the benchmark contract: digits, a-z after lowering, everything beyond ASCII.
ALNUM = np.array([b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A for b in range(256)])
#: Words between ASCII white space.
NOT_SPACE = np.array([not (b == 0x20 or 0x09 <= b <= 0x0D) for b in range(256)])
LOWER = lower_table()

_MASK = (1 << 64) - 1
_BASE = 0x9E3779B97F4A7C15 | 1
_BYTE_VALUES = np.random.default_rng(20240607).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power_tables(n: int) -> list[np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, kept for the next step."""
    if len(_powers[0]) < n:
        for k, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            table = np.full(max(n, STEP_BYTES + 4096), base & _MASK, np.uint64)
            table[0] = 1
            _powers[k] = np.multiply.accumulate(table)
    return _powers


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor-shift and multiply rounds)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_spans(data: np.ndarray, offsets: np.ndarray, member: np.ndarray):
    """Starts and ends of the words in lowered ``data`` and, per document, its range of words."""
    inside = member.take(data)
    edge = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    if len(inside) and inside[0]:
        edge = np.concatenate([[0], edge])
    if len(inside) and inside[-1]:
        edge = np.append(edge, len(inside))
    starts, ends = edge[0::2], edge[1::2]
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word, the same wherever the word stands."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    power, inverse = _power_tables(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE_VALUES[data] * power[: len(data)], out=total[1:])
    return mix((total[ends] - total[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))


def shingles(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hashes of all runs of ``width`` words; fewer words form one run, none form none."""
    n = len(hashes)
    if not n:
        return hashes
    width = min(width, n)
    out = np.full(n - width + 1, width, np.uint64)
    for k in range(width):
        out = mix(out * np.uint64(0xD6E8FEB86659FD93) + hashes[k : n - width + 1 + k])
    return out
