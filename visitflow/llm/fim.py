"""Fill-in-the-middle by displacement scatter.

A text is cut at two code points into prefix, middle and suffix and put together anew around three
marks.  For all texts of a batch at once: the starts of the three parts carry, in a difference array,
by how much the way of their bytes to the output differs from that of the part before; its cumulative
sum is the shift of every byte, and one scatter writes the output.  Restoring finds the marks, forms the
difference array over the bytes of the text, and gathers.  Shifts are formed for STEP_BYTES at a time,
so a very long text needs little more than itself twice.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import STEP_BYTES, steps

#: Of 100 texts so many are rearranged, and of 100 rearranged ones so many put the suffix first.
REARRANGED, SUFFIX_FIRST = 90, 20

PLAIN, PSM, SPM = 0, 1, 2
FORMS = np.array(["plain", "psm", "spm"])
_P, _S, _M = ord("P"), ord("S"), ord("M")


def buffers(text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts one behind the other, and where each begins (one more at the end).  Null is empty."""
    text = pc.fill_null(text.cast(pa.large_string()), "")
    offsets = np.frombuffer(text.buffers()[1], np.int64, len(text) + 1, text.offset * 8) if len(text) else np.zeros(1, np.int64)
    data = text.buffers()[2] if len(text) else None
    if data is None:
        return np.zeros(0, np.uint8), offsets - offsets[0]
    return np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]], offsets - offsets[0]


def strings(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    buffers_ = [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data)]
    return pa.LargeStringArray.from_buffers(len(offsets) - 1, buffers_[1], buffers_[2]).cast(pa.string())


def _windows(n: int):
    return range(0, n + 1, STEP_BYTES)


def _points(data: np.ndarray, at: int) -> np.ndarray:
    return np.flatnonzero((data[at : at + STEP_BYTES] & 0xC0) != 0x80)


def ranks(data: np.ndarray, places: np.ndarray) -> np.ndarray:
    """How many code points begin before each of the ascending byte places."""
    out, total = np.zeros(len(places), np.int64), 0
    for at in _windows(len(data)):
        points = _points(data, at)
        lo, hi = np.searchsorted(places, [at, at + STEP_BYTES])
        out[lo:hi] = total + np.searchsorted(points, places[lo:hi] - at)
        total += len(points)
    return out


def select(data: np.ndarray, numbers: np.ndarray) -> np.ndarray:
    """The byte places where the code points of the ascending ``numbers`` begin; the end for one more than there are."""
    out, total = np.full(len(numbers), len(data), np.int64), 0
    for at in _windows(len(data)):
        points = _points(data, at)
        lo, hi = np.searchsorted(numbers, [total, total + len(points)])
        out[lo:hi] = at + points[numbers[lo:hi] - total]
        total += len(points)
    return out


def marks(data: np.ndarray, offsets: np.ndarray, wanted: np.ndarray):
    """Byte place, text number and letter of every mark that lies whole in a wanted text, window by window."""
    for at in _windows(len(data)):
        d = data[at : at + STEP_BYTES + 2]
        middle = d[1:-1]
        hit = at + np.flatnonzero((d[:-2] == ord("<")) & (d[2:] == ord(">")) & ((middle == _P) | (middle == _S) | (middle == _M)))
        doc = np.searchsorted(offsets, hit, side="right") - 1
        whole = (hit + 3 <= offsets[doc + 1]) & wanted[doc] if len(hit) else np.zeros(0, bool)
        yield hit[whole], doc[whole], data[hit[whole] + 1]


def shifts(starts: np.ndarray, values: np.ndarray, n: int):
    """Windows (from, to, shift of each byte): ``values[k]`` holds from the ascending ``starts[k]`` on, as the
    cumulative sum of a difference array."""
    change = np.diff(values, prepend=0)
    carry = 0
    for at in range(0, n, STEP_BYTES):
        stop = min(n, at + STEP_BYTES)
        lo, hi = np.searchsorted(starts, [at, stop])
        difference = np.zeros(stop - at, np.int64)
        np.add.at(difference, starts[lo:hi] - at, change[lo:hi])
        difference[0] += carry
        shift = np.cumsum(difference)
        carry = int(shift[-1])
        yield at, stop, shift


def _layout(form, begin, prefix, middle, suffix):
    """Where prefix, middle and suffix and the marks in front of them begin in an output that begins at ``begin``."""
    swapped = form == SPM
    p = np.where(swapped, begin + 3 + suffix, begin)
    s = np.where(swapped, begin, begin + 3 + prefix)
    m = begin + 6 + prefix + suffix
    return p, m, s


def rearrange(data, offsets, first, second, form):
    """Bytes and offsets of the outputs: texts cut at the byte places ``first`` and ``second``."""
    begin, end = offsets[:-1], offsets[1:]
    out_offsets = np.concatenate([[0], np.cumsum(end - begin + np.where(form == PLAIN, 0, 9))])
    p, m, s = _layout(form, out_offsets[:-1], first - begin, second - first, end - second)
    plain = form == PLAIN
    way = np.stack([np.where(plain, out_offsets[:-1] - begin, x + 3 - y)
                    for x, y in ((p, begin), (m, first), (s, second))], axis=1)
    out = np.empty(out_offsets[-1], np.uint8)
    for at, stop, shift in shifts(np.stack([begin, first, second], axis=1).ravel(), way.ravel(), len(data)):
        out[np.arange(at, stop) + shift] = data[at:stop]
    for places, letter in ((p, _P), (m, _M), (s, _S)):
        at = places[~plain]
        out[at], out[at + 1], out[at + 2] = ord("<"), letter, ord(">")
    return out, out_offsets


def put_back(data, offsets, form):
    """Bytes and offsets of the texts that ``rearrange`` had, from its outputs and forms alone, and whether each
    output has the marks of its form."""
    n = len(form)
    place = {letter: np.full(n, -1, np.int64) for letter in (_P, _S, _M)}
    found = np.zeros(n, np.int64)
    for hit, doc, letter in marks(data, offsets, form != PLAIN):
        found += np.bincount(doc, minlength=n)
        for x, at in place.items():
            at[doc[letter == x]] = hit[letter == x]
    begin, end = offsets[:-1], offsets[1:]
    p, m, s = place[_P], place[_M], place[_S]
    opened, closed = np.where(form == SPM, s, p), np.where(form == SPM, p, s)
    good = (form == PLAIN) | ((found == 3) & (opened == begin) & (opened < closed) & (closed < m))
    size = np.where(form == PLAIN, end - begin, end - begin - 9) * good
    moved = good & (form != PLAIN)
    first_size = closed - opened - 3
    prefix = np.where(moved, np.where(form == SPM, m - closed - 3, first_size), 0)
    suffix = np.where(moved, np.where(form == SPM, first_size, m - closed - 3), 0)
    back = np.concatenate([[0], np.cumsum(size)])
    to = np.stack([back[:-1], back[:-1] + prefix, back[1:] - suffix], axis=1)
    source = np.stack([np.where(moved, x + 3, begin + y) for x, y in ((p, 0), (m, prefix), (s, size - suffix))], axis=1)
    out = np.empty(back[-1], np.uint8)
    for at, stop, shift in shifts(to.ravel(), (source - to).ravel(), len(out)):
        out[at:stop] = data[np.arange(at, stop) + shift]
    return out, back, good


def _draws(ids, seed) -> np.ndarray:
    """Four unsigned 32-bit numbers of each id from SHA-256 of ``seed:id``."""
    heads = b"".join(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).digest()[:16] for i in ids)
    return np.frombuffer(heads, ">u4").reshape(-1, 4).astype(np.int64)


def _transformed(batches, seed, rearranged, suffix_first):
    for batch in steps(batches):
        data, offsets = buffers(batch.column(1))
        h = _draws(batch.column(0).to_pylist(), seed)
        before = ranks(data, offsets)
        n = np.diff(before)
        a, b = h[:, 0] % (n + 1), h[:, 1] % (n + 1)
        a, b = np.minimum(a, b), np.maximum(a, b)
        cuts = select(data, (before[:-1, None] + np.stack([a, b], axis=1)).ravel()).reshape(-1, 2)
        marked = np.zeros(len(n), bool)
        for _, doc, _ in marks(data, offsets, np.ones(len(n), bool)):
            marked[doc] = True
        form = np.where(h[:, 3] % 100 < suffix_first, SPM, PSM)
        form[(n == 0) | marked | (h[:, 2] % 100 >= rearranged)] = PLAIN
        out, out_offsets = rearrange(data, offsets, cuts[:, 0], cuts[:, 1], form)
        plain = form == PLAIN
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(n), pa.array(FORMS[form]), pa.array(a, mask=plain), pa.array(b - a, mask=plain),
             strings(out, out_offsets)], names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])


def fill_in_middle(docs: DataFrame, seed: str = "1", rearranged: int = REARRANGED, suffix_first: int = SUFFIX_FIRST) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output) of every row of ``docs`` (doc_id, text).

    ``n`` counts code points; the two cuts and the form are drawn from SHA-256 of ``seed:doc_id`` (nothing for
    a null id), so repeated ids get the same draws.  ``form`` is psm (``<P>`` prefix ``<S>`` suffix ``<M>``
    middle), spm (``<S>`` suffix ``<P>`` prefix ``<M>`` middle) or plain (the text): empty or null texts,
    those that contain a mark, and those beyond ``rearranged`` of 100.  The sizes are null where it is plain.
    """
    kind = docs.schema["doc_id"].dataType
    schema = T.StructType([
        T.StructField("doc_id", kind), T.StructField("n", T.LongType()), T.StructField("form", T.StringType()),
        T.StructField("prefix_chars", T.LongType()), T.StructField("middle_chars", T.LongType()), T.StructField("output", T.StringType())])
    return docs.select("doc_id", "text").mapInArrow(lambda batches: _transformed(batches, seed, rearranged, suffix_first), schema)


def _restored(batches, at):
    for batch in steps(batches, at):
        form = np.array([{"psm": PSM, "spm": SPM}.get(f, PLAIN) for f in batch.column(batch.schema.get_field_index("form")).to_pylist()], np.int64)
        text, offsets, good = put_back(*buffers(batch.column(at)), form)
        restored = pc.if_else(pa.array(good), strings(text, offsets), pa.scalar(None, pa.string()))
        yield pa.RecordBatch.from_arrays([*batch.columns, restored], names=[*batch.schema.names, "restored"])


def restore(outputs: DataFrame) -> DataFrame:
    """``outputs`` with a column ``restored``: the text before ``fill_in_middle``, from ``output`` and ``form`` alone.
    Null where the output has not the marks of its form; a null output of form plain is the empty text."""
    outputs = outputs.drop("restored")
    at = outputs.columns.index("output")
    return outputs.mapInArrow(lambda batches: _restored(batches, at), T.StructType([*outputs.schema.fields, T.StructField("restored", T.StringType())]))
