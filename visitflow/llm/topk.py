"""Operator 10: exact top-k inner products on a bit-sliced index.

Components are quantised to integers.  A block of vectors keeps, for each component, one bitmap
for each binary digit of its value above the block's minimum.  A query adds these bitmaps, shifted
by the digits of its weights, with carry-save adders; for a negative weight the inverted bitmaps
are added.  The bitmaps of the sum give the best rows from the most significant digit downward; the
rows still equal at the end lie exactly on the boundary and are taken by smallest vec_id.

Queries and vectors are dealt out in blocks, so that a task holds one block of each.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut

ROW_BLOCK = 32_768
QUERY_BLOCK = 1_024
#: Query blocks to make at least, where there are so many queries, for the cores to share.
MIN_QUERY_BLOCKS = 24


def quantised(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 64) -> DataFrame:
    """(vec_id, v) with v = floor(scale * x); vectors that are null or hold null, NaN or infinite
    components are left out, and equal rows count once."""
    usable = F.forall(vector_col, lambda x: F.coalesce(F.abs(x.cast("double")) < float("inf"), F.lit(False)))
    return (
        vectors.where(F.col(id_col).isNotNull() & F.coalesce(usable, F.lit(False)))
        .select(F.col(id_col).cast("long").alias("vec_id"),
                F.transform(vector_col, lambda x: F.floor(x.cast("double") * scale).cast("long")).alias("v"))
        .distinct())


class BitSlices:
    """``low``: each component's minimum; ``maps``: component, digit, words of its bitmap."""

    def __init__(self, low: np.ndarray, maps: np.ndarray, rows: int):
        self.low, self.maps, self.rows = low, maps, rows
        self.size, self.digits, words = maps.shape
        self.all = np.packbits(np.arange(64 * words) < rows, bitorder="little").view(np.uint64)

    @classmethod
    def of(cls, values: np.ndarray) -> BitSlices:
        """``values``: one row for each vector, one column for each component."""
        rows, size = values.shape
        low = values.min(axis=0) if rows else np.zeros(size, np.int64)
        above = values - low
        digits = max(1, int(above.max()).bit_length()) if above.size else 1
        padded = np.zeros((size, -(-rows // 64) * 64), np.int64)
        padded[:, :rows] = above.T
        maps = [np.packbits((padded >> s) & 1, axis=1, bitorder="little").view(np.uint64) for s in range(digits)]
        return cls(low, np.stack(maps, axis=1), rows)

    def add(self, query: np.ndarray) -> tuple[list[np.ndarray], int]:
        """Bitmaps of the sum, least significant first, and what to add to get the inner product."""
        weight = np.abs(query)
        minus = query < 0
        constant = int((query * self.low).sum()) - int(weight[minus].sum()) * ((1 << self.digits) - 1)
        places: dict[int, list[np.ndarray]] = {}
        for j in range(int(weight.max()).bit_length() if self.size else 0):
            chosen = np.flatnonzero((weight >> j) & 1)
            if len(chosen):
                flip = np.where(minus[chosen], np.uint64(0xFFFFFFFFFFFFFFFF), np.uint64(0))[:, None]
                for s in range(self.digits):
                    places.setdefault(j + s, []).append(self.maps[chosen, s] ^ flip)
        out, place = [], 0
        carried: list[np.ndarray] = []
        while place <= max(places, default=-1) or carried:
            stack = np.concatenate([*places.get(place, []), *carried]) if places.get(place) or carried else np.zeros((0, len(self.all)), np.uint64)
            carried = []
            while len(stack) > 2:  # three bitmaps make one here and one in the next place
                third = len(stack) // 3
                a, b, c = stack[:third], stack[third : 2 * third], stack[2 * third : 3 * third]
                either = a ^ b
                carried.append((a & b) | (either & c))
                stack = np.concatenate([either ^ c, stack[3 * third :]])
            if len(stack) == 2:
                carried.append(stack[:1] & stack[1:])
                out.append(stack[0] ^ stack[1])
            else:
                out.append(stack[0] if len(stack) else np.zeros(len(self.all), np.uint64))
            place += 1
        return out, constant

    def best(self, query: np.ndarray, k: int, without: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row numbers and inner products of the ``k`` best rows but ``without``, the first row among
        equals, in no order."""
        total, constant = self.add(query)
        equal = self.all.copy()
        for row in without.tolist():
            equal[row >> 6] &= ~(np.uint64(1) << np.uint64(row & 63))
        sure = np.zeros_like(equal)
        if int(np.bitwise_count(equal).sum()) > k:
            for digits in reversed(total):
                higher = sure | (equal & digits)
                n = int(np.bitwise_count(higher).sum())
                if n > k:
                    equal = equal & digits
                else:
                    sure, equal = higher, equal & ~digits
                    if n == k:
                        break
        rows = rows_of(sure)
        if len(rows) < k:  # the boundary: equal sums
            rows = np.concatenate([rows, rows_of(equal)[: k - len(rows)]])
        scores = np.full(len(rows), constant, np.int64)
        for w, digits in enumerate(total):
            scores += ((digits[rows >> 6] >> (rows & 63).astype(np.uint64)) & np.uint64(1)).astype(np.int64) << w
        return rows, scores


def rows_of(bitmap: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.unpackbits(bitmap.view(np.uint8), bitorder="little"))


def blocks_of(vectors: DataFrame, blocks: int, size: int, most: int, make) -> DataFrame:
    """About ``blocks`` blocks of at most ``most`` vectors, by vec_id within each: (ids, low, values,
    block), where ``make`` gives low and values (two arrays) of a block's matrix."""

    def pack(batches):
        held = [b for b in batches if b.num_rows]
        table = pa.Table.from_batches(held) if held else None
        for at in range(0, table.num_rows if table else 0, most):
            part = table.slice(at, most)
            ids = part.column(0).to_numpy()
            order = np.argsort(ids, kind="stable")
            matrix = np.zeros((len(ids), size), np.int64)
            for k, v in enumerate(part.column(1).to_pylist()):
                matrix[k, : len(v)] = v
            cells = [ids[order], *make(matrix[order])]
            yield pa.RecordBatch.from_arrays([pa.array([c.tobytes()], pa.binary()) for c in cells], ["ids", "low", "values"])

    return cut(vectors.repartition(blocks).mapInArrow(pack, "ids binary, low binary, values binary").withColumn("block", F.monotonically_increasing_id()))


def sliced(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    index = BitSlices.of(matrix)
    return index.low, index.maps


def plain(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return np.zeros(0, np.int64), matrix


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 20, row_block: int = ROW_BLOCK, query_block: int = QUERY_BLOCK) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: for each of ``queries`` the ``k`` rows of ``vectors``
    with the greatest integer inner product but those of the query's own vec_id, all if there are
    fewer, ties by smaller vec_id.

    Both are (vec_id, v) of quantised().  A shorter vector counts as filled up with zeros; an empty
    one has inner product 0 with all; empty tables give no row.  Components and products must fit
    in 64 bits."""
    vectors, queries = cut(vectors), cut(queries)
    n, size = vectors.agg(F.count(F.lit(1)), F.max(F.size("v"))).first()
    m, query_size = queries.agg(F.count(F.lit(1)), F.max(F.size("v"))).first()
    size = max(size or 0, query_size or 0, 1)
    each = max(1, min(query_block, math.ceil(m / MIN_QUERY_BLOCKS)))
    rows = blocks_of(vectors, max(1, math.ceil(n / row_block)), size, row_block, sliced).toDF("ids", "low", "maps", "rows")
    asked = blocks_of(queries, max(1, math.ceil(m / each)), size, each, plain).drop("low").toDF("query_ids", "query_matrix", "query_block")
    row_numbers, query_numbers = ([r[0] for r in t.select(c).collect()] for t, c in ((rows, "rows"), (asked, "query_block")))  # one number a block

    def search(batches):
        for batch in batches:
            for ids, low, maps, query_ids, query_matrix in zip(*(c.to_pylist() for c in batch.columns)):
                ids, query_ids = np.frombuffer(ids, np.int64), np.frombuffer(query_ids, np.int64)
                index = BitSlices(np.frombuffer(low, np.int64), np.frombuffer(maps, np.uint64).reshape(size, -1, -(-len(ids) // 64)), len(ids))
                found = []
                for query_id, query in zip(query_ids.tolist(), np.frombuffer(query_matrix, np.int64).reshape(len(query_ids), size)):
                    own = np.arange(*np.searchsorted(ids, [query_id, query_id + 1]))
                    at, scores = index.best(query, k, own)
                    found.append((np.full(len(at), query_id), ids[at], scores))
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*found)], ["query_id", "vec_id", "score"])

    units = max(1, len(row_numbers) * len(query_numbers))
    by_rows = rows.withColumn("query_block", F.explode(F.lit(query_numbers).cast("array<long>"))).repartition(units, "rows", "query_block")
    by_queries = asked.withColumn("rows", F.explode(F.lit(row_numbers).cast("array<long>"))).repartition(units, "rows", "query_block")
    found = by_rows.join(by_queries.hint("shuffle_merge"), ["rows", "query_block"]).select("ids", "low", "maps", "query_ids", "query_matrix").mapInArrow(
        search, "query_id long, vec_id long, score long")
    ranked = found.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
