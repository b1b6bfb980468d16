"""Inverted lists that travel packed: rows of one bucket of keys as one binary value, and of all rows only
those that have a possible partner as rows of a table."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import mix
from .linking import MOST_PAIRS, SHORT_RUN

#: Buckets of keys for each shuffle partition, and keys (or as many bytes of rows) that a task gathers before it deals them out.
BUCKETS, GATHERED = 8, 1 << 19
#: So many buckets leave their numbers room in ``codes``.
MOST_BUCKETS = 1 << 18
#: Buckets whose rows leave a task in one batch.
PACKED = 64
#: Rows of a key that one task compares with each other; longer lists are dealt out over several.
MOST_COMPARED = 2048


def buckets_of(spark: SparkSession) -> int:
    return min(BUCKETS * int(spark.conf.get("spark.sql.shuffle.partitions")), MOST_BUCKETS)


def bucket_of(key: np.ndarray, buckets: int) -> np.ndarray:
    return (mix(key.view(np.uint64)) % np.uint64(buckets)).astype(np.int64)


def brief(key: np.ndarray, buckets: int) -> np.ndarray:
    """A key's bucket and 32 of its bits."""
    return bucket_of(key, buckets) << 32 | key & 0xFFFFFFFF


def dealt(rows: np.ndarray, bucket: np.ndarray) -> pa.RecordBatch:
    """Rows packed by their buckets: Spark's rows would be twice as large."""
    order = np.argsort(bucket, kind="stable")
    rows, bucket = rows[order], bucket[order]
    begins = np.concatenate([np.flatnonzero(np.diff(bucket, prepend=-1)), [len(bucket)]]).tolist()
    spans = list(zip(begins[:-1], begins[1:]))
    return pa.RecordBatch.from_pydict({"bucket": pa.array([int(bucket[a]) for a, _ in spans], pa.int32()),
                                       "packed": pa.array([planes(rows[a:b]) for a, b in spans], pa.binary())})


def dealt_parts(rows: np.ndarray, bucket: np.ndarray) -> Iterator[pa.RecordBatch]:
    """``dealt`` of rows in the order of their buckets, PACKED buckets at a time: so much is copied at once."""
    begins = np.flatnonzero(np.diff(bucket, prepend=-1))[::PACKED].tolist()
    for a, b in zip(begins, [*begins[1:], len(bucket)]):
        yield dealt(rows[a:b], bucket[a:b])


def planes(rows: np.ndarray) -> bytes:
    """The first bytes of all rows, then the second ones ...: numbers that are small or sorted compress so."""
    return rows.view(np.uint8).reshape(len(rows), -1).T.tobytes()


def of_planes(parts: list[bytes], kind: np.dtype) -> np.ndarray:
    """The rows that ``planes`` packed."""
    size = np.dtype(kind).itemsize
    out = np.empty((sum(map(len, parts)) // size, size), np.uint8)
    at = 0
    for part in parts:
        n = len(part) // size
        out[at : at + n] = np.frombuffer(part, np.uint8).reshape(size, n).T
        at += n
    return out.view(kind).reshape(-1)


def gathered(parts: Iterable[np.ndarray], most: int = GATHERED) -> Iterator[np.ndarray]:
    """Arrays joined until they hold ``most`` rows."""
    held, n = [], 0
    for part in parts:
        held.append(part)
        n += len(part)
        if n >= most:
            whole, held, n = np.concatenate(held), [], 0  # the parts go before the whole is worked on
            yield whole
            del whole
    if n:
        yield np.concatenate(held)


def dealt_steps(key: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Sorted keys (a bucket and 32 bits each), packed by their buckets as the steps from one to the next."""
    bucket = key >> 32
    step = np.diff(key & 0xFFFFFFFF, prepend=0)  # ascending within a bucket
    first = np.diff(bucket, prepend=-1) != 0
    step[first] = key[first] & 0xFFFFFFFF
    return dealt_parts(step.astype(np.uint32), bucket)


def of_steps(packed: list[bytes]) -> np.ndarray:
    """The 32 bits of the keys of one bucket that ``dealt_steps`` packed."""
    return np.concatenate([np.cumsum(of_planes([p], np.uint32), dtype=np.uint32) for p in packed])


def repeated_keys(source: DataFrame, keys: Callable, buckets: int) -> DataFrame:
    """(key) of the ``brief`` keys that two rows or more have, and a few others.  ``keys(batches)`` gives arrays of
    64-bit keys; 32 bits of each travel."""

    def spread(batches):
        for key in gathered(keys(batches)):
            key, n = np.unique(brief(key, buckets), return_counts=True)
            yield from dealt_steps(np.sort(np.concatenate([key, key[n > 1]])))  # twice if two rows of the task have it

    def add(batches):
        held: dict[int, list[bytes]] = {}
        for batch in batches:
            for bucket, packed in zip(*(c.to_pylist() for c in batch.columns)):
                held.setdefault(bucket, []).append(packed)
        for bucket, packed in held.items():
            key, n = np.unique(of_steps(packed), return_counts=True)
            yield pa.RecordBatch.from_pydict({"key": bucket << 32 | key[n > 1].astype(np.int64)})

    return source.mapInArrow(spread, "bucket int, packed binary").repartition("bucket").mapInArrow(add, "key long")


#: Bits of a code inside its bucket, and of the tag that tells its owners apart.
CODE_BITS, TAG_BITS = 28, 16


def codes(key: np.ndarray, buckets: int) -> np.ndarray:
    """A bucket and CODE_BITS more of keys that are hashes of 64 bits: sorted codes are sorted by bucket."""
    bucket = (key >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)
    return (bucket << np.uint64(CODE_BITS) | key & np.uint64((1 << CODE_BITS) - 1)).view(np.int64)


#: Owners of a code from which on it is of the next level, and bits of that level's bitmap at any input size.
LEVELS = ((2, 1 << 27), (16, 1 << 24), (256, 1 << 21))
#: The same for keys of which every occurrence counts.
ONE_LEVEL = ((2, 1 << 25),)


class Levels:
    """How common codes are, by bitmaps in which each bucket has its range: 0 for a code that one owner has, 1, 2 ... for
    those of each level.  A few codes get a higher level than theirs."""

    def __init__(self, each: list[int], bits: list[np.ndarray]):
        self.each, self.bits = each, bits

    def __call__(self, code: np.ndarray) -> np.ndarray:
        out = np.zeros(len(code), np.uint8)
        some = None
        for level, (each, bits) in enumerate(zip(self.each, self.bits), 1):
            own = code if some is None else code[some]
            at = (own >> CODE_BITS) * each + ((own & (1 << CODE_BITS) - 1) * each >> CODE_BITS)
            found = np.flatnonzero(bits[at >> 3] >> (at & 7).astype(np.uint8) & 1)
            some = found if some is None else some[found]
            out[some] = level
        return out


def _each_once(code: np.ndarray) -> np.ndarray:
    """Sorted numbers without their repeats."""
    kept = np.ones(len(code), bool)
    kept[1:] = code[1:] != code[:-1]
    return code[kept]


def _two_each(code: np.ndarray, bits: int) -> np.ndarray:
    """Of sorted numbers that agree but for their lowest ``bits`` two at most."""
    kept = np.ones(len(code), bool)
    kept[2:] = code[2:] >> bits != code[:-2] >> bits
    return code[kept]


def _dealt_codes(code: np.ndarray, bits: int) -> Iterator[pa.RecordBatch]:
    """Sorted numbers, whose buckets stand above ``bits``, packed by these as the steps from one to the next."""
    bucket, inside = code >> bits, code & (1 << bits) - 1
    step = np.diff(inside, prepend=0)
    first = np.diff(bucket, prepend=-1) != 0
    step[first] = inside[first]
    size = -(-bits // 8)
    yield from dealt_parts(step.view(np.uint8).reshape(-1, 8)[:, :size].copy().view(f"V{size}").reshape(-1), bucket)


def _codes_of(packed: bytes, bits: int) -> np.ndarray:
    """The numbers, without their bucket, that ``_dealt_codes`` packed."""
    size = -(-bits // 8)
    step = np.zeros((len(packed) // size, 8), np.uint8)
    step[:, :size] = np.frombuffer(packed, np.uint8).reshape(size, -1).T
    return np.cumsum(step.view(np.int64).reshape(-1))


def common_levels(source: DataFrame, keys: Callable, buckets: int) -> tuple[Levels, Levels]:
    """The levels of the ``codes`` of keys by owners, and of those that count each time.

    ``keys(batches)`` gives arrays (key, owner) of 64-bit hashes, or (key, None) where each occurrence counts.  Two owners of a
    code are taken for one where 16 bits of a hash of both agree, which are others for each code; never if just their highest bits differ.
    Of owners that a task gathers at a time, two are told for a code that has more."""
    kinds = LEVELS, ONE_LEVEL
    each = [[max(8, bits // buckets & ~7) for _, bits in kind] for kind in kinds]

    def spread(batches):
        held, n_held = ([], []), [0, 0]

        def given(kind):
            code = np.sort(np.concatenate([np.zeros(0, np.int64), *held[kind]]))
            held[kind].clear()
            n_held[kind] = 0
            if kind:
                yield from _dealt_codes(_two_each(code, 0) + (buckets << CODE_BITS), CODE_BITS)
            else:
                yield from _dealt_codes(_two_each(_each_once(code), TAG_BITS), CODE_BITS + TAG_BITS)

        for key, owner in keys(batches):
            code, kind = codes(key, buckets), int(owner is None)
            if owner is not None:
                tag = (owner ^ code.view(np.uint64) * np.uint64(0xD6E8FEB86659FD93)) * np.uint64(0x9E6C63D0876A9A47) >> np.uint64(64 - TAG_BITS)
                code = code << TAG_BITS | tag.view(np.int64)
            held[kind].append(code)
            n_held[kind] += len(code)
            if n_held[kind] >= GATHERED:
                yield from given(kind)
        yield from given(0)
        yield from given(1)

    def add(batches):
        for bucket, parts in _by_bucket(batches):
            kind = int(bucket >= buckets)
            code = np.sort(np.concatenate([_codes_of(part, CODE_BITS + (0 if kind else TAG_BITS)) for part in parts]))
            if not kind:
                code = _each_once(code) >> TAG_BITS
            again = code[1:][code[1:] == code[:-1]]
            row = {"bucket": pa.array([bucket], pa.int32())}
            for level in range(len(LEVELS)):
                size = each[kind][level] if level < len(each[kind]) else 0
                bits = np.zeros(size, bool)
                if size:
                    n = kinds[kind][level][0]
                    bits[again[n - 2 :][again[n - 2 :] == again[: max(0, len(again) - n + 2)]] * size >> CODE_BITS] = True
                row[f"level{level}"] = pa.array([np.packbits(bits, bitorder="little").tobytes()], pa.binary())
            yield pa.RecordBatch.from_pydict(row)

    schema = "bucket int, " + ", ".join(f"level{k} binary" for k in range(len(LEVELS)))
    table = source.mapInArrow(spread, "bucket int, packed binary").repartition("bucket").mapInArrow(add, schema).toArrow()
    bits = [[np.zeros(buckets * size // 8, np.uint8) for size in kind] for kind in each]
    for batch in table.to_batches():
        for row in batch.to_pylist():
            kind, at = divmod(row["bucket"], buckets)
            for k, size in enumerate(each[kind]):
                bits[kind][k][at * size // 8 : (at + 1) * size // 8] = np.frombuffer(row[f"level{k}"], np.uint8)
    return tuple(Levels(*x) for x in zip(each, bits))


def _column(values: np.ndarray) -> pa.Array:
    if values.ndim > 1:
        return pa.array([row.tobytes() for row in np.ascontiguousarray(values)], pa.binary())
    return pa.array(values.astype(np.int64) if values.dtype.itemsize < 8 else np.ascontiguousarray(values).view(np.int64))


def _spread(posts: Callable, kind: np.dtype, buckets: int):
    def spread(batches):
        for rows in gathered(posts(batches), GATHERED * 8 // kind.itemsize):  # as many bytes as of keys
            bucket = bucket_of(rows["key"].copy(), buckets)
            order = np.lexsort((rows["node"], rows["key"], bucket))
            key, node = rows["key"][order], rows["node"][order]
            new = np.ones(len(rows), bool)  # a node that several rows of the task stand for is one
            new[1:] = (key[1:] != key[:-1]) | (node[1:] != node[:-1])
            del key, node
            order = order[new]
            rows, bucket = rows[order], bucket[order]
            yield from dealt_parts(rows, bucket)

    return spread


def _by_bucket(batches) -> Iterator[tuple[int, list[bytes]]]:
    """The packed rows of each bucket of a task, one bucket after the other: whole lists, and only one bucket is unpacked at a time."""
    held: dict[int, list[bytes]] = {}
    for batch in batches:
        for bucket, packed in zip(*(c.to_pylist() for c in batch.columns)):
            held.setdefault(bucket, []).append(packed)
    for bucket in list(held):
        yield bucket, held.pop(bucket)


def _buckets(batches) -> Iterator[list[bytes]]:
    return (parts for _, parts in _by_bucket(batches))


def _lists(parts: list[bytes], kind: np.dtype, size: str) -> tuple[np.ndarray, np.ndarray]:
    """The rows of a bucket by key and ``size``, a node once in a list, and where each list begins (one more at the end)."""
    rows = of_planes(parts, kind)
    rows = rows[np.lexsort((rows["node"], rows[size], rows["key"]))]
    again = np.zeros(len(rows), bool)
    again[1:] = (rows["key"][1:] == rows["key"][:-1]) & (rows["node"][1:] == rows["node"][:-1])
    rows = rows[~again]
    return rows, np.flatnonzero(np.concatenate([[True], rows["key"][1:] != rows["key"][:-1], [True]])) if len(rows) else np.zeros(1, np.int64)


def _near_pairs(rows: np.ndarray, begins: np.ndarray, near: Callable):
    """Pairs of places (x, y) in one list that ``near`` passes, of all lists that one task may compare."""
    own = _own(rows)
    sizes = np.diff(begins)
    for n in np.unique(sizes[(sizes > 1) & (sizes <= SHORT_RUN)]).tolist():
        alike = begins[:-1][sizes == n]
        first, second = np.triu_indices(n, 1)
        for some in np.array_split(alike, -(-len(alike) * len(first) // MOST_PAIRS)):
            x, y = (some[:, None] + first).ravel(), (some[:, None] + second).ravel()
            fits = near(own, x, y)
            yield x[fits], y[fits]
    for at in np.flatnonzero((sizes > SHORT_RUN) & (sizes <= MOST_COMPARED)).tolist():
        for k in range(begins[at] + 1, begins[at + 1]):
            x = np.arange(begins[at], k)
            x = x[near(own, x, np.full(len(x), k))]
            yield x, np.full(len(x), k)


def met_posts(source: DataFrame, posts: Callable, kind: np.dtype, size: str, near: Callable, buckets: int) -> DataFrame:
    """The rows of ``kind`` (key, node, ``size`` and others) and n_rows, the rows of their key, where ``near`` passes another
    row of the key: one row a post, however many those are.  Rows of lists too long for one task to compare
    are all given.

    ``posts(batches)`` gives structured arrays; ``near(own, a, b)`` judges pairs of places, b[i] being the one of the
    larger ``size``; binary fields are rows of 64-bit numbers."""
    names = list(kind.names)

    def meet(batches):
        for parts in _buckets(batches):
            rows, begins = _lists(parts, kind, size)
            sizes = np.diff(begins)
            met = np.repeat(sizes > MOST_COMPARED, sizes)
            for x, y in _near_pairs(rows, begins, near):
                met[x] = met[y] = True
            rows, n_rows = rows[met], np.repeat(sizes, sizes)[met]
            for at in range(0, len(rows), GATHERED):
                part = rows[at : at + GATHERED]
                yield pa.RecordBatch.from_arrays([*(_column(part[name]) for name in names), pa.array(n_rows[at : at + GATHERED].astype(np.int64))], [*names, "n_rows"])

    schema = T.StructType([T.StructField(name, T.BinaryType() if kind[name].shape else T.LongType()) for name in names] + [T.StructField("n_rows", T.LongType())])
    return source.mapInArrow(_spread(posts, kind, buckets), "bucket int, packed binary").repartition("bucket").mapInArrow(meet, schema)


def dealt_posts(rows: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Rows whose keys are ``codes``, packed by their buckets."""
    rows = rows[np.argsort(rows["key"], kind="stable")]
    new = np.ones(len(rows), bool)  # most rows that a node has several times for a key
    new[1:] = (rows["key"][1:] != rows["key"][:-1]) | (rows["node"][1:] != rows["node"][:-1])
    rows = rows[new]
    yield from dealt_parts(rows, rows["key"] >> CODE_BITS)


def met_links(posts: DataFrame, kind: np.dtype, size: str, least: Callable, near: Callable, buckets: int) -> DataFrame:
    """(a, b), a < b: links that connect whatever ``near`` connects inside the lists of ``posts`` (bucket, packed), see
    ``dealt_posts``, and all rows of a list too long for one task to compare.  ``least(sizes)`` is the least ``size`` that
    ``near`` may pass beside a larger one; other arguments as ``met_posts``."""

    def meet(batches):
        links, n = [], 0
        for parts in _buckets(batches):
            links.append(_stars(*_code_lists(of_planes(parts, kind), size), size, least, near))
            n += len(links[-1])
            if n >= GATHERED:
                yield from spread(links)
                links, n = [], 0
        yield from spread(links)

    def spread(links):
        links = _distinct(links)
        yield from dealt_parts(links, codes(links["a"].view(np.uint64), buckets) >> CODE_BITS)  # nodes are hashes

    def distinct(batches):
        for parts in _buckets(batches):
            links = _distinct([of_planes(parts, LINK)])
            yield pa.RecordBatch.from_pydict({"a": pa.array(links["a"].copy()), "b": pa.array(links["b"].copy())})

    dealt = posts.repartition("bucket").mapInArrow(meet, "bucket int, packed binary")
    return dealt.repartition("bucket").mapInArrow(distinct, "a long, b long")


LINK = np.dtype([("a", "<i8"), ("b", "<i8")])


def _distinct(links: list[np.ndarray]) -> np.ndarray:
    links = np.concatenate([np.zeros(0, LINK), *links])
    links = links[np.lexsort((links["b"], links["a"].view(np.uint64)))]
    new = np.ones(len(links), bool)
    new[1:] = (links["a"][1:] != links["a"][:-1]) | (links["b"][1:] != links["b"][:-1])
    return links[new]


#: Sizes from here on have no order.
CAPPED = 0xFFFF


def _code_lists(rows: np.ndarray, size: str) -> tuple[np.ndarray, np.ndarray]:
    """As ``_lists``, of rows whose keys are ``codes`` of one bucket; a node may be in a list again."""
    key, node = rows["key"].view(np.uint64), rows["node"].view(np.uint64)
    some = np.minimum(rows[size], CAPPED).astype(np.uint64) << np.uint64(20) | node & np.uint64(0xFFFFF)
    rows = rows[np.argsort(key << np.uint64(36) | some)]
    again = np.zeros(len(rows), bool)
    again[1:] = (rows["key"][1:] == rows["key"][:-1]) & (rows["node"][1:] == rows["node"][:-1])
    rows = rows[~again]
    return rows, np.flatnonzero(np.concatenate([[True], rows["key"][1:] != rows["key"][:-1], [True]])) if len(rows) else np.zeros(1, np.int64)


def _own(rows: np.ndarray) -> dict[str, np.ndarray]:
    return {name: rows[name].astype(np.int64) if rows[name].dtype.itemsize < 8 else np.ascontiguousarray(rows[name]) for name in rows.dtype.names}


def _stars(rows: np.ndarray, begins: np.ndarray, size: str, least: Callable, near: Callable) -> np.ndarray:
    """Links from the smallest node of each set that ``near`` connects inside a list to its others."""
    several = np.diff(begins) > 1
    rows = rows[np.repeat(several, np.diff(begins))]
    sizes = np.diff(begins)[several]
    begins = np.cumsum(sizes) - sizes
    first, place, own = np.repeat(begins, sizes), np.arange(len(rows)), _own(rows)
    fits = near(own, first, place)  # most lists are one set, around its first row
    label = np.where(fits | np.repeat(sizes > MOST_COMPARED, sizes), first, place)
    if len(rows):
        apart = np.repeat(np.add.reduceat(label != first, begins) > 0, sizes)
        label = _labels(label, _open_pairs(own, np.flatnonzero(apart), first, label, size, least, near))
    inside = label != place
    inside[label[inside]] = True
    at = np.flatnonzero(inside)
    at = at[np.lexsort((rows["node"][at], label[at]))]
    node, label = rows["node"][at], label[at]
    top = np.flatnonzero(np.diff(label, prepend=-1))
    out = np.empty(len(at), LINK)
    out["a"], out["b"] = np.repeat(node[top], np.diff(np.append(top, len(at)))), node
    return out[out["a"] != out["b"]]


def _open_pairs(own: dict[str, np.ndarray], at: np.ndarray, first: np.ndarray, label: np.ndarray, size: str, least: Callable, near: Callable):
    """Pairs of the places ``at``, whole lists by ``size``, of one list and two labels that ``near`` passes."""
    code = first << 16 | np.minimum(own[size], CAPPED)  # ascends
    low = np.searchsorted(code, first[at] << 16 | np.minimum(least(own[size][at]), CAPPED))
    n = at - low
    ends = np.cumsum(n)
    k = 0
    while k < len(at):
        stop = max(k + 1, int(np.searchsorted(ends, (ends[k - 1] if k else 0) + MOST_PAIRS, side="right")))
        y = np.repeat(at[k:stop], n[k:stop])
        x = np.arange(len(y)) - np.repeat(ends[k:stop] - n[k:stop] - (ends[k - 1] if k else 0) - low[k:stop], n[k:stop])
        two = np.flatnonzero(label[x] != label[y])
        x, y = x[two], y[two]
        fits = near(own, x, y)
        yield x[fits], y[fits]
        k = stop


def _labels(label: np.ndarray, near_pairs) -> np.ndarray:
    """``_settled`` by pairs that come in parts: of many pairs only the labels stay."""
    pairs, n_pairs = [], 0
    for x, y in near_pairs:
        pairs.append((x, y))
        n_pairs += len(x)
        if n_pairs >= MOST_PAIRS:
            label = _settled(label, pairs)
            pairs, n_pairs = [], 0
    return _settled(label, pairs) if n_pairs else label


def met_sets(source: DataFrame, posts: Callable, kind: np.dtype, size: str, near: Callable, buckets: int) -> DataFrame:
    """(key, node, rank, n_rows): sets of nodes that ``near`` connects inside one list, each set once, whatever lists give
    it (``key`` stands for the set).  A list too long for one task to compare is a set as it is.  ``rank``, the bits
    between a row's ``simhash`` and the majority of its set, puts first what most others are like.  Other
    arguments as ``met_posts``."""

    def meet(batches):
        seen: set[int] = set()  # sets that the task gave
        for parts in _buckets(batches):
            yield from met(*_lists(parts, kind, size), seen)

    def met(rows, begins, seen):
        sizes = np.diff(begins)
        label = _labels(np.arange(len(rows)), _near_pairs(rows, begins, near))
        order = np.lexsort((rows["node"], label))
        begin = np.flatnonzero(np.concatenate([[True], np.diff(label[order]) != 0])) if len(order) else np.zeros(0, np.int64)
        n = np.diff(np.append(begin, len(order)))
        begin, n = begin[n > 1], n[n > 1]
        yield from given(rows[order], begin, n, None, seen)
        for at in np.flatnonzero(sizes > MOST_COMPARED).tolist():
            whole = rows[begins[at] : begins[at + 1]]
            cuts = np.arange(0, len(whole), MOST_COMPARED)
            yield from given(whole, cuts, np.diff(np.append(cuts, len(whole))), rows["key"][begins[at]], seen)

    def given(rows, begin, n, key, seen):
        """Sets as rows; ``part`` tells the rows of one long list apart."""
        if not len(begin):
            return
        spans = np.repeat(begin - (np.cumsum(n) - n), n) + np.arange(n.sum())
        nodes, begin = np.ascontiguousarray(rows["node"][spans]), np.cumsum(n) - n
        ranks = _from_majority(np.ascontiguousarray(rows["simhash"][spans]), begin if key is None else np.zeros(1, np.int64))
        total = np.add.reduceat(mix(nodes.view(np.uint64)), begin).view(np.int64) if key is None else np.full(len(n), key)
        part = np.zeros(len(n), np.int64) if key is None else np.arange(1, len(n) + 1)
        size_ = n if key is None else np.full(len(n), n.sum())
        keep = np.unique(total, return_index=True)[1] if key is None else np.arange(len(n))
        if key is None:
            keep = np.array([at for at, one in zip(keep.tolist(), total[keep].tolist()) if one not in seen], np.int64)
            seen.update(total[keep].tolist())
        members = pa.StructArray.from_arrays([pa.array(nodes), pa.array(ranks)], ["node", "rank"])
        lists = pa.ListArray.from_arrays(pa.array(np.append(begin, len(nodes)), pa.int32()), members).take(pa.array(keep))
        yield pa.RecordBatch.from_arrays(
            [pa.array(total[keep]), pa.array(part[keep]), pa.array(size_[keep].astype(np.int64)), lists], ["key", "part", "n_rows", "nodes"])

    schema = "key long, part long, n_rows long, nodes array<struct<node: long, rank: long>>"
    sets = source.mapInArrow(_spread(posts, kind, buckets), "bucket int, packed binary").repartition("bucket").mapInArrow(meet, schema)
    sets = sets.groupBy("key", "part").agg(F.first("n_rows").alias("n_rows"), F.first("nodes").alias("nodes"))
    return sets.select("key", F.inline("nodes"), "n_rows").select("key", "node", "rank", "n_rows")


def unlike_most(own: dict[str, np.ndarray], begins: np.ndarray) -> np.ndarray:
    """How many bits each ``simhash`` is from the majority of its group: those that most others are like come first."""
    return _from_majority(own["simhash"].view(np.uint64), begins)


def _from_majority(hashes: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """How many bits each hash is from the majority of its set; sets begin at the ascending places ``begin``."""
    sizes = np.diff(np.append(begin, len(hashes)))
    ones = np.stack([np.add.reduceat((hashes >> np.uint64(k) & np.uint64(1)).astype(np.int64), begin) for k in range(64)])
    majority = np.zeros(len(begin), np.uint64)
    for k in range(64):
        majority |= (2 * ones[k] > sizes).astype(np.uint64) << np.uint64(k)
    return np.bitwise_count(hashes ^ np.repeat(majority, sizes)).astype(np.int64)


def _settled(label: np.ndarray, pairs) -> np.ndarray:
    """Labels (each the place of a row that has itself as its label) on which all pairs agree as well: the
    smallest label spreads until nothing changes."""
    x, y = (np.concatenate(p) for p in zip(*pairs))
    while len(x):
        a, b = label[x], label[y]
        apart = a != b
        x, y, a, b = x[apart], y[apart], a[apart], b[apart]
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while True:
            above = label[label]
            if (above == label).all():
                break
            label = above
    return label
