"""Links between similar rows without all pairs: inverted lists cut into blocks, a pass over each
block that leaves out pairs already known to be connected, and distributed connected components."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut

#: Rows of a list that one block holds on average; a longer list is compared block by block.
BLOCK_ROWS = 1024


#: Runs of up to so many rows are compared together, so many pairs at once; longer ones row by row.
SHORT_RUN, MOST_PAIRS = 64, 500_000


class Sets:
    """Union-find over any keys."""

    def __init__(self):
        self.parent: dict = {}

    def root(self, x):
        parent = self.parent
        top = x
        while (up := parent.get(top, top)) != top:
            top = up
        while (up := parent.get(x, x)) != top:
            parent[x] = top
            x = up
        return top

    def join(self, a, b) -> bool:
        """True if they were apart."""
        a, b = self.root(a), self.root(b)
        if a != b:
            self.parent[max(a, b)] = min(a, b)
        return a != b


def whole_keys(batches: Iterator[pa.RecordBatch], keys: int, ragged: tuple[int, ...] = ()) -> Iterator[tuple[list[np.ndarray], np.ndarray]]:
    """The columns of consecutive rows and a number for each distinct key (the first ``keys`` columns):
    the rows of one key come together, also across batches.  Binary columns become rows of 64-bit numbers,
    those at the places ``ragged`` stay bytes."""
    held: list[np.ndarray] | None = None  # rows of the last key so far
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = []
        for at, column in enumerate(batch.columns):
            if at in ragged:
                values = np.empty(batch.num_rows, object)
                values[:] = column.to_pylist()
                columns.append(values)
            elif pa.types.is_binary(column.type):
                columns.append(np.frombuffer(b"".join(column.to_pylist()), np.uint64).reshape(batch.num_rows, -1))
            else:
                columns.append(column.to_numpy(zero_copy_only=False))
        if held is not None:
            columns = [np.concatenate(c) for c in zip(held, columns)]
        change = np.zeros(len(columns[0]), bool)
        for k in range(keys):
            change[1:] |= columns[k][1:] != columns[k][:-1]
        number = np.cumsum(change)
        last = int(np.searchsorted(number, number[-1]))
        if last:
            yield [c[:last] for c in columns], number[:last]
        held = [c[last:].copy() for c in columns]
    if held is not None:
        yield held, np.zeros(len(held[0]), np.int64)


def runs(key: np.ndarray, code: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """The places in the order of key and code, and where each run of rows that agree in both begins
    (one more at the end); key ascends, and within a run the places do."""
    order = np.arange(len(key)) if code is None else np.lexsort((code, key))
    change = key[order][1:] != key[order][:-1]
    if code is not None:
        change |= code[order][1:] != code[order][:-1]
    return order, np.concatenate([[0], np.flatnonzero(change) + 1, [len(order)]])


def candidate_pairs(rows: DataFrame, keys: list[str], columns: list[str], order: list[str], near: Callable, forest: bool,
                    parts: Callable | None = None) -> DataFrame:
    """Pairs (a, b) of nodes, a < b, that ``near`` passes among rows that agree in ``keys``.

    ``rows``: keys, side, node, perhaps group, and ``columns``.  Rows of one group are known to be
    connected and make no pair; rows of side 1 and 2 make pairs across the sides alone (0: any).
    ``near(own, a, b)`` gets the rows' columns by name and says which of the pairs of places a[i], b[i]
    may be linked, a[i] being the earlier in ``order``.  ``parts(own)`` gives one code or more
    for each row; rows that agree in none of them make no pair.  With ``forest`` a task leaves out
    pairs that the pairs it gave before connect: what it gives spans the rest."""
    names = [*keys, "side", "node", *(["group"] if "group" in rows.columns else []), *columns]

    def pairs(batches):
        sets = Sets()
        out_a, out_b = [], []

        def flush():
            a, b = np.array(out_a, np.int64), np.array(out_b, np.int64)
            out_a.clear(), out_b.clear()
            return pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["a", "b"])

        def give(a: int, b: int) -> bool:
            if a == b or (forest and not sets.join(a, b)):
                return False
            out_a.append(a)
            out_b.append(b)
            return True

        def compare(own):
            side, node, group = own["side"], own["node"], own["group"]
            # rows of one label need no pair: known to be connected or, for a forest, by pairs given before
            label = np.array([sets.root(n) for n in node.tolist()], np.int64) if forest else group
            if (label == label[0]).all():
                return
            for k in range(1, len(node)):
                places = np.flatnonzero((label[:k] != label[k]) & (group[:k] != group[k]) & ((side[:k] != side[k]) | (side[k] == 0)))
                places = places[near(own, places, np.full(len(places), k))]
                if forest and len(places):  # one row of each label is enough
                    places = places[np.unique(label[places], return_index=True)[1]]
                for at in places.tolist():
                    if give(int(node[at]), int(node[k])) and forest:
                        label[(label == label[at]) | (label == label[k])] = sets.root(int(node[k]))

        for found, number in whole_keys(batches, len(keys)):
            own = dict(zip(names, found))
            own.setdefault("group", own["node"])
            node, group, side = own["node"], own["group"], own["side"]
            for code in [None] if parts is None else parts(own):
                order, begins = runs(number, code)
                sizes = np.diff(begins)
                if forest:  # neighbours first: that connects most rows that are alike
                    a, b = order[:-1], order[1:]
                    pair = np.repeat(np.arange(len(sizes)), sizes)
                    pair = np.flatnonzero((pair[:-1] == pair[1:]) & (group[a] != group[b]) & ((side[a] != side[b]) | (side[b] == 0)))
                    pair = pair[near(own, a[pair], b[pair])]
                    for x, y in zip(node[a[pair]].tolist(), node[b[pair]].tolist()):
                        give(x, y)
                    long_runs = np.flatnonzero(sizes > 2)
                else:
                    sorted_group = group[order]
                    long_runs = np.flatnonzero(np.minimum.reduceat(sorted_group, begins[:-1]) != np.maximum.reduceat(sorted_group, begins[:-1]))
                if forest:
                    nodes = node[order]
                    long_runs = np.array([at for at in long_runs.tolist()
                                          if len({sets.root(n) for n in nodes[begins[at] : begins[at + 1]].tolist()}) > 1], np.int64)
                for size in np.unique(sizes[long_runs[sizes[long_runs] <= SHORT_RUN]]).tolist():
                    alike = long_runs[sizes[long_runs] == size]
                    first, second = np.triu_indices(size, 1)
                    for part in np.array_split(alike, -(-len(alike) * len(first) // MOST_PAIRS)):
                        places = order[begins[part][:, None] + np.arange(size)]
                        a, b = places[:, first].ravel(), places[:, second].ravel()
                        open_ = np.flatnonzero((group[a] != group[b]) & ((side[a] != side[b]) | (side[b] == 0)))
                        a, b = a[open_], b[open_]
                        fits = near(own, a, b)
                        for x, y in zip(node[a[fits]].tolist(), node[b[fits]].tolist()):
                            give(x, y)
                for at in long_runs[sizes[long_runs] > SHORT_RUN].tolist():
                    places = order[begins[at] : begins[at + 1]]
                    compare({name: column[places] for name, column in own.items()})
            if len(out_a) >= 10_000:
                yield flush()
        if out_a:
            yield flush()

    dealt = rows.select(*names).repartition(*keys).sortWithinPartitions(*keys, *order)
    return dealt.mapInArrow(pairs, "a long, b long").distinct()


def verified_links(rows: DataFrame, keys: list[str], columns: list[str], order: list[str], near: Callable, linked: Callable,
                   ragged: list[str], extra: Callable | None = None, rank: Callable | None = None) -> DataFrame:
    """Links (a, b) of nodes, a < b, among rows that agree in ``keys``: a forest of each task, which connects
    every pair that ``near`` passes and ``linked`` confirms.

    ``rows``, sides, ``near`` and ``order`` are those of ``candidate_pairs``; ``linked(own, x, y)`` judges one
    pair of places for good, on columns that may be ``ragged`` (bytes of any length); ``extra(own)`` gives further
    columns, which a task derives from its rows.  ``rank(own, begins)`` numbers the rows of the keys that begin at those
    places: the rows of a key come by it, then in ``order``.  Pairs that the task's links
    connect already are not judged, and none is judged twice while it is remembered."""
    names = [*keys, "side", "node", *columns]

    def links(batches):
        sets = Sets()
        refused: set[int] = set()
        out_a, out_b = [], []

        def flush():
            a, b = np.array(out_a, np.int64), np.array(out_b, np.int64)
            out_a.clear(), out_b.clear()
            return pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["a", "b"])

        def judge(own, x: int, y: int, a: int, b: int) -> bool:
            if a == b or sets.root(a) == sets.root(b):
                return True
            pair = min(a, b) << 64 | max(a, b) & (1 << 64) - 1
            if pair in refused:
                return False
            if linked(own, x, y):
                sets.join(a, b)
                out_a.append(a)
                out_b.append(b)
                return True
            if len(refused) >= MOST_PAIRS:
                refused.clear()
            refused.add(pair)
            return False

        def across(side, a, b):
            return (side[a] != side[b]) | (side[b] == 0)

        def compare(own):
            """Each row of a long run with the earlier rows of other labels, until one of a label confirms."""
            side, node = own["side"], own["node"]
            nodes = node.tolist()
            label = np.array([sets.root(n) for n in nodes], np.int64)
            for k in range(1, len(nodes)):
                if (label == label[0]).all():
                    return
                places = np.flatnonzero(label[:k] != label[k])
                places = places[across(side, places, np.full(len(places), k))]
                places = places[near(own, places, np.full(len(places), k))]
                for at in places.tolist():
                    if label[at] != label[k] and judge(own, at, k, nodes[at], nodes[k]):
                        label[(label == label[at]) | (label == label[k])] = sets.root(nodes[k])

        for found, number in whole_keys(batches, len(keys), tuple(names.index(c) for c in ragged)):
            own = dict(zip(names, found))
            places, begins = runs(number, None)
            if rank is not None:
                ranked = np.lexsort((rank(own, begins[:-1]), number))
                own = {name: column[ranked] for name, column in own.items()}
            if extra is not None:
                own |= extra(own)
            node, side = own["node"], own["side"]
            nodes = node.tolist()
            sizes = np.diff(begins)
            a, b = np.repeat(begins[:-1], sizes), places  # the first row of a run with all others: that connects most
            pair = np.flatnonzero((a != b) & across(side, a, b))
            pair = pair[near(own, a[pair], b[pair])]
            for x, y in zip(a[pair].tolist(), b[pair].tolist()):
                judge(own, x, y, nodes[x], nodes[y])
            several = np.array([at for at in np.flatnonzero(sizes > 2).tolist()
                                if len({sets.root(n) for n in nodes[begins[at] : begins[at + 1]]}) > 1], np.int64)
            for size in np.unique(sizes[several[sizes[several] <= SHORT_RUN]]).tolist():
                alike = several[sizes[several] == size]
                first, second = np.triu_indices(size, 1)
                for part in np.array_split(alike, -(-len(alike) * len(first) // MOST_PAIRS)):
                    at = begins[part][:, None] + np.arange(size)
                    a, b = at[:, first].ravel(), at[:, second].ravel()
                    fits = np.flatnonzero(across(side, a, b))
                    fits = fits[near(own, a[fits], b[fits])]
                    for x, y in zip(a[fits].tolist(), b[fits].tolist()):
                        judge(own, x, y, nodes[x], nodes[y])
            for at in several[sizes[several] > SHORT_RUN].tolist():
                compare({name: column[begins[at] : begins[at + 1]] for name, column in own.items()})
            if len(out_a) >= 10_000:
                yield flush()
        if out_a:
            yield flush()

    dealt = rows.select(*names, *(c for c in order if c not in names)).repartition(*keys).sortWithinPartitions(*keys, *order).select(*names)
    return dealt.mapInArrow(links, "a long, b long").distinct()


def dealt_blocks(posts: DataFrame, blocks: Column) -> DataFrame:
    """``posts`` (node, ...) with block pair (first, second) and side: a list of one block stays one
    group (0, 0) of side 0; of a list of more, each row goes to every pair of blocks that its own is
    part of, side 1 as the first of the two and 2 as the second (0 where both are one)."""
    return (
        posts.withColumn("blocks", F.greatest(blocks, F.lit(1)).cast("int"))
        .withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumn("first", F.least("block", "other")).withColumn("second", F.greatest("block", "other"))
        .withColumn("side", F.when(F.col("first") == F.col("second"), 0).when(F.col("block") == F.col("first"), 1).otherwise(2).cast("int"))
        .drop("blocks", "block", "other"))


def in_lists(posts: DataFrame, lists: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """dealt_blocks() of the rows (key, node, ...), where they are; ``lists`` has the n_rows of every key of two rows or more."""
    long_lists = F.broadcast(lists.where(F.col("n_rows") > block_rows))  # one for block_rows posts at most
    return dealt_blocks(posts.join(long_lists, "key", "left"), F.ceil(F.col("n_rows") / block_rows)).drop("n_rows")


#: Bits of a membership table for each member, at least (128 kB) and at most (16 MB): beyond that more strangers pass.
BITS_EACH, LEAST_BITS, MOST_BITS = 16, 1 << 20, 1 << 27


class Members:
    """A bitmap of hashed numbers: every member passes, few others do."""

    def __init__(self, words: np.ndarray):
        self.words = words

    def __call__(self, values: np.ndarray) -> np.ndarray:
        at = xxhash_of_numbers(values) & np.uint64(64 * len(self.words) - 1)
        return self.words[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63)) & np.uint64(1) != 0


def xxhash_of_numbers(values: np.ndarray) -> np.ndarray:
    """Spark's xxhash64() of numbers: the public 64-bit xxHash of eight bytes, seed 42."""
    p1, p2, p3, p4, p5 = (np.uint64(p) for p in (
        0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))

    def turned(x, n):
        return x << np.uint64(n) | x >> np.uint64(64 - n)

    with np.errstate(over="ignore"):
        h = turned((np.uint64(42 + 8) + p5) ^ turned(values.astype(np.int64).view(np.uint64) * p2, 31) * p1, 27) * p1 + p4
        h = (h ^ h >> np.uint64(33)) * p2
        h = (h ^ h >> np.uint64(29)) * p3
    return h ^ h >> np.uint64(32)


def among(df: DataFrame, column: str, values: DataFrame, inside: bool = True) -> DataFrame:
    """The rows of ``df`` whose number in ``column`` is among ``values`` (one column), and a few others:
    what a join with ``values`` would find, at hardly any shuffle.  Null is not among them.  With ``inside``
    False exactly the rows that this leaves out."""
    shared = df.sparkSession.sparkContext.broadcast(members(values))  # of bounded size
    at = df.columns.index(column)

    def keep(batches):
        for batch in batches:
            yield picked(batch, at, shared.value, inside)

    return df.mapInArrow(keep, df.schema)


def picked(batch: pa.RecordBatch, at: int, known: Members, inside: bool = True) -> pa.RecordBatch:
    """The rows of a batch whose number in column ``at`` passes ``known``, or with ``inside`` False the others; null does not pass."""
    number = batch.column(at)
    wanted = pc.and_(pa.array(known(pc.fill_null(number, 0).to_numpy(zero_copy_only=False))), pc.is_valid(number))
    return batch.filter(wanted if inside else pc.invert(wanted))


def members(values: DataFrame) -> Members:
    """The bitmap of a table of one column of numbers: a summary of bounded size, made by a
    partially aggregated group of 64 bits each."""
    values = values.select(F.col(values.columns[0]).cast("long").alias("value")).where("value is not null")
    size = min(MOST_BITS, max(LEAST_BITS, 1 << (BITS_EACH * max(1, values.count()) - 1).bit_length()))
    place = F.xxhash64("value").bitwiseAND(F.lit(size - 1))
    bits = values.select(place.alias("place")).select(
        F.shiftright("place", 6).alias("word"), F.expr("shiftleft(1L, cast(place & 63 AS INT))").alias("bit"))
    table = bits.groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    words = np.zeros(size // 64, np.uint64)
    words[table.column("word").to_numpy()] = table.column("bits").to_numpy().view(np.uint64)
    return Members(words)


#: Links that a task contracts at first, on average.
LINKS_EACH = 1 << 16


def connected_components(links: DataFrame) -> DataFrame:
    """(node, component) of all nodes of ``links`` (a, b); component is the smallest node.

    First every task replaces its LINKS_EACH links by stars around its local components' smallest nodes,
    where they are; a hub has then one link a task at most, and links that one task held are done.  Else the
    same is repeated with the links dealt out by their larger node until nothing changes: then every node has
    one parent, a smaller one, and parents are replaced by their own parents until all are roots."""

    def contract(batches):
        sets, given = Sets(), set()
        for batch in batches:
            for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                given.add((a, b))
                sets.join(a, b)
        stars = [(n, sets.root(n)) for n in sets.parent]
        changed = len(stars) != len(given) or any(star not in given for star in stars)
        if stars:
            node, parent = zip(*stars)
            yield pa.RecordBatch.from_arrays(
                [pa.array(node, pa.int64()), pa.array(parent, pa.int64()), pa.array([changed] * len(node))], ["node", "parent", "changed"])

    schema = "node long, parent long, changed boolean"
    links = cut(links.where("a <> b").select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("parent")))
    tasks = max(1, -(-links.count() // LINKS_EACH))
    edges = cut(links.coalesce(tasks).mapInArrow(contract, schema))
    while tasks > 1:
        edges = cut(edges.select("node", "parent").repartition("node").mapInArrow(contract, schema))
        if edges.where("changed").isEmpty():
            break
    edges = edges.select("node", "parent")
    while tasks > 1:
        above = edges.select(F.col("node").alias("parent"), F.col("parent").alias("top"))
        moved = cut(edges.join(above, "parent", "left").select("node", F.coalesce("top", "parent").alias("parent"), F.col("top").isNotNull().alias("changed")))
        edges = moved.select("node", "parent")
        if moved.where("changed").isEmpty():
            break
    edges = edges.withColumnRenamed("parent", "component")
    return edges.union(edges.select("component", "component").distinct())


def with_links(known: DataFrame, links: DataFrame) -> DataFrame:
    """The components of ``known`` (node, component) after further links between any nodes."""
    if links.isEmpty():
        return known
    root = known.select(F.col("node").alias("member"), F.col("component").alias("root"))
    for side in ("a", "b"):
        links = links.join(root, F.col(side) == F.col("member"), "left").withColumn(side, F.coalesce("root", side)).drop("member", "root")
    above = cut(connected_components(links))
    moved = known.join(above.toDF("component", "top"), "component", "left").select("node", F.coalesce("top", "component").alias("component"))
    return moved.union(above.join(known.select("node"), "node", "left_anti"))
