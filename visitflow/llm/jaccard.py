"""Operator 9: exact n-gram Jaccard join with set-relation skipping.

Documents with the same shingle set are one class.  Classes that are similar enough share one of
their rarest shingles, so each class goes into the inverted lists of its prefix.  Lists are sorted
by set size: sizes and positions that cannot reach the similarity are skipped in blocks.  Each set
carries a parity sketch (shingles hashed to 256 bits, each flipping its bit): two sketches differ
in at most as many bits as the sets differ in shingles, so a greater difference rules a pair out.

Sets that are highly similar share their answers: within a task, a set linked to another is not
compared again with what that one is connected to.  A first round gives such a spanning forest of
the candidates, which is verified on the whole sets; a second round gives every candidate pair that
the verified links leave unconnected.  Every pair is thus verified, ruled out, or connected already.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import LOWER, NOT_SPACE, cut, flat, mix, shingles, steps, word_hashes, word_spans, written
from .linking import Members, among, candidate_pairs, connected_components, in_lists, members, picked, with_links
from .packed import bucket_of, dealt_steps, gathered, of_steps

#: Counters of the rarity table; any order of shingles is right, a good one makes short lists.
COUNTER_BITS = 22
COUNTER_PARTS = 256
#: Shingles below this, a fourth of all, come first where no other set has them: counters alone cannot tell, the more
#: sets there are, and what two sets have by chance would make posts that grow with the square of their number.
TRIED = np.uint64(1 << 62)
#: Bits of a parity sketch; above about four times as many shingles it rules nothing out any more.
SKETCH_BITS = 256


def sets_of(text: pa.Array, width: int):
    """The sorted distinct shingles of each text."""
    data, offsets = flat(text)
    data = LOWER[data]
    starts, ends, ranges = word_spans(data, offsets, NOT_SPACE)
    hashes = word_hashes(data, starts, ends)
    return [np.unique(shingles(hashes[a:b], width)) for a, b in zip(ranges[:-1], ranges[1:])]


def signature(s: np.ndarray) -> tuple[int, int]:
    """128 bits of a set, independent of order."""
    with np.errstate(over="ignore"):
        return int(mix(s).sum(dtype=np.uint64).view(np.int64)), int(mix(s ^ np.uint64(0xA5A5A5A55A5A5A5A)).sum(dtype=np.uint64).view(np.int64))


def briefly(s: np.ndarray, buckets: int) -> np.ndarray:
    """A shingle's bucket and 24 of its bits, with 8 bits of room."""
    return bucket_of(s, buckets) << 32 | (s & np.uint64(0xFFFFFF)).astype(np.int64) << 8


def rarity(docs: DataFrame, width: int, buckets: int) -> tuple[np.ndarray, Members]:
    """How often shingles occur, in 2**COUNTER_BITS shared counters: a table of fixed size; and which of the
    TRIED shingles (see ``briefly``) two sets or more have, and a few others: of bounded size."""
    size = 1 << COUNTER_BITS
    names = ["bucket", "packed", "counts"]

    def count(batches):
        counts = np.zeros(size, np.uint32)

        def tried():
            for batch in steps(batches):
                found = sets_of(batch.column(1), width)
                every = np.concatenate([*found, np.zeros(0, np.uint64)])
                np.add.at(counts, every.astype(np.int64) & (size - 1), np.uint32(1))  # where they are: no second table
                # copies are one set: 8 bits of its signature tell them from others
                tag = np.repeat(np.array([signature(s)[0] & 0xFF for s in found], np.int64), [len(s) for s in found])
                some = np.flatnonzero(every < TRIED)
                yield briefly(every[some], buckets) | tag[some]

        for key in gathered(tried()):
            for batch in dealt_steps(np.unique(key)):
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.nulls(batch.num_rows, pa.binary())], names)
        parts = np.minimum(counts, 255).astype(np.uint8).reshape(COUNTER_PARTS, -1)
        yield pa.RecordBatch.from_arrays([pa.array(range(COUNTER_PARTS), pa.int32()), pa.nulls(COUNTER_PARTS, pa.binary()),
                                          pa.array([p.tobytes() for p in parts], pa.binary())], names)

    def add(batches):
        total: dict[int, np.ndarray] = {}
        held: dict[int, list[bytes]] = {}
        for batch in batches:
            for bucket, packed, counts in zip(*(c.to_pylist() for c in batch.columns)):
                if packed is None:
                    total[bucket] = total.get(bucket, 0) + np.frombuffer(counts, np.uint8).astype(np.uint32)
                else:
                    held.setdefault(bucket, []).append(packed)
        n = len(total)
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([t.tobytes() for t in total.values()], pa.binary()), pa.nulls(n, pa.int64())], ["part", "counts", "key"])
        for bucket, packed in held.items():
            key = np.unique(of_steps(packed)) >> 8
            key = np.unique(key[1:][key[1:] == key[:-1]]).astype(np.int64)
            n = len(key)
            yield pa.RecordBatch.from_arrays([pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary()), pa.array(bucket << 32 | key << 8)], ["part", "counts", "key"])

    dealt = docs.mapInArrow(count, "bucket int, packed binary, counts binary").repartition("bucket")
    found = cut(dealt.mapInArrow(add, "part int, counts binary, key long"))
    out = np.zeros((COUNTER_PARTS, size // COUNTER_PARTS), np.uint32)
    for row in found.where("part is not null").select("part", "counts").collect():
        out[row["part"]] = np.frombuffer(row["counts"], np.uint32)
    return out.ravel(), members(found.where("key is not null").select("key"))


def rarest_first(s: np.ndarray, counts: np.ndarray, shared: np.ndarray) -> np.ndarray:
    """The order of a sorted set's shingles, the same in all sets: those TRIED that are not ``shared``, then by their counters."""
    rank = counts[s.astype(np.int64) & (len(counts) - 1)].astype(np.int64) + 1
    some = int(np.searchsorted(s, TRIED))
    rank[:some][~shared] = 0
    return np.argsort(rank, kind="stable")


def described(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """doc_id, n (set size), s1, s2 (signature), prefix (its rarest shingles), sketch."""
    buckets = max(COUNTER_PARTS, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    shared = docs.sparkSession.sparkContext.broadcast(rarity(docs, width, buckets))  # 32 MB at most, at any input size

    def describe(batches):
        counts, known = shared.value
        for batch in steps(batches):
            n, s1, s2, prefix, sketch = [], [], [], [], []
            sets = sets_of(batch.column(1), width)
            tried = [s[: np.searchsorted(s, TRIED)] for s in sets]
            met = known(briefly(np.concatenate([*tried, np.zeros(0, np.uint64)]), buckets))
            ends = np.cumsum([len(s) for s in tried])
            for s, own in zip(sets, np.split(met, ends[:-1])):
                take = len(s) - -(-percent * len(s) // 100) + 1 if len(s) else 0
                order = rarest_first(s, counts, own)[:take]
                a, b = signature(s)
                n.append(len(s))
                s1.append(a)
                s2.append(b)
                prefix.append(s[order].view(np.int64))
                parity = np.bincount((s >> np.uint64(65 - SKETCH_BITS.bit_length())).astype(np.int64), minlength=SKETCH_BITS) & 1
                sketch.append(np.packbits(parity.astype(np.uint8)).tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(s1, pa.int64()), pa.array(s2, pa.int64()),
                 pa.array(prefix, pa.list_(pa.int64())), pa.array(sketch, pa.binary())],
                ["doc_id", "n", "s1", "s2", "prefix", "sketch"])

    return docs.mapInArrow(describe, "doc_id long, n long, s1 long, s2 long, prefix array<long>, sketch binary")


def in_shared_lists(classes: DataFrame) -> DataFrame:
    """The blocks (see ``linking.dealt_blocks``) of the posts (key, pos and all columns but ``prefix``) of ``classes``: one for each shingle
    of a prefix that another class's prefix has, and a few others, which are alone in their lists."""
    lists = cut(classes.select(F.explode("prefix").alias("key")).groupBy("key").agg(F.count(F.lit(1)).alias("n_rows")).where("n_rows > 1"))
    known = classes.sparkSession.sparkContext.broadcast(members(lists.select("key")))  # of bounded size

    names = [c for c in classes.columns if c != "prefix"]

    def posts(batches):
        for batch in batches:
            prefix = batch.column(len(names))
            key, sizes = prefix.flatten().to_numpy(), prefix.value_lengths().to_numpy()
            row = np.repeat(np.arange(len(sizes)), sizes)
            pos = np.arange(len(key)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            kept = np.flatnonzero(known.value(key))
            rows = pa.array(row[kept])
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(k).take(rows) for k in range(len(names))), pa.array(pos[kept]), pa.array(key[kept])], [*names, "pos", "key"])

    schema = T.StructType([*classes.select(*names).schema.fields, T.StructField("pos", T.LongType()), T.StructField("key", T.LongType())])
    rows = classes.select(*names, "prefix").mapInArrow(posts, schema)
    return in_lists(rows, lists)


def verified(docs: DataFrame, classes: DataFrame, pairs: DataFrame, width: int, percent: int) -> DataFrame:
    """``pairs`` with ``linked``, judged on the whole sets; hardly any text that is in no pair is shuffled.

    Texts travel, which pack better than their sets: once by their set's signature, and once more for each pair."""
    nodes = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    needed = cut(classes.select("node", F.col("rep").alias("doc_id"), "s1", "s2").join(nodes, "node"))
    wanted = docs.sparkSession.sparkContext.broadcast(members(needed.select("doc_id")))  # of bounded size

    def sign(batches):
        for batch in steps(picked(b, 0, wanted.value) for b in batches):  # in one function: two of them would be two workers a core
            signed = np.array([signature(s) for s in sets_of(batch.column(1), width)], np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([pa.array(signed[:, 0]), pa.array(signed[:, 1]), batch.column(1)], ["s1", "s2", "text"])

    texts = docs.mapInArrow(sign, "s1 long, s2 long, text string").dropDuplicates(["s1", "s2"])

    def judge(batches):
        for batch in steps(batches, 2):
            linked = []
            for x, y in zip(sets_of(batch.column(2), width), sets_of(batch.column(3), width)):
                common = len(np.intersect1d(x, y, assume_unique=True))
                linked.append(100 * common >= percent * (len(x) + len(y) - common))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(linked, pa.bool_())], ["a", "b", "linked"])

    for side in ("a", "b"):
        pairs = pairs.join(needed.select(F.col("node").alias(side), F.col("s1").alias(f"{side}1"), F.col("s2").alias(f"{side}2")), side)
    pairs = cut(pairs)
    for side, text in (("a", "x"), ("b", "y")):
        pairs = pairs.join(texts.select(F.col("s1").alias(f"{side}1"), F.col("s2").alias(f"{side}2"), F.col("text").alias(text)), [f"{side}1", f"{side}2"])
    return pairs.select("a", "b", "x", "y").mapInArrow(judge, "a long, b long, linked boolean")


def near_sizes(percent: int):
    """The filter of candidate_pairs(): sizes, positions and sketches that still allow a link."""

    def near(own, a, b):
        n, pos, sketch = own["n"], own["pos"], own["sketch"]
        common = -(-percent * (n[a] + n[b]) // (100 + percent))  # shingles that a link needs in common
        fits = (100 * n[a] >= percent * n[b]) & (np.minimum(n[a] - pos[a], n[b] - pos[b]) >= common)
        at = np.flatnonzero(fits)
        if len(at):
            apart = np.bitwise_count(sketch[a[at]] ^ sketch[b[at]]).sum(axis=1, dtype=np.int64)
            fits[at] = apart <= n[a[at]] + n[b[at]] - 2 * common[at]
        return fits

    return near


def jaccard_classes(docs: DataFrame, width: int = 3, percent: int = 90) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(documents, classes, components): documents with n, s1, s2; one class (node, rep, n, s1, s2)
    for each distinct set, rep its smallest doc_id; the component of every node that is linked, directly
    or over others, to another whose similarity reaches percent / 100."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = cut(described(docs, width, percent))
    classes = cut(
        found.where("n > 0").groupBy("s1", "s2", "n")
        .agg(F.min("doc_id").alias("rep"), F.first("prefix").alias("prefix"), F.first("sketch").alias("sketch"))
        .withColumn("node", F.monotonically_increasing_id()))
    rows = written(in_shared_lists(classes.select("node", "n", "sketch", "prefix")))

    keys, columns, order = ["key", "first", "second"], ["n", "pos", "sketch"], ["n", "node"]
    first = cut(candidate_pairs(rows.withColumn("group", F.col("node")), keys, columns, order, near_sizes(percent), forest=True))
    judged = cut(verified(docs, classes, first, width, percent))
    known = cut(connected_components(judged.where("linked").select("a", "b")))
    if not judged.where("not linked").isEmpty():  # else everything left out is connected
# a pair was left out only if both its sides are in pairs that were given
        paired = cut(first.select(F.col("a").alias("node")).union(first.select("b")).distinct())
        rows = among(rows, "node", paired).join(known, "node", "left").withColumn("group", F.coalesce("component", "node"))
        second = cut(candidate_pairs(rows, keys, columns, order, near_sizes(percent), forest=False).join(judged.select("a", "b"), ["a", "b"], "left_anti"))
        if not second.isEmpty():
            known = cut(with_links(known, cut(verified(docs, classes, second, width, percent).where("linked").select("a", "b"))))
    return found.select("doc_id", "n", "s1", "s2"), classes.select("node", "rep", "n", "s1", "s2"), known


def jaccard_components(docs: DataFrame, width: int = 3, percent: int = 90) -> DataFrame:
    """Per document: doc_id, n_shingles, component_id (the smallest doc_id that links reach).

    Null and empty texts have no shingles and are components of their own; repeated rows are one
    class; a row with a null doc_id has the component of its class, null if that has no doc_id; an
    empty table gives no row; other columns are not read."""
    found, classes, known = jaccard_classes(docs, width, percent)
    linked = cut(known.join(classes.select("node", "rep"), "node"))
    smallest = linked.groupBy("component").agg(F.min("rep").alias("component_id"))
    of_node = linked.join(smallest, "component").select("node", "component_id")
    of_class = classes.join(of_node, "node", "left").select("s1", "s2", "n", F.coalesce("component_id", "rep").alias("component_id"))
    return found.join(of_class, ["s1", "s2", "n"], "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


def keep_one(docs: DataFrame, width: int = 3, percent: int = 90) -> DataFrame:
    """The rows of ``docs``, with all their columns, whose doc_id is its component's smallest; rows
    of components without any doc_id stay."""
    judged = jaccard_components(docs, width, percent)
    kept = judged.where(F.col("component_id").isNull() | (F.col("doc_id") == F.col("component_id"))).select(F.col("doc_id").alias("__kept")).distinct()
    return docs.join(kept, F.col("doc_id").cast("long").eqNullSafe(F.col("__kept")), "left_semi")
