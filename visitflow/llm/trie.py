"""Conversation prefix trie by fixed-length block hashing.

Conversations are first grouped by the digests of successive blocks of ``BLOCK`` turns.  Where all
conversations that go on behind a block share the next one, its turns are a chain and need no
comparison; only where siblings diverge are the turns inside their blocks grouped one by one, and
then once for each distinct block, not for each conversation.

A prefix is known by its depth and four sums of 32-bit hashes of (position, role, text); texts never
leave their scan.  Sums over subtrees need no walk: conversation ``c`` owns the nodes of which it is
the smallest member, which are the end of its path, so with ``shared`` the words that stand before
them, a node of ``n`` members with ``w`` words before its last turn saves the sum of ``shared`` over
its other members less ``(n - 1) * w``; leaves are counted by their owners.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import cut

#: Turns of a block.
BLOCK = 8
#: Blocks of one conversation that one running sum takes together; longer ones are carried on.
SEGMENT = 1024
#: Words of the token counts.
WORDS = r"[^\x20\x09-\x0D]+"

_LANES = ("l0", "l1", "l2", "l3")
_RUNNING = "conv_id long, part int, first long, copies long, digest string, words long"


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, position, digest, words) of every turn, positions from 0 by ``turn`` (null first).

    ``digest`` stands for (role, text), null being empty; turns of one conversation with the same
    ``turn`` follow their digest; a row that occurs several times is that many turns.  Rows without
    conv_id are left out.  One conversation may hold any share of the rows: identical rows are
    counted first, and positions are running sums over ranges of (conv_id, turn, digest).
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    turns = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text)).alias("digest"),
        F.regexp_count(text, F.lit(WORDS)).cast("long").alias("words"))
    turns = turns.groupBy("conv_id", "turn", "digest", "words").agg(F.count(F.lit(1)).alias("copies"))
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("digest")]
    placed = turns.repartitionByRange(*order).sortWithinPartitions(*order)
    local = cut(placed.select("conv_id", "copies", "digest", "words").mapInArrow(_running, _RUNNING))
    parts = local.groupBy("conv_id", "part").agg(F.sum("copies").alias("copies"))
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("conv_id", "part", F.coalesce(F.sum("copies").over(earlier), F.lit(0)).alias("before"))
    return local.join(parts, ["conv_id", "part"]).select(
        "conv_id", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)).alias("copy"), "before", "first",
        "digest", "words").select("conv_id", (F.col("before") + F.col("first") + F.col("copy")).alias("position"), "digest", "words")


def _running(batches):
    """For each row of a sorted partition the turns of its conversation before it in this partition."""
    part, last, carry = TaskContext.get().partitionId(), None, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        conv, copies = (batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 1))
        before = np.cumsum(copies) - copies
        begin = np.flatnonzero(np.concatenate([[True], conv[1:] != conv[:-1]]))
        base = before[begin]
        if conv[0] == last:
            base[0] -= carry
        first = before - np.repeat(base, np.diff(np.append(begin, len(conv))))
        last, carry = conv[-1], int(first[-1] + copies[-1])
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(np.full(len(conv), part, np.int32)), pa.array(first), *batch.columns[1:]],
            names=["conv_id", "part", "first", "copies", "digest", "words"])


def shared_starts(turns: DataFrame, every: int = 20, most: int = 4) -> tuple[DataFrame, DataFrame]:
    """Conversations that begin like their neighbours: the first h turns of conversation ``c`` become
    those of ``c - c % every`` (all if it has fewer, none if it is absent), h = crc32(c) % most.
    Returns the new turns and (conv_id) of every conversation, turnless ones too."""
    convs = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n")).select(
        "conv_id", "n", (F.crc32(F.col("conv_id").cast("string").cast("binary")) % most).alias("h"),
        (F.col("conv_id") - F.col("conv_id") % every).alias("model"))
    models = convs.select(F.col("conv_id").alias("model"), F.col("n").alias("n_model"))
    convs = convs.join(models, "model", "left").select(
        "conv_id", "model", "h", F.least("h", F.coalesce("n_model", F.lit(0))).alias("kept"))
    own = turns.join(convs.drop("model"), "conv_id").where("position >= h").select(
        "conv_id", (F.col("position") - F.col("h") + F.col("kept")).alias("position"), "digest", "words")
    heads = turns.where(f"conv_id % {every} = 0 and position < {most}").withColumnRenamed("conv_id", "model")
    heads = heads.join(convs, "model").where("position < h").select("conv_id", "position", "digest", "words")
    return own.unionByName(heads), convs.select("conv_id")


def _node(depth: Column, sums) -> Column:
    return F.md5(F.concat_ws(",", depth.cast("string"), *(s.cast("string") for s in sums)))


def _root() -> Column:
    return _node(F.lit(0), [F.lit(0)] * len(_LANES))


def _paths(turns: DataFrame) -> DataFrame:
    """A row for each block of each conversation: ``up`` and ``end`` are the prefixes that end before and with it."""
    depth = (F.col("position") + 1).alias("depth")
    hashes = [F.xxhash64(F.lit(k), depth, F.col("digest")) for k in (0, 1)]
    lanes = [lane.alias(name) for name, lane in zip(
        _LANES, (x for h in hashes for x in (h.bitwiseAND(0xFFFFFFFF), F.shiftrightunsigned(h, 32))))]
    placed = turns.select("conv_id", F.expr(f"position div {BLOCK}").alias("k"), depth, "words", *lanes)
    one = F.struct("depth", "words", *_LANES)
    sums = ("words", *_LANES)
    blocks = placed.groupBy("conv_id", "k").agg(
        F.sort_array(F.collect_list(one)).alias("turns"), F.count(F.lit(1)).alias("size"),
        *(F.sum(c).alias(c) for c in sums)).withColumn("segment", F.expr(f"k div {SEGMENT}"))

    def before(keys, order):
        window = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        return lambda c: F.coalesce(F.sum(c).over(window), F.lit(0))

    here, far = before(["conv_id", "segment"], "k"), before(["conv_id"], "segment")
    segments = blocks.groupBy("conv_id", "segment").agg(*(F.sum(c).alias(c) for c in sums))
    segments = segments.select("conv_id", "segment", *(far(c).alias(f"far_{c}") for c in sums))
    blocks = blocks.select("*", *(here(c).alias(f"near_{c}") for c in sums)).join(segments, ["conv_id", "segment"])
    start = {c: F.col(f"far_{c}") + F.col(f"near_{c}") for c in sums}
    return blocks.select(
        "conv_id", "k", "words",
        _node(F.col("k") * BLOCK, [start[c] for c in _LANES]).alias("up"),
        _node(F.col("k") * BLOCK + F.col("size"), [start[c] + F.col(c) for c in _LANES]).alias("end"),
        F.struct(*(start[c].alias(c) for c in sums)).alias("start"), "turns")


def _nodes(paths: DataFrame) -> DataFrame:
    """Nodes but the root from block rows with ``shared`` and ``leaf`` of their conversation: grouped by blocks,
    and by turns inside the blocks that have siblings."""
    groups = paths.groupBy("up", "end").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("conv_id", "shared")).alias("low"), F.sum("shared").alias("shared"),
        F.sum("leaf").alias("leaves"), F.min_by(F.struct("start", "turns"), "conv_id").alias("block"))
    siblings = groups.groupBy("up").agg((F.count(F.lit(1)) > 1).alias("diverges"))
    groups = groups.join(siblings, "up")

    def total(name, upto):
        inside = F.aggregate(F.slice("block.turns", 1, upto), F.lit(0).cast("long"), lambda a, t: a + t[name])
        return F.col(f"block.start.{name}") + inside

    def one(turn, i):
        return F.struct(
            turn["depth"].alias("depth"), turn["words"].alias("words"), total("words", i).alias("before"),
            _node(turn["depth"], [total(c, i + 1) for c in _LANES]).alias("node"),
            _node(turn["depth"] - 1, [total(c, i) for c in _LANES]).alias("up"))

    flat = groups.select("diverges", "n", "low", "shared", "leaves", F.explode(F.transform("block.turns", one)).alias("t"))
    flat = flat.select("diverges", "t.*", "n", "low", "shared", "leaves")
    refined = flat.where("diverges").groupBy("node").agg(
        *(F.first(c).alias(c) for c in ("depth", "words", "before", "up")), F.sum("n").alias("n"), F.min("low").alias("low"),
        F.sum("shared").alias("shared"), F.sum("leaves").alias("leaves"))
    return flat.where("not diverges").drop("diverges").unionByName(refined)


def _rooted(nodes: DataFrame, convs: DataFrame) -> DataFrame:
    """``nodes`` and the root, each with its number of children."""
    root = convs.agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("conv_id", "shared")).alias("low"), F.sum("shared").alias("shared"),
        F.sum("leaf").alias("leaves")).where("n > 0").select(
        F.lit(0).cast("long").alias("depth"), F.lit(0).cast("long").alias("words"), F.lit(0).cast("long").alias("before"),
        _root().alias("node"), F.lit(None).cast("string").alias("up"), "n", "low", "shared", "leaves")
    children = nodes.groupBy(F.col("up").alias("node")).agg(F.count(F.lit(1)).alias("n_children"))
    return nodes.unionByName(root).join(children, "node", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))


def _ends(convs: DataFrame) -> DataFrame:
    """(node, ends_sha256): digest of the ids of the conversations that end there.  The ids of one node are joined in
    ranges of 65,536 ids each, and the ranges go through the hash one after the other."""
    ranges = convs.groupBy(F.col("end").alias("node"), F.shiftright("conv_id", 16).alias("range")).agg(
        F.sort_array(F.collect_list("conv_id")).alias("ids"))
    ranges = ranges.select("node", "range", F.array_join(F.col("ids").cast("array<string>"), ",").alias("ids"))
    ranges = ranges.repartition("node").sortWithinPartitions("node", "range")
    return ranges.select("node", "ids").mapInArrow(_digests, "node string, ends_sha256 string")


def _digests(batches):
    last, digest = None, None
    for batch in batches:
        nodes, hashes = [], []
        for node, ids in zip(*(c.to_pylist() for c in batch.columns)):
            if node == last:
                digest.update(b",")
            else:
                if last is not None:
                    nodes.append(last)
                    hashes.append(digest.hexdigest())
                last, digest = node, hashlib.sha256()
            digest.update(ids.encode())
        yield pa.RecordBatch.from_pydict({"node": pa.array(nodes, pa.string()), "ends_sha256": pa.array(hashes, pa.string())})
    if last is not None:
        yield pa.RecordBatch.from_pydict({"node": [last], "ends_sha256": [digest.hexdigest()]})


def prefix_trie(turns: DataFrame, convs: DataFrame | None = None) -> DataFrame:
    """The trie of conversations: a row for each distinct sequence of first turns, from the empty one (depth 0).

    ``turns`` are (conv_id, position, digest, words) as ``ordered_turns`` gives them, ``convs`` the conv_id of
    all conversations (those of ``turns`` if None; others are turnless and end at the root).  Returns

    * conv_id, the smallest member (conversation that begins so), depth, parent_conv_id (null for the root);
    * n_convs members, n_children, n_leaves childless nodes of the subtree, the node included;
    * saved_tokens: (n_convs - 1) * words of the last turn, summed over the subtree;
    * ends_sha256: SHA-256 of the ids of the members that end here, ascending, comma-joined.

    No conversations give no rows, not even a root.  The turn of a node is number ``depth - 1`` of ``conv_id``.
    """
    paths = cut(_paths(turns))
    last = paths.groupBy("conv_id").agg(F.max_by("end", "k").alias("end"), F.sum("words").alias("total"))
    if convs is not None:
        last = convs.select("conv_id").distinct().join(last, "conv_id", "left")
    last = last.select("conv_id", F.coalesce("end", _root()).alias("end"), F.coalesce("total", F.lit(0)).alias("total"))

    nothing = [F.lit(0).cast("long").alias(c) for c in ("shared", "leaf")]
    found = _rooted(_nodes(paths.select("*", *nothing)), last.select("*", *nothing))
    owners = found.groupBy(F.col("low.conv_id").alias("conv_id")).agg(
        F.min_by("before", "depth").alias("shared"), F.max((F.col("n_children") == 0).cast("long")).alias("leaf"))
    # a conversation that owns no node shares all its words
    known = cut(last.join(owners, "conv_id", "left").select(
        "conv_id", "end", F.coalesce("shared", "total").alias("shared"), F.coalesce("leaf", F.lit(0)).alias("leaf")))

    nodes = cut(_rooted(_nodes(paths.join(known.drop("end"), "conv_id")), known))
    parents = nodes.select(F.col("node").alias("up"), F.col("low.conv_id").alias("parent_conv_id"))
    return nodes.join(parents, "up", "left").join(_ends(known), "node", "left").select(
        F.col("low.conv_id").alias("conv_id"), "depth", "parent_conv_id", F.col("n").alias("n_convs"), "n_children",
        F.col("leaves").alias("n_leaves"),
        (F.col("shared") - F.col("low.shared") - (F.col("n") - 1) * F.col("before")).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"))
