"""Exact top-k of sums over many keys in three rounds: keys that cannot enter are not shuffled.

Each input partition adds up its own keys and ranks them, where it is read (``partial_sums``).

1. The k largest of each part give k keys or more with lower bounds of their sums; the k-th best bound is t1.
2. A key with a sum of t1 has t1 / parts in some part, so only partial sums from there on are looked at: they
   give every key that can still enter a lower bound and, with what the silent parts may hide, an upper
   bound.  The k-th best lower bound is t2; keys whose upper bound is below it are out.
3. The partial sums of the few that are left are added up.

Ties with the k-th are all kept until the order is decided.  Sums are right whatever the skew; it only decides how
many keys are left after round 2."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

PART, RANK = "part", "part_rank"
#: Distinct keys that a task adds up before it merges them with those it has.
MERGE_ROWS = 1 << 20
#: Keys after round 2 that are broadcast; more are joined by shuffle.
FEW_KEYS = 100_000


def partial_sums(rows: DataFrame, keys: Sequence[str], sums: Sequence[str]) -> DataFrame:
    """(part, keys, sums, part_rank): the sums of non-negative long columns inside each input partition, ranked by the
    first of them.  No shuffle; write the result before it is read three times."""
    keys, sums = list(keys), list(sums)

    def merged(tables: list[pa.Table]) -> pa.Table:
        table = pa.concat_tables(tables)
        added = table.group_by(keys).aggregate([(c, "sum") for c in sums])
        return added.rename_columns([c[: -len("_sum")] if c.endswith("_sum") and c[: -len("_sum")] in sums else c for c in added.column_names]).select(keys + sums)

    def add(batches):
        known, fresh, n = [], [], 0
        for batch in batches:
            if batch.num_rows:
                fresh.append(merged([pa.Table.from_batches([batch])]))
                n += fresh[-1].num_rows
            if n >= MERGE_ROWS:
                known, fresh, n = [merged([*known, *fresh])], [], 0
        if not known and not fresh:
            return
        table = merged([*known, *fresh])
        table = table.take(pc.sort_indices(table, sort_keys=[(sums[0], "descending"), *((k, "ascending") for k in keys)]))
        table = table.append_column(RANK, pa.array(np.arange(1, table.num_rows + 1, dtype=np.int64)))
        table = table.add_column(0, PART, pa.array(np.full(table.num_rows, TaskContext.get().partitionId(), np.int32)))
        yield from table.combine_chunks().to_batches(max_chunksize=10_000)

    chosen = rows.select(*keys, *(F.col(c).cast("long").alias(c) for c in sums))
    schema = T.StructType([T.StructField(PART, T.IntegerType()), *chosen.schema.fields, T.StructField(RANK, T.LongType())])
    return chosen.mapInArrow(add, schema)


def threshold_candidates(partials: DataFrame, keys: Sequence[str], by: str, k: int, counts=None) -> DataFrame:
    """The partial sums of the keys whose sum of ``by`` may be among the ``k`` largest, those that tie with the k-th too.
    ``counts`` (a ``plans.counts.TableCounts``) gets the rows that each round reads."""
    keys = list(keys)

    def watched(name: str, df: DataFrame) -> DataFrame:
        return df if counts is None else counts.watch(name, df)

    def kth(lower: DataFrame) -> int:
        best = lower.orderBy(F.col("lower").desc()).limit(int(k)).select("lower").collect()  # k numbers
        return int(best[-1][0]) if len(best) == int(k) else 0

    parts = partials.where(F.col(RANK) == 1).count()  # one row a part
    t1 = kth(watched("round 1", partials.where(F.col(RANK) <= int(k))).groupBy(*keys).agg(F.sum(by).alias("lower")))
    least = max(1, -(-t1 // max(1, parts)))  # a sum of t1 needs so much in one part
    loud = partials.where(F.col(by) >= least)
    bounds = watched("round 2", loud).groupBy(*keys).agg(F.sum(by).alias("lower"), F.count(F.lit(1)).alias("heard")).checkpoint(eager=True)
    t2 = max(t1, kth(bounds))
    may_enter = bounds.where(F.col("lower") + (F.lit(parts) - F.col("heard")) * (least - 1) >= t2).select(*keys)
    if may_enter.count() <= FEW_KEYS:
        may_enter = F.broadcast(may_enter)
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in keys]
    left = partials.join(may_enter.toDF(*(f"_{c}" for c in keys)), same, "left_semi")
    return watched("round 3", left)


def threshold_top_k(partials: DataFrame, keys: Sequence[str], by: str, k: int, counts=None) -> DataFrame:
    """The ``k`` keys with the largest sums of ``by``, ties to the smaller key: (keys, by)."""
    found = threshold_candidates(partials, keys, by, k, counts).groupBy(*keys).agg(F.sum(by).alias(by))
    return found.orderBy(F.col(by).desc(), *keys).limit(int(k))


def threshold_top_categories(visits: DataFrame, n: int = 10, task_id: int = 1, pay_requires_action: bool = False) -> DataFrame:
    """``top_categories(category_counts(visits))`` where categories are many: only those whose clicks can be among the
    most are counted in full.  A category also needs an order and a payment; as long as fewer than ``n`` of the
    candidates have both, twice as many are asked for.  The partial sums are checkpointed."""
    kinds = ("click", "order", "pay")
    action = F.col("action")
    paid = F.col("pay_category_id") != 0
    tests = {"click": action == "click", "order": action == "order", "pay": paid & (action == "pay") if pay_requires_action else paid}
    pairs = F.array(*(F.struct(F.when(tests[kind], F.col(f"{kind}_category_id")).alias("category_id"),
                               *(F.lit(int(other == kind)).alias(f"{other}_count") for other in kinds)) for kind in kinds))
    rows = visits.select(F.inline(pairs)).where(F.col("category_id").isNotNull())
    sums = [f"{kind}_count" for kind in kinds]
    partials = partial_sums(rows, ["category_id"], sums).checkpoint(eager=True)
    asked = int(n)
    while True:
        found = threshold_candidates(partials, ["category_id"], sums[0], asked).groupBy("category_id").agg(
            *(F.sum(c).alias(c) for c in sums)).checkpoint(eager=True)
        whole = found.where(" and ".join(f"{c} > 0" for c in sums))
        if whole.count() >= n or found.count() < asked:  # fewer than asked for: these are all
            break
        asked *= 2
    return whole.orderBy(*(F.col(c).desc() for c in sums), F.col("category_id")).limit(n).select(
        F.lit(task_id).alias("task_id"), "category_id", *sums)
