"""Catalog tables bucketed and sorted by user: joins and counts per user without a shuffle.

Every user's rows lie in one bucket, so a user with a large share of the rows would make one huge bucket.  Users
with more than a bucket's even share are therefore kept apart, spread evenly, in ``<table>_hot``; there are fewer of
them than buckets, whatever the data, so what belongs to them may be broadcast."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from visitflow.functions.predicates import all_not_null

USER = "user_id"


def hot_users(df: DataFrame, buckets: int, key: str = USER) -> DataFrame:
    """(key) of those with more than one in ``buckets`` of all rows: fewer than ``buckets``."""
    counted = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    total = counted.agg(F.sum("n").alias("total"))  # one row
    return counted.join(F.broadcast(total), F.col("n") * buckets > F.col("total")).select(key)


def save_by_user(df: DataFrame, table: str, buckets: int, key: str = USER, split_hot: bool = True) -> None:
    """Replace ``table`` by the rows of ``df``, bucketed and sorted by ``key``, one file a bucket, and
    ``<table>_hot`` by those of the hot users, in as many files.  Rows without a key are left out: they join nothing."""
    spark = df.sparkSession
    known = df.where(F.col(key).isNotNull())
    if split_hot:
        hot = hot_users(known, buckets, key).collect()  # fewer than buckets
        is_hot = F.col(key).isin([r[0] for r in hot]) if hot else F.lit(False)
    else:
        is_hot = F.lit(False)
    known.where(~is_hot).repartition(buckets, key).write.mode("overwrite").bucketBy(buckets, key).sortBy(key).format("parquet").saveAsTable(table)
    apart = known.where(is_hot) if split_hot else known.limit(0)
    apart.repartition(buckets).write.mode("overwrite").format("parquet").saveAsTable(f"{table}_hot")
    spark.catalog.refreshTable(table)


def hot_part(spark: SparkSession, table: str) -> DataFrame:
    return spark.table(f"{table}_hot")


def _of_hot(spark: SparkSession, other: str, hot: DataFrame, key: str) -> DataFrame:
    """The keys of the table ``other`` that are hot in another table: fewer than its buckets, so they may be broadcast."""
    wanted = F.broadcast(hot.select(key).distinct())
    keys = spark.table(other).select(key).unionByName(hot_part(spark, other).select(key))
    return keys.join(wanted, key, "left_semi").distinct()


def _joined(spark: SparkSession, table: str, other: str, key: str, how: str) -> DataFrame:
    rows, hot = spark.table(table), hot_part(spark, table)
    plain = rows.join(spark.table(other).select(F.col(key).alias("_key")), F.col(key) == F.col("_key"), how)
    # keys that are hot in the other table alone are in its second part, and there are few of them
    rest = F.broadcast(hot_part(spark, other).select(F.col(key).alias("_key")).distinct())
    if how == "left_semi":
        plain = plain.unionByName(rows.join(rest, F.col(key) == F.col("_key"), how))
    else:
        plain = plain.join(rest, F.col(key) == F.col("_key"), how)
    few = F.broadcast(_of_hot(spark, other, hot, key).select(F.col(key).alias("_key")))
    return plain.unionByName(hot.join(few, F.col(key) == F.col("_key"), how))


def rows_of_users(spark: SparkSession, table: str, users: str, key: str = USER) -> DataFrame:
    """Rows of ``table`` whose user is in ``users``, once each (a semi join of two tables with the same number of
    buckets; no row of either is shuffled)."""
    return _joined(spark, table, users, key, "left_semi")


def rows_of_others(spark: SparkSession, table: str, listed: str, key: str = USER) -> DataFrame:
    """Rows of ``table`` whose user is not in ``listed`` (an anti join, as ``rows_of_users``)."""
    return _joined(spark, table, listed, key, "left_anti")


def counts_by_user(spark: SparkSession, table: str, keys: list[str], where: Column | None = None) -> DataFrame:
    """``keys`` (the bucket key among them) and ``click_count``: buckets count alone, hot users with partial counts."""
    def counted(df: DataFrame) -> DataFrame:
        df = df if where is None else df.where(where)
        return df.where(all_not_null(*keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias("click_count"))

    return counted(spark.table(table)).unionByName(counted(hot_part(spark, table)))
