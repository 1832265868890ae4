"""Choosing, merging and maintaining rows by key: deduplication, upserts, snapshots, change logs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_per_key(df: DataFrame, keys: list[str | Column], order: list[Column], k: int = 1, rank: str | None = None) -> DataFrame:
    """The first k rows of each key in the given order; the planner limits each partition before the shuffle."""
    w = Window.partitionBy(*keys).orderBy(*order)
    ranked = df.withColumn(rank or "__r", F.row_number().over(w)).where(F.col(rank or "__r") <= k)
    return ranked if rank else ranked.drop("__r")


def latest(df: DataFrame, keys: list[str], by: list[str]) -> DataFrame:
    """Last-writer-wins: the row with the greatest `by` of each key."""
    return top_per_key(df, keys, [F.desc(c) for c in by])


def longest(df: DataFrame, keys: list[str | Column], text: str, tie: str) -> DataFrame:
    """The row with the longest text of each key (null counts as empty), ties to the smallest `tie`."""
    return top_per_key(df, keys, [F.desc(F.coalesce(F.char_length(text), F.lit(0))), F.asc(tie)])


def merge_append(existing: DataFrame, fresh: DataFrame, key: str) -> DataFrame:
    """All existing rows and the fresh ones with unseen keys, each key once."""
    new = fresh.dropDuplicates([key]).join(existing.select(key).distinct(), key, "left_anti")
    return existing.unionByName(new, allowMissingColumns=True)


def merge_rebuild(existing: DataFrame, fresh: DataFrame, key: str) -> DataFrame:
    """The fresh rows alone, each key once."""
    return fresh.dropDuplicates([key])


def replace_where(existing: DataFrame, stale: Column, fresh: DataFrame) -> DataFrame:
    """Rows for which `stale` holds give way to the fresh ones."""
    return existing.where(~F.coalesce(stale, F.lit(False))).unionByName(fresh, allowMissingColumns=True)


def upsert(current: DataFrame, changes: DataFrame, keys: list[str], order: list[str], eligible: DataFrame | None = None) -> DataFrame:
    """One row per key, the newest by `order`; keys that are no longer eligible go, keys without a change keep their row."""
    both = latest(current.unionByName(changes), keys, order)
    return both if eligible is None else both.join(eligible.select(*keys).distinct(), keys, "left_semi")


def append_snapshots(log: DataFrame, observed: DataFrame, keys: list[str]) -> DataFrame:
    """The log and the observed rows, idempotent on the keys."""
    return log.unionByName(observed).dropDuplicates(keys)


def fold_log(log: DataFrame, keys: list[str], order: list[str], removes: Column) -> DataFrame:
    """The state after a change log: the last entry of each key, unless it removes."""
    return latest(log, keys, order).where(~F.coalesce(removes, F.lit(False)))


def apply_overrides(base: DataFrame, log: DataFrame, keys: list[str], order: list[str], action: str = "action") -> DataFrame:
    """Base pairs less those whose last override is 'remove', plus those whose last is 'add'."""
    last = latest(log, keys, order)
    kept = base.join(last.where(F.col(action).isin("remove", "add")).select(*keys), keys, "left_anti")
    return kept.unionByName(last.where(F.col(action) == "add").select(*keys), allowMissingColumns=True)


def pending(rows: DataFrame, done: DataFrame, key: str, retry: Column) -> DataFrame:
    """Rows whose key is not done yet, or done with a result to be tried again."""
    return rows.join(done.where(~F.coalesce(retry, F.lit(False))).select(key).distinct(), key, "left_anti")


def unseen(rows: DataFrame, seen: DataFrame, key: str) -> DataFrame:
    return rows.join(seen.select(key).distinct(), key, "left_anti")


def with_runner_up(df: DataFrame, keys: list[str], score: str, tie: str) -> DataFrame:
    """The best row of each key with the runner-up's score (0 if alone)."""
    w = Window.partitionBy(*keys).orderBy(F.desc(score), F.asc_nulls_last(tie))
    both = df.withColumn("__r", F.row_number().over(w)).withColumn("runner_up", F.coalesce(F.lead(score).over(w), F.lit(0.0)))
    return both.where("__r = 1").drop("__r")


def carry_forward(df: DataFrame, group: list[str], order: list[str], value: Column, out: str, chunk: int | None = None) -> DataFrame:
    """The last non-null value seen so far in the group's order.

    chunk: with one whole-number order column, the order is cut into stretches of so many numbers. Each is filled by
    itself, and its last value is carried into the next ones by a window over one row per stretch, so a group that holds
    most rows is spread over tasks.
    """
    if chunk is None:
        w = Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
        return df.withColumn(out, F.last(value, ignorenulls=True).over(w))
    at = F.floor(F.col(order[0]) / chunk)
    cut = df.withColumn("__v", value).withColumn("__at", at)
    inner = Window.partitionBy(*group, "__at").orderBy(order[0]).rowsBetween(Window.unboundedPreceding, 0)
    # a stretch without a value takes what the stretches before it left
    stretches = cut.groupBy(*group, "__at").agg(F.max_by("__v", F.when(F.col("__v").isNotNull(), F.col(order[0]))).alias("__last"))
    outer = Window.partitionBy(*group).orderBy("__at").rowsBetween(Window.unboundedPreceding, -1)
    before = stretches.withColumn("__before", F.last("__last", ignorenulls=True).over(outer)).select(*group, "__at", "__before")
    keys = [*group, "__at"]
    before = before.toDF(*[f"__k{i}" for i in range(len(keys))], "__before")
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__k{i}")) for i, k in enumerate(keys)])
    filled = cut.withColumn("__in", F.last("__v", ignorenulls=True).over(inner)).join(before, same)
    return filled.withColumn(out, F.coalesce("__in", "__before")).drop("__v", "__at", "__in", "__before", *[f"__k{i}" for i in range(len(keys))])


def grouped_lists(df: DataFrame, keys: list[str | Column], lists: dict[str, str]) -> DataFrame:
    """One row per key with its size and, per column -> name of `lists`, its sorted distinct values joined by ';'."""
    aggs = [F.array_join(F.array_sort(F.collect_set(c)), ";").alias(o) for c, o in lists.items()]
    return df.groupBy(*keys).agg(F.count("*").alias("n_rows"), *aggs)


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
