"""Human review: cell-level edits, decision logs, feedback, reconciliation of counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citeloom.functions.numeric import ratio
from citeloom.functions.text import split_list


def changed_cells(sheet: DataFrame, baseline: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """(key, column, value): cells of a sheet that differ from its baseline; null equals ''."""
    b = baseline.select(key, *[F.col(c).alias("b_" + c) for c in columns])
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.coalesce(F.col(c).cast("string"), F.lit("")).alias("value"), F.coalesce(F.col("b_" + c).cast("string"), F.lit("")).alias("old")) for c in columns])
    return sheet.join(b, key).select(key, F.explode(cells).alias("x")).where("x.value <> x.old").select(key, "x.column", "x.value")


def apply_edits(records: DataFrame, edits: DataFrame, id: str, ids: str, columns: list[str]) -> DataFrame:
    """records with edited cells (ids: ';' list of record ids, column, value) written over; the greatest value wins a conflict."""
    e = edits.select(F.explode(split_list(F.col(ids))).alias(id), "column", "value")
    wide = e.groupBy(id).pivot("column", columns).agg(F.max("value"))
    new = wide.select(id, *[F.col(c).alias("n_" + c) for c in columns])
    out = records.join(new, id, "left")
    for c in columns:
        out = out.withColumn(c, F.coalesce(F.col("n_" + c).cast(records.schema[c].dataType), F.col(c)))
    return out.drop(*["n_" + c for c in columns])


def missing_ids(edits: DataFrame, records: DataFrame, id: str, ids: str) -> DataFrame:
    return edits.select(F.explode(split_list(F.col(ids))).alias(id)).distinct().join(records.select(id), id, "left_anti")


def overrides_of(decisions: DataFrame) -> DataFrame:
    """(target_id, action, name): approve_add gives an add, reject a remove, replace a remove and an add."""
    add = lambda n: F.struct(F.lit("add").alias("action"), n.alias("name"))
    drop = F.struct(F.lit("remove").alias("action"), F.col("name").alias("name"))
    rows = F.when(F.col("action") == "approve_add", F.array(add(F.col("name")))).when(F.col("action") == "reject", F.array(drop)).when(F.col("action") == "replace", F.array(drop, add(F.col("replacement"))))
    return decisions.select("target_id", F.explode(rows).alias("x")).select("target_id", "x.*")


def invalid_decisions(decisions: DataFrame, allowed: list[str], known: DataFrame) -> DataFrame:
    """Decisions with an action that is not allowed, an unknown target, or a replacement missing."""
    k = known.select(F.col("target_id"), F.lit(True).alias("known")).distinct()
    bad = F.when(~F.col("action").isin(allowed), "action").when(F.col("known").isNull(), "target").when((F.col("action") == "replace") & (F.coalesce(F.trim("replacement"), F.lit("")) == ""), "replacement")
    return decisions.join(k, "target_id", "left").withColumn("problem", bad).where("problem is not null").drop("known")


def checked_feedback(rows: DataFrame, kinds: dict[str, list[str]], limits: dict[str, int], trap: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(valid, invalid) feedback: type must belong to its category, target given, mail well-formed; texts are clipped, trapped rows go."""
    rows = rows.where(F.coalesce(F.trim(trap), F.lit("")) == "") if trap else rows
    pair = F.lit(False)
    for category, types in kinds.items():
        pair = pair | ((F.col("category") == category) & F.col("type").isin(types))
    mail = F.coalesce(F.trim("contact_email"), F.lit(""))
    ok = F.coalesce(pair, F.lit(False)) & (F.coalesce(F.trim("target_id"), F.lit("")) != "") & ((mail == "") | mail.rlike("^[^\\s@]+@[^\\s@]+\\.[^\\s@]+$"))
    for c, n in limits.items():
        rows = rows.withColumn(c, F.substring(F.trim(c), 1, n))
    return rows.where(ok), rows.where(~ok)


def reconciled(expected: DataFrame, found: DataFrame, year: str, n_expected: str, n_found: str, exclude: list[int] | None = None, near: float = 0.05) -> DataFrame:
    """Yearly counts side by side with difference, ratio and status, over the years of either side."""
    j = expected.select(year, F.col(n_expected).alias("n_expected")).join(found.select(year, F.col(n_found).alias("n_found")), year, "full_outer")
    j = j.where(~F.col(year).isin(exclude)) if exclude else j
    d = F.col("n_found") - F.col("n_expected")
    status: Column = (
        F.when(F.col("n_expected").isNull(), "not_expected").when(F.col("n_found").isNull(), "not_found").when(d == 0, "exact")
        .when(F.abs(d) <= near * F.col("n_expected"), "near").when(d > 0, "over").otherwise("under")
    )
    return j.select(year, "n_expected", "n_found", d.alias("delta"), ratio(F.col("n_found"), F.col("n_expected")).alias("ratio"), status.alias("status"))


def counters(rows: DataFrame, **conditions: Column) -> DataFrame:
    """(counter, n): how many rows meet each condition."""
    one = rows.agg(F.count("*").alias("rows"), *[F.count_if(c).alias(k) for k, c in conditions.items()])
    pairs = F.array(*[F.struct(F.lit(k).alias("counter"), F.col(k).alias("n")) for k in ["rows", *conditions]])
    return one.select(F.explode(pairs).alias("x")).select("x.*")
