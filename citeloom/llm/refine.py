"""Problem 3: duplicates hidden by formatting differences.

Method: progressive partition refinement. Rows are first classed by cheap invariants (the number of letters and digits
and their histogram, both blind to case, spacing, punctuation and order of parts); only classes with several members
get the costlier key of sorted words, and only that key decides.
"""

from __future__ import annotations

import sys

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citeloom.llm import _util
from citeloom.llm.textforms import with_same_form


def letters(col: Column) -> Column:
    """Letters and digits only, in lower case."""
    return F.lower(F.regexp_replace(col, "[^\\p{L}\\p{N}]+", ""))


def word_bag(col: Column) -> Column:
    """The words in lower case and sorted, joined by spaces; null if there is none."""
    words = F.array_remove(F.split(F.lower(col), "[^\\p{L}\\p{N}]+"), "")
    return F.when(F.size(words) > 0, F.array_join(F.array_sort(words), " "))


def doi_key(col: Column) -> Column:
    """A DOI without resolver, label, case, spaces and marks; null for a missing one."""
    bare = F.regexp_replace(F.lower(F.regexp_replace(col, "\\s+", "")), "^.*?(?=10\\.\\d{4,}/)|^(https?://[^/]+/|doi:?)", "")
    return F.nullif(F.regexp_replace(bare, "[^\\p{L}\\p{N}]+", ""), F.lit(""))


def histogram(col: Column) -> Column:
    """An order-blind invariant of a string: its characters, sorted."""
    return F.array_join(F.array_sort(F.split(col, "")), "")


def several(df: DataFrame, key: str) -> DataFrame:
    """The rows of df whose key is held by two rows or more; keys are counted map-side before any row moves."""
    n = df.groupBy(key).agg(F.count("*").alias("__n")).where("__n > 1").select(key)
    return df.join(n, key, "left_semi")


def _first(df: DataFrame, id: str, text: str, extra: Column | None, within: str | None) -> DataFrame:
    """(w, id, x, f, k1): the first refinement, for every row: number of letters and digits, their histogram, the extra key."""
    base = df.select((F.col(within) if within else F.lit("")).alias("w"), F.col(id).alias("id"), F.col(text).alias("t"), (extra if extra is not None else F.lit(None).cast("string")).alias("x"))
    base = with_same_form(base.where("t <> '' and id is not null"), "t", "f").withColumn("l", letters(F.col("f"))).where("l <> ''")
    return _util.cut(base.select("w", "id", "x", "f", F.xxhash64("w", "x", F.char_length("l"), histogram(F.col("l"))).alias("k1")))


def _second(first: DataFrame) -> DataFrame:
    """(w, id, class_key): the second refinement, only inside classes with several members: the sorted words."""
    return several(first, "k1").select("w", "id", _util.key128("w", "x", word_bag(F.col("f"))).alias("class_key")).distinct()


def classes(df: DataFrame, id: str, text: str, extra: Column | None = None, within: str | None = None) -> DataFrame:
    """(within, id, class_key) of the rows whose text, up to formatting, is held by several rows.

    extra: a further key column that must be equal too (null equals null). Rows with null, empty or wordless text are
    left out. Repeated rows (same id) count once.
    """
    second = _second(_first(df, id, text, extra, within))
    return several(_util.cut(second), "class_key").withColumnRenamed("w", within or "w")


def copies(df: DataFrame, id: str, text: str, extra: Column | None = None, within: str | None = None) -> DataFrame:
    """One row per class with copies: (within, record_id = smallest id, n_copies, copies are counted, not listed)."""
    return counted(df, id, text, extra, within).where("n_copies > 1")


def counted(df: DataFrame, id: str, text: str, extra: Column | None = None, within: str | None = None) -> DataFrame:
    """One row per class, also of a single member: (within, record_id = smallest id, n_copies).

    Rows alone in their class of the first refinement are settled there.
    """
    first = _first(df, id, text, extra, within)
    alone = first.groupBy("k1").agg(F.first("w").alias("w"), F.min("id").alias("record_id"), F.count("*").alias("n_copies")).where("n_copies = 1")
    more = _second(first).groupBy("w", "class_key").agg(F.min("id").alias("record_id"), F.count("*").alias("n_copies"))
    out = alone.select("w", "record_id", "n_copies").unionByName(more.select("w", "record_id", "n_copies"))
    return out.withColumnRenamed("w", within or "w")


def copy_pairs(df: DataFrame, id: str, text: str, extra: Column | None = None, within: str | None = None) -> DataFrame:
    """(within, record_id, copy_record_id): each member of a class but the smallest, beside the smallest.

    The smallest ids are found map-side first; the join that brings them back has one row per class on one side, so a
    class that holds a third of all rows is split by adaptive execution instead of meeting in one task.
    """
    c = classes(df, id, text, extra, within)
    least = c.groupBy("class_key").agg(F.min("id").alias("record_id"))
    return c.join(least, "class_key").where("id <> record_id").select(within or F.col("w"), "record_id", F.col("id").alias("copy_record_id")).distinct()


_util.by_value(sys.modules[__name__])
