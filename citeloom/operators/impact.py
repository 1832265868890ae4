"""Bibliometric measures of works and of people."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from citeloom.functions.numeric import age_years, decay, finite, ratio, window_sum


def h_index(df: DataFrame, by: str, citations: str) -> DataFrame:
    """(by, h_index): the greatest rank r whose r-th largest citation count is r or more, else 0."""
    w = Window.partitionBy(by).orderBy(F.desc(citations))
    ranked = df.select(by, F.col(citations).alias("c"), F.row_number().over(w).alias("r"))
    return ranked.groupBy(by).agg(F.coalesce(F.max(F.when(F.col("c") >= F.col("r"), F.col("r"))), F.lit(0)).cast("long").alias("h_index"))


def summary(pairs: DataFrame, works: DataFrame, by: str, work: str) -> DataFrame:
    """Impact measures per `by` over its distinct works.

    works: one row per work with citations, weight (field-normalised measure) and top (boolean, null where unknown).
    Works without measures count in the coverage only; shares have the measured rows as denominator and are null without.
    """
    p = pairs.select(by, work).distinct()
    j = p.join(works.withColumn("measured", F.lit(True)), work, "left")
    c, x = F.col("citations"), finite(F.col("weight"))
    out = j.groupBy(by).agg(
        F.count("*").alias("n_works"), F.count("measured").alias("n_measured"), F.sum(c).alias("total_citations"),
        F.round(F.avg(c), 4).alias("mean_citations"), F.round(F.median(c), 4).alias("median_citations"),
        F.count_if(c == 0).alias("n_uncited"), ratio(F.count_if(c == 0), F.count(c)).alias("uncited_share"),
        F.round(F.avg(x), 10).alias("mean_weight"), F.round(F.median(x), 10).alias("median_weight"),
        F.count_if(F.col("top")).alias("n_top"), ratio(F.count_if(F.col("top")), F.count("top")).alias("top_share"),
        F.count_if(c >= 10).alias("i10_index"),
    )
    out = out.withColumn("coverage_share", ratio(F.col("n_measured"), F.col("n_works")))
    return out.join(h_index(j.where("measured"), by, "citations"), by, "left").withColumn("h_index", F.coalesce("h_index", F.lit(0)))


def work_measures(works: DataFrame, observed: str = "observed_at") -> DataFrame:
    """Derived measures from publication_date, publication_year, cited_by_count and counts (array of year, n)."""
    y = F.year(observed)
    total = F.coalesce(F.col("cited_by_count"), F.lit(0))
    active = F.filter("counts", lambda c: c["n"] > 0)
    age = age_years(F.col("publication_date"), F.col("publication_year"), F.col(observed))
    return works.withColumns({
        "publication_age_years": F.round(age, 4), "citations_per_year": F.round(total / F.greatest(age, F.lit(1.0)), 4),
        "citations_last_1_year": window_sum(F.col("counts"), y, 1), "citations_last_2_years": window_sum(F.col("counts"), y, 2), "citations_last_5_years": window_sum(F.col("counts"), y, 5),
        "recent_citation_share": F.when(total > 0, F.round(window_sum(F.col("counts"), y, 2) / total, 4)).otherwise(0.0),
        "years_since_earliest_citation": y - F.array_min(F.transform(active, lambda c: c["year"])),
        "citation_active_years": F.size(active), "is_uncited": total == 0,
    })


def recency_weight(df: DataFrame, by: list[str], year: str, half_life: float = 5.0) -> DataFrame:
    """Sum of 0.5 ^ (age / half_life) per group, age counted from the newest year of all rows."""
    newest = df.agg(F.max(year).alias("__max"))
    return df.crossJoin(F.broadcast(newest)).groupBy(*by).agg(F.round(F.sum(decay(F.col("__max") - F.col(year), half_life)), 6).alias("recency_weight"), F.min(year).alias("first_year"), F.max(year).alias("last_year"))
