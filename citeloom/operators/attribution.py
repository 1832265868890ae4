"""Whose work it is, end to end: stored authorships, what they teach about people, evidence of the reports, the decision."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citeloom.functions.text import clean_name, name_key, orcid, split_list
from citeloom.lineage import cut
from citeloom.operators.keep import top_per_key
from citeloom.operators.people import decide, merge_evidence, named_candidates
from citeloom.sources.files import authorships, json_list

def _empty() -> Column:
    return F.array().cast("array<string>")


def stored(resolution: DataFrame, record: str = "record_id", column: str = "openalex_authorships") -> DataFrame:
    """(record, name, author_id, orcid, institutions) of every stored authorship; bad lists have none."""
    each = resolution.where(F.col(column).isNotNull()).select(record, F.explode(authorships(F.col(column))).alias("a"))
    ids = F.array_sort(F.array_distinct(F.filter(F.transform("a.institutions", lambda i: F.trim(i)), lambda i: i != "")))
    return each.select(record, clean_name(F.col("a.name")).alias("name"), F.nullif(F.trim("a.author_id"), F.lit("")).alias("author_id"), orcid(F.col("a.orcid")).alias("orcid"), ids.alias("institutions"))


def observed(stored_: DataFrame, years: DataFrame, record: str = "record_id", year: str = "report_year") -> DataFrame:
    """Stored authorships made distinct: authorship_id, name, author_id, orcid, institutions and the years of their records."""
    y = years.select(record, F.col(year).cast("string").alias("__y"))
    key = F.sha2(F.concat_ws("\u0001", F.coalesce("author_id", F.lit("")), name_key(F.col("name")), F.array_join("institutions", ";")), 256)
    rows = stored_.join(y, record, "left").withColumn("authorship_id", F.substring(key, 1, 24))
    return rows.groupBy("authorship_id").agg(F.min("name").alias("name"), F.min("author_id").alias("author_id"), F.max("orcid").alias("orcid"), F.min("institutions").alias("institutions"), F.array_sort(F.collect_set("__y")).alias("years"))


def registered(roster: DataFrame, id: str, name: str, aliases: str, years: str, identifier: str) -> DataFrame:
    """A roster as people: person_id, aliases, orcid, author_ids, institutions, years."""
    return roster.where(F.col(id).isNotNull()).select(
        F.col(id).alias("person_id"), F.array_distinct(F.array_compact(F.concat(F.array(name), split_list(F.col(aliases))))).alias("aliases"), orcid(F.col(identifier)).alias("orcid"),
        _empty().alias("author_ids"), _empty().alias("institutions"), F.coalesce(split_list(F.col(years)), _empty()).alias("years"),
    )


def learned(people: DataFrame, observations: DataFrame, least: float = 0.96, lead: float = 0.015, rounds: int = 10) -> DataFrame:
    """People with the spellings, author ids and institutions of the observations whose name is clearly theirs.

    A name is clearly someone's if its similarity to one of their spellings is `least` or more and leads the next
    person's by `lead`. What a round teaches is known in the next, until no new spelling comes up, so the result does
    not depend on any order of rows. Raises if rounds run out.
    """
    observations, people = cut(observations), cut(people)
    for _ in range(rounds):
        pairs = named_candidates(observations, people).where(F.col("s") >= least)
        best = pairs.groupBy("authorship_id").agg(F.max(F.struct("s", "person_id")).alias("b"), F.array_sort(F.collect_list("s")).alias("all"))
        clear = F.coalesce(F.round(F.col("b.s") - F.get(F.reverse("all"), F.lit(1)), 6) >= lead, F.lit(True))
        won = best.where(clear).select("authorship_id", "b.person_id").join(observations, "authorship_id")
        new = won.groupBy("person_id").agg(F.collect_set("name").alias("n"), F.collect_set("author_id").alias("i"), F.array_distinct(F.flatten(F.collect_list("institutions"))).alias("w"))
        grown = people.join(new, "person_id", "left")
        more = lambda a, b: F.array_sort(F.array_union(a, F.coalesce(b, _empty())))
        grown = cut(grown.select("person_id", more("aliases", "n").alias("aliases"), "orcid", more("author_ids", "i").alias("author_ids"), more("institutions", "w").alias("institutions"), "years", F.size("aliases").alias("__was")))
        done = grown.where(F.size("aliases") > F.col("__was")).limit(1).count() == 0
        people = grown.drop("__was")
        if done:
            return people
    raise RuntimeError(f"aliases still grew after {rounds} rounds")


def owners(candidates: DataFrame, people: DataFrame, id: str = "record_id", heading: str = "faculty_heading") -> DataFrame:
    """(id, person_id, basis, confidence): the person of whom the heading is a spelling; keys of several people show nobody."""
    keys = people.select("person_id", F.explode("aliases").alias("a")).select("person_id", name_key(F.col("a")).alias("k")).where("k <> ''").distinct()
    sole = keys.groupBy("k").agg(F.min("person_id").alias("person_id"), F.count("*").alias("n")).where("n = 1").drop("n")
    return candidates.select(id, name_key(F.col(heading)).alias("k")).join(sole, "k").select(id, "person_id", F.lit("owner").alias("basis"), F.lit(0.9).alias("confidence"))


def local_evidence(candidates: DataFrame, id: str = "record_id", column: str = "institutional_author_evidence") -> DataFrame:
    """(id, person_id, basis, confidence) of the evidence stored with candidates, the most confident per person."""
    each = candidates.where(F.col(column).isNotNull()).select(id, F.explode(json_list(F.col(column), "struct<faculty_id:string,basis:string,confidence:double>")).alias("e"))
    rows = each.where("e.faculty_id is not null").select(id, F.col("e.faculty_id").alias("person_id"), F.coalesce("e.basis", F.lit("pre_resolution_citation")).alias("basis"), F.coalesce("e.confidence", F.lit(0.0)).alias("confidence"))
    return top_per_key(rows, [id, "person_id"], [F.desc("confidence"), F.asc("basis")])


def attributed(articles: DataFrame, sources: str, stored_: DataFrame, candidates: DataFrame, people: DataFrame, id: str = "record_id", year: str = "report_year") -> tuple[DataFrame, DataFrame]:
    """(attributions, audit) of articles, each with a ';' list of source rows.

    attributions: (work_id, person_id, basis, confidence) after merging stored authorships with local evidence; audit:
    (work_id, authorship_id, name, status, person_id, rule, confidence) for every authorship of an article, also those
    that are nobody's or fit several people.
    """
    rows = articles.where(F.col(id).isNotNull()).select(F.col(id).alias("work_id"), F.explode(split_list(F.col(sources))).alias("src")).distinct()
    of = rows.join(stored_.withColumnRenamed(id, "src"), "src")
    key = F.sha2(F.concat_ws("\u0001", "work_id", F.coalesce("author_id", F.lit("")), name_key(F.col("name")), F.array_join("institutions", ";")), 256)
    of = of.withColumn("authorship_id", F.substring(key, 1, 24)).groupBy("authorship_id", "work_id").agg(F.min("name").alias("name"), F.min("author_id").alias("author_id"), F.max("orcid").alias("orcid"), F.min("institutions").alias("institutions"))
    when = rows.join(candidates.select(F.col(id).alias("src"), F.col(year).cast("string").alias("y")), "src").groupBy("work_id").agg(F.array_sort(F.collect_set("y")).alias("years"))
    of = cut(of.join(when, "work_id", "left").withColumn("years", F.coalesce("years", _empty())))
    audit = cut(decide(of.drop("work_id"), people)).join(of.select("authorship_id", "work_id", "name"), "authorship_id")
    external = top_per_key(audit.where("status = 'matched'").select("work_id", "person_id", F.lit("authorship").alias("basis"), "confidence"), ["work_id", "person_id"], [F.desc("confidence")])
    told = local_evidence(candidates, id).unionByName(owners(candidates, people, id))
    local = top_per_key(rows.join(told.withColumnRenamed(id, "src"), "src").drop("src"), ["work_id", "person_id"], [F.desc("confidence"), F.asc("basis")])
    return merge_evidence(local.select("work_id", "person_id", "basis", "confidence"), external, of), audit.select("work_id", "authorship_id", "name", "status", "person_id", "rule", "confidence")


def profiles(people: DataFrame, attributions: DataFrame) -> DataFrame:
    """(person_id, n_aliases, n_author_ids, n_institutions, n_works, bases, has_doubt) of every person."""
    w = attributions.groupBy("person_id").agg(F.count_distinct("work_id").alias("n_works"), F.array_join(F.array_sort(F.collect_set("basis")), ";").alias("bases"), F.bool_or(F.col("confidence") < 0.5).alias("has_doubt"))
    sizes: list[Column] = [F.size(c).alias(f"n_{c}") for c in ("aliases", "author_ids", "institutions")]
    return people.select("person_id", *sizes).join(w, "person_id", "left").select("person_id", "n_aliases", "n_author_ids", "n_institutions", F.coalesce("n_works", F.lit(0)).cast("long").alias("n_works"), F.coalesce("bases", F.lit("")).alias("bases"), F.coalesce("has_doubt", F.lit(False)).alias("has_doubt"))
