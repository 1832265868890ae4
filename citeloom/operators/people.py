"""Rosters of people: building, overriding, finding them in citations, deciding on authorships."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from citeloom.functions.numeric import overlap_or_open
from citeloom.functions.similarity import name_similarity
from citeloom.functions.text import clean_name, contains_tokens, name_key, orcid, split_list, stable_id, years
from citeloom.operators.keep import fold_log, top_per_key


def roster(headings: DataFrame, name: str, year: str, source: str, preferred: Column | None = None, not_people: list[str] | None = None) -> DataFrame:
    """One row per name key: id, the most frequent display name (preferred sources first), years, sources, occurrences.

    Keys of fewer than two or more than seven words, and those listed as no people, are left out.
    """
    h = headings.select(clean_name(F.col(name)).alias("display"), name_key(F.col(name)).alias("key"), F.col(year).cast("string").alias("y"), F.col(source).alias("s"), (preferred if preferred is not None else F.lit(False)).alias("p"))
    h = h.where(F.size(F.split("key", " ")).between(2, 7) & ~F.col("key").isin(not_people or []))
    counted = h.groupBy("key", "display").agg(F.max("p").alias("p"), F.count("*").alias("n"), F.collect_set("y").alias("ys"), F.collect_set("s").alias("ss"))
    best = top_per_key(counted, ["key"], [F.desc("p"), F.desc("n"), F.lower("display"), F.col("display")]).select("key", F.col("display").alias("name"))
    total = counted.groupBy("key").agg(F.sum("n").alias("n_rows"), F.array_join(F.array_sort(F.array_distinct(F.flatten(F.collect_list("ys")))), ";").alias("years"), F.array_join(F.array_sort(F.array_distinct(F.flatten(F.collect_list("ss")))), ";").alias("sources"), F.array_join(F.array_sort(F.collect_set("display")), ";").alias("aliases"))
    return best.join(total, "key").select(stable_id("fac_", F.col("key")).alias("person_id"), F.col("name"), F.col("key").alias("name_key"), "aliases", "years", "sources", "n_rows")


def with_overrides(people: DataFrame, log: DataFrame) -> DataFrame:
    """A roster after its log of (person_id, action rename|add_alias|exclude, value, seq)."""
    last = fold_log(log.where("action in ('rename', 'exclude')"), ["person_id", "action"], ["seq"], F.lit(False))
    out = people.join(last.where("action = 'exclude'").select("person_id"), "person_id", "left_anti")
    name = last.where("action = 'rename'").select("person_id", F.col("value").alias("__new"))
    extra = log.where("action = 'add_alias'").groupBy("person_id").agg(F.collect_set("value").alias("__more"))
    both = out.join(name, "person_id", "left").join(extra, "person_id", "left")
    old = F.when(F.col("__new").isNotNull(), F.array("name")).otherwise(F.array().cast("array<string>"))
    aliases = F.array_join(F.array_sort(F.array_distinct(F.concat(split_list(F.col("aliases")), old, F.coalesce("__more", F.array().cast("array<string>"))))), ";")
    return both.withColumn("aliases", aliases).withColumn("name", F.coalesce("__new", "name")).drop("__new", "__more")


def identifier_problems(ids: DataFrame, people: DataFrame) -> DataFrame:
    """(person_id, problem) of curated identifiers: unknown person, bad check digit, or used for several people."""
    i = ids.select("person_id", F.col("orcid").alias("raw"), orcid(F.col("orcid")).alias("o"))
    unknown = i.join(people.select("person_id"), "person_id", "left_anti").select("person_id", F.lit("unknown person").alias("problem"))
    bad = i.where("raw is not null and o is null").select("person_id", F.lit("invalid identifier").alias("problem"))
    twice = i.join(i.groupBy("o").agg(F.count_distinct("person_id").alias("n")).where("n > 1 and o is not null"), "o").select("person_id", F.lit("identifier of several people").alias("problem"))
    return unknown.unionByName(bad).unionByName(twice).distinct()


def author_zone(citation: Column) -> Column:
    """The text before the first year, if that starts after two characters, else all."""
    at = F.regexp_instr(citation, F.lit("(?<!\\d)(?:19|20)\\d{2}(?!\\d)"))
    return F.when(at >= 3, F.substring(citation, F.lit(1), at - 1)).otherwise(citation)


def citation_authors(citations: DataFrame, id: str, citation: str, year: str, people: DataFrame, person: str, name: str, aliases: str, active: str) -> DataFrame:
    """(id, person, basis, confidence): people named in a citation's author zone, in full or as a unique surname with initial.

    Blocking on the surname token makes this an equi-join; containment is verified on what it leaves. People with years
    are considered in those only.
    """
    forms = people.select(person, F.explode(F.array_distinct(F.concat(F.array(name_key(F.col(name))), F.transform(split_list(F.col(aliases)), lambda a: name_key(a))))).alias("form"), split_list(F.col(active)).alias("ys"))
    w = F.split("form", " ")
    forms = forms.where(F.size(w) >= 2).select(person, "form", "ys", F.element_at(w, -1).alias("surname"), F.get(w, 0).alias("first"), F.get(w, 1).alias("second"), F.size(w).alias("n"))
    sole = forms.groupBy("surname", F.substring("first", 1, 1).alias("initial")).agg(F.count_distinct(person).alias("m")).where("m = 1").drop("m")
    f = forms.withColumn("initial", F.substring("first", 1, 1)).join(sole.withColumn("sole", F.lit(True)), ["surname", "initial"], "left")
    zone = citations.select(id, F.col(year).cast("string").alias("y"), name_key(author_zone(F.col(citation))).alias("zone")).where("zone <> ''")
    words = zone.select(id, "y", "zone", F.explode(F.array_distinct(F.split("zone", " "))).alias("surname"))
    j = words.join(f, "surname").where((F.size("ys") == 0) | F.col("y").isNull() | F.array_contains("ys", F.col("y")))
    z = F.col("zone")
    reverse = F.concat_ws(" ", "surname", F.expr("substring(form, 1, length(form) - length(surname) - 1)"))
    full = contains_tokens(z, F.col("form")) | contains_tokens(z, reverse)
    s, i, a, m = F.col("surname"), F.col("initial"), F.col("first"), F.when(F.col("n") > 2, F.substring("second", 1, 1))
    short = F.array_compact(F.array(F.concat_ws(" ", i, s), F.concat_ws(" ", s, i), F.concat_ws(" ", a, s), F.concat_ws(" ", s, a), F.when(m.isNotNull(), F.concat_ws(" ", i, m, s)), F.when(m.isNotNull(), F.concat_ws(" ", s, i, m))))
    some = F.coalesce(F.col("sole"), F.lit(False)) & F.exists(short, lambda v: contains_tokens(z, v))
    hit = j.withColumn("confidence", F.when(full, 0.99).when(some, 0.96)).where("confidence is not null")
    return hit.groupBy(id, person).agg(F.max("confidence").alias("confidence")).withColumn("basis", F.when(F.col("confidence") == 0.99, "citation_full_name").otherwise("citation_unique_surname_initial"))


def surnames_in_reach(a: Column, b: Column) -> Column:
    """False for name keys whose surnames' ratio cannot be 0.88: too many letters of one surname are not in the other."""
    sa, sb = F.element_at(F.split(a, " "), -1), F.element_at(F.split(b, " "), -1)
    least = 0.44 * (F.char_length(sa) + F.char_length(sb)) - 1e-9
    held = lambda x, y: F.char_length(x) - F.char_length(F.call_function("translate", x, y, F.lit("")))
    return (held(sa, sb) >= least) & (held(sb, sa) >= least)


def similar_names(names: DataFrame, name: str, people: DataFrame, person: str, roster_name: str) -> DataFrame:
    """(name, person, roster name, score): all pairs of names with equal surnames or a name similarity over 0.

    No similarity is over 0 unless the first initials are equal and the surnames' ratio is 0.88 or more, so names are met
    by their initial; pairs of equal surnames come out with their 0 where the initials differ.
    """
    n = names.select(name, name_key(F.col(name)).alias("a"))
    p = people.select(person, roster_name, name_key(F.col(roster_name)).alias("b"))
    last = lambda k: F.element_at(F.split(k, " "), -1)
    n = n.withColumn("sa", last(F.col("a"))).withColumn("i", F.substring("a", 1, 1))
    p = p.withColumn("sb", last(F.col("b"))).withColumn("j", F.substring("b", 1, 1))
    other = n.join(p, (F.col("i") == F.col("j")) & (F.col("sa") != F.col("sb"))).where(surnames_in_reach(F.col("a"), F.col("b")))
    out = lambda d: d.select(name, person, roster_name, name_similarity(F.col(name), F.col(roster_name)).alias("score"))
    return out(n.join(p, F.col("sa") == F.col("sb"))).unionByName(out(other).where("score > 0"))


def reach_keys(key: Column) -> Column:
    """What two name keys have in common that any similarity over 0 needs: the first initial with two letters in a row of the surname.

    Surnames of a ratio of 0.88 have runs of two letters or more in common, and one of a single letter has only its like.
    """
    last = F.element_at(F.split(key, " "), -1)
    runs = F.when(F.char_length(last) < 2, F.array(last)).otherwise(F.transform(F.sequence(F.lit(1), F.char_length(last) - 1), lambda i: F.substring(last, i, F.lit(2))))
    return F.when(key != "", F.array_distinct(F.transform(runs, lambda r: F.concat(F.substring(key, 1, 1), r))))


def named_candidates(authorships: DataFrame, people: DataFrame) -> DataFrame:
    """(authorship_id, person_id, s): pairs with the similarity of the name to the person's nearest alias, where over 0.

    Distinct names meet distinct alias keys, so a name that many authorships share is compared once.
    """
    alias = people.select("person_id", F.explode("aliases").alias("alias")).withColumn("b", name_key(F.col("alias"))).where("b <> ''")
    mine = authorships.select("authorship_id", "name").withColumn("a", name_key(F.col("name"))).where("a <> ''")
    left = mine.groupBy("a").agg(F.min("name").alias("name")).withColumn("k", F.explode(reach_keys(F.col("a"))))
    right = alias.groupBy("b").agg(F.min("alias").alias("alias")).withColumn("k", F.explode(reach_keys(F.col("b"))))
    met = left.join(right, "k").where(surnames_in_reach(F.col("a"), F.col("b"))).groupBy("a", "b").agg(F.min("name").alias("name"), F.min("alias").alias("alias"))
    scored = met.select("a", "b", name_similarity(F.col("name"), F.col("alias")).alias("s")).where("s > 0")
    of = scored.join(alias.select("person_id", "b"), "b").groupBy("a", "person_id").agg(F.max("s").alias("s"))
    return mine.select("authorship_id", "a").join(of, "a").select("authorship_id", "person_id", "s")


def decide(authorships: DataFrame, people: DataFrame) -> DataFrame:
    """(authorship_id, status, person_id, rule, confidence): who an authorship is, by identifiers, name and institutions.

    authorships: authorship_id, name, author_id, orcid, institutions, years; people: person_id, aliases (array), orcid,
    author_ids, institutions, years. People are met through equal identifiers or a similar name; the best of several must
    lead by 0.015, else the authorship is ambiguous.
    """
    named = named_candidates(authorships, people)
    by_id = authorships.where("orcid is not null").select("authorship_id", "orcid").join(people.where("orcid is not null").select("person_id", "orcid"), "orcid").select("authorship_id", "person_id", F.lit(0.0).alias("s"))
    pairs = named.unionByName(by_id).groupBy("authorship_id", "person_id").agg(F.max("s").alias("s"))
    j = pairs.join(authorships, "authorship_id").join(people.select("person_id", F.col("orcid").alias("p_orcid"), F.col("author_ids").alias("p_ids"), F.col("institutions").alias("p_inst"), F.col("years").alias("p_years")), "person_id")
    j = j.where(overlap_or_open(F.col("years"), F.col("p_years"))).where("orcid is null or p_orcid is null or orcid = p_orcid")
    same, known, shared, s = F.coalesce(F.col("orcid") == F.col("p_orcid"), F.lit(False)), F.coalesce(F.array_contains("p_ids", F.col("author_id")), F.lit(False)), F.arrays_overlap("institutions", "p_inst"), F.col("s")
    steps = [(same, "curated_orcid", F.lit(0.999)), ((s >= 0.96) & known & shared, "name+id+institution", F.lit(0.995)), ((s >= 0.96) & known, "name+id", F.lit(0.99)), ((s >= 0.96) & shared, "name+institution", F.lit(0.985)), (s >= 0.96, "extremely_similar_name", F.least(F.lit(0.98), s)), (known & (s >= 0.82), "id+compatible_name", F.lit(0.98)), (shared & (s >= 0.9), "institution+extremely_similar_name", F.lit(0.97))]
    rule, confidence = F.lit(None).cast("string"), F.lit(None).cast("double")
    for when, name, value in reversed(steps):
        rule, confidence = F.when(when, name).otherwise(rule), F.when(when, value).otherwise(confidence)
    r = j.withColumn("rule", rule).withColumn("confidence", confidence).where("rule is not null")
    w = Window.partitionBy("authorship_id").orderBy(F.desc("confidence"), F.desc("s"), F.desc("person_id"))
    top = r.withColumn("k", F.row_number().over(w)).withColumn("second", F.lead("confidence").over(w)).where("k = 1")
    clear = F.col("second").isNull() | (F.round(F.col("confidence") - F.col("second"), 6) >= 0.015)
    out = authorships.select("authorship_id").join(top.select("authorship_id", "person_id", "rule", "confidence", clear.alias("clear")), "authorship_id", "left")
    status = F.when(F.col("clear").isNull(), "unmatched").when(F.col("clear"), "matched").otherwise("ambiguous")
    keep = lambda c: F.when(F.col("clear"), F.col(c)).alias(c)
    return out.select("authorship_id", status.alias("status"), keep("person_id"), keep("rule"), keep("confidence"))


def merge_evidence(local: DataFrame, external: DataFrame, has_external: DataFrame, work: str = "work_id", person: str = "person_id") -> DataFrame:
    """(work, person, basis, confidence): local and external evidence, the more confident wins, the external on ties.

    Owner-only evidence is withheld for works that have external authors if the person is not among them.
    """
    owner = local.where("basis = 'owner'").join(has_external.select(work).distinct(), work, "left_semi").join(external.select(work, person), [work, person], "left_anti").select(work, person, "basis")
    kept = local.join(owner, [work, person, "basis"], "left_anti")
    both = external.withColumn("o", F.lit(0)).unionByName(kept.withColumn("o", F.lit(1)), allowMissingColumns=True)
    return top_per_key(both, [work, person], [F.desc("confidence"), F.asc("o"), F.asc("basis")]).drop("o")


def seen_years(text: Column) -> Column:
    return F.array_sort(F.array_distinct(years(text)))
