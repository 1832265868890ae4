"""Problem 2: matching entities across sources without keys.

Method: loopy belief propagation over candidate pairs with one-to-one factors. Pairs come from word-wise symmetric
deletes of the main title; titles, authors and years give each pair its own evidence. Citations that stand in one
person's list of one year for the same work, misspelt or extracted again, are one mention; a mention denotes at most one
work, and of the mentions in a list at most one denotes a given work. Messages pass through joins until they settle,
and the marginal probability is the confidence.
"""

from __future__ import annotations

import sys

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from citeloom.llm import _util
from citeloom.llm.textforms import with_same_form

#: The evidence a pair starts from, as log odds: prior, title, subtitle, authors and year.
PRIOR, TITLE_EQUAL, TITLE_NEAR, TITLE_SHORT = -3.0, 5.6, 4.0, 1.5
SUB_THERE, SUB_AWAY = 2.0, -1.0
AUTHORS_THERE, AUTHORS_SOME, AUTHORS_AWAY = 2.5, 1.5, -2.5
YEAR_NEAR, YEAR_FAR = 1.0, -1.5
#: Shorter titles are no evidence by themselves: they are met by their exact words and need authors and a year.
MIN_WORDS = 4


def flat(col: Column) -> Column:
    """Lower case on one line; words broken at a line end are joined."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(col), "(?<=\\p{L})[-‐]\\s*[\\r\\n]+\\s*(?=\\p{L})", ""), "\\s+", " "))


def words(col: Column) -> Column:
    return F.array_remove(F.split(col, "[^\\p{L}\\p{N}]+"), "")


def left_out(ws: Column) -> Column:
    """Keys of a list of words and of the list without each of its words, blind to the words' order.

    A list's key is the sum of its words' hashes, so leaving a word out is a subtraction. Pairs are verified later.
    """
    each = F.transform(ws, lambda w: F.hash(w).cast("long"))
    total = F.aggregate(each, F.lit(0).cast("long"), lambda s, x: s + x)
    return F.array_distinct(F.concat(F.array(total), F.transform(each, lambda x: total - x)))


def segments(text: Column, longest: int, short: bool = False) -> Column:
    """The stretches of a citation that may be a main title: between sentence marks, and up to each comma inside.

    Stretches mostly of initials and numbers are none. longest: the words of the longest title there is, beyond which
    no stretch can match. short: only the stretches of fewer than MIN_WORDS words, instead of only the others.
    """
    base = F.split(text, "[.:;?“”\"«»()\\[\\]]+|(?<=\\s)[-–—](?=\\s)|,[”\"]")
    if not short:
        base = F.filter(base, lambda s: s.rlike("([\\p{L}\\p{N}]+[^\\p{L}\\p{N}]+){%d}[\\p{L}\\p{N}]" % (MIN_WORDS - 1)) & s.rlike("\\p{L}{2,}"))
    # a stretch up to the n-th comma has n words at least
    commas = F.flatten(F.transform(base, lambda s: F.transform(F.sequence(F.lit(1), F.least(F.size(F.split(s, ",")), F.lit(longest + 1))), lambda i: F.array_join(F.slice(F.split(s, ","), F.lit(1), i), " "))))
    lists = F.transform(commas, words)
    fits = (lambda w: F.size(w).between(1, MIN_WORDS - 1)) if short else (lambda w: F.size(w).between(MIN_WORDS, longest + 1))
    whole = lambda w: fits(w) & (F.size(F.filter(w, lambda x: x.rlike("^(.|\\d+)$"))) * 3 <= F.size(w))
    return F.array_distinct(F.transform(F.filter(lists, whole), lambda w: F.array_join(w, " ")))


def mentions(candidates: DataFrame, matched: DataFrame, longest: int, short: bool) -> tuple[DataFrame, DataFrame]:
    """(record_id, c, slot) of every candidate without a matched row, and (c, segs, said, years) of every distinct citation c.

    Rows that were extracted twice, or differ in formatting only, share one c, so copies are matched once. Texts are
    mapped where they are read; only ids and hashes meet the matched ids, and texts move once.
    """
    both = candidates.where("record_id is not null").select("record_id", F.concat_ws(" \u0001. ", "title", "raw_citation").alias("t"), F.hash("faculty_heading", "report_year").alias("slot"))
    folded = with_same_form(both, "t", "f").withColumn("t", flat(F.col("f"))).select("record_id", "slot", "t").withColumn("c", F.xxhash64("t"))
    folded = _util.cut(folded)
    rows = _util.cut(folded.select("record_id", "c", "slot").join(matched.select("record_id").distinct(), "record_id", "left_anti"))
    distinct = folded.select("c", "t").join(rows.select("c").distinct(), "c", "left_semi").groupBy("c").agg(F.min("t").alias("t"))
    years = F.transform(F.regexp_extract_all("t", F.lit("(?<!\\d)((?:19|20)\\d\\d)(?!\\d)"), F.lit(1)), lambda y: y.cast("int"))
    brief = segments(F.col("t"), longest, True) if short else F.array().cast("array<string>")
    cites = distinct.select("c", segments(F.col("t"), longest).alias("segs"), brief.alias("brief"), F.array_distinct(words(F.col("t"))).alias("said"), F.array_distinct(years).alias("years"))
    return rows, _util.cut(cites).where("size(segs) > 0 or size(brief) > 0")


def catalogue(matched: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(record_id, w) of every matched row, and (w, main, sub, authors, years) of every catalogued work w.

    Rows with one main title are one work unless their subtitles differ; a row whose subtitle was cut belongs to the
    only subtitled work of that main title, if there is just one.
    """
    m = with_same_form(matched.where("record_id is not null and canonical_title <> ''").select("record_id", "canonical_title", "authors", "publication_year"), "canonical_title", "f")
    m = with_same_form(m, "authors", "au").withColumn("t", flat(F.col("f")))
    main, sub = words(F.substring_index("t", ":", 1)), words(F.when(F.col("t").contains(":"), F.expr("substring(t, locate(':', t) + 1)")).otherwise(""))
    m = m.select("record_id", F.array_join(main, " ").alias("main"), F.array_join(sub, " ").alias("sub"), F.transform(F.split(F.lower(F.coalesce("au", F.lit(""))), ";"), lambda a: F.array_join(F.filter(words(a), lambda w: F.char_length(w) >= 3), " ")).alias("authors"), "publication_year").where("main <> ''")
    m = _util.cut(m)
    subs = m.where("sub <> ''").groupBy("main").agg(F.min("sub").alias("lo"), F.max("sub").alias("hi"))
    whole = m.join(subs, "main", "left").withColumn("sub", F.when((F.col("sub") == "") & (F.col("lo") == F.col("hi")), F.col("lo")).otherwise(F.col("sub"))).drop("lo", "hi")
    whole = whole.withColumn("w", F.xxhash64("main", "sub"))
    works = whole.groupBy("w", "main", "sub").agg(F.array_distinct(F.flatten(F.collect_set("authors"))).alias("authors"), F.collect_set(F.col("publication_year").cast("int")).alias("years"))
    return whole.select("record_id", "w"), works


def evidence(cites: DataFrame, works: DataFrame, short: bool) -> DataFrame:
    """(c, w, odds): candidate pairs that share a main title up to one word, with their own log odds."""
    ck = cites.select("c", F.explode(F.array_distinct(F.flatten(F.transform("segs", lambda s: left_out(F.split(s, " ")))))).alias("k"))
    wk = works.where(f"size(split(main, ' ')) >= {MIN_WORDS}").select("w", F.explode(left_out(F.split("main", " "))).alias("k"))
    pairs = ck.join(wk, "k").select("c", "w").distinct()
    if short:
        brief = cites.select("c", F.explode("brief").alias("main")).join(works.where(f"size(split(main, ' ')) < {MIN_WORDS}").select("w", "main"), "main")
        pairs = pairs.unionByName(brief.select("c", "w").distinct())
    p = pairs.join(works, "w").join(cites.withColumnRenamed("years", "cited"), "c")
    # one changed word must be a misspelling or an abbreviation, one added word an article
    article = lambda x: F.regexp_replace(x, "^(the|a|an|on) | (the|a|an)(?= )", "")
    short = lambda a, b: (F.char_length(a) >= 3) & (F.char_length(a) <= 6) & F.rlike(b, F.concat(F.lit("^"), F.array_join(F.split(a, ""), ".*"), F.lit("$")))
    mw = F.split("main", " ")

    def abbreviates(s: Column) -> Column:
        pairs = F.filter(F.zip_with(F.split(s, " "), mw, lambda a, b: F.struct(a.alias("a"), b.alias("b"))), lambda x: x["a"] != x["b"])
        return (F.size(F.split(s, " ")) == F.size(mw)) & (F.size(pairs) == 1) & F.exists(pairs, lambda x: short(x["a"], x["b"]))

    like = F.array_max(F.transform("segs", lambda s: F.when(s == F.col("main"), 2).when(F.levenshtein(s, F.col("main"), 2) >= 0, 1).when(article(s) == article(F.col("main")), 1).when(abbreviates(s), 1).otherwise(0)))
    p = p.withColumn("like", F.when(F.size(mw) < MIN_WORDS, 3).otherwise(like)).where("like > 0")
    subw = F.array_remove(F.split("sub", " "), "")
    there = F.size(F.array_intersect(subw, "said")) / F.greatest(F.size(subw), F.lit(1))
    au = F.filter("authors", lambda a: a != "")
    named = F.size(F.filter(au, lambda a: F.arrays_overlap(F.split(a, " "), F.col("said")))) / F.greatest(F.size(au), F.lit(1))
    gap = F.array_min(F.flatten(F.transform("years", lambda y: F.transform("cited", lambda z: F.abs(y - z)))))
    odds = F.lit(PRIOR) + F.when(F.col("like") == 3, TITLE_SHORT).when(F.col("like") == 2, TITLE_EQUAL).otherwise(TITLE_NEAR)
    odds += F.when(F.size(subw) == 0, 0.0).when(there >= 0.6, SUB_THERE).otherwise(SUB_AWAY)
    odds += F.when(F.size(au) == 0, 0.0).when(named >= 0.5, AUTHORS_THERE).when(named > 0, AUTHORS_SOME).otherwise(AUTHORS_AWAY)
    odds += F.when(gap.isNull(), 0.0).when(gap <= 1, YEAR_NEAR).when(gap >= 3, YEAR_FAR).otherwise(0.0)
    return p.select("c", "w", odds.alias("odds"))


def mentioned(pairs: DataFrame) -> DataFrame:
    """(c, slot, w, odds) pairs with m: the smallest citation of the list that shares a work with c."""
    shared = pairs.groupBy("slot", "w").agg(F.min("c").alias("lo"))
    least = pairs.join(shared, ["slot", "w"]).groupBy("slot", "c").agg(F.min("lo").alias("m"))
    return pairs.join(least, ["slot", "c"])


def propagate(pairs: DataFrame, rounds: int = 100, tolerance: float = 1e-3) -> DataFrame:
    """(c, slot, w, told): loopy belief propagation over (c, slot, w, odds) pairs; told is what the factors say to a pair.

    Each pair is a yes/no variable between two at-most-one factors: over the works of its candidate (c), and over the
    candidates of its list (w, slot). The message of such a factor to a pair is -log(1 + sum of the others' odds).
    Pairs that compete with none are settled at once; only the others take part in the rounds.
    """
    by_c, by_w = Window.partitionBy("c", "slot"), Window.partitionBy("w", "slot")
    rival = pairs.withColumn("n", F.greatest(F.count("*").over(by_c), F.count("*").over(by_w)))
    rival = _util.cut(rival)
    sure = rival.where("n = 1").select("c", "slot", "w", F.lit(0.0).alias("told"))
    live = rival.where("n > 1").select("c", "slot", "w", "odds", F.lit(0.0).alias("from_c"), F.lit(0.0).alias("from_w"))
    for _ in range(rounds):
        to_c, to_w = F.exp(F.least(F.col("odds") + F.col("from_w"), F.lit(30.0))), F.exp(F.least(F.col("odds") + F.col("from_c"), F.lit(30.0)))
        said = live.withColumn("to_c", to_c).withColumn("to_w", to_w)
        damp = lambda old, new: 0.3 * F.col(old) + 0.7 * new
        new = said.withColumn("new_c", damp("from_c", -F.log1p(F.greatest(F.sum("to_c").over(by_c) - F.col("to_c"), F.lit(0.0)))))
        new = new.withColumn("new_w", damp("from_w", -F.log1p(F.greatest(F.sum("to_w").over(by_w) - F.col("to_w"), F.lit(0.0)))))
        new = _util.cut(new.select("c", "slot", "w", "odds", F.col("new_c").alias("from_c"), F.col("new_w").alias("from_w"), F.greatest(F.abs(F.col("new_c") - F.col("from_c")), F.abs(F.col("new_w") - F.col("from_w"))).alias("moved")))
        top = new.agg(F.max("moved")).first()[0]
        live = new.drop("moved")
        if top is None or top < tolerance:
            break
    else:
        raise RuntimeError(f"messages did not settle in {rounds} rounds")
    return sure.unionByName(live.select("c", "slot", "w", (F.col("from_c") + F.col("from_w")).alias("told")))


def matches(candidates: DataFrame, resolution: DataFrame) -> DataFrame:
    """(candidate_record_id, resolution_record_id, confidence) for candidates without a matched row of their own.

    Null titles, citations, authors or years simply give no evidence; repeated rows give their pairs once. Titles that
    differ by a word that is no misspelling are other works; works that only rivals of a citation are come out with a
    confidence below one half. Every matched row of the work is given.
    """
    matched = resolution.where("match_status = 'matched'")
    held, works = catalogue(matched)
    works = _util.cut(works)
    size = F.size(F.split("main", " "))
    longest, shortest = works.agg(F.max(size), F.min(size)).first()
    short = shortest is not None and shortest < MIN_WORDS
    rows, cites = mentions(candidates, matched, longest or 0, short)
    odds = _util.cut(evidence(cites, works, short))
    pairs = _util.cut(mentioned(rows.select("c", "slot").distinct().join(odds, "c")))
    told = propagate(pairs.groupBy(F.col("m").alias("c"), "slot", "w").agg(F.max("odds").alias("odds"))).withColumnRenamed("c", "m")
    marginal = pairs.join(told, ["m", "slot", "w"]).select("c", "slot", "w", (1 / (1 + F.exp(-(F.col("odds") + F.col("told"))))).alias("confidence"))
    got = rows.join(marginal, ["c", "slot"]).select(F.col("record_id").alias("candidate_record_id"), "w", "confidence")
    return got.join(held.withColumnRenamed("record_id", "resolution_record_id"), "w").groupBy("candidate_record_id", "resolution_record_id").agg(F.max("confidence").alias("confidence"))


_util.by_value(sys.modules[__name__])
