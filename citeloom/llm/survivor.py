"""Problem 4: the best representative of each duplicate group.

Method: iterative truth discovery. Every stored value is a claim. What can be wrong with a value (markup, an added notice,
a cut end, odd capitals, an impossible score ...) are marks, the sources of doubt: each has a trust, the share of contests
its values win, and a value's support is the product of its marks' trusts. Trusts and the winners of the groups are
estimated in turn until they settle; the value with the highest support survives, the longest of equal ones.
"""

from __future__ import annotations

import math
import sys

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citeloom.llm import _util
from citeloom.llm.refine import doi_key, word_bag
from citeloom.llm.textforms import with_same_form

# Notices that publishers add to an abstract, and texts that stand in for one.
NOTICE = "(?i)(©|\\(c\\) *\\d{4}|\\bcopyright\\s+(by\\b|\\d{4})|all rights reserved|keywords?:|this article is part of|read more online)"
PLACEHOLDER = "(?i)^\\W*(n\\W*a|see pdf|no abstract.*|abstract (is )?not (available|provided).*|not available|none|null|tbd|-*)\\W*$"
MARKUP = "<[^>]{1,60}>|&[a-zA-Z]{2,8};|&#\\d+;|\\$\\$|\\\\[a-z]+\\{"


#: A mark's trust before any contest, and how many contests this start counts as.
START, START_WEIGHT = 0.6, 1.0


def abstract_marks(a: Column) -> dict[str, Column]:
    """What may be wrong with an abstract: text that is not the author's, or is not whole."""
    return {
        "start": ~a.rlike("^[\\p{L}\\p{N}\"“‘'(]"),
        "end": ~a.rlike("(?s)[^.…\\s][.!?][\"”’']?$"),
        "short": F.char_length(a) < 40,
        "notice": a.rlike(NOTICE),
        "placeholder": a.rlike(PLACEHOLDER),
        "markup": a.rlike(MARKUP),
        "label": a.rlike("(?i)^(abstract|summary)\\b *[:.\\-–—]"),
    }


def title_marks(t: Column) -> dict[str, Column]:
    """What may be wrong with a title: decorated edges, spacing, capitals that are not the ordinary ones."""
    words = F.filter(F.split(t, "[^\\p{L}\\p{N}'’]+"), lambda w: F.char_length(w) > 0)
    long = F.filter(words, lambda w: F.char_length(w) > 3)
    capital = F.filter(long, lambda w: w.rlike("^(\\p{Lu}|\\p{N})"))
    shout = F.filter(long, lambda w: w.rlike("^\\p{Lu}{4,}$"))
    return {
        "edges": ~t.rlike("(?s)^[\\p{L}\\p{N}].*[\\p{L}\\p{N})?!]$") | (t.rlike("[)]$") & ~t.contains("(")),
        "spaces": t.rlike("  |[\\t\\n\\r\\u00a0]"),
        "lower": ~t.rlike("^(\\p{Lu}|\\p{N})") | (F.size(capital) * 2 < F.size(long)) | ~t.rlike("\\p{Lu}"),
        "shout": (F.size(shout) * 2 > F.size(long)) | ~t.rlike("\\p{Ll}"),
        "mixed": F.exists(words, lambda w: w.rlike("\\p{Ll}\\p{Lu}\\p{Ll}*\\p{Lu}|^\\p{Ll}+\\p{Lu}|^\\p{Lu}{2,}\\p{Ll}+\\p{Lu}?")),
    }


def score_marks(s: Column) -> dict[str, Column]:
    return {"impossible": F.isnan(s) | (s < 0) | (s > 1)}


def work_keys(rows: DataFrame, id: str, title: str, doi: str) -> DataFrame:
    """(id, title_key, doi_key): hashed identities of a row in the sense of problem 3; null where a value is missing."""
    r = with_same_form(rows.select(F.col(id).alias("id"), F.col(title).alias("t"), F.col(doi).alias("d")), "t", "f")
    r = with_same_form(r, "d", "e")
    bag, d = word_bag(F.col("f")), doi_key(F.col("e"))
    return r.select("id", F.when(bag.isNotNull(), _util.key128(bag)).alias("tk"), F.when(d.isNotNull(), _util.key128(d)).alias("dk"))


def works(rows: DataFrame, id: str, title: str, doi: str, rounds: int = 40) -> DataFrame:
    """(id, group_id): rows linked, directly or through other rows, by title or doi; group_id is the smallest id.

    Rows are first folded to their distinct (title, doi) pairs, so copies cost nothing later. Labels then pass between
    titles and dois by minimum, each round also jumping to the label's own label, until nothing changes; every round
    is an aggregate with map-side combine and a written table, so hot keys and lost executors are harmless. A row
    without title and doi is its own group. Raises if rounds were not enough.
    """
    keys = _util.cut(work_keys(rows, id, title, doi).where("id is not null"))
    pairs = keys.groupBy("tk", "dk").agg(F.min("id").alias("label"))
    pairs = _util.cut(pairs.where("tk is not null or dk is not null"))
    # titles are the nodes, dois the links; a row without title is held by its doi alone
    node = F.coalesce("tk", "dk")
    nodes = pairs.withColumn("n", node).groupBy("n").agg(F.min("label").alias("label"))
    links = pairs.where("dk is not null").withColumn("n", node).select("n", "dk").distinct()
    links = links.join(links.groupBy("dk").agg(F.count("*").alias("c")).where("c > 1").select("dk"), "dk", "left_semi")
    labels, links = _util.cut(nodes), _util.cut(links)
    for _ in range(rounds):
        low = links.join(labels, "n").groupBy("dk").agg(F.min("label").alias("l"))
        sent = links.join(low, "dk").groupBy("n").agg(F.min("l").alias("l"))
        new = labels.join(sent, "n", "left").select("n", F.least("label", F.coalesce("l", "label")).alias("new"), F.col("label").alias("old"))
        jump = new.where("new <> old").groupBy(F.col("old").alias("j")).agg(F.min("new").alias("to"))
        new = new.join(jump, new["new"] == jump["j"], "left").select("n", F.least("new", F.coalesce("to", "new")).alias("label"), "old")
        new = _util.cut(new)
        moved = new.where("label <> old").limit(1).count()
        labels = new.select("n", "label")
        if not moved:
            break
    else:
        raise RuntimeError(f"groups of the same work did not settle in {rounds} rounds")
    named = keys.withColumn("n", node).join(labels, "n", "left")
    return named.select("id", F.coalesce("label", "id").alias("group_id"))


def _marks() -> list[str]:
    c = F.lit("")
    return [f"{f}:{m}" for f, d in (("abstract", abstract_marks(c)), ("canonical_title", title_marks(c)), ("match_score", score_marks(F.lit(0.0)))) for m in d]


def claims(rows: DataFrame, id: str, abstract: str, title: str, score: str) -> DataFrame:
    """(id, field, size, marks) of all values that are not null or empty: size is length or score, marks a bit set."""
    at = {m: i for i, m in enumerate(_marks())}
    s = F.col(score).cast("double")

    def claim(field: str, held: Column, size: Column, marks: dict[str, Column]) -> Column:
        bits = F.lit(0)
        for m, c in marks.items():
            bits = bits + F.when(c, F.lit(1 << at[f"{field}:{m}"])).otherwise(F.lit(0))
        return F.when(held, F.struct(F.lit(field).alias("field"), size.alias("size"), bits.alias("marks")))

    a, t = F.col(abstract), F.col(title)
    fields = F.array(
        claim("abstract", a != "", F.char_length(a).cast("double"), abstract_marks(a)),
        claim("canonical_title", t != "", F.char_length(t).cast("double"), title_marks(t)),
        claim("match_score", s.isNotNull(), s, score_marks(s)),
    )
    return rows.select(F.col(id).alias("id"), F.explode(F.filter(fields, lambda x: x.isNotNull())).alias("x")).select("id", "x.*")


def support(marks: int, trust: list[float]) -> float:
    """The product of the trusts of a value's marks; 1 for a value without any."""
    return math.prod(t for i, t in enumerate(trust) if marks >> i & 1)


def _supports(kinds: list[int], trust: list[float]) -> Column:
    """A map literal from every set of marks in use to its support."""
    return F.create_map(*[F.lit(x) for k in kinds for x in (k, float(support(k, trust)))])


def sets_of_marks(claimed: DataFrame) -> list[int]:
    """The sets of marks in use: at most 2 ** 7 + 2 ** 5 + 2, a field having seven marks at most."""
    return sorted(r.marks for r in claimed.select("marks").distinct().collect()) or [0]


def discover(claimed: DataFrame, used: list[int], tolerance: float = 0.01, rounds: int = 60) -> list[float]:
    """The trust of every mark, from (group_id, field, marks) claims.

    A contest is a group and field whose claims differ in their marks. The kinds of claims that have the highest support
    win it, and share the win if several do; a mark's trust is the share of its contests it won, START counting as
    START_WEIGHT contests. Contests with the same kinds of claims are counted first, so that a round meets one row per
    combination. Raises if the trusts do not settle.
    """
    contests = claimed.groupBy("group_id", "field").agg(F.array_sort(F.collect_set("marks")).alias("kinds")).where("size(kinds) > 1")
    contests = _util.cut(contests.groupBy("field", "kinds").agg(F.count("*").alias("n")))
    names = _marks()
    trust = [START] * len(names)
    for _ in range(rounds):
        held = F.transform("kinds", lambda k: F.try_element_at(_supports(used, trust), k))
        each = contests.select("n", F.arrays_zip("kinds", held.alias("s")).alias("k")).withColumn("top", F.array_max("k.s"))
        each = each.withColumn("ties", F.size(F.filter("k", lambda k: k["s"] >= F.col("top") - 1e-12))).select("n", "top", "ties", F.explode("k").alias("k")).select("n", "top", "ties", "k.*").withColumnRenamed("kinds", "marks")
        won = F.when(F.col("s") >= F.col("top") - 1e-12, F.col("n") / F.col("ties")).otherwise(0.0)
        bit = lambda i: F.shiftright("marks", i).bitwiseAND(F.lit(1))
        sums = each.agg(*[F.sum(bit(i) * x).alias(f"{c}{i}") for i in range(len(names)) for c, x in (("w", won), ("n", F.col("n")))]).first()
        new = [(START * START_WEIGHT + (sums[f"w{i}"] or 0)) / (START_WEIGHT + (sums[f"n{i}"] or 0)) for i in range(len(names))]
        moved, trust = max(abs(a - b) for a, b in zip(new, trust)), new
        if moved < tolerance:
            return trust
    raise RuntimeError(f"the marks' trusts did not settle in {rounds} rounds")


def survivors(rows: DataFrame, id: str, title: str, doi: str, abstract: str, score: str, accept: float = 0.5) -> DataFrame:
    """(group_record_id, field, record_id): whose value survives, for groups of two rows or more.

    Ties go to the smallest record_id; a field without a value of a support of `accept` or more gives no row; null and
    empty values claim nothing; repeated rows count once; null ids are left out. Claims of one group, field and set of
    marks are reduced to the longest map-side, so a group that holds a third of all rows costs a row per set of marks.
    """
    rows = rows.dropDuplicates([id])
    groups = works(rows, id, title, doi)
    many = groups.join(groups.groupBy("group_id").agg(F.count("*").alias("c")).where("c > 1").select("group_id"), "group_id", "left_semi")
    claimed = claims(rows, id, abstract, title, score).join(many, "id")
    claimed = _util.cut(claimed.groupBy("group_id", "field", "marks").agg(F.min(F.struct((-F.col("size")).alias("s"), F.col("id"))).alias("b")))
    used = sets_of_marks(claimed)
    trust = discover(claimed, used)
    best = claimed.withColumn("support", F.try_element_at(_supports(used, trust), F.col("marks"))).where(F.col("support") >= accept)
    best = best.groupBy("group_id", "field").agg(F.min(F.struct((-F.col("support")).alias("v"), F.col("b.s"), F.col("b.id"))).alias("b"))
    return best.select(F.col("group_id").alias("group_record_id"), "field", F.col("b.id").alias("record_id"))


_util.by_value(sys.modules[__name__])
