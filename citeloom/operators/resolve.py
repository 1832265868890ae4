"""Resolving citations against a catalogue by fuzzy titles, without comparing all pairs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from citeloom.functions.similarity import containment, jaccard, sequence_ratio, token_set, year_adjusted
from citeloom.functions.text import normalized_title
from citeloom.operators.keep import top_per_key, with_runner_up


#: What a score has beside the words' part at most: half a sequence ratio of 1, a near year, and the rounding to 4 digits.
BESIDE = 0.5 + 0.04 + 1e-4


def _reach(shared: Column, nq: Column, nc: Column, lq: Column, lc: Column) -> Column:
    """The highest score of a pair with so many shared words, words and letters."""
    return 0.3 * shared / (nq + nc - shared) + 0.2 * shared / nq + F.least(lq, lc) / (lq + lc) + F.lit(BESIDE - 0.5)


def _profiles(titles: DataFrame) -> DataFrame:
    """(h, n, l, lo, hi, ws) of distinct normalised titles (t): hash, words, letters, 128 bits of the words, their hashes."""
    ws = F.transform(token_set(F.col("t")), lambda w: F.xxhash64(w))
    bits = lambda first: F.aggregate("ws", F.lit(0).cast("long"), lambda a, w: a.bitwiseOR(F.when(F.pmod(w, F.lit(128)).between(first, first + 63), F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(w, F.lit(64)).cast("int"))).otherwise(F.lit(0).cast("long"))))
    return titles.select(F.xxhash64("t").alias("h"), F.char_length("t").alias("l"), ws.alias("ws")).withColumns({"n": F.size("ws"), "lo": bits(0), "hi": bits(64)})


def title_pairs(queries: DataFrame, catalogue: DataFrame, floor: float) -> DataFrame:
    """(q, c): hashes of all pairs of distinct normalised titles (column t) that can reach a score, and some others.

    An exact prefix filter. To reach the floor the words' part must give floor - BESIDE, for which a share of the words
    of either title must be in the other; so the first word that two titles have in common, in the order from the
    catalogue's rarest to its most frequent, is among the first of each. Postings carry what bounds the score by the number
    of words, letters and the places of the common word, and pairs beyond it never leave the join. With a floor that
    titles without a common word can reach, all pairs come out.
    """
    q, c = _profiles(queries), _profiles(catalogue)
    least = floor - BESIDE
    if least <= 0:
        return q.select(F.col("h").alias("q")).crossJoin(c.select(F.col("h").alias("c")))
    held = c.select(F.explode("ws").alias("w")).groupBy("w").agg(F.count("*").alias("f"))

    def postings(titles: DataFrame, share: float, side: str) -> DataFrame:
        words = titles.select("h", "n", "l", "lo", "hi", F.explode("ws").alias("w")).join(held, "w", "left")
        first = F.col("n") - F.greatest(F.ceil(F.col("n") * share - 1e-9), F.lit(1)) + 1
        rank = F.row_number().over(Window.partitionBy("h").orderBy(F.coalesce("f", F.lit(0)), "w"))
        kept = words.withColumn("at", rank).where((F.col("at") <= first) & F.col("f").isNotNull())
        return kept.select("w", *[F.col(x).alias(side + x) for x in ("h", "n", "l", "lo", "hi", "at")])

    # all words of a query may be in the title (Jaccard alone is lost to its length), or none of its own be left over
    left, right = postings(q, least / 0.5, "q_"), postings(c, (least - 0.2) / 0.3, "c_")
    tasks = 4 * int(q.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    x = F.col
    lost = lambda a, b: sum(F.bit_count(x(a + s).bitwiseAND(F.bitwise_not(x(b + s)))) for s in ("lo", "hi"))
    reach = lambda shared: _reach(shared, x("q_n"), x("c_n"), x("q_l"), x("c_l")) >= floor
    # the places of the common word settle most pairs, before bits are counted
    near = reach(F.least(x("q_n") - x("q_at") + 1, x("c_n") - x("c_at") + 1)) & reach(F.least(x("q_n") - lost("q_", "c_"), x("c_n") - lost("c_", "q_")))
    j = left.repartition(tasks, "w").join(right.repartition(tasks, "w"), "w").where(near)
    return j.select(x("q_h").alias("q"), x("c_h").alias("c")).distinct()


def scored(queries: DataFrame, catalogue: DataFrame, query_id: str, query: str, id: str, title: str, query_year: str | None = None, year: str | None = None, floor: float = 0.0) -> DataFrame:
    """(query_id, id, score) of the candidate pairs: title score with the year adjustment where both years are given.

    floor: all pairs that reach this score come out; pairs that cannot are left out before the sequence ratio is computed,
    by title_pairs() and the exact words' part. Equal titles are compared once, whatever their years; the year
    adjustment then meets every row.
    """
    q = queries.select(F.col(query_id).alias("query_id"), normalized_title(F.col(query)).alias("t"), (F.col(query_year) if query_year else F.lit(None)).cast("int").alias("qy")).where("t <> ''")
    c = catalogue.select(F.col(id).alias("id"), normalized_title(F.col(title)).alias("t"), (F.col(year) if year else F.lit(None)).cast("int").alias("y")).where("t <> ''")
    tq, tc = q.select("t").distinct(), c.select("t").distinct()
    text = lambda d, h, name: d.select(F.xxhash64("t").alias(h), F.col("t").alias(name))
    p = title_pairs(tq, tc, floor).join(text(tq, "q", "a"), "q").join(text(tc, "c", "b"), "c")
    p = p.withColumn("by_words", 0.3 * jaccard(token_set(F.col("a")), token_set(F.col("b"))) + 0.2 * containment(token_set(F.col("a")), token_set(F.col("b"))))
    la, lb = F.char_length("a"), F.char_length("b")
    p = p.where(F.col("by_words") + F.least(la, lb) / (la + lb) + F.lit(BESIDE - 0.5) >= floor)
    p = p.select("q", "c", F.round(0.5 * sequence_ratio(F.col("a"), F.col("b")) + F.col("by_words"), 4).alias("s")).where(F.col("s") + 0.04 + 1e-9 >= floor)
    rows = p.join(q.select(F.xxhash64("t").alias("q"), "query_id", "qy"), "q").join(c.select(F.xxhash64("t").alias("c"), "id", "y"), "c")
    return rows.select("query_id", "id", year_adjusted(F.col("s"), F.col("qy"), F.col("y")).alias("score"))


def nearest(queries: DataFrame, catalogue: DataFrame, scale: float, digits: int, least: float) -> DataFrame:
    """(query_id, id, score): for each row of queries (query_id, k, x), two pairs that stand for all with catalogue rows (id, k, x) of its k.

    The score is 1 - distance of the two x / scale, rounded half-up. Of the pairs of a row come out the first, ties to the
    smaller id, and one with the runner-up's score and the first's id, so best() and unambiguous() of them are those of all
    pairs, also where a query_id has several rows. A first under `least` may be another one of its ties. Rows without k or
    x have no pairs.

    Distinct x of each k are sorted, so the pairs are never formed. The two nearest on either side of an x have the two
    highest scores, as the score falls with the distance; ids are sought in the width of one rounded score beyond them.
    A k's distinct x of the catalogue pass one task, those of the queries are spread over slices. NaN and infinite x,
    at most three of each k, meet every x of their k.
    """
    given, finite = "k is not null and x is not null", F.abs("x") < float("inf")  # NaN is not under infinity
    # scaled before rounding as DuckDB does; round(x, digits) here would round the shortest decimal form of x
    score = lambda y: F.round((1 - F.abs(F.col("x") - y) / scale) * 10**digits) / 10**digits
    q = queries.where(given).select("k", "x").distinct()
    c = catalogue.where(given).groupBy("k", "x").agg(F.min("id").alias("id"), (F.count("*") > 1).alias("twice"))
    reach = 1.01 * scale / 10**digits
    cell = lambda y, width=reach: F.floor(y / width)
    slice_ = cell(F.col("x"), 32 * reach).alias("slice")

    # a row below all others holds the first two of its k
    row, by = F.struct(F.col("x").alias("y"), "id", "twice"), Window.partitionBy("k").orderBy("x")
    listed = c.where(finite).select("k", "x", row.alias("row"))
    listed = listed.unionByName(listed.select("k").distinct().withColumn("x", F.lit(float("-inf"))), allowMissingColumns=True)
    held = listed.select("k", "x", slice_, F.array(F.lag("row").over(by), "row", F.lead("row").over(by), F.lead("row", 2).over(by)).alias("around"), F.lit(0).alias("side"))

    def met(seen: DataFrame, asked: DataFrame, *keys: str) -> DataFrame:
        """Rows asked for, with what is around the last row seen at or under their x."""
        w = Window.partitionBy(*keys).orderBy("x", "side").rowsBetween(Window.unboundedPreceding, 0)
        both = seen.unionByName(asked.withColumn("side", F.lit(1)), allowMissingColumns=True)
        return both.withColumn("around", F.last("around", True).over(w)).where("side = 1 and around is not null")

    asked = q.where(finite).select("k", "x", slice_)
    starts = met(held, asked.groupBy("k", "slice").agg(F.min("x").alias("x")), "k").withColumn("side", F.lit(0))
    m = met(held.unionByName(starts), asked, "k", "slice")
    at = [F.get("around", F.lit(i)) for i in range(4)]
    m = m.select("k", "x", "around", *[score(a["y"]).alias(f"s{i}") for i, a in enumerate(at)])
    scores = F.sort_array(F.array(*[f"s{i}" for i in range(4)], *[F.when(a["twice"], F.col(f"s{i}")) for i, a in enumerate(at)]), False)  # nulls last
    m = m.withColumn("scores", F.slice(scores, 1, 2)).withColumn("s", F.greatest(*[f"s{i}" for i in range(4)]))
    m = m.withColumn("id", F.least(*[F.when(F.col(f"s{i}") == F.col("s"), a["id"]) for i, a in enumerate(at)]))

    # the outer ones tie too: so may some beyond them
    beyond = lambda i, step: F.when(F.col(f"s{i}") == F.col("s"), F.array(cell(at[i]["y"]), cell(at[i]["y"]) + step)).otherwise(F.array().cast("array<bigint>"))
    wide = m.where(F.col("s") >= least).select("k", "x", "scores", F.explode(F.array_distinct(F.concat(beyond(0, -1), beyond(3, 1)))).alias("cell"))
    ties = wide.join(c.where(finite).select("k", cell(F.col("x")).alias("cell"), F.col("x").alias("y"), "id"), ["k", "cell"]).where(score(F.col("y")) == F.col("scores")[0])
    firsts = m.select("k", "x", "scores", "id").unionByName(ties.select("k", "x", "scores", "id")).groupBy("k", "x", "scores").agg(F.min("id").alias("id"))
    pairs = firsts.select("k", "x", "id", F.explode(F.array_compact("scores")).alias("score"))

    every = lambda a, b: a.join(b.withColumnRenamed("x", "y"), "k").select("k", "x", "id", score(F.col("y")).alias("score"), F.explode(F.when(F.col("twice"), F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy"))
    odd = every(q, c.where(~finite)).unionByName(every(q.where(~finite), c.where(finite)))
    odd = top_per_key(odd, ["k", "x"], [F.desc("score"), F.asc_nulls_last("id")], 2)
    return queries.join(pairs.unionByName(odd.drop("copy")), ["k", "x"]).select("query_id", "id", "score")


def best(pairs: DataFrame, least: float = 0.86) -> DataFrame:
    """The best catalogue row of each query at or over a score, ties to the smaller id."""
    return with_runner_up(pairs, ["query_id"], "score", "id").where(F.col("score") >= least)


def unambiguous(pairs: DataFrame, least: float = 0.88, alone: float = 0.96, gap: float = 0.04) -> DataFrame:
    """best(), but only if the score is `alone` or more, or leads the runner-up by `gap`."""
    b = with_runner_up(pairs, ["query_id"], "score", "id").where(F.col("score") >= least)
    return b.where((F.col("score") >= alone) | (F.round(F.col("score") - F.col("runner_up"), 6) >= gap))


def word_overlap(pairs: DataFrame, left: str, right: str) -> DataFrame:
    """Pairs with shared and total words of two normalised titles."""
    a, b = token_set(F.col(left)), token_set(F.col(right))
    return pairs.withColumn("n_shared", F.size(F.array_intersect(a, b)).cast("long")).withColumn("n_words", F.size(F.array_union(a, b)).cast("long"))
