"""Property graphs over entities: nodes, edges, similarity, neighbourhoods, layout, checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from citeloom.functions.numeric import dot, unit
from citeloom.functions.text import stable_id
from citeloom.operators.keep import top_per_key


def nodes(df: DataFrame, kind: str, id: str, label: str) -> DataFrame:
    return df.groupBy(F.col(id).cast("string").alias("id")).agg(F.min(label).alias("label")).select("id", F.lit(kind).alias("type"), "label")


def edges(df: DataFrame, kind: str, source: str, target: str, *payload: Column) -> DataFrame:
    """Edges with a deterministic id from kind and endpoints."""
    s, t = F.col(source).cast("string"), F.col(target).cast("string")
    return df.select(stable_id("edge_", F.concat_ws(":", F.lit(kind), s, t)).alias("id"), s.alias("source"), t.alias("target"), F.lit(kind).alias("type"), *payload)


def similar_pairs(df: DataFrame, id: str, vector: str, least: float = 0.35, k: int = 10, blend: tuple[str, float] | None = None) -> DataFrame:
    """(source, target, score): upper-triangle pairs at or over a cosine, the k best per source; 6 digits, ties to the greater target.

    For centroid tables (people, topics). Rows are dealt to blocks and each pair of blocks meets once, so no task holds
    more than two blocks. blend: a second vector column and its weight in the score.
    """
    b = F.pmod(F.xxhash64(id), F.lit(16)).cast("int")
    cols = [F.col(id).alias("id"), unit(F.col(vector)).alias("v"), b.alias("b")] + ([unit(F.col(blend[0])).alias("w")] if blend else [])
    t = df.where(F.col(vector).isNotNull()).select(*cols)
    every = F.sequence(F.lit(0), F.lit(15))
    left = t.withColumn("p", F.explode(F.transform(every, lambda x: F.least("b", x) * 16 + F.greatest("b", x))))
    right = left.select(*[F.col(c).alias("r_" + c) for c in left.columns])
    once = F.least("b", "r_b") * 16 + F.greatest("b", "r_b") == F.col("p")
    j = left.join(right, (left["p"] == right["r_p"]) & (left["id"] < right["r_id"])).where(once)
    s = dot(F.col("v"), F.col("r_v"))
    if blend:
        s = (1 - blend[1]) * s + blend[1] * dot(F.col("w"), F.col("r_w"))
    scored = j.select(F.col("id").alias("source"), F.col("r_id").alias("target"), F.round(s, 6).alias("score")).where(F.col("score") >= least)
    return top_per_key(scored, ["source"], [F.desc("score"), F.desc("target")], k)


def related(chosen: DataFrame, items: DataFrame, id: str, topic: str, people: DataFrame, person: str) -> DataFrame:
    """(id, other, shared): all items that share a topic or a person with the chosen ones, and how many of both.

    chosen: a stated set of ids; items: (id, topic) and people: (id, person) of all items. Each side is an equi-join from
    the chosen items' distinct topics or people, so the pairs are those of the chosen set with all items. Null topics and
    people relate nothing.
    """
    c = chosen.select(id).distinct()

    def by(df: DataFrame, column: str) -> DataFrame:
        d = df.where(F.col(column).isNotNull()).select(F.col(id), F.col(column).alias("k")).distinct()
        return d.join(c, id, "left_semi").join(d.select(F.col(id).alias("other"), "k"), "k").where(F.col(id) != F.col("other")).select(id, "other")

    return by(items, topic).unionByName(by(people, person)).groupBy(id, "other").agg(F.count("*").alias("shared"))


def neighbourhood(edge: DataFrame, selected: Column) -> DataFrame:
    """Ids at the ends of edges that touch the selection, with the selection itself."""
    touch = edge.where(selected)
    return touch.select(F.explode(F.array("source", "target")).alias("id")).distinct()


def scaled(df: DataFrame, columns: list[str], pad: float = 0.05) -> DataFrame:
    """Columns scaled to pad..1-pad by their global minimum and maximum; a constant column gives 0.5."""
    lim = df.agg(*[f(c).alias(f"__{n}_{c}") for c in columns for n, f in (("lo", F.min), ("hi", F.max))])
    out = df.crossJoin(F.broadcast(lim))
    for c in columns:
        lo, hi = F.col(f"__lo_{c}"), F.col(f"__hi_{c}")
        out = out.withColumn(c, F.when(F.col(c).isNotNull(), F.round(F.coalesce(pad + (1 - 2 * pad) * F.try_divide(F.col(c) - lo, hi - lo), F.lit(0.5)), 6)))
    return out.drop(*lim.columns)


def ring(df: DataFrame, group: str, order: str, radius: float = 1.0) -> DataFrame:
    """Positions of a group's members on a circle, by rank."""
    w = Window.partitionBy(group)
    a = 2 * F.pi() * (F.row_number().over(w.orderBy(order)) - 1) / F.count("*").over(w)
    return df.withColumn("px", F.round(radius * F.cos(a), 6)).withColumn("py", F.round(radius * F.sin(a), 6))


def coauthors(pairs: DataFrame, person: str, work: str) -> DataFrame:
    """An extension: people who share works, with their number. Works with very many people are split by the join's skew handling."""
    p = pairs.select(person, work).distinct()
    j = p.select(F.col(person).alias("source"), work).join(p.select(F.col(person).alias("target"), work), work)
    return j.where("source < target").groupBy("source", "target").agg(F.count("*").alias("n_works"))


def dangling(node: DataFrame, edge: DataFrame) -> DataFrame:
    """Edges an endpoint of which is no node."""
    ids = node.select("id").distinct()
    bad_source = edge.join(ids, edge["source"] == ids["id"], "left_anti")
    bad_target = edge.join(ids, edge["target"] == ids["id"], "left_anti")
    return bad_source.unionByName(bad_target).distinct()


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n_rows")).where("n_rows > 1")


def validation(node: DataFrame, edge: DataFrame) -> DataFrame:
    """(check_name, n_bad): one row per invariant; all must be 0."""
    return (
        duplicate_keys(node, ["id"]).agg(F.count("*").alias("n_bad")).select(F.lit("unique_node_ids").alias("check_name"), "n_bad")
        .unionByName(duplicate_keys(edge, ["id"]).agg(F.count("*").alias("n_bad")).select(F.lit("unique_edge_ids").alias("check_name"), "n_bad"))
        .unionByName(dangling(node, edge).agg(F.count("*").alias("n_bad")).select(F.lit("no_dangling_edges").alias("check_name"), "n_bad"))
        .unionByName(node.agg(F.count_if(F.coalesce(F.trim("label"), F.lit("")) == "").alias("n_bad")).select(F.lit("labels_present").alias("check_name"), "n_bad"))
    )


def require(checks: DataFrame) -> None:
    """Raise if a check of validation() found anything."""
    bad = checks.where("n_bad > 0").collect()
    if bad:
        raise ValueError("; ".join(f"{r.check_name}: {r.n_bad}" for r in bad))
