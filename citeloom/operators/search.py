"""Keyword search and vector top-k."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citeloom.functions.numeric import dot, unit
from citeloom.functions.text import collapse, inverted_text
from citeloom.operators.keep import top_per_key


def documents(df: DataFrame, kind: str, id: str, title: Column, *text: Column) -> DataFrame:
    """Search documents (entity_type, entity_id, title, text)."""
    return df.select(F.lit(kind).alias("entity_type"), F.col(id).cast("string").alias("entity_id"), title.alias("title"), F.lower(F.concat_ws(" ", title, *text)).alias("text"))


def inverted_index(df: DataFrame, id: str, text: str) -> DataFrame:
    """(id, word, positions) of every text's words as they are written; null and blank texts have none."""
    words = df.select(id, F.posexplode(F.split(collapse(F.col(text)), " ")).alias("p", "word")).where("word <> ''")
    return words.groupBy(id, "word").agg(F.array_sort(F.collect_list("p")).alias("positions"))


def indexed_texts(index: DataFrame, id: str) -> DataFrame:
    """(id, text): the texts of an inverted index."""
    words = index.groupBy(id).agg(F.map_from_entries(F.collect_list(F.struct("word", "positions"))).alias("m"))
    return words.select(id, inverted_text(F.col("m")).alias("text"))


def keyword(docs: DataFrame, query: str, boosts: dict[str, int] | None = None, k: int = 12) -> DataFrame:
    """The k best documents: how many of the query's words they contain, plus a boost by entity type for any hit.

    Ties go by title, then id. Queries of fewer than two letters find nothing.
    """
    words = [w for w in query.lower().split() if w] if len(query.strip()) >= 2 else []
    if not words:
        return docs.limit(0).select("entity_type", "entity_id", "title", F.lit(0).cast("long").alias("score"))
    hits = sum((F.col("text").contains(w).cast("long") for w in words), F.lit(0).cast("long"))
    boost = F.lit(0)
    for kind, v in (boosts or {}).items():
        boost = F.when(F.col("entity_type") == kind, v).otherwise(boost)
    scored = docs.withColumn("h", hits).where("h > 0").withColumn("score", F.col("h") + boost)
    return scored.orderBy(F.desc("score"), "title", "entity_id").limit(k).select("entity_type", "entity_id", "title", "score")


def vector_topk(queries: DataFrame, index: DataFrame, query_id: str, id: str, vector: str, k: int = 5, kind: str | None = None) -> DataFrame:
    """(query_id, [kind], id, score, rank): the k index rows with the highest cosine per query (and kind), ties to the greater id.

    The queries are a stated set; they are broadcast only if few enough that their vectors stay under 32 MB, else the
    planner joins blocks. The planner limits every partition to k rows per query before the shuffle.
    """
    q = queries.select(F.col(query_id).alias("query_id"), unit(F.col(vector)).alias("qv"))
    dims = index.select(F.size(vector)).first()
    small = q.count() * 8 * max(1, dims[0] if dims else 1) <= 32 << 20
    i = index.where(F.col(vector).isNotNull()).select(*([kind] if kind else []), F.col(id).alias("id"), unit(F.col(vector)).alias("v"))
    scored = i.crossJoin(F.broadcast(q) if small else q).withColumn("score", F.round(dot(F.col("v"), F.col("qv")), 6))
    keys = ["query_id", kind] if kind else ["query_id"]
    return top_per_key(scored, keys, [F.desc("score"), F.desc("id")], k, "rank").select(*keys, "id", "score", F.col("rank").cast("long").alias("rank"))
