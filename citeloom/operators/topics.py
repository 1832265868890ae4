"""Topics: class-based TF-IDF, labels, summaries, representatives, clustering."""

from __future__ import annotations

from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from citeloom.functions.numeric import unit
from citeloom.functions.text import display_term
from citeloom.operators.keep import top_per_key

# Words too general for a label, and acronyms.
GENERIC = "analysis data effect effects evidence model models policy research study theory using countries program".split()
ACRONYMS = "aca bmi chip covid iq lgb lgbtq medicaid ppe sat scd snap".split()


def terms(text: Column, stop: list[str]) -> Column:
    """Lower-case words of two letters or digits and more, without stop words."""
    words = F.regexp_extract_all(F.lower(text), F.lit("([a-z0-9]{2,})"), F.lit(1))
    return F.filter(words, lambda w: ~w.isin(stop)) if stop else words


def with_bigrams(words: Column) -> Column:
    pairs = F.zip_with(F.slice(words, F.lit(1), F.greatest(F.size(words) - 1, F.lit(0))), F.slice(words, F.lit(2), F.greatest(F.size(words) - 1, F.lit(0))), lambda a, b: F.concat_ws(" ", a, b))
    return F.concat(words, pairs)


def ctfidf(docs: DataFrame, topic: str, text: str, stop: list[str] | None = None, bigrams: bool = True, k: int = 15) -> DataFrame:
    """(topic, term, weight, rank): the k heaviest terms, L1 term frequency times ln((1 + T) / (1 + df)) + 1, 6 digits.

    Terms are counted map-side per (topic, term) before anything is joined; ties go to the smaller term.
    """
    words = terms(F.col(text), stop or [])
    counts = docs.select(topic, F.explode(with_bigrams(words) if bigrams else words).alias("term")).groupBy(topic, "term").agg(F.count("*").alias("n"))
    size = counts.groupBy(topic).agg(F.sum("n").alias("total"))
    df = counts.groupBy("term").agg(F.count("*").alias("df"))
    n_topics = size.agg(F.count("*").alias("t"))
    w = F.round(F.col("n") / F.col("total") * (F.log((1.0 + F.col("t")) / (1.0 + F.col("df"))) + 1.0), 6)
    weighed = counts.join(size, topic).join(df, "term").crossJoin(F.broadcast(n_topics)).withColumn("weight", w)
    return top_per_key(weighed.where("weight > 0"), [topic], [F.desc("weight"), F.asc("term")], k, "rank").select(topic, "term", "weight", F.col("rank").cast("long").alias("rank"))


def label(terms_: Column, topic: Column, n: int = 3) -> Column:
    """Up to n terms that are neither general nor parts of one another, in display form, else 'Topic id'."""
    fresh = lambda kept, t: ~F.exists(kept, lambda k: (F.size(F.array_except(F.split(t, " "), F.split(k, " "))) == 0) | (F.size(F.array_except(F.split(k, " "), F.split(t, " "))) == 0))
    kept = F.aggregate(terms_, F.array().cast("array<string>"), lambda acc, t: F.when((F.size(acc) < n) & ~F.lower(t).isin(GENERIC) & fresh(acc, F.lower(t)), F.concat(acc, F.array(F.lower(t)))).otherwise(acc))
    shown = F.when(F.size(kept) > 0, kept).when(F.size(terms_) > 0, F.slice(terms_, 1, n)).otherwise(F.array(F.concat(F.lit("Topic "), topic.cast("string"))))
    return F.array_join(F.transform(shown, lambda t: display_term(t, ACRONYMS)), " • ")


def labelled(topics: DataFrame, topic: str, term_list: str) -> DataFrame:
    """(topic, label, description): labels are unique, a later user of a label gets its id."""
    one = topics.withColumn("label", label(F.col(term_list), F.col(topic)))
    again = F.row_number().over(Window.partitionBy("label").orderBy(topic)) > 1
    text = F.concat(F.lit("Research cluster characterized by "), F.array_join(F.slice(term_list, 1, 8), ", "), F.lit("."))
    return one.select(topic, F.when(again, F.concat("label", F.lit(" ("), F.col(topic).cast("string"), F.lit(")"))).otherwise(F.col("label")).alias("label"), text.alias("description"))


def summary(rows: DataFrame, who: str, topic: str, work: str, probability: str, title: str) -> DataFrame:
    """Per (who, topic): distinct works, mean probability (10 digits, so that no tie depends on the order of adding), share of who's works, and the top three titles."""
    n = rows.groupBy(who, topic).agg(F.count_distinct(work).alias("n_works"), F.round(F.avg(probability), 10).alias("mean_probability"))
    total = rows.groupBy(who).agg(F.count_distinct(work).alias("total"))
    best = rows.where(F.col(title).isNotNull()).groupBy(who, topic, title).agg(F.max(F.coalesce(F.col(probability), F.lit(-1.0))).alias("p"))
    top = top_per_key(best, [who, topic], [F.desc("p"), F.asc(title)], 3, "r").groupBy(who, topic).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("r", title))), lambda s: s[title]), " | ").alias("top_titles"))
    return n.join(total, who).join(top, [who, topic], "left").withColumn("share", F.round(F.col("n_works") / F.col("total"), 4)).drop("total")


def centroids(df: DataFrame, by: str, vector: str) -> DataFrame:
    """(by, centroid): the mean vector, element by element so that every sum is combined map-side."""
    cells = df.where(F.col(vector).isNotNull()).select(by, F.posexplode(vector).alias("i", "x")).groupBy(by, "i").agg(F.avg(F.col("x").cast("double")).alias("m"))
    return cells.groupBy(by).agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "m"))), lambda s: s["m"]).alias("centroid"))


def representatives(df: DataFrame, by: str, id: str, vector: str, k: int = 5) -> DataFrame:
    """The k rows nearest to their group's centroid by Euclidean distance (6 digits), ties to the smaller id."""
    c = centroids(df, by, vector)
    d = F.round(F.sqrt(F.aggregate(F.zip_with(vector, "centroid", lambda x, y: F.pow(x.cast("double") - y, F.lit(2.0))), F.lit(0.0), lambda s, x: s + x)), 6)
    near = df.where(F.col(vector).isNotNull()).join(c, by).select(by, id, d.alias("distance"))
    return top_per_key(near, [by], [F.asc("distance"), F.asc(id)], k, "rank").select(by, id, "distance", F.col("rank").cast("long").alias("rank"))


def reduce_and_cluster(df: DataFrame, id: str, vector: str, k: int, dims: int = 15, noise: float = 3.0, seed: int = 42) -> DataFrame:
    """(id, topic_id, x, y): PCA and k-means in place of neighbour embedding and density clustering.

    Rows farther from their centre than `noise` times its mean distance get topic_id -1; x and y are the first two
    principal components.
    """
    v = df.where(F.col(vector).isNotNull()).select(id, array_to_vector(unit(F.col(vector))).alias("v"))
    low = PCA(k=dims, inputCol="v", outputCol="low").fit(v).transform(v)
    model = KMeans(k=k, seed=seed, featuresCol="low", predictionCol="topic").fit(low)
    centres = F.array(*[F.array(*[F.lit(float(x)) for x in c]) for c in model.clusterCenters()])
    low = model.transform(low).withColumn("a", vector_to_array("low")).withColumn("c", F.get(centres, "topic"))
    far = low.withColumn("d", F.sqrt(F.aggregate(F.zip_with("a", "c", lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, x: s + x)))
    mean = far.groupBy("topic").agg(F.avg("d").alias("mean_d"))
    return far.join(mean, "topic").select(id, F.when(F.col("d") > noise * F.col("mean_d"), -1).otherwise(F.col("topic")).alias("topic_id"), F.get("a", 0).alias("x"), F.get("a", 1).alias("y"))
