"""The queries over the nine problems, each over its whole tables with production parameters."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citeloom.llm import leakage, linkage, names, neighbours, packing, reading, refine, survivor, textforms

#: The folder of the public tokenizers' vocabulary files.
TOKENIZERS = os.environ.get("CITELOOM_TOKENIZERS", "/opt/tokenizers")

FIELDS = ["faculty_heading", "title", "raw_citation"]


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _matched(spark: SparkSession, sf: str) -> DataFrame:
    return _table(spark, sf, "publication_resolution").where("match_status = 'matched'")


def p1_found(spark: SparkSession, sf: str) -> DataFrame:
    """Names that spell a roster person otherwise than the roster does, with the person."""
    t = lambda n: _table(spark, sf, n)
    return names.found(t("publication_candidates"), t("publication_resolution"), t("article_faculty_attributions"), t("faculty_registry"))


def p2_matches(spark: SparkSession, sf: str) -> DataFrame:
    """Candidates without a matched row beside matched rows that may be the same work, with the confidence."""
    m = linkage.matches(_table(spark, sf, "publication_candidates"), _table(spark, sf, "publication_resolution"))
    return m.withColumn("confidence", F.round("confidence", 6))


def p2_found(spark: SparkSession, sf: str) -> DataFrame:
    """The pairs of p2_matches with a marginal probability of one half or more."""
    return p2_matches(spark, sf).where("confidence >= 0.5").select("candidate_record_id", "resolution_record_id")


def p3_found(spark: SparkSession, sf: str) -> DataFrame:
    """Titles (and dois) that differ in formatting only: each further copy beside the first."""
    c = refine.copy_pairs(_table(spark, sf, "publication_candidates"), "record_id", "title")
    r = refine.copy_pairs(_matched(spark, sf), "record_id", "canonical_title", refine.doi_key(F.col("doi")))
    tag = lambda d, t: d.select(F.lit(t).alias("table_name"), "record_id", "copy_record_id")
    return tag(c, "publication_candidates").unionByName(tag(r, "publication_resolution"))


def p3_copies(spark: SparkSession, sf: str) -> DataFrame:
    """One record per title of candidates, and per title and doi of matched rows, with its number of copies."""
    c = refine.counted(_table(spark, sf, "publication_candidates"), "record_id", "title")
    r = refine.counted(_matched(spark, sf), "record_id", "canonical_title", refine.doi_key(F.col("doi")))
    tag = lambda d, t: d.select(F.lit(t).alias("table_name"), "record_id", "n_copies")
    return tag(c, "publication_candidates").unionByName(tag(r, "publication_resolution"))


def p4_found(spark: SparkSession, sf: str) -> DataFrame:
    """For each work with several matched rows, the row whose value of each field survives."""
    return survivor.survivors(_matched(spark, sf), "record_id", "canonical_title", "doi", "abstract", "match_score")


def p5_found(spark: SparkSession, sf: str) -> DataFrame:
    """Pairs of articles of which one is among the five most similar of the other."""
    return neighbours.neighbour_pairs(_table(spark, sf, "cluster_publications"), "record_id", "embedding", 5)


def p6_found(spark: SparkSession, sf: str) -> DataFrame:
    """Stored texts that look ordinary but hold other characters."""
    return textforms.odd_characters(_table(spark, sf, "publication_candidates"), "record_id", FIELDS)


def p6_canonical(spark: SparkSession, sf: str) -> DataFrame:
    """All three texts of every candidate in their one consistent form."""
    long = textforms.long_fields(_table(spark, sf, "publication_candidates"), "record_id", FIELDS)
    return textforms.canonical_text(long, "text", "canonical").select("record_id", "field", "canonical")


def p7_packing(spark: SparkSession, sf: str) -> DataFrame:
    """Every document assigned to containers of every size."""
    counts = packing.token_counts(_table(spark, sf, "documents"), "doc_id", "text", f"{TOKENIZERS}/byte_bpe_50k.tiktoken")
    return packing.pack(counts, _table(spark, sf, "container_sizes"))


def p8_leaks(spark: SparkSession, sf: str) -> DataFrame:
    """Documents with leaked items, the longest run found and how many of its words are equal."""
    return leakage.leaks(_table(spark, sf, "documents"), _table(spark, sf, "heldout_items"))


def p8_found(spark: SparkSession, sf: str) -> DataFrame:
    """Documents with the items that leaked into them."""
    return p8_leaks(spark, sf).select("doc_id", "item_id")


def p9_levels(spark: SparkSession, sf: str) -> DataFrame:
    """The level of every English document, rated or not."""
    return reading.reading_levels(_table(spark, sf, "documents").where("lang = 'en'"), _table(spark, sf, "reading_labels"))


def p9_found(spark: SparkSession, sf: str) -> DataFrame:
    """The level of every English document of 60 words or more that nobody rated."""
    rated = _table(spark, sf, "reading_labels").select("doc_id").distinct()
    return p9_levels(spark, sf).where("n_words >= 60").join(rated, "doc_id", "left_anti").select("doc_id", "level")


QUERIES = [p1_found, p2_found, p2_matches, p3_found, p3_copies, p4_found, p5_found, p6_found, p6_canonical, p7_packing, p8_found, p8_leaks, p9_found, p9_levels]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in QUERIES}


def _same_form_sql(col: str) -> str:
    """The look-alike mapping in SQL, for keys: letters of other scripts are mapped in every word, which groups the same."""
    pairs = textforms.STYLED_ONE | textforms.ALIKE_MAP
    quote = lambda s: s.replace("'", "''")
    x = f"regexp_replace({col}, '[{textforms.INVISIBLE}]', '', 'g')"
    for a, b in textforms.STYLED_MORE.items():
        x = f"replace({x}, '{a}', '{b}')"
    return f"nfc_normalize(translate({x}, '{quote(''.join(pairs))}', '{quote(''.join(pairs.values()))}'))"


def _p3_sql() -> str:
    bag = lambda c: f"array_to_string(list_sort(list_filter(regexp_split_to_array(lower({_same_form_sql(c)}), '[^\\p{{L}}\\p{{N}}]+'), lambda w: w <> '')), ' ')"
    bare = "lower(regexp_replace(doi, '\\s+', '', 'g'))"
    doi = f"nullif(regexp_replace(CASE WHEN regexp_matches({bare}, '10[.][0-9]{{4,}}/') THEN regexp_extract({bare}, '10[.][0-9]{{4,}}/.*') ELSE regexp_replace({bare}, '^(https?://[^/]+/|doi:?)', '') END, '[^\\p{{L}}\\p{{N}}]+', '', 'g'), '')"
    pairs = lambda t: f"SELECT '{t}' AS table_name, first AS record_id, record_id AS copy_record_id FROM (SELECT record_id, min(record_id) OVER (PARTITION BY bag, doi) AS first FROM {t[12:]} WHERE bag <> '') WHERE record_id <> first"
    return f"WITH candidates AS (SELECT record_id, {bag('title')} AS bag, NULL AS doi FROM publication_candidates WHERE title IS NOT NULL), resolution AS (SELECT record_id, {bag('canonical_title')} AS bag, {doi} AS doi FROM publication_resolution WHERE match_status = 'matched' AND canonical_title IS NOT NULL) {pairs('publication_candidates')} UNION ALL {pairs('publication_resolution')}"


def oracle_sql() -> dict[str, str]:
    """SQL where it can express the problem: p3 by keys, p6 by classes of characters; the rest is tested by brute force."""
    odd = "\\x{AD}\\x{A0}\\x{200B}-\\x{200F}\\x{2060}-\\x{2064}\\x{FEFF}\\x{1680}\\x{2000}-\\x{200A}\\x{202F}\\x{205F}\\x{3000}\\x{2010}\\x{2011}\\x{2212}\\x{FB00}-\\x{FB06}\\x{FF01}-\\x{FF5E}\\x{1D400}-\\x{1D7FF}\\x{251}\\x{261}"
    alone = "".join(textforms.ALIKE_ALONE)
    parts = []
    for f in FIELDS:
        clean = f"regexp_replace({f}, '[{odd}]', '', 'g')"
        mixed = f"regexp_matches({clean}, '\\p{{Latin}}\\p{{M}}*[\\p{{Cyrillic}}\\p{{Greek}}\\p{{Armenian}}]|[\\p{{Cyrillic}}\\p{{Greek}}\\p{{Armenian}}]\\p{{M}}*\\p{{Latin}}')"
        only = f"regexp_matches({clean}, '(^|[^\\p{{L}}\\p{{M}}])[{alone}]+([^\\p{{L}}\\p{{M}}]|$)') AND NOT regexp_matches({clean}, '(^|[^\\p{{L}}\\p{{M}}])[\\p{{Cyrillic}}\\p{{Greek}}]{{2,}}([^\\p{{L}}\\p{{M}}]|$)')"
        parts.append(f"SELECT record_id, '{f}' AS field FROM publication_candidates WHERE {f} IS NOT NULL AND (regexp_matches({f}, '[{odd}]|\\p{{M}}') OR {mixed} OR ({only}))")
    return {"p3_found": _p3_sql(), "p6_found": " UNION ".join(parts)}
