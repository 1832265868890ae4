import datetime
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from citeloom.operators import attribution, extract, graph, impact, keep, people, resolve, review, search, topics
from citeloom.plans import catalogue


def rows(df, *cols):
    return sorted(tuple(r) for r in (df.select(*cols) if cols else df).collect())


def test_h_index_and_summary(spark):
    df = spark.createDataFrame([("a", c) for c in (10, 8, 5, 4, 3)] + [("b", 0)], "who string, c int")
    assert rows(impact.h_index(df, "who", "c"), "who", "h_index") == [("a", 4), ("b", 0)]
    pairs = spark.createDataFrame([("x", "w1"), ("x", "w1"), ("x", "w2"), ("y", "w9")], "who string, work string")
    works = spark.createDataFrame([("w1", 12, 1.0, True), ("w2", 0, None, False), ("w3", 99, 1.0, True)], "work string, citations long, weight double, top boolean")
    r = {x.who: x for x in impact.summary(pairs, works, "who", "work").collect()}
    assert (r["x"].total_citations, r["x"].median_citations, r["x"].top_share, r["x"].h_index, r["x"].i10_index) == (12, 6.0, 0.5, 1, 1)
    assert (r["y"].n_measured, r["y"].coverage_share, r["y"].mean_citations, r["y"].h_index) == (0, 0.0, None, 0)
    assert impact.summary(pairs.limit(0), works, "who", "work").count() == 0


def test_citation_windows(spark):
    w = spark.createDataFrame([([(2022, 2), (2025, 6), (2026, 4)], 20, datetime.date(2026, 8, 6), None, 2020)], "counts array<struct<year:int,n:long>>, cited_by_count long, observed_at date, publication_date date, publication_year int")
    m = impact.work_measures(w).first()
    assert (m.citations_last_2_years, m.citations_last_5_years, m.citation_active_years, m.years_since_earliest_citation, m.recent_citation_share) == (10, 12, 3, 4, 0.5)
    assert not m.is_uncited and m.citations_last_1_year == 4


def test_keep(spark):
    e = spark.createDataFrame([("a", 1, "x"), ("a", 2, "clear"), ("b", 1, "y"), ("b", 1, "y")], "k string, seq int, v string")
    assert rows(keep.latest(e, ["k"], ["seq", "v"])) == [("a", 2, "clear"), ("b", 1, "y")]
    assert rows(keep.fold_log(e, ["k"], ["seq", "v"], F.col("v") == "clear"), "k") == [("b",)]
    old, new = spark.createDataFrame([("1", "Original")], "id string, t string"), spark.createDataFrame([("1", "Again"), ("2", "New"), ("2", "New")], "id string, t string")
    assert rows(keep.merge_append(old, new, "id")) == [("1", "Original"), ("2", "New")]
    once = keep.merge_append(old, new, "id")
    assert rows(keep.merge_append(once, new, "id")) == rows(once)
    assert [r[0] for r in rows(keep.merge_rebuild(old, new, "id"), "id")] == ["1", "2"]
    log = keep.append_snapshots(new.limit(0), new, ["id", "t"])
    assert rows(keep.append_snapshots(log, new, ["id", "t"])) == rows(log)
    base = spark.createDataFrame([("p", "x"), ("p", "y")], "work string, who string")
    over = spark.createDataFrame([("p", "x", "remove", 1), ("q", "z", "add", 1), ("q", "z", "remove", 2), ("q", "z", "add", 3)], "work string, who string, action string, seq int")
    assert rows(keep.apply_overrides(base, over, ["work", "who"], ["seq"])) == [("p", "y"), ("q", "z")]
    g = spark.createDataFrame([("s", 1, "h1"), ("s", 2, None), ("s", 3, "h2"), ("t", 1, None)], "g string, i int, h string")
    assert rows(keep.carry_forward(g, ["g"], ["i"], F.col("h"), "c"), "g", "i", "c")[1] == ("s", 2, "h1")


def test_topics(spark):
    t = spark.createDataFrame([(3, ["urban", "resilience", "cities", "policy"]), (4, []), (5, ["urban", "resilience", "cities"]), (6, ["policy", "covid wave", "wave"])], "topic int, terms array<string>")
    got = {r.topic: r.label for r in topics.labelled(t, "topic", "terms").collect()}
    assert got == {3: "Urban • Resilience • Cities", 4: "Topic 4", 5: "Urban • Resilience • Cities (5)", 6: "COVID Wave"}
    d = spark.createDataFrame([("x", "alpha alpha beta"), ("y", "beta gamma"), ("y", None)], "topic string, text string")
    w = topics.ctfidf(d, "topic", "text", bigrams=False)
    assert [r.term for r in w.where("topic = 'x'").orderBy("rank").collect()] == ["alpha", "beta"]
    v = spark.createDataFrame([(1, 0, [0.0, 0.0]), (2, 0, [2.0, 0.0]), (3, 0, None)], "id int, g int, v array<float>")
    assert topics.centroids(v, "g", "v").first().centroid == [1.0, 0.0]
    assert rows(topics.representatives(v, "g", "id", "v", 1), "id") == [(1,)]


def test_graph_and_search(spark):
    n = spark.createDataFrame([("a", "f", "A"), ("b", "f", "B")], "id string, type string, label string")
    e = spark.createDataFrame([("1", "a", "b", "t"), ("2", "a", "zz", "t")], "id string, source string, target string, type string")
    assert dict(rows(graph.validation(n, e)))["no_dangling_edges"] == 1
    with pytest.raises(ValueError, match="no_dangling_edges"):
        graph.require(graph.validation(n, e))
    v = spark.createDataFrame([(i, [1.0, float(i) / 50]) for i in range(40)], "id int, v array<double>")
    p = graph.similar_pairs(v, "id", "v", least=-1, k=100)
    assert p.count() == 40 * 39 // 2 == p.select("source", "target").distinct().count()
    q = search.vector_topk(v.where("id = 0"), v, "id", "id", "v", 2)
    assert [r.id for r in q.orderBy("rank").collect()] == [0, 1]
    d = spark.createDataFrame([("publication", "1", "Urban heat", "urban heat"), ("faculty", "2", "Ann", "ann urban")], "entity_type string, entity_id string, title string, text string")
    assert [r.entity_id for r in search.keyword(d, "urban heat", {"faculty": 2}).collect()] == ["2", "1"]
    assert search.keyword(d, "u").count() == 0
    s = graph.scaled(spark.createDataFrame([(1.0,), (3.0,), (None,)], "x double"), ["x"])
    assert sorted((r.x for r in s.collect()), key=str) == [0.05, 0.95, None]


def test_resolution(spark):
    q = spark.createDataFrame([("q1", "Measuring the urban heat of small towns"), ("q2", "Nothing like it at all here"), ("q3", None)], "q string, t string")
    c = spark.createDataFrame([("c1", "Measuring the Urban Heat of Small Towns."), ("c2", "Measuring the urban heat of small cities")], "id string, t string")
    full = resolve.scored(q, c, "q", "t", "id", "t")
    assert rows(resolve.best(full), "query_id", "id", "score") == [("q1", "c1", 1.0)]
    assert rows(resolve.best(resolve.scored(q, c, "q", "t", "id", "t", floor=0.86)), "query_id", "id") == [("q1", "c1")]
    p = spark.createDataFrame([("q", "a", 0.93), ("q", "b", 0.91)], "query_id string, id string, score double")
    assert resolve.unambiguous(p).count() == 0


def test_resolution_meets_every_pair_over_the_floor(spark):
    q = spark.createDataFrame([("q1", "Grid reliability among tribal farmworkers of Trealut: results under matching"), ("q2", "Measuring urban heat stress across coastal towns")], "q string, t string")
    more = [(f"c{i}", f"{w} tribal farmworkers of Trealut: results under matching") for i, w in enumerate(("Solar leasing near", "Flood insurance for", "Donor fatigue with"))]
    # c7 shares only runs with q1 that others have too, c8 no run of five words with q2; c6 holds the rare runs of q1
    c = spark.createDataFrame(more + [("c6", "Grid reliability among tribal farmworkers of Trealut"), ("c7", "Grid reliability amnog tribal farmworkers of Trealut: results under matching"), ("c8", "Measuring urban heat stres across coastal towns")], "id string, t string")
    every = resolve.scored(q, c, "q", "t", "id", "t")
    assert every.count() == 12
    over = resolve.scored(q, c, "q", "t", "id", "t", floor=0.86).where("score >= 0.86")
    assert rows(over) == rows(every.where("score >= 0.86"))
    assert rows(resolve.best(over), "query_id", "id") == [("q1", "c7"), ("q2", "c8")]


def _balances(spark, path, customers, suppliers):
    spark.createDataFrame(customers, "c_custkey long, c_nationkey int, c_acctbal double").write.parquet(f"{path}/customer.parquet")
    spark.createDataFrame(suppliers, "s_suppkey long, s_nationkey int, s_acctbal double").write.parquet(f"{path}/supplier.parquet")
    return catalogue.queries()["best_match_margin"](spark, str(path))


def test_best_match_margin_equals_its_sql(spark, tmp_path):
    r = random.Random(3)
    # halves of the last digit, ties on both sides, repeated balances and keys, one supplier alone, no supplier at all
    near = lambda: r.choice([0.0, -0.0, 1.0, 10.0, 12.0, 3000.5, None, float("nan"), float("inf")]) if r.random() < 0.1 else float(r.randrange(-40, 40)) if r.random() < 0.6 else round(r.uniform(-999, 9999), 2)
    customers = [(r.randrange(900) if i % 3 == 0 else 1000 + i, r.choice([None, *range(9)]), near()) for i in range(900)]
    suppliers = [(r.choice([None, r.randrange(90)]) if i % 20 == 0 else 100 + i, r.choice([None, *range(7), 5, 5]), near() if i % 9 else float(i % 80)) for i in range(400)] + [(9, 7, 12.0)]
    got = [tuple(x) for x in _balances(spark, tmp_path, customers, suppliers).select("query_id", "id", "score", "runner_up").collect()]
    con = duckdb.connect()
    for name in ("customer", "supplier"):
        con.execute(f"create view {name} as select * from '{tmp_path}/{name}.parquet/*.parquet'")
    want = con.execute(f"select query_id, id, score, runner_up from ({catalogue.oracle_sql()['best_match_margin']})").fetchall()
    assert len(want) > 300 and sorted(map(repr, got)) == sorted(map(repr, want))


def test_best_match_margin_rounds_halves_as_its_sql(spark, tmp_path):
    # the score before rounding is 0.9934499999999999, and 9934.5 times 10,000
    assert rows(_balances(spark, tmp_path, [(1, 0, 549.97)], [(1, 0, 680.97)]), "score") == [(0.9935,)]


def test_best_match_margin_forms_no_product(spark, tmp_path):
    n = 2000
    d = _balances(spark, tmp_path, [(i, 0, i * 7919 % 999_983 / 100) for i in range(n)], [(i, 0, i * 104_729 % 999_983 / 100) for i in range(n)])

    def most(plan):
        kind, m = plan.getClass().getSimpleName(), plan.metrics().get("numOutputRows")
        below = [plan.executedPlan()] if kind == "AdaptiveSparkPlanExec" else [plan.plan()] if kind.endswith("QueryStageExec") else [plan.children().apply(i) for i in range(plan.children().size())]
        return max([m.get().value() if m.isDefined() else 0, *map(most, below)])

    assert len(d.collect()) > n // 2
    assert n <= most(d._jdf.queryExecution().executedPlan()) <= 10 * n


def test_fuzzy_resolve_meets_every_year_of_a_title(spark, tmp_path):
    spark.createDataFrame([("q1", "Measuring the urban heat of small towns", 2001), ("q2", "Toward food sovereignty with bilingual households", 2001)], "record_id string, title string, report_year int").write.parquet(f"{tmp_path}/publication_candidates.parquet")
    c = [("r1", "Measuring the urban heat of small towns", 1990), ("r2", "Measuring the Urban Heat of Small Towns", 2001), ("r3", "Toward food sovereignty with bilingual household", 1990), ("r4", "Toward food sovereignty with bilingual household", None), ("r5", "Toward food sovereignty with bilingual household", 2002)]
    spark.createDataFrame([(*r, "matched") for r in c], "record_id string, canonical_title string, publication_year int, match_status string").write.parquet(f"{tmp_path}/publication_resolution.parquet")
    got = rows(catalogue.queries()["fuzzy_resolve"](spark, str(tmp_path)), "query_id", "id")
    # with the year of r1 alone q1 has a lower score, with that of r3 alone q2 has no match
    assert got == [("q1", "r2"), ("q2", "r5")]


def test_people(spark):
    h = spark.createDataFrame([("Ann Lee", 2001, "r1"), ("ANN LEE", 2002, "dm"), ("Ann Lee", 2001, "r1"), ("Books", 2001, "r1"), (None, 1, "r")], "n string, y int, s string")
    r = people.roster(h, "n", "y", "s", F.col("s") == "dm").collect()
    assert [(x.name, x.years, x.n_rows) for x in r] == [("ANN LEE", "2001;2002", 3)]
    roster = spark.createDataFrame([("f1", "Jane Q. Smith", None, ""), ("f2", "John R. Smith", None, ""), ("f3", "Ada Byron", "A. Byron", "2001;2002")], "id string, n string, a string, y string")
    c = spark.createDataFrame([("1", "Smith, J. (2001). T.", 2001), ("2", "Byron, A. and Smith, Jane Q. (2001). T.", 2001), ("3", "Byron, A. (2001). T.", 1999), ("4", None, 2000)], "id string, c string, y int")
    got = rows(people.citation_authors(c, "id", "c", "y", roster.withColumnRenamed("id", "p"), "p", "n", "a", "y"), "id", "p", "basis")
    assert got == [("2", "f1", "citation_full_name"), ("2", "f3", "citation_full_name")]
    a = spark.createDataFrame([("a1", "Ada Byron", None, "0000-0002-1825-0097", [], []), ("a2", "Ada Byron", None, "0000-0001-5109-3700", [], []), ("a3", "J. Smith", None, None, [], [])], "authorship_id string, name string, author_id string, orcid string, institutions array<string>, years array<string>")
    p = spark.createDataFrame([("f3", ["Ada Byron"], "0000-0002-1825-0097", [], [], []), ("f1", ["Jane Smith"], None, [], [], []), ("f2", ["John Smith"], None, [], [], [])], "person_id string, aliases array<string>, orcid string, author_ids array<string>, institutions array<string>, years array<string>")
    d = {r.authorship_id: r for r in people.decide(a, p).collect()}
    assert (d["a1"].status, d["a1"].rule, d["a1"].confidence) == ("matched", "curated_orcid", 0.999)
    assert d["a2"].status == "unmatched" and d["a3"].status == "ambiguous"
    local = spark.createDataFrame([("w", "f1", "owner", 0.9)], "work_id string, person_id string, basis string, confidence double")
    ext = spark.createDataFrame([("w", "f2", "external", 0.99)], local.schema)
    assert rows(people.merge_evidence(local, ext, ext), "person_id") == [("f2",)]
    assert rows(people.merge_evidence(local, ext.limit(0), ext.limit(0)), "person_id") == [("f1",)]


def test_attribution_end_to_end(spark):
    """Every rule decides somewhere, spellings are learned, and a shared name is ambiguous."""
    import json

    author = lambda name, id=None, orcid=None, inst=(): {"author": {"id": id, "display_name": name, "orcid": orcid}, "institutions": [{"id": i} for i in inst]}
    lists = {
        "r1": [author("Ada Byron", "A1", None, ["I1"]), author("Bo Ray")], "r2": [author("Ada Byron", "A1", None, ["I1"])], "r3": [author("Ada Bryon", "A1")], "r4": [author("Ada Byron", None, None, ["I1"])], "r5": [author("Ada Byron", "A1")],
        "r6": [author("Countess Lovelace", None, "https://orcid.org/0000-0002-1825-0097")], "r7": [author("J. Smith")], "r8": [author("Ada Byron", None, "0000-0001-5109-3700")], "r9": "no json",
    }
    res = spark.createDataFrame([(k, v if isinstance(v, str) else json.dumps(v)) for k, v in lists.items()] + [("r10", None)], "record_id string, openalex_authorships string")
    cand = spark.createDataFrame([(k, 2001, "Cy Fox" if k == "r9" else None, json.dumps([{"faculty_id": "f4", "basis": "exact_heading", "confidence": 0.5}]) if k == "r9" else None) for k in lists], "record_id string, report_year int, faculty_heading string, institutional_author_evidence string")
    roster = spark.createDataFrame([("f1", "Ada Byron", "A. Byron;", "2001", "0000-0002-1825-0097"), ("f2", "Jane Smith", None, None, None), ("f3", "John Smith", "", "", None), ("f4", "Cy Fox", None, "", None)], "id string, n string, a string, y string, o string")
    people_ = attribution.registered(roster, "id", "n", "a", "y", "o")
    stored = attribution.stored(res)
    known = attribution.learned(people_, attribution.observed(stored, cand))
    ada = known.where("person_id = 'f1'").first()
    assert "A1" in ada.author_ids and ada.institutions == ["I1"]
    articles = spark.createDataFrame([(k, k) for k in lists] + [("none", None)], "record_id string, s string")
    found, audit = attribution.attributed(articles, "s", stored, cand, known)
    rule = {(r.work_id, r.name): (r.status, r.rule) for r in audit.collect()}
    assert rule[("r6", "Countess Lovelace")] == ("matched", "curated_orcid") and rule[("r7", "J. Smith")][0] == "ambiguous" and rule[("r8", "Ada Byron")][0] == "unmatched" and rule[("r1", "Bo Ray")][0] == "unmatched"
    assert rule[("r2", "Ada Byron")] == ("matched", "name+id+institution") and rule[("r4", "Ada Byron")] == ("matched", "name+institution") and rule[("r5", "Ada Byron")] == ("matched", "name+id")
    got = {(r.work_id, r.person_id): (r.basis, r.confidence) for r in found.collect()}
    assert got[("r9", "f4")] == ("owner", 0.9) and got[("r6", "f1")] == ("authorship", 0.999) and ("r7", "f2") not in got
    assert {r.person_id: r.n_works for r in attribution.profiles(known, found).collect()} == {"f1": 5 + (("r3", "f1") in got), "f2": 0, "f3": 0, "f4": 1}


def test_name_rules_meet_unlike_surnames(spark, tmp_path):
    spark.createDataFrame([("Josephine C. Roubuvold",), ("Ada Byron",), ("J. Smith",), (None,)], "faculty_name string").write.parquet(f"{tmp_path}/article_faculty_attributions.parquet")
    spark.createDataFrame([("f1", "Josephine C. Roubuvlod"), ("f2", "Ada Byron"), ("f3", "Bo Byron"), ("f4", "Jane Smith"), ("f5", "Kate Roubuvold"), ("f6", "Jane Smits")], "faculty_id string, faculty_name string").write.parquet(f"{tmp_path}/faculty_registry.parquet")
    got = rows(catalogue.queries()["name_rules"](spark, str(tmp_path)), "faculty_name", "faculty_id", "score")
    # surnames 8/9 alike, whole names 20/21; f6 has 4/5 alike; pairs of one surname come out with their 0
    assert got == [("Ada Byron", "f2", 1.0), ("Ada Byron", "f3", 0.0), ("J. Smith", "f4", 0.97), ("Josephine C. Roubuvold", "f1", 0.9357), ("Josephine C. Roubuvold", "f5", 0.0)]


def test_extract(spark):
    c = spark.createDataFrame([(1, 'A. B. "A quoted one," J. 2001'), (2, "Lee, A. (2001). An apa title. Journal."), (3, "x"), (4, None)], "id int, c string")
    got = {r.id: (r.title, r.method) for r in extract.with_title(c, "c").collect()}
    assert got[1] == ("A quoted one,", "quoted_title") and got[3] == ("", "unresolved") and got[4][1] == "unresolved"
    b = spark.createDataFrame([(1, "Ann Lee\nLee, A. one\ncontinued\n\nSecond block")], "id int, t string")
    assert [r.text for r in extract.page_blocks(b, "id", "t").orderBy("block").collect()] == ["Ann Lee", "Lee, A. one continued", "Second block"]
    lines = [("Name: Dr. Ann Lee", "", False), ("Publications", "", False), ("Journal Articles", "", False), ("Lee, A. Some work. Journal, 2001.", "", False), ("Lee, A. Some  work. Journal, 2001.", "", False), ("Other", "", False), ("Lee, A. Submitted paper 2003.", "", False), ("Teaching", "", False), ("A course of the journal, 2001.", "", False), ("Bo Ray", "ReportHeader", True)]
    df = spark.createDataFrame([("r", 2005, i, t, s, x) for i, (t, s, x) in enumerate(lines)], "report string, report_year int, idx int, text string, style string, bold boolean")
    got = rows(extract.fold_sections(df), "owner", "category", "is_ongoing")
    assert got == [("Ann Lee", "article", False), ("Ann Lee", "article", True)]
    states = {"A paper, ON-GOING": True, "on going since May": True, "Reviewed -not accepted": True, "re-submitted working papers": True, "Forthgoing, in print": False, "Published 2001": False, "": False}
    got = spark.createDataFrame([(v,) for v in states], "x string").select("x", extract.is_ongoing(F.col("x")).alias("y")).collect()
    assert {r.x: r.y for r in got} == states


def test_titles_by_rule(spark):
    cases = {
        'Lee, A. "Foo bar." Journal': ("Foo bar.", "quoted_title"),
        'Lee, A. "Foo" 2001. A longer title here. Journal': ("A longer title here", "apa_title"),
        "Lee, A. (Accepted/Forthcoming/In Press) (in press). Trees of the town. Journal": ("Trees of the town", "apa_title"),
        "Lee, A., Editor. Towns and trees, Boston: Press": ("Towns and trees", "editor_book_title"),
        "wrote the review of the book Green Towns, in Town Journal, May": ("Green Towns", "reviewed_work_title"),
        "(forthcoming). The shade of trees, Arden University": ("The shade of trees", "status_leading_title"),
        "Heat in four towns. Report prepared for the council": ("Heat in four towns", "standalone_work_title"),
        "Ann Lee, Heat in towns, 2003": ("Heat in towns", "title_like_segment"),
        "2001. Abc. D": ("", "unresolved"),
        "": ("", "unresolved"),
    }
    got = extract.with_title(spark.createDataFrame([(c,) for c in cases], "c string").withColumn("title", F.lit("clash")), "c").collect()
    assert {r.c: (r.title, r.method) for r in got} == cases


def test_blocks_of_reports(spark):
    yes = ["Lee, A. Heat in small towns, 2001", 'Lee, A. "Heat in many small towns"', "Lee, A. Heat in towns, forthcoming soon", "Ann Lee and Bo Ray, chapter of a longer work"]
    no = ["Lee, A. 2001", "During 2001 the staff published 20 papers", "See also the list of 2001 in the journal", "A sentence about nothing in particular here", "", None]
    got = spark.createDataFrame([(x,) for x in yes + no], "x string").select("x", extract.looks_like_citation(F.col("x")).alias("y")).collect()
    assert [r.y for r in got] == [True] * 4 + [False] * 6
    pages = [("r", i, t) for i, t in enumerate(["Contents Scholarly work 14", *["front"] * 11, "Scholarly work: during 2001, 20 papers", "body", "body", "Papers under review", "rest"])] + [("s", 0, "nothing"), ("t", 1, "x Scholarly work"), ("t", 2, "y")]
    got = extract.section_bounds(spark.createDataFrame(pages, "r string, p int, t string"), "r", "p", "t", "Scholarly work", "during \\d{4}", "^Papers under review")
    assert rows(got) == [("r", 12, 14), ("t", 1, 2)]
    tails = spark.createDataFrame([("In a Press", "title_like_segment"), ("In a Press", "apa_title"), ("Towns of old", "title_like_segment"), (None, None)], "t string, m string")
    assert [r.x for r in tails.select(extract.is_tail(F.col("t"), F.col("m")).alias("x")).collect()] == [True, False, False, False]


def test_fold_of_one_long_report_in_chunks(spark):
    lines = []
    for i in range(40):
        lines += [(f"Name: Ann {chr(65 + i % 26)}{'x' * (i // 26 + 1)}", ""), ("Presentations:", ""), ("Awards", "b"), (f"Talk {i} at the journal of towns", ""), ("Scholarly works", ""), ("Invited book chapters", "b"), (f"Chapter {i} in the journal of towns", ""), ("Service", "b"), (f"Work {i} in the journal of duty", ""), ("TEACHING", "b"), (f"Course {i} of the journal of duty", "")]
    df = spark.createDataFrame([(None if i % 2 else "r", 2005, 3 * j, t, "", s == "b") for i in range(2) for j, (t, s) in enumerate(lines)], "report string, report_year int, idx int, text string, style string, bold boolean")
    for chunk in (7, 10_000):
        got = extract.fold_sections(df, chunk)
        assert got.count() == 160 and got.where("report is null").count() == 80
        assert rows(got.groupBy("section", "category").count()) == [("presentations", "presentation", 80), ("publications", "book_chapter", 80)]
        assert got.select("owner").distinct().count() == 40


def test_review(spark):
    base = spark.createDataFrame([("k", "t", "a", "1;2")], "k string, title string, abstract string, ids string")
    sheet = base.withColumn("title", F.lit("T2")).withColumn("abstract", F.lit("A2"))
    e = review.changed_cells(sheet, base, "k", ["title", "abstract"]).join(base.select("k", "ids"), "k")
    rec = spark.createDataFrame([("1", "t", "a"), ("2", "t", "a"), ("3", "t", "a")], "id string, title string, abstract string")
    assert rows(review.apply_edits(rec, e, "id", "ids", ["title", "abstract"])) == [("1", "T2", "A2"), ("2", "T2", "A2"), ("3", "t", "a")]
    assert review.missing_ids(e.withColumn("ids", F.lit("9")), rec, "id", "ids").count() == 1
    d = spark.createDataFrame([("p", "replace", "x", "y"), ("q", "approve_add", "z", None), ("r", "odd", "z", None)], "target_id string, action string, name string, replacement string")
    assert rows(review.overrides_of(d)) == [("p", "add", "y"), ("p", "remove", "x"), ("q", "add", "z")]
    assert rows(review.invalid_decisions(d, ["replace", "approve_add"], d.where("target_id <> 'q'")), "target_id", "problem") == [("q", "target"), ("r", "action")]
    a, b = spark.createDataFrame([(2001, 10), (2002, 5)], "y int, e long"), spark.createDataFrame([(2001, 10), (2003, 1)], "y int, f long")
    assert rows(review.reconciled(a, b, "y", "e", "f"), "y", "status") == [(2001, "exact"), (2002, "not_found"), (2003, "not_expected")]
