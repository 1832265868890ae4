import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from citeloom.llm import entries, leakage, linkage, names, neighbours, packing, reading, refine, survivor, textforms


def rows(df, *cols):
    return sorted(tuple(r) for r in (df.select(*cols) if cols else df).collect())


# ---- 6 ----
def test_odd_characters(spark):
    texts = {"a": "Plain text — “fine” …\t\n", "b": "ｗｉｄｅ １", "c": "Cаvani", "d": "zero​width", "e": "nb space", "f": "ét", "g": "ét", "h": "\U0001d5b1om", "i": "β version [на русском]", "j": "", "k": None, "l": "ﬁne", "m": "x‑y", "n": "bell\x07", "o": "Α. Lee", "p": "ét"}
    df = spark.createDataFrame(list(texts.items()), "id string, t string").withColumn("text", F.lit("clash")).withColumn("field", F.lit(1))
    assert rows(textforms.odd_characters(df, "id", ["t"])) == [(x, "t") for x in "bcdefhlmno"]
    got = dict(rows(textforms.canonical_text(df, "t", "canonical").where("t is not null"), "id", "canonical"))
    assert (got["b"], got["c"], got["d"], got["e"], got["f"], got["h"], got["l"], got["m"], got["o"]) == ("wide 1", "Cavani", "zerowidth", "nb space", "ét", "Rom", "fine", "x-y", "A. Lee")
    assert got["i"] == texts["i"] and got["a"] == texts["a"] and got["j"] == ""
    assert textforms.odd_characters(df.limit(0), "id", ["t"]).count() == 0
    assert rows(textforms.odd_characters(df.unionByName(df), "id", ["t"])) == rows(textforms.odd_characters(df, "id", ["t"]))


def test_classes_join_what_the_mapping_leaves_apart(spark):
    """Written-apart syllables and letters of their own are equal under the collation though no mapping knows them."""
    same = {"c": "\u212bngstrom", "d": "\u00c5ngstrom", "e": "한글 text", "f": "\u1112\u1161\u11ab\u1100\u1173\u11af text", "g": "quota"}
    df = spark.createDataFrame(list(same.items()), "id string, t string")
    got = dict(rows(textforms.canonical_text(df, "t", "canonical"), "id", "canonical"))
    assert got["g"] == "quota" and got["c"] == got["d"] == "\u00c5ngstrom" and got["e"] == got["f"] == "한글 text"
    mapped = dict(rows(textforms.with_same_form(df, "t", "m"), "id", "m"))
    assert mapped["e"] != mapped["f"]


def test_further_look_alikes(spark):
    odd = {"a": ("Ⅷ", "VIII"), "b": ("ⓐ① ⁴ ₂ ᵃ", "a1 4 2 a"), "c": ("ᏢᎪᏙᎬ", "PAVE"), "d": ("ꓑꓲꓠ", "PIN"), "e": ("x² ½ ™ №", "x² ½ ™ №"), "f": ("ᏣᎳᎩ words", "ᏣᎳᎩ words"), "g": ("🅐🄰", "🅐A"), "h": ("quo\U000e0074te\ufff9", "quote"), "i": ("\u212a\u037e", "K;")}
    df = spark.createDataFrame([(k, a) for k, (a, _) in odd.items()], "id string, t string")
    assert dict(rows(textforms.canonical_text(df, "t", "canonical"), "id", "canonical")) == {k: b for k, (_, b) in odd.items()}


# ---- 3 ----
def test_copies_against_brute_force(spark):
    rnd = random.Random(3)
    base = ["Urban heat, in towns: a study", "urban   HEAT in towns a STUDY", "A study. Urban heat in towns", "Urban heat in town: as tudy", "Ｕｒｂａｎ heat in towns a study!", "", None, "!!!", "other"]
    data = [(f"{i:03d}", rnd.choice(base), rnd.choice([None, "10.1000/AB c", "https://doi.org/10.1000/abc", "doi: 10.1000/ABC."])) for i in range(120)]
    df = spark.createDataFrame(data, "id string, t string, doi string").withColumn("w", F.lit(1)).withColumn("k1", F.lit("clash"))

    def key(x):
        import re
        import unicodedata

        w = sorted(re.findall(r"[^\W_]+", unicodedata.normalize("NFKC", x or "").lower()))
        return " ".join(w)

    for extra, k2 in ((None, lambda d: 0), (refine.doi_key(F.col("doi")), lambda d: d is None)):
        groups = {}
        for i, t, d in data:
            if key(t):
                groups.setdefault((key(t), k2(d)), []).append(i)
        want = sorted((min(g), x) for g in groups.values() for x in g if x != min(g))
        assert rows(refine.copy_pairs(df, "id", "t", extra), "record_id", "copy_record_id") == want
        assert rows(refine.copies(df, "id", "t", extra), "record_id", "n_copies") == sorted((min(g), len(g)) for g in groups.values() if len(g) > 1)
    assert refine.copy_pairs(df.limit(0), "id", "t").count() == 0
    assert rows(refine.copy_pairs(df.unionByName(df), "id", "t"), "record_id", "copy_record_id") == rows(refine.copy_pairs(df, "id", "t"), "record_id", "copy_record_id")


def test_copies_of_both_tables_with_single_titles(spark, tmp_path):
    c = [("c1", "Urban heat in towns"), ("c2", "URBAN HEAT, in towns"), ("c3", "Held once"), ("c3", "Held once"), ("c4", "Dlhe once"), ("c5", ""), ("c6", None), ("c7", "!!!")]
    spark.createDataFrame(c, "record_id string, title string").write.parquet(f"{tmp_path}/publication_candidates.parquet")
    r = [("r1", "Urban heat", "10.1000/a", "matched"), ("r2", "Urban HEAT", "doi:10.1000/A", "matched"), ("r3", "Urban heat", None, "matched"), ("r4", "Urban heat", "10.1000/b", "matched"), ("r5", "Urban heat", None, "unmatched"), ("r6", None, "10.1000/a", "matched")]
    spark.createDataFrame(r, "record_id string, canonical_title string, doi string, match_status string").write.parquet(f"{tmp_path}/publication_resolution.parquet")
    got = rows(entries.p3_copies(spark, str(tmp_path)), "table_name", "record_id", "n_copies")
    assert got == [("publication_candidates", i, n) for i, n in (("c1", 2), ("c3", 1), ("c4", 1))] + [("publication_resolution", i, n) for i, n in (("r1", 2), ("r3", 1), ("r4", 1))]


# ---- 4 ----
def test_survivors(spark):
    long = "The authors studied the heat of towns. They found that trees helped a lot."
    data = [
        ("r1", "Urban Heat in Towns: A Study", "10.1000/a", long, 0.9, "x"), ("r2", "URBAN HEAT IN TOWNS: A STUDY", None, long + " © 2001 The Authors. All rights reserved.", 1.5, "y"),
        ("r3", "Urban Heat", "doi:10.1000/A", long[:39], 0.95, "y"), ("r4", "Urban Heat", None, "<p>" + long + "</p>", None, None), ("r0", "Urban Heat", None, long, 0.95, "x"),
        ("s1", "Alone in Here", None, long, 0.5, "x"), ("t1", None, None, None, None, None), ("t2", None, None, long, 2.0, "x"), ("u1", " Two  Spaces Here", "10.1/u", "N/A", -1.0, "x"), ("u2", "two spaces here.", "10.1/u", "See PDF.", None, "x"),
    ]
    df = spark.createDataFrame(data, "id string, title string, doi string, abs string, score double, src string").withColumn("n", F.lit(1)).withColumn("label", F.lit("clash"))
    run = lambda d: rows(survivor.survivors(d, "id", "title", "doi", "abs", "score"))
    want = [("r0", "abstract", "r0"), ("r0", "canonical_title", "r1"), ("r0", "match_score", "r0")]
    assert run(df) == want and run(df.unionByName(df)) == want and run(df.limit(0)) == []


def test_works_follow_chains(spark):
    n = 60
    data = [(f"{i:03d}", f"Title {(i + 1) // 2} of the chain", f"10.1000/x{i // 2}") for i in range(n)]
    random.Random(1).shuffle(data)
    df = spark.createDataFrame(data, "id string, t string, d string")
    assert {r[1] for r in rows(survivor.works(df, "id", "t", "d"))} == {"000"}


def test_trust_in_marks_is_learned(spark, monkeypatch):
    """A mark that loses its contests is not believed where it stands alone; one that wins them is."""
    whole = "The towns were measured for a year. Trees helped a lot."
    notice = whole + " All rights reserved."
    data = [(f"a{i}{x}", f"Work {i} of Many", t) for i in range(20) for x, t in (("x", whole), ("y", notice))] + [("b1", "Only with Notice", notice), ("b2", "Only with Notice", None)]
    data += [(f"c{i}{x}", f"Tiny {i} of Many", t) for i in range(20) for x, t in (("x", "Trees helped."), ("y", "trees helped"))] + [("d1", "Only Tiny", "Trees cool."), ("d2", "Only Tiny", "")]
    df = spark.createDataFrame(data, "id string, title string, abs string").withColumn("doi", F.lit(None).cast("string")).withColumn("score", F.lit(None).cast("double"))
    run = lambda: {r[0]: r[2] for r in rows(survivor.survivors(df, "id", "title", "doi", "abs", "score").where("field = 'abstract'"))}
    got = run()
    assert got["a0x"] == "a0x" and "b1" not in got and got["c0x"] == "c0x" and got["d1"] == "d1"
    monkeypatch.setattr(survivor, "discover", lambda claimed, used: [survivor.START] * len(survivor._marks()))
    assert run()["b1"] == "b1"


def test_survivors_of_many_sources(spark):
    r = spark.range(8400).select(F.format_string("%05d", F.col("id")).alias("id"), F.format_string("Title %d", (F.col("id") / 2).cast("int")).alias("title"), F.lit(None).cast("string").alias("doi"), F.lit(None).cast("string").alias("abs"), ((F.col("id") % 2) / 2).alias("score"), F.format_string("s%d", (F.col("id") / 2).cast("int")).alias("src"))
    got = rows(survivor.survivors(r, "id", "title", "doi", "abs", "score").where("field = 'match_score'"), "group_record_id", "record_id")
    assert got == [(f"{i:05d}", f"{i + 1:05d}") for i in range(0, 8400, 2)]


# ---- 5 ----
@pytest.mark.parametrize("hot", [0, 150])
def test_neighbours_against_brute_force(spark, hot):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(300, 8)).astype(np.float32)
    if hot:
        x[:hot] = x[0]
    ids = [f"{i:04d}" for i in rng.permutation(300)]
    data = [(i, [float(v) for v in r]) for i, r in zip(ids, x)] + [("0short", [1.0]), ("null", None), ("zero", [0.0] * 8), ("nan", [float("nan")] * 8)]
    df = spark.createDataFrame(data, "id string, e array<float>").withColumn("g", F.lit(1)).withColumn("v", F.lit("clash")).orderBy("id")
    y = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    sim = np.round(y @ y.T, 10)
    want = set()
    for i in range(300):
        order = sorted((j for j in range(300) if j != i), key=lambda j: (-sim[i, j], ids[j]))[:5]
        want |= {tuple(sorted((ids[i], ids[j]))) for j in order}
    got = set(rows(neighbours.neighbour_pairs(df, "id", "e")))
    assert len(got & want) / len(want) >= 0.9 and len(got & want) / len(got) >= 0.9
    if hot:
        cells = {ids[i] for i in range(hot)}
        assert {p for p in want if set(p) <= cells} == {p for p in got if set(p) <= cells}


def test_neighbours_of_nothing(spark):
    df = spark.createDataFrame([("a", None), ("b", [1.0])], "id string, e array<float>")
    assert neighbours.nearest(df, "id", "e").count() == 0 and neighbours.nearest(df.limit(0), "id", "e").count() == 0


# ---- 7 ----
def test_packing_round_trip(spark):
    rng = random.Random(7)
    n = {i: rng.choice([0, 1, 40, 60, 99, 100, 101, 250, 1000]) for i in range(500)}
    counts = spark.createDataFrame(list(n.items()), "doc_id long, n_tokens int").withColumn("size", F.lit(3))
    boxes = spark.createDataFrame([("s", 100), ("m", 400), (None, 5), ("bad", 0)], "container_name string, capacity_tokens int")
    got = packing.pack(counts.unionByName(counts.limit(20)), boxes).toPandas()
    for name, cap in (("s", 100), ("m", 400)):
        g = got[got.container_name == name]
        assert dict(g.groupby("doc_id").n_tokens.sum()) == n and g.groupby("container_id").n_tokens.sum().max() <= cap
        assert g[g.piece > 0].doc_id.map(n).gt(cap).all() and (g.first_token == g.piece * cap).all()
        assert sum(n.values()) / cap / g.container_id.nunique() > 0.8
    assert packing.pack(counts.limit(0), boxes).count() == 0
    tried = packing.best_fit([60, 50, 40, 40, 10], 100)
    assert sorted(map(sorted, tried)) == [[0, 2], [1, 3, 4]]


def test_token_counts(spark):
    docs = spark.createDataFrame([(1, "two words"), (2, ""), (3, None), (4, "a " * 20000), (None, "x")], "doc_id long, text string")
    got = dict(rows(packing.token_counts(docs, "doc_id", "text", "/opt/tokenizers/byte_bpe_50k.tiktoken")))
    assert got[1] == 2 and got[2] == got[3] == 0 and got[4] >= 20000


def test_packing_into_many_sizes(spark):
    boxes = spark.range(1100).select(F.format_string("c%d", F.col("id")).alias("container_name"), (F.col("id") + 10).cast("int").alias("capacity_tokens"))
    counts = spark.createDataFrame([(1, 5)], "doc_id long, n_tokens int")
    assert packing.pack(counts, boxes).select("container_name").distinct().count() == 1100


# ---- 8 ----
def test_leaks(spark):
    rng = random.Random(8)
    vocab = [f"{a}{b}{c}" for a, b, c in itertools.product("bdgk", "aeio", ("lm", "rt", "ns", "st"))]
    vocab = [w + s for w in vocab for s in ("an", "or", "ix")]
    opening = "read the passage and decide which claim the authors support"
    item = {i: opening + " " + " ".join(rng.choice(vocab) for _ in range(60)) for i in range(40)}
    noise = lambda k: " ".join(rng.choice(vocab) for _ in range(k))
    body = lambda i, a, b: item[i].split()[10:][a:b]
    changed = body(3, 5, 45)
    for k in range(6, 40, 9):
        changed[k] = "zzz"
    docs = {1: noise(80), 2: f"{noise(30)} {' '.join(body(1, 10, 26))} {noise(30)}", 3: f"{noise(20)} {' '.join(body(2, 0, 11))} {noise(9)}", 4: f"{noise(33)} {' '.join(changed).upper()}, {noise(5)}", 5: f"{opening}. {noise(50)}", 6: "", 7: None, 8: noise(40_000) + " " + "-\n".join([" ".join(body(4, 0, 20))[:25], " ".join(body(4, 0, 20))[25:]]) + " [12] " + " ".join(body(4, 20, 40))}
    df = spark.createDataFrame(list(docs.items()), "doc_id long, text string").withColumn("i", F.lit(1))
    items = spark.createDataFrame([*item.items(), (99, None), (98, ""), (97, "too short")], "item_id long, text string")
    want = [(2, 1), (4, 3), (8, 4)]
    assert rows(leakage.leaks(df, items), "doc_id", "item_id") == want
    assert rows(leakage.leaks(df.unionByName(df), items.unionByName(items), block_bytes=4000), "doc_id", "item_id") == want
    assert leakage.leaks(df, items.limit(0)).count() == 0 and leakage.leaks(df.limit(0), items).count() == 0


def test_wand_finds_what_a_full_scan_finds():
    rng = random.Random(2)
    items = [(i, " ".join(rng.choice("abcdefg") * 3 for _ in range(30))) for i in range(60)]
    ix = leakage.Index(items, set())
    for _ in range(50):
        terms = sorted(rng.sample(sorted(ix.postings), 12))
        score = {}
        for t in terms:
            for d, w in zip(*ix.postings[t][:2]):
                score[d] = score.get(d, 0) + w
        ix.threshold = rng.choice([0.5, 1.0, 2.0])
        assert sorted(d for d, _ in ix.retrieve(terms)) == sorted(d for d, s in score.items() if s >= ix.threshold - 1e-12)


def test_wand_skips_what_cannot_be_a_leak():
    """Every pair that the alignment verifies, tried on all pairs, is retrieved; most pairs that share a term are not."""
    rng = random.Random(3)
    vocab = [f"{a}{b}n" for a in "bdfgklmprst" for b in "aeiou"]
    say = lambda k: [rng.choice(vocab) for _ in range(k)]
    stock = [say(5) for _ in range(6)]  # set phrases that items and texts share
    item = [say(12) + rng.choice(stock) + say(30) + rng.choice(stock) + say(12) for _ in range(30)]
    texts = []
    for i in range(120):
        part = item[i % 30][(a := rng.randrange(40)) : a + rng.choice([0, 9, 15, 18, 24])]
        if len(part) > 14:
            part[rng.randrange(1, len(part) - 1)] = "changed"
        texts.append(" ".join(say(20) + rng.choice(stock) + part + say(15)))
    ix = leakage.Index([(i, " ".join(w)) for i, w in enumerate(item)], set())
    asked, inner = [], ix.retrieve

    def retrieve(terms):
        out = inner(terms)
        asked.append((len({d for t in terms for d in ix.postings[t][0]}), len(out)))
        return out

    ix.retrieve = retrieve
    got = {(d, i) for d, i, *_ in leakage.leaks_in(texts, ix, 15, 1 / 7)}
    want = set()
    for d, t in enumerate(texts):
        ids = np.array([ix.words.get(w, 0) for w in leakage.words_of(t)])
        for i in range(30):
            for lo in range(0, len(ids), leakage.STRIDE):
                span, same = leakage.aligned(ids[lo : lo + leakage.PASSAGE], ix.ids[i], ix.shared[i])
                if span >= 15 and span - same <= -(-span // 7):
                    want.add((d, i))
    assert got == want and len(want) > 40
    assert sum(b for _, b in asked) < 0.5 * sum(a for a, _ in asked)


# ---- 9 ----
def test_reading_levels(spark):
    rng = random.Random(9)
    tiers = [[f"{chr(97 + t)}{a}{b}" for a in "aeiou" for b in "bcdfg"] for t in range(5)]
    make = lambda lv: " ".join(rng.choice(tiers[min(4, max(0, lv - 1 + rng.choice([-1, 0, 0, 0, 1])))]) for _ in range(90))
    truth = {i: 1 + i % 5 for i in range(400)}
    docs = spark.createDataFrame([(i, make(v)) for i, v in truth.items()] + [(900, None), (901, ""), (902, "word " * 60_000)], "doc_id long, text string").withColumn("rating", F.lit(7))
    ratings = spark.createDataFrame([(i, min(5, max(1, truth[i] + rng.choice([0, 0, 0, 0, 1, -1])))) for i in range(0, 400, 3)] + [(0, None)], "doc_id long, level int")
    got = {r.doc_id: r.level for r in reading.reading_levels(docs, ratings).collect()}
    assert sum(got[i] == v for i, v in truth.items()) / 400 > 0.9 and 900 not in got and 1 <= got[902] <= 5
    assert reading.reading_levels(docs, ratings.limit(0)).count() == 0 and reading.reading_levels(docs.limit(0), ratings).count() == 0
    blocks = {r.doc_id: r.level for r in reading.reading_levels(docs.unionByName(docs), ratings, block_words=40).collect()}
    assert blocks == got  # repeated rows count once, and the vocabulary in four blocks gives what it gives in one


def test_sentences_correct_misleading_words(spark):
    rng = random.Random(19)
    tiers = [[f"{chr(97 + t)}{a}{b}" for a in "aeiou" for b in "bcdfg"] for t in range(5)]

    def make(words_at, sentences_at):
        return " ".join(" ".join(rng.choice(tiers[min(4, max(0, words_at - 1 + rng.choice([-1, 0, 0, 1])))]) for _ in range(rng.randint(4, 6) + 4 * sentences_at)) + "." for _ in range(8))

    truth, texts = {}, []
    for i in range(500):
        v = 1 + i % 5
        off = rng.choice([0, 0, 0, 1, -1]) if 1 < v < 5 else 0
        truth[i] = v
        texts.append((i, make(v + off, v - off)))
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    ratings = spark.createDataFrame([(i, v) for i, v in truth.items() if i % 4 == 0], "doc_id long, level int")
    got = {r.doc_id: r.level for r in reading.reading_levels(docs, ratings).where("not rated").collect()}
    assert sum(got[i] == truth[i] for i in got) / len(got) > 0.9


# ---- 1 ----
def test_names(spark):
    roster = spark.createDataFrame([("f1", "Nicholas P. Fileazzin", None), ("f2", "Rebecca Souzzéazzesh", "Becky Souzzéazzesh"), ("f3", "Renée Souzzéazzesh", ""), ("f4", "J. Gudoukez", "Joseph N. Gudoukez"), ("f5", "Joseph N. Gudoukez", None), ("f6", "Mei-Lin Dirnova-Flemund", None), ("f7", None, None)], "faculty_id string, faculty_name string, aliases string")
    heads = {"1": "FILEAZZIN, Nicholas", "2": "Nick Fileazin", "3": "Fileazzin NP", "4": "Niсhоlas Fileazzin*", "5": "Nicholas P. Fileazzin", "6": "R. Souzzéazzesh", "7": "Becky Souzzeazzesh, Ph.D.", "8": "Nicholas Q. Fileazzin", "9": "Nora Fileazzin", "10": "Research Centers", "11": None, "12": "", "13": "Joseph Gudoukez", "14": "M. L. Flemund", "15": "x" * 5000, "16": "Prof. Nicholas Penelope Fileazzin (PI)"}
    cand = spark.createDataFrame(list(heads.items()), "record_id string, faculty_heading string").withColumn("name", F.lit(1)).withColumn("pid", F.lit("clash"))
    res = spark.createDataFrame([("r1", "Fileazzin, N.;Ann Other; Renée  Souzzéazzesh"), ("r2", None)], "record_id string, authors string")
    att = spark.createDataFrame([("a1", "Nicholas Fileazzni"), ("a2", None)], "record_id string, faculty_name string")
    got = rows(names.found(cand, res, att, roster))
    want = [("heading", i, "f1") for i in ("1", "2", "3", "4", "16")] + [("heading", "7", "f2"), ("heading", "13", "f4"), ("heading", "14", "f6"), ("author", "r1", "f1"), ("author", "r1", "f3"), ("attribution", "a1", "f1"), ("registry", "f5", "f4")]
    assert got == sorted(want)
    assert rows(names.found(cand.unionByName(cand), res, att, roster)) == got
    assert names.found(cand.limit(0), res.limit(0), att.limit(0), roster.limit(0)).count() == 0


def test_short_family_names_and_those_of_aliases(spark):
    roster = spark.createDataFrame([("f1", "Mei Li", None), ("f2", "Anna Wu", "Anna Gudoukez"), ("f3", "Bo Ng", "")], "faculty_id string, faculty_name string, aliases string")
    cand = spark.createDataFrame([("1", "LI, Mei"), ("2", "Gudoukez, Anna"), ("3", "Dr. Bo Ng"), ("4", "Mei Lu"), ("5", "A. Wu")], "record_id string, faculty_heading string")
    none = spark.createDataFrame([], "record_id string, authors string, faculty_name string")
    assert rows(names.found(cand, none, none, roster)) == [("heading", "1", "f1"), ("heading", "2", "f2"), ("heading", "3", "f3"), ("heading", "5", "f2")]


def test_assignment_takes_all_words():
    a = list("abcdefghijklm")
    assert names.assign(a, a[::-1], lambda x, y: float(x == y)) == (13.0, list(range(12, -1, -1)))
    assert names.assign(["k"], a, lambda x, y: float(x == y)) == (1.0, [10]) and names.assign(a, ["z"], lambda x, y: float(x == y)) == (0.0, [-1] * 13)


def test_assignment_is_optimal():
    rng = random.Random(4)
    for _ in range(30):
        w = {(i, j): rng.choice([0, 0, 0.3, 0.9, 1.0]) for i in "abc" for j in "wxyz"}
        best = max(sum(w[i, p[k]] for k, i in enumerate("abc")) for p in itertools.permutations("wxyz", 3))
        assert abs(names.assign(list("abc"), list("wxyz"), lambda a, b: w[a, b])[0] - best) < 1e-9


# ---- 2 ----
def test_matches(spark):
    cat = [("m1", "matched", "Urban Heat among Small Towns of Arden: A Study", "Ann Lee; Bo Ray", 2001), ("m2", "matched", "urban heat among small towns of arden", "Lee, A.", 2001), ("m3", "matched", "Urban Heat among Small Towns of Calder: A Study", "Cy Fox", 2009), ("m4", "unmatched", None, None, None), ("m5", "matched", None, None, None)]
    res = spark.createDataFrame(cat, "record_id string, match_status string, canonical_title string, authors string, publication_year int").withColumn("w", F.lit(0))
    cand = [
        ("c1", 'Urban Heat Among Small Towns of Arden: A Study', 'A. Lee and B. Ray, "Urban Heat among Small Towns of Arden: A Study," Journal, 2001.', "Ann Lee"), ("c2", "Lee, A. (2001). Urban Haet among Small Towns of Arden: A Study. Journal.", "Lee, A. (2001). Urban Haet among Small To-\nwns of Arden: A Study. Journal.", "Ann Lee"),
        ("c3", "Urban Heat among Small Towns of Zzyzx: A Study", "Ann Lee. Urban Heat among Small Towns of Zzyzx: A Study. 2001", "Ann Lee"), ("c4", None, None, None), ("c5", "", "", ""), ("m3", "Urban Heat among Small Towns of Calder: A Study", "same", "x"), ("c6", "word " * 3000, "word " * 3000, "x"),
    ]
    df = spark.createDataFrame(cand, "record_id string, title string, raw_citation string, faculty_heading string").withColumn("report_year", F.lit(2002)).withColumn("c", F.lit("clash"))
    got = {(r[0], r[1]): r[2] for r in rows(linkage.matches(df, res), "candidate_record_id", "resolution_record_id", "confidence")}
    assert {k for k, v in got.items() if v >= 0.5} == {(c, m) for c in ("c1", "c2") for m in ("m1", "m2")} and all(0 <= v <= 1 for v in got.values())
    assert {(r[0], r[1]) for r in rows(linkage.matches(df.unionByName(df), res))} == set(got)
    assert linkage.matches(df.limit(0), res).count() == 0 and linkage.matches(df, res.limit(0)).count() == 0


def test_messages_settle_between_rivals(spark, monkeypatch):
    """Two works of one main title differ by their subtitle; each alone would pass, together only the cited one does."""
    cat = [("m1", "matched", "Urban Heat among Small Towns of Arden: A First Look", "Ann Lee", 2001), ("m2", "matched", "Urban Heat among Small Towns of Arden: Lessons Learned", "Ann Lee", 2001), ("m3", "matched", "Shade: Notes", "Cy Fox", 1999), ("m4", "matched", "Urban Heat among Small Towns of Calder: A First Look", "Ann Lee", 2001)]
    res = spark.createDataFrame(cat, "record_id string, match_status string, canonical_title string, authors string, publication_year int")
    cand = [("c1", None, 'Lee, A. (2001). Urban Heat among Small Towns of Arden: Lessons Learned. Journal.', "x"), ("c2", "Shade: Notes", "Fox, C. (1999). Shade: Notes. Press.", "x"), ("c3", "Shade", "Ray, B. (2011). Shade. Press.", "x"), ("c4", "Fine, a, b, c, d, e, f, g, h, i, j, k, l, m, n, o, p, Urban Heat among Small Towns of Arden", None, "y")]
    df = spark.createDataFrame(cand, "record_id string, title string, raw_citation string, faculty_heading string").withColumn("report_year", F.lit(2002))
    run = lambda: {(r[0], r[1]): r[2] for r in rows(linkage.matches(df, res), "candidate_record_id", "resolution_record_id", "confidence")}
    got = run()
    assert {k for k, v in got.items() if v >= 0.5} == {("c1", "m2"), ("c2", "m3")}
    assert ("c1", "m4") not in got and 0 < got[("c1", "m1")] < 0.5
    monkeypatch.setattr(linkage, "propagate", lambda p: p.select("c", "slot", "w", F.lit(0.0).alias("told")))
    assert run()[("c1", "m1")] >= 0.5


def test_propagation_prefers_the_free_partner(spark):
    p = spark.createDataFrame([(1, 0, 10, 4.0), (1, 0, 20, 3.0), (2, 0, 10, 3.9)], "c long, slot int, w long, odds double")
    told = {(r.c, r.w): r.told for r in linkage.propagate(p).collect()}
    conf = {k: 1 / (1 + np.exp(-(o + told[k]))) for k, o in {(1, 10): 4.0, (1, 20): 3.0, (2, 10): 3.9}.items()}
    assert conf[(1, 20)] > 0.5 > conf[(1, 10)] and conf[(2, 10)] > 0.5
