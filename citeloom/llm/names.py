"""Problem 1: variant spellings of names typed by people.

Method: a symmetric-delete neighbourhood index on tokens finds names whose words are within one edit of a family name of
the roster; name and person are then aligned word by word, by the assignment with the highest similarity, permitting
initials, abbreviations, nicknames and any order of the parts.
"""

from __future__ import annotations

import functools
import re
import sys
import unicodedata

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from citeloom.llm import _util
from citeloom.llm.textforms import with_same_form

# Titles, degrees and remarks that are no part of a name, particles, and short forms of given names.
NOISE = re.compile(r"\b(?:dr|prof|professor|assoc|associate|asst|assistant|emeritus|emerita|mr|mrs|ms|rev|hon|pi|co-pi|jr|sr|phd|ph\.\s?d|edd|ed\.\s?d|md|m\.d|mph|msw|jd|esq)\b\.?", re.I)
PARTICLES = frozenset("al el de da di du del della der den van von la le ten ter bin ibn st".split())
NICKNAMES = """
abigail abby gail|alexandra alex lexi sandra sasha|alexander alex sandy sasha|alfred al fred|amanda mandy|amelie amy|andrew andy drew|
anthony tony|barbara barb babs|benjamin ben benji benny|catherine cathy kate cat|charles charlie chuck chas|christine chris tina|
christopher chris kit topher|cynthia cindy|daniel dan danny|david dave davey|deborah deb debbie|dennis denny|donald don donnie|
dorothy dot dottie dolly|douglas doug|edward ed eddie ted ned|eleanor ellie nell nora|elizabeth liz beth betty eliza lizzie|
emily em|eugene gene|florence flo|frances fran frankie|francis frank|frederick fred freddy rick|gabriel gabe|gerald gerry jerry|gregory greg|
harold harry hal|henry hank harry|jacqueline jackie|james jim jimmy jamie|janet jan|jeffrey jeff|jennifer jen jenny jenn|jessica jess|
john jack johnny|jonathan jon jonny|joseph joe joey|josephine jo josie|joshua josh|judith judy jude|katherine kate kathy katie kat kay|kenneth ken kenny|
lawrence larry|leonard len lenny leo|lillian lily|louis lou|louise lou|margaret maggie meg peggy marge|martha marty|matthew matt|michael mike mick mikey|
nathaniel nate nat nathan|nathan nate|nicholas nick nicky|oliver ollie|pamela pam|patricia pat patty trish tricia|patrick pat paddy|penelope penny|peter pete|
philip phil|rachel rae|raymond ray|rebecca becky becca|richard rick dick rich ricky|robert bob rob bobby robbie bert|roderick rod rick roddy|ronald ron ronnie|
samuel sam sammy|samantha sam|sebastian seb bash|stephen steve stevie|steven steve|susan sue susie|theodore ted theo teddy|theresa terry tess|
thomas tom tommy|timothy tim timmy|tobias toby|valerie val|victor vic|victoria vicky tori|vincent vince vinny|virginia ginny|walter walt wally|william bill will billy liam|jose pepe|francisco paco pancho|ignacio nacho|enrique quique|manuel manolo|ravindra ravi|leilani lani|oksana ksana|zachary zach zack
"""
SHORT_FOR: dict[str, frozenset[str]] = {}
for _line in NICKNAMES.replace("\n", "").split("|"):
    _full, *_short = _line.split()
    for _s in _short:
        SHORT_FOR[_s] = SHORT_FOR.get(_s, frozenset()) | {_full}


def bare(s: str) -> str:
    """Lower case without accents."""
    return "".join(c for c in unicodedata.normalize("NFKD", s) if not unicodedata.combining(c)).lower()


def tokens(name: str) -> list[str]:
    """The words of a name in order: remarks go, apostrophes join, hyphens part, clustered initials (NP) are split."""
    name = re.sub(r"\([^)]*\)|\[[^\]]*\]", " ", name)
    short = re.fullmatch(r"\W*((?:[^\W\d_]+[\s\-'’]+)*[^\W\d_]*[^\W\d_A-ZÀ-Þ][^\W\d_]*)\s+([A-Z]{2,3})\W*", name)
    if short and short[2].upper() not in ("PHD", "III", "II"):  # Family AB: letters are initials, even where they spell a title or particle
        return tokens(short[1]) + [c.lower() for c in short[2]]
    name = NOISE.sub(" ", re.sub(r"['’`´]+", "", name))
    raw = re.findall(r"[^\W\d_]+", name)
    letters = "".join(raw)
    shout = letters.isupper() and any(len(w) > 3 for w in raw) and not any(len(w) == 1 for w in raw[1:-1] + raw[:1])
    family = re.match(r"\W*[^\W\d_]{2,3}\s*,", name) is not None  # LI, Mei: a short word before a comma is no pair of initials
    out = []
    for i, w in enumerate(raw):
        if i == 0 and family:
            out.append(bare(w))
        elif 2 <= len(w) <= 3 and w.isupper() and bare(w) not in PARTICLES and not shout:
            out += [bare(c) for c in w]
        else:
            out.append(bare(w))
    return out


def parsed(form: str) -> tuple[list[str], list[str]]:
    """(given, family) words of a roster form: family before a comma, else the last word with its hyphenated parts."""
    form = NOISE.sub(" ", re.sub(r"\([^)]*\)", " ", form))
    head, comma, tail = form.partition(",")
    if comma and tokens(head) and tokens(tail):
        return tokens(tail), [w for w in tokens(head) if w not in PARTICLES]
    parts = [p for p in re.sub(r"\s*-\s*", "-", form.replace(".", ". ")).split() if tokens(p)]
    if not parts:
        return [], []
    last = tokens(parts[-1])
    if all(len(w) == 1 for w in last) and len(parts) > 1 and all(len(w) > 1 for w in tokens(parts[0])):  # Fileazzin NP
        return [w for p in parts[1:] for w in tokens(p)], [w for w in tokens(parts[0]) if w not in PARTICLES]
    return [w for w in tokens(" ".join(parts[:-1])) if w not in PARTICLES], [w for w in last if w not in PARTICLES]


def near(a: str, b: str) -> bool:
    """Whether two words are one edit apart: a letter added, dropped, changed, or two neighbours swapped."""
    if abs(len(a) - len(b)) > 1 or min(len(a), len(b)) < 3 or max(len(a), len(b)) < 4:
        return False
    i = 0
    while i < min(len(a), len(b)) and a[i] == b[i]:
        i += 1
    if len(a) == len(b):
        return a[i + 1 :] == b[i + 1 :] or (a[i + 2 :] == b[i + 2 :] and a[i : i + 2] == b[i : i + 2][::-1])
    return a[i + 1 :] == b[i:] if len(a) > len(b) else a[i:] == b[i + 1 :]


def given_likeness(w: str, g: str, known: frozenset[str]) -> float:
    """How well a written given name w stands for g: equal, mistyped, short form, abbreviation or initial; 0 if it does not."""
    if w == g:
        return 1.0
    if len(w) == 1 or len(g) == 1:
        return 0.6 if w[0] == g[0] else 0.0
    if g in SHORT_FOR.get(w, ()) or w in SHORT_FOR.get(g, ()):
        return 0.88
    if w in known and g in known:
        return 0.0
    if near(w, g):
        return 0.9
    for s, full in SHORT_FOR.items():
        if g in full and near(w, s):
            return 0.8
    return 0.84 if min(len(w), len(g)) >= 3 and (g.startswith(w) or w.startswith(g)) else 0.0


def assign(rows: list[str], cols: list[str], like) -> tuple[float, list[int]]:
    """The assignment of rows to distinct columns with the highest summed likeness (-1: none); names have few words."""
    if len(rows) > 8 or len(cols) > 10:
        return _assign_long(rows, cols, like)

    @functools.cache
    def best(i: int, free: int) -> tuple[float, tuple[int, ...]]:
        if i == len(rows):
            return 0.0, ()
        s, t = best(i + 1, free)
        top = (s, (-1, *t))
        for j in range(len(cols)):
            if free >> j & 1 and (v := like(rows[i], cols[j])) > 0:
                s, t = best(i + 1, free & ~(1 << j))
                if s + v > top[0] + 1e-9:
                    top = (s + v, (j, *t))
        return top

    s, t = best(0, (1 << len(cols)) - 1)
    return s, list(t)


def _assign_long(rows: list[str], cols: list[str], like) -> tuple[float, list[int]]:
    """assign() for long names: over the words that are like any other, one by one, with sets of the shorter side's words."""
    v = {(i, j): x for i, r in enumerate(rows) for j, c in enumerate(cols) if (x := like(r, c)) > 0}
    a, b = sorted({i for i, _ in v}), sorted({j for _, j in v})
    turned = len(a) < len(b)
    each, other = (b, a) if turned else (a, b)
    best: dict[int, tuple[float, tuple]] = {0: (0.0, ())}
    for x in each:
        new = dict(best)
        for used, (s, pairs) in best.items():
            for k, y in enumerate(other):
                at = (y, x) if turned else (x, y)
                if not used >> k & 1 and at in v and s + v[at] > new.get(used | 1 << k, (-1.0,))[0] + 1e-9:
                    new[used | 1 << k] = (s + v[at], (*pairs, at))
        best = new
    s, pairs = max(best.values(), key=lambda x: x[0])
    to = dict(pairs)
    return s, [to.get(i, -1) for i in range(len(rows))]


def align(words: list[str], given: list[str], family: list[str], known: frozenset[str]) -> float:
    """The likeness of a written name to one form of a person; 0 if they differ.

    A family word must be there, whole or one edit off, and of a double name one part may be missing; the first given name must be there in some form; further
    given names must not contradict, but may be missing on either side.
    """
    if not family or len(words) < 2:
        return 0.0
    s, at = assign(family, words, lambda f, w: 1.0 if f == w else 0.9 if near(f, w) else 0.0)
    found_ = sum(j >= 0 for j in at)
    if not found_:
        return 0.0
    rest = [w for j, w in enumerate(words) if j not in at and w not in PARTICLES]
    if not rest or not given:
        return 0.0
    s = s / found_ - 0.15 * (len(family) - found_)  # one part of a double name may be missing
    first = given_likeness(rest[0], given[0], known)
    if not first:
        return 0.0
    total, used = assign(rest[1:], given[1:], lambda w, g: given_likeness(w, g, known))
    extra = sum(j < 0 for j in used)
    if extra and len(given) - 1 > sum(j >= 0 for j in used):
        return 0.0  # both have a further given name, and they differ
    return s + first + 0.1 * total - 0.15 * extra


def unaccented(col: Column) -> Column:
    """Lower case without accents, in SQL."""
    pairs = {chr(c): bare(chr(c)) for c in [*range(0xC0, 0x250), *range(0x1E00, 0x1F00)] if len(bare(chr(c))) == 1 and bare(chr(c)) != chr(c)}
    return F.lower(F.translate(col, "".join(pairs), "".join(pairs.values())))


def deletes(word: Column) -> Column:
    """A word and all its forms with one letter dropped."""
    return F.array_distinct(F.concat(F.array(word), F.transform(F.sequence(F.lit(1), F.char_length(word)), lambda i: F.concat(F.substring(word, F.lit(1), i - 1), F.substring(word, i + 1, F.char_length(word))))))


def roster_forms(roster: DataFrame, id: str, name: str, aliases: str) -> DataFrame:
    """(pid, main, form): the canonical spellings of every roster row, its own name first."""
    r = roster.where(F.col(id).isNotNull()).select(F.col(id).alias("pid"), F.explode(F.concat(F.array(F.struct(F.lit(True).alias("main"), F.col(name).alias("form"))), F.transform(F.split(F.coalesce(F.col(aliases), F.lit("")), ";"), lambda a: F.struct(F.lit(False).alias("main"), a.alias("form"))))).alias("x"))
    return with_same_form(r.select("pid", "x.*").withColumn("form", F.trim("form")).where("form <> ''").distinct(), "form", "form")


def _people(forms: DataFrame) -> DataFrame:
    """(pid, family, forms): the family words to index and all parsed forms of every roster row."""

    def scan(batches):
        for pdf in batches:
            g = [parsed(f) for f in pdf["form"]]
            yield pd.DataFrame({"pid": pdf["pid"], "main": pdf["main"], "given": [x[0] for x in g], "family": [x[1] for x in g]})

    p = forms.mapInPandas(scan, "pid string, main boolean, given array<string>, family array<string>").where("size(family) > 0")
    return p.groupBy("pid").agg(F.array_distinct(F.flatten(F.collect_list("family"))).alias("keys"), F.array_sort(F.collect_set(F.struct("given", "family"))).alias("forms"))


def _candidates(names: DataFrame, people: DataFrame) -> DataFrame:
    """(name, pid): names with a word that is at most one edit from a family word of the person, by the symmetric-delete index.

    The family words of all forms are indexed. Words of fewer than four letters have no edits and are met as they are.
    """
    index = people.select("pid", F.explode("keys").alias("key")).where("char_length(key) >= 2")
    index = index.select("pid", "key", F.explode(F.when(F.char_length("key") >= 4, deletes(F.col("key"))).otherwise(F.array("key"))).alias("d"))
    plain = F.regexp_replace(unaccented(F.col("name")), "['’`´]+", "")
    words = names.select("name", F.explode(F.array_distinct(F.split(plain, "[^\\p{L}]+"))).alias("w")).where("char_length(w) >= 2")
    # the neighbourhood is formed once per distinct word, however many names hold it
    reach = words.select("w").distinct().select("w", F.explode(F.when(F.char_length("w") >= 4, deletes(F.col("w"))).otherwise(F.array("w"))).alias("d"))
    near_words = reach.join(index, "d").select("w", "pid").distinct()
    return words.join(near_words, "w").select("name", "pid").distinct()


def match(names: DataFrame, people: DataFrame, known: frozenset[str]) -> DataFrame:
    """(name, pid, score) of all candidate pairs that align."""

    def verify(batches):
        for pdf in batches:
            score = []
            for name, forms in zip(pdf["name"], pdf["forms"]):
                w = tokens(name)
                score.append(max((align(w, list(f["given"]), list(f["family"]), known) for f in forms), default=0.0))
            out = pdf[["name", "pid"]].assign(score=score)
            yield out[out["score"] > 0]

    pairs = _candidates(names, people).join(people.select("pid", "forms"), "pid").select("name", "pid", "forms")
    # few bytes but much work: spread by number, not by size
    parts = int(names.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return pairs.repartition(parts, "name").mapInPandas(verify, "name string, pid string, score double")


def people_of(roster: DataFrame, id: str, name: str, aliases: str, given_bound: int = 5000) -> tuple[DataFrame, DataFrame, frozenset[str]]:
    """(row -> person as pid, person), the people with all their forms, and the given names in use.

    Two rows are one person when each row's fullest form aligns with the other's and no third row, that is not the same
    person too, aligns as well with the vaguer one. The given names are the at most given_bound most frequent ones.
    """
    forms = _util.cut(roster_forms(roster, id, name, aliases))
    rows = _util.cut(_people(forms))
    firsts = rows.select(F.explode("forms.given").alias("g")).where("size(g) > 0").select(F.col("g")[0].alias("g")).where("char_length(g) > 2").groupBy("g").count()
    known = frozenset(r.g for r in firsts.where("count > 2").orderBy(F.desc("count"), "g").limit(given_bound).collect()) | frozenset(f for s in SHORT_FOR.values() for f in s)
    fullest = F.array_max(F.transform("forms", lambda f: F.struct(F.char_length(F.array_join(f["given"], " ")).alias("n"), f.alias("f"))))["f"]
    full = rows.select("pid", "keys", F.array(fullest).alias("forms"), F.array_join(F.concat(fullest["given"], fullest["family"]), " ").alias("name"))
    pairs = match(full.select("name").distinct(), full, known).join(full.select("name", F.col("pid").alias("a")), "name").where("a <> pid").select("a", F.col("pid").alias("b"), "score")
    pairs = _util.cut(pairs.groupBy(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).agg(F.max("score").alias("score")))
    both = pairs.select("a", "b", "score").unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"), "score"))
    # a row that fits two others which do not fit each other is left apart
    fits = both.alias("x").join(both.alias("y"), F.expr("x.a = y.a and x.b < y.b")).select(F.col("x.a").alias("a"), F.col("x.b").alias("b"), F.col("y.b").alias("c"))
    torn = fits.join(both.select(F.col("a").alias("b"), F.col("b").alias("c")), ["b", "c"], "left_anti").select("a").distinct()
    sound = _util.cut(both.join(torn, "a", "left_anti").join(torn.withColumnRenamed("a", "b"), "b", "left_anti").select("a", "b"))
    label = rows.select("pid", F.col("pid").alias("person"))
    for _ in range(30):
        low = sound.join(label, sound["a"] == label["pid"]).groupBy("b").agg(F.min("person").alias("m"))
        new = _util.cut(label.join(low, label["pid"] == low["b"], "left").select("pid", F.least("person", F.coalesce("m", "person")).alias("person"), F.col("person").alias("was")))
        label = new.select("pid", "person")
        if not new.where("person <> was").limit(1).count():
            break
    else:
        raise RuntimeError("rows of the same person did not settle in 30 rounds")
    people = rows.join(label, "pid").groupBy("person").agg(F.array_distinct(F.flatten(F.collect_list("keys"))).alias("keys"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("forms")))).alias("forms")).withColumnRenamed("person", "pid")
    return label, _util.cut(people), known


def linked_names(names: DataFrame, people: DataFrame, known: frozenset[str]) -> DataFrame:
    """(raw, pid): the person every distinct written name denotes; names that fit several people equally well are left out."""
    shaped = _util.cut(with_same_form(names.where("raw <> ''").select("raw").distinct(), "raw", "name"))
    scored = match(shaped.select("name").distinct(), people, known)
    w = Window.partitionBy("name").orderBy(F.desc("score"), "pid")
    best = scored.withColumn("r", F.row_number().over(w)).withColumn("second", F.lead("score").over(w)).where("r = 1 and (second is null or score - second > 0.02)")
    return shaped.join(best, "name").select("raw", "pid")


def found(candidates: DataFrame, resolution: DataFrame, attributions: DataFrame, roster: DataFrame) -> DataFrame:
    """(field, record_id, faculty_id) as TESTDATA.md states it.

    Names are made distinct map-side before any matching and joined back afterwards, so a name that a third of all rows
    hold costs one row. Null and empty names denote nobody; a roster row without a readable name denotes only itself.
    """
    label, people, known = people_of(roster, "faculty_id", "faculty_name", "aliases")
    occurring = (
        candidates.select(F.lit("heading").alias("field"), "record_id", F.col("faculty_heading").alias("raw"))
        .unionByName(resolution.select(F.lit("author").alias("field"), "record_id", F.explode(F.split("authors", ";")).alias("raw")).withColumn("raw", F.trim("raw")))
        .unionByName(attributions.select(F.lit("attribution").alias("field"), "record_id", F.col("faculty_name").alias("raw")))
        .where("raw <> '' and record_id is not null")
    )
    who = linked_names(occurring, people, known)
    own = roster.join(label, roster["faculty_id"] == label["pid"]).select("person", F.col("faculty_name").alias("raw")).distinct()
    # what is written exactly as a roster row of that person is no variant
    who = _util.cut(who.join(own.withColumnRenamed("person", "pid"), ["raw", "pid"], "left_anti"))
    hits = occurring.join(_util.bounded(who, 256), "raw").select("field", "record_id", F.col("pid").alias("faculty_id"))
    rows = label.where("person < pid").select(F.lit("registry").alias("field"), F.col("pid").alias("record_id"), F.col("person").alias("faculty_id"))
    return hits.distinct().unionByName(rows)


_util.by_value(sys.modules[__name__])
