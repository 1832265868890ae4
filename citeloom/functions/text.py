"""Column expressions over text, names and identifiers; all of them stay in the JVM."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F


def _accents() -> dict[str, str]:
    """Accented Latin letters with the plain letter, from the Unicode database."""
    out = {}
    for cp in [*range(0xC0, 0x250), *range(0x1E00, 0x1F00)]:
        plain = "".join(c for c in unicodedata.normalize("NFKD", chr(cp)) if not unicodedata.combining(c))
        if len(plain) == 1 and plain != chr(cp):
            out[chr(cp)] = plain
    return out


ACCENTS = _accents()


def unaccent(x: Column) -> Column:
    return F.regexp_replace(F.translate(x, "".join(ACCENTS), "".join(ACCENTS.values())), "\\p{M}+", "")


def collapse(x: Column) -> Column:
    """White space to single spaces, trimmed."""
    return F.trim(F.regexp_replace(x, "\\s+", " "))


def title_key(x: Column) -> Column:
    """Lower case, everything but a-z and digits to one space."""
    return F.trim(F.regexp_replace(F.lower(x), "[^a-z0-9]+", " "))


def normalized_title(x: Column) -> Column:
    """title_key after accents are dropped and & is spelled out."""
    return title_key(F.replace(unaccent(x), F.lit("&"), F.lit(" and ")))


def unbroken(x: Column) -> Column:
    """Soft hyphens dropped, hyphens unified, words broken at a line end joined, white space collapsed."""
    y = F.translate(x, "‐‑­", "--")
    return collapse(F.regexp_replace(y, "(?U)(?<=\\w)-\\s*\\n\\s*(?=\\w)", ""))


def clean_name(x: Column) -> Column:
    y = F.regexp_replace(F.trim(F.regexp_replace(F.trim(x), "\\*+$", "")), "(?i)^(?:professor|prof\\.?|doctor|dr\\.?)\\s+", "")
    return F.regexp_replace(collapse(y), "^[ ,;:|]+|[ ,;:|]+$", "")


def name_key(x: Column) -> Column:
    return title_key(unaccent(clean_name(x)))


def years(x: Column) -> Column:
    """Array of the years 1900-2099 that stand free of other digits."""
    return F.transform(F.regexp_extract_all(x, F.lit("(?<!\\d)((?:19|20)\\d{2})(?!\\d)"), F.lit(1)), lambda y: y.cast("int"))


def citation_year(raw: Column, report_year: Column, ahead: int = 2) -> Column:
    """The last year from 1900 to the report's plus `ahead`, else the report's."""
    ok = F.filter(years(raw), lambda y: (y >= 1900) & (y <= report_year + ahead))
    return F.coalesce(F.try_element_at(ok, F.lit(-1)), report_year.cast("int"))


def report_year(file: Column) -> Column:
    """First year in a file's stem; a free-standing 96 is 1996."""
    stem = F.regexp_replace(F.substring_index(file, "/", -1), "\\.[^.]*$", "")
    return F.coalesce(F.try_element_at(years(stem), F.lit(1)), F.when(stem.rlike("(?:^|\\D)96(?:\\D|$)"), 1996))


def split_list(x: Column, mark: str = ";") -> Column:
    """Trimmed non-empty parts of a delimited list; null gives an empty array."""
    parts = F.transform(F.split(F.coalesce(x, F.lit("")), "\\" + mark), lambda p: F.trim(p))
    return F.filter(parts, lambda p: p != "")


def bare_doi(x: Column) -> Column:
    return F.nullif(F.regexp_replace(F.lower(F.trim(x)), "^https?://(dx\\.)?doi\\.[a-z]+/|^doi:?\\s*", ""), F.lit(""))


def work_key(doi: Column, title: Column) -> Column:
    d = F.nullif(F.lower(F.trim(doi)), F.lit(""))
    return F.when(d.isNotNull(), F.concat(F.lit("doi:"), d)).otherwise(F.concat(F.lit("title:"), title_key(F.coalesce(title, F.lit("")))))


def stable_id(prefix: str, key: Column, n: int = 16) -> Column:
    return F.concat(F.lit(prefix), F.substring(F.sha2(key, 256), 1, n))


def publication_id(doi: Column, title: Column) -> Column:
    return stable_id("pub_", work_key(doi, title))


def record_id(*parts: Column) -> Column:
    return F.substring(F.sha1(F.concat_ws("|", *parts)), 1, 16)


def slug(title: Column, doi: Column, n: int = 90) -> Column:
    """A file name: the title's letters and digits, cut, and ten digits of the DOI's hash."""
    stem = F.regexp_replace(F.regexp_replace(F.lower(title), "[^a-z0-9]+", "-"), "^-+|-+$", "")
    return F.concat(F.regexp_replace(F.substring(stem, 1, n), "-+$", ""), F.lit("-"), F.substring(F.sha1(doi), 1, 10))


ENTITIES = {"&amp;": "&", "&lt;": "<", "&gt;": ">", "&quot;": '"', "&#39;": "'", "&apos;": "'", "&nbsp;": " "}


def html_text(x: Column) -> Column:
    """Entities decoded, tags to spaces, white space collapsed."""
    for k, v in ENTITIES.items():
        if k != "&amp;":
            x = F.replace(x, F.lit(k), F.lit(v))
    return collapse(F.regexp_replace(F.replace(x, F.lit("&amp;"), F.lit("&")), "<[^>]+>", " "))


def inverted_text(index: Column) -> Column:
    """The text of a word -> positions map, in order of position."""
    spots = F.flatten(F.transform(F.map_entries(index), lambda e: F.transform(e["value"], lambda p: F.struct(p.alias("p"), e["key"].alias("w")))))
    return F.array_join(F.transform(F.array_sort(spots), lambda s: s["w"]), " ")


def orcid(x: Column) -> Column:
    """The bare upper-case ORCID if pattern and ISO 7064 mod 11-2 check digit hold, else null."""
    bare = F.upper(F.regexp_extract(F.trim(x), "(?i)^(?:https?://orcid\\.org/)?(\\d{4}-\\d{4}-\\d{4}-\\d{3}[\\dX])$", 1))
    digits = F.replace(bare, F.lit("-"), F.lit(""))
    total = F.aggregate(F.sequence(F.lit(1), F.lit(15)), F.lit(0), lambda s, i: (s + F.substring(digits, i, F.lit(1)).try_cast("int")) * 2)
    check = F.pmod(F.lit(12) - total % 11, F.lit(11))
    given = F.when(F.substring(digits, 16, 1) == "X", 10).otherwise(F.substring(digits, 16, 1).try_cast("int"))
    return F.when((bare != "") & (check == given), bare)


def hash31(x: Column) -> Column:
    """The 32-bit multiply-by-31 string hash, unsigned."""
    return F.aggregate(F.filter(F.split(x, ""), lambda c: c != ""), F.lit(0).cast("long"), lambda h, c: (h * 31 + F.ascii(c)) % 4294967296)


def display_term(term: Column, acronyms: list[str]) -> Column:
    words = F.transform(F.split(term, " "), lambda w: F.when(F.lower(w).isin(acronyms), F.upper(w)).otherwise(F.initcap(w)))
    return F.array_join(words, " ")


def ellipsis(x: Column, n: int) -> Column:
    return F.when(F.char_length(x) > n, F.concat(F.rtrim(F.substring(x, 1, n - 1)), F.lit("…"))).otherwise(x)


def initials(x: Column) -> Column:
    return F.array_join(F.transform(F.slice(F.split(collapse(x), " "), 1, 2), lambda w: F.upper(F.substring(w, 1, 1))), "")


def cell_text(x: Column) -> Column:
    """A spreadsheet cell as text: 3.0 is 3, an escaped leading '= is =."""
    return F.regexp_replace(F.regexp_replace(F.trim(x), "^(-?\\d+)\\.0+$", "$1"), "^'=", "=")


def cell_escape(x: Column) -> Column:
    return F.when(x.startswith("="), F.concat(F.lit("'"), x)).otherwise(x)


def contains_tokens(zone: Column, value: Column) -> Column:
    """Whole-token containment."""
    return F.contains(F.concat(F.lit(" "), zone, F.lit(" ")), F.concat(F.lit(" "), value, F.lit(" ")))
