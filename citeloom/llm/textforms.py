"""Problem 6: visually identical text with different characters.

Method: values are mapped through a look-alike table, grouped under the accent-sensitive Unicode collation in SQL, one
canonical member is chosen per equivalence class, and it is joined back.
"""

from __future__ import annotations

import sys
import unicodedata

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from citeloom.llm import _util

# Letters of other scripts that are drawn like a Latin letter, each with that letter.
ALIKE = (
    "АA ВB ЕE ЅS ІI ЈJ КK МM НH ОO РP СC ТT УY ХX ҺH ԚQ ԜW аa еe оo рp сc уy хx ѕs іi јj һh ԁd ԛq ԝw ӏl гr "
    "ΑA ΒB ΕE ΖZ ΗH ΙI ΚK ΜM ΝN ΟO ΡP ΤT ΥY ΧX οo νv ρp ϲc ϳj αa ιi κk υu χx γy "
    "ՕO օo ոn սu հh Տ S ցg զq "
    "ᎪA ᏴB ᏟC ᎠD ᎬE ᎻH ᎫJ ᏦK ᏞL ᎷM ᏢP ᏒR ᏚS ᎢT ᏙV ᎳW ᏃZ ꓮA ꓐB ꓚC ꓓD ꓰE ꓝF ꓖG ꓧH ꓲI ꓙJ ꓗK ꓡL ꓟM ꓠN ꓳO ꓑP ꓣR ꓢS ꓔT ꓴU ꓦV ꓪW ꓫX ꓬY ꓜZ"
).replace(" S", "S").split()
# Of these, the ones that stand in a Latin word only beside Latin letters (alone they are ordinary symbols).
BESIDE_LATIN = "αικυχγг"
# Latin letters and marks drawn like an ordinary one.
ALIKE_PLAIN = "ɑa ɡg ⅼl ꞉: ‐- ‑- −- ﹣- ․. ⁄/ ∕/ ʹ' ʼ' ＇' ‚, ∶:".split()
# Invisible characters and spaces, as regular expression ranges.
INVISIBLE = "\\x00-\\x08\\x0b\\x0c\\x0e-\\x1f\\x7f-\\x84\\x86-\\x9f\\xad͏؜ᅟᅠ឴឵᠋-᠎​-‏‪-‮⁠-⁯ㅤ︀-️﻿ﾠ\\x{fff9}-\\x{fffb}\\x{1d173}-\\x{1d17a}\\x{e0000}-\\x{e0fff}"
SPACES = "                 　"


def _styled() -> dict[str, str]:
    """Wide, narrow, mathematical, circled, raised and lowered forms, roman numerals and letter ligatures with what they stand for, from the Unicode database.

    Raised 1 to 3 of Latin-1 are ordinary characters and stay. Forms of anything but ASCII letters and digits stay too,
    except wide and narrow ones.
    """
    out = {}
    blocks = [*range(0x1D2C, 0x1D6B), *range(0x2070, 0x20A0), *range(0x2100, 0x2150), *range(0x2160, 0x2180), *range(0x2460, 0x2500), *range(0xFB00, 0xFB07), *range(0xFF01, 0xFFEF), *range(0x1D400, 0x1D800), *range(0x1F110, 0x1F16A)]
    for cp in blocks:
        kind, plain_ = unicodedata.decomposition(chr(cp)).partition(" ")[0], unicodedata.normalize("NFKC", chr(cp))
        ordinary = plain_.isascii() and plain_.isalnum()
        roman = 0x2160 <= cp < 0x2180 and ordinary
        if kind in ("<wide>", "<narrow>", "<font>") or 0xFB00 <= cp <= 0xFB06 or roman or (kind in ("<circle>", "<super>", "<sub>", "<square>") and ordinary and not 0x2100 <= cp < 0x2150):
            out[chr(cp)] = plain_
    # letters and marks of their own that are an ASCII one by definition
    out |= {chr(cp): a for cp in (0x037E, 0x1FEF, 0x212A) for a in [unicodedata.normalize("NFC", chr(cp))]}
    return out


def _composed() -> dict[str, str]:
    """Letter and accent, written apart, with the single character, from the Unicode database."""
    out = {}
    for cp in [*range(0xC0, 0x0530), *range(0x1E00, 0x2000)]:
        apart = unicodedata.normalize("NFD", chr(cp))
        if len(apart) > 1 and unicodedata.normalize("NFC", apart) == chr(cp):
            out[apart] = chr(cp)
    return out


STYLED = _styled()
STYLED_ONE = {a: b for a, b in STYLED.items() if len(b) == 1} | {p[0]: p[1] for p in ALIKE_PLAIN} | dict.fromkeys(SPACES, " ")
STYLED_MORE = {a: b for a, b in STYLED.items() if len(b) > 1}
ALIKE_MAP = {p[0]: p[1] for p in ALIKE}
ALIKE_ALONE = {a: b for a, b in ALIKE_MAP.items() if a not in BESIDE_LATIN}
FOREIGN = "\\p{IsCyrillic}\\p{IsGreek}\\p{IsArmenian}\\p{IsCherokee}\\p{IsLisu}"


def _translate(col: Column, pairs: dict[str, str]) -> Column:
    return F.translate(col, "".join(pairs), "".join(pairs.values()))


def compose(col: Column) -> Column:
    """Letters with separate accents as single characters, in SQL; rows without separate accents pass untouched."""
    pairs = _composed()
    table = F.create_map(*[F.lit(x) for pair in pairs.items() for x in pair])
    clusters = F.regexp_extract_all(col, F.lit("(?s)(\\P{M}\\p{M}*|\\p{M}+)"), F.lit(1))
    whole = F.array_join(F.transform(clusters, lambda c: F.when(F.char_length(c) > 1, F.coalesce(F.try_element_at(table, c), c)).otherwise(c)), "")
    return F.when(col.rlike("\\p{M}"), whole).otherwise(col)


def plain(col: Column) -> Column:
    """First half of the mapping: invisible characters go, odd spaces and styled forms become ordinary."""
    out = _translate(F.regexp_replace(col, f"[{INVISIBLE}]", ""), STYLED_ONE)
    for a, b in STYLED_MORE.items():
        out = F.replace(out, F.lit(a), F.lit(b))
    return out


def really_foreign(text: Column) -> Column:
    """Whether the text has a word of another script, i.e. one with a letter that looks like no Latin one."""
    alone = "".join(ALIKE_ALONE)
    return text.rlike(f"(?<![\\p{{L}}\\p{{M}}])[{FOREIGN}\\p{{M}}]*[{FOREIGN}&&[^{alone}]][{FOREIGN}\\p{{M}}]*(?![\\p{{L}}\\p{{M}}])")


def settled(text: Column, real: Column) -> Column:
    """Second half, on the result of plain: look-alike letters of other scripts.

    Such a letter is mapped in a word that also has Latin letters, or in a word made of look-alikes only while the text
    has no word that really is of another script.
    """
    alone = "".join(ALIKE_ALONE)
    words = F.regexp_extract_all(text, F.lit("(?s)([\\p{L}\\p{M}]+|[^\\p{L}\\p{M}]+)"), F.lit(1))

    def word(w: Column) -> Column:
        foreign = w.rlike(f"[{FOREIGN}]")
        return F.when(~foreign, w).when(w.rlike("\\p{IsLatin}"), _translate(w, ALIKE_MAP)).when(~real & w.rlike(f"^[{alone}\\p{{M}}]+$"), _translate(w, ALIKE_ALONE)).otherwise(w)

    return F.array_join(F.transform(words, word), "")


#: A text without such a character passes every mapping untouched: beside ASCII these are single Latin letters,
#: typographic quotes, dashes, bullets and the ellipsis.
ODD = "[^\\x09\\x0a\\x0d\\x20-\\x7e\\xa1-\\xac\\xae-\\u024f–—‘’“”†•…]"


CONTROL = "[\\x00-\\x08\\x0b\\x0c\\x0e-\\x1f\\x7f]"


def _has(col: Column, beyond_ascii: str) -> Column:
    """Whether a text has a control character or one of the given class; ASCII texts are told by their length in bytes."""
    return F.when(F.octet_length(col) == F.char_length(col), col.rlike(CONTROL)).otherwise(col.rlike(beyond_ascii))


def with_folded(df: DataFrame, text: str, out: str) -> DataFrame:
    """df with a column `out`: the look-alike mapping of string column `text`.

    Tabs, line breaks, typographic quotes, dashes and bullets stay. Null gives null, '' gives ''. In steps, so that the
    planner evaluates each once; texts without odd characters skip them.
    """
    staged = df.withColumn("__odd", _has(F.col(text), ODD)).withColumn("__plain", F.when(F.col("__odd"), plain(F.col(text))).otherwise(F.col(text)))
    staged = staged.withColumn("__foreign", F.when(F.col("__odd"), F.col("__plain").rlike(f"[{FOREIGN}]")))
    staged = staged.withColumn("__real", F.when(F.col("__foreign"), really_foreign(F.col("__plain"))))
    return staged.withColumn(out, F.when(F.col("__foreign"), settled(F.col("__plain"), F.col("__real"))).otherwise(F.col("__plain"))).drop("__plain", "__odd", "__foreign", "__real")


def with_same_form(df: DataFrame, text: str, out: str) -> DataFrame:
    """with_folded, and letters with separate accents composed: one form for keys of other operators."""
    return with_folded(df.withColumn("__any", _has(F.col(text), ODD)), text, "__folded").withColumn(out, F.when(F.col("__any"), compose(F.col("__folded"))).otherwise(F.col("__folded"))).drop("__folded", "__any")


def canonical_values(values: DataFrame, text: str) -> DataFrame:
    """(text, canonical) for the mapped values whose class under the Unicode collation has another canonical member.

    values: rows with a string column of mapped texts. They are made distinct map-side first, so a value that a third
    of all rows hold is one row here. The canonical member has the fewest separate accents, then the fewest characters,
    then comes first in code point order.
    """
    v = values.select(F.col(text).alias("v")).distinct()
    marks = F.char_length(F.regexp_replace("v", "\\P{M}", ""))
    forms = F.when(F.col("v").rlike("\\p{M}"), F.array(F.col("v"), compose(F.col("v")))).otherwise(F.array("v"))
    members = v.select(F.posexplode(forms).alias("p", "v")).select("v", (F.col("p") == 0).alias("own"))
    rank = F.struct(marks.alias("m"), F.char_length("v").alias("n"), F.col("v"))
    same = Window.partitionBy(F.expr("collate(v, 'UNICODE')"))
    chosen = members.withColumn("canonical", F.min(rank).over(same)["v"])
    return chosen.where("own and v <> canonical").select(F.col("v").alias(text), "canonical")


#: Only a text with such a character, or a control character, is changed by the mapping or can equal another text under the collation.
ABLE = "[^\\x00-\\x7f–—‘’“”†•·«»…]"


def _canonical_able(df: DataFrame, text: str, out: str) -> DataFrame:
    """canonical_text of the rows with a character of ABLE; the mapping runs once, into a written table."""
    mapped = _util.cut(with_folded(df.where(_has(F.col(text), ABLE)), text, "__mapped"))
    table = canonical_values(mapped, "__mapped")
    joined = mapped.join(table.withColumnRenamed("canonical", "__canonical"), "__mapped", "left")
    return joined.withColumn(out, F.coalesce("__canonical", "__mapped")).drop("__mapped", "__canonical")


def canonical_text(df: DataFrame, text: str, out: str) -> DataFrame:
    """df with a column `out`: the canonical form of string column `text`.

    Every other column, extra or clashing, passes through; nulls stay null, an empty table gives an empty one and
    repeated rows stay repeated.
    """
    rest = df.where(F.col(text).isNull() | ~_has(F.col(text), ABLE)).withColumn(out, F.col(text))
    return _canonical_able(df, text, out).unionByName(rest)


def long_fields(df: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """(key, field, text) for the non-null values of the given string columns, in one scan."""
    pairs = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("text")) for f in fields])
    return df.select(F.col(key), F.explode(pairs).alias("x")).select(key, "x.field", "x.text").where("text is not null")


def odd_characters(df: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """(key, field) of the stored texts that differ from their canonical form, distinct."""
    long = long_fields(df, key, fields)
    return _canonical_able(long, "text", "canonical").where("canonical <> text").select(key, "field").distinct()


_util.by_value(sys.modules[__name__])
assert len({p[0] for p in ALIKE}) == len(ALIKE)
