"""String similarities that no built-in expresses, as Arrow-batched UDFs, and the scores built on them."""

from __future__ import annotations

import sys
from difflib import SequenceMatcher

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from citeloom.functions.text import name_key, normalized_title


@F.pandas_udf(DoubleType())
def sequence_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """Ratcliff-Obershelp ratio of each pair; the second string is the reference one. Null gives 0."""
    return pd.Series([(1.0 if x == y else SequenceMatcher(None, x, y).ratio()) if x and y else 0.0 for x, y in zip(a, b)], dtype="float64")


def jaccard(a: Column, b: Column) -> Column:
    return F.coalesce(F.try_divide(F.size(F.array_intersect(a, b)).cast("double"), F.size(F.array_union(a, b))), F.lit(0.0))


def containment(a: Column, b: Column) -> Column:
    return F.coalesce(F.try_divide(F.size(F.array_intersect(a, b)).cast("double"), F.size(F.array_distinct(a))), F.lit(0.0))


def token_set(x: Column) -> Column:
    return F.array_distinct(F.array_remove(F.split(x, " "), ""))


def title_score(query: Column, candidate: Column) -> Column:
    """Half sequence ratio, the rest Jaccard (0.3) and containment (0.2) of the words; 4 digits."""
    q, c = normalized_title(query), normalized_title(candidate)
    s = F.round(0.5 * sequence_ratio(q, c) + 0.3 * jaccard(token_set(q), token_set(c)) + 0.2 * containment(token_set(q), token_set(c)), 4)
    return F.when((q == "") | (c == ""), 0.0).otherwise(s)


def year_adjusted(score: Column, a: Column, b: Column) -> Column:
    """+0.04 within a year (at most 1), -0.08 beyond three (at least 0)."""
    gap = F.abs(a - b)
    return F.when(gap <= 1, F.least(score + 0.04, F.lit(1.0))).when(gap > 3, F.greatest(score - 0.08, F.lit(0.0))).otherwise(score)


def _first(ws: Column) -> Column:
    return F.get(ws, 0)


def _letter(w: Column) -> Column:
    return F.substring(w, 1, 1)


def compatible(a: Column, b: Column) -> Column:
    """Same surname, and given names that agree as far as both spell them out."""
    ka, kb = name_key(a), name_key(b)
    ta, tb = F.split(ka, " "), F.split(kb, " ")
    fa, fb = _first(ta), _first(tb)
    spelled = (F.char_length(fa) > 1) & (F.char_length(fb) > 1) & (fa != fb)
    prefix = (F.least(F.char_length(fa), F.char_length(fb)) >= 3) & (F.startswith(fa, fb) | F.startswith(fb, fa))
    core = lambda t: F.slice(t, F.lit(1), F.size(t) - 1)
    m = F.least(F.size(ta), F.size(tb)) - 1
    same = F.forall(F.zip_with(F.slice(core(ta), F.lit(1), m), F.slice(core(tb), F.lit(1), m), lambda x, y: _letter(x) == _letter(y)), lambda x: x)
    agree = (_letter(fa) == _letter(fb)) & (~spelled | prefix) & ((F.size(ta) == 2) | (F.size(tb) == 2) | same)
    return F.when((ka == "") | (kb == ""), False).when(F.element_at(ta, -1) != F.element_at(tb, -1), False).when(ka == kb, True).otherwise(F.coalesce(agree, F.lit(False)))


def name_similarity(a: Column, b: Column) -> Column:
    """1 for equal keys, 0 for unlike surnames or initials, fixed steps for compatible forms, else a blend; 4 digits."""
    ka, kb = name_key(a), name_key(b)
    ta, tb = F.split(ka, " "), F.split(kb, " ")
    sa, sb, fa, fb = F.element_at(ta, -1), F.element_at(tb, -1), _first(ta), _first(tb)
    surname = sequence_ratio(sa, sb)
    blend = F.round(0.45 * surname + 0.25 * sequence_ratio(fa, fb) + 0.3 * sequence_ratio(ka, kb), 4)
    one = (F.char_length(fa) == 1) | (F.char_length(fb) == 1)
    return (
        F.when((ka == "") | (kb == ""), 0.0).when(ka == kb, 1.0).when((surname < 0.88) | (_letter(fa) != _letter(fb)), 0.0)
        .when(compatible(a, b), 0.97).when((sa == sb) & (fa == fb), 0.985).when((sa == sb) & one, 0.96).otherwise(blend)
    )


# functions travel with their code, so executors need not have the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])
