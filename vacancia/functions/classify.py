"""Keyword classification: ordered rules, first match wins."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from vacancia import fixed_values as V


def _chain(tests: list[tuple[Column, str]], default: str) -> Column:
    (test, label), *rest = tests
    chain = F.when(test, F.lit(label))
    for test, label in rest:
        chain = chain.when(test, F.lit(label))
    return chain.otherwise(F.lit(default))


def classify_contains(col: Column, rules: list[tuple[str, str]], default: str) -> Column:
    """Label of the first keyword found in the lower-cased text; null gives the default."""
    text = F.lower(col)
    return _chain([(text.contains(word), label) for word, label in rules], default)


def classify_rlike(col: Column, rules: list[tuple[str, str]], default: str) -> Column:
    """Label of the first pattern found in the lower-cased text; null gives the default."""
    text = F.lower(col)
    return _chain([(text.rlike(pattern), label) for pattern, label in rules], default)


def work_mode(col: Column) -> Column:
    return classify_contains(col, V.WORK_MODES, V.WORK_MODE_DEFAULT)


def employment_type(col: Column) -> Column:
    return classify_contains(col, V.EMPLOYMENT_TYPES, V.UNKNOWN)


def qualification(col: Column) -> Column:
    return classify_rlike(col, V.QUALIFICATIONS, V.UNKNOWN)


def classify_tags(tags: Column, allowed: list[str]) -> Column:
    """The last tag that belongs to the allowed set, in its own spelling."""
    return F.try_element_at(F.filter(tags, lambda t: F.lower(t).isin(allowed)), F.lit(-1))
