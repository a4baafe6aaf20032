"""Text normalisation as Column expressions; nothing leaves the JVM."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlens.schema import NULL_TOKENS, TRUE_TOKENS, UNKNOWN

BLANKS = " \t\n\r\f\v"


def _col(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value


def snake_case(label: str) -> str:
    return re.sub(r"[^a-z0-9]+", "_", label.lower()).strip("_")


def standardize_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[snake_case(name) for name in df.columns])


def require_columns(df: DataFrame, required: list[str], table: str) -> None:
    absent = sorted(name for name in required if name not in df.columns)
    if absent:
        raise ValueError(f"{table} is missing required columns: {absent}")


def null_tokens(value: str | Column) -> Column:
    """Text spellings of a missing value become NULL."""
    value = _col(value)
    return F.when(~value.isin(NULL_TOKENS), value)


def clean_text(value: str | Column) -> Column:
    """Strip surrounding white space; empty text becomes NULL."""
    return F.nullif(F.btrim(_col(value).cast("string"), F.lit(BLANKS)), F.lit(""))


def title_case(value: str | Column) -> Column:
    """Upper-case every letter that follows a non-letter, lower-case the others."""
    runs = F.regexp_extract_all(F.lower(clean_text(value)), F.lit(r"(\p{L}+|\P{L}+)"), F.lit(0))
    return F.array_join(F.transform(runs, lambda run: F.concat(
        F.upper(F.substring(run, 1, 1)), run.substr(F.lit(2), F.length(run)))), "")


def business_key(value: str | Column) -> Column:
    return F.upper(clean_text(value))


def canonical(value: str | Column, vocabulary: list[str]) -> Column:
    """Map case and spacing variants to the approved word; anything else becomes NULL."""
    pairs = [F.lit(item) for word in vocabulary for item in (word.lower(), word)]
    return F.try_element_at(F.create_map(*pairs), F.lower(clean_text(value)))


def or_unknown(value: str | Column) -> Column:
    return F.coalesce(_col(value), F.lit(UNKNOWN))


def to_flag(value: str | Column) -> Column:
    """True for the approved tokens; NULL and every other token are False."""
    return F.coalesce(F.lower(clean_text(value)).isin(TRUE_TOKENS), F.lit(False))


def has_outer_blanks(value: str | Column) -> Column:
    value = _col(value).cast("string")
    return F.coalesce(F.btrim(value, F.lit(BLANKS)) != value, F.lit(False))


def label_of(value: str | Column, labels: dict[str, str], other: str = "Other") -> Column:
    pairs = [F.lit(item) for pair in labels.items() for item in pair]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), _col(value)), F.lit(other))


def category_of(value: str | Column, rules: list[tuple[list[str], str]],
                other: str = "Other") -> Column:
    """Label of the first rule one of whose substrings occurs, ignoring case."""
    lowered = F.lower(_col(value))
    chain = None
    for fragments, label in rules:
        hit = F.lit(False)
        for fragment in fragments:
            hit = hit | lowered.contains(fragment)
        chain = F.when(hit, label) if chain is None else chain.when(hit, label)
    return chain.otherwise(other)


def prettify(value: str | Column) -> Column:
    """data_quality_score becomes Data Quality Score."""
    return F.initcap(F.replace(_col(value), F.lit("_"), F.lit(" ")))


def record_json(columns: list[str], prefix: str = "", missing: str = "<NULL>") -> Column:
    """One JSON document per row with keys in sorted order; NULL is spelled out.

    `prefix` is the part of the column names that the keys do not carry.
    """
    return F.to_json(F.struct(*[
        F.coalesce(F.col(prefix + name).cast("string"), F.lit(missing)).alias(name)
        for name in sorted(columns)]))
