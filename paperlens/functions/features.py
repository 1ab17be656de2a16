"""The 27 model inputs as one projection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..constants import (
    BUZZWORD_FEATURES,
    BUZZWORDS,
    CATEGORY_FEATURES,
    FEATURE_COLS,
    TARGET_CATEGORIES,
)
from .dates import day_of_week, month_of_year

_NUMBER = r"\A\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*\z"


def list_len(values: Column) -> Column:
    return F.coalesce(F.array_size(values), F.lit(0))


def text_len(text: Column, unit: str = "chars") -> Column:
    """Length in code points (training) or UTF-8 bytes (online scoring); NULL is 0."""
    if unit not in ("chars", "bytes"):
        raise ValueError("unit must be 'chars' or 'bytes'")
    return F.coalesce(F.length(text) if unit == "chars" else F.octet_length(text), F.lit(0))


def category_flags(categories: Column, wanted: list[str] = TARGET_CATEGORIES) -> list[Column]:
    """One 0/1 flag per wanted category; a NULL list has none."""
    return [
        F.coalesce(F.array_contains(categories, c), F.lit(False)).cast("int") for c in wanted
    ]


def buzzword_flags(title: Column, words: list[str] = BUZZWORDS) -> list[Column]:
    """One 0/1 flag per literal substring of the lower-cased title; a NULL title has none."""
    lowered = F.lower(title)
    return [F.coalesce(F.contains(lowered, F.lit(w)), F.lit(False)).cast("int") for w in words]


def whole_number(value: Column, kind: T.DataType) -> Column:
    """Numeric coercion: NULL, NaN and non-numbers are 0; fractions are cut off."""
    if isinstance(kind, T.StringType):
        value = F.when(value.rlike(_NUMBER), F.trim(value)).try_cast("double")
    if not isinstance(kind, T.IntegralType):
        value = F.nanvl(value.cast("double"), F.lit(0.0))
    return F.coalesce(value, F.lit(0)).cast("bigint")


def author_signals(df: DataFrame) -> list[Column]:
    """h-index, prior papers and the enrichment flag, by which of the columns the table has."""
    if "max_h_index" not in df.columns:
        return [F.lit(0).cast("bigint"), F.lit(0).cast("bigint"), F.lit(0)]

    def number(name: str) -> Column:
        if name not in df.columns:
            return F.lit(0).cast("bigint")
        return whole_number(F.col(name), df.schema[name].dataType)

    if "has_author_enrichment" in df.columns:
        enriched = F.coalesce(F.col("has_author_enrichment").cast("boolean"), F.lit(False))
    else:
        enriched = F.col("max_h_index").isNotNull()
    return [number("max_h_index"), number("total_prior_papers"), enriched.cast("int")]


def feature_columns(df: DataFrame, text_unit: str = "chars") -> list[Column]:
    """The features of ``df`` in contract order, each under its contract name."""
    authors = "authors" if "authors" in df.columns else "author_names"
    columns = [
        list_len(F.col(authors)),
        text_len(F.col("abstract"), text_unit),
        text_len(F.col("title"), text_unit),
        day_of_week(F.col("submitted_at")),
        month_of_year(F.col("submitted_at")),
        list_len(F.col("categories")),
        *category_flags(F.col("categories")),
        *buzzword_flags(F.col("title")),
        *author_signals(df),
    ]
    return [c.alias(name) for c, name in zip(columns, FEATURE_COLS, strict=True)]


def build_features(df: DataFrame, keep: tuple[str, ...] = (), text_unit: str = "chars") -> DataFrame:
    """Feature matrix, led by the ``keep`` columns of the input."""
    return df.select(*keep, *feature_columns(df, text_unit))


def get_label(label: Column) -> Column:
    return label.cast("int")


def category_multi_hot(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    flags = category_flags(F.col("categories"))
    return df.select(*keep, *[c.alias(n) for c, n in zip(flags, CATEGORY_FEATURES)])


def buzzword_table(df: DataFrame, keep: tuple[str, ...] = (), words: list[str] | None = None) -> DataFrame:
    names = BUZZWORD_FEATURES if words is None else [f"buzz_{w}" for w in words]
    flags = buzzword_flags(F.col("title"), words or BUZZWORDS)
    return df.select(*keep, *[c.alias(n) for c, n in zip(flags, names)])
