"""Author lists."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def author_structs(parsed: Column) -> Column:
    """``[[last, first, ...], ...]`` to ``[{name: "First Last"}, ...]``; NULL list to empty list."""

    def named(parts: Column) -> Column:
        last = F.trim(F.get(parts, F.lit(0)))
        first = F.trim(F.get(parts, F.lit(1)))
        name = F.when(first == "", last).otherwise(F.concat(first, F.lit(" "), last))
        return F.struct(name.alias("name"))

    empty = F.array().cast("array<struct<name: string>>")
    return F.coalesce(F.transform(parsed, named), empty)


def author_names(raw: Column) -> Column:
    """Names from a JSON array of ``{name}``; NULL for empty or malformed JSON."""
    return struct_names(F.from_json(raw, "array<struct<name: string>>"))


def struct_names(authors: Column) -> Column:
    return F.transform(authors, lambda a: F.coalesce(a.getField("name"), F.lit("")))
