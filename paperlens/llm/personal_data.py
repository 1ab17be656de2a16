"""Personal data: patterns propose spans, checksums confirm them, words near by move their score.

Everything is one expression over the text, with no Python and no shuffle. ``split`` by a pattern gives
the stretches between the matches that ``regexp_extract_all`` gives, so the lengths of both, added up,
are the positions. A value that several steps need is bound by ``let``: it is worked out once, whatever
the optimizer does with the projection or a filter behind it.

The patterns are written so that a text without a match, and one very long word or number, still cost
time in proportion: a run of characters is tried from its start only and never given back.

Nulls: a null text is empty. Repeated rows keep a row each; other columns play no part.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Percent added or taken away by the words near a span, and what a span that is not certain must reach.
STEP, THRESHOLD = 30, 60
# Characters looked at before and behind a span; the neighbouring match of the kind is not crossed.
BEFORE, BEHIND = 40, 20
BLOCK = 128


@dataclass(frozen=True)
class Kind:
    """``pattern`` proposes, ``confirm`` decides; certain kinds stay whatever their score.

    ``alone``: a letter or digit may not stand next to the span. ``holds`` is a character that every
    match has: texts without it are not searched.
    """

    name: str
    pattern: str
    score: int
    confirm: Callable[[Column], Column]
    for_it: str
    against_it: str = ""
    certain: bool = True
    alone: bool = False
    holds: str = ""


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is evaluated once however often ``body`` names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def mod_97(value: Column) -> Column:
    """The remainder of an account number whose first four characters go behind the others."""
    def remainder(text: Column) -> Column:
        codes = F.transform(F.sequence(F.lit(1), F.length(text)), lambda i: F.ascii(F.substring(text, i, F.lit(1))))
        return F.aggregate(codes, F.lit(0), lambda sum_, code: F.when(
            code < 58, (sum_ * 10 + code - 48) % 97).otherwise((sum_ * 100 + code - 55) % 97))

    return let(F.regexp_replace(value, " ", ""), lambda v: let(
        F.concat(F.substring(v, F.lit(5), F.length(v)), F.substring(v, 1, 4)), remainder))


def any_value(value: Column) -> Column:
    return F.lit(True)


BYTE = "0*+(?:[0-9]{0,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
CALLED = "phone|tel|telephone|call|mobile|cell|fax"

KINDS = (
    Kind("email", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", 80, any_value,
         "mail|email|contact|write|reach", "example|noreply", holds="@"),
    Kind("ip", r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}", 50, lambda v: v.rlike(rf"^{BYTE}(?:\.{BYTE}){{3}}$"),
         "ip|host|server|address|login", "version|release|chapter|section|v"),
    Kind("card", r"[0-9](?:[\x20-]?+[0-9])++", 70,
         lambda v: let(digits(v), lambda d: F.length(d).between(12, 19) & F.call_function("luhn_check", d)),
         "card|visa|mastercard|credit|debit|payment|pay", "order|serial|isbn|tracking|id"),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", 70, lambda v: F.length(digits(v)).between(9, 15), CALLED, "serial|id",
         holds="+"),
    Kind("iban", r"[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?", 70, lambda v: mod_97(v) == 1,
         "iban|bank|account|transfer", "serial|part", certain=False, alone=True),
    Kind("ssn", r"[0-9]{3}-[0-9]{2}-[0-9]{4}", 40,
         lambda v: ~v.rlike("^(?:000|666|9)") & ~v.rlike("-00-|-0000$"),
         "ssn|social|security|insurance", "serial|part|order", certain=False, alone=True, holds="-"),
    Kind("local", r"\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}", 40, any_value, CALLED, "serial|part|order",
         certain=False, alone=True),
)
BASE = ("email", "ip", "card", "phone")

CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def sums_before(lengths: Column) -> Column:
    """For each place of an array the sum of those before it, in blocks so that long arrays stay cheap."""
    def run(values: Column) -> Column:
        start = F.struct(F.lit(0).cast("bigint").alias("all"), F.array().cast("array<bigint>").alias("before"))
        return F.aggregate(values, start, lambda state, x: F.struct(
            (state["all"] + x).alias("all"), F.concat(state["before"], F.array(state["all"])).alias("before")))

    blocks = F.transform(
        F.sequence(F.lit(0), ((F.size(lengths) - 1) / BLOCK).cast("int")),
        lambda b: run(F.slice(lengths, b * BLOCK + 1, BLOCK)))
    return let(blocks, lambda found: F.flatten(F.zip_with(
        found, run(F.transform(found, lambda b: b["all"]))["before"],
        lambda block, offset: F.transform(block["before"], lambda x: x + offset))))


def near(before: Column, behind: Column, words: str) -> Column:
    if not words:
        return F.lit(False)
    pattern = f"(^|[^a-z])({words})([^a-z]|$)"
    return before.rlike(pattern) | behind.rlike(pattern)


def spans_of(text: Column, kind: Kind, place: int) -> Column:
    """Confirmed spans of one kind in order: (start, place, end, kind, score, value)."""
    none = F.array().cast("array<struct<start:bigint,place:int,end:bigint,kind:string,score:int,value:string>>")

    def placed(found: Column, gaps: Column, i: Column, offset: Column) -> Column:
        before = F.translate(F.right(F.get(gaps, i), F.lit(BEFORE)), CAPITALS, SMALL)
        behind = F.translate(F.left(F.get(gaps, i + 1), F.lit(BEHIND)), CAPITALS, SMALL)
        value, start = F.get(found, i), offset + F.length(F.get(gaps, i))

        def scored(b: Column) -> Column:
            moved = near(b[0], b[1], kind.for_it).cast("int") - near(b[0], b[1], kind.against_it).cast("int")
            free = ~(b[0].rlike(r"[a-z0-9]\z") | b[1].rlike("^[a-z0-9]")) if kind.alone else F.lit(True)
            score = F.least(F.lit(100), F.lit(kind.score) + moved * STEP)
            return F.struct(
                start.alias("start"), F.lit(place).alias("place"), (start + F.length(value)).alias("end"),
                F.lit(kind.name).alias("kind"), F.when(kind.confirm(value) & free, score).alias("score"),
                value.alias("value"))

        return let(F.array(before, behind), scored)

    def located(found: Column, gaps: Column) -> Column:
        lengths = F.zip_with(F.slice(gaps, 1, F.size(found)), found,
                             lambda gap, value: (F.length(gap) + F.length(value)).cast("bigint"))
        spans = let(lengths, lambda all_: let(sums_before(all_), lambda offsets: F.transform(
            offsets, lambda offset, i: placed(found, gaps, i, offset))))
        return F.filter(spans, lambda s: s["score"].isNotNull() if kind.certain else s["score"] >= THRESHOLD)

    found = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0))
    if kind.holds:
        found = F.when(F.contains(text, F.lit(kind.holds)), found).otherwise(F.array().cast("array<string>"))
    return let(found, lambda found: F.when(
        F.size(found) == 0, none
    ).otherwise(let(F.split(text, kind.pattern, -1), lambda gaps: located(found, gaps))))


def personal_spans(docs: DataFrame, kinds: tuple[Kind, ...] = KINDS) -> DataFrame:
    """(doc_id, spans) of every whole text; spans are (start, place, end, kind, score, value) in that order.

    Positions count code points, the end is exclusive. Spans of one kind never overlap, those of
    different kinds may. An empty text has an empty list.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    spans = [spans_of(text, kind, place) for place, kind in enumerate(kinds)]
    return docs.select("doc_id", F.array_sort(F.concat(*spans)).alias("spans"))


def personal_report(docs: DataFrame) -> DataFrame:
    """Counts, digest of the base spans, and all spans as text, one row for each document."""
    def shown(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def base(spans: Column) -> Column:
        return F.filter(spans, lambda s: s["place"] < len(BASE))

    def count(test: Callable[[Column], Column]) -> Column:
        return F.size(F.filter("spans", test)).cast("bigint")

    def of_kind(name: str) -> Callable[[Column], Column]:
        return lambda s: s["kind"] == name

    return personal_spans(docs).select(
        "doc_id",
        *[count(of_kind(name)).alias(f"n_{name}") for name in BASE],
        F.sha2(shown(base(F.col("spans"))), 256).alias("base_sha256"),
        shown(F.col("spans")).alias("spans"),
        count(lambda s: s["place"] >= len(BASE)).alias("n_added"),
        count(lambda s: s["score"] >= 80).alias("n_likely"),
    )
