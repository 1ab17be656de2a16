"""Mix sources to target weights by Pfair scheduling.

A source's documents are cut into blocks. With the weight w of its source, block j (from 1) may be
placed from slot floor((j - 1) / w) on and must be placed before slot ceil(j / w); at every slot the
released block with the earliest deadline goes. Weights are multiples of one over the slots of a
period, so the schedule repeats after it: one period is made, and every block finds its slot in it by
arithmetic. At any slot each source is within one block of its weight's share.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import small_rows

BUCKET_ROWS = 1_000
# Slots that a period has for each source, at least, so that the one slot that each has by right is a tenth of all.
SLOTS_EACH = 10
# The schedule of one period is a fold in one task, whose work is sources times slots.
MOST_SOURCES = 1_000


def shares(weights: DataFrame, slots: int) -> DataFrame:
    """source, share: whole slots of a period, adding up to ``slots``; at least one each.

    ``weights`` has source and weight, one row for each source; there must be at most ``slots`` sources.
    Largest remainders take what rounding down leaves, ties to the smaller source. The windows run over
    one row for each source.
    """
    every = Window.partitionBy()
    part = F.col("weight") / F.sum("weight").over(every)
    # Rounded, so that the order in which floating-point numbers are added decides nothing.
    out = weights.withColumn("_exact", F.round(part * (slots - F.count("*").over(every)), 9))
    out = out.withColumn("_floor", F.floor("_exact"))
    left = slots - F.sum(F.col("_floor") + 1).over(every)
    rank = F.row_number().over(Window.orderBy(F.desc(F.col("_exact") - F.col("_floor")), F.asc_nulls_first("source")))
    out = out.withColumn("_left", left).withColumn("_rank", rank)
    return out.select("source", (F.col("_floor") + 1 + (F.col("_rank") <= F.col("_left")).cast("long")).cast("int").alias("share"))


def period(sources: DataFrame, slots: int) -> DataFrame:
    """slot, source, turn (from 0), share: earliest deadline first over one period of ``slots`` slots.

    A fold over the slots; its state holds the turns that each source has had. ``slots`` rows come out,
    whatever the size of the data.
    """
    listed = sources.agg(F.sort_array(F.collect_list(F.struct("source", "share"))).alias("sources"))
    start = F.struct(F.transform("sources", lambda s: F.lit(0)).alias("had"), F.array().cast("array<int>").alias("picks"))

    def step(state: Column, slot: Column) -> Column:
        def deadline(s: Column, i: Column) -> Column:
            had = F.get(state["had"], i)
            released = F.floor(had * slots / s["share"]) <= slot
            return F.when(released, F.struct(F.ceil((had + 1) * slots / s["share"]).alias("by"), i.alias("i")))

        def placed(first: Column) -> Column:
            had = F.transform(state["had"], lambda n, i: n + F.when(i == first, 1).otherwise(0))
            return F.struct(had.alias("had"), F.concat(state["picks"], F.array(F.coalesce(first, F.lit(-1)))).alias("picks"))

        # As the argument of a lambda, the earliest deadline is looked for once a slot and not once a source.
        return F.get(F.transform(F.array(F.array_min(F.transform("sources", deadline))["i"]), placed), F.lit(0))

    # Shares of no source at all, of an empty table, give no period.
    slots_of = F.when(F.size("sources") > 0, F.sequence(F.lit(0), F.lit(slots - 1))).otherwise(F.array().cast("array<int>"))
    picks = listed.select("sources", F.aggregate(slots_of, start, step)["picks"].alias("picks"))
    rows = picks.select("sources", F.posexplode("picks").alias("slot", "pick"))
    rows = rows.select("slot", F.get("sources", F.col("pick")).alias("s")).select("slot", "s.source", "s.share")
    turn = F.row_number().over(Window.partitionBy("source").orderBy("slot")) - 1
    return rows.withColumn("turn", turn)


def key_of(source: Column) -> Column:
    """A source as a string that is never null, so that joins and windows share one partitioning."""
    return F.coalesce(F.concat(F.lit("s"), source.cast("string")), F.lit("null"))


def numbered(rows: DataFrame, sizes: DataFrame, order: Column) -> DataFrame:
    """``rows`` with ``_size`` of their source and ``_index``: their position in it by ``order``, a hexadecimal digest.

    A source is cut into ranges of its digests of about BUCKET_ROWS rows, so that no task has to hold a
    whole source; rows are numbered in each range, and the ranges' counts are summed up. ``sizes`` has one
    row for each source.
    """
    point = F.conv(F.substring("_digest", 1, 8), 16, 10).cast("long") / F.lit(float(1 << 32))
    rows = rows.withColumn("_digest", order).join(F.broadcast(sizes), "_key")
    rows = rows.withColumn("_range", F.floor(point * F.ceil(F.col("_size") / BUCKET_ROWS)))
    counts = rows.groupBy("_key", "_range").agg(F.count("*").alias("_n"))
    before = Window.partitionBy("_key").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("_key", "_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    place = F.row_number().over(Window.partitionBy("_key", "_range").orderBy("_digest", "doc_id"))
    rows = rows.withColumn("_place", place).join(counts, ["_key", "_range"])
    return rows.withColumn("_index", F.col("_before") + F.col("_place") - 1).drop("_before", "_place", "_range", "_digest")


def mix(docs: DataFrame, weights: DataFrame | None = None, block_rows: int = 16, slots: int = 1000,
        repeat: bool = True, power: float = 0.8) -> DataFrame:
    """``docs`` placed in a mixture: ``slot``, ``epoch`` and ``block`` beside the columns of ``docs``.

    ``weights`` (source, weight > 0) gives the target share of blocks; by default a source weighs its
    number of documents to the power ``power``, which brings small sources forward. A period has ``slots``
    slots, the precision of the weights, or SLOTS_EACH for each source if that is more; the sources are
    counted at once, and more than MOST_SOURCES are an error. A source without a weight is an error of
    the caller and is left out by the join. With ``repeat`` every source goes round until the one that takes
    longest has been placed once, so the target holds to the last slot, no document is left out, and
    ``epoch`` counts the rounds; without it every document is placed once, and a source that has ended
    leaves its slots empty. Within a source the order is that of a digest of doc_id. A null source is a
    source of its own, null ids come first, rows with equal ids are interchangeable, and an empty table
    gives no rows. Columns named slot, epoch or block are replaced.
    """
    rows = docs.drop("slot", "epoch", "block").withColumn("_key", key_of(F.col("source")))
    # One row for each source, of which there are at most MOST_SOURCES: small enough to broadcast.
    sizes = rows.groupBy("_key").agg(F.count("*").alias("_size"))
    if weights is None:
        weights = rows.groupBy("source").agg(F.pow(F.count("*"), F.lit(power)).alias("weight"))
    slots = max(slots, SLOTS_EACH * len(small_rows(weights.select("source"), MOST_SOURCES, "sources")))
    per_source = period(shares(weights, slots), slots).groupBy("source").agg(
        F.first("share").alias("_share"), F.sort_array(F.collect_list("slot")).alias("_slots"),
    ).select(key_of(F.col("source")).alias("_key"), "_share", "_slots")
    order = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    placed = numbered(rows, sizes, order).withColumn("block", F.floor(F.col("_index") / block_rows)).drop("_index")
    out = placed.join(F.broadcast(per_source), "_key").withColumn("_blocks", F.ceil(F.col("_size") / block_rows))
    helpers = ["_key", "_share", "_slots", "_blocks", "_size"]

    def slot_of(turn: Column) -> Column:
        return F.floor(turn / F.col("_share")) * slots + F.get("_slots", (turn % F.col("_share")).cast("int"))

    if not repeat:
        return out.withColumn("slot", slot_of(F.col("block"))).withColumn("epoch", F.lit(0).cast("long")).drop(*helpers)
    # The slot at which the last source has been placed once.
    last = F.ceil(F.col("_size") / block_rows) - 1
    end = sizes.join(F.broadcast(per_source), "_key").agg(F.max(slot_of(last))).scalar()
    out = out.withColumn("_end", end)
    most = (F.floor(F.col("_end") / slots) + 1) * F.col("_share") - 1
    turns_of = F.sequence(F.col("block"), F.greatest(most, F.col("block")), F.col("_blocks"))
    out = out.withColumn("_turn", F.explode(turns_of)).withColumn("slot", slot_of(F.col("_turn")))
    out = out.filter(F.col("slot") <= F.col("_end")).withColumn("epoch", F.floor(F.col("_turn") / F.col("_blocks")))
    return out.drop(*helpers, "_end", "_turn")


def in_mixed_order(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` as the mixture places them, in its order, with their columns as they are.

    Rows come out in ranges of slots, sorted within each, so that files written from them hold the
    mixture from the first to the last; a document that goes round again comes out again.
    """
    packed = docs.select(F.struct(*docs.columns).alias("_row"), "doc_id", "source")
    placed = mix(packed, **options)
    return placed.repartitionByRange("slot").sortWithinPartitions("slot", "doc_id").select("_row.*")


def with_position(docs: DataFrame, column: str = "position") -> DataFrame:
    """``docs``, read from Parquet files that ``in_mixed_order`` wrote, with the place of each row in the mixture from 0.

    Files are in the order of their part numbers and rows in that of their file. Rows are counted in each
    file by reading no column; the window over the counts has one row for each file. A column of this name
    is replaced; an empty table gives no rows.
    """
    rows = docs.drop(column).select("*", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    sizes = docs.select(F.col("_metadata.file_name").alias("_file")).groupBy("_file").agg(F.count("*").alias("_n"))
    part = F.regexp_extract("_file", "^part-([0-9]+)", 1).cast("long")
    before = F.sum("_n").over(Window.orderBy(part, "_file").rowsBetween(Window.unboundedPreceding, -1))
    starts = sizes.select("_file", F.coalesce(before, F.lit(0)).alias("_before"))
    return rows.join(starts, "_file").withColumn(column, F.col("_before") + F.col("_row")).drop("_file", "_row", "_before")
