"""Mixing sources to target weights by Pfair scheduling, in DataFrame functions alone.

Each source's documents, in a fixed pseudo-random order, are cut into blocks of
``block_units`` (code points, one more for each document).  Target weights are rounded to
whole blocks of a cycle of about ``cycle`` slots (largest remainder, one at least).

Think of all sources flowing at once, source i at rate c_i until its blocks run out: when
each has given c_i x blocks or all it has, t(x) = sum of min(c_k x, m_k) blocks have gone.
Block j of source i is released at floor(t(j / c_i)) and due by ceil(t((j + 1) / c_i)); in
every slot the released block that is due first goes next.  With these windows every source
is at any slot less than one block away from its share, and when one has run out the others
keep their proportions.  No document is dropped or repeated.

Cycles with the same blocks left have the same schedule, and these change only where a
source runs out: for S sources at most 2 S + 1 schedules of at most ``cycle + S`` slots
are computed, whatever the size of the corpus, and joined to the blocks by equality.

Places inside a source are sums over 65,536 hash buckets, so no window holds a source.

Edge cases: a null source is a source of its own; null text counts as empty; sources
without a weight, and weights that are null or not positive, count as weight 1; rows equal in id
and length are interchangeable; a null id sorts first; empty tables give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from caseflow.llm import common as C

BLOCK_UNITS = 1 << 16
CYCLE = 1000


def source_key(col: str) -> Column:
    """The source as text, with null apart from every name."""
    return F.coalesce(F.concat(F.lit("="), F.col(col).cast("string")), F.lit("-"))


def placed(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """_key, _id, _hash, _units and _start: units before the document in its source."""
    rows = docs.select(
        source_key(source_col).alias("_key"),
        F.col(id_col).alias("_id"),
        F.md5(F.concat(F.lit("mix|"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))).alias("_hash"),
        (F.coalesce(F.length(text_col), F.lit(0)) + 1).cast("bigint").alias("_units"),
    ).withColumn("_bucket", F.substring("_hash", 1, 4))
    sums = rows.groupBy("_key", "_bucket").agg(F.sum("_units").alias("_sum"))
    before = W.partitionBy("_key").orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    sums = sums.withColumn("_base", F.coalesce(F.sum("_sum").over(before), F.lit(0))).drop("_sum")
    inside = W.partitionBy("_key", "_bucket").orderBy("_hash", "_id", "_units").rowsBetween(W.unboundedPreceding, 0)
    return (
        rows.withColumn("_upto", F.sum("_units").over(inside))
        .join(sums, ["_key", "_bucket"])
        .withColumn("_start", F.col("_base") + F.col("_upto") - F.col("_units"))
        .drop("_base", "_upto", "_bucket")
    )


def slots_of_cycle(totals: DataFrame, weights: DataFrame, cycle: int) -> DataFrame:
    """totals: _key, _blocks; weights: _key, _weight (whole numbers).  Adds _share, slots a cycle."""
    w = F.when(F.col("_weight") > 0, F.col("_weight")).otherwise(1).cast("bigint")
    rows = totals.join(weights, "_key", "left").select("_key", "_blocks", w.alias("_weight"))
    every = rows.agg(F.sum("_weight").alias("_all"), F.collect_list(F.struct("_key", "_weight", "_blocks")).alias("_rows"))
    # one row with an entry per source: the table of sources is small by nature
    part = F.transform(
        "_rows",
        lambda r: F.struct(
            r["_key"].alias("key"),
            r["_blocks"].alias("blocks"),
            F.floor(r["_weight"] * cycle / F.col("_all")).cast("bigint").alias("whole"),
            ((r["_weight"] * cycle) % F.col("_all")).alias("rest"),
        ),
    )
    every = every.select(part.alias("p"))
    left = F.lit(cycle) - F.aggregate("p", F.lit(0).cast("bigint"), lambda s, r: s + r["whole"])
    ordered = F.array_sort(F.transform("p", lambda r: F.struct((-r["rest"]).alias("rest"), r["key"].alias("key"))))
    every = every.select("p", F.slice(ordered, 1, F.greatest(left, F.lit(0)).cast("int")).alias("bonus"))
    more = lambda r: F.exists("bonus", lambda b: b["key"] == r["key"]).cast("bigint")
    return every.select(
        F.array_sort(
            F.transform(
                "p",
                lambda r: F.struct(
                    r["key"].alias("key"),
                    r["blocks"].alias("blocks"),
                    F.greatest(F.lit(1), r["whole"] + more(r)).cast("int").alias("share"),
                ),
            )
        ).alias("sources")
    )


def schedules(sources: DataFrame) -> DataFrame:
    """One row per stretch of equal cycles: sources, cuts, first cycle, first slot, length, picks.

    ``picks`` names, slot by slot, the source (its place in ``sources``) of the block that
    is due first among those released.
    """
    cuts = F.array_sort(
        F.array_distinct(
            F.flatten(
                F.transform(
                    "sources",
                    lambda r: F.array(F.lit(0).cast("bigint"), F.floor(r["blocks"] / r["share"]), F.ceil(r["blocks"] / r["share"])),
                )
            )
        )
    )
    d = sources.withColumn("cuts", cuts).withColumn("cut", F.explode("cuts"))
    left = lambda r: F.least(r["share"], F.greatest(F.lit(0), r["blocks"] - r["share"] * F.col("cut"))).cast("int")
    d = d.withColumn("m", F.transform("sources", left))
    d = d.withColumn("length", F.aggregate("m", F.lit(0), lambda s, x: s + x)).where("length > 0")
    # slots before this stretch: every source has given share blocks a cycle, or all it has
    gone = lambda s, r: s + F.least(r["blocks"], r["share"] * F.col("cut"))
    d = d.withColumn("base", F.aggregate("sources", F.lit(0).cast("bigint"), gone))
    def window(i: Column, j: Column) -> Column:
        c = F.get("sources", i)["share"]
        gone = lambda n: F.aggregate(
            F.arrays_zip("sources", "m"),
            F.lit(0).cast("bigint"),
            lambda s, r: s + F.least(r["sources"]["share"] * n, r["m"] * c),
        )
        return F.struct(F.ceil(gone(j + 1) / c).alias("due"), F.floor(gone(j) / c).alias("released"))

    def blocks(m: Column, i: Column) -> Column:
        none = F.array().cast("array<struct<due:bigint,released:bigint>>")
        return F.when(m > 0, F.transform(F.sequence(F.lit(0), m - 1), lambda j: window(i, j))).otherwise(none)

    # a row per stretch: dealt out, the folds below run side by side
    d = d.withColumn("windows", F.transform("m", blocks)).repartition(F.col("cut"))
    start = F.struct(F.transform("m", lambda x: F.lit(0)).alias("given"), F.array().cast("array<int>").alias("picks"))

    def due(given: Column, slot: Column) -> Column:
        def next_of(blocks: Column, i: Column) -> Column:
            block = F.get(blocks, F.get(given, i))
            return F.when(block["released"] <= slot, F.struct(block["due"].alias("due"), i.alias("source")))

        return F.array_min(F.transform("windows", next_of))["source"]

    def step(acc: Column, slot: Column) -> Column:
        pick = due(acc["given"], slot)
        return F.struct(
            F.transform(acc["given"], lambda g, i: F.when(i == pick, g + 1).otherwise(g)).alias("given"),
            F.concat(acc["picks"], F.array(pick)).alias("picks"),
        )

    run = F.aggregate(F.sequence(F.lit(0), F.col("length") - 1), start, step, lambda acc: acc["picks"])
    return d.withColumn("picks", run).drop("windows")


def mix(
    docs: DataFrame,
    weights: DataFrame | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    block_units: int = BLOCK_UNITS,
    cycle: int = CYCLE,
) -> DataFrame:
    """id, source key, units, block, mix_slot and mix_offset of every document.

    ``weights`` has columns source and weight (whole numbers); without it every source's
    weight is the square root of its number of blocks, rounded down.  Documents go in order
    of (mix_slot, mix_offset); a document lies in the slot its first unit lies in.
    """
    rows = placed(docs, id_col, text_col, source_col).withColumn(
        "_block", F.floor(F.col("_start") / block_units).cast("bigint")
    )
    totals = docs.groupBy(source_key(source_col).alias("_key")).agg(
        F.sum(F.coalesce(F.length(text_col), F.lit(0)).cast("bigint") + 1).alias("_units")
    )
    totals = totals.select("_key", F.ceil(F.col("_units") / block_units).cast("bigint").alias("_blocks"))
    if weights is None:
        wanted = totals.select("_key", F.floor(F.sqrt("_blocks")).cast("bigint").alias("_weight"))
    else:
        wanted = weights.select(source_key("source").alias("_key"), F.col("weight").cast("bigint").alias("_weight"))
    # a few rows; written, as three branches read it
    plan = C.stored(schedules(slots_of_cycle(totals, wanted, cycle)), "mix-plan")
    slots = plan.select("cut", "base", "length", "sources", F.posexplode("picks").alias("_at", "_pick"))
    nth = W.partitionBy("cut", "_pick").orderBy("_at")
    slots = slots.select(
        "cut",
        F.get("sources", "_pick")["key"].alias("_key"),
        (F.row_number().over(nth) - 1).cast("bigint").alias("_nth"),
        "base",
        "length",
        "_at",
    )
    shares = plan.where("cut = 0").select("cuts", F.explode("sources").alias("s"))
    shares = shares.select(F.col("s.key").alias("_key"), F.col("s.share").alias("_share"), "cuts")
    d = rows.join(shares, "_key").withColumn("_cycle", F.floor(F.col("_block") / F.col("_share")))
    d = d.withColumn("cut", F.array_max(F.filter("cuts", lambda c: c <= F.col("_cycle"))))
    d = d.withColumn("_nth", F.col("_block") - F.col("_cycle") * F.col("_share"))
    d = d.join(slots, ["_key", "cut", "_nth"])
    return d.select(
        F.col("_id").alias(id_col),
        F.col("_key").alias("source_key"),
        F.col("_units").alias("units"),
        F.col("_block").alias("block"),
        (F.col("base") + (F.col("_cycle") - F.col("cut")) * F.col("length") + F.col("_at")).alias("mix_slot"),
        (F.col("_start") - F.col("_block") * block_units).alias("mix_offset"),
    )


def in_mix_order(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **params) -> DataFrame:
    """The documents, all columns and rows, dealt to tasks in mix order and sorted inside them.

    Written as files, one task's documents are one stretch of the mix, so whoever reads a
    file in order gets the sources at their weights.  Rows equal in id and length share a place.
    """
    places = mix(docs, id_col=id_col, text_col=text_col, **params)
    places = places.groupBy(F.col(id_col).alias("_id"), F.col("units").alias("_units")).agg(
        F.min(F.struct("mix_slot", "mix_offset")).alias("_place")
    )
    row = docs.select(
        F.struct("*").alias("_row"),
        F.col(id_col).alias("_mine"),
        (F.coalesce(F.length(text_col), F.lit(0)) + 1).cast("bigint").alias("_length"),
    )
    same = F.col("_mine").eqNullSafe(F.col("_id")) & (F.col("_length") == F.col("_units"))
    d = row.join(places, same).select("_row", "_place")
    return d.repartitionByRange("_place").sortWithinPartitions("_place").select("_row.*")
