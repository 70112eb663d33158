"""Cross-site boilerplate lines by distinct-site spread, in DataFrame functions alone.

A line is compared without the white space around it.  A HyperLogLog sketch of the sites
is kept per line (a pair of hashes); sketches of a line are merged by aggregation wherever
its copies lie.  A line whose estimated spread is clearly above ``min_sites`` is
boilerplate, one clearly below is not, and for those within ``margin`` of the threshold
the distinct sites are counted exactly.  Boilerplate lines leave every document.

A line on fewer rows than ``min_sites`` cannot lie on that many sites, so sketches are
only made for lines that pass this exact bound.

Edge cases: lines without text are never boilerplate and stay; a null site is no site; a
null text stays null, with no lines; a document whose every line goes becomes the empty
text; repeated rows are cleaned alike, row by row.  The sketch's error at ``LG_K`` is 1.6 %
(one sigma); the margin is over twelve of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from caseflow.llm import common as C

MIN_SITES = 10
MARGIN = 0.2
LG_K = 12
_BLANK = "\t\n\x0b\f\r "


def _lines(text: str) -> Column:
    return F.split(F.col(text), "\n", -1)


def _bare(line: Column) -> Column:
    return F.trim(line, F.lit(_BLANK))


def boilerplate(rows: DataFrame, min_sites: int = MIN_SITES, margin: float = MARGIN) -> DataFrame:
    """rows: h1, h2, site.  The (h1, h2) of lines on at least ``min_sites`` different sites."""
    often = rows.groupBy("h1", "h2").agg(F.count("site").alias("n")).where(F.col("n") >= min_sites)
    often = C.stored(often.select("h1", "h2"), "lines-often")
    near = rows.where("site is not null").join(often, ["h1", "h2"], "left_semi")
    sketches = near.groupBy("h1", "h2").agg(F.hll_sketch_agg("site", F.lit(LG_K)).alias("sketch"))
    spread = C.stored(
        sketches.select("h1", "h2", F.hll_sketch_estimate("sketch").alias("spread")), "lines-spread"
    )
    close = F.abs(F.col("spread") - min_sites) <= margin * min_sites
    exact = (
        near.join(spread.where(close), ["h1", "h2"], "left_semi")
        .distinct()
        .groupBy("h1", "h2")
        .agg(F.count("*").alias("n"))
        .where(F.col("n") >= min_sites)
    )
    return spread.where(~close & (F.col("spread") > min_sites)).select("h1", "h2").unionByName(exact.select("h1", "h2"))


def drop_boilerplate(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    site_col: str = "source",
    min_sites: int = MIN_SITES,
    margin: float = MARGIN,
) -> DataFrame:
    """id, n_lines, n_removed and the cleaned text of every document."""
    mine = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"), F.col(site_col).cast("string").alias("site"))
    mine = mine.withColumn("_row", F.xxhash64("_text"))
    lines = mine.select("_id", "_row", "site", F.posexplode(_lines("_text")).alias("at", "line"))
    lines = lines.withColumn("line", _bare(F.col("line"))).where("line <> ''")
    lines = lines.select("_id", "_row", "site", "at", F.xxhash64("line").alias("h1"), F.hash("line").alias("h2"))
    gone = C.stored(boilerplate(lines.select("h1", "h2", "site"), min_sites, margin), "lines-boilerplate")
    hits = (
        lines.select("_id", "_row", "at", "h1", "h2")
        .join(gone, ["h1", "h2"], "left_semi")
        .groupBy(F.col("_id").alias("_hit"), F.col("_row").alias("_hit_row"))
        .agg(F.collect_set("at").alias("_gone"))
    )
    same = F.col("_id").eqNullSafe(F.col("_hit")) & (F.col("_row") == F.col("_hit_row"))
    d = mine.join(hits, same, "left").select("_id", "_text", "_gone")
    kept = F.when(F.col("_gone").isNull(), F.col("_text")).otherwise(
        F.array_join(F.filter(_lines("_text"), lambda x, i: ~F.array_contains("_gone", i)), "\n")
    )
    return d.select(
        F.col("_id").alias(id_col),
        F.when(F.col("_text").isNull(), 0).otherwise(F.size(_lines("_text"))).cast("bigint").alias("n_lines"),
        F.when(F.col("_gone").isNull(), 0).otherwise(F.size("_gone")).cast("bigint").alias("n_removed"),
        kept.alias("text"),
    )
