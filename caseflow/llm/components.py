"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from caseflow.llm import common as C


def connected_components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component) for every node of a link; component is the smallest node reachable.

    Alternates two moves until nothing changes: every node hands its larger neighbours to
    the smallest node it knows, then its smaller ones.  Each move is one grouping and one
    join; a node of very many links is pre-aggregated before the shuffle and its join can
    be split, and every round is written to the shared folder.  Links to itself and
    repeated links are harmless; rows with a null end are ignored.
    """
    e = links.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v")
    e = C.stored(e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    before = None
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        # larger neighbours go to the smallest of the neighbourhood
        e = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # then a node's smaller neighbours, and the node itself, do
        least = e.groupBy("u").agg(F.min("v").alias("m"))
        down = e.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = C.stored(down.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "links")
        now = tuple(e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == before:
            break
        before = now
    # at the end every node points at its component's smallest node
    roots = e.select(F.col("v").alias("node")).distinct()
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        roots.withColumn("component", F.col("node"))
    )
