"""Patient XML files read in parallel, whatever their size, once.

``<`` cannot stand inside a well-formed tag or text, so Spark's text source, with it as the line
separator, deals a large file to tasks by byte ranges, and every row is one tag and the
text after it.  What a tag lies in is carried along a file: open patient and section, depth,
and comments.  Stretches of byte ranges are the chunks of these running values, so that no task
walks a file; a chunk passes on one row, and tasks get about the same number of rows at every size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from caseflow.plans.spread import carried, running, stored

#: A tag's name, attributes and end, without quoted values.
_TAG = r"^/?[\w.:-]+(\s+[\w.:-]+\s*=\s*)*\s*/?>$"
_QUOTED = r""""[^"]*"|'[^']*'"""
#: Entities every XML reader knows. Fixed values; the last stands for what begins an entity.
_ENTITIES = {"lt": "<", "gt": ">", "quot": '"', "apos": "'", "amp": "&"}


#: Pieces of a chunk at most, as a power of two, and of a task's chunks on average.
_CHUNK_BITS = 12
_TASK_ROWS = 1 << 16


def _decoded(text: Column) -> Column:
    """Character references as characters."""
    code = lambda n: F.when(F.startswith(n, F.lit("x")), F.conv(F.substring(n, 2, 8), 16, 10)).otherwise(n).cast("int")
    char = lambda n: F.decode(F.unhex(F.lpad(F.hex(code(n)), 8, "0")), "UTF-32")
    numbers = F.array_distinct(F.regexp_extract_all(text, F.lit("&#(x?[0-9A-Fa-f]+);"), F.lit(1)))
    plain = F.aggregate(numbers, text, lambda s, n: F.replace(s, F.concat(F.lit("&#"), n, F.lit(";")), char(n)))
    for name, letter in _ENTITIES.items():
        plain = F.replace(plain, F.lit(f"&{name};"), F.lit(letter))
    return F.when(text.contains("&"), plain).otherwise(text)


def attribute(tag: Column, name: str) -> Column:
    """The value of a tag's attribute; null when it has none of that name."""
    pattern = rf"""\s{name}\s*=\s*(?:"([^"]*)"|'([^']*)')"""
    value = F.concat(F.regexp_extract(tag, pattern, 1), F.regexp_extract(tag, pattern, 2))
    return F.when(tag.rlike(pattern), _decoded(value))


def _rows(spark: SparkSession, path: str) -> DataFrame:
    """file_path, _block, _at (order inside a block) and text of each piece that follows a ``<``."""
    raw = spark.read.option("lineSep", "<").option("recursiveFileLookup", "true").text(path)
    return raw.select(
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_at"),
        F.col("value").alias("_text"),
    )


def _chunk() -> Column:
    """Stretches of a block: the order goes on inside a block, so they do not decrease along it."""
    return F.struct("_block", F.shiftright("_at", _CHUNK_BITS).alias("stretch"))


def _without_comments(rows: DataFrame, parts: int) -> DataFrame:
    """Tags alone: no text before the first, no comments, declarations or instructions."""
    begins = F.startswith("_text", F.lit("!--")) | F.startswith("_text", F.lit("![CDATA["))
    ends = F.col("_text").contains("-->") | F.col("_text").contains("]]>")
    mark = F.when(begins & ~ends, 1).when(ends, 0)
    if not rows.where(mark == 1).isEmpty():  # only then does one reach over tags
        rows = carried(rows, ["_at"], {"_inside": mark}, ["file_path"], _chunk(), parts)
        rows = rows.where(F.coalesce("_inside", F.lit(0)) == 0)
    blank = F.trim(F.translate("_text", "﻿\t\r\n", "")) == ""
    return rows.where(~(blank | F.startswith("_text", F.lit("!")) | F.startswith("_text", F.lit("?"))))


def scan(spark: SparkSession, path: str, sections: dict[str, list[str]]) -> tuple[DataFrame, DataFrame]:
    """(patients: id, file_path; events: id, file_path, section, tag).

    Tags that do not nest, or are no tags, are an error that names the file.
    """
    pieces = stored(_rows(spark, path), "xml-tags")
    parts = -(-pieces.count() // _TASK_ROWS) or 1
    rows = _without_comments(pieces, parts)
    bare = F.regexp_replace("_text", _QUOTED, "")
    rows = rows.withColumns(
        {
            "_name": F.regexp_extract("_text", r"^/?([\w.:-]+)", 1),
            "_closing": F.startswith("_text", F.lit("/")),
            "_bare": F.substring_index(bare, ">", 1),
            "_whole": bare.contains(">"),
        }
    )
    rows = rows.withColumn("_single", F.endswith("_bare", F.lit("/")))
    rows = rows.withColumn("_bad", ~(F.col("_whole") & F.concat("_bare", F.lit(">")).rlike(_TAG)))
    step = F.when(F.col("_single"), 0).when(F.col("_closing"), -1).otherwise(1)
    rows = running(rows, ["_at"], {"_depth": step}, ["file_path"], _chunk(), parts)
    # the level a tag's element stands on
    level = F.col("_depth") + F.when(F.col("_single") | F.col("_closing"), 1).otherwise(0)
    rows = stored(rows.withColumn("_level", level).drop("_bare", "_whole"), "xml-levels")
    _check(rows, parts)

    opens = ~F.col("_closing")
    named = F.col("_name").isin(list(sections))
    rows = rows.withColumn("_id", F.when(opens & (F.col("_name") == "patient"), attribute(F.col("_text"), "id")))
    held = {
        "_patient": F.when(opens & (F.col("_name") == "patient"), F.struct(F.col("_id").alias("id"), F.col("_level").alias("level"))),
        "_section": F.when(named, F.struct(F.when(opens & ~F.col("_single"), F.col("_name")).alias("name"), F.col("_level").alias("level"))),
    }
    patients = rows.where(held["_patient"].isNotNull()).select(F.col("_id").alias("id"), "file_path")
    inside = carried(rows, ["_at"], held, ["file_path"], _chunk(), parts)
    mine = (F.col("_name") == "event") & opens
    mine = mine & (F.col("_section.level") == F.col("_patient.level") + 1) & (F.col("_level") == F.col("_section.level") + 1)
    events = inside.where(mine & F.col("_section.name").isNotNull())
    return patients, events.select(
        F.col("_patient.id").alias("id"), "file_path", F.col("_section.name").alias("section"), F.col("_text").alias("tag")
    )


def _check(rows: DataFrame, parts: int) -> None:
    """Every closing tag ends the element opened last on its level, and all are closed."""
    pairs = rows.where("not _single")
    name = F.when(~F.col("_closing"), F.col("_name")).otherwise(F.lit(""))
    pairs = carried(pairs, ["_at"], {"_open": name}, ["file_path", "_level"], _chunk(), parts)
    expected = F.when(F.col("_closing"), F.col("_name")).otherwise(F.lit(""))
    wrong = pairs.where(F.coalesce("_open", F.lit("")) != expected).select("file_path")
    unclosed = rows.groupBy("file_path").agg(
        F.sum(F.when(F.col("_single"), 0).when(F.col("_closing"), -1).otherwise(1)).alias("_sum")
    )
    odd = rows.where("_bad").select("file_path").unionByName(wrong).unionByName(unclosed.where("_sum <> 0").select("file_path"))
    found = odd.limit(1).collect()
    if found:
        raise ValueError(f"not well-formed XML: {found[0][0]}")
