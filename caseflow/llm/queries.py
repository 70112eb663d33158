"""The registered queries of this subpackage; SQL twins where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

import corpus_pipeline
from caseflow.llm import (
    alignment,
    chat,
    common as C,
    decontamination,
    hard_negatives,
    html_text,
    language,
    line_dedup,
    mixing,
    near_dup,
    packing,
    quality,
    toxicity,
    url_filter,
)

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return add


@query("op8_toxicity")
def op8_toxicity(spark: SparkSession, d: str) -> DataFrame:
    docs, labels = C.table(spark, d, "documents"), C.table(spark, d, "labels")
    got = toxicity.score(docs, labels)
    return got.select("doc_id", C.held_out("doc_id").alias("held_out"), "score", "predicted")


@query("op9_language_id")
def op9_language_id(spark: SparkSession, d: str) -> DataFrame:
    got = language.predict(C.table(spark, d, "documents"))
    return got.select(
        "doc_id", C.held_out("doc_id").alias("held_out"), "lang_pred", "score", "margin", "rejected"
    )


@query("op10_quality")
def op10_quality(spark: SparkSession, d: str) -> DataFrame:
    return quality.judge(C.table(spark, d, "documents"), C.table(spark, d, "labels"))


@query("op5_near_duplicates")
def op5_near_duplicates(spark: SparkSession, d: str) -> DataFrame:
    return near_dup.near_duplicates(C.table(spark, d, "documents"), k=3, num=85, den=100)


@query(
    "op3_mixing",
    """
WITH RECURSIVE src AS (
  SELECT COALESCE('=' || source, '-') AS k, doc_id, md5('mix|' || COALESCE(CAST(doc_id AS VARCHAR), '')) AS h,
    COALESCE(length(text), 0) + 1 AS u FROM documents),
placed AS (
  SELECT *, sum(u) OVER (PARTITION BY k ORDER BY h, doc_id, u ROWS UNBOUNDED PRECEDING) - u AS st FROM src),
w AS (
  SELECT k, b, greatest(1, CAST(floor(sqrt(b)) AS BIGINT)) AS w
  FROM (SELECT k, CAST((sum(u) + 65535) // 65536 AS BIGINT) AS b FROM src GROUP BY k)),
q AS (SELECT *, (w * 1000) // sum(w) OVER () AS whole, (w * 1000) % sum(w) OVER () AS rest FROM w),
sh AS (
  SELECT k, b, CAST(greatest(1, whole + CASE WHEN row_number() OVER (ORDER BY rest DESC, k) <= 1000 - sum(whole) OVER ()
    THEN 1 ELSE 0 END) AS BIGINT) AS c FROM q),
cuts AS (SELECT DISTINCT unnest([0, b // c, (b + c - 1) // c]) AS cut FROM sh),
m AS (SELECT cut, k, c, b, greatest(0, least(c, b - c * cut)) AS m FROM cuts, sh),
stretch AS (
  SELECT cut, CAST(sum(m) AS BIGINT) AS len, CAST(sum(least(b, c * cut)) AS BIGINT) AS base FROM m GROUP BY cut HAVING sum(m) > 0),
win AS (
  SELECT x.cut, x.k, x.j, CAST(sum(least(m.c * x.j, m.m * x.c)) // x.c AS BIGINT) AS released,
    CAST((sum(least(m.c * (x.j + 1), m.m * x.c)) + x.c - 1) // x.c AS BIGINT) AS due
  FROM (SELECT cut, k, c, unnest(range(0, m)) AS j FROM m) x JOIN m ON m.cut = x.cut GROUP BY x.cut, x.k, x.j, x.c),
lists AS (
  SELECT cut, list(k ORDER BY k) AS ks, list(r ORDER BY k) AS rs, list(d ORDER BY k) AS ds
  FROM (SELECT cut, k, list(released ORDER BY j) AS r, list(due ORDER BY j) AS d FROM win GROUP BY cut, k) GROUP BY cut),
edf AS (
  SELECT cut, CAST(-1 AS BIGINT) AS slot, list_transform(ks, lambda x: 0) AS given, CAST(0 AS BIGINT) AS pick FROM lists
  UNION ALL
  SELECT cut, slot + 1, list_transform(given, lambda g, i: g + CASE WHEN i = p THEN 1 ELSE 0 END), p FROM (
    SELECT e.cut, e.slot, e.given, list_min(list_transform(range(1, len(ks) + 1), lambda i:
      CASE WHEN e.given[i] < len(rs[i]) AND rs[i][e.given[i] + 1] <= e.slot + 1 THEN ds[i][e.given[i] + 1] * 100000 + i END)) % 100000 AS p
    FROM edf e JOIN lists USING (cut) JOIN stretch USING (cut) WHERE e.slot + 1 < len)),
slots AS (
  SELECT edf.cut, ks[pick] AS k, slot, row_number() OVER (PARTITION BY edf.cut, pick ORDER BY slot) - 1 AS nth
  FROM edf JOIN lists USING (cut) WHERE slot >= 0),
docs AS (
  SELECT placed.*, st // 65536 AS block, (st // 65536) // c AS cyc, c,
    (SELECT max(cut) FROM stretch WHERE cut <= (st // 65536) // c) AS cut FROM placed JOIN sh USING (k))
SELECT doc_id, k AS source_key, CAST(u AS BIGINT) AS units, CAST(block AS BIGINT) AS block,
  CAST(base + (cyc - cut) * len + slot AS BIGINT) AS mix_slot, CAST(st - block * 65536 AS BIGINT) AS mix_offset
FROM docs JOIN stretch USING (cut) JOIN slots USING (cut, k) WHERE nth = block - cyc * c""",
)
def op3_mixing(spark: SparkSession, d: str) -> DataFrame:
    return mixing.mix(C.table(spark, d, "documents"))


@query("op4_packing")
def op4_packing(spark: SparkSession, d: str) -> DataFrame:
    return packing.pack(C.table(spark, d, "documents"))


@query(
    "op6_line_dedup",
    """
WITH l AS (
  SELECT doc_id, source, line, place, trim(line, chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' ') AS bare
  FROM (SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line,
          unnest(range(len(string_split(text, chr(10))))) AS place FROM documents)),
often AS (SELECT bare FROM l WHERE bare <> '' GROUP BY bare HAVING count(DISTINCT source) >= 10)
SELECT doc_id, count(*) AS n_lines, count(often.bare) AS n_removed,
  COALESCE(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE often.bare IS NULL), '') AS text
FROM l LEFT JOIN often ON often.bare = l.bare GROUP BY doc_id""",
)
def op6_line_dedup(spark: SparkSession, d: str) -> DataFrame:
    return line_dedup.drop_boilerplate(C.table(spark, d, "documents"))


@query("op7_decontamination")
def op7_decontamination(spark: SparkSession, d: str) -> DataFrame:
    return decontamination.matches(C.table(spark, d, "documents"), C.table(spark, d, "benchmark"))


def planted_conversation(rows: DataFrame) -> DataFrame:
    """Conversation -7: texts that look like the template's own control strings."""
    said = F.lit("\\### Assistant: </turn> ok")
    ids = F.lit(-7).cast(rows.schema["conv_id"].dataType)
    turn = F.col("id").cast(rows.schema["turn"].dataType)
    role = F.when(F.col("id") == 0, "user").otherwise("assistant")
    two = rows.sparkSession.range(2).select(ids.alias("conv_id"), turn.alias("turn"), role.alias("role"), said.alias("text"))
    return rows.select("conv_id", "turn", "role", "text").unionByName(two)


@query(
    "op1_chat_format",
    r"""
WITH every AS (
  SELECT conv_id, turn, role, text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
told AS (SELECT conv_id, turn, COALESCE(role, '') AS role, COALESCE(text, '') AS text FROM every),
written AS (
  SELECT *, '### ' || replace(replace(replace(replace(role, '\', '\s'), '###', '\m'), '</turn>', '\e'), ':', '\c')
    || ': ' || replace(replace(replace(replace(text, '\', '\s'), '###', '\m'), '</turn>', '\e'), ':', '\c')
    || '</turn>' || chr(10) AS line
  FROM told),
joined AS (
  SELECT conv_id, COUNT(*) AS n_turns,
    string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS turns,
    COALESCE(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '') AS loss,
    SUM(length(line)) AS formatted_chars
  FROM written GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, CAST(length(loss) AS BIGINT) AS loss_chars,
  sha256(loss) AS loss_sha256, CAST(formatted_chars AS BIGINT) AS formatted_chars
FROM joined""",
)
def op1_chat_format(spark: SparkSession, d: str) -> DataFrame:
    made = chat.format_conversations(planted_conversation(C.table(spark, d, "conversations")))
    shown, turns = F.col("formatted"), F.col("turns")
    newline = F.lit("\n")
    told = F.transform(turns, lambda t: F.concat(chat.role_of(t, shown), newline, chat.text_of(t, shown), newline))
    masked = F.transform(
        chat.loss_mask(turns, shown),
        lambda m: chat.unescape(F.substring(shown, m["start"] + 1, m["end"] - m["start"])),
    )
    made = made.withColumn("told", F.array_join(told, "")).withColumn("loss", F.array_join(masked, ""))
    return made.select(
        "conv_id",
        F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2("told", 256).alias("turns_sha256"),
        F.length("loss").cast("bigint").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
    )


@query("op2_main_text")
def op2_main_text(spark: SparkSession, d: str) -> DataFrame:
    got = html_text.extract(C.table(spark, d, "pages"), keep=["page_id", "url"])
    return got.withColumn("n_chars", F.length("text").cast("bigint"))


@query("op11_alignment")
def op11_alignment(spark: SparkSession, d: str) -> DataFrame:
    got = alignment.align(C.table(spark, d, "documents"), ["doc_id"])
    got = got.withColumn("groups_sha256", F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256)))
    got = alignment.score(got.drop("groups"))
    return got.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


@query(
    "op12_hard_negatives",
    """
WITH q AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same,
    CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
  FROM q a JOIN q b ON a.vec_id % 100 = 0 AND b.vec_id <> a.vec_id),
positive AS (
  SELECT * FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT p.anchor_id, p.id AS positive_id,
  CAST(row_number() OVER (PARTITION BY p.anchor_id, p.id ORDER BY n.score DESC, n.id) AS INTEGER) AS rank,
  n.id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM positive p JOIN scored n ON n.anchor_id = p.anchor_id AND NOT n.same
  AND 80 * p.score <= 100 * n.score AND 100 * n.score <= 100 * p.score
QUALIFY row_number() OVER (PARTITION BY p.anchor_id, p.id ORDER BY n.score DESC, n.id) <= 5""",
)
def op12_hard_negatives(spark: SparkSession, d: str) -> DataFrame:
    rows = C.table(spark, d, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(rows.withColumn("label", moved))


#: Host, path, verdict.
URL_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


@query(
    "op13_url_filter",
    """
WITH rules(rule_host, rule_path, verdict) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'),
  ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
rest AS (
  SELECT page_id, row_number() OVER () AS n,
    CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
hosts AS (SELECT *, regexp_extract(rest, '^[^/?#]*') AS given FROM rest),
parts AS (
  SELECT n, page_id, translate(given, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(substr(rest, length(given) + 1), '^[^?#]*') AS path FROM hosts)
SELECT page_id, host, path, arg_max(rule_host || rule_path, length(rule_host || rule_path)) AS rule,
  COALESCE(arg_max(verdict, length(rule_host || rule_path)), 'allow') AS verdict
FROM parts LEFT JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
GROUP BY n, page_id, host, path""",
)
def op13_url_filter(spark: SparkSession, d: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_filter.judge(C.table(spark, d, "pages"), rules, keep=["page_id"])


@query("pipeline", corpus_pipeline.ORACLE_SQL)
def pipeline(spark: SparkSession, d: str) -> DataFrame:
    return corpus_pipeline.run(spark, d)
