"""Record attributes to tokens with weights, vocabularies, token ids."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F, types as T

from caseflow.plans.spread import running, stored

TOP = 30
#: Tokens of a vocabulary that is searched row by row instead of joined.
SHORT_VOCAB = 500


def _pairs(attrs: list[str]) -> Column:
    return F.array(
        *[
            F.struct(F.lit(a).alias("attr"), F.col(a).cast("string").alias("value"))
            for a in attrs
        ]
    )


def count_values(df: DataFrame, attrs: list[str]) -> DataFrame:
    """Rows per attribute and value, nulls left out; one shuffle for all attributes."""
    rows = df.select(F.inline(_pairs(attrs))).where("value is not null")
    return rows.groupBy("attr", "value").agg(F.count(F.lit(1)).alias("n"))


def fit_top_values(
    df: DataFrame, attrs: list[str], k: int = TOP, per_attr: dict[str, int] | None = None
) -> DataFrame:
    """The most frequent values of each attribute with their place, ties by value.

    The place filter lets Spark keep only the first k of a task before the
    shuffle, so no task receives all values of an attribute.
    """
    limit = F.lit(k)
    for a, n in (per_attr or {}).items():
        limit = F.when(F.col("attr") == a, n).otherwise(limit)
    most = max([k, *(per_attr or {}).values()])
    place = F.row_number().over(W.partitionBy("attr").orderBy(F.desc("n"), "value"))
    top = count_values(df, attrs).withColumn("place", place).where(F.col("place") <= most)
    return top.where(F.col("place") <= limit)


def top_as_lists(top: DataFrame, attrs: list[str]) -> dict[str, list[str]]:
    """Fitted values as lists; at most k rows per attribute reach the driver."""
    found = {a: [] for a in attrs}
    for r in top.orderBy("attr", "place").collect():
        found[r["attr"]].append(r["value"])
    return found


def _tokens(items: list[Column]) -> tuple[Column, Column]:
    """Split an array of (token, weight) arrays into token and weight arrays."""
    whole = F.flatten(F.array(*items))
    return F.transform(whole, lambda x: x["t"]), F.transform(whole, lambda x: x["w"])


def _one(token, weight=1.0) -> Column:
    t = token if isinstance(token, Column) else F.lit(token)
    w = weight if isinstance(weight, Column) else F.lit(weight)
    return F.array(F.struct(t.alias("t"), w.cast("double").alias("w")))


def tokenize_category(df: DataFrame, top: dict[str, list[str]], feat: str) -> DataFrame:
    """Token ``attr_value`` for a frequent value, ``attr_minor`` for others and null,
    ``attr_unk`` when the table has no such attribute; weight 1."""
    items = []
    for a, values in top.items():
        if a not in df.columns:
            items.append(_one(f"{a}_unk"))
            continue
        v = F.col(a).cast("string")
        known = v.isin([*values, "unk"])
        items.append(_one(F.when(known, F.concat(F.lit(f"{a}_"), v)).otherwise(f"{a}_minor")))
    t, w = _tokens(items)
    return df.withColumns({f"{feat}_tkn": t, f"{feat}_wgt": w})


def _zfill(x: Column, width: int) -> Column:
    s = F.abs(x).cast("string")
    sign = F.when(x < 0, "-").otherwise("")
    pad = F.lit(width) - F.length(sign)
    return F.concat(sign, F.lpad(s, F.greatest(pad, F.length(s)), F.lit("0")))


def _bin_tokens(a: str, low, high, step) -> Column:
    """Tokens of one binned attribute."""
    x = F.col(a).cast("double")
    width = len(str(int(high)))
    floor = (F.floor(x / F.lit(float(step))) * F.lit(float(step))).cast("bigint")
    label = F.concat(
        F.lit(f"{a}:"), _zfill(floor, width), F.lit("~"), _zfill((floor + F.lit(step)).cast("bigint"), width)
    )
    place = F.bround((x - floor) / F.lit(float(step)), 4)
    inside = F.concat(_one(label), _one(F.concat(label, F.lit("Itv")), place))
    return (
        F.when(x.isNull(), _one(f"{a}:None"))
        .when(x == F.lit(float(high)), _one(f"{a}:Equal{high}"))
        .when(x == F.lit(float(low)), _one(f"{a}:Equal{low}"))
        .when(x > F.lit(float(high)), _one(f"{a}:Above{high}"))
        .when(x < F.lit(float(low)), _one(f"{a}:Below{low}"))
        .otherwise(inside)
    )


def tokenize_numeric_bins(df: DataFrame, bins: dict[str, tuple], feat: str) -> DataFrame:
    """Bin tokens per attribute: the bin with weight 1 and the place inside it.

    ``bins`` maps attribute to (min, max, step).
    """
    t, w = _tokens([_bin_tokens(a, *b) for a, b in bins.items()])
    return df.withColumns({f"{feat}_tkn": t, f"{feat}_wgt": w})


def tokenize_numeric(df: DataFrame, attrs: list[str], feat: str) -> DataFrame:
    """The attribute name as token with its value as weight; null gives ``attr_None`` weight 1."""
    t, w = _tokens(
        [
            F.when(F.col(a).isNull(), _one(f"{a}_None")).otherwise(_one(a, F.col(a)))
            for a in attrs
        ]
    )
    return df.withColumns({f"{feat}_tkn": t, f"{feat}_wgt": w})


def build_vocab(spark: SparkSession, kind: str, spec) -> list[str]:
    """Ordered tokens: ``category`` from fitted lists, ``bins`` from (min, max, step) per
    attribute, ``numeric`` from attribute names.

    Bin tokens are those the tokenizer gives on a probe grid from one and a half
    steps below the minimum to one and a half above the maximum.
    """
    if kind == "category":
        return [t for a, vs in spec.items() for t in [f"{a}_unk", f"{a}_minor", *[f"{a}_{v}" for v in vs]]]
    if kind == "numeric":
        return list(spec) + [f"{a}_None" for a in spec]
    if kind != "bins":
        raise ValueError(f"unknown vocabulary kind {kind!r}")
    rows = [tuple(None for _ in spec)]
    for a, (low, high, step) in spec.items():
        n = -(-(high - low + 3 * step) // step)
        grid = [low, high] + [low - 1.5 * step + i * step for i in range(int(n))]
        rows += [tuple(float(v) if b == a else None for b in spec) for v in grid]
    schema = T.StructType([T.StructField(a, T.DoubleType()) for a in spec])
    probe = tokenize_numeric_bins(spark.createDataFrame(rows, schema), spec, "p")
    found = probe.select(F.explode("p_tkn").alias("t")).distinct().collect()
    return sorted(r["t"] for r in found)


def vocab_table(spark: SparkSession, vocab: list[str]) -> DataFrame:
    """(token, tid) of a vocabulary; a token that occurs twice is an error."""
    if len(set(vocab)) != len(vocab):
        raise ValueError("a token occurs twice in the vocabulary")
    table = pa.table({"token": pa.array(vocab, pa.string()), "tid": pa.array(range(len(vocab)), pa.int32())})
    return spark.createDataFrame(table)


def tokens_to_ids(df: DataFrame, feat: str, vocab: list[str] | DataFrame, keep: list[str]) -> DataFrame:
    """Token ids ``<feat>_tid`` (place in the vocabulary) and weights; unknown tokens raise.

    A short vocabulary is searched row by row.  A long one, or one given as a table (token,
    tid), is joined: tokens leave their rows with their places, meet the table, and are
    laid back in order by the row they came from.
    """
    tokens = f"{feat}_tkn"
    lost = lambda x: F.raise_error(F.concat(F.lit("token not in vocabulary: "), x)).cast("int")
    if not isinstance(vocab, DataFrame):
        table = vocab_table(df.sparkSession, vocab)
        if len(vocab) <= SHORT_VOCAB:
            order = sorted(range(len(vocab)), key=lambda i: vocab[i].encode())
            known, ids = F.lit([vocab[i] for i in order]), F.lit(order)
            steps = F.lit([1 << k for k in range(len(vocab).bit_length() - 1, -1, -1)])

            def place(x: Column) -> Column:
                step = lambda n, half: F.when(F.get(known, n + half - 1) <= x, n + half).otherwise(n)
                return F.aggregate(steps, F.lit(0), step) - 1

            found = F.transform(tokens, lambda x: F.struct(x.alias("x"), place(x).alias("i")))
            tid = F.transform(found, lambda f: F.when(F.get(known, f["i"]) == f["x"], F.get(ids, f["i"])).otherwise(lost(f["x"])))
            return df.select(*keep, tid.cast("array<int>").alias(f"{feat}_tid"), f"{feat}_wgt")
        vocab = table
    rows = df.select(*keep, tokens, f"{feat}_wgt").withColumn("_row", F.monotonically_increasing_id())
    rows = stored(rows, "tokens").repartition("_row")
    apart = rows.select("_row", F.posexplode(tokens).alias("_at", "_token"))
    met = apart.join(vocab.select(F.col("token").alias("_token"), F.col("tid").alias("_tid")), "_token", "left")
    placed = F.struct("_at", F.coalesce("_tid", lost(F.coalesce("_token", F.lit("null")))).alias("_tid"))
    back = met.groupBy("_row").agg(F.sort_array(F.collect_list(placed)).alias("_ids"))
    none = F.when(F.col(tokens).isNotNull(), F.array().cast("array<int>"))
    tid = F.coalesce(F.transform("_ids", lambda x: x["_tid"]), none)
    return rows.join(back, "_row", "left").select(*keep, tid.alias(f"{feat}_tid"), f"{feat}_wgt")


def describe_category(df: DataFrame, attrs: list[str]) -> DataFrame:
    """Rows per value of each attribute."""
    return count_values(df, attrs)


def describe_numeric(df: DataFrame, attrs: list[str]) -> DataFrame:
    """Count, mean, deviation, extremes and quartiles of each attribute, 2 decimals.

    Quartiles are exact, between neighbours in proportion.  Equal values are
    counted first; running counts over the distinct values then tell which of
    them holds a place, so no task sees all values of an attribute.
    """
    rows = df.select(
        F.inline(
            F.array(
                *[F.struct(F.lit(a).alias("attr"), F.col(a).cast("double").alias("x")) for a in attrs]
            )
        )
    ).where("x is not null")
    moments = rows.groupBy("attr").agg(
        F.count("x").alias("count"),
        F.avg("x").alias("mean"),
        F.stddev_samp("x").alias("std"),
        F.min("x").alias("min"),
        F.max("x").alias("max"),
    )
    values = rows.groupBy("attr", "x").agg(F.count(F.lit(1)).alias("n"))
    placed = running(values, ["x"], {"upto": F.col("n")}, ["attr"]).join(moments, "attr")

    def at(place):
        """Value at a place counted from 0: the first whose running count passes it."""
        return F.min(F.when(F.col("upto") > place, F.col("x")))

    cells = {}
    for q in (25, 50, 75):
        place = (F.col("count") - 1) * F.lit(q / 100)
        cells[f"_lo{q}"], cells[f"_hi{q}"] = at(F.floor(place)), at(F.ceil(place))
    found = placed.groupBy("attr").agg(*[c.alias(k) for k, c in cells.items()])
    out = moments.join(found, "attr")

    def quartile(q):
        place = (F.col("count") - 1) * F.lit(q / 100)
        low, high = F.col(f"_lo{q}"), F.col(f"_hi{q}")
        return F.bround(low + (high - low) * (place - F.floor(place)), 2).alias(f"q{q}")

    rounded = lambda c: F.bround(c, 2).alias(c)
    return out.select(
        "attr",
        "count",
        *[rounded(c) for c in ("mean", "std", "min")],
        *[quartile(q) for q in (25, 50, 75)],
        rounded("max"),
    )
