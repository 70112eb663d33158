"""From model outputs to a chosen action and its response."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from caseflow.functions.codes import MESSAGE_ACTIONS
from caseflow.functions.rng import uniform
from caseflow.operators.policy import draw


def _pct(x: Column) -> Column:
    return F.rint(x * 10000) / 100


def _predictions(name: str, order: str, value: Column) -> Column:
    """Aggregate: (name, score) list of a request in option order; options are few by design."""
    items = F.collect_list(F.struct(F.col(order), F.col(name).alias("name"), value.alias("score")))
    return F.transform(
        F.sort_array(items), lambda x: F.struct(x["name"].alias("name"), x["score"].alias("score"))
    )


def best_action(df: DataFrame, request: list[str], name: str, score: str, order: str) -> DataFrame:
    """Highest-scoring option of each request (first on ties), with all scores in percent."""
    top = F.max_by(F.struct(name, score), F.struct(F.col(score), -F.col(order)))
    return (
        df.groupBy(*request)
        .agg(top.alias("_t"), _predictions(name, order, _pct(F.col(score))).alias("predictions"))
        .select(
            *request,
            F.col("_t")[name].alias("action"),
            _pct(F.col("_t")[score]).alias("score"),
            "predictions",
        )
    )


def label_by_model(
    df: DataFrame, request: list[str], model: str, name: str, percentile: str, order: str
) -> DataFrame:
    """Per request and model family: its predictions with percentiles, the best one as label."""
    top = F.max_by(F.struct(name, percentile), F.struct(F.col(percentile), -F.col(order)))
    return (
        df.groupBy(*request, model)
        .agg(top.alias("_t"), _predictions(name, order, F.col(percentile)).alias("predictions"))
        .select(
            *request,
            model,
            F.col("_t")[name].alias("label"),
            F.col("_t")[percentile].alias("label_score"),
            "predictions",
        )
    )


def _bands(u: Column, names: list[Column], width: float) -> Column:
    """Name of the band a uniform is in; bands include their upper end, the last takes the rest."""
    return reduce(
        lambda acc, i: F.when(u <= width * (i + 1), names[i]).otherwise(acc),
        reversed(range(len(names) - 1)),
        names[-1],
    )


def assign_treatment(df: DataFrame, ids: list[str], seed: int, model_action: str) -> DataFrame:
    """Five arms of 0.2: the four fixed messages and the model's own choice, each with its score."""
    u = uniform(ids, seed)
    arms = [F.lit(a) for a in MESSAGE_ACTIONS]
    reasons = [F.lit(f"Treatment Group - {a}") for a in MESSAGE_ACTIONS]
    return (
        df.withColumn("random_score", u)
        .withColumn("action", _bands(F.col("random_score"), [*arms, F.col(model_action)], 0.2))
        .withColumn(
            "action_reason",
            _bands(F.col("random_score"), [*reasons, F.lit("Treatment Group - AI Bandit Action")], 0.2),
        )
        .withColumn("action_score", F.col("random_score") * 100)
    )


def assign_treatment_thirds(
    df: DataFrame,
    ids: list[str],
    seed: int,
    bandit_action: str,
    tree_action: str,
    probs: dict[str, str],
    trees: dict[str, str],
) -> DataFrame:
    """A third each: a message drawn in quarters by a second uniform, the bandit's, the tree model's.

    ``probs`` and ``trees`` map names to the score columns of the bandit's actions and of
    the tree models; the arm's own scores are its predictions (the random arm's are 0),
    and the tree arm's action has the best tree's score.
    """

    def listed(scores: dict[str, str], known: bool = True) -> Column:
        cells = [(n, _pct(F.col(f"`{c}`")) if known else F.lit(0.0)) for n, c in scores.items()]
        return F.array(*[F.struct(F.lit(n).alias("name"), x.cast("double").alias("score")) for n, x in cells])

    best = reduce(lambda a, c: F.greatest(a, F.col(f"`{c}`")), list(trees.values())[1:], F.col(f"`{list(trees.values())[0]}`"))
    u, v = F.col("random_score"), F.col("random_score_v2")
    quarter = _bands(v, [F.lit(a) for a in MESSAGE_ACTIONS], 0.25)
    reason = _bands(v, [F.lit(f"Treatment Group - Random - {a}") for a in MESSAGE_ACTIONS], 0.25)
    third, two = 1.0 / 3.0, 2.0 / 3.0
    return (
        df.withColumn("random_score", uniform(ids, seed))
        .withColumn("random_score_v2", uniform(ids, seed + 1))
        .withColumn(
            "action",
            F.when(u < third, quarter).when(u <= two, F.col(bandit_action)).otherwise(F.col(tree_action)),
        )
        .withColumn(
            "action_reason",
            F.when(u < third, reason)
            .when(u <= two, "Treatment Group - AI Bandit Action")
            .otherwise("Treatment Group - XGBoost Action"),
        )
        .withColumn("action_score", F.when(u <= two, u * 100).otherwise(best * 100))
        .withColumn(
            "predictions",
            F.when(u < third, listed(probs, known=False)).when(u <= two, listed(probs)).otherwise(listed(trees)),
        )
    )


def bandit_response(
    df: DataFrame, action: str, probs: dict[str, str], model: str, version: str
) -> DataFrame:
    """Response of a bandit request: chosen action with its percent, all percents as a list."""
    listed = F.array(
        *[
            F.struct(F.lit(n).alias("name"), _pct(F.col(f"`{c}`")).alias("score"))
            for n, c in probs.items()
        ]
    )
    mine = F.create_map(*[x for n, c in probs.items() for x in (F.lit(n), _pct(F.col(f"`{c}`")))])
    return df.withColumn(
        "response",
        F.to_json(
            F.struct(
                F.lit(model).alias("name"),
                F.lit(version).alias("version"),
                F.struct(F.col(action).alias("name"), mine[F.col(action)].alias("score")).alias("action"),
                listed.alias("predictions"),
            )
        ),
    )


def random_policy(df: DataFrame, actions: list, ids: list[str], seed: int) -> DataFrame:
    """Random probabilities that sum to 1 (4 decimals, the last takes what is left) and a draw."""
    us = F.array(*[uniform([*ids, F.lit(str(a))], seed) for a in actions])
    d = df.withColumn("_u", us)
    d = d.withColumn("_sum", F.aggregate("_u", F.lit(0.0), lambda a, x: a + x))
    d = d.withColumn("_r", F.transform("_u", lambda x: F.bround(x / F.col("_sum"), 4)))
    rest = F.lit(1.0) - F.aggregate(F.slice("_r", 1, len(actions) - 1), F.lit(0.0), lambda a, x: a + x)
    d = d.withColumn("probs", F.concat(F.slice("_r", 1, len(actions) - 1), F.array(F.bround(rest, 4))))
    names = F.array(*[F.lit(a) for a in actions])
    pick = draw(F.col("probs"), uniform(ids, seed + 1))
    return d.withColumn("Action", F.get(names, pick)).drop("_u", "_sum", "_r")


def next_day_send_time(df: DataFrame, action: str, now: str, probs: str) -> DataFrame:
    """The chosen hour (the action) on the day after ``now``, and the chosen probability."""
    day = F.date_add(F.to_date(now), 1).cast("timestamp_ntz")
    at = day + F.make_dt_interval(hours=F.col(action).cast("int"))
    return df.withColumn("action_time", F.date_format(at, "yyyy-MM-dd HH:mm:ss")).withColumn(
        "probability", F.get(probs, F.col(action).cast("int"))
    )


def round_outputs(df: DataFrame, cols: list[str], digits: int = 4) -> DataFrame:
    """Array outputs rounded, half to even."""
    return df.withColumns(
        {c: F.transform(c, lambda x: F.bround(x.cast("double"), digits)) for c in cols}
    )
