"""Models and policies on DataFrames: fit, score, draw, estimate value."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from typing import Any, Callable, Iterator

import pandas as pd
from pyspark.ml import Pipeline
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import Column, DataFrame, functions as F

from caseflow.functions.rng import uniform
from caseflow.operators.evaluate import score_percentile
from caseflow.sources.fingerprint import fingerprint, remove, seal, sealed

# Fixed value: probabilities below this count as zero.
SMALLEST = 1e-07


def _assembler(features: list[str]) -> VectorAssembler:
    return VectorAssembler(inputCols=features, outputCol="_features", handleInvalid="keep")


def fit_binary_classifier(df: DataFrame, features: list[str], label: str, rounds: int = 20, seed: int = 42):
    """Boosted-tree classifier; trees grow from per-partition histograms, rows are not gathered."""
    model = GBTClassifier(featuresCol="_features", labelCol=label, maxIter=rounds, seed=seed)
    return Pipeline(stages=[_assembler(features), model]).fit(df)


def score(df: DataFrame, model, out: str = "y_pred_score", ref: DataFrame | None = None) -> DataFrame:
    """Probability of the positive class, with the percentile within reference scores if given."""
    d = model.transform(df).withColumn(out, vector_to_array("probability")[1])
    d = d.drop("_features", "rawPrediction", "probability", "prediction")
    return d if ref is None else score_percentile(d, ref, out, f"{out}_percentile")


def join_item_embedding(
    df: DataFrame, items: DataFrame, item: str, vector: str, features: str
) -> DataFrame:
    """Feature arrays with the item's vector appended; an unknown item adds nothing."""
    joined = df.join(items.select(item, F.col(vector).alias("_vec")), item, "left")
    return joined.withColumn(
        features, F.concat(features, F.coalesce("_vec", F.array().cast("array<double>")))
    ).drop("_vec")


def fit_standardizer(df: DataFrame, cols: list[str]) -> dict[str, tuple[float, float]]:
    """Mean and population deviation per column (null counts as 0); one row reaches the driver."""
    aggs = []
    for c in cols:
        x = F.coalesce(F.col(c).cast("double"), F.lit(0.0))
        aggs += [F.avg(x).alias(f"{c}_m"), F.stddev_pop(x).alias(f"{c}_s")]
    row = df.agg(*aggs).first()
    return {c: (row[f"{c}_m"], row[f"{c}_s"]) for c in cols}


def standardize(df: DataFrame, fitted: dict[str, tuple[float, float]]) -> DataFrame:
    """z-scores by fitted moments; no deviation counts as 1."""
    z = {}
    for c, (mean, std) in fitted.items():
        x = F.coalesce(F.col(c).cast("double"), F.lit(0.0))
        z[c] = (x - F.lit(mean)) / F.lit(std if std else 1.0)
    return df.withColumns(z)


def fit_reward_models(
    df: DataFrame, action: str, reward: str, features: list[str], ids: list[str], actions: list, seed: int = 42
) -> dict:
    """One reward regressor per action on 80 % of its rows, with train and test MSE.

    Actions are few and given, so the loop is over models, not data.
    """
    out = {}
    d = df.withColumn("_train", uniform(ids, seed) < 0.8)
    for a in actions:
        mine = d.where(F.col(action) == a)
        reg = GBTRegressor(
            featuresCol="_features", labelCol=reward, predictionCol="_r", maxIter=10, maxDepth=3, seed=seed
        )
        model = Pipeline(stages=[_assembler(features), reg]).fit(mine.where("_train"))
        err = (F.col("_r") - F.col(reward)) * (F.col("_r") - F.col(reward))
        mse = {
            bool(r["_train"]): r["mse"]
            for r in model.transform(mine).groupBy("_train").agg(F.avg(err).alias("mse")).collect()
        }
        out[a] = {"model": model, "train_mse": mse.get(True), "test_mse": mse.get(False)}
    return out


def predict_rewards(df: DataFrame, models: dict, out: str = "rewards") -> DataFrame:
    """Predicted reward of every action, as an array in model order."""
    cols = []
    for i, fitted in enumerate(models.values()):
        df = fitted["model"].transform(df).withColumnRenamed("_r", f"_r{i}").drop("_features")
        cols.append(f"_r{i}")
    return df.withColumn(out, F.array(*cols)).drop(*cols)


def softmax_policy(df: DataFrame, scores: str, out: str = "probs") -> DataFrame:
    """Action probabilities from scores.

    The exponentials are a column of their own, so they are computed once.
    """
    d = df.withColumn("_max", F.array_max(scores))
    d = d.withColumn("_e", F.transform(scores, lambda x: F.exp(x - F.col("_max"))))
    d = d.withColumn("_sum", F.aggregate("_e", F.lit(0.0), lambda a, x: a + x))
    p = F.transform(
        "_e",
        lambda x: F.when(x / F.col("_sum") < SMALLEST, F.lit(0.0)).otherwise(x / F.col("_sum")),
    )
    return d.withColumn(out, p).drop("_max", "_e", "_sum")


def draw(probs: Column, u: Column) -> Column:
    """First index (from 0) whose cumulative probability reaches the uniform; 0 when none does."""
    start = F.struct(F.lit(0.0).alias("c"), F.lit(0).alias("i"), F.lit(-1).alias("at"))

    def step(acc, p):
        c = acc["c"] + p
        hit = (acc["at"] < 0) & (c >= u)
        return F.struct(
            c.alias("c"), (acc["i"] + 1).alias("i"), F.when(hit, acc["i"]).otherwise(acc["at"]).alias("at")
        )

    return F.aggregate(probs, start, step, lambda a: F.greatest(a["at"], F.lit(0)))


def sample_action(df: DataFrame, probs: str, ids: list[str], seed: int, out: str = "Action") -> DataFrame:
    """An action index drawn from the row's probabilities."""
    return df.withColumn(out, draw(F.col(probs), uniform(ids, seed)))


def policy_value_dr(
    df: DataFrame, rewards: str, probs: str, chosen: str, logged: str, reward: str, k: int
) -> DataFrame:
    """Doubly robust mean reward, with uniform logging over k actions (indices from 0)."""
    r_new = F.get(rewards, F.col(chosen))
    r_old = F.get(rewards, F.col(logged))
    value = r_new + F.get(probs, F.col(logged)) * k * (F.col(reward) - r_old)
    return df.agg(F.avg(value).alias("value"), F.count(F.lit(1)).alias("n"))


def clip_weights(df: DataFrame, weight: str, low: float, high: float) -> DataFrame:
    """Instance weights kept within bounds."""
    return df.withColumn(weight, F.least(F.greatest(F.col(weight), F.lit(low)), F.lit(high)))


def policy_value_snips(
    df: DataFrame, policy: str, logging: str, reward: str, low: float = 0.1, high: float = 10.0
) -> DataFrame:
    """Self-normalised mean reward under clipped importance weights."""
    d = clip_weights(df.withColumn("_w", F.col(policy) / F.col(logging)), "_w", low, high)
    return d.agg(
        (F.sum(F.col("_w") * F.col(reward)) / F.sum("_w")).alias("value"),
        F.sum(F.col("_w") * F.col(reward)).alias("weighted_reward"),
        F.sum(reward).alias("logged_reward"),
    )


def estimate_logging_policy(df: DataFrame, action: str, features: list[str], out: str = "propensity") -> DataFrame:
    """Each row's probability of its own logged action, by multinomial logistic regression."""
    model = LogisticRegression(featuresCol="_features", labelCol=action, family="multinomial", maxIter=50)
    fitted = Pipeline(stages=[_assembler(features), model]).fit(df)
    p = vector_to_array("probability")
    d = fitted.transform(df).withColumn(out, F.get(p, F.col(action).cast("int")))
    return d.drop("_features", "rawPrediction", "probability", "prediction")


def predict_with_reward(
    df: DataFrame, scores: str, rewards: str, actions: list[str], ids: list[str], seed: int
) -> DataFrame:
    """Drawn action, its name, its predicted reward, and one probability column per action."""
    d = sample_action(softmax_policy(df, scores, "_p"), "_p", ids, seed)
    names = F.array(*[F.lit(a) for a in actions])
    d = d.withColumn("ActionName", F.get(names, F.col("Action")))
    d = d.withColumn("Reward", F.get(rewards, F.col("Action")))
    return d.withColumns(
        {f"action_prob_{a}": F.get("_p", F.lit(i)) for i, a in enumerate(actions)}
    ).drop("_p")


def abstain(df: DataFrame, scores: str, rho: float, out: str = "pred") -> DataFrame:
    """The best class (index from 0) if it beats the second by more than rho, else the class count."""
    top = F.sort_array(F.col(scores), asc=False)
    best = (F.array_position(scores, top[0]) - 1).cast("int")
    sure = F.get(top, F.lit(0)) - F.get(top, F.lit(1)) > F.lit(rho)
    return df.withColumn(out, F.when(sure, best).otherwise(F.size(scores)))


def abstain_loss(df: DataFrame, pred: str, target: str, classes: int, alpha: float) -> DataFrame:
    """Errors count 1, abstentions alpha."""
    loss = F.when(F.col(pred) == classes, F.lit(float(alpha))).otherwise(
        (F.col(pred) != F.col(target)).cast("double")
    )
    return df.agg(F.sum(loss).alias("loss"), F.count(F.lit(1)).alias("n"))


def batch_infer(
    df: DataFrame,
    load_model: Callable[[], Callable[[pd.DataFrame], pd.DataFrame]],
    ids: list[str],
    outputs: str,
) -> DataFrame:
    """A user's model over Arrow batches, results beside the ids.

    ``load_model`` runs once per task and returns the function of a batch.
    """
    schema = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*ids).schema], outputs])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        predict = load_model()
        for b in batches:
            if len(b):
                yield pd.concat([b[ids].reset_index(drop=True), predict(b).reset_index(drop=True)], axis=1)

    return df.mapInPandas(run, schema)


def batch_infer_stored(
    df: DataFrame,
    load_model: Callable[[], Callable[[pd.DataFrame], pd.DataFrame]],
    ids: list[str],
    outputs: str,
    path: str,
    parts: int = 4,
    together: int = 2,
    holds: Any = None,
) -> DataFrame:
    """Batch inference with a commit per part; a run that stopped goes on with the missing parts.

    What is upstream runs once: its rows are written with their part, by the hash of their id, so
    parts are even and repeatable.  Each part is then read alone, scored and committed,
    ``together`` of them at a time.  A run that goes on reads the rows that are there.  ``holds``
    names what the results are made of (model version, inputs); results of something
    else are made again.  The written rows go when all parts are done.
    """
    spark, top = df.sparkSession, path.rstrip("/")
    where = [f"{top}/part={i}" for i in range(parts)]
    mark = fingerprint(holds, parts, ids, outputs)
    missing = [i for i in range(parts) if sealed(spark, where[i]) != mark]
    if missing:
        inputs = f"{top}/inputs"
        tagged = df.withColumn("_part", F.pmod(F.xxhash64(*ids), F.lit(parts)))
        if sealed(spark, inputs) != mark:
            tagged.where(F.col("_part").isin(missing)).write.mode("overwrite").partitionBy("_part").parquet(inputs)
            seal(spark, inputs, mark)
        rows = spark.read.schema(tagged.schema).parquet(inputs)

        def one(i: int) -> None:
            mine = rows.where(F.col("_part") == i).drop("_part")
            batch_infer(mine, load_model, ids, outputs).write.mode("overwrite").parquet(where[i])
            seal(spark, where[i], mark)

        with ThreadPoolExecutor(max(1, together)) as pool:
            done = [pool.submit(one, i) for i in missing]
        for d in done:
            d.result()
        remove(spark, inputs)
    return spark.read.parquet(*where)


def mask_future_events(df: DataFrame, col: str, n: int) -> DataFrame:
    """Event indicators set to 0 from step n on."""
    return df.withColumn(
        col, F.transform(col, lambda x, i: F.when(i < n, x).otherwise(F.lit(0).cast("int")))
    )
