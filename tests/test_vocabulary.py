"""Token ids by search and by join."""

import random
import time

import pytest
from pyspark.sql import functions as F

from caseflow.operators import tokens as K

SCHEMA = "id int, f_tkn array<string>, f_wgt array<double>"


def rows(vocab, n=200):
    rnd = random.Random(4)
    out = [(i, [rnd.choice(vocab) for _ in range(rnd.randrange(7))], [1.0]) for i in range(n)]
    return [*out, (n, None, None), (n + 1, [], []), (n + 2, [vocab[0]] * 3, [0.5]), (n + 2, [vocab[0]] * 3, [0.5])]


@pytest.mark.parametrize("size", [1, 2, 3, 64, 65, 500, 501])
def test_ids_are_places_in_the_vocabulary(spark, size):
    vocab = [f"{chr(0x61 + i % 26)}é_{i * 7919 % 1000}_{i}" for i in range(size)]
    given = rows(vocab)
    df = spark.createDataFrame(given, SCHEMA)
    want = sorted((i, None if t is None else [vocab.index(x) for x in t], w) for i, t, w in given)
    for form in (vocab, K.vocab_table(spark, vocab)):
        got = K.tokens_to_ids(df, "f", form, ["id"])
        assert dict(got.dtypes)["f_tid"] == "array<int>"
        assert sorted(map(tuple, got.collect()), key=lambda r: r[0]) == sorted(want, key=lambda r: r[0])


@pytest.mark.parametrize("size", [3, 600])
def test_unknown_tokens_are_named(spark, size):
    vocab = [f"t{i}" for i in range(size)]
    for odd in ("nosuch", "", "t", "zzz"):
        df = spark.createDataFrame([(1, ["t1", odd], [1.0, 1.0])], SCHEMA)
        with pytest.raises(Exception, match=f"token not in vocabulary: {odd}"):
            K.tokens_to_ids(df, "f", vocab, ["id"]).collect()
    with pytest.raises(ValueError, match="twice"):
        K.tokens_to_ids(df, "f", ["a", "a"], ["id"])


def test_a_large_vocabulary_takes_seconds(spark):
    vocab = [f"token {i}" for i in range(100_000)]
    i = F.col("id")
    df = spark.range(50_000).select(
        i.cast("int").alias("id"),
        F.transform(F.sequence(F.lit(0), F.lit(9)), lambda k: F.concat(F.lit("token "), (i * 7 + k * 1009) % 100_000)).alias("f_tkn"),
        F.array_repeat(F.lit(1.0), 10).alias("f_wgt"),
    )
    start = time.perf_counter()
    got = K.tokens_to_ids(df, "f", vocab, ["id"])
    wrong = F.exists(F.arrays_zip("f_tid", F.sequence(F.lit(0), F.lit(9)).alias("k")), lambda x: x["f_tid"] != (i * 7 + x["k"] * 1009) % 100_000)
    assert got.where(wrong).count() == 0 and got.count() == 50_000
    assert time.perf_counter() - start < 30
    assert len(got._jdf.queryExecution().toString()) < 100_000  # the vocabulary is no part of the plan's text
