"""Stateful streams: processors with a store of their own, and whole streams against the batch forms."""

import random
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from caseflow.config import BF24H
from caseflow.functions import timegrid as tg
from caseflow.operators import features as X, observe as O
from caseflow.operators.anchors import densify_anchor
from caseflow.streaming import processors as P, streams as ST

BASE = 1_704_067_200_000_000
MIN = tg.MINUTE


class Store:
    """Stands in for Spark's state store: values, maps and timers of one key."""

    def __init__(self):
        self.value, self.map, self.timers, self.most = None, {}, set(), 0

    def getValueState(self, name, columns):
        return self

    def getMapState(self, name, key, value):
        self.spill = Spill(self)
        return self.spill

    def registerTimer(self, at):
        self.timers.add(at)

    def deleteTimer(self, at):
        self.timers.remove(at)

    def get(self):
        return self.value

    def update(self, value):
        self.value = value

    def clear(self):
        self.value = None

    def getCurrentWatermarkInMs(self):
        return 0


class Spill:
    def __init__(self, store):
        self.rows, self.read = {}, []

    def updateValue(self, key, value):
        self.rows[key] = value

    def getValue(self, key):
        self.read.append(len(self.rows[key][0]))
        return self.rows[key]

    def removeKey(self, key):
        del self.rows[key]


def chunks(times, values, size):
    for i in range(0, len(times), size):
        yield pd.DataFrame({"at_us": times[i : i + size], "reading": values[i : i + size]})


def started(processor):
    store = Store()
    processor.init(store)
    return processor, store


def brute_anchor(times, gap):
    out, anchor = {}, None
    for t in sorted(times):
        if anchor is None or t > anchor + gap:
            anchor = t
        out[t] = anchor
    return out


@pytest.mark.parametrize("size", [7, 1000, 10**6])
def test_a_long_history_in_one_batch_is_walked_by_days(size):
    rnd = random.Random(size)
    times = [BASE + rnd.randrange(40 * 24 * 60) * MIN for _ in range(3000)]
    walk, store = started(P.Anchors("p", 31 * MIN))
    got = pd.concat(walk.handleInputRows((1,), chunks(times, [0.0] * len(times), size), store))
    want = brute_anchor(times, 31 * MIN)
    assert dict(zip(got["event_us"], got["anchor_us"])) == want and len(got) == 3000
    assert not store.spill.rows and len(store.timers) == 1 and store.value[1] == max(want.values())
    if size < 3000:
        assert sum(store.spill.read) == 3000 and max(store.spill.read) <= size


def test_later_batches_go_on_from_the_state():
    walk, store = started(P.Anchors("p", 31 * MIN))
    first = list(walk.handleInputRows((1,), chunks([BASE, BASE + 40 * MIN], [0.0] * 2, 10), store))
    assert first[0]["anchor_us"].tolist() == [BASE, BASE + 40 * MIN]
    late = [BASE + 5 * MIN, BASE + 41 * MIN, BASE + 72 * MIN]
    (got,) = walk.handleInputRows((1,), chunks(late, [0.0] * 3, 10), store)
    assert got["anchor_us"].tolist() == [BASE + 5 * MIN, BASE + 40 * MIN, BASE + 72 * MIN]
    assert len(store.timers) == 1 and list(walk.handleInputRows((1,), iter([pd.DataFrame()]), store)) == []
    walk.handleExpiredTimer((1,), None, None)
    assert store.value is None


def test_the_moving_multiset_knows_its_mode():
    rnd = random.Random(1)
    bag, held = P.Values(), []
    for _ in range(20_000):
        if held and rnd.random() < 0.5:
            bag.remove(held.pop(rnd.randrange(len(held))))
        else:
            held.append(float(rnd.randrange(12)))
            bag.add(held[-1])
        counts = Counter(held)
        top = max(counts.values(), default=0)
        assert bag.top == top and bag.mode() == min((v for v, c in counts.items() if c == top), default=None)
    assert bag._pushed <= 4 * len(bag.counts) + 1001


def brute_info(times, values, t):
    seen = [v for u, v in zip(times, values) if t + BF24H.lo <= u < t + BF24H.hi]
    known, n = [v for v in seen if v == v], len(seen)
    counts = Counter(known)
    top = max(counts.values(), default=0)
    mode = min((v for v, c in counts.items() if c == top), default=0)
    at_mode = top if mode >= X.TINY else counts.get(X.TINY, 0)
    share = lambda test: round(sum(map(test, known)) / n, 6)
    return (round(max(at_mode / n, X.TINY), 6), share(lambda v: v == 0), share(lambda v: v >= 400), share(lambda v: v <= 20), n)


@pytest.mark.parametrize("size", [50, 10**6])
def test_sliding_info_of_a_long_history(size):
    """Rows in any order, null readings, times off the grid that fall into the window's 3.6 ms after a case."""
    rnd = random.Random(size)
    times = [BASE + i * 5 * MIN + rnd.choice([0, 0, 1000]) for i in range(288 * 4)] + [BASE + tg.DAY + 3_000, BASE + tg.DAY - 1]
    values = [rnd.choice([0.0, 1e-06, 20.0, 100.0, 100.5, 400.0, float("nan")]) for _ in times]
    order = rnd.sample(range(len(times)), len(times))
    look, store = started(P.SlidingInfo("p", BF24H.lo, BF24H.hi, 60 * MIN))
    rows = chunks([times[i] for i in order], [values[i] for i in order], size)
    got = pd.concat(look.handleInputRows((1,), rows, store)).reset_index(drop=True)
    assert len(got) == len(times)
    for r in got.sample(200, random_state=1).itertuples():
        want = brute_info(times, values, r.obs_us)
        assert (r.ModePercent, r.ZeroPercent, r.Geq400Percent, r.Leq20Percent, r.RecNum) == pytest.approx(want, abs=1e-9)
    assert len(store.value[1]) <= 288 + 12 + 5 and not store.spill.rows


def run(spark, stream, tmp_path):
    ST.run_to_table(stream, str(tmp_path / "out"), str(tmp_path / "state"))
    return spark.read.schema(stream.schema).parquet(str(tmp_path / "out"))


@pytest.fixture
def small_chunks(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 200)
    yield
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_streams_equal_batch_for_a_busy_patient(spark, tmp_path, small_chunks):
    """One patient with most rows, two weeks in one micro-batch of many chunks, unordered."""
    i = F.col("id")
    rows = spark.range(288 * 14).where("id % 11 <> 0").select(
        F.when(i % 9 == 0, 2 + i % 3).otherwise(1).alias("PID"), (i * 5 * MIN + BASE).alias("us"), (i * 7 % 5 * 100.0).alias("BGValue")
    )
    rows = rows.withColumn("DT_s", F.timestamp_micros("us")).orderBy(F.xxhash64("us"))
    rows.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))

    got = run(spark, ST.stream_densify(stream, "PID", "DT_s"), tmp_path / "a")
    want = densify_anchor(rows.select("PID", F.col("us").alias("event_us")), ["PID"], "event_us")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.select(*got.columns).collect()))

    got = run(spark, ST.stream_sliding_info(stream, "PID", "DT_s", "BGValue"), tmp_path / "b")
    flat = rows.withColumn("DT_s", F.col("DT_s").cast("timestamp_ntz"))
    cases = flat.select("PID", F.col("DT_s").alias("ObsDT"))
    want = O.observe_frame(cases, {X.CGM: flat}, [X.cgm_info("a", BF24H)], value={X.CGM: "BGValue"})
    want = want.select("PID", tg.micros("ObsDT").alias("obs_us"), *[F.col(f"`a-{c}`").alias(c) for c in got.columns[2:]])
    found, known = (sorted(map(tuple, x.collect())) for x in (got, want))
    assert len(found) == len(known) and np.allclose(found, known, atol=1e-9)


def test_readings_of_later_batches_see_the_ones_before(spark, tmp_path):
    """A file a micro-batch, in order: the state carries a day over."""
    i = F.col("id")
    rows = spark.range(288 * 3).select(F.lit(1).alias("PID"), (i * 5 * MIN + BASE).alias("us"), (i % 4 * 150.0).alias("BGValue"))
    rows = rows.withColumn("DT_s", F.timestamp_micros("us"))
    for k in range(3):
        rows.where(f"(us - {BASE}) div {tg.DAY} = {k}").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    got = run(spark, ST.stream_sliding_info(stream, "PID", "DT_s", "BGValue"), tmp_path / "o")
    n = {r["obs_us"]: r["RecNum"] for r in got.collect()}
    assert n == {BASE + i * 5 * MIN: min(i + 1, 289) for i in range(288 * 3)}
