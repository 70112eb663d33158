"""What a task of the text operators holds: few texts at once, and only tables that can be shared."""

import pyarrow as pa
from pyspark.sql import functions as F, types as T

from caseflow.llm import common as C, near_dup as N


def test_texts_come_in_short_lists(spark):
    docs = spark.range(2_600).coalesce(1).select("id", F.col("id").cast("string").alias("text"))
    schema = T.StructType([T.StructField("n", T.LongType()), T.StructField("back", T.StringType())])
    got = C.map_text(docs, ["id"], "text", schema, lambda ts: {"n": [len(ts)] * len(ts), "back": ts}).collect()
    assert sorted(r["id"] for r in got) == list(range(2_600)) and all(r["back"] == str(r["id"]) for r in got)
    assert max(r["n"] for r in got) <= 500


def test_batches_of_long_texts_are_bounded_by_bytes(spark):
    """20,000 texts of 3 kB reach Python in batches of about 4 MB; a smaller bound of the session stays."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    docs = spark.range(0, 20_000, 1, 1).select("id", F.repeat(F.lit("abc "), 750).alias("text"))
    schema = T.StructType([T.StructField("n", T.LongType())])

    def held(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows]), pa.array([b.nbytes])], names=["rows", "bytes"])

    try:
        assert C.map_text(docs, ["id"], "text", schema, lambda ts: {"n": [len(t) for t in ts]}).agg(F.sum("n")).first()[0] == 60_000_000
        got = docs.mapInArrow(held, "rows long, bytes long").collect()
        assert sum(r["rows"] for r in got) == 20_000 and max(r["bytes"] for r in got) < 5_000_000
        spark.conf.set(name, "1000000")
        C.bound_batches(spark)
        assert spark.conf.get(name) == "1000000"
    finally:
        spark.conf.set(name, before)


def test_only_shared_halves_become_tables(spark, monkeypatch):
    """200 unrelated texts and two alike: tables are laid out for the two."""
    made, keep = {}, C.stored
    monkeypatch.setattr(C, "stored", lambda df, name: made.setdefault(name, keep(df, name)))
    rows = [(i, [1000 + i, 2000 + i], [3000 + i, 4000 + i]) for i in range(200)]
    rows += [(900, [1, 2], [3, 4]), (901, [1, 9], [3, 4])]
    reps = spark.createDataFrame(rows, "id long, left array<long>, right array<long>")
    got = N._buckets(reps)
    assert made["near-tables"].count() == 4
    assert sorted(r["id"] for r in got.collect()) == [900, 900, 901, 901]


def test_a_pivot_meets_every_member_in_all_slices(spark, monkeypatch):
    """A pivot's text is no column beside its members'; verdicts are those of full sets."""
    monkeypatch.setattr(N, "BLOCK", 3)
    words = [f"w{i}" for i in range(40)]
    rows = [(i, " ".join(words[: 40 - i])) for i in range(20)]
    texts = spark.createDataFrame(rows, "id long, text string")
    stars = spark.createDataFrame([(4, i) for i in range(20) if i != 4] + [(19, 2)], "pivot long, id long")
    plan = N._compare(stars, texts, 3, 80, 100)
    assert "pivot_text" not in plan._jdf.queryExecution().toString()
    got = {(r["pivot"], r["id"]): (r["linked"], r["size"]) for r in plan.collect()}
    sets = {i: set(zip(*[t.split()[k:] for k in range(3)])) for i, t in rows}
    want = {}
    for p, i in [(4, i) for i in range(20) if i != 4] + [(19, 2)]:
        want[p, i] = (100 * len(sets[p] & sets[i]) >= 80 * len(sets[p] | sets[i]), len(sets[i]))
    assert got == want


def test_texts_of_a_repeated_pivot_are_all_met(spark):
    text = " ".join(f"w{i}" for i in range(40))
    texts = spark.createDataFrame([(1, "other words"), (1, text), (1, "else"), (2, text)], "id long, text string")
    stars = spark.createDataFrame([(1, 2)], "pivot long, id long")
    got = N._compare(stars, texts, 3, 80, 100).collect()
    assert sorted(r["linked"] for r in got) == [False, False, True]
