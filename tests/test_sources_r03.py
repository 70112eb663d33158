"""Sources held as folders, and hooks that get many patient-days a call."""

import pandas as pd
from pyspark.sql import functions as F

from caseflow.plans import timeline as TL
from caseflow.sources import readers as RD


def test_a_folder_of_part_files_is_one_source(spark, tmp_path):
    root = tmp_path / "a.parquet.d"
    spark.range(10).repartition(3).write.parquet(str(root / "big.parquet"))
    spark.range(5).coalesce(1).write.parquet(str(root / "deep" / "k=1" / "other.parquet"))
    (root / "plain.parquet").write_bytes(b"12345")
    (root / "note.txt").write_bytes(b"1")
    (root / "__processed__.parquet").write_bytes(b"1")
    for path in (str(root), f"file://{root}/"):
        got = {r["path"].rsplit("/", 1)[1]: r["length"] for r in RD.list_sources(spark, path, ["parquet"]).collect()}
        parts = sum(f.stat().st_size for f in (root / "big.parquet").glob("*.parquet"))
        assert set(got) == {"big.parquet", "other.parquet", "plain.parquet"}
        assert got["plain.parquet"] == 5 and got["big.parquet"] == parts


def test_a_day_hook_is_called_for_many_whole_days(spark):
    rows = spark.range(30_000).select(
        F.when(F.col("id") % 100 != 0, F.col("id") % 400).alias("PID"),
        F.expr("timestamp_ntz'2024-01-01' + make_dt_interval(id % 7, 0, 0, id % 86400)").alias("DT_s"),
    )

    def days(pdf):
        assert "_day" not in pdf.columns
        d = pdf.assign(day=pdf["DT_s"].dt.strftime("%Y-%m-%d"), n=1, call=0)
        out = d.groupby(["PID", "day"], dropna=False)["n"].sum().reset_index()
        return out.assign(calls=[1] + [0] * (len(out) - 1))

    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 997)
    try:
        got = TL.per_patient_batch(rows, "PID", days, "PID bigint, day string, n bigint, calls bigint").toPandas()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    want = rows.groupBy("PID", F.date_format("DT_s", "yyyy-MM-dd").alias("day")).count().toPandas()
    both = got.merge(want, on=["PID", "day"], how="outer")
    assert len(got) == len(want) == len(both) and (both["n"] == both["count"]).all()
    assert got["calls"].sum() < len(want) / 10, "a call for each day costs more than its rows"
    assert pd.isna(got["PID"]).any()
