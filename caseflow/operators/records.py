"""Raw rows to records: time zones, the 5-minute grid, rollups, record ids."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from caseflow.functions import timegrid as tg
from caseflow.operators.anchors import densify_anchor
from caseflow.operators.shaping import first_value, ordered_join
from caseflow.plans.spread import join_null_safe, previous_time, rank_rows, row_order, running, stored

# Time formats met in raw tables, the time at or before which a
# clock was unset, the offset (minutes) from which a value is invalid, and the
# minutes of exercise kept.
TIME_FORMATS = [
    "yyyy-MM-dd HH:mm:ss[.SSSSSS]",
    "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]",
    "M/d/yyyy H:mm:ss",
    "M/d/yyyy H:mm",
    "yyyy-MM-dd",
]
UNSET_CLOCK = "2010-01-01 00:00:00"
INVALID_OFFSET = 1000
EXERCISE_MINUTES = (5, 120)
#: Rows of one key that meet in one place of a join.
CELL = 20_000
#: Slices of a busy key that are enough for tasks to share its pairs; more would only copy rows.
SLICES = 64


def eligible_entities(human: DataFrame, names: list[str]) -> DataFrame:
    """Patients with rows in every raw table a record needs."""
    return human.where(reduce(Column.__and__, [F.col(n) > 0 for n in names]))


def restrict_to_entities(raw: DataFrame, human: DataFrame, key: str) -> DataFrame:
    """Raw rows of the chosen patients."""
    return raw.join(human.select(key), key, "left_semi")


def merge_raws(raws: list[DataFrame], key: str | list[str], cell: int = CELL) -> DataFrame:
    """Raw tables of one record joined on the patient, rows of either side kept.

    On the patient alone, tables with many rows of a patient on both sides give every pair
    of them: that is the rule's meaning.  Where a record allows it, give further keys (a day,
    an entry id) to keep the pairs of a busy patient apart.

    A key with more than ``cell`` rows on a side is dealt out on both: its rows fall into
    slices of about that size, every slice of the one side meets every slice of the other
    in a cell of its own, and rows without a partner are spread without copies.  A small ``cell``
    makes ``SLICES`` slices at most, unless those would be longer than ``CELL`` rows.
    """
    keys = [key] if isinstance(key, str) else list(key)
    return reduce(lambda a, b: _outer_join(a, b, keys, cell), raws)


def _slices(rows: str, cell: int) -> Column:
    """Slices of a key's rows: every row goes to all slices of the other side, so no more than it takes."""
    enough = F.greatest(F.lit(SLICES), F.ceil(F.col(rows) / max(cell, CELL)))
    return F.greatest(F.least(F.ceil(F.col(rows) / cell), enough), F.lit(1)).cast("int")


def _outer_join(left: DataFrame, right: DataFrame, keys: list[str], cell: int) -> DataFrame:
    """Full outer join that holds the pairs of one left row at a time; Spark's own holds all pairs of a key.

    Every left row meets its right rows; right rows without a partner meet a stand-in, a left row without values.
    """
    marked = [d.select(*keys, F.lit(l).alias("_l"), F.lit(1 - l).alias("_r")) for d, l in ((left, 1), (right, 0))]
    found = marked[0].unionByName(marked[1]).groupBy(*keys).agg(F.sum("_l").alias("_l"), F.sum("_r").alias("_r"))
    # a null key has no partner, however many rows have it
    known = reduce(Column.__and__, [F.col(k).isNotNull() for k in keys])
    partner = known & (F.col("_l") > 0) & (F.col("_r") > 0)
    found = found.select(
        *keys,
        partner.alias("_split"),
        (~partner & (F.col("_r") > 0)).alias("_alone"),
        ((F.col("_l") > cell) | (F.col("_r") > cell)).alias("_busy"),
        _slices("_l", cell).alias("_ls"),
        _slices("_r", cell).alias("_rs"),
    )
    found = stored(found.where("_busy OR _alone"), "outer-keys")
    busy = stored(found.where("_busy").drop("_busy", "_alone"), "busy-keys")
    even = busy.isEmpty()

    def dealt(d: DataFrame, own: str, other: str, mine: str, theirs: str) -> DataFrame:
        """Rows with their slice, once for each slice of the other side."""
        if even:
            return d.withColumns({mine: F.lit(0), theirs: F.lit(0), "_meets": F.lit(False)})
        same = F.xxhash64(*[f"`{f.name}`" for f in d.schema.fields if "map<" not in f.dataType.simpleString()])
        d = join_null_safe(d, busy, keys, "left")
        copies = F.when(F.col("_split"), F.col(other) - 1).otherwise(0)
        d = d.withColumn(mine, F.pmod(same, F.coalesce(own, F.lit(1))).cast("int"))
        d = d.withColumn(theirs, F.explode(F.sequence(F.lit(0), F.coalesce(copies, F.lit(0)))))
        return d.withColumn("_meets", F.coalesce("_split", F.lit(False))).drop("_split", "_ls", "_rs")

    rest = left.drop(*keys)
    if left.columns[: len(keys)] != keys:
        left = left.select(*keys, *[f"`{c}`" for c in rest.columns])
    # null meets null below, so right rows with a null key are kept from left ones by their place
    place = F.when(known, 0).otherwise(-1)
    empty = [F.lit(None).cast(f.dataType).alias(f.name) for f in rest.schema.fields]
    parts = F.explode(F.sequence(F.lit(0), F.col("_rs") - 1))
    alone = found.where("_alone").select(*keys, *empty, place.alias("_i"), parts.alias("_j"), F.lit(True).alias("_meets"))
    a = dealt(left, "_ls", "_rs", "_i", "_j").union(alone)
    b = dealt(right, "_rs", "_ls", "_j", "_i").drop("_meets").withColumn("_met", F.lit(True))
    b = b.withColumn("_i", F.when(known, F.col("_i")).otherwise(-1))
    joined = join_null_safe(a, b.hint("merge"), [*keys, "_i", "_j"], "left")
    # of a key that was split both sides exist: a copy that meets an empty slice is no lone row, nor is a stand-in
    return joined.where(~F.col("_meets") | F.col("_met").isNotNull()).drop("_i", "_j", "_meets", "_met")


def parse_mixed_ts(col: Column) -> Column:
    """Time text in any of the known formats; unreadable text is null."""
    return F.coalesce(
        *[F.try_to_timestamp(col, F.lit(f)).cast("timestamp_ntz") for f in TIME_FORMATS]
    )


def resolve_tz(df: DataFrame, offset: str, user_tz: str = "user_tz", default=None) -> DataFrame:
    """Rows with a usable offset, and the offset to apply as ``DT_tz``.

    Offset 0 means unknown: the patient's own offset is used, then ``default``.
    """
    tz = F.coalesce(F.nullif(F.col(offset), F.lit(0)), F.col(user_tz))
    if default is not None:
        tz = F.coalesce(tz, F.lit(default))
    return df.where(F.abs(offset) < INVALID_OFFSET).withColumn("DT_tz", tz.cast("int"))


def localize(df: DataFrame, observed: str, entered: str | None, tz: str = "DT_tz") -> DataFrame:
    """Local time ``DT_s``; with ``entered``, its local time ``DT_r`` stands in for an unset clock.

    Without ``entered`` rows whose time is unknown are dropped.
    """
    unset = F.lit(UNSET_CLOCK).cast("timestamp_ntz")
    at = tg.shift_minutes(F.when(F.col(observed) > unset, F.col(observed)), F.col(tz))
    if entered is None:
        return df.withColumn("DT_s", at).where(F.col("DT_s").isNotNull())
    df = df.withColumn("DT_r", tg.shift_minutes(F.col(entered), F.col(tz)))
    return df.withColumn("DT_s", F.coalesce(at, F.col("DT_r")))


def floor_5min(df: DataFrame, cols: list[str]) -> DataFrame:
    """Times lowered to the 5-minute grid."""
    return df.withColumns({c: tg.floor_5min(c) for c in cols})


def drop_exact_duplicates(df: DataFrame) -> DataFrame:
    """One of each set of identical rows; the patient is part of the row."""
    return df.dropDuplicates()


def glucose_5min(df: DataFrame, key: str = "PatientID", value: str = "BGValue") -> DataFrame:
    """Mean reading per patient and 5-minute step (partial averages before the shuffle)."""
    return df.groupBy(key, "DT_s").agg(F.avg(value).alias(value))


def densify(df: DataFrame, key: str = "PatientID", gap_minutes: int = 31) -> DataFrame:
    """``DT_s`` replaced by its anchor's time; the time before is kept as ``DT_o``."""
    missing = F.concat(F.lit("no time DT_s in an event record of patient "), F.coalesce(F.col(key).cast("string"), F.lit("null")))
    d = df.withColumn("_us", F.coalesce(tg.micros("DT_s"), F.raise_error(missing).cast("bigint")))
    d = densify_anchor(d, [key], "_us", gap_minutes, "_anchor")
    return d.withColumn("DT_o", F.col("DT_s")).withColumn("DT_s", tg.from_micros("_anchor")).drop(
        "_us", "_anchor"
    )


def event_rollup(
    df: DataFrame,
    key: str = "PatientID",
    sums: list[str] | None = None,
    firsts: list[str] | None = None,
    joins: list[str] | None = None,
    order: list[str] | None = None,
) -> DataFrame:
    """Per patient and grid time: sums (all null gives 0), first non-null values, joined texts.

    First and joined follow ``order``, the original time unless given.
    """
    order = order or ["DT_o"]
    at = F.struct(*order)
    return df.groupBy(key, "DT_s").agg(
        *[first_value(c, at).alias(c) for c in firsts or []],
        *[ordered_join(order, c).alias(c) for c in joins or []],
        *[F.coalesce(F.sum(c), F.lit(0.0)).alias(c) for c in sums or []],
    )


def time_to_last_entry(df: DataFrame, key: str = "PatientID") -> DataFrame:
    """5-minute steps since the patient's previous record; null for the first."""
    d = previous_time(df.withColumn("_us", tg.micros("DT_s")), [key], "_us", "_prev")
    steps = (F.col("_us") - F.col("_prev")) / F.lit(float(tg.STEP))
    return d.withColumn("time_to_last_entry", steps).drop("_us", "_prev")


def exercise_range(df: DataFrame, col: str = "ExerciseDuration") -> DataFrame:
    """Records whose duration is within the kept range."""
    low, high = EXERCISE_MINUTES
    return df.where(F.col(col).between(low, high))


def exercise_end(df: DataFrame, minutes: str = "ExerciseDuration") -> DataFrame:
    """End time ``DT_e`` of an exercise."""
    return df.withColumn(
        "DT_e", tg.from_micros(tg.micros("DT_s") + (F.col(minutes).cast("double") * tg.MINUTE).cast("bigint"))
    )


def patient_record(df: DataFrame) -> DataFrame:
    """Demographics: disease type as one-decimal text, unknown offset 0."""
    number = F.col("DiseaseType").cast("double")
    kind = F.when(number.isNull(), "nan").otherwise(F.format_string("%.1f", number))
    return df.withColumn("DiseaseType", kind).withColumn(
        "UserTimeZoneOffset", F.coalesce(F.col("UserTimeZoneOffset").cast("int"), F.lit(0))
    )


def attach_parent(df: DataFrame, parent: DataFrame, raw_key: str, chain: list[str]) -> DataFrame:
    """Records of patients with a parent record, with its ids."""
    return df.join(parent.select(raw_key, *chain), raw_key)


def assign_record_id(df: DataFrame, out: str, pid: str = "PID", time: str = "DT_s") -> DataFrame:
    """``PID-0000000``: running number of the record in its patient by time.

    Numbers are counted per patient-day first, so a patient is never one task.  Equal
    times are ordered by the other columns, a null time comes first, and numbers beyond
    seven digits keep all of them.
    """
    if out in df.columns:
        return df
    d = df.withColumn("_us", tg.micros(time))
    d = rank_rows(d, row_order(d, ["_us"]), "_n", group=[pid], chunk=tg.bucket(F.col("_us")))
    number = (F.col("_n") - 1).cast("string")
    number = F.lpad(number, F.greatest(F.lit(7), F.length(number)), F.lit("0"))
    return d.withColumn(out, F.concat_ws("-", F.col(pid).cast("string"), number)).drop("_us", "_n")


def record_index(df: DataFrame, pid: str = "PID", time: str = "DT_s") -> DataFrame:
    """First and last row position of each patient in the table sorted by patient and time,
    with the first and last time."""
    per = df.groupBy(pid).agg(
        F.count(F.lit(1)).alias("n"), F.min(time).alias("first_time"), F.max(time).alias("last_time")
    )
    placed = running(per, [pid], {"_upto": F.col("n")})
    return placed.select(
        pid,
        (F.col("_upto") - F.col("n")).alias("first_row"),
        (F.col("_upto") - 1).alias("last_row"),
        "n",
        "first_time",
        "last_time",
    )


def record_dates(df: DataFrame, pid: str = "PID", time: str = "DT_s") -> DataFrame:
    """Sorted record times of each patient-day, one array per day."""
    return df.groupBy(pid, F.to_date(time).alias("day")).agg(
        F.sort_array(F.collect_list(time)).alias("times")
    )


def concat_groups(parts: list[DataFrame]) -> DataFrame:
    """Records of several patient groups or cohorts."""
    return reduce(DataFrame.unionByName, parts)


def glucose_record(raw: DataFrame, human: DataFrame) -> DataFrame:
    """Glucose entries to 5-minute means in local time."""
    d = raw.join(human.select("PatientID", "user_tz"), "PatientID", "left")
    d = resolve_tz(d, "TimezoneOffset")
    d = floor_5min(localize(d, "ObservationDateTime", None), ["DT_s"])
    return glucose_5min(drop_exact_duplicates(d))


def _event_record(raw, human, offset, observed, entered, default=None):
    d = raw.join(human.select("PatientID", "user_tz"), "PatientID", "left")
    return localize(resolve_tz(d, offset, default=default), observed, entered)


def diet_record(raw: DataFrame, human: DataFrame, sums: list[str]) -> DataFrame:
    """Meals with carbohydrates to anchored diet records."""
    d = _event_record(raw, human, "TimezoneOffset", "ObservationDateTime", "ObservationEntryDateTime")
    d = floor_5min(densify(d.where(F.col("Carbs") > 0)), ["DT_s", "DT_r"])
    d = event_rollup(
        drop_exact_duplicates(d),
        sums=sums,
        firsts=["DT_r", "DT_tz", "ActivityType"],
        joins=["FoodName"],
        order=["DT_o", "FoodName"],
    )
    return time_to_last_entry(d)


def medication_record(raw: DataFrame, human: DataFrame) -> DataFrame:
    """Administrations to anchored medication records; an unknown offset is 0."""
    d = _event_record(
        raw, human, "AdministrationTimeZoneOffset", "AdministrationDate", "EntryDateTime", default=0
    )
    d = floor_5min(densify(d), ["DT_s", "DT_r"])
    d = event_rollup(
        drop_exact_duplicates(d),
        firsts=["DT_r", "DT_tz"],
        joins=["MedicationID", "Dose"],
        order=["DT_o", "MedicationID", "Dose"],
    )
    return time_to_last_entry(d)


def exercise_record(raw: DataFrame, human: DataFrame) -> DataFrame:
    """Exercise entries to anchored records of plausible duration."""
    d = _event_record(raw, human, "TimezoneOffset", "ObservationDateTime", "ObservationEntryDateTime")
    d = drop_exact_duplicates(exercise_end(d))
    d = floor_5min(densify(d), ["DT_s", "DT_r", "DT_e"])
    d = event_rollup(
        drop_exact_duplicates(d),
        sums=["ExerciseDuration", "CaloriesBurned", "DistanceInMeters"],
        firsts=["DT_r", "DT_tz", "ExerciseIntensity", "ActivityType"],
        joins=["ExerciseType"],
        order=["DT_o", "ExerciseType"],
    )
    return exercise_range(time_to_last_entry(d))
