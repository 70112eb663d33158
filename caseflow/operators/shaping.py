"""Source tables to raw tables: renames, code maps, meal rollup, patient split, sections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from caseflow.functions import codes

JOINER = "; "


def rename_key(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """Columns renamed where present."""
    return df.withColumnsRenamed({k: v for k, v in names.items() if k in df.columns})


def patient_outer_join(patient: DataFrame, user: DataFrame, key: str = "PatientID") -> DataFrame:
    """Patient and user attributes of every patient that is in either table."""
    return patient.join(user, key, "full_outer")


def map_codes(df: DataFrame, col: str, table: dict, out: str, keep_unmapped: bool = False) -> DataFrame:
    """Code to label; an unknown code gives null, or stays as it is with ``keep_unmapped``."""
    label = codes.lookup(F.col(col), table)
    if keep_unmapped:
        label = F.coalesce(label, F.col(col).cast("string"))
    return df.withColumn(out, label)


def ordered_join(order: list[str], text: str, joiner: str = JOINER) -> Column:
    """Aggregate: texts of a group joined in a fixed order; nulls left out."""
    items = F.collect_list(
        F.when(F.col(text).isNotNull(), F.struct(*order, F.col(text).cast("string").alias("_txt")))
    )
    return F.array_join(F.transform(F.sort_array(items), lambda x: x["_txt"]), joiner)


def first_value(col: str, order: Column) -> Column:
    """Aggregate: non-null value that comes first in the order."""
    return F.min_by(col, F.when(F.col(col).isNotNull(), order))


def meal_rollup(
    food: DataFrame,
    keys: list[str],
    name: str,
    order: list[str],
    sums: list[str] | None = None,
) -> DataFrame:
    """Food items to meals: names joined, nutrients summed (all-null sums are 0)."""
    sums = codes.NUTRIENTS if sums is None else sums
    return food.groupBy(*keys).agg(
        ordered_join(order, name).alias(name),
        *[F.coalesce(F.sum(c), F.lit(0.0)).alias(c) for c in sums],
    )


def diet_join(carbs: DataFrame, meal: DataFrame, keys: list[str]) -> DataFrame:
    """Carbohydrate entries with the meal they belong to."""
    return carbs.join(meal, keys)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Listed columns in order, cast to their types; missing ones null."""
    return df.select(
        [
            (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema
        ]
    )


def route_events(events: DataFrame, name: str, table: dict[str, str], out: str = "RecName") -> DataFrame:
    """Events with the record they feed; events of no record are left out."""
    return events.withColumn(out, codes.lookup(F.col(name), table)).where(F.col(out).isNotNull())


def distinct_ids_by_type(events: DataFrame, kind: str, first: str, second: str) -> DataFrame:
    """Distinct ids of each kind as rows ``(kind, id_type, id)``; null ids read ``nan``.

    Rows rather than one list per kind: a list would hold all ids of the largest
    kind in a single value.
    """
    a, b = [F.coalesce(F.col(c).cast("string"), F.lit("nan")) for c in (first, second)]
    ids = F.array(
        F.struct(F.lit(first).alias("id_type"), a.alias("id")),
        F.struct(F.lit(second).alias("id_type"), b.alias("id")),
        F.struct(F.lit(f"{first}-{second}").alias("id_type"), F.concat_ws("-", a, b).alias("id")),
    )
    return events.select(kind, F.inline(ids)).distinct()


def known_invitation_rx(
    rx: DataFrame, inv: DataFrame, on: list[str], rx_id: str, order: list[str]
) -> DataFrame:
    """Prescriptions of known invitations, one row per id: first non-null value per column."""
    kept = rx.join(inv.select(*on).distinct(), on, "left_semi")
    cols = [c for c in rx.columns if c != rx_id]
    key = F.struct(*order)
    return kept.groupBy(rx_id).agg(*[first_value(c, key).alias(c) for c in cols])


def membership_flags(
    rx: DataFrame, ids: DataFrame, kinds: list[str], kind: str, first: str, second: str
) -> DataFrame:
    """0/1 column per kind: whether the row's ``first-second`` pair was ever seen in that kind.

    ``ids`` is the output of :func:`distinct_ids_by_type`; the pair ``nan-nan`` never counts.
    """
    a, b = [F.coalesce(F.col(c).cast("string"), F.lit("nan")) for c in (first, second)]
    pair = F.concat_ws("-", a, b)
    seen = (
        ids.where((F.col("id_type") == f"{first}-{second}") & (F.col("id") != "nan-nan"))
        .groupBy(F.col("id").alias("_pair"))
        .agg(*[F.max((F.col(kind) == k).cast("int")).alias(k) for k in kinds])
    )
    out = rx.withColumn("_pair", pair).join(seen, "_pair", "left").drop("_pair")
    return out.fillna(0, subset=kinds)


def split_patient_dim(
    rx: DataFrame, key: str, attributes: list[str], order: list[str], zips: list[str] | None = None
) -> DataFrame:
    """Patient attributes, one row per patient; zip codes cut before the decimal point."""
    cols = [c for c in attributes]
    out = rx.groupBy(key).agg(*[first_value(c, F.struct(*order)).alias(c) for c in cols])
    for z in zips or []:
        out = out.withColumn(z, F.substring_index(F.col(z).cast("string"), ".", 1))
    return out


def zip_timezone(df: DataFrame, geo: DataFrame, values: list[str]) -> DataFrame:
    """Place columns by three-digit zip, else by five-digit zip, else null."""
    if set(values) <= set(df.columns):
        return df
    for z in ("zipcode3", "zipcode5"):
        if z in df.columns and z in geo.columns:
            return df.join(geo.select(z, *values), z, "left")
    return df.withColumns({v: F.lit(None).cast("string") for v in values})


def xml_patient_meta(df: DataFrame, path: str = "file_path", pid: str = "id") -> DataFrame:
    """Year and train/test part read from the file path; the part is added to the patient id."""
    p = F.col(path)
    year = F.regexp_extract(p, r"/(\d{4})/", 1)
    part = (
        F.when(p.contains("/test/") | p.contains("-testing"), "test")
        .when(p.contains("/train/") | p.contains("-training"), "train")
        .otherwise("unknown")
    )
    suffix = F.when(F.col("dataset_type") == "unknown", "").otherwise(
        F.concat(F.lit("_"), F.col("dataset_type"))
    )
    return (
        df.withColumn("year", F.when(year == "", "unknown").otherwise(year))
        .withColumn("dataset_type", part)
        .withColumn("patient_id", F.concat(F.col(pid).cast("string"), suffix))
    )


def parse_ts(df: DataFrame, cols: list[str], fmt: str = "dd-MM-yyyy HH:mm:ss") -> DataFrame:
    """Text to time in one format; unreadable text becomes null."""
    return df.withColumns(
        {c: F.try_to_timestamp(F.col(c), F.lit(fmt)).cast("timestamp_ntz") for c in cols}
    )


# XML section to raw table, its renames and the constants it gets.
SECTIONS = {
    "glucose_level": (
        "ElogBGEntry",
        {"value": "BGValue", "ts": "ObservationDateTime"},
        {"TimezoneOffset": 0, "ExternalSourceID": 18},
        "BGEntryID",
        "EntryCreatedDateTime",
    ),
    "meal": (
        "ELogCarbsEntry",
        {"carbs": "CarbsValue", "ts": "ObservationDateTime"},
        {"TimezoneOffset": 0},
        "CarbsEntryID",
        "EntryCreatedDateTime",
    ),
    "exercise": (
        "ELogExerciseEntry",
        {"ts": "ObservationDateTime", "intensity": "ExerciseIntensity", "duration": "ExerciseDuration"},
        {"TimezoneOffset": 0},
        "ExerciseEntryID",
        "ObservationEntryDateTime",
    ),
}


# Columns of the raw tables, in order.
CANONICAL = {
    "Patient": [
        "PatientID", "MRSegmentID", "MRSegmentModifiedDateTime", "DiseaseType", "Gender", "ActivationDate",
        "UserTimeZoneOffset", "UserTimeZone", "Description", "YearOfBirth",
    ],
    "ELogExerciseEntry": [
        "ExerciseEntryID", "PatientID", "EntryID", "ExerciseDuration", "ExerciseType", "ExerciseIntensity",
        "TimeSinceExercise", "EntrySourceID", "ActivityTypeID", "ObservationDateTime", "ObservationEntryDateTime",
        "TimezoneOffset", "Timezone", "EntryCreatedDateTime", "ObservationCreatedBy", "ObservationStatus",
        "SourceReferenceID", "ModifiedDateTime", "CaloriesBurned", "DistanceInMeters", "ExternalEntryID",
        "ExternalSourceID",
    ],
    "ELogCarbsEntry": [
        "PatientID", "CarbsEntryID", "EntryID", "CarbsValue", "EntrySourceID", "ActivityTypeID",
        "ObservationDateTime", "ObservationEntryDateTime", "TimezoneOffset", "Timezone", "EntryCreatedDateTime",
        "ObservationCreatedBy", "ObservationStatus", "SourceReferenceID", "ModifiedDateTime", "ExternalSourceID",
        "ExternalEntryID", "TotalCalories",
    ],
    "ElogBGEntry": [
        "BGEntryID", "PatientID", "ObservationDateTime", "BGValue", "IsNormalIndicator", "ObservationEntryDateTime",
        "TimezoneOffset", "Timezone", "EntryCreatedDateTime", "ActualBGValue", "ExternalSourceID",
        "UserObservationDateTime",
    ],
}


def _canonical(df: DataFrame, table: str) -> DataFrame:
    """The raw table's columns in order; those the source lacks are null text."""
    known = {f.name: f.dataType for f in df.schema.fields}
    return conform(df, T.StructType([T.StructField(c, known.get(c, T.StringType())) for c in CANONICAL[table]]))


def canonical_sections(sections: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """XML sections as raw tables.

    The running row id is the row's place by (patient, time), counted range by range, so
    no task sorts the whole table.  Every table has all its columns, in order.
    """
    from caseflow.plans.spread import rank_rows

    out = {}
    for name, df in sections.items():
        if name == "patient_info":
            patient = df.withColumnRenamed("patient_id", "PatientID")
            patient = patient.withColumns({"DiseaseType": F.lit(1), "UserTimeZoneOffset": F.lit(0)})
            out["Patient"] = _canonical(patient, "Patient")
            continue
        table, renames, constants, row_id, copy = SECTIONS[name]
        raw = df.withColumnsRenamed({**renames, "patient_id": "PatientID"})
        raw = raw.withColumns({c: F.lit(v) for c, v in constants.items()})
        raw = raw.withColumn(copy, F.col("ObservationDateTime"))
        order = ["PatientID", "ObservationDateTime"]
        ties = [c for c in renames.values() if c not in order]
        ranked = rank_rows(raw, order + ties, row_id)
        out[table] = _canonical(ranked.withColumn(row_id, F.col(row_id) - 1), table)
    return out
