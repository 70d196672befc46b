"""Alarms: observations whose value lies inside an abnormal band."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from normwatch.functions import alarm_key, date_as_written, now_or
from normwatch.operators.band_index import indexed_matches
from normwatch.operators.joins import spread_join

# The names of the columns of reports and alarms, here and below, are the format that
# readers of the files expect.
VALUE = "result.numerieke_waarde"


def _key(band: str) -> Column:
    return alarm_key(F.col("_id"), F.col("resultTime"), F.col(band), F.col("operating_no"))


def inside_band(value: Column, lower: Column, upper: Column) -> Column:
    """Strictly between the bounds; a NULL bound is open."""
    return (lower.isNull() | (value > lower)) & (upper.isNull() | (value < upper))


def match_bands(
    observations: DataFrame,
    bands: DataFrame,
    bands_bytes: int | None = None,
    many: int | None = None,
) -> DataFrame:
    """Observations joined to every absolute band of their system and property they lie in.

    An observation in several bands gives several rows.  A band open on both sides matches every
    observation, also one without a number.  ``bands_bytes`` is an upper bound of the size of the
    bands, if there is one; within the bound for broadcasts the observations are not shuffled.
    With ``many``, bands of a system and property that has so many of them are found by an index
    (see :mod:`normwatch.operators.band_index`) instead of being compared one by one.
    """
    on = [("hasFeatureOfInterest", "lzsid"), ("observedProperty", "parameter")]
    if many is not None:
        return indexed_matches(observations, bands, on, F.col(VALUE), many)
    in_band = inside_band(F.col(VALUE), F.col("minValue"), F.col("maxValue"))
    return spread_join(observations, bands, on, where=in_band, right_bytes=bands_bytes)


def alarm_report(
    observations: DataFrame,
    bands: DataFrame,
    as_of: str | None = None,
    bands_bytes: int | None = None,
    many: int | None = None,
) -> DataFrame:
    """One flat row per alarm: measured value, reference value and bounds.

    ``bands_bytes`` and ``many`` are those of :func:`match_bands`.
    """
    wanted = bands.select(
        "lzsid",
        "bbid",
        "parameter",
        "operating_no",
        "referentiewaarde",
        "scopeNote",
        "minValue",
        "maxValue",
    )
    matched = match_bands(observations, wanted, bands_bytes, many)
    return matched.select(
        _key("bbid").alias("_id"),
        "hasFeatureOfInterest",
        "observedProperty",
        now_or(as_of).cast("date").alias("resultTime"),
        F.col("resultTime").alias("phenomenonTime"),
        F.col(VALUE).alias("gemetenwaarde"),
        "referentiewaarde",
        F.col("scopeNote").alias("bandbreedte"),
        "minValue",
        "maxValue",
        date_as_written(F.col("resultTime")).alias("datum"),
    )


def alarm_report_nested(
    observations: DataFrame,
    bands: DataFrame,
    as_of: str | None = None,
    bands_bytes: int | None = None,
) -> DataFrame:
    """The flat report on bands of :func:`resolve_bands_nested`, whose ids hash all their fields."""
    matched = match_bands(observations, bands, bands_bytes)
    return matched.select(
        F.concat(F.lit("observation:"), _key("bbid")).alias("_id"),
        F.lit("sosa:Observation").alias("_type"),
        "hasFeatureOfInterest",
        "observedProperty",
        now_or(as_of).cast("date").alias("resultTime"),
        F.col("resultTime").alias("phenomenonTime"),
        F.col("type").alias("alarmtype"),
        "label",
        F.col(VALUE).alias("gemetenwaarde"),
        "referentiewaarde",
        F.col("minValue").alias("minValueNormBandbreedte"),
        F.col("maxValue").alias("maxValueNormBandbreedte"),
    )


def alarm_observations(
    observations: DataFrame,
    bands: DataFrame,
    shape: str = "compact",
    id_mode: str = "hash",
    as_of: str | None = None,
    bands_bytes: int | None = None,
) -> DataFrame:
    """Alarms as derived observations with provenance, one per observation and band.

    ``shape="extended"`` adds the dimensions of the observation to the result.  ``id_mode="uuid"``
    gives random ids; they and the clock change on every evaluation, so write such a result once
    or cache it.  The default ids repeat.
    """
    if shape not in ("compact", "extended") or id_mode not in ("hash", "uuid"):
        raise ValueError("shape is compact or extended, id_mode is hash or uuid")
    wanted = bands.select(
        "lzsid", "bbid", "parameter", "operating_no", "type", "scopeNote", "minValue", "maxValue"
    )
    matched = match_bands(observations, wanted, bands_bytes)

    def name(prefix: str) -> Column:
        return F.concat(F.lit(prefix), F.uuid() if id_mode == "uuid" else _key("bbid"))

    kind = F.lit("sosa:Result")
    dimensions = []
    if shape == "extended":
        kind = F.array(kind, F.lit("qb:Observation"))
        dimensions = [
            F.col("observedProperty").alias("parameterDimensie"),
            F.col("hasFeatureOfInterest").alias("lzsDimensie"),
            F.col("resultTime").alias("refPeriod"),
        ]
    result = F.struct(
        name("result:").alias("_id"),
        kind.alias("_type"),
        F.col("bbid").alias("value"),
        F.col("type").alias("label"),
        *dimensions,
        F.col(VALUE).alias("parametervalue"),
        F.col("result.eenheid").alias("parameterunit"),
        F.col("scopeNote").alias("scopenote"),
    )
    return matched.select(
        name("observation:").alias("_id"),
        F.lit("sosa:Observation").alias("_type"),
        "hasFeatureOfInterest",
        "observedProperty",
        now_or(as_of).alias("resultTime"),
        F.col("resultTime").alias("phenomenonTime"),
        F.col("_id").alias("wasInformedBy"),
        result.alias("result"),
        date_as_written(F.col("resultTime")).alias("datum"),
    )
