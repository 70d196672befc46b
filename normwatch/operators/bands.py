"""Norm bands: relative bands of a class of systems resolved to absolute bands per system.

A band is a range of *abnormal* values.  ``operatie`` says how it is expressed:

* NULL: the bounds are absolute;
* ``som``: the bounds are added to the operating limits of the system;
* ``product``: the bounds multiply them.

The lower bound anchors on the operating maximum, the upper bound on the operating minimum, and
each falls back to the operating value and to nothing else.  A bound that cannot be resolved stays
NULL, which reads as unbounded.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from normwatch.functions import record_key
from normwatch.operators.joins import spread_join


def absolute_bound(
    operation: Column, anchor: Column, fallback: Column, relative: Column, unknown_op: str = "null"
) -> Column:
    """One bound of a band, given the operating limit it is relative to."""
    added = F.coalesce(anchor + relative, fallback + relative)
    scaled = F.coalesce(anchor * relative, fallback * relative)
    bound = F.when(operation == "som", added).when(operation == "product", scaled)
    if unknown_op == "absolute":
        return bound.otherwise(relative)
    return bound.when(operation.isNull(), relative)


def reference_value(operating: str) -> Column:
    """First known of value, minimum and maximum of an operating property."""
    return F.coalesce(*[F.col(f"{operating}.{part}") for part in ("value", "minValue", "maxValue")])


def operating_properties(systems: DataFrame) -> DataFrame:
    """One row per system and operating property, with its place in the list (``operating_no``);
    systems without any have no row."""
    each = F.posexplode("hasOperatingRange.hasOperatingProperty").alias("operating_no", "operating")
    return systems.select(F.col("_id").alias("operating_of"), each)


def bands_of_systems(systems: DataFrame, bands: DataFrame) -> DataFrame:
    """Each system with each band of its class."""
    own = systems.select(
        F.col("_id").alias("lzsid"),
        F.col("type").alias("system_class"),
        F.col("hasOperatingRange.hasOperatingProperty").alias("operating_list"),
    )
    wanted = bands.select(
        F.col("subject").alias("band_class"),
        F.col("id").alias("bbid"),
        F.col("forProperty").alias("parameter"),
        F.col("minValue").alias("minValueNormBandbreedte"),
        F.col("maxValue").alias("maxValueNormBandbreedte"),
        F.col("operatie"),
        F.col("dc_type").alias("type"),
        F.col("prefLabel").alias("label"),
        F.col("scopeNote"),
    )
    return spread_join(own, wanted, [("system_class", "band_class")])


def with_operating_property(
    banded: DataFrame, systems: DataFrame, unique_ids: bool = False
) -> DataFrame:
    """Add the operating property of the band's parameter, NULL where the system has none.

    Several operating properties for one parameter give several rows.  With ``unique_ids`` the
    caller states that ``_id`` is a key of the systems: the properties then travel with the system
    and no second join is needed.
    """
    if unique_ids:
        numbered = F.transform(
            "operating_list", lambda op, i: F.struct(i.alias("operating_no"), op.alias("operating"))
        )
        same = F.filter(numbered, lambda n: n["operating"]["forProperty"] == F.col("parameter"))
        kept = [c for c in banded.columns if c != "operating_list"]
        found = banded.select(*kept, F.explode_outer(same).alias("found"))
        return found.select(*kept, "found.operating_no", "found.operating")
    lookup = operating_properties(systems).select(
        "operating_of",
        F.col("operating.forProperty").alias("operating_for"),
        "operating_no",
        "operating",
    )
    on = [("lzsid", "operating_of"), ("parameter", "operating_for")]
    joined = spread_join(banded.drop("operating_list"), lookup, on, how="left")
    return joined.drop("operating_of", "operating_for")


def resolve_bands(
    systems: DataFrame,
    bands: DataFrame,
    unresolved: str = "alarm",
    unknown_op: str = "null",
    unique_ids: bool = False,
) -> DataFrame:
    """Absolute bands per system.

    ``unresolved="alarm"`` keeps bands with a bound that could not be resolved (they are open on
    that side); ``"skip"`` drops them.  ``unknown_op="absolute"`` takes the bounds of an unknown
    operation as they are instead of leaving them NULL.
    """
    if unresolved not in ("alarm", "skip") or unknown_op not in ("null", "absolute"):
        raise ValueError("unresolved is alarm or skip, unknown_op is null or absolute")
    joined = with_operating_property(bands_of_systems(systems, bands), systems, unique_ids)
    lower, upper = F.col("minValueNormBandbreedte"), F.col("maxValueNormBandbreedte")
    value = F.col("operating.value")
    absolute = joined.select(
        "lzsid",
        "bbid",
        "parameter",
        "operating_no",
        reference_value("operating").alias("referentiewaarde"),
        "minValueNormBandbreedte",
        "maxValueNormBandbreedte",
        "operatie",
        "type",
        "label",
        "scopeNote",
        absolute_bound(
            F.col("operatie"), F.col("operating.maxValue"), value, lower, unknown_op
        ).alias("minValue"),
        absolute_bound(
            F.col("operatie"), F.col("operating.minValue"), value, upper, unknown_op
        ).alias("maxValue"),
    )
    if unresolved == "skip":
        open_below = lower.isNotNull() & F.col("minValue").isNull()
        open_above = upper.isNotNull() & F.col("maxValue").isNull()
        absolute = absolute.where(~(open_below | open_above))
    return absolute


def flat_bands(norms: DataFrame) -> DataFrame:
    """Norms with a nested list of bands as one row per band; the id hashes all its fields."""
    each = norms.select("klasse", "parameter", F.explode("bandbreedtes").alias("band"))
    key = record_key("klasse", "parameter", F.col("band"))
    return each.select(
        key.alias("id"),
        F.col("klasse").alias("subject"),
        F.col("parameter").alias("forProperty"),
        F.col("band.label").alias("prefLabel"),
        F.col("band.note").alias("scopeNote"),
        F.col("band.type").alias("dc_type"),
        F.col("band.minValue").alias("minValue"),
        F.col("band.maxValue").alias("maxValue"),
        F.col("band.operatie").alias("operatie"),
    )


def resolve_bands_nested(systems: DataFrame, norms: DataFrame, **options) -> DataFrame:
    """``resolve_bands`` for systems with ``parameterconditie`` and norms with ``bandbreedtes``."""
    conditions = F.transform(
        "parameterconditie",
        lambda c: F.struct(
            c["parameter"].alias("forProperty"),
            c["value"].alias("value"),
            c["minValue"].alias("minValue"),
            c["maxValue"].alias("maxValue"),
        ),
    )
    same_shape = systems.select(
        "_id", "type", F.struct(conditions.alias("hasOperatingProperty")).alias("hasOperatingRange")
    )
    return resolve_bands(same_shape, flat_bands(norms), **options).select(
        "lzsid",
        "bbid",
        "parameter",
        "operating_no",
        "referentiewaarde",
        F.col("minValueNormBandbreedte").alias("relatieveMinValueNormBandbreedte"),
        F.col("maxValueNormBandbreedte").alias("relatieveMaxValueNormBandbreedte"),
        "operatie",
        "label",
        "type",
        F.col("scopeNote").alias("note"),
        "minValue",
        "maxValue",
    )
