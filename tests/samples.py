"""Small records with known answers: two systems, nine bands, twenty-one observations."""

from normwatch.schemas import BAND, OBSERVATION, SYSTEM

DAY1, DAY2 = "2025-04-05T12:01:31+02:00", "2025-04-06T12:01:31+02:00"
PREFIXES = {
    "observation": "https://example.org/id/observation/",
    "system": "https://example.org/id/system/",
    "prop": "https://example.org/id/property/",
}


def _limit(prop, value=None, lower=None, upper=None):
    return {"forProperty": prop, "value": value, "minValue": lower, "maxValue": upper}


def _system(number, class_, conductivity, flow, discharge, pressure):
    limits = [
        _limit("prop:conductivity", upper=conductivity),
        _limit("prop:flow", lower=flow),
        _limit("prop:discharge", lower=discharge),
        _limit("prop:pressure", value=pressure),
    ]
    return {
        "_id": f"system:{number}",
        "_type": "ssn:System",
        "type": class_,
        "hasOperatingRange": {"hasOperatingProperty": limits},
    }


# Operating limits, bounds of bands and measured values whose results are known.
SYSTEMS = [
    _system(1, "class:s1", 40.0, 10.0, 70.0, 100.0),
    _system(2, "class:s2", 100.0, 20.0, 50.0, 80.0),
]
_BANDS = [
    (1, "s1", "ph", None, 6.0, None),
    (2, "s1", "ph", 8.5, None, None),
    (3, "s1", "conductivity", 0.0, None, "som"),
    (4, "s1", "flow", None, 0.8, "product"),
    (5, "s1", "discharge", None, 0.9, "product"),
    (6, "s1", "pressure", None, 0.6, "product"),
    (7, "s1", "pressure", 1.4, None, "product"),
    (8, "s2", "ph", 1.0, None, "som"),
    (9, "s3", "pressure", 50.0, None, "som"),
]
BANDS = [
    {
        "id": f"band:{number}",
        "subject": f"class:{class_}",
        "forProperty": f"prop:{prop}",
        "prefLabel": f"label {number}",
        "scopeNote": f"note {number}",
        "dc_type": "outside",
        "minValue": lower,
        "maxValue": upper,
        "operatie": operation,
    }
    for number, class_, prop, lower, upper, operation in _BANDS
]
# (system, band, reference, lower, upper)
ABSOLUTE = {
    ("system:1", "band:1", None, None, 6.0),
    ("system:1", "band:2", None, 8.5, None),
    ("system:1", "band:3", 40.0, 40.0, None),
    ("system:1", "band:4", 10.0, None, 8.0),
    ("system:1", "band:5", 70.0, None, 63.0),
    ("system:1", "band:6", 100.0, None, 60.0),
    ("system:1", "band:7", 100.0, 140.0, None),
    ("system:2", "band:8", None, None, None),
}


def _observation(id_, system, prop, time, number=None, unit=None, status=None):
    return {
        "_id": f"observation:{id_}",
        "_type": "sosa:Observation",
        "hasFeatureOfInterest": f"system:{system}",
        "observedProperty": f"prop:{prop}",
        "result": {
            "_type": "sosa:Result",
            "eenheid": unit,
            "kwalitatieve_waarde": status,
            "numerieke_waarde": number,
        },
        "resultTime": time,
    }


def _day(time, ph, pressure, conductivity, discharge, flow):
    return [
        _observation(24, 1, "ph", time, ph, "unit:PH"),
        _observation(13, 1, "pressure", time, pressure, "unit:PA"),
        _observation(14, 1, "conductivity", time, conductivity, "unit:MilliS-PER-CentiM"),
        _observation(15, 1, "discharge", time, discharge, "unit:M3"),
        _observation(21, 1, "flow", time, flow, "unit:M3-PER-HR"),
        _observation(16, 1, "occupation", time, status="status:empty"),
        _observation(18, 1, "status", time, status="status:running"),
    ]


OBSERVATIONS = [
    *_day(DAY1, 3.7, 359.0, 50.0, 60.0, 7.0),
    *_day(DAY2, 4.0, 340.0, 44.0, 40.0, 2.0),
    _observation(17, 2, "occupation", DAY1, status="status:used"),
    _observation(19, 2, "status", DAY1, status="status:failure"),
    _observation(20, 99, "status", DAY1, status="status:service"),
    _observation(11, 99, "rinse", DAY1, 359.0, "unit:M3"),
    _observation(12, 99, "drain", DAY1, 359.0, "unit:M3"),
    _observation(22, 99, "irrigation", DAY1, 359.0, "unit:M3-PER-HR"),
    _observation(23, 99, "moistening", DAY1, 359.0, "unit:M3-PER-HR"),
]
# (time, band, value)
ALARMS = {
    (DAY1, "band:1", 3.7),
    (DAY1, "band:3", 50.0),
    (DAY1, "band:4", 7.0),
    (DAY1, "band:5", 60.0),
    (DAY1, "band:7", 359.0),
    (DAY2, "band:1", 4.0),
    (DAY2, "band:3", 44.0),
    (DAY2, "band:4", 2.0),
    (DAY2, "band:5", 40.0),
    (DAY2, "band:7", 340.0),
}


def systems(spark):
    return spark.createDataFrame(SYSTEMS, SYSTEM)


def bands(spark):
    return spark.createDataFrame(BANDS, BAND)


def observations(spark):
    return spark.createDataFrame(OBSERVATIONS, OBSERVATION)
