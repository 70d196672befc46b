"""Random systems, bands and observations against the definition, row by row."""

import random
from collections import Counter

import pytest

from normwatch import schemas
from normwatch.operators.alarms import match_bands
from normwatch.operators.bands import resolve_bands

PROPERTIES = ["a", "b", "c", "d"]


def sample(seed):
    rng = random.Random(seed)

    def number(chance=0.6):
        return float(rng.randrange(-20, 60)) / 2 if rng.random() < chance else None

    systems = [
        {
            "_id": f"s{i}",
            # A third of the systems are of one class; some have none.
            "type": rng.choice(["hot", "k1", "k2", "k3", None]) if i % 3 else "hot",
            "hasOperatingRange": None
            if rng.random() < 0.1
            else {
                "hasOperatingProperty": [
                    {
                        "forProperty": rng.choice([*PROPERTIES, None]),
                        "value": number(),
                        "minValue": number(),
                        "maxValue": number(),
                    }
                    for _ in range(rng.randrange(5))
                ]
            },
        }
        for i in range(25)
    ]
    bands = [
        {
            "id": f"b{i}",
            "subject": rng.choice(["hot", "k1", "k2", "none", None]),
            "forProperty": rng.choice([*PROPERTIES, None]),
            "minValue": number(),
            "maxValue": number(),
            "operatie": rng.choice([None, "som", "product", "macht"]),
        }
        for i in range(25)
    ]
    observations = [
        {
            "_id": f"o{i}",
            "hasFeatureOfInterest": rng.choice(["s0", f"s{rng.randrange(28)}", None]),
            "observedProperty": rng.choice([*PROPERTIES, "unnormed", None]),
            "result": {"numerieke_waarde": number(0.9)} if rng.random() < 0.95 else None,
            "resultTime": "2025-01-01T00:00:00Z",
        }
        for i in range(300)
    ]
    return systems, bands, observations


def first(*values):
    return next((v for v in values if v is not None), None)


def absolute(operation, anchor, value, relative):
    if operation is None:
        return relative
    if operation not in ("som", "product") or relative is None:
        return None
    base = first(anchor, value)
    if base is None:
        return None
    return base + relative if operation == "som" else base * relative


def resolved(systems, bands):
    for s in systems:
        limits = (s["hasOperatingRange"] or {}).get("hasOperatingProperty", [])
        for b in bands:
            if b["subject"] is None or b["subject"] != s["type"]:
                continue
            own = [
                p for p in limits
                if b["forProperty"] is not None and p["forProperty"] == b["forProperty"]
            ]
            for p in own or [{"value": None, "minValue": None, "maxValue": None}]:
                reference = first(p["value"], p["minValue"], p["maxValue"])
                lower = absolute(b["operatie"], p["maxValue"], p["value"], b["minValue"])
                upper = absolute(b["operatie"], p["minValue"], p["value"], b["maxValue"])
                yield s["_id"], b["id"], b["forProperty"], reference, lower, upper


def matched(observations, limits):
    for o in observations:
        value = (o["result"] or {}).get("numerieke_waarde")
        for system, band, prop, _, lower, upper in limits:
            if None in (o["hasFeatureOfInterest"], o["observedProperty"]):
                continue
            if (o["hasFeatureOfInterest"], o["observedProperty"]) != (system, prop):
                continue
            above = lower is None or (value is not None and value > lower)
            below = upper is None or (value is not None and value < upper)
            if above and below:
                yield o["_id"], band, lower, upper


@pytest.mark.parametrize("seed,broadcast", [(1, None), (2, None), (3, 0), (4, 0), (5, 700)])
def test_bands_and_matches(spark, monkeypatch, seed, broadcast):
    from normwatch.operators import joins

    if broadcast is not None:
        monkeypatch.setattr(joins, "BROADCAST_BYTES", broadcast)
        monkeypatch.setattr(joins, "HOT_KEY_ROWS", 10)
    systems, bands, observations = sample(seed)
    limits = list(resolved(systems, bands))
    bands_df = spark.createDataFrame(bands, schemas.BAND)
    systems_df = spark.createDataFrame(systems, schemas.SYSTEM)
    observations_df = spark.createDataFrame(observations, schemas.OBSERVATION)
    for unique in (True, False):
        got = resolve_bands(systems_df, bands_df, unique_ids=unique)
        rows = got.select("lzsid", "bbid", "parameter", "referentiewaarde", "minValue", "maxValue")
        assert Counter(map(tuple, rows.collect())) == Counter(limits)
    alarms = match_bands(observations_df, got)
    rows = alarms.select("_id", "bbid", "minValue", "maxValue").collect()
    assert Counter(map(tuple, rows)) == Counter(matched(observations, limits))
