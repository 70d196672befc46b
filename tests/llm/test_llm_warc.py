import random
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from normwatch.llm import warc

START = datetime(2024, 1, 1, tzinfo=timezone.utc)
SCHEMA = (
    "record_id long, warc_type string, target_uri string, warc_date timestamp, http_status int, "
    "http_headers map<string,string>, payload string"
)


def make(seed, n):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        kind = rng.choice(["response", "revisit", "revisit", "request"])
        # A third of the records are of one URL.
        url = "http://Hot.example/" if rng.random() < 0.34 else f"https://www.x{rng.randrange(4)}.example/p#{i}"
        url = None if rng.random() < 0.03 else url
        at = None if rng.random() < 0.03 else START + timedelta(minutes=rng.randrange(300))
        headers = {"cache-control": f"c{i}", "content-type": f"t{i}"}
        if rng.random() < 0.6:
            headers["etag"] = rng.choice(["", "W/"]) + rng.choice(['"a"', '"b"'])
        if rng.random() < 0.5:
            headers["last-modified"] = rng.choice(["d1", "d2"])
        if rng.random() < 0.05:
            headers = None
        status = rng.choice([200, 200, 200, 404]) if kind == "response" else 304
        payload = rng.choice([None, "", f"body {i}"]) if kind == "response" else None
        rows.append((i, kind, url, at, status, headers, payload))
    return rows


def plain_url(url):
    return None if url is None else url.split("#")[0].split("//")[1].lower().removeprefix("www.").rstrip("/")


def brute_force(rows):
    full = [r for r in rows if r[1] == "response" and r[4] == 200 and r[6] is not None and r[2] and r[3]]
    out = {}
    for r in rows:
        if r[1] != "revisit":
            continue
        past = [f for f in full if r[2] and r[3] and plain_url(f[2]) == plain_url(r[2]) and f[3] < r[3]]
        if not past:
            out[r[0]] = ("no_response", None, r[5], None)
            continue
        old = max(past, key=lambda f: (f[3], f[0]))
        a, b = r[5] or {}, old[5] or {}
        if "etag" in a and "etag" in b:
            same = a["etag"].removeprefix("W/") == b["etag"].removeprefix("W/")
        elif "last-modified" in a and "last-modified" in b:
            same = a["last-modified"] == b["last-modified"]
        else:
            out[r[0]] = ("no_validator", old[0], r[5], None)
            continue
        if not same:
            out[r[0]] = ("validator_mismatch", old[0], r[5], None)
        else:
            merged = b | {k: v for k, v in a.items() if k in warc.PERMITTED}
            out[r[0]] = ("resolved", old[0], merged, old[6])
    return out


@pytest.mark.parametrize("block", [600, 86_400])
def test_revisits_equal_brute_force(spark, block):
    rows = make(block, 400)
    df = spark.createDataFrame(rows, SCHEMA).withColumn("block", F.lit("own")).repartition(4)
    got = warc.resolve_revisits(df, block).collect()
    found = {r["record_id"]: (r["status"], r["response_id"], r["http_headers"], r["payload"]) for r in got}
    want = brute_force(rows)
    assert len(got) == len(found) == len(want)
    assert found == want
    assert {s for s, *_ in want.values()} == {"resolved", "no_response", "no_validator", "validator_mismatch"}


def test_repeated_and_no_records(spark):
    rows = [
        (1, "response", "http://a/x", START, 200, {"etag": "1"}, "short"),
        (1, "response", "http://a/x", START, 200, {"etag": "1"}, "much longer"),
        (2, "revisit", "https://a/x/", START + timedelta(days=3), 304, {"etag": "1"}, None),
        (2, "revisit", "https://a/x/", START + timedelta(days=3), 304, {"etag": "1"}, None),
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    got = warc.resolve_revisits(df).collect()
    assert [(r["record_id"], r["response_id"], r["payload"]) for r in got] == [(2, 1, "short")] * 2
    assert warc.resolve_revisits(df.where("false")).count() == 0


@pytest.mark.parametrize(
    "url, want",
    [
        ("HTTP://WWW.Example.org:80/A/?utm_source=f&b=1#top", "example.org/A/?b=1"),
        ("https://m.example.org/a/?ref=x", "m.example.org/a"),
        ("https://example.org:443?page=2&ref=x", "example.org?page=2"),
        ("example.org/", "example.org"),
        ("", ""),
    ],
)
def test_canonical_urls(spark, url, want):
    row = spark.range(1).select(warc.canonical_url(F.lit(url))).first()
    assert row[0] == want
