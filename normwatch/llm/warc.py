"""Not-modified revisits of web archives: find the response that each one stands for.

A revisit record holds no body.  It is resolved to the latest earlier full response of the same
canonical URL (an as-of join), if their validators agree; the permitted headers of the revisit
then replace those of the response, whose body is taken over.

The as-of join works on narrow rows.  Time is cut into blocks, so a URL that is captured very often
is spread over many tasks: rows look back within their block, and only what finds nothing there
looks up the last response of the earlier blocks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from normwatch.llm.common import stored, table

BLOCK_SECONDS = 86_400
# Header fields that a 304 response may send for the stored one (RFC 9110, 15.4.5).
PERMITTED = ("cache-control", "content-location", "date", "etag", "expires", "vary")
RESOLVED, NO_RESPONSE, MISMATCH, UNCHECKED = (
    "resolved",
    "no_response",
    "validator_mismatch",
    "no_validator",
)


def canonical_url(url: Column) -> Column:
    """Scheme, ``www.``, default ports, fragment, tracking parameters and a last slash removed;
    host in lower case.  A null URL stays null."""
    plain = F.regexp_replace(F.trim(url), "#.*$", "")
    plain = F.regexp_replace(plain, "^[A-Za-z][A-Za-z0-9+.-]*://", "")
    host = F.regexp_replace(F.lower(F.regexp_extract(plain, "^[^/?]*", 0)), "^www[.]", "")
    host = F.regexp_replace(host, ":(80|443)$", "")
    rest = F.regexp_replace(plain, "^[^/?]*", "")
    rest = F.regexp_replace(rest, "([?&])(utm_[a-z]+|ref)=[^&]*", "$1")
    rest = F.regexp_replace(F.regexp_replace(rest, "&+", "&"), "[?]&", "?")
    rest = F.regexp_replace(F.regexp_replace(rest, "[?&]+$", ""), "/$", "")
    return F.concat(host, rest)


def _weak(tag: Column) -> Column:
    return F.regexp_replace(tag, "^W/", "")


def resolve_revisits(records: DataFrame, block_seconds: int = BLOCK_SECONDS) -> DataFrame:
    """One row per revisit of ``records``.

    Columns read: record_id, warc_type, target_uri, warc_date (timestamp), http_status,
    http_headers (map, names in lower case) and payload.  Columns returned: record_id,
    canonical_url, warc_date, status, response_id, http_headers, payload.

    A full response has type ``response``, status 200 and a payload that is not null (it may be
    empty).  Earlier means strictly earlier; of responses at the same moment the largest record_id
    counts.  ETags decide where both have one (weak comparison), else Last-Modified; without a
    common validator the status is ``no_validator``.  What is not resolved has null payload and its
    own headers.  A null URL, date or record_id has no response.  A record_id that full responses
    repeat is taken once, with its largest payload.
    """
    seconds = F.unix_micros(F.col("warc_date").cast("timestamp"))
    headers = F.col("http_headers")
    full = (F.col("warc_type") == "response") & (F.col("http_status") == 200)
    for needed in ("payload", "record_id", "warc_date", "target_uri"):
        full = full & F.col(needed).isNotNull()
    full = F.coalesce(full, F.lit(False))
    base = records.select(
        "record_id",
        "warc_type",
        "warc_date",
        "http_headers",
        canonical_url(F.col("target_uri")).alias("canonical_url"),
        seconds.alias("at"),
        F.floor(seconds / (block_seconds * 1_000_000)).cast("long").alias("block"),
        full.alias("full"),
        F.try_element_at(headers, F.lit("etag")).alias("etag"),
        F.try_element_at(headers, F.lit("last-modified")).alias("modified"),
    ).where((F.col("warc_type") == "revisit") | F.col("full"))
    found = F.when(F.col("full"), F.struct("at", "record_id", "etag", "modified"))
    base = base.withColumn("response", found)
    revisits = F.col("warc_type") == "revisit"
    near = base.withColumn(
        "here",
        F.expr(
            "max(response) over (partition by canonical_url, block order by at"
            " range between unbounded preceding and 1 preceding)"
        ),
    ).where(revisits & F.col("canonical_url").isNotNull() & F.col("at").isNotNull())
    last = base.groupBy("canonical_url", "block").agg(F.max("response").alias("response"))
    before = last.select(
        F.col("canonical_url").alias("b_url"),
        F.col("block").alias("b_block"),
        F.expr(
            "max(response) over (partition by canonical_url order by block"
            " rows between unbounded preceding and 1 preceding)"
        ).alias("earlier"),
    )
    joined = near.join(
        before,
        (F.col("canonical_url") == F.col("b_url")) & (F.col("block") == F.col("b_block")),
        "left",
    ).withColumn("response", F.coalesce("here", "earlier"))
    kept = ["record_id", "canonical_url", "warc_date", "http_headers"]
    lost = base.where(revisits & (F.col("canonical_url").isNull() | F.col("at").isNull()))
    joined = joined.select(*kept, "etag", "modified", "response").unionByName(
        lost.select(*kept, "etag", "modified", "response")
    )
    old, new = F.col("response"), F.col
    both_tags = new("etag").isNotNull() & old["etag"].isNotNull()
    both_dates = new("modified").isNotNull() & old["modified"].isNotNull()
    agree = F.when(both_tags, _weak(new("etag")) == _weak(old["etag"])).when(
        both_dates, new("modified") == old["modified"]
    )
    status = (
        F.when(old.isNull(), NO_RESPONSE)
        .when(agree.isNull(), UNCHECKED)
        .when(agree, RESOLVED)
        .otherwise(MISMATCH)
    )
    judged = joined.select(*kept, status.alias("status"), old["record_id"].alias("response_id"))
    bodies = (
        records.where(full)
        .select(F.col("record_id").alias("body_id"), F.col("http_headers").alias("old_headers"), "payload")
        .groupBy("body_id")
        .agg(F.max_by(F.struct("old_headers", "payload"), "payload").alias("body"))
    )
    # Only resolved revisits look for a body: the others would all meet without a key.
    judged = stored(judged, "judged")
    resolved = judged.where(F.col("status") == RESOLVED)
    merged = resolved.join(bodies, F.col("response_id") == F.col("body_id"), "left")
    permitted = F.map_filter("http_headers", lambda k, v: k.isin(*PERMITTED))
    untouched = F.map_filter(
        F.coalesce(F.col("body.old_headers"), F.expr("cast(map() as map<string,string>)")),
        lambda k, v: ~F.map_contains_key(permitted, k),
    )
    told = ["record_id", "canonical_url", "warc_date", "status", "response_id"]
    kind = records.schema["payload"].dataType
    found = merged.select(
        *told,
        F.map_concat(untouched, permitted).alias("http_headers"),
        F.col("body.payload").alias("payload"),
    )
    others = judged.where(F.col("status") != RESOLVED)
    return found.unionByName(others.select(*told, "http_headers", F.lit(None).cast(kind).alias("payload")))


def records_of_pages(pages: DataFrame) -> DataFrame:
    """An archive derived from ``pages``: a response and a not-modified revisit for every page.

    Validators, status and times follow from page_id and the page itself, so that all outcomes
    occur: matching and changed ETags, dates only, no validator, errors, and revisits that come
    before the first response.
    """
    n = F.col("page_id")
    tag = F.concat(F.lit('"'), F.substring(F.md5(F.col("html").cast("binary")), 1, 16), F.lit('"'))
    has_tag, has_date = n % 5 != 0, n % 3 != 0
    modified = F.concat(F.lit("day "), (n % 28).cast("string"))

    def fields(*pairs: tuple[str, Column]) -> Column:
        entries = F.array(*[F.struct(F.lit(k).alias("k"), v.alias("v")) for k, v in pairs])
        return F.map_from_entries(F.filter(entries, lambda e: e["v"].isNotNull()))

    def moment(seconds: Column) -> Column:
        return F.timestamp_seconds(F.lit(1_700_000_000) + seconds)

    responses = pages.select(
        (n * 2).alias("record_id"),
        F.lit("response").alias("warc_type"),
        F.col("url").alias("target_uri"),
        moment(n * 60).alias("warc_date"),
        F.when(n % 13 == 0, 404).otherwise(200).alias("http_status"),
        fields(
            ("etag", F.when(has_tag, tag)),
            ("last-modified", F.when(has_date, modified)),
            ("content-type", F.lit("text/html")),
            ("cache-control", F.lit("max-age=60")),
        ).alias("http_headers"),
        F.col("html").alias("payload"),
    )
    revisits = pages.select(
        (n * 2 + 1).alias("record_id"),
        F.lit("revisit").alias("warc_type"),
        F.col("url").alias("target_uri"),
        moment(n * 60 + (n % 97 - 8) * 3600).alias("warc_date"),
        F.lit(304).alias("http_status"),
        fields(
            ("etag", F.when(has_tag & (n % 7 == 0), F.lit('"changed"')).when(has_tag, F.concat(F.lit("W/"), tag))),
            ("last-modified", F.when(has_date, modified)),
            ("content-type", F.lit("text/plain")),
            ("cache-control", F.lit("max-age=120")),
            ("vary", F.lit("accept")),
        ).alias("http_headers"),
        F.lit(None).cast("string").alias("payload"),
    )
    return responses.unionByName(revisits)


def op8_warc_revisits(spark, sf_dir: str) -> DataFrame:
    """The revisits of all ``pages``, with digests of headers and bodies."""
    resolved = resolve_revisits(records_of_pages(table(spark, sf_dir, "pages")))
    entries = F.transform(
        F.map_entries("http_headers"), lambda e: F.concat(e["key"], F.lit("="), e["value"])
    )
    return resolved.select(
        "record_id",
        "canonical_url",
        F.unix_seconds("warc_date").alias("captured"),
        "status",
        "response_id",
        F.array_join(F.array_sort(entries), ";").alias("headers"),
        F.sha2(F.col("payload").cast("binary"), 256).alias("payload_sha256"),
    )


OP8_SQL = r"""
WITH plain AS (
  SELECT page_id AS n, html,
         regexp_replace(regexp_replace(trim(url), '#.*$', ''), '^[A-Za-z][A-Za-z0-9+.-]*://', '') AS p
  FROM pages
), cut AS (
  SELECT n, html,
         regexp_replace(regexp_replace(lower(regexp_extract(p, '^[^/?]*')), '^www[.]', ''),
                        ':(80|443)$', '') AS host,
         regexp_replace(regexp_replace(p, '^[^/?]*', ''),
                        '([?&])(utm_[a-z]+|ref)=[^&]*', '\1', 'g') AS rest
  FROM plain
), base AS (
  SELECT n, html,
         host || regexp_replace(regexp_replace(regexp_replace(regexp_replace(
           rest, '&+', '&', 'g'), '[?]&', '?', 'g'), '[?&]+$', ''), '/$', '') AS canonical_url,
         CASE WHEN n % 5 <> 0 THEN '"' || substr(md5(html), 1, 16) || '"' END AS tag,
         CASE WHEN n % 3 <> 0 THEN 'day ' || (n % 28) END AS modified
  FROM cut
), responses AS (
  SELECT canonical_url, 1700000000 + n * 60 AS secs, max(n) AS n
  FROM base WHERE n % 13 <> 0 AND html IS NOT NULL GROUP BY ALL
), revisits AS (
  SELECT *, 1700000000 + n * 60 + (n % 97 - 8) * 3600 AS secs,
         CASE WHEN tag IS NOT NULL AND n % 7 = 0 THEN '"changed"' ELSE tag END AS new_tag
  FROM base
), joined AS (
  SELECT v.*, r.n AS rn, o.tag AS old_tag, o.modified AS old_modified, o.html AS body
  FROM revisits v ASOF LEFT JOIN responses r ON v.canonical_url = r.canonical_url AND v.secs > r.secs
  LEFT JOIN base o ON o.n = r.n
), judged AS (
  SELECT *, CASE
    WHEN rn IS NULL THEN 'no_response'
    WHEN new_tag IS NOT NULL AND old_tag IS NOT NULL
      THEN CASE WHEN new_tag = old_tag THEN 'resolved' ELSE 'validator_mismatch' END
    WHEN modified IS NOT NULL AND old_modified IS NOT NULL
      THEN CASE WHEN modified = old_modified THEN 'resolved' ELSE 'validator_mismatch' END
    ELSE 'no_validator' END AS status
  FROM joined
)
SELECT n * 2 + 1 AS record_id, canonical_url, secs AS captured, status, rn * 2 AS response_id,
       concat_ws(';', 'cache-control=max-age=120',
         CASE WHEN status = 'resolved' THEN 'content-type=text/html' ELSE 'content-type=text/plain' END,
         'etag=' || coalesce(CASE WHEN new_tag = '"changed"' THEN new_tag ELSE 'W/' || new_tag END,
                             CASE WHEN status = 'resolved' THEN old_tag END),
         'last-modified=' || CASE WHEN status = 'resolved' THEN old_modified ELSE modified END,
         'vary=accept') AS headers,
       CASE WHEN status = 'resolved' THEN sha256(body) END AS payload_sha256
FROM judged
"""
