"""The same questions as plain SQL over the given tables."""

from __future__ import annotations

from normwatch.plans import testviews as tv


def _value(value) -> str:
    if value is None:
        return "NULL"
    return f"'{value}'" if isinstance(value, str) else repr(value)


def _values(rows: list[tuple]) -> str:
    return ", ".join("(" + ", ".join(_value(v) for v in row) + ")" for row in rows)


OBS = """
obs AS (
  SELECT 'observation:' || event_id AS id,
         'system:' || user_id AS foi,
         'prop:' || event_type AS prop,
         CASE event_type WHEN 'click' THEN 'unit:PH' WHEN 'view' THEN 'unit:PA'
                         WHEN 'signup' THEN NULL ELSE 'unit:M3' END AS unit,
         CASE WHEN event_type = 'signup' THEN 'status:' || (user_id % 3) END AS status,
         CASE WHEN event_type <> 'signup' THEN value END AS num,
         strftime(ts, '%Y-%m-%dT%H:%M:%S.%f')
           || CASE event_id % 3 WHEN 0 THEN 'Z' WHEN 1 THEN '+02:00' ELSE '-05:00' END AS t,
         CAST(ts AS DATE) AS datum,
         epoch_us(ts) - CASE event_id % 3 WHEN 1 THEN 7200 WHEN 2 THEN -18000 ELSE 0 END::BIGINT
           * 1000000 AS micros,
         CAST(user_id AS DOUBLE) AS ceiling
  FROM events)"""


def _bands(rows: list[tuple]) -> str:
    return f"""
bands AS (
  SELECT id, class, 'prop:' || property AS prop,
         CAST(lo AS DOUBLE) AS lo, CAST(hi AS DOUBLE) AS hi, CAST(op AS VARCHAR) AS op,
         'label ' || id AS label, 'note ' || id AS note, 'kind ' || id AS kind
  FROM (VALUES {_values(rows)}) AS v(id, class, property, lo, hi, op))"""


SYSTEMS = """
systems AS (
  SELECT 'system:' || c_custkey AS sys, c_mktsegment AS class, c_custkey AS k FROM customer),
limits AS (
  SELECT sys, 'prop:click' AS prop, NULL::DOUBLE AS val, NULL::DOUBLE AS vmin,
         (40 + k % 50)::DOUBLE AS vmax, 0 AS no FROM systems
  UNION ALL SELECT sys, 'prop:view', NULL, (10 + k % 20)::DOUBLE, NULL, 1 FROM systems
  UNION ALL SELECT sys, 'prop:purchase', (30 + k % 40)::DOUBLE, NULL, NULL, 2 FROM systems)"""
PRICES = """
systems AS (SELECT 'part:' || p_partkey AS sys, p_type AS class, p_retailprice FROM part),
limits AS (
  SELECT sys, 'prop:unitprice' AS prop, p_retailprice AS val, NULL::DOUBLE AS vmin,
         NULL::DOUBLE AS vmax, 0 AS no FROM systems)"""


def _absolute(unknown: str = "NULL") -> str:
    return f"""
absolute AS (
  SELECT s.sys, s.class, b.id AS bbid, b.prop, l.no, COALESCE(l.val, l.vmin, l.vmax) AS ref,
         b.lo AS rel_lo, b.hi AS rel_hi, b.op, b.kind, b.label, b.note,
         CASE WHEN b.op IS NULL THEN b.lo
              WHEN b.op = 'som' THEN COALESCE(l.vmax, l.val) + b.lo
              WHEN b.op = 'product' THEN COALESCE(l.vmax, l.val) * b.lo
              ELSE {unknown.replace('?', 'b.lo')} END AS lo,
         CASE WHEN b.op IS NULL THEN b.hi
              WHEN b.op = 'som' THEN COALESCE(l.vmin, l.val) + b.hi
              WHEN b.op = 'product' THEN COALESCE(l.vmin, l.val) * b.hi
              ELSE {unknown.replace('?', 'b.hi')} END AS hi
  FROM systems s JOIN bands b ON s.class = b.class
  LEFT JOIN limits l ON l.sys = s.sys AND l.prop = b.prop)"""


MATCHED = """
matched AS (
  SELECT o.*, a.bbid, a.ref, a.kind, a.label, a.note, a.lo, a.hi, a.no, a.class,
         a.rel_lo, a.rel_hi, a.op,
         md5(to_json([o.id, o.t, a.bbid, a.no::VARCHAR])::VARCHAR) AS key
  FROM obs o JOIN absolute a ON o.foi = a.sys AND o.prop = a.prop
  WHERE (a.lo IS NULL OR o.num > a.lo) AND (a.hi IS NULL OR o.num < a.hi))"""

_BANDED = ",".join([SYSTEMS, _bands(tv.BAND_ROWS), _absolute()])
_ALARMS = ",".join([OBS, _BANDED, MATCHED])
_NESTED_ID = """to_json({'klasse': class, 'parameter': prop, 'band': {'minValue': rel_lo,
  'maxValue': rel_hi, 'operatie': op, 'label': label, 'type': kind, 'note': note}})::VARCHAR"""
_ABSOLUTE_COLUMNS = """
  sys AS lzsid, bbid, prop AS parameter, ref AS referentiewaarde,
  rel_lo AS "minValueNormBandbreedte", rel_hi AS "maxValueNormBandbreedte", op AS operatie,
  kind AS type, label, note AS "scopeNote", lo AS "minValue", hi AS "maxValue" """
_REPORT_COLUMNS = f"""
  key AS _id, foi AS "hasFeatureOfInterest", prop AS "observedProperty",
  DATE '{tv.AS_OF[:10]}' AS "resultTime", t AS "phenomenonTime", num AS gemetenwaarde,
  ref AS referentiewaarde, note AS bandbreedte, lo AS "minValue", hi AS "maxValue", datum"""


def _alarm_columns(kind: str, dimensions: str = "") -> str:
    return f"""
  'observation:' || key AS _id, 'sosa:Observation' AS _type, foi AS "hasFeatureOfInterest",
  prop AS "observedProperty", '{tv.AS_OF}' AS "resultTime", t AS "phenomenonTime",
  id AS "wasInformedBy", datum, 'result:' || key AS result__id, '{kind}' AS result__type,
  bbid AS result_value, kind AS result_label, {dimensions}
  num AS result_parametervalue, unit AS result_parameterunit, note AS result_scopenote"""


_FLAT = """
  id AS _id, foi AS "hasFeatureOfInterest", prop AS "observedProperty", unit AS eenheid,
  status AS kwalitatieve_waarde, num AS numerieke_waarde, t AS "resultTime" """

CODES = f"""
codes AS (
  SELECT *, 'code:' || p_partkey AS id, 'scheme:' || p_type AS scheme,
         list_value(p_type, p_brand) AS types,
         CASE WHEN p_size % 7 <> 0 THEN p_size % 3 END AS n_narrower,
         CASE WHEN p_partkey % 4 = 0 THEN list_value(seg[p_partkey % 5 + 1])
              ELSE list_value(seg[p_partkey % 5 + 1], seg[(p_partkey + 2) % 5 + 1]) END AS classes
  FROM part, (SELECT list_value({", ".join(_value(s) for s in tv.SEGMENTS)}) AS seg))"""

TRIPLES = """
named AS (SELECT *, '_:' || md5(to_json({'_id': id, 'resultTime': t})::VARCHAR) || '-result' AS node FROM obs),
triples AS (
  SELECT id AS s, 'rdf:type' AS p, 'sosa:Observation' AS o, 'iri' AS o_kind,
         NULL::VARCHAR AS datatype FROM named
  UNION ALL SELECT id, 'sosa:hasFeatureOfInterest', foi, 'iri', NULL FROM named
  UNION ALL SELECT id, 'sosa:observedProperty', prop, 'iri', NULL FROM named
  UNION ALL SELECT id, 'sosa:hasResult', node, 'bnode', NULL FROM named
  UNION ALL SELECT node, 'rdf:type', 'sosa:Result', 'iri', NULL FROM named
  UNION ALL SELECT node, 'http://qudt.org/schema/qudt/unit', unit, 'iri', NULL FROM named
            WHERE unit IS NOT NULL
  UNION ALL SELECT node, 'rdf:value', status, 'iri', NULL FROM named WHERE status IS NOT NULL
  UNION ALL SELECT node, 'rdf:value', CAST(num AS VARCHAR), 'literal', 'xsd:decimal' FROM named
            WHERE num IS NOT NULL
  UNION ALL SELECT id, 'sosa:resultTime', t, 'literal', 'xsd:dateTime' FROM named)"""
_GRAPH = f"{OBS},{TRIPLES}"

EXPANDED = f"""
prefixes AS (SELECT * FROM (VALUES {_values(list(tv.CONTEXT.prefixes.items()))}) AS v(prefix, ns)),
full_triples AS (
  SELECT COALESCE(ps.ns || substr(s, strpos(s, ':') + 1), s) AS s,
         COALESCE(pp.ns || substr(p, strpos(p, ':') + 1), p) AS p,
         CASE WHEN o_kind = 'iri' THEN COALESCE(po.ns || substr(o, strpos(o, ':') + 1), o)
              ELSE o END AS o,
         o_kind,
         COALESCE(pd.ns || substr(datatype, strpos(datatype, ':') + 1), datatype) AS datatype
  FROM triples
  LEFT JOIN prefixes ps ON ps.prefix = split_part(s, ':', 1)
  LEFT JOIN prefixes pp ON pp.prefix = split_part(p, ':', 1)
  LEFT JOIN prefixes po ON po.prefix = split_part(o, ':', 1)
  LEFT JOIN prefixes pd ON pd.prefix = split_part(datatype, ':', 1))"""

_REPORT = """
report AS (
  SELECT *, 'click-low' AS rule, 'sh:Violation' AS severity, 'click not above 5' AS message
  FROM obs WHERE prop = 'prop:click' AND num <= 5
  UNION ALL
  SELECT *, 'view-band', 'sh:Violation', 'view in 7.5 to 10'
  FROM obs WHERE prop = 'prop:view' AND num > 7.5 AND num <= 10
  UNION ALL
  SELECT *, 'click-tiny', 'sh:Warning', 'click below 1'
  FROM obs WHERE prop = 'prop:click' AND num < 1)"""
_CONSTRAINTS = """,
constrained AS (
  SELECT * FROM report
  UNION ALL SELECT *, 'purchase-unit', 'sh:Violation', 'purchase in M3'
  FROM obs WHERE prop = 'prop:purchase' AND unit IS DISTINCT FROM 'unit:M3'
  UNION ALL SELECT *, 'signup-unit', 'sh:Info', 'signup has a unit'
  FROM obs WHERE prop = 'prop:signup' AND unit IS DISTINCT FROM 'unit:PH'
  UNION ALL SELECT *, 'status-number', 'sh:Warning', 'status is a number'
  FROM obs WHERE status IS NOT NULL AND TRY_CAST(status AS DOUBLE) IS NULL
  UNION ALL SELECT *, 'error-above', 'sh:Warning', 'error above 2.5'
  FROM obs WHERE prop = 'prop:error' AND num IS NOT NULL AND NOT num > 2.5
  UNION ALL SELECT *, 'error-ceiling', 'sh:Violation', 'error below ceiling'
  FROM obs WHERE prop = 'prop:error' AND num IS NOT NULL AND NOT num < ceiling)"""
_REPORT_OUT = """
  id AS "focusNode", severity AS "resultSeverity", message AS "resultMessage", rule,
  foi AS "hasFeatureOfInterest", prop AS "observedProperty", t AS "resultTime" """
_HASHED = f"""
hashed AS (
  SELECT *, md5(replace(id, 'observation:', '{tv.PREFIXES["observation"]}') || '-' || t) AS key
  FROM report)"""
_CONSTRUCTED = f"""
WITH {OBS},{_REPORT},{_HASHED}
SELECT 'observation:' || key AS _id, severity || ',sosa:Observation' AS _type,
       foi AS "hasFeatureOfInterest", prop AS "observedProperty", t AS "phenomenonTime",
       id AS "wasInformedBy", '{tv.AS_OF}' AS "resultTime",
       '_:' || md5(key || '-' || message) AS result_id, message
FROM hashed"""
_MERGED = f"""
merged AS (
  SELECT 'observation:' || key AS id_, foi, prop, t, id,
         list_sort(list_append(list(DISTINCT severity), 'sosa:Observation')) AS types,
         list_sort(list(DISTINCT message)) AS messages
  FROM hashed GROUP BY ALL)"""

_PATH = """
chain AS (
  SELECT a.s, b.o, b.o_kind, b.datatype FROM triples a JOIN triples b ON a.o = b.s
  WHERE a.p = 'sosa:hasResult' AND b.p = 'rdf:value')"""
_MEMBERS = """
members AS (
  SELECT a.s, 'ex:HighClick' AS class FROM triples a JOIN chain c ON a.s = c.s
  JOIN triples r ON r.s = a.s JOIN triples u ON u.s = r.o
  WHERE a.p = 'sosa:observedProperty' AND a.o = 'prop:click' AND r.p = 'sosa:hasResult'
    AND u.p = 'http://qudt.org/schema/qudt/unit' AND u.o = 'unit:PH'
    AND TRY_CAST(c.o AS DOUBLE) >= 7.5
  UNION
  SELECT u.s, CASE u.o WHEN 'unit:PH' THEN 'ex:HighResult' ELSE 'ex:LowPressure' END
  FROM triples u JOIN triples v ON u.s = v.s
  WHERE u.p = 'http://qudt.org/schema/qudt/unit' AND v.p = 'rdf:value'
    AND (u.o = 'unit:PH' AND TRY_CAST(v.o AS DOUBLE) >= 7.5
         OR u.o = 'unit:PA' AND TRY_CAST(v.o AS DOUBLE) < 3))"""
_INHERITED = f"""
edges AS (SELECT * FROM (VALUES {_values(tv.SUBCLASS_ROWS)}) AS v(sub, super)),
up AS (
  SELECT sub, super FROM edges
  UNION SELECT up.sub, e.super FROM up JOIN edges e ON up.super = e.sub),
stated AS (SELECT s, class FROM members UNION SELECT s, o FROM triples WHERE p = 'rdf:type')"""

_GAPS = f"""
WITH {OBS}, gaps AS (
  SELECT * REPLACE (
    CASE WHEN CAST(split_part(id, ':', 2) AS BIGINT) % 11 <> 2 THEN foi END AS foi,
    CASE WHEN CAST(split_part(id, ':', 2) AS BIGINT) % 5 <> 3 THEN prop END AS prop,
    CASE WHEN CAST(split_part(id, ':', 2) AS BIGINT) % 7 <> 5 THEN num END AS num) FROM obs),
{SYSTEMS},{_bands(tv.BAND_ROWS + tv.GAP_BAND_ROWS)},{_absolute()},
{MATCHED.replace("FROM obs o", "FROM gaps o")}
SELECT {_REPORT_COLUMNS} FROM matched"""

_ORDERED = """
seg AS (SELECT 'customer:' || c_custkey AS s, 'segment:' || c_mktsegment AS segment FROM customer),
ord AS (SELECT 'customer:' || o_custkey AS c, 'order:' || o_orderkey AS s, 'status:' || o_orderstatus AS status,
  CAST(o_orderdate AS DATE) + 100 AS limit_, o_totalprice >= 200000 AS large FROM orders),
line AS (SELECT 'order:' || l_orderkey AS ord, l_quantity AS q, l_linenumber * 10 AS number,
  CAST(l_shipdate AS DATE) AS shipped FROM lineitem),
bought AS (SELECT seg.s, seg.segment, q FROM seg JOIN ord ON ord.c = seg.s JOIN line ON line.ord = ord.s),
shape_report AS (
  SELECT s AS focus, 'sh:Warning' AS severity, 'an order' AS message, 'has-order' AS rule, NULL AS value
  FROM seg WHERE s NOT IN (SELECT c FROM ord)
  UNION ALL SELECT s, 'sh:Info', 'at most 14 orders', 'few-orders', NULL FROM seg
  WHERE (SELECT count(*) FROM ord WHERE c = seg.s) > 14
  UNION ALL SELECT ord.s, 'sh:Info', 'two to five days', 'few-days', NULL FROM ord LEFT JOIN line ON line.ord = ord.s
  WHERE status = 'status:F' GROUP BY ord.s HAVING count(DISTINCT shipped) NOT BETWEEN 2 AND 5
  UNION ALL SELECT DISTINCT s, 'sh:Violation', 'above 2', 'quantity', CAST(q AS VARCHAR) FROM bought
  WHERE segment = 'segment:BUILDING' AND NOT q > 2
  UNION ALL SELECT DISTINCT s, 'sh:Warning', '49 or more', 'full', CAST(q AS VARCHAR) FROM bought
  WHERE segment = 'segment:AUTOMOBILE' AND q >= 49
  UNION ALL SELECT s, 'sh:Violation', 'one finished', 'finished', NULL FROM seg
  WHERE segment = 'segment:MACHINERY' AND s NOT IN (SELECT c FROM ord WHERE status = 'status:F')
  UNION ALL SELECT DISTINCT ord.s, 'sh:Violation', 'shipped soon', 'in-time',
    strftime(shipped, '%Y-%m-%dT00:00:00Z') FROM ord JOIN line ON line.ord = ord.s
  WHERE status = 'status:O' AND NOT shipped < limit_
  UNION ALL SELECT DISTINCT ord.s, 'sh:Info', 'quantity below number', 'low', CAST(a.q AS VARCHAR)
  FROM ord JOIN line a ON a.ord = ord.s JOIN line b ON b.ord = ord.s
  WHERE status = 'status:P' AND NOT a.q < b.number
  UNION ALL SELECT seg.s, 'sh:Info', 'a large order', 'large', ord.s FROM seg JOIN ord ON ord.c = seg.s
  WHERE segment = 'segment:FURNITURE' AND NOT large)"""

_NESTED = """
edges AS (
  SELECT 'order:' || o_orderkey AS class, 'customer:' || o_custkey AS super FROM orders
  UNION SELECT 'customer:' || c_custkey, 'nation:' || c_nationkey FROM customer
  UNION SELECT 'customer:' || c_custkey, 'segment:' || c_mktsegment FROM customer
  UNION SELECT 'nation:' || n_nationkey, 'region:' || n_regionkey FROM nation
  UNION SELECT 'region:0', 'nation:0' FROM region WHERE r_regionkey = 0
  UNION SELECT 'region:' || r_regionkey, 'part of:' || r_name FROM region),
above AS (
  SELECT class, super FROM edges
  UNION SELECT a.class, e.super FROM above a JOIN edges e ON a.super = e.class)"""

ORACLES: dict[str, str] = {
    "q01_json_declared_schema": f"WITH {OBS} SELECT {_FLAT} FROM obs",
    "q01_array_in_ranges": f"WITH {OBS} SELECT {_FLAT} FROM obs",
    "q01_multiline_json": f"WITH {OBS} SELECT {_FLAT} FROM obs",
    "q02_parquet_round_trip": "SELECT * FROM lineitem",
    "q03_json_text_records": (
        "SELECT CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events"
    ),
    "q03_inferred_records": f"WITH {OBS} SELECT {_FLAT} FROM obs",
    # The schema of the texts of the query.
    "q03_inferred_schema": """
SELECT * FROM (VALUES
  ('_id', 'string'), ('_type', 'string'), ('hasFeatureOfInterest', 'string'),
  ('hasOperatingRange', 'struct<hasOperatingProperty:array<struct<forProperty:string,'
    || 'maxValue:double,minValue:double,value:double>>>'),
  ('k', 'bigint'), ('observedProperty', 'string'),
  ('result', 'struct<_type:string,eenheid:string,kwalitatieve_waarde:string,numerieke_waarde:double>'),
  ('resultTime', 'string'), ('type', 'string')) AS v(field, kind)
WHERE (SELECT count(*) FROM events) > 0 AND (SELECT count(*) FROM customer) > 0""",
    "q04_inferred_envelope": f"""
WITH {OBS} SELECT id AS _id, 'sosa:Observation' AS _type FROM obs
UNION ALL SELECT foi, 'ssn:System' FROM obs""",
    "q04_envelope_unwrap": f"""
WITH {OBS} SELECT id AS _id, 'sosa:Observation' AS _type FROM obs
UNION ALL SELECT foi, 'ssn:System' FROM obs""",
    "q05_parquet_by_date": f"WITH {_ALARMS} SELECT {_alarm_columns('sosa:Result')} FROM matched",
    "q05_late_alarms": f"WITH {_ALARMS} SELECT {_alarm_columns('sosa:Result')} FROM matched",
    "q06_late_json": f"WITH {_ALARMS} SELECT {_alarm_columns('sosa:Result')} FROM matched",
    "q05_replaced_day": f"""
WITH {_ALARMS}, flat AS (SELECT {_alarm_columns('sosa:Result')} FROM matched)
SELECT * REPLACE (CASE WHEN datum = DATE '{tv.DAY}' THEN '{tv.LATER}' ELSE "resultTime" END AS "resultTime")
FROM flat""",
    "q06_json_by_date": f"WITH {_ALARMS} SELECT {_REPORT_COLUMNS} FROM matched",
    "q05_single_file": f"""
WITH {_ALARMS} SELECT count(*) AS alarms, count(*) AS ids, 1::BIGINT AS files FROM matched""",
    "q07_nested_select": f"WITH {OBS} SELECT {_FLAT} FROM obs",
    "q08_concept_schemes": f"""
WITH {CODES} SELECT id, p_name AS "prefLabel" FROM codes
WHERE list_contains(types, 'Brand#1') AND scheme = 'scheme:ECONOMY'""",
    "q09_leaf_concepts": f"""
WITH {CODES} SELECT id, p_type || ',' || p_brand AS type, scheme AS "inScheme",
  p_name AS "prefLabel", 'code:' || p_brand AS broader
FROM codes WHERE scheme = 'scheme:SMALL' AND n_narrower = 0""",
    "q10_operating_properties": f"""
WITH {SYSTEMS} SELECT sys AS operating_of, prop AS "forProperty", val AS value,
  vmin AS "minValue", vmax AS "maxValue" FROM limits""",
    "q11_typed_concepts": f"""
WITH {CODES} SELECT id, u.t AS type, scheme AS "inScheme", p_name AS "prefLabel",
  array_to_string(classes, ',') AS dct_type, 'unit:' || p_size AS "applicableUnit",
  p_brand AS subject, NULL::VARCHAR AS "seeAlso"
FROM codes, unnest(types) AS u(t) WHERE scheme = 'scheme:PROMO' AND u.t = 'Brand#7'""",
    "q12_band_concepts": f"""
WITH {CODES} SELECT id, u.t AS type, scheme AS "inScheme", p_name AS "prefLabel",
  'part ' || p_name AS definition, 'size ' || p_size AS "scopeNote", c.c AS dct_type,
  'prop:unitprice' AS "relevantProperty",
  CASE WHEN p_partkey % 2 = 1 THEN p_retailprice END AS "maxValue",
  CASE WHEN p_partkey % 2 = 0 THEN p_retailprice END AS "minValue",
  CASE p_partkey % 3 WHEN 0 THEN 'som' WHEN 1 THEN 'product' END AS operatie
FROM codes, unnest(types) AS u(t), unnest(classes) AS c(c)
WHERE scheme = 'scheme:LARGE'
  AND NOT (p_type IN ('LARGE', 'Brand#3') AND p_brand IN ('LARGE', 'Brand#3'))""",
    "q12_code_list_job": f"""
WITH {CODES}
SELECT 'schemes' AS slice, id FROM codes WHERE list_contains(types, 'Brand#1')
UNION ALL SELECT 'classes', id FROM codes WHERE scheme = 'scheme:SMALL' AND n_narrower = 0
UNION ALL SELECT 'parameters', id FROM codes, unnest(types) AS u(t)
  WHERE scheme = 'scheme:PROMO' AND u.t = 'Brand#7'
UNION ALL SELECT 'bands', id FROM codes, unnest(types) AS u(t), unnest(classes) AS c(c)
  WHERE scheme = 'scheme:LARGE'""",
    "q13_with_column": """
SELECT l_orderkey, l_linenumber, l_extendedprice * (1 - l_discount) AS l_extendedprice, l_discount,
  CASE WHEN l_returnflag = 'R' THEN 'returned' ELSE 'kept' END AS l_returnflag FROM lineitem""",
    "q14_bands_of_systems": f"""
WITH {SYSTEMS},{_bands(tv.BAND_ROWS)} SELECT s.sys AS lzsid, s.class AS system_class, b.id AS bbid,
  b.prop AS parameter FROM systems s JOIN bands b ON s.class = b.class""",
    "q15_bands_with_operating": f"""
WITH {SYSTEMS},{_bands(tv.BAND_ROWS)} SELECT s.sys AS lzsid, b.id AS bbid, l.prop AS "forProperty",
  l.val AS value, l.vmin AS "minValue", l.vmax AS "maxValue"
FROM systems s JOIN bands b ON s.class = b.class
LEFT JOIN limits l ON l.sys = s.sys AND l.prop = b.prop""",
    "q16_absolute_bands": f"WITH {_BANDED} SELECT {_ABSOLUTE_COLUMNS} FROM absolute",
    "q16_absolute_bands_sql": f"WITH {_BANDED} SELECT {_ABSOLUTE_COLUMNS} FROM absolute",
    "q16_absolute_bands_resolved": f"""
WITH {SYSTEMS},{_bands(tv.BAND_ROWS)},{_absolute('?')} SELECT {_ABSOLUTE_COLUMNS} FROM absolute
WHERE (rel_lo IS NULL OR lo IS NOT NULL) AND (rel_hi IS NULL OR hi IS NOT NULL)""",
    "q17_absolute_bands_nested": f"""
WITH {_BANDED} SELECT sys AS lzsid, prop AS parameter, ref AS referentiewaarde,
  rel_lo AS "relatieveMinValueNormBandbreedte", rel_hi AS "relatieveMaxValueNormBandbreedte",
  op AS operatie, label, kind AS type, note, lo AS "minValue", hi AS "maxValue" FROM absolute""",
    "q18_concepts_for_class": (
        f"WITH {CODES} SELECT id FROM codes WHERE list_contains(classes, 'BUILDING')"
    ),
    "q18_classes_for_concept": (
        f"WITH {CODES} SELECT id, array_to_string(classes, '|') AS classes FROM codes"
    ),
    "q18_classes_of_one_concept": f"""
WITH {CODES} SELECT id, array_to_string(classes, ', ') AS classes FROM codes
WHERE id = 'code:5'""",
    "q19_times": f"WITH {OBS} SELECT id AS _id, datum, micros FROM obs",
    "q20_alarm_report": f"WITH {_ALARMS} SELECT {_REPORT_COLUMNS} FROM matched",
    "q20_alarm_report_sql": f"WITH {_ALARMS} SELECT {_REPORT_COLUMNS} FROM matched",
    "q20_indexed": f"WITH {_ALARMS} SELECT {_REPORT_COLUMNS} FROM matched",
    "q20_indexed_gaps": _GAPS,
    "q20_indexed_tiers": f"""
WITH obs AS (
  SELECT 'order:' || o_orderkey AS id, 'shop:1' AS foi, 'prop:total' AS prop, o_totalprice AS num,
         strftime(o_orderdate, '%Y-%m-%d') AS t, CAST(o_orderdate AS DATE) AS datum FROM orders),
absolute AS (
  SELECT 'shop:1' AS sys, 'tier:' || p_partkey AS bbid, 'prop:total' AS prop, NULL::INT AS no,
         NULL::DOUBLE AS ref, 'tier ' || p_partkey AS note, NULL AS kind, NULL AS label, NULL AS class,
         NULL AS rel_lo, NULL AS rel_hi, NULL AS op,
         round(p_retailprice * (1 + p_partkey % 200)) AS lo,
         CASE WHEN p_partkey % 50 <> 0 THEN round(p_retailprice * (1 + p_partkey % 200)) + 400 END AS hi
  FROM part),
{MATCHED} SELECT {_REPORT_COLUMNS} FROM matched""",
    "q20_gaps": _GAPS,
    "q20_gaps_sql": _GAPS,
    "q20_alarm_report_nested": f"""
WITH {_ALARMS} SELECT 'observation:' || md5(to_json([id, t, md5({_NESTED_ID}), no::VARCHAR])::VARCHAR) AS _id,
  'sosa:Observation' AS _type, foi AS "hasFeatureOfInterest", prop AS "observedProperty",
  DATE '{tv.AS_OF[:10]}' AS "resultTime", t AS "phenomenonTime", kind AS alarmtype, label,
  num AS gemetenwaarde, ref AS referentiewaarde, lo AS "minValueNormBandbreedte",
  hi AS "maxValueNormBandbreedte" FROM matched""",
    "q20_distinct_ids": f"""
WITH {OBS},{SYSTEMS},{_bands(tv.BAND_ROWS)},
single AS (SELECT * FROM limits),{_absolute()},{MATCHED},
doubled AS (
  SELECT sys, prop, val, vmin, vmax FROM limits
  UNION ALL SELECT sys, 'prop:click', NULL, NULL, (40 + (k + 1) % 50)::DOUBLE FROM systems
  UNION ALL SELECT sys, 'prop:view', NULL, (10 + (k + 1) % 20)::DOUBLE, NULL FROM systems
  UNION ALL SELECT sys, 'prop:purchase', (30 + (k + 1) % 40)::DOUBLE, NULL, NULL FROM systems),
twice AS ({_absolute().replace("absolute AS (", "", 1).rsplit(")", 1)[0].replace("limits l", "doubled l").replace("l.no,", "")}),
flat AS (
  SELECT count(*) AS n FROM obs o JOIN twice a ON o.foi = a.sys AND o.prop = a.prop
  WHERE (a.lo IS NULL OR o.num > a.lo) AND (a.hi IS NULL OR o.num < a.hi))
SELECT 'flat' AS form, n AS alarms, n AS ids FROM flat
UNION ALL SELECT 'nested', count(*), count(*) FROM matched""",
    "q21_alarms_compact": f"WITH {_ALARMS} SELECT {_alarm_columns('sosa:Result')} FROM matched",
    "q22_alarms_extended": f"""
WITH {_ALARMS} SELECT {_alarm_columns(
        'sosa:Result,qb:Observation',
        'prop AS "result_parameterDimensie", foi AS "result_lzsDimensie", t AS "result_refPeriod",'
    )} FROM matched""",
    "q23_hashed_ids": (
        f"WITH {OBS} SELECT id AS _id, md5(to_json([id, t, prop, NULL])::VARCHAR) AS key FROM obs"
    ),
    "q24_uuid_facts": f"""
WITH {_ALARMS} SELECT count(*) AS alarms, true AS well_formed, true AS all_distinct,
  true AS clock_of_run FROM matched""",
    "q25_rule_targets": f"""
WITH {OBS} SELECT 'having' AS target, id AS "focusNode" FROM obs
UNION ALL SELECT 'equal', id FROM obs WHERE prop = 'prop:click'""",
    "q26_rule_report": f"WITH {OBS},{_REPORT} SELECT {_REPORT_OUT} FROM report",
    "q26_extreme_numbers": f"""
WITH {OBS}, extremes AS (
  SELECT o.*, x.x FROM obs o
  JOIN (VALUES {_values(list(enumerate(tv.EXTREMES)))}) AS x(i, x)
    ON x.i = CAST(split_part(o.id, ':', 2) AS BIGINT) % {len(tv.EXTREMES)}),
found AS (
  SELECT *, 'above' AS rule, 'sh:Violation' AS severity, 'above 7.5' AS message
  FROM extremes WHERE CAST(x AS DOUBLE) > 7.5
  UNION ALL SELECT *, 'tiny', 'sh:Violation', 'at most tiny' FROM extremes
  WHERE CAST(x AS DOUBLE) <= 1e-11
  UNION ALL SELECT *, 'text-above', 'sh:Warning', 'text above 7.5' FROM extremes
  WHERE CAST(x AS DOUBLE) > 7.5
  UNION ALL SELECT *, 'text-exclusive', 'sh:Info', 'text over 7.5' FROM extremes
  WHERE NOT CAST(x AS DOUBLE) > 7.5)
SELECT {_REPORT_OUT} FROM found""",
    "q27_constraint_report": (
        f"WITH {OBS},{_REPORT}{_CONSTRAINTS} SELECT {_REPORT_OUT} FROM constrained"
    ),
    "q27_graph_report": f"WITH {OBS},{_REPORT}{_CONSTRAINTS} SELECT {_REPORT_OUT} FROM constrained",
    "q27_shapes_for_all": f"""
WITH {_ORDERED} SELECT focus AS "focusNode", severity AS "resultSeverity", message AS "resultMessage",
  rule, value, segment FROM shape_report LEFT JOIN seg ON seg.s = focus""",
    "q28_constructed_alarms": _CONSTRUCTED,
    "q28_constructed_alarms_joined": _CONSTRUCTED,
    "q29_merged_alarms": f"""
WITH {OBS},{_REPORT},{_HASHED},{_MERGED}
SELECT id_ AS _id, array_to_string(types, ',') AS _type, foi AS "hasFeatureOfInterest",
  prop AS "observedProperty", t AS "phenomenonTime", id AS "wasInformedBy",
  '{tv.AS_OF}' AS "resultTime", array_to_string(messages, ',') AS messages FROM merged""",
    "q30_to_triples": f"WITH {_GRAPH} SELECT * FROM triples",
    "q31_expanded_triples": f"WITH {_GRAPH},{EXPANDED} SELECT * FROM full_triples",
    "q32_path_values": f"""
WITH {_GRAPH},{_PATH} SELECT c.* FROM chain c JOIN triples q ON q.s = c.s
WHERE q.p = 'sosa:observedProperty' AND q.o = 'prop:click'""",
    "q33_union_of_graphs": f"""
WITH {_GRAPH}, named_ AS (
  SELECT * FROM triples WHERE p IN ('sosa:hasFeatureOfInterest', 'sosa:observedProperty'))
SELECT s, p, o, o_kind, datatype FROM named_
UNION SELECT o, 'rdf:type', 'kind:' || p, o_kind, datatype FROM named_""",
    "q33_union_of_loads": f"WITH {_GRAPH},{_PATH} SELECT * FROM chain",
    "q34_framed_observations": f"WITH {OBS} SELECT {_FLAT} FROM obs",
    "q34_framed_at_two_times": f"""
WITH {OBS} SELECT 'observation:' || (CAST(split_part(id, ':', 2) AS BIGINT) // 2) AS _id,
  min(foi) AS "hasFeatureOfInterest", min(prop) AS "observedProperty", min(t) AS "resultTime",
  nullif(concat_ws(',', CASE WHEN min(foi) <> max(foi) THEN 'hasFeatureOfInterest' END,
    CASE WHEN min(prop) <> max(prop) THEN 'observedProperty' END,
    CASE WHEN min(t) <> max(t) THEN 'resultTime' END), '') AS several
FROM obs GROUP BY 1""",
    "q36_rule_job_ntriples": f"""
WITH {OBS},{_REPORT},{_HASHED}
SELECT DISTINCT '<{tv.PREFIXES["observation"]}' || key || '> <'
  || '{tv.CONTEXT.prefixes["prov"]}wasInformedBy> <'
  || replace(id, 'observation:', '{tv.PREFIXES["observation"]}') || '> .' AS value FROM hashed""",
    "q35_framed_alarms_json": f"""
WITH {OBS},{_REPORT},{_HASHED},{_MERGED}
SELECT '{{"_id":"' || id_ || '","_type":["' || array_to_string(types, '","')
  || '"],"hasFeatureOfInterest":"' || foi || '","observedProperty":"' || prop
  || '","phenomenonTime":"' || t || '","wasInformedBy":"' || id
  || '","resultTime":"{tv.AS_OF}","messages":["' || array_to_string(messages, '","')
  || '"]}}' AS record
FROM merged WHERE list_contains(types, 'sh:Violation')""",
    "q36_ntriples": f"""
WITH {_GRAPH},{EXPANDED}
SELECT CASE WHEN s LIKE '\\_:%' ESCAPE '\\' THEN s ELSE '<' || s || '>' END || ' <' || p || '> '
  || CASE o_kind WHEN 'iri' THEN '<' || o || '>' WHEN 'bnode' THEN o
     ELSE '"' || o || '"' || COALESCE('^^<' || datatype || '>', '') END || ' .' AS value
FROM full_triples""",
    "q37_property_chain": f"""
WITH {_GRAPH},{_PATH} SELECT s, 'ex:numericValue' AS p, o, o_kind, datatype FROM chain""",
    "q38_class_members": f"WITH {_GRAPH},{_PATH},{_MEMBERS} SELECT s, class FROM members",
    "q38_filled_classes": f"""
WITH RECURSIVE {OBS}, results AS (
  SELECT id, '_:' || md5(to_json({{'_id': id, 'resultTime': t}})::VARCHAR) || '-result' AS node,
         CASE WHEN unit = 'unit:PH' AND num >= 7.5 THEN 'ex:HighResult'
              WHEN unit = 'unit:PA' AND num < 3 THEN 'ex:LowPressure' END AS class FROM obs),
previous AS (
  SELECT 'observation:' || event_id AS id,
         'observation:' || lag(event_id) OVER (PARTITION BY user_id ORDER BY event_id) AS before
  FROM events),
alerting AS (
  SELECT id FROM obs JOIN results USING (id) WHERE prop = 'prop:click' AND class = 'ex:HighResult'),
streak AS (
  SELECT id, false AS defined FROM alerting
  UNION SELECT p.id, true FROM previous p JOIN streak ON p.before = streak.id
  JOIN obs o ON o.id = p.id WHERE o.prop = 'prop:click')
SELECT node AS s, class FROM results WHERE class IS NOT NULL
UNION ALL SELECT id, 'ex:Notable' FROM results WHERE class IS NOT NULL
UNION ALL SELECT id, 'ex:Alerting' FROM alerting
UNION ALL SELECT id, 'ex:Streak' FROM streak WHERE defined""",
    "q39_inferred_types": f"""
WITH RECURSIVE {_GRAPH},{_PATH},{_MEMBERS},{_INHERITED}
SELECT s, class FROM stated
UNION SELECT t.s, up.super FROM stated t JOIN up ON up.sub = t.class""",
    "q39_labelled_superclasses": f"""
WITH RECURSIVE {_NESTED} SELECT class, super FROM above WHERE class LIKE 'order:%' AND class <> super""",
    "q39_labelled_members": f"""
WITH RECURSIVE {_NESTED}
SELECT DISTINCT 'line:' || l_orderkey || ':' || l_linenumber AS s, super AS class
FROM lineitem JOIN above ON class = 'order:' || l_orderkey
WHERE super IN ({", ".join(f"'{c}'" for c, in tv.ASKED_CLASSES)})""",
    "q40_price_report": f"""
WITH obs AS (
  SELECT 'line:' || l_orderkey || ':' || l_linenumber AS id, 'part:' || l_partkey AS foi,
         'prop:unitprice' AS prop, l_extendedprice / l_quantity AS num,
         strftime(l_shipdate, '%Y-%m-%d') AS t, CAST(l_shipdate AS DATE) AS datum FROM lineitem),
{PRICES},{_bands(tv.PRICE_BAND_ROWS)},{_absolute()},{MATCHED}
SELECT {_REPORT_COLUMNS} FROM matched""",
}
ORACLES["q35_rule_job_json"] = ORACLES["q35_framed_alarms_json"]
ORACLES["q12_reused_concepts"] = ORACLES["q11_typed_concepts"]
