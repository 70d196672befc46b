"""The given tables seen as observations, systems, bands and codes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from normwatch.operators.classes import Conjunct
from normwatch.operators.rules import FIELDS, Rule
from normwatch.operators.shapes import Shape
from normwatch.sources.context import STANDARD_CONTEXT, Context
from normwatch.session import literal_table

AS_OF = "2025-08-08 13:35:09"
LATER = "2025-08-09 01:02:03"
# A day of observations that is run again.
DAY = "2024-01-15"

# (id, class, property, lower, upper, operation): every way a band can be expressed or fail.
BAND_ROWS = [
    ("b01", "BUILDING", "error", None, 5.0, None),
    ("b02", "BUILDING", "error", 100.0, None, None),
    ("b03", "BUILDING", "click", 0.0, None, "som"),
    ("b04", "BUILDING", "view", None, 0.8, "product"),
    ("b05", "BUILDING", "purchase", None, 0.6, "product"),
    ("b06", "BUILDING", "purchase", 1.4, None, "product"),
    ("b07", "MACHINERY", "error", 1.0, None, "som"),
    ("b08", "MACHINERY", "click", 25.0, None, "som"),
    ("b09", "AUTOMOBILE", "purchase", 20.0, 60.0, "som"),
    ("b10", "HOUSEHOLD", "view", None, -5.0, "som"),
    ("b11", "FURNITURE", "click", 3.0, None, "macht"),
    ("b12", "NOSUCH", "view", 50.0, None, "som"),
    ("b13", "HOUSEHOLD", "click", 1.2, None, "product"),
]
# Open bands, and bands without a property or a class.
GAP_BAND_ROWS = [
    ("g01", "BUILDING", None, None, None, None),
    ("g02", "MACHINERY", None, 1.0, None, None),
    ("g03", None, "click", None, None, None),
    ("g04", "FURNITURE", "error", None, None, None),
]
# Unit prices of line items against the list price of the part, per type of part.
PRICE_BAND_ROWS = [
    ("p01", "ECONOMY", "unitprice", None, 0.5, "product"),
    ("p02", "ECONOMY", "unitprice", 20.0, None, "product"),
    ("p03", "SMALL", "unitprice", 0.0, 400.0, "som"),
    ("p04", "STANDARD", "unitprice", 50000.0, None, None),
    ("p05", "PROMO", "unitprice", -100.0, 100.0, "som"),
    ("p06", "LARGE", "unitprice", None, 0.1, "product"),
    ("p07", "MEDIUM", "unitprice", 8.0, 9.0, "product"),
]
SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
PREFIXES = {
    "observation": "https://example.org/id/observation/",
    "system": "https://example.org/id/system/",
    "prop": "https://example.org/id/property/",
    "status": "https://example.org/id/status/",
}
CONTEXT = STANDARD_CONTEXT.merged(Context(prefixes=PREFIXES))
NODE_KEY = ("_id", "resultTime")

RULES = [
    Rule("info", "sh:Info", "observed"),
    Rule("warning", "sh:Warning", "observed"),
    Rule("click-low", "sh:Violation", "click not above 5", "match", "prop:click",
         hi="5", hi_inclusive=True),
    Rule("view-band", "sh:Violation", "view in 7.5 to 10", "match", "prop:view",
         lo="7.5", hi="10", hi_inclusive=True),
    Rule("click-tiny", "sh:Warning", "click below 1", "match", "prop:click", hi="1"),
]
CONSTRAINTS = RULES + [
    Rule("purchase-unit", "sh:Violation", "purchase in M3", "has_value", "prop:purchase",
         field="unit", operand="unit:M3"),
    Rule("signup-unit", "sh:Info", "signup has a unit", "has_value", "prop:signup",
         field="unit", operand="unit:PH"),
    Rule("status-number", "sh:Warning", "status is a number", "decimal", None, field="status"),
    Rule("error-above", "sh:Warning", "error above 2.5", "min_exclusive", "prop:error", lo="2.5"),
    Rule("error-ceiling", "sh:Violation", "error below ceiling", "less_than", "prop:error",
         field="value", other="ceiling"),
]
# Numbers as text that no fixed number of digits holds, and limits next to them.
EXTREMES = ["7.50000000001", "1e30", "0.00000000001", "3.7E0", "7.5"]
EXTREME_RULES = [
    Rule("above", "sh:Violation", "above 7.5", "match", None, lo="7.5"),
    Rule("tiny", "sh:Violation", "at most tiny", "match", None, hi="0.00000000001",
         hi_inclusive=True),
    Rule("text-above", "sh:Warning", "text above 7.5", "match", None, "status", lo="7.5"),
    Rule("text-number", "sh:Warning", "text is a number", "decimal", None, "status"),
    Rule("text-exclusive", "sh:Info", "text over 7.5", "min_exclusive", None, "status", lo="7.5"),
]
RULE_FIELDS = {**FIELDS, "ceiling": "ceiling"}
CEILING_CONTEXT = CONTEXT.merged(Context(terms={"ceiling": ("ex:ceiling", "xsd:decimal")}))

# About customers with no order or many, and orders with many lines.
_LINES = ("ex:order", "ex:line")
ORDER_SHAPES = [
    Shape("has-order", "sh:Warning", "an order", "count", ("ex:order",), "ex:segment", lo="1"),
    Shape("few-orders", "sh:Info", "at most 14 orders", "count", ("ex:order",), "ex:segment", hi="14"),
    Shape("few-days", "sh:Info", "two to five days", "count", ("ex:line", "ex:shipped"), "ex:status",
          "status:F", lo="2", hi="5"),
    Shape("quantity", "sh:Violation", "above 2", "min_exclusive", (*_LINES, "ex:quantity"),
          "ex:segment", "segment:BUILDING", lo="2"),
    Shape("full", "sh:Warning", "49 or more", "match", (*_LINES, "ex:quantity"),
          "ex:segment", "segment:AUTOMOBILE", lo="49", lo_inclusive=True),
    Shape("finished", "sh:Violation", "one finished", "has_value", ("ex:order", "ex:status"),
          "ex:segment", "segment:MACHINERY", operand="status:F"),
    Shape("in-time", "sh:Violation", "shipped soon", "less_than", ("ex:line", "ex:shipped"),
          "ex:status", "status:O", other=("ex:limit",)),
    Shape("low", "sh:Info", "quantity below number", "less_than", ("ex:line", "ex:quantity"),
          "ex:status", "status:P", other=("ex:line", "ex:number")),
    Shape("large", "sh:Info", "a large order", "instance", ("ex:order",),
          "ex:segment", "segment:FURNITURE", operand="ex:LargeOrder"),
]

CHAIN = {"ex:numericValue": ("sosa:hasResult", "rdf:value")}
UNIT = "http://qudt.org/schema/qudt/unit"
CLASS_PREDICATES = ("sosa:observedProperty", "sosa:hasResult", UNIT, "rdf:value")
CLASSES = {
    "ex:HighClick": [
        Conjunct(("sosa:observedProperty",), "is", "prop:click"),
        Conjunct(("sosa:hasResult", UNIT), "is", "unit:PH"),
        Conjunct(("ex:numericValue",), ">=", "7.5"),
    ],
    "ex:HighResult": [
        Conjunct((UNIT,), "is", "unit:PH"),
        Conjunct(("rdf:value",), ">=", "7.5"),
    ],
    "ex:LowPressure": [
        Conjunct((UNIT,), "is", "unit:PA"),
        Conjunct(("rdf:value",), "<", "3"),
    ],
}
ASKED_CLASSES = [("region:0",), ("segment:BUILDING",), ("nation:7",), ("nowhere",)]
# Classes defined by classes: a click with a high result, and clicks that follow such a one of the
# same system without a break.
FILLED_CLASSES = {
    "ex:HighResult": CLASSES["ex:HighResult"],
    "ex:LowPressure": CLASSES["ex:LowPressure"],
    "ex:Alerting": [
        Conjunct(("sosa:observedProperty",), "is", "prop:click"),
        Conjunct(("sosa:hasResult",), "a", "ex:HighResult"),
    ],
    "ex:Streak": [
        Conjunct(("sosa:observedProperty",), "is", "prop:click"),
        Conjunct(("ex:previous",), "a", "ex:Streak"),
    ],
    "ex:Notable": [Conjunct(("sosa:hasResult",), "a", "ex:Extreme")],
}
FILLED_SUBCLASSES = [
    ("ex:Alerting", "ex:Streak"),
    ("ex:HighResult", "ex:Extreme"),
    ("ex:LowPressure", "ex:Extreme"),
]
SUBCLASS_ROWS = [
    ("ex:HighClick", "ex:Alarm"),
    ("ex:Alarm", "ex:Event"),
    ("ex:Event", "ex:Thing"),
    ("ex:HighResult", "sosa:Result"),
    ("ex:LowPressure", "sosa:Result"),
    ("sosa:Result", "ex:Thing"),
    ("sosa:Observation", "ex:Event"),
    # A cycle: the two classes are the same.
    ("ex:Event", "ex:Occurrence"),
    ("ex:Occurrence", "ex:Event"),
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as observations: sign-ups carry a status instead of a number."""
    is_text = F.col("event_type") == "signup"
    unit = (
        F.when(F.col("event_type") == "click", "unit:PH")
        .when(F.col("event_type") == "view", "unit:PA")
        .when(~is_text, "unit:M3")
    )
    offset = (
        F.when(F.col("event_id") % 3 == 0, "Z")
        .when(F.col("event_id") % 3 == 1, "+02:00")
        .otherwise("-05:00")
    )
    written = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    status = F.concat(F.lit("status:"), (F.col("user_id") % 3).cast("string"))
    return table(spark, sf_dir, "events").select(
        F.concat(F.lit("observation:"), F.col("event_id")).alias("_id"),
        F.lit("sosa:Observation").alias("_type"),
        F.concat(F.lit("system:"), F.col("user_id")).alias("hasFeatureOfInterest"),
        F.concat(F.lit("prop:"), F.col("event_type")).alias("observedProperty"),
        F.struct(
            F.lit("sosa:Result").alias("_type"),
            unit.alias("eenheid"),
            F.when(is_text, status).alias("kwalitatieve_waarde"),
            F.when(~is_text, F.col("value")).alias("numerieke_waarde"),
        ).alias("result"),
        F.concat(written, offset).alias("resultTime"),
    )


def observations_with_extremes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Observations whose numbers are beyond ten decimals or 28 digits; as text in the status."""
    texts = F.array(*[F.lit(t) for t in EXTREMES])
    text = F.element_at(texts, (F.col("number") % len(EXTREMES) + 1).cast("int"))
    rows = observations(spark, sf_dir).withColumn(
        "number", F.substring_index("_id", ":", -1).cast("long")
    )
    result = F.col("result").withField("kwalitatieve_waarde", text)
    return rows.withColumn("result", result.withField("numerieke_waarde", text.cast("double")))


def observations_with_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Observations of which some lack the property, some the system, some the number."""
    number = F.substring_index("_id", ":", -1).cast("long")
    rows = observations(spark, sf_dir)
    value = F.when(number % 7 != 5, F.col("result.numerieke_waarde"))
    return rows.withColumns(
        {
            "observedProperty": F.when(number % 5 != 3, F.col("observedProperty")),
            "hasFeatureOfInterest": F.when(number % 11 != 2, F.col("hasFeatureOfInterest")),
            "result": F.col("result").withField("numerieke_waarde", value),
        }
    )


def bands_with_gaps(spark: SparkSession) -> DataFrame:
    """Bands and beside them open bands without a property, and without a class."""
    return _band_table(spark, BAND_ROWS + GAP_BAND_ROWS)


def observations_at_two_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of observations that share an id."""
    number = F.substring_index("_id", ":", -1).cast("long")
    pair = F.concat(F.lit("observation:"), F.floor(number / 2).cast("string"))
    return observations(spark, sf_dir).withColumn("_id", pair)


def systems_with_two_limits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Systems with two operating properties for each parameter, the second one higher by one."""
    key = F.col("c_custkey")
    both = F.concat(_limits(key, "forProperty"), _limits(key + 1, "forProperty"))
    return systems(spark, sf_dir).drop("hasOperatingRange").join(
        table(spark, sf_dir, "customer").select(
            F.concat(F.lit("system:"), key).alias("_id"),
            F.struct(both.alias("hasOperatingProperty")).alias("hasOperatingRange"),
        ),
        "_id",
    )


def norms_without_labels(spark: SparkSession) -> DataFrame:
    """Nested norms whose bands have no label."""
    bare = F.transform("bandbreedtes", lambda b: b.withField("label", F.lit(None).cast("string")))
    return norms_nested(spark).withColumn("bandbreedtes", bare)


def observations_with_ceiling(spark: SparkSession, sf_dir: str) -> DataFrame:
    number = F.substring_index("hasFeatureOfInterest", ":", -1).cast("double")
    return observations(spark, sf_dir).withColumn("ceiling", number)


def _limits(key, named: str):
    nothing = F.lit(None).cast("double")

    def limit(prop: str, value=nothing, lower=nothing, upper=nothing):
        return F.struct(
            F.lit(prop).alias(named),
            value.cast("double").alias("value"),
            lower.cast("double").alias("minValue"),
            upper.cast("double").alias("maxValue"),
        )

    return F.array(
        limit("prop:click", upper=40 + key % 50),
        limit("prop:view", lower=10 + key % 20),
        limit("prop:purchase", value=30 + key % 40),
    )


def systems(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as systems whose class is the market segment."""
    key = F.col("c_custkey")
    limits = _limits(key, "forProperty").alias("hasOperatingProperty")
    return table(spark, sf_dir, "customer").select(
        F.concat(F.lit("system:"), key).alias("_id"),
        F.col("c_mktsegment").alias("type"),
        F.struct(limits).alias("hasOperatingRange"),
    )


def systems_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        F.concat(F.lit("system:"), key).alias("_id"),
        F.col("c_mktsegment").alias("type"),
        _limits(key, "parameter").alias("parameterconditie"),
    )


def _band_table(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    schema = (
        "id string, subject string, property string, minValue double, maxValue double, "
        "operatie string"
    )
    return literal_table(spark, rows, schema).select(
        "id",
        "subject",
        F.concat(F.lit("prop:"), F.col("property")).alias("forProperty"),
        F.concat(F.lit("label "), F.col("id")).alias("prefLabel"),
        F.concat(F.lit("note "), F.col("id")).alias("scopeNote"),
        F.concat(F.lit("kind "), F.col("id")).alias("dc_type"),
        "minValue",
        "maxValue",
        "operatie",
    )


def bands(spark: SparkSession) -> DataFrame:
    return _band_table(spark, BAND_ROWS)


def norms_nested(spark: SparkSession) -> DataFrame:
    """The same bands, nested per class and property."""
    band = F.struct(
        "minValue",
        "maxValue",
        "operatie",
        F.col("prefLabel").alias("label"),
        F.col("dc_type").alias("type"),
        F.col("scopeNote").alias("note"),
    )
    grouped = bands(spark).groupBy(
        F.col("subject").alias("klasse"), F.col("forProperty").alias("parameter")
    )
    return grouped.agg(F.collect_list(band).alias("bandbreedtes"))


def price_systems(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as systems with one operating property, the list price."""
    nothing = F.lit(None).cast("double")
    price = F.struct(
        F.lit("prop:unitprice").alias("forProperty"),
        F.col("p_retailprice").alias("value"),
        nothing.alias("minValue"),
        nothing.alias("maxValue"),
    )
    return table(spark, sf_dir, "part").select(
        F.concat(F.lit("part:"), F.col("p_partkey")).alias("_id"),
        F.col("p_type").alias("type"),
        F.struct(F.array(price).alias("hasOperatingProperty")).alias("hasOperatingRange"),
    )


def price_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as observations of a unit price."""
    price = F.col("l_extendedprice") / F.col("l_quantity")
    return table(spark, sf_dir, "lineitem").select(
        F.concat_ws(":", F.lit("line"), "l_orderkey", "l_linenumber").alias("_id"),
        F.concat(F.lit("part:"), F.col("l_partkey")).alias("hasFeatureOfInterest"),
        F.lit("prop:unitprice").alias("observedProperty"),
        F.struct(price.alias("numerieke_waarde")).alias("result"),
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("resultTime"),
    )


def order_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as observations of a total, all of one system."""
    return table(spark, sf_dir, "orders").select(
        F.concat(F.lit("order:"), F.col("o_orderkey")).alias("_id"),
        F.lit("shop:1").alias("hasFeatureOfInterest"),
        F.lit("prop:total").alias("observedProperty"),
        F.struct(F.col("o_totalprice").alias("numerieke_waarde")).alias("result"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("resultTime"),
    )


def price_tiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Absolute bands of that one system, one for each part; some open above, ends repeat."""
    key = F.col("p_partkey")
    low = F.round(F.col("p_retailprice") * (1 + key % 200)).cast("double")
    return table(spark, sf_dir, "part").select(
        F.lit("shop:1").alias("lzsid"),
        F.concat(F.lit("tier:"), key).alias("bbid"),
        F.lit("prop:total").alias("parameter"),
        F.lit(None).cast("int").alias("operating_no"),
        F.lit(None).cast("double").alias("referentiewaarde"),
        F.concat(F.lit("tier "), key).alias("scopeNote"),
        low.alias("minValue"),
        F.when(key % 50 != 0, low + 400).alias("maxValue"),
    )


def price_bands(spark: SparkSession) -> DataFrame:
    return _band_table(spark, PRICE_BAND_ROWS)


def codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as concepts of a code list per type of part."""
    key, size = F.col("p_partkey"), F.col("p_size")
    segments = F.array(*[F.lit(s) for s in SEGMENTS])

    def segment(number):
        return F.element_at(segments, (number % 5 + 1).cast("int"))

    children = F.transform(
        F.filter(F.array(F.lit(1), F.lit(2)), lambda i: i <= size % 3),
        lambda i: F.concat(F.lit("code:"), key, F.lit("/"), i),
    )
    one, two = F.array(segment(key)), F.array(segment(key), segment(key + 2))
    return table(spark, sf_dir, "part").select(
        F.concat(F.lit("code:"), key).alias("id"),
        F.array("p_type", "p_brand").alias("type"),
        F.concat(F.lit("scheme:"), F.col("p_type")).alias("inScheme"),
        F.col("p_name").alias("prefLabel"),
        F.concat(F.lit("code:"), F.col("p_brand")).alias("broader"),
        F.when(size % 7 != 0, children).alias("narrower"),
        F.when(key % 4 == 0, one).otherwise(two).alias("dct_type"),
        F.concat(F.lit("unit:"), size).alias("applicableUnit"),
        F.col("p_brand").alias("subject"),
        F.lit(None).cast("string").alias("seeAlso"),
        F.concat(F.lit("part "), F.col("p_name")).alias("definition"),
        F.concat(F.lit("size "), size).alias("scopeNote"),
        F.lit("prop:unitprice").alias("relevantProperty"),
        F.when(key % 2 == 0, F.col("p_retailprice")).alias("minValue"),
        F.when(key % 2 == 1, F.col("p_retailprice")).alias("maxValue"),
        F.when(key % 3 == 0, "som").when(key % 3 == 1, "product").alias("operatie"),
    )


def previous_triples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each observation of a system linked to the one before it."""
    line = Window.partitionBy("user_id").orderBy("event_id")
    before = F.lag("event_id").over(line)
    return table(spark, sf_dir, "events").withColumn("before", before).where("before is not null").select(
        F.concat(F.lit("observation:"), F.col("event_id")).alias("s"),
        F.lit("ex:previous").alias("p"),
        F.concat(F.lit("observation:"), F.col("before")).alias("o"),
        F.lit("iri").alias("o_kind"),
        F.lit(None).cast("string").alias("datatype"),
    )


def order_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers, orders and line items as triples; large orders have a type."""

    def triples(rows: DataFrame, s, p: str, o, kind: str, datatype: str | None = None) -> DataFrame:
        return rows.select(
            s.alias("s"),
            F.lit(p).alias("p"),
            o.cast("string").alias("o"),
            F.lit(kind).alias("o_kind"),
            F.lit(datatype).cast("string").alias("datatype"),
        )

    def named(prefix: str, *keys: str):
        return F.concat_ws(":", F.lit(prefix), *keys)

    def day(name: str):
        return F.concat(F.date_format(name, "yyyy-MM-dd"), F.lit("T00:00:00Z"))

    customers, orders = table(spark, sf_dir, "customer"), table(spark, sf_dir, "orders")
    lines = table(spark, sf_dir, "lineitem")
    order, line = named("order", "o_orderkey"), named("line", "l_orderkey", "l_linenumber")
    limit = day(F.date_add(F.col("o_orderdate").cast("date"), 100))
    large = orders.where("o_totalprice >= 200000")
    parts = [
        triples(customers, named("customer", "c_custkey"), "ex:segment", named("segment", "c_mktsegment"), "iri"),
        triples(orders, named("customer", "o_custkey"), "ex:order", order, "iri"),
        triples(orders, order, "ex:status", named("status", "o_orderstatus"), "iri"),
        triples(orders, order, "ex:limit", limit, "literal", "xsd:dateTime"),
        triples(large, order, "rdf:type", F.lit("ex:LargeOrder"), "iri"),
        triples(lines, named("order", "l_orderkey"), "ex:line", line, "iri"),
        triples(lines, line, "ex:shipped", day("l_shipdate"), "literal", "xsd:dateTime"),
        triples(lines, line, "ex:quantity", F.col("l_quantity"), "literal", "xsd:decimal"),
        triples(lines, line, "ex:number", F.col("l_linenumber") * 10, "literal", "xsd:integer"),
    ]
    return reduce(DataFrame.unionByName, parts)


def nested_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders below customers, those below nations and segments, and so on; one region and one of
    its nations are the same."""
    customers, nations = table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation")
    orders, regions = table(spark, sf_dir, "orders"), table(spark, sf_dir, "region")

    def pairs(rows: DataFrame, sub: str, sub_key: str, above: str, above_key: str) -> DataFrame:
        return rows.select(
            F.concat(F.lit(f"{sub}:"), F.col(sub_key).cast("string")).alias("class"),
            F.concat(F.lit(f"{above}:"), F.col(above_key).cast("string")).alias("super"),
        )

    parts = [
        pairs(orders, "order", "o_orderkey", "customer", "o_custkey"),
        pairs(customers, "customer", "c_custkey", "nation", "c_nationkey"),
        pairs(customers, "customer", "c_custkey", "segment", "c_mktsegment"),
        pairs(nations, "nation", "n_nationkey", "region", "n_regionkey"),
        pairs(regions.where("r_regionkey = 0"), "region", "r_regionkey", "nation", "r_regionkey"),
        pairs(regions, "region", "r_regionkey", "part of", "r_name"),
    ]
    return reduce(DataFrame.unionByName, parts)


def ordered_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as members of the class of their order."""
    return table(spark, sf_dir, "lineitem").select(
        F.concat_ws(":", F.lit("line"), "l_orderkey", "l_linenumber").alias("s"),
        F.concat(F.lit("order:"), F.col("l_orderkey")).alias("class"),
    )


def subclass_triples(spark: SparkSession) -> DataFrame:
    """The class hierarchy as triples."""
    return literal_table(spark, SUBCLASS_ROWS, "s string, o string").select(
        "s",
        F.lit("rdfs:subClassOf").alias("p"),
        "o",
        F.lit("iri").alias("o_kind"),
        F.lit(None).cast("string").alias("datatype"),
    )
