"""Stand-in views: the driver's test tables seen as the domain's input tables.

The test data is a TPC-H-like star schema. It is mapped onto the incident
domain as follows (see FIXTURES.md §3):

* national offense      <- lineitem  (incident_id = l_orderkey, offense_code = l_partkey)
* national incident     <- orders    (agency_id = o_custkey, incident_date = o_orderdate)
* national offense type <- part      (offense_name = p_type, category = p_brand)
* national agencies     <- customer x nation x region
* the out-of-domain set <- lineitem by l_shipdate, supplier -> nation -> region
* the dashboard cube    <- orders x customer
* geo points / events   <- embeddings (+ events)

Every function returns a lazy DataFrame; only the needed columns are read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskbeacon.functions.expr import CITY_TYPE_GROUPS, clean_region_token

# --- fixed values: stand-in part type -> crime group ------------------------
STANDIN_TYPE_GROUPS = [
    ("ECONOMY", "theft_larceny"),
    ("LARGE", "assault_battery"),
    ("MEDIUM", "burglary"),
    ("PROMO", "robbery"),
    ("SMALL", "motor_vehicle_theft"),
    ("STANDARD", "drug_narcotics"),
]

# --- fixed values: stand-in event type -> crime group (signup is unmapped) --
STANDIN_EVENT_GROUPS = [
    ("view", "theft_larceny"),
    ("click", "assault_battery"),
    ("purchase", "burglary"),
    ("error", "robbery"),
]

# Train windows end before this Monday; test windows start at or after it.
STANDIN_SPLIT_DATE = "2000-01-03"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def map_pairs(c, pairs) -> "F.Column":
    out = F.lit(None).cast("string")
    for raw, grp in reversed(pairs):
        out = F.when(c == raw, F.lit(grp)).otherwise(out)
    return out


def standin_group(c) -> "F.Column":
    return map_pairs(c, STANDIN_TYPE_GROUPS)


# ------------------------------------------------------------- national ----
def nat_offense(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("incident_id"),
        F.col("l_partkey").alias("offense_code"))


def nat_incident(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("incident_id"),
        F.col("o_custkey").alias("agency_id"),
        F.col("o_orderdate").alias("incident_date"))


def nat_offense_type(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("offense_code"),
        F.col("p_type").alias("offense_name"),
        F.col("p_brand").alias("offense_category_name"))


def nat_agencies(spark, sf_dir) -> DataFrame:
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    cust = table(spark, sf_dir, "customer")
    geo = nation.join(region, nation.n_regionkey == region.r_regionkey, "left")
    return (cust.join(geo, cust.c_nationkey == geo.n_nationkey, "left")
            .select(F.col("c_custkey").alias("agency_id"),
                    F.col("r_name").alias("state_abbr"),
                    F.col("r_name").alias("state_name"),
                    F.col("n_name").alias("county_name"),
                    F.lit(None).cast("string").alias("ori"),
                    F.lit(None).cast("string").alias("pub_agency_unit"),
                    F.lit(None).cast("string").alias("pub_agency_name")))


# ---------------------------------------------------------- out domain -----
def out_domain_events(spark, sf_dir) -> DataFrame:
    """Out-of-domain events: one per lineitem, dated by ship date, placed in the
    supplier's region/nation. Canonical schema (event_date, region_id,
    crime_group, raw_type)."""
    li = table(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey", "l_shipdate")
    part = table(spark, sf_dir, "part").select(
        "p_partkey", "p_type", standin_group(F.col("p_type")).alias("crime_group"))
    supp = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    region = table(spark, sf_dir, "region").select("r_regionkey", "r_name")

    def place(state, county):
        return F.concat_ws("__", clean_region_token(state), clean_region_token(county))
    # Names are joined last: suppliers alone are small enough for Spark to plan
    # without dealing the events, joined with nations their size isn't known.
    geo = (nation.join(region, F.col("n_regionkey") == region.r_regionkey, "left")
           .select("n_nationkey", place("r_name", "n_name").alias("__place")))
    nowhere = place(F.lit(None), F.lit(None))  # of suppliers without a nation
    ev = (li.join(part, li.l_partkey == part.p_partkey, "left")
          .join(supp, li.l_suppkey == supp.s_suppkey, "left")
          .join(geo, F.col("s_nationkey") == F.col("n_nationkey"), "left")
          .select(F.col("l_shipdate").alias("event_date"),
                  F.when(F.col("s_suppkey").isNotNull(), F.coalesce("__place", nowhere)).alias("region_id"),
                  "crime_group", F.col("p_type").alias("raw_type")))
    return ev.dropna(subset=["event_date", "crime_group", "region_id"])


# ------------------------------------------------------------- cube --------
def city_clean(spark, sf_dir) -> DataFrame:
    """Cleaned city export (dashboard input): orders x customer."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority",
                                              "o_orderstatus")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    j = o.join(c, o.o_custkey == c.c_custkey, "left")
    d = F.to_date("o_orderdate")
    return j.select(
        d.alias("Date"),
        F.date_format("o_orderdate", "HH:mm:ss").alias("Time"),
        F.col("o_orderpriority").alias("Primary Type"),
        F.col("o_orderstatus").alias("Description"),
        F.col("c_mktsegment").alias("Location Description"),
        (F.col("o_orderstatus") == "F").alias("Arrest"),
        (F.col("o_orderstatus") == "P").alias("Domestic"),
        F.col("c_nationkey").cast("short").alias("District"),
        (F.col("o_custkey") % 77).cast("short").alias("Community Area"),
        F.year(d).cast("short").alias("Year"),
        (F.lit(41.6) + (F.col("o_orderkey") % 400) / F.lit(1000.0)).cast("double").alias("Latitude"),
        (F.lit(-87.9) + ((F.col("o_orderkey") * 7) % 400) / F.lit(1000.0)).cast("double").alias("Longitude"),
        F.month(d).cast("byte").alias("Month"),
        F.date_format(d, "EEEE").alias("DayOfWeek"),
        (F.col("o_orderkey") % 24).cast("byte").alias("Hour"),
    )


# ------------------------------------------------------------- geo ---------
def _label_regions(spark, sf_dir) -> DataFrame:
    """Embedding label -> the region id of nation ``label`` (county form)."""
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    region = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    return (nation.join(region, nation.n_regionkey == region.r_regionkey, "left")
            .select(F.col("n_nationkey").alias("label"),
                    F.concat_ws("__", clean_region_token("r_name"), clean_region_token("n_name")).alias("region_id")))


def geo_points(spark, sf_dir) -> DataFrame:
    """Geo points (region_id, latitude, longitude): one per embedding vector."""
    e = table(spark, sf_dir, "embeddings").select("label", "embedding")
    return (e.join(_label_regions(spark, sf_dir), "label", "inner")
            .select("region_id",
                    F.col("embedding")[1].cast("double").alias("latitude"),
                    F.col("embedding")[0].cast("double").alias("longitude")))


def geo_events(spark, sf_dir) -> DataFrame:
    """Geo events of the test period: every order dated at/after the split
    date, placed at embedding ``o_orderkey % 500`` (region = that vector's
    label region). Dates overlap the in-domain test predictions."""
    o = (table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
         .filter(F.col("o_orderdate") >= F.lit(STANDIN_SPLIT_DATE).cast("timestamp")))
    e = table(spark, sf_dir, "embeddings").select("vec_id", "label", "embedding")
    j = (o.join(e, (o.o_orderkey % 500) == e.vec_id, "inner")
         .join(_label_regions(spark, sf_dir), "label", "inner"))
    return j.select("region_id",
                    F.col("embedding")[1].cast("double").alias("latitude"),
                    F.col("embedding")[0].cast("double").alias("longitude"),
                    F.col("o_orderdate").alias("event_date"))


# ------------------------------------------------------- short panel -------
def short_events(spark, sf_dir) -> DataFrame:
    """About 30 days of app events as incidents (3-day windows only)."""
    ev = table(spark, sf_dir, "events").select("ts", "user_id", "event_type")
    return ev.select(
        F.col("ts").alias("event_date"),
        F.concat(F.lit("S"), (F.col("user_id") % 3).cast("string"), F.lit("__"),
                 (F.col("user_id") % 15).cast("string")).alias("region_id"),
        map_pairs(F.col("event_type"), STANDIN_EVENT_GROUPS).alias("crime_group"),
        F.col("event_type").alias("raw_type"),
    ).dropna(subset=["event_date", "crime_group", "region_id"])


# ------------------------------------------------------- city export -------
def city_raw(spark, sf_dir) -> DataFrame:
    """The original city export shape (text timestamps, id columns) from
    orders x customer; the hour of day is ``o_orderkey % 24``."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority",
                                              "o_orderstatus")
    cu = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment", "c_name")
    j = o.join(cu, o.o_custkey == cu.c_custkey, "left")
    ts = F.col("o_orderdate") + F.make_interval(hours=(F.col("o_orderkey") % 24).cast("int"))
    fmt = "MM/dd/yyyy hh:mm:ss a"
    return j.select(
        F.col("o_orderkey").alias("ID"), F.concat(F.lit("C"), F.col("o_orderkey").cast("string")).alias("Case Number"),
        F.date_format(ts, fmt).alias("Date"), F.col("c_name").alias("Block"),
        F.substring("o_orderpriority", 1, 1).alias("IUCR"), F.col("o_orderpriority").alias("Primary Type"),
        F.col("o_orderstatus").alias("Description"), F.col("c_mktsegment").alias("Location Description"),
        (F.col("o_orderstatus") == "F").alias("Arrest"), (F.col("o_orderstatus") == "P").alias("Domestic"),
        (F.col("o_custkey") % 300).alias("Beat"), F.col("c_nationkey").alias("District"),
        (F.col("o_custkey") % 50).alias("Ward"), (F.col("o_custkey") % 77).alias("Community Area"),
        F.substring("o_orderpriority", 1, 1).alias("FBI Code"),
        (F.col("o_orderkey") % 1000).cast("double").alias("X Coordinate"),
        (F.col("o_orderkey") % 997).cast("double").alias("Y Coordinate"),
        F.year("o_orderdate").alias("Year"), F.date_format(ts, fmt).alias("Updated On"),
        (F.lit(41.6) + (F.col("o_orderkey") % 400) / F.lit(1000.0)).alias("Latitude"),
        (F.lit(-87.9) + ((F.col("o_orderkey") * 7) % 400) / F.lit(1000.0)).alias("Longitude"),
        F.lit(None).cast("string").alias("Location"))


# Types of a mixed export: every type of the city's rules once, odd spellings
# of some, types of no group, and none.
MIXED_TYPES = [*[t for t, _ in CITY_TYPE_GROUPS], " theft ", "Robbery", "GAMBLING", "", "NARCOTICS VIOLATION", None]
MIXED_TYPES_SQL = "[" + ", ".join("NULL" if t is None else f"'{t}'" for t in MIXED_TYPES) + "]"


def city_mixed(spark, sf_dir) -> DataFrame:
    """The city export with types that reach every mapping rule, missing and
    impossible dates, and districts that are missing or float-like."""
    key = F.col("ID")
    types = F.array(*[F.lit(t).cast("string") for t in MIXED_TYPES])
    return city_raw(spark, sf_dir).withColumns({
        "Primary Type": F.get(types, (key % len(MIXED_TYPES)).cast("int")),
        "Date": F.when(key % 89 == 0, F.lit(None)).when(key % 97 == 0, F.lit("13/45/2001 99:00:00 PM")).otherwise(F.col("Date")),
        "District": F.when(key % 101 == 0, F.lit(None)).when(key % 103 == 0, F.lit("nan"))
        .otherwise(F.concat(F.col("District").cast("string"), F.lit(".0")))})
