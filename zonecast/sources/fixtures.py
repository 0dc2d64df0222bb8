"""Stand-in inputs built over the driver's tables.

The surveyed workload reads taxi trips, station ridership and zone polygons;
the test tables are TPC-H-like. These views only *map columns* so that every
operator has rows of the schema it expects (see FIXTURES.md section 2). They
do none of the operators' work: no filtering by rule, no aggregation, no zone
assignment. Where FIXTURES.md gives a formula it is followed; columns it leaves
open (vendor id, store-and-forward flag, surcharges and fees, the raw
ridership text columns) get simple deterministic stand-ins, and tip and tolls
are rounded to cents the same way in Spark and in the SQL oracle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from zonecast.functions.timecols import hour_start
from zonecast.sources.tables import read_table

# Fixed values (FIXTURES.md section 2): zones_v ring vertex offsets, in ring
# order, relative to the zone origin (x0, y0).
ZONE_RING_OFFSETS = [(0.1, 0.3), (1.7, 0.1), (1.1, 0.9), (1.9, 1.8), (0.4, 1.6)]

# Borough codes used by the raw ridership text view, by
# user_id % 5. The first four are the codes the recode (P10) maps to names.
RAW_BOROUGH_CODES = ["Q", "BX", "M", "BK", "SI"]

# Rings of the zones of several parts, relative to the zone
# origin: a hole in the zone, an island in the hole, a second part with a hole
# that touches it in a corner. Some run clockwise.
HOLE_RING = [(0.6, 0.8), (1.0, 0.8), (1.0, 1.2), (0.6, 1.2)]
ISLAND_RING = [(0.7, 0.9), (0.7, 1.1), (0.9, 1.1), (0.9, 0.9)]
SECOND_RING = [(12.2, 0.2), (13.8, 0.2), (13.8, 1.8), (12.2, 1.8)]
SECOND_HOLE_RING = [(12.2, 0.2), (13.0, 0.7), (13.0, 1.1), (12.6, 1.1)]

# Damage to zone texts, by the zone's id modulo 11; others are
# whole.
WKT_DAMAGE = {
    1: "POLYGON ((0 0, 4 0, 4 4, 0 4, 0 0)", 2: "POLYGON ((0 0, 4 0, x 4, 0 4, 0 0))",
    3: "POINT (1 2)", 4: "POLYGON ((0 0, 4 0, 4 4, 0 4))", 5: "POLYGON ((0 0, 4 0, 0 0))",
    6: "MULTIPOLYGON EMPTY", 7: "  multipolygon(((0 0 1,4 0 1, 4 4 1,0 0 1)) ,\n((5 5 1,6 5 1,6 6 1,5 5 1)))",
    8: "POLYGON EMPTY", 9: "POLYGON ((0 0, 4 0, 4 4, 0 4, 0 0), (1 1, 2 1, 2 2, 1 1))", 10: None,
}

RIDER_EVENT_TYPES = ["purchase", "signup"]
PICKUP_EVENT_TYPES = ["view", "click", "error"]


def _cents(x: Column) -> Column:
    """Round half up to cents on the binary value. `round(x, 2)` is avoided:
    engines differ on whether they round the binary or the decimal text."""
    return F.floor(x * 100 + 0.5) / 100


def _station_lon(key: Column) -> Column:
    return (key * 37 % 1000).cast("double") / 100


def _station_lat(key: Column) -> Column:
    return (key * 91 % 1000).cast("double") / 100


def trips_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """trips_v: one trip per lineitem, 19 columns in the contract order."""
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_extendedprice", "l_discount", "l_tax", "l_returnflag",
        "l_linestatus", "l_shipdate")
    o = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    s = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    # orders meet their customers first: where customers are too many for a
    # broadcast, narrow orders are shuffled by customer, never whole trips
    oc = o.join(c, F.col("o_custkey") == c.c_custkey).drop("o_custkey", "c_custkey")
    j = (li.join(oc, li.l_orderkey == oc.o_orderkey)
         .join(s, li.l_suppkey == s.s_suppkey))
    price = F.col("l_extendedprice")
    return j.select(
        (1 + F.col("l_linenumber") % 2).cast("bigint").alias("vendorid"),
        F.col("o_orderdate").alias("pu_time"),
        F.col("l_shipdate").alias("do_time"),
        F.when(F.col("l_orderkey") % 50 == 0, F.lit(None))
         .otherwise(F.col("l_linenumber")).cast("int").alias("passenger_count"),
        F.col("l_quantity").alias("trip_distance"),
        (1 + F.col("l_partkey") % 7).cast("int").alias("ratecodeid"),
        (F.col("l_returnflag") == "R").alias("store_and_fwd_flag"),
        F.col("c_nationkey").cast("bigint").alias("pulocationid"),
        F.col("s_nationkey").cast("bigint").alias("dolocationid"),
        (1 + F.col("l_suppkey") % 7).cast("int").alias("payment_type"),
        price.alias("fare_amount"),
        (F.col("l_discount") - 0.01).alias("extra"),
        F.col("l_tax").alias("mta_tax"),
        _cents(price * F.col("l_discount")).alias("tip_amount"),
        _cents(price * F.col("l_tax")).alias("tolls_amount"),
        F.lit(0.3).alias("improvement_surcharge"),
        F.col("o_totalprice").alias("total_amount"),
        F.when(F.col("l_linestatus") == "O", 2.5).otherwise(0.0)
         .alias("congestion_surcharge"),
        F.when(F.col("c_nationkey") == F.col("s_nationkey"), 1.25)
         .otherwise(F.lit(None).cast("double")).alias("airport_fee"),
    )


def landing_trips_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """trips_v under the landing names (mixed case, pre-rename), as the
    monthly files arrive before P1/P4 run."""
    t = trips_view(spark, sf_dir)
    landing = {
        "vendorid": "VendorID", "pu_time": "tpep_pickup_datetime",
        "do_time": "tpep_dropoff_datetime", "ratecodeid": "RatecodeID",
        "pulocationid": "PULocationID", "dolocationid": "DOLocationID",
        "airport_fee": "Airport_fee",
    }
    return t.select([F.col(c).alias(landing.get(c, c)) for c in t.columns])


def pickups_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """pickups_v: hour-grained demand over a month of events."""
    ev = read_table(spark, sf_dir, "events")
    return ev.where(F.col("event_type").isin(PICKUP_EVENT_TYPES)).select(
        (F.col("user_id") % 25).cast("bigint").alias("pulocationid"),
        F.col("ts").alias("pu_time"),
        (1 + F.col("event_id") % 6).cast("int").alias("passenger_count"),
    )


def event_trips_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """event_trips_v: one trip per pickup event, in the columns of trips_v. Its
    month is the ridership's, so cleaned trips and ridership meet."""
    eid, value = F.col("event_id"), F.col("value")
    ev = read_table(spark, sf_dir, "events").where(F.col("event_type").isin(PICKUP_EVENT_TYPES))
    return ev.select(
        (1 + eid % 2).cast("bigint").alias("vendorid"),
        F.col("ts").alias("pu_time"),
        F.expr("ts + make_dt_interval(0, 0, cast(event_id % 60 - 3 AS int), 0)").alias("do_time"),
        F.when(eid % 50 == 0, F.lit(None)).otherwise(1 + eid % 7).cast("int")
         .alias("passenger_count"),
        (value / 10).alias("trip_distance"),
        (1 + F.floor(value) % 7).cast("int").alias("ratecodeid"),
        (eid % 3 == 0).alias("store_and_fwd_flag"),
        (F.col("user_id") % 25).cast("bigint").alias("pulocationid"),
        (eid % 25).cast("bigint").alias("dolocationid"),
        (1 + eid % 4).cast("int").alias("payment_type"),
        (value + 3).alias("fare_amount"),
        F.lit(0.5).alias("extra"),
        F.lit(0.5).alias("mta_tax"),
        (value / 8 - 0.25).alias("tip_amount"),
        (value / 2).alias("tolls_amount"),
        F.lit(0.3).alias("improvement_surcharge"),
        (value * 2 + 4).alias("total_amount"),
        F.lit(2.5).alias("congestion_surcharge"),
        F.lit(None).cast("double").alias("airport_fee"),
    )


def ridership_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ridership_v: typed station ridership rows (station_id, timestamp, ridership)."""
    ev = read_table(spark, sf_dir, "events")
    return ev.where(F.col("event_type").isin(RIDER_EVENT_TYPES)).select(
        F.col("user_id").cast("string").alias("station_id"),
        hour_start("ts").alias("timestamp"),
        F.floor(F.col("value")).cast("bigint").alias("ridership"),
    )


def ridership_text_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw ridership CSV shape: 11 text columns, header names as landed.

    Numbers and timestamps are text; every 101st event carries a malformed
    ridership value ('n/a') so the tolerant casts have work.
    """
    ev = read_table(spark, sf_dir, "events").where(
        F.col("event_type").isin(RIDER_EVENT_TYPES))
    uid = F.col("user_id")
    lon, lat = _station_lon(uid), _station_lat(uid)
    riders = F.floor(F.col("value")).cast("bigint")
    return ev.select(
        F.date_format("ts", "MM/dd/yyyy hh:mm:ss a").alias("transit_timestamp"),
        uid.cast("string").alias("station_complex_id"),
        F.concat(F.lit("Station "), uid.cast("string")).alias("station_complex"),
        F.element_at(F.array(*[F.lit(c) for c in RAW_BOROUGH_CODES]),
                     (uid % 5 + 1).cast("int")).alias("borough"),
        F.lit("A C E").alias("routes"),
        F.when(F.col("event_type") == "purchase", "omny")
         .otherwise("metrocard").alias("payment_method"),
        F.when(F.col("event_id") % 101 == 0, F.lit("n/a"))
         .otherwise(riders.cast("string")).alias("ridership"),
        F.floor(F.col("value") / 10).cast("bigint").cast("string").alias("transfers"),
        lat.cast("string").alias("latitude"),
        lon.cast("string").alias("longitude"),
        F.concat(F.lit("POINT ("), lon.cast("string"), F.lit(" "),
                 lat.cast("string"), F.lit(")")).alias("georeference"),
    )


def stations_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """stations_v: one row per user_id over all events, with coordinates."""
    uid = F.col("user_id")
    return (read_table(spark, sf_dir, "events").select("user_id").distinct()
            .select(uid.cast("string").alias("station_id"),
                    _station_lat(uid).alias("latitude"),
                    _station_lon(uid).alias("longitude")))


def customer_points_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The larger point set for the spatial join: one point per customer."""
    k = F.col("c_custkey")
    return read_table(spark, sf_dir, "customer").select(
        k.alias("point_id"), _station_lon(k).alias("lon"), _station_lat(k).alias("lat"))


def zone_attrs_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zone attributes (locationid, borough, zone) from nation and region."""
    n = read_table(spark, sf_dir, "nation")
    r = read_table(spark, sf_dir, "region")
    return n.join(r, n.n_regionkey == r.r_regionkey).select(
        F.col("n_nationkey").cast("bigint").alias("locationid"),
        F.col("r_name").alias("borough"),
        F.col("n_name").alias("zone"),
    )


def zone_vertices_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """zones_v as a vertex table (locationid, ring, seq, x, y): one ring of
    five vertices per zone, placed on a 5-wide grid of 2x2 cells."""
    ring = F.array(*[
        F.struct(F.lit(i).alias("seq"), F.lit(float(dx)).alias("dx"),
                 F.lit(float(dy)).alias("dy"))
        for i, (dx, dy) in enumerate(ZONE_RING_OFFSETS)])
    key = F.col("locationid")
    x0 = (key % 5).cast("double") * 2
    y0 = F.floor(key / 5).cast("double") * 2
    return (zone_attrs_view(spark, sf_dir)
            .select("locationid", x0.alias("x0"), y0.alias("y0"),
                    F.explode(ring).alias("v"))
            .select("locationid", F.lit(0).alias("ring"),
                    F.col("v.seq").alias("seq"),
                    (F.col("x0") + F.col("v.dx")).alias("x"),
                    (F.col("y0") + F.col("v.dy")).alias("y")))


def multipart_vertices_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """zones_m as a vertex table: the ring of zones_v in all zones; a hole in
    those with id % 3 > 0; an island in the hole and a second part with a hole
    in those with id % 3 = 2. Rings are in no order."""
    def ring(number: int, offsets: list, least: int):
        return F.struct(F.lit(number).alias("ring"), F.lit(least).alias("least"), F.array(*[
            F.struct(F.lit(i).alias("seq"), F.lit(float(dx)).alias("dx"), F.lit(float(dy)).alias("dy"))
            for i, (dx, dy) in enumerate(offsets)]).alias("v"))

    rings = F.array(ring(0, HOLE_RING, 1), ring(1, SECOND_HOLE_RING, 2), ring(2, ZONE_RING_OFFSETS, 0),
                    ring(3, ISLAND_RING, 2), ring(4, SECOND_RING, 2))
    key = F.col("locationid")
    return (zone_attrs_view(spark, sf_dir)
            .select("locationid", ((key % 5).cast("double") * 2).alias("x0"),
                    (F.floor(key / 5).cast("double") * 2).alias("y0"), F.inline(rings))
            .where(key % 3 >= F.col("least"))
            .select("locationid", "ring", "x0", "y0", F.explode("v").alias("v"))
            .select("locationid", "ring", F.col("v.seq").alias("seq"),
                    (F.col("x0") + F.col("v.dx")).alias("x"), (F.col("y0") + F.col("v.dy")).alias("y")))


def wkt_text_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A layer of zone texts, one per zone, some damaged."""
    key = F.col("locationid")
    wkt = F.lit("POLYGON ((0 0, 1 0, 1 1, 0 0))")
    for rest, text in WKT_DAMAGE.items():
        wkt = F.when(key % 11 == rest, F.lit(text)).otherwise(wkt)
    return zone_attrs_view(spark, sf_dir).select("locationid", wkt.alias("wkt"))


def damaged_ridership_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw ridership text with planted bad values: riders that are no
    number (n/a), too large or broken, times and latitudes that are none."""
    raw = read_table(spark, sf_dir, "events").where(F.col("event_type").isin(RIDER_EVENT_TYPES))
    eid, uid = F.col("event_id"), F.col("user_id")
    return raw.select(
        eid.cast("string").alias("event_id"),
        F.when(eid % 109 == 0, F.lit("13/45/2024 01:00:00 AM"))
         .otherwise(F.date_format("ts", "MM/dd/yyyy hh:mm:ss a")).alias("transit_timestamp"),
        F.when(eid % 101 == 0, F.lit("n/a")).when(eid % 103 == 0, F.lit("3000000000"))
         .when(eid % 107 == 0, F.lit("12.7")).when(eid % 127 == 0, F.lit(" "))
         .otherwise(F.floor("value").cast("bigint").cast("string")).alias("ridership"),
        F.when(eid % 113 == 0, F.lit("north")).otherwise(_station_lat(uid).cast("string")).alias("latitude"))
