"""Polygons of several parts: ring nesting, WKT in and out, GeoJSON out.

A zone is a set of rings. Which ring is a shell and which a hole follows from
how they lie in each other, not from their order or direction: a ring inside an
even number of the zone's other rings is a shell, any other a hole of the
smallest ring around it. That is asked of one point inside each ring, looked up
in a quadtree over all rings, so no two rings are paired. Written rings run as
GeoJSON and WKT want them: shells counter-clockwise, holes clockwise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from zonecast.functions.geometry import ring_edges
from zonecast.operators import quadtree
from zonecast.plans.strategy import materialize


def signed_area(edges: Column) -> Column:
    """Positive for a ring that runs counter-clockwise."""
    return F.aggregate(edges, F.lit(0.0), lambda a, e: a + (e["x1"] * e["y2"] - e["x2"] * e["y1"])) / 2


def rings(vertices: DataFrame) -> DataFrame:
    """One row per ring: locationid, ring, v (vertices in order), edges, bbox
    and area. A last vertex that repeats the first is dropped."""
    v = (vertices.groupBy("locationid", "ring")
         .agg(F.sort_array(F.collect_list(F.struct(
             "seq", F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y")))).alias("v")))
    first, last = F.col("v")[0], F.element_at("v", -1)
    closed = (F.size("v") > 1) & (first["x"] == last["x"]) & (first["y"] == last["y"])
    v = v.withColumn("v", F.when(closed, F.slice("v", 1, F.size("v") - 1)).otherwise(F.col("v")))
    v = v.withColumn("edges", ring_edges(F.col("v")))
    xs, ys = F.transform("v", lambda p: p["x"]), F.transform("v", lambda p: p["y"])
    return v.select("locationid", "ring", "v", "edges", signed_area(F.col("edges")).alias("area"),
                    F.array_min(xs).alias("xmin"), F.array_max(xs).alias("xmax"),
                    F.array_min(ys).alias("ymin"), F.array_max(ys).alias("ymax"))


def _inner_point(df: DataFrame) -> DataFrame:
    """`df` with a point inside each ring: between the first two crossings of
    the line halfway between the ring's two lowest heights. (A vertex would
    not do: rings of one polygon may touch there.)"""
    heights = F.array_sort(F.array_distinct(F.transform("v", lambda p: p["y"])))
    df = df.withColumn("_ys", heights).withColumn(
        "_iy", (F.get("_ys", F.lit(0)) + F.coalesce(F.get("_ys", F.lit(1)), F.get("_ys", F.lit(0)))) / 2)
    hit = F.filter("edges", lambda e: (e["y1"] > F.col("_iy")) != (e["y2"] > F.col("_iy")))
    df = df.withColumn("_xs", F.array_sort(F.transform(
        hit, lambda e: (e["x2"] - e["x1"]) * (F.col("_iy") - e["y1"]) / (e["y2"] - e["y1"]) + e["x1"])))
    flat = F.col("v")[0]["x"]           # a ring without height has no inside
    return df.withColumn("_ix", F.coalesce((F.get("_xs", F.lit(0)) + F.get("_xs", F.lit(1))) / 2, flat)).drop(
        "_ys", "_xs")


def ring_parts(vertices: DataFrame, broadcast: bool | None = None) -> DataFrame:
    """One row per ring: locationid, ring, part (shells of a zone from 0, in
    ring order; a hole has its shell's), hole, depth (rings around it), area
    and v, in the direction to write."""
    table = materialize(_inner_point(rings(vertices)))
    shapes = table.select(F.struct("locationid", F.abs("area").alias("size"), "ring").alias("id"),
                          "edges", "xmin", "xmax", "ymin", "ymax")
    tree = quadtree.build(shapes, "id")
    around = quadtree.containing(table, tree, "_ix", "_iy", "_around", broadcast=broadcast)
    # rings inside this one may hold the point as well: only larger ones count
    # (of equal rings the one with the lower number is the outer one)
    own = F.abs("area")
    around = around.withColumn("_around", F.filter("_around", lambda r: (
        r["locationid"] == F.col("locationid")) & ((r["size"] > own) | (
            (r["size"] == own) & (r["ring"] < F.col("ring"))))))
    # sorted by size: the first of the rings around is the one just around
    told = materialize(around.select(
        "locationid", "ring", "v", "area", F.size("_around").alias("depth"),
        (F.size("_around") % 2 == 1).alias("hole"), F.get("_around", F.lit(0))["ring"].alias("_parent")))
    numbered = told.where(~F.col("hole")).select("locationid", F.col("ring").alias("_shell"), (
        F.row_number().over(W.partitionBy("locationid").orderBy("ring")) - 1).alias("part"))
    shell = F.when(F.col("hole"), F.col("_parent")).otherwise(F.col("ring"))
    out = told.withColumn("_shell", shell).join(numbered, ["locationid", "_shell"])
    turned = F.concat(F.slice("v", 1, 1), F.reverse(F.slice("v", 2, F.greatest(F.size("v") - 1, F.lit(0)))))
    wrong = (F.col("area") < 0) != F.col("hole")
    return out.select("locationid", "ring", "part", "hole", "depth", "area",
                      F.when(wrong, turned).otherwise(F.col("v")).alias("v"))


def zone_polygons(vertices: DataFrame) -> DataFrame:
    """(locationid, polygons): per part its shell and then its holes, rings
    closed, as array<polygon array<ring array<point array<double>>>>."""
    points = F.transform(F.concat("v", F.slice("v", 1, 1)), lambda p: F.array(p["x"], p["y"]))
    parts = (ring_parts(vertices).select("locationid", "part", "hole", "ring", points.alias("points"))
             .groupBy("locationid", "part")
             .agg(F.sort_array(F.collect_list(F.struct("hole", "ring", "points"))).alias("r")))
    return (parts.select("locationid", "part", F.transform("r", lambda s: s["points"]).alias("rings"))
            .groupBy("locationid").agg(F.sort_array(F.collect_list(F.struct("part", "rings"))).alias("p"))
            .select("locationid", F.transform("p", lambda s: s["rings"]).alias("polygons")))


# --- K6: GeoJSON lines ------------------------------------------------------

def zone_features(vertices: DataFrame, attrs: DataFrame) -> DataFrame:
    """One GeoJSON Feature (a JSON string, encoded once) per zone:
    (locationid, feature). A zone of one part is a Polygon, any other a
    MultiPolygon."""
    zones = zone_polygons(vertices).join(attrs, "locationid")

    def feature(kind: str, coordinates: Column) -> Column:
        return F.to_json(F.struct(
            F.lit("Feature").alias("type"), F.struct("locationid", "borough", "zone").alias("properties"),
            F.struct(F.lit(kind).alias("type"), coordinates.alias("coordinates")).alias("geometry")))

    one = F.size("polygons") == 1
    return zones.select("locationid", F.when(one, feature("Polygon", F.col("polygons")[0])).otherwise(
        feature("MultiPolygon", F.col("polygons"))).alias("feature"))


def _feature_schema(depth: int) -> str:
    return ("struct<type:string, properties:struct<locationid:bigint, borough:string, zone:string>,"
            f" geometry:struct<type:string, coordinates:{'array<' * depth}double{'>' * depth}>>")


def parse_features(lines: DataFrame, col: str = "value") -> DataFrame:
    """GeoJSON feature lines back in typed columns: the attributes,
    feature_type, geometry_type, polygons (one per part) and, for a Polygon,
    its rings as coordinates."""
    multi = F.get_json_object(col, "$.geometry.type") == "MultiPolygon"
    both = lines.select(F.from_json(col, _feature_schema(3)).alias("p"),
                        F.when(multi, F.from_json(col, _feature_schema(4))).alias("m"))
    rings_of = F.col("p.geometry.coordinates")
    polygons = F.when(F.col("m").isNotNull(), F.col("m.geometry.coordinates")).otherwise(F.array(rings_of))
    return both.select(
        *[F.coalesce(f"m.properties.{c}", f"p.properties.{c}").alias(c) for c in ("locationid", "borough", "zone")],
        F.coalesce("m.type", "p.type").alias("feature_type"),
        F.coalesce("m.geometry.type", "p.geometry.type").alias("geometry_type"),
        F.when(F.col("m").isNull(), rings_of).alias("coordinates"), polygons.alias("polygons"))


# --- A8: WKT ----------------------------------------------------------------

def to_wkt(vertices: DataFrame) -> DataFrame:
    """(locationid, wkt): POLYGON for one part, else MULTIPOLYGON."""
    def text(items: Column, one) -> Column:
        return F.concat(F.lit("("), F.array_join(F.transform(items, one), ", "), F.lit(")"))

    def ring(r: Column) -> Column:
        return text(r, lambda p: F.concat(p[0].cast("string"), F.lit(" "), p[1].cast("string")))

    zones = zone_polygons(vertices)
    single = F.concat(F.lit("POLYGON "), text(F.col("polygons")[0], ring))
    several = F.concat(F.lit("MULTIPOLYGON "), text(F.col("polygons"), lambda p: text(p, ring)))
    return zones.select("locationid", F.when(F.size("polygons") == 1, single).otherwise(several).alias("wkt"))


# Why a text is no polygon.
REASONS = ("missing", "not a polygon", "unbalanced", "not a number", "too few points", "not closed")


def read_wkt(rows: DataFrame, wkt: str = "wkt") -> DataFrame:
    """`rows` with `polygons`, array<part array<ring array<struct<x, y>>>>, and
    `problem`: NULL for a POLYGON or MULTIPOLYGON (EMPTY has no parts), else
    one of `REASONS`. Rings come without their closing vertex; Z and M values
    are passed over. Upper and lower case, and white space, do not matter."""
    flat = F.trim(F.regexp_replace(F.upper(F.col(wkt)), r"\s+", " "))
    flat = F.regexp_replace(flat, r" ?([(),]) ?", "$1")
    kind = F.regexp_extract("_flat", r"^(MULTIPOLYGON|POLYGON)(?: Z| M| ZM)?(?:\(| ?EMPTY$)", 1)
    body = F.regexp_replace("_flat", r"^[A-Z ]*", "")
    df = rows.withColumn("_flat", flat).withColumn("_kind", kind).withColumn("_body", body)
    # one part is written as the only part of several
    df = df.withColumn("_body", F.when(F.col("_kind") == "POLYGON", F.concat(F.lit("("), "_body", F.lit(")")))
                       .otherwise(F.col("_body")))
    empty = F.col("_flat").endswith("EMPTY")
    whole = F.col("_body").startswith("(((") & F.col("_body").endswith(")))")
    inner = F.expr("substring(_body, 4, length(_body) - 6)")

    def numbers(point: Column) -> Column:
        return F.transform(F.split(point, " "), lambda n: n.try_cast("double"))

    def cut(text: Column, at: str, one) -> Column:
        return F.transform(F.split(text, at), one)

    raw = cut(inner, r"\)\),\(\(", lambda part: cut(part, r"\),\(", lambda r: cut(r, ",", numbers)))
    df = df.withColumn("_raw", F.when(whole & ~empty, raw))

    def every(test) -> Column:
        return F.forall("_raw", lambda part: F.forall(part, test))

    def numeric(r: Column) -> Column:
        return F.forall(r, lambda p: F.size(p).between(2, 4) & F.forall(
            p, lambda n: n.isNotNull() & ~F.isnan(n) & (F.abs(n) < float("inf"))))

    def closes(r: Column) -> Column:
        return (r[0][0] == F.element_at(r, -1)[0]) & (r[0][1] == F.element_at(r, -1)[1])

    # a piece with a parenthesis left in it is no number either
    balanced = F.length(F.replace("_flat", F.lit("("), F.lit(""))) == F.length(
        F.replace("_flat", F.lit(")"), F.lit("")))
    problem = (F.when(F.col(wkt).isNull(), REASONS[0]).when(F.col("_kind") == "", REASONS[1])
               .when(empty, F.lit(None)).when(~whole | ~balanced, REASONS[2])
               .when(~every(numeric), REASONS[3]).when(~every(lambda r: F.size(r) >= 4), REASONS[4])
               .when(~every(closes), REASONS[5]))
    df = df.withColumn("problem", problem)
    points = F.transform("_raw", lambda part: F.transform(part, lambda r: F.transform(
        F.slice(r, 1, F.size(r) - 1), lambda p: F.struct(p[0].alias("x"), p[1].alias("y")))))
    kind_of = "array<array<array<struct<x:double,y:double>>>>"
    out = F.when(F.col("problem").isNotNull(), F.lit(None).cast(kind_of)).when(
        F.col("_raw").isNull(), F.array().cast(kind_of)).otherwise(points)
    return df.withColumn("polygons", out).drop("_flat", "_kind", "_body", "_raw")


def wkt_vertices(parsed: DataFrame, id_col: str = "locationid") -> DataFrame:
    """The vertex table (locationid, part, ring, seq, x, y) of what
    `read_wkt` read; rings of a zone are numbered over its parts."""
    parts = parsed.where("problem IS NULL").select(
        F.col(id_col).alias("locationid"), "polygons", F.posexplode("polygons").alias("part", "_rings"))
    before = F.aggregate(F.slice("polygons", 1, F.col("part")), F.lit(0), lambda n, p: n + F.size(p))
    rings_ = parts.select("locationid", "part", before.alias("_before"),
                          F.posexplode("_rings").alias("_r", "_points"))
    return (rings_.select("locationid", "part", (F.col("_before") + F.col("_r")).alias("ring"),
                          F.posexplode("_points").alias("seq", "_p"))
            .select("locationid", "part", "ring", "seq", "_p.x", "_p.y"))
