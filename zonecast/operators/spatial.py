"""Polygons and the point-in-zone join.

Zones arrive as a vertex table (locationid, ring, seq, x, y), one or more
rings a zone. One row per zone carries its edge array and bounding box; the
even-odd rule makes holes and several parts of a zone come out right without
telling them apart (`polygons` tells them apart where they are written).

The point-in-zone join looks points up in a quadtree over all edges (see
`quadtree`): each point meets exactly one leaf row, no pairs are regrouped and
nothing is a nested loop. The lowest zone id wins (documented choice for
overlapping zones); a point in no zone keeps NULL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonecast.functions.geometry import ring_edges
from zonecast.operators import quadtree


def zone_shapes(vertices: DataFrame) -> DataFrame:
    """One row per zone: `edges` array<struct<x1,y1,x2,y2>> over all rings
    (even-odd handles holes and multipart zones) and the bbox."""
    rings = (vertices
             .select("locationid", "ring", "seq", F.col("x").cast("double").alias("x"),
                     F.col("y").cast("double").alias("y"))
             .groupBy("locationid", "ring")
             .agg(F.sort_array(F.collect_list(F.struct("seq", "x", "y"))).alias("v"),
                  F.min("x").alias("xmin"), F.max("x").alias("xmax"),
                  F.min("y").alias("ymin"), F.max("y").alias("ymax")))
    return (rings.select("locationid", ring_edges(F.col("v")).alias("edges"),
                         "xmin", "xmax", "ymin", "ymax")
            .groupBy("locationid")
            .agg(F.flatten(F.collect_list("edges")).alias("edges"),
                 F.min("xmin").alias("xmin"), F.max("xmax").alias("xmax"),
                 F.min("ymin").alias("ymin"), F.max("ymax").alias("ymax")))


def polygon_edges(vertices: DataFrame) -> DataFrame:
    """A8 as a flat table: (locationid, x1, y1, x2, y2), one row per edge."""
    return (zone_shapes(vertices)
            .select("locationid", F.inline("edges")))


def assign_zone(points: DataFrame, shapes: DataFrame, x: str = "lon", y: str = "lat",
                out: str = "locationid", broadcast: bool | None = None,
                max_edges: int = quadtree.LEAF_EDGES) -> DataFrame:
    """Add `out` = the zone containing (x, y), NULL when none.

    `max_edges` is what a leaf of the zones' quadtree holds; the result does
    not depend on it, only the work per point does. `broadcast=None` decides
    by the size of the leaves; True/False force a strategy (both give the same
    rows)."""
    tree = quadtree.build(shapes, "locationid", max_edges)
    return quadtree.containing(points, tree, x, y, out, F.array_min, broadcast)


def point_tiles(points: DataFrame, x: str, y: str, tile_size: float) -> DataFrame:
    """P11 plus the tile index each point is routed by."""
    from zonecast.functions.geometry import point

    ts = F.lit(float(tile_size))
    return points.withColumns({
        "point": point(x, y),
        "tx": F.floor(F.col(x).cast("double") / ts),
        "ty": F.floor(F.col(y).cast("double") / ts),
    })
