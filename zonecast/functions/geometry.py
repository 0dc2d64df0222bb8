"""Geometry as column expressions: points (P11), ring edges, the even-odd
crossing test used by the point-in-zone join (J4), and the Lambert conformal
conic projection (P12). No geometry library, no UDF: everything stays inside
whole-stage codegen as built-in math and higher-order functions.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def point(lon: Column | str, lat: Column | str) -> Column:
    """A point as struct(lon, lat), both double."""
    lo = F.col(lon) if isinstance(lon, str) else lon
    la = F.col(lat) if isinstance(lat, str) else lat
    return F.struct(lo.cast("double").alias("lon"), la.cast("double").alias("lat"))


def ring_edges(verts: Column) -> Column:
    """Edges of one ring from its vertex array (sorted by seq): each vertex is
    paired with the next, the last with the first. Output
    array<struct<x1,y1,x2,y2>>."""
    n = F.size(verts)
    return F.transform(verts, lambda v, i: F.struct(
        v["x"].alias("x1"), v["y"].alias("y1"),
        verts[(i + 1) % n]["x"].alias("x2"), verts[(i + 1) % n]["y"].alias("y2")))


def crossings(edges: Column, px: Column, py: Column) -> Column:
    """Number of edges a ray from (px, py) towards +x crosses (half-open rule:
    an edge counts when exactly one end lies strictly above py)."""
    def step(acc: Column, e: Column) -> Column:
        straddles = (e["y1"] > py) != (e["y2"] > py)
        x_at = (e["x2"] - e["x1"]) * (py - e["y1"]) / (e["y2"] - e["y1"]) + e["x1"]
        # CASE keeps the division behind the straddle test (y1 != y2 there).
        return acc + F.when(straddles, F.when(px < x_at, 1).otherwise(0)).otherwise(0)
    return F.aggregate(edges, F.lit(0), step)


def inside(edges: Column, px: Column, py: Column) -> Column:
    """Even-odd containment: odd crossing count."""
    return crossings(edges, px, py) % 2 == 1


# --- P12: Lambert conformal conic (two standard parallels, ellipsoid) ------
# Formulae from Snyder, "Map Projections: A Working Manual" (USGS PP 1395,
# 1987), section 15. The constants n, F, rho0 depend only on the parameters and
# are computed once in Python; per-vertex work is column math.

@dataclass(frozen=True)
class LambertConic:
    lat1: float                     # standard parallels, degrees
    lat2: float
    lat0: float                     # latitude of origin, degrees
    lon0: float                     # central meridian, degrees
    false_easting: float = 0.0      # in projected units
    false_northing: float = 0.0
    a: float = 6378137.0            # semi-major axis, metres
    inv_f: float = 298.257222101    # inverse flattening
    unit: float = 1.0               # metres per projected unit
    iterations: int = 6             # fixed-point steps for latitude

    @property
    def e(self) -> float:
        f = 1.0 / self.inv_f
        return math.sqrt(2 * f - f * f)

    def _m(self, phi: float) -> float:
        return math.cos(phi) / math.sqrt(1 - (self.e * math.sin(phi)) ** 2)

    def _t(self, phi: float) -> float:
        es = self.e * math.sin(phi)
        return math.tan(math.pi / 4 - phi / 2) / ((1 - es) / (1 + es)) ** (self.e / 2)

    def constants(self) -> tuple[float, float, float]:
        p1, p2, p0 = (math.radians(v) for v in (self.lat1, self.lat2, self.lat0))
        m1, m2 = self._m(p1), self._m(p2)
        t1, t2, t0 = self._t(p1), self._t(p2), self._t(p0)
        n = (math.log(m1) - math.log(m2)) / (math.log(t1) - math.log(t2))
        big_f = m1 / (n * t1 ** n)
        rho0 = self.a * big_f * t0 ** n
        return n, big_f, rho0


# EPSG 2263 (NAD83 / New York Long Island, US survey feet), the
# projection the city's zone polygons are commonly published in. The source
# CRS of the surveyed polygon layer is not recorded, so this is only a
# default; callers pass their own parameters.
NY_LONG_ISLAND_FTUS = LambertConic(
    lat1=41.03333333333333, lat2=40.66666666666666, lat0=40.16666666666666,
    lon0=-74.0, false_easting=984250.0, false_northing=0.0,
    unit=1200.0 / 3937.0)


def lcc_inverse(df: DataFrame, x: str, y: str, p: LambertConic,
                lon_out: str = "lon", lat_out: str = "lat") -> DataFrame:
    """Projected (x, y) -> (lon, lat) in degrees, appended to `df`.

    Latitude solves phi = pi/2 - 2 atan(t * ((1 - e sin phi)/(1 + e sin phi))^(e/2))
    with a fixed number of fixed-point steps. Each step is its own projected
    column (Catalyst does not collapse projects that would duplicate
    non-trivial expressions), so the plan stays linear in the step count."""
    n, big_f, rho0 = p.constants()
    e = p.e
    sgn = 1.0 if n >= 0 else -1.0
    dx = (F.col(x) - F.lit(p.false_easting)) * F.lit(p.unit)
    dy = F.lit(rho0) - (F.col(y) - F.lit(p.false_northing)) * F.lit(p.unit)
    rho = F.lit(sgn) * F.sqrt(dx * dx + dy * dy)
    out = df.withColumns({
        "_lcc_t": F.pow(rho / F.lit(p.a * big_f), F.lit(1.0 / n)),
        lon_out: F.degrees(F.atan2(F.lit(sgn) * dx, F.lit(sgn) * dy) / F.lit(n))
                 + F.lit(p.lon0),
    })
    out = out.withColumn("_lcc_phi", F.lit(math.pi / 2) - 2 * F.atan(F.col("_lcc_t")))
    for _ in range(p.iterations):
        es = F.lit(e) * F.sin(F.col("_lcc_phi"))
        out = out.withColumn("_lcc_phi", F.lit(math.pi / 2) - 2 * F.atan(
            F.col("_lcc_t") * F.pow((1 - es) / (1 + es), F.lit(e / 2))))
    return out.withColumn(lat_out, F.degrees("_lcc_phi")).drop("_lcc_t", "_lcc_phi")


def lcc_forward(lon: Column, lat: Column, p: LambertConic) -> tuple[Column, Column]:
    """(lon, lat) degrees -> projected (x, y); used to check round trips."""
    n, big_f, rho0 = p.constants()
    e = p.e
    phi = F.radians(lat)
    es = F.lit(e) * F.sin(phi)
    t = F.tan(F.lit(math.pi / 4) - phi / 2) / F.pow((1 - es) / (1 + es), F.lit(e / 2))
    rho = F.lit(p.a * big_f) * F.pow(t, F.lit(n))
    theta = F.lit(n) * F.radians(lon - F.lit(p.lon0))
    x = (rho * F.sin(theta)) / F.lit(p.unit) + F.lit(p.false_easting)
    y = (F.lit(rho0) - rho * F.cos(theta)) / F.lit(p.unit) + F.lit(p.false_northing)
    return x, y
