"""A quadtree over polygon edges, and points looked up in it.

The root cell covers the layer. While a cell holds more than `max_edges` edges
it is cut in four, level by level, each edge going only to the cells that it
reaches (edges that lie on each other are left together after `FUTILE_CUTS`). So a cell is small where the layer is dense, and the work per point is
bounded by `max_edges`, whatever the size or number of the polygons.

What a point needs to know of a polygon, from its cell alone: the polygon
contains it when a ray to +x crosses an odd number of edges. Seen from any
point of the cell an edge is one of

* left of the cell, or above or below it: never crossed;
* right of the cell at all its heights: crossed at the heights from its lower
  to its upper end, whatever the point's x. Two such edges that follow each
  other share an end, which cancels out, so of a long outline to the right only
  a few heights are left where the parity changes: `turns`, and `odd`, the
  parity of those below the cell;
* near: kept as an edge and tested exactly.

So a polygon is `odd`, `turns` and `edges` per cell, all from the cell above,
and containment is exactly that of the whole outline, to the last bit.

Cells of one tree do not overlap, and each has one row with its polygons. A
point computes its cell on each level that has leaves (a few numbers) and meets
its leaf by an equi join: broadcast when the leaves pass a check of their size,
else shuffled. For the shuffle equal points are looked up once, a crowded cell
is dealt out by the points' coordinates, and the answers go back by
coordinates, those of crowded places by broadcast.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonecast.functions.geometry import crossings
from zonecast.plans.strategy import materialize

LEAF_EDGES = 64
MAX_LEVEL = 20
BROADCAST_EDGES = 2_000_000     # edges and turns of all leaves: 32 bytes each, 64 MB
BROADCAST_LEAVES = 500_000      # and their rows
MANY_TURNS = 1000
FUTILE_CUTS = 3                 # cuts in a row that may leave a cell as full as before
DIRECT_CHECKS = 2_000_000       # edges held against cells before the first level
SALTS = 32                      # tasks that a crowded cell is dealt to
CROWDED_PLACES = 1000           # equal points from a thousandth of all are crowded

OUTSIDE = -1                    # cell of points outside the root, or without place


@dataclass(frozen=True)
class Quadtree:
    """leaves: cell (long), candidates array<struct<id, odd, turns, edges>>."""
    leaves: DataFrame
    x0: float
    y0: float
    side: float
    levels: tuple[int, ...]     # those that have leaves
    n_leaves: int
    n_edges: int                # edges and turns of all leaves

    @property
    def small(self) -> bool:
        return self.n_edges <= BROADCAST_EDGES and self.n_leaves <= BROADCAST_LEAVES

    def cell(self, level: int, px: Column, py: Column) -> Column:
        scale = F.lit(2.0 ** level / self.side)
        last = F.lit(2 ** level - 1).cast("long")

        def step(p: Column, start: float) -> Column:
            return F.least(F.greatest(F.floor((p - F.lit(start)) * scale), F.lit(0).cast("long")), last)

        return cell_code(F.lit(level), step(px, self.x0), step(py, self.y0))

    def within(self, px: Column, py: Column) -> Column:
        """False, too, where there is no place."""
        ok = ((px >= self.x0) & (px < self.x0 + self.side)
              & (py >= self.y0) & (py < self.y0 + self.side))
        return F.coalesce(ok, F.lit(False))

    def cells(self, px: Column, py: Column) -> Column:
        """The cells that a point may have its leaf in; exactly one is a leaf."""
        outside = F.array(F.lit(OUTSIDE).cast("long"))
        if not self.levels:
            return outside
        return F.when(self.within(px, py), F.array(*[self.cell(v, px, py) for v in self.levels])).otherwise(outside)


def cell_code(level: Column, cx: Column, cy: Column) -> Column:
    """level, cx and cy in one long (cx, cy < 2^20)."""
    return (F.shiftleft(level.cast("long"), 40).bitwiseOR(F.shiftleft(cx.cast("long"), 20))
            .bitwiseOR(cy.cast("long")))


def _root(shapes: DataFrame) -> tuple[float, float, float, int]:
    """A square a little larger than the layer, and the layer's edges."""
    b = shapes.agg(F.min("xmin").alias("x0"), F.min("ymin").alias("y0"),
                   F.max("xmax").alias("x1"), F.max("ymax").alias("y1"),
                   F.sum(F.size("edges").cast("long")).alias("n")).first()
    if b["x0"] is None:
        return 0.0, 0.0, 1.0, 0
    size = max(b["x1"] - b["x0"], b["y1"] - b["y0"]) or max(abs(b["x0"]), abs(b["y0"]), 1.0)
    return b["x0"] - size / 64, b["y0"] - size / 64, size * (1 + 1 / 32), b["n"]


def _first_level(n_edges: int, max_edges: int, max_level: int) -> int:
    """The level that evenly spread edges would need, or the deepest that all
    edges can be held against each cell of with `DIRECT_CHECKS` tests."""
    level = 0
    while (level < max_level and n_edges > max_edges * 4 ** level
           and n_edges * 4 ** (level + 1) <= DIRECT_CHECKS):
        level += 1
    return level


def _seen_from(cells: DataFrame, x0: float, y0: float, side: float) -> DataFrame:
    """`cells` (id, level, cx, cy, odd, turns, edges of the cell above) with
    odd, turns and edges of the cell itself. Its bounds are widened by a
    trace, so that a point that rounding puts into it sees all it needs."""
    width = F.lit(side) / F.pow(F.lit(2.0), F.col("level"))
    trace = F.lit(side * 2.0 ** -40)
    df = cells.withColumns({
        "_xl": F.lit(x0) + F.col("cx") * width - trace, "_xh": F.lit(x0) + (F.col("cx") + 1) * width + trace,
        "_yl": F.lit(y0) + F.col("cy") * width - trace, "_yh": F.lit(y0) + (F.col("cy") + 1) * width + trace})

    def kind(e: Column) -> Column:
        low, high = F.least(e["y1"], e["y2"]), F.greatest(e["y1"], e["y2"])

        def at(y: Column) -> Column:
            return (e["x2"] - e["x1"]) * (y - e["y1"]) / (e["y2"] - e["y1"]) + e["x1"]

        # x where the edge enters and leaves the cell's heights
        a, b = at(F.greatest(low, F.col("_yl"))), at(F.least(high, F.col("_yh")))
        return (F.when((low == high) | (high < F.col("_yl")) | (low > F.col("_yh")), "none")
                .when(F.greatest(a, b) + trace < F.col("_xl"), "none")
                .when(F.least(a, b) - trace > F.col("_xh"), "right").otherwise("near"))

    df = df.withColumn("_kind", F.transform("edges", kind))

    def follows(e: Column, f: Column) -> Column:
        return F.coalesce((e["x2"] == f["x1"]) & (e["y2"] == f["y1"]), F.lit(False))

    def ends(e: Column, i: Column) -> Column:
        before, after = F.get("edges", i - 1), F.get("edges", i + 1)
        joined = (F.get("_kind", i - 1) == "right") & follows(before, e)
        goes_on = (F.get("_kind", i + 1) == "right") & follows(e, after)
        none = F.array().cast("array<double>")
        own = F.concat(F.when(F.coalesce(joined, F.lit(False)), none).otherwise(F.array(e["y1"])),
                       F.when(F.coalesce(goes_on, F.lit(False)), none).otherwise(F.array(e["y2"])))
        return F.when(F.get("_kind", i) == "right", own).otherwise(none)

    df = df.withColumn("_turns", F.concat("turns", F.flatten(F.transform("edges", ends))))
    df = df.withColumn("_within", F.filter("_turns", lambda t: (t > F.col("_yl")) & (t <= F.col("_yh"))))
    # equal heights cancel out in pairs (left as they are where there are many:
    # they do no harm)
    single = F.filter(F.array_distinct("_within"), lambda t: F.size(F.filter("_within", lambda u: u == t)) % 2 == 1)
    return df.select(
        *[c for c in cells.columns if c not in ("odd", "turns", "edges")],
        (F.col("odd") != (F.size(F.filter("_turns", lambda t: t <= F.col("_yl"))) % 2 == 1)).alias("odd"),
        F.when(F.size("_within") <= MANY_TURNS, single).otherwise(F.col("_within")).alias("turns"),
        F.filter("edges", lambda _, i: F.get("_kind", i) == "near").alias("edges"))


def build(shapes: DataFrame, id_col: str = "locationid", max_edges: int = LEAF_EDGES,
          max_level: int = MAX_LEVEL) -> Quadtree:
    """The tree over `shapes` (id, edges, xmin, xmax, ymin, ymax; see
    `spatial.zone_shapes`). Each level is one job over the cells still to be
    cut, written to the shared folder, and one over what they hold."""
    x0, y0, side, n = _root(shapes)
    if not n:                                       # no polygons: no leaf
        return Quadtree(_outside(shapes, id_col), x0, y0, side, (), 0, 0)
    level = _first_level(n, max_edges, max_level)
    steps = F.sequence(F.lit(0).cast("long"), F.lit(2 ** level - 1).cast("long"))
    open_cells = (shapes.select(F.col(id_col).alias("id"), "edges", F.explode(steps).alias("cx"))
                  .select("id", F.lit(level).alias("level"), "cx", F.explode(steps).alias("cy"),
                          F.lit(2 ** 60).cast("long").alias("above"), F.lit(0).alias("futile"),
                          F.lit(False).alias("odd"), F.array().cast("array<double>").alias("turns"), "edges"))
    quarter = F.explode(F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"))
                                  for a in (0, 1) for b in (0, 1)])).alias("q")
    load = F.size("edges") + F.size("turns")
    done: list[DataFrame] = []
    levels: list[int] = []
    n_leaves = n_edges = 0
    while True:
        # one row per polygon and cell; a polygon that a cell knows nothing of
        # keeps its row there, so that empty cells are leaves like any other
        cells = materialize(_seen_from(open_cells, x0, y0, side))
        held = cells.groupBy("cx", "cy").agg(F.sum(load).alias("_load"), F.max("above").alias("above"),
                                             F.max("futile").alias("futile"))
        # edges that lie on each other, or meet in a point, cannot be cut apart
        held = held.withColumn("futile", F.when(F.col("_load") * 4 > F.col("above") * 3, F.col("futile") + 1)
                               .otherwise(0))
        cut = (F.col("_load") > max_edges) & (F.col("futile") < FUTILE_CUTS) & F.lit(level < max_level)
        got = held.agg(F.count_if(cut).alias("cut"), F.count_if(~cut).alias("leaves"),
                       F.sum(F.when(~cut, F.col("_load"))).alias("n")).first()
        if got["leaves"]:
            levels.append(level)
            n_leaves += got["leaves"]
            n_edges += got["n"]
        if not got["cut"]:
            done.append(cells)
            break
        heavy = held.where(cut).select("cx", "cy", F.col("_load").alias("_above"), F.col("futile").alias("_futile"))
        if got["cut"] <= BROADCAST_LEAVES:          # two longs each
            heavy = F.broadcast(heavy)
        if got["leaves"]:
            done.append(cells.join(heavy, ["cx", "cy"], "left_anti"))
        level += 1
        open_cells = (cells.join(heavy, ["cx", "cy"])
                      .select("id", "cx", "cy", "_above", "_futile", "odd", "turns", "edges", quarter)
                      .select("id", F.lit(level).alias("level"), (F.col("cx") * 2 + F.col("q.a")).alias("cx"),
                              (F.col("cy") * 2 + F.col("q.b")).alias("cy"), F.col("_above").alias("above"),
                              F.col("_futile").alias("futile"), "odd", "turns", "edges"))
    rows = done[0].select(*cells.columns)
    for more in done[1:]:
        rows = rows.unionByName(more)
    known = F.col("odd") | (load > 0)
    leaves = (rows.groupBy(cell_code(F.col("level"), F.col("cx"), F.col("cy")).alias("cell"))
              .agg(F.collect_list(F.when(known, F.struct("id", "odd", "turns", "edges"))).alias("candidates")))
    return Quadtree(leaves.unionByName(_outside(shapes, id_col)), x0, y0, side, tuple(levels),
                    n_leaves, n_edges)


def _outside(shapes: DataFrame, id_col: str) -> DataFrame:
    """The row that points outside the root meet: no candidates."""
    fields = {f.name: f.dataType.simpleString() for f in shapes.schema.fields}
    kind = (f"array<struct<id:{fields[id_col]},odd:boolean,turns:array<double>,"
            f"edges:{fields['edges']}>>")
    return shapes.sparkSession.range(1).select(F.lit(OUTSIDE).cast("long").alias("cell"),
                                               F.array().cast(kind).alias("candidates"))


def holders(px: Column, py: Column) -> Column:
    """Ids of the candidates that contain the point, in any order."""
    def holds(c: Column) -> Column:
        turned = F.size(F.filter(c["turns"], lambda t: t <= py)) + crossings(c["edges"], px, py)
        return c["odd"] != (turned % 2 == 1)

    return F.transform(F.filter("candidates", holds), lambda c: c["id"])


def _looked_up(points: DataFrame, tree: Quadtree, px: Column, py: Column, out: str,
               answer, broadcast: bool) -> DataFrame:
    """`points` with `answer` of the ids that hold each; every point meets
    exactly one leaf."""
    rows = points.withColumn("_cell", F.explode(tree.cells(px, py)))
    leaves = tree.leaves.withColumnRenamed("cell", "_cell")
    if broadcast:
        joined = rows.join(F.broadcast(leaves), "_cell")
    else:
        # dealt by coordinates, which differ: a crowded cell goes to many tasks
        rows = rows.withColumn("_salt", F.pmod(F.xxhash64(px, py), F.lit(SALTS)).cast("int"))
        leaves = leaves.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        joined = rows.join(leaves, ["_cell", "_salt"]).drop("_salt")
    return joined.withColumn(out, answer(holders(px, py))).drop("_cell", "candidates")


def containing(points: DataFrame, tree: Quadtree, x: str, y: str, out: str,
               answer=F.array_sort, broadcast: bool | None = None) -> DataFrame:
    """`points` with `out`: `answer` of the ids of all polygons that contain
    (x, y). Points without a place, or outside the layer, get the answer of no
    ids."""
    if broadcast is None:
        broadcast = tree.small
    px, py = F.col(x).cast("double"), F.col(y).cast("double")
    if broadcast:
        return _looked_up(points, tree, px, py, out, answer, True)
    nothing = answer(F.array().cast(f"array<{_id_type(tree)}>"))
    inside = tree.within(px, py)
    # -0.0 joins 0.0: their bits differ, their place does not
    place = {"_px": px + F.lit(0.0), "_py": py + F.lit(0.0)}
    there = points.where(inside).withColumns(place)
    seen = there.groupBy("_px", "_py").agg(F.count(F.lit(1)).alias("_n"))
    found = materialize(_looked_up(seen, tree, F.col("_px"), F.col("_py"), out, answer, False))
    total = found.agg(F.sum("_n")).first()[0] or 0
    # at most CROWDED_PLACES places hold a thousandth of all points each
    crowded = F.col("_n") > F.lit(math.ceil(total / CROWDED_PLACES))
    hot = found.where(crowded).drop("_n").withColumn("_hot", F.lit(True))
    marked = there.join(F.broadcast(hot), ["_px", "_py"], "left")
    quick = marked.where("_hot").drop("_hot", "_px", "_py")
    rest = (marked.where(F.col("_hot").isNull()).drop("_hot", out)
            .join(found.where(~crowded).drop("_n"), ["_px", "_py"]).drop("_px", "_py"))
    return (quick.select(*points.columns, out).unionByName(rest.select(*points.columns, out))
            .unionByName(points.where(~inside).withColumn(out, nothing)))


def _id_type(tree: Quadtree) -> str:
    return tree.leaves.schema["candidates"].dataType.elementType["id"].dataType.simpleString()
