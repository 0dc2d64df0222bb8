"""Regression trees with exact splits (M8, M9).

All trees of a call grow together, one level at a time. Per tree, node, feature
and distinct value Spark sums the labels (before the shuffle, so a node that
holds all rows ships a row per value and task); running sums over the values
score every cut between two neighbouring values, and the best cut of a node is
the level's result. No value is binned away and no row leaves Spark.

Running sums never pass one task whole: values lie in blocks, cut once at
quantiles of each feature; sums run inside a block, and over the blocks' sums.

Criteria:
* squared_error: the cut that leaves the least squared error around the means
  of both sides;
* friedman_mse: the cut with the greatest improvement, n_l n_r / n times the
  squared difference of the means;
* absolute_error: the cut that leaves the least absolute error around the
  medians of both sides. A side's absolute error is the area under
  min(rows below t, rows above t) over all label values t, so it takes the
  side's counts by label: those of the blocks before come as one row per label,
  those of the block itself are added value by value in a task. Its tasks hold
  the labels of one node times a few values, never a node's rows.

A node is cut unless its labels are all equal, its rows all agree in every
feature, it has fewer rows than `min_samples_split`, or it is as deep as
`max_depth`; a cut that gains nothing is still made, as the nodes below may
gain. Thresholds lie halfway between two values; rows at or below go left. Of
equally good cuts the feature named first wins, then the lower threshold. Leaves
predict the mean (the median for absolute_error).

The nodes are a table. Whether a node is cut does not depend on the grid's
other settings, so one growth per criterion and fold answers all depths and
minimum sizes: a row's prediction is that of the last node on its way that
these allow.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from zonecast.operators.models import LABEL, N_FOLDS, check_features
from zonecast.plans.strategy import materialize

CRITERIA = ("squared_error", "absolute_error", "friedman_mse")
BLOCKS = 128                # blocks of a feature's values
ABSOLUTE_BLOCKS = 32        # the same where each block comes with label counts
VALUES_AT_ONCE = 64         # values whose label counts a task holds at once
MAX_DEPTH = 60              # a node's place in its tree is a long
BROADCAST_NODES = 500_000   # of four numbers each: 16 MB
STAGE_EVERY = 4             # levels whose joins one plan carries


@dataclass(frozen=True)
class Trees:
    """nodes: tree, node (1, and 2 n, 2 n + 1 below n), depth, n, prediction,
    feature (place in `features`; NULL for a leaf), threshold."""
    nodes: DataFrame
    features: tuple[str, ...]
    depth: int
    n_nodes: int


def _checked(c: str) -> Column:
    x = F.col(c).cast("double")
    error = F.raise_error(F.lit(f"{c} is NULL or NaN")).cast("double")
    return F.when(x.isNull() | F.isnan(x), error).otherwise(x)


def _values(rows: DataFrame, features: Sequence[str]) -> DataFrame:
    """`rows` with _x, the features' values in order."""
    return rows.withColumn("_x", F.array(*[_checked(f) for f in features]))


def _cuts(rows: DataFrame, n_features: int, blocks: int) -> list[list[float]]:
    """Upper ends of each feature's blocks: quantiles of its values, each once."""
    at = [i / blocks for i in range(1, blocks)]
    got = rows.agg(*[F.percentile_approx(F.col("_x")[i], at, 1000).alias(f"c{i}")
                     for i in range(n_features)]).first()
    return [sorted(set(got[f"c{i}"] or [])) for i in range(n_features)]


def _small(df: DataFrame, n: int) -> DataFrame:
    return F.broadcast(df) if n <= BROADCAST_NODES else df


def _cells(rows: DataFrame, cuts: list[list[float]], by_label: bool) -> DataFrame:
    """Rows summed by tree, node, feature f, block b and value v (and label y)."""
    def block(i: int, ends: list[float]) -> Column:
        if not ends:
            return F.lit(0)
        return F.size(F.filter(F.array(*[F.lit(c) for c in ends]), lambda c: c < F.col("_x")[i]))

    each = F.inline(F.array(*[F.struct(F.lit(i).alias("f"), block(i, ends).alias("b"),
                                       F.col("_x")[i].alias("v")) for i, ends in enumerate(cuts)]))
    long = rows.select("tree", "node", "_y", each)
    if by_label:
        return long.groupBy("tree", "node", "f", "b", "v", F.col("_y").alias("y")).agg(
            F.count(F.lit(1)).alias("n"))
    return long.groupBy("tree", "node", "f", "b", "v").agg(F.count(F.lit(1)).alias("n"),
                                                           F.sum("_y").alias("s"))


def _best_by_means(rows: DataFrame, cuts: list[list[float]], friedman: Column) -> DataFrame:
    """The best cut of each node: tree, node, feature, threshold."""
    cells = _cells(rows, cuts, False)
    inside = W.partitionBy("tree", "node", "f", "b").orderBy("v")
    cells = cells.withColumns({
        "ln": F.sum("n").over(inside), "ls": F.sum("s").over(inside), "next": F.lead("v").over(inside),
        "last": F.row_number().over(W.partitionBy("tree", "node", "f", "b").orderBy(F.desc("v"))) == 1})
    # a block's last value carries the block's sums and meets the next block
    key = W.partitionBy("tree", "node", "f").orderBy("b")
    blocks = cells.groupBy("tree", "node", "f", "b").agg(
        F.sum("n").alias("bn"), F.sum("s").alias("bs"), F.min("v").alias("least"))
    past = key.rowsBetween(W.unboundedPreceding, -1)
    whole = W.partitionBy("tree", "node", "f")
    blocks = blocks.select(
        "tree", "node", "f", "b", F.coalesce(F.sum("bn").over(past), F.lit(0)).alias("pn"),
        F.coalesce(F.sum("bs").over(past), F.lit(0.0)).alias("ps"), F.lead("least").over(key).alias("then"),
        F.sum("bn").over(whole).alias("tn"), F.sum("bs").over(whole).alias("ts"))
    j = cells.join(blocks, ["tree", "node", "f", "b"]).select(
        "tree", "node", "f", "v", (F.col("ln") + F.col("pn")).cast("double").alias("ln"),
        (F.col("ls") + F.col("ps")).alias("ls"), F.col("tn").cast("double").alias("tn"), "ts",
        F.when(F.col("last"), F.col("then")).otherwise(F.col("next")).alias("next"))
    rn, rs = F.col("tn") - F.col("ln"), F.col("ts") - F.col("ls")
    apart = F.col("ls") / F.col("ln") - rs / rn
    score = F.when(friedman, F.col("ln") * rn / F.col("tn") * apart * apart).otherwise(
        F.col("ls") * F.col("ls") / F.col("ln") + rs * rs / rn)
    return _first(j.where("next IS NOT NULL").select("tree", "node", (-score).alias("loss"), "f",
                                                     _halfway(F.col("v"), F.col("next")).alias("t")))


def _halfway(a: Column, b: Column) -> Column:
    """Between a < b; a where rounding gives b."""
    m = (a + b) / 2
    return F.when(m >= b, a).otherwise(m)


def _first(scored: DataFrame) -> DataFrame:
    return (scored.groupBy("tree", "node").agg(F.min(F.struct("loss", "f", "t")).alias("m"))
            .select("tree", "node", F.col("m.f").alias("feature"), F.col("m.t").alias("threshold")))


def absolute_errors(labels: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """For each row of counts by (ascending) label: the sum of distances to
    its median."""
    below = np.cumsum(counts, axis=1)[:, :-1]
    return (np.minimum(below, counts.sum(axis=1)[:, None] - below) * np.diff(labels)).sum(axis=1)


def _best_by_medians(rows: DataFrame, cuts: list[list[float]]) -> DataFrame:
    import pyarrow as pa

    cells = materialize(_cells(rows, cuts, True), "label-cells")
    labels = cells.where("f = 0").groupBy("tree", "node", "y").agg(F.sum("n").alias("total"))
    blocks = cells.groupBy("tree", "node", "f", "b").agg(F.min("v").alias("least"))
    ahead = W.partitionBy("tree", "node", "f").orderBy("b")
    blocks = blocks.withColumn("then", F.lead("least").over(ahead)).drop("least")
    counted = cells.groupBy("tree", "node", "f", "b", "y").agg(F.sum("n").alias("n"))
    # every block with every label of its node, and how many lie in blocks before
    every = blocks.join(labels, ["tree", "node"]).join(counted, ["tree", "node", "f", "b", "y"], "left")
    past = W.partitionBy("tree", "node", "f", "y").orderBy("b").rowsBetween(W.unboundedPreceding, -1)
    before = every.select("tree", "node", "f", "b", "y", "total", "then",
                          F.coalesce(F.sum(F.coalesce("n", F.lit(0))).over(past), F.lit(0)).alias("before"))

    def best(key, entries: pa.Table, sides: pa.Table) -> pa.Table:
        at = {c: np.asarray(sides.column(c)) for c in ("y", "total", "before")}
        order = np.argsort(at["y"])
        y, total = at["y"][order], at["total"][order].astype(np.float64)
        left = at["before"][order].astype(np.float64)
        v, place = np.unique(np.asarray(entries.column("v")), return_inverse=True)
        label = np.searchsorted(y, np.asarray(entries.column("y")))
        n = np.asarray(entries.column("n")).astype(np.float64)
        then = sides.column("then")[0].as_py()
        ends = np.append(v[1:], np.nan if then is None else then)
        found = None
        for a in range(0, len(v), VALUES_AT_ONCE):
            b = min(a + VALUES_AT_ONCE, len(v))
            own = np.zeros((b - a, len(y)))
            mine = (place >= a) & (place < b)
            np.add.at(own, (place[mine] - a, label[mine]), n[mine])
            counts = left + np.cumsum(own, axis=0)
            left = counts[-1]
            loss = absolute_errors(y, counts) + absolute_errors(y, total - counts)
            loss[np.isnan(ends[a:b])] = np.inf       # nothing to the right
            i = int(np.argmin(loss))
            if np.isfinite(loss[i]) and (found is None or loss[i] < found[0]):
                middle = (v[a + i] + ends[a + i]) / 2
                found = (float(loss[i]), float(v[a + i] if middle >= ends[a + i] else middle))
        some = [] if found is None else [found]
        return pa.table({"tree": pa.array([key[0].as_py()] * len(some), pa.int32()),
                         "node": pa.array([key[1].as_py()] * len(some), pa.int64()),
                         "loss": pa.array([x[0] for x in some], pa.float64()),
                         "f": pa.array([key[2].as_py()] * len(some), pa.int32()),
                         "t": pa.array([x[1] for x in some], pa.float64())})

    key = ["tree", "node", "f", "b"]
    before = before.toDF(*before.columns)       # both sides come from the same table
    scored = (cells.select(*key, "v", "y", "n").groupBy(*key)
              .cogroup(before.select(*key, "y", "total", "before", "then").groupBy(*key))
              .applyInArrow(best, "tree int, node long, loss double, f int, t double"))
    return _first(scored)


def grow(rows: DataFrame, features: Sequence[str], label: str = LABEL, tree: str | None = None,
         criteria: dict[int, str] | None = None, criterion: str = "squared_error",
         max_depth: int = MAX_DEPTH, min_samples_split: int = 2) -> Trees:
    """Grow one tree for each value of the int column `tree` (one tree, 0,
    without it) on its rows. `criteria` maps a tree to its criterion, others
    take `criterion`. With the default depth a tree that is not finished at
    `MAX_DEPTH` is an error."""
    check_features(features, label)
    if not 0 <= max_depth <= MAX_DEPTH or min_samples_split < 2:
        raise ValueError("max_depth is 0 to 60, min_samples_split 2 or more")
    known = {**{t: c for t, c in (criteria or {}).items()}, None: criterion}
    if not set(known.values()) <= set(CRITERIA):
        raise ValueError(f"criteria are {', '.join(CRITERIA)}")

    def uses(name: str) -> Column:
        other = [t for t in known if t is not None]
        named = F.col("tree").isin([t for t in other if known[t] == name]) if other else F.lit(False)
        rest = ~F.col("tree").isin(other) if other else F.lit(True)
        return named | (rest & F.lit(criterion == name))

    number = F.col(tree).cast("int") if tree else F.lit(0)
    now = materialize(_values(rows, features).select(
        number.alias("tree"), F.lit(1).cast("long").alias("node"), _checked(label).alias("_y"), "_x"), "tree-rows")
    by_median = "absolute_error" in known.values()
    by_mean = set(known.values()) != {"absolute_error"}
    cuts = _cuts(now, len(features), BLOCKS)
    coarse = [c[::max(1, BLOCKS // ABSOLUTE_BLOCKS)] for c in cuts]
    tables: list[DataFrame] = []
    n_nodes = depth = 0
    while True:
        middle = F.when(uses("absolute_error"), F.col("_median")).otherwise(F.col("s") / F.col("n"))
        stats = now.groupBy("tree", "node").agg(
            F.count(F.lit(1)).alias("n"), F.sum("_y").alias("s"), F.min("_y").alias("_low"),
            F.max("_y").alias("_high"),
            (F.median(F.when(uses("absolute_error"), F.col("_y"))) if by_median
             else F.lit(None).cast("double")).alias("_median"))
        stats = stats.select("tree", "node", F.lit(depth).alias("depth"), "n", middle.alias("prediction"),
                             ((F.col("_low") < F.col("_high")) & (F.col("n") >= min_samples_split)).alias("_open"))
        if depth < max_depth:
            best = []
            if by_mean:
                best.append(_best_by_means(now.where(~uses("absolute_error")), cuts, uses("friedman_mse")))
            if by_median:
                best.append(_best_by_medians(now.where(uses("absolute_error")), coarse))
            found = best[0] if len(best) == 1 else best[0].unionByName(best[1])
            stats = stats.join(found, ["tree", "node"], "left")
            cut = F.col("_open") & F.col("feature").isNotNull()
            stats = stats.withColumns({c: F.when(cut, F.col(c)) for c in ("feature", "threshold")})
        else:
            stats = stats.withColumns({"feature": F.lit(None).cast("int"),
                                       "threshold": F.lit(None).cast("double")})
        nodes = materialize(stats, "tree-nodes")
        got = nodes.agg(F.count(F.lit(1)).alias("n"), F.count("feature").alias("cut"),
                        F.count_if("_open").alias("open")).first()
        tables.append(nodes.drop("_open"))
        n_nodes += got["n"]
        if depth == MAX_DEPTH and got["open"]:
            raise ValueError(f"a tree is deeper than {MAX_DEPTH}")
        if not got["cut"]:
            break
        now = _step(now, nodes.where("feature IS NOT NULL"), got["cut"])
        depth += 1
        if depth % STAGE_EVERY == 0:
            now = materialize(now, "tree-rows")
    out = tables[0]
    for more in tables[1:]:
        out = out.unionByName(more)
    return Trees(materialize(out.select("tree", "node", "depth", "n", "prediction", "feature", "threshold"),
                             "trees"), tuple(features), depth, n_nodes)


def _step(rows: DataFrame, cut: DataFrame, n: int) -> DataFrame:
    """The rows of the nodes that are cut, one level further down."""
    small = _small(cut.select("tree", "node", "feature", "threshold"), n)
    right = F.element_at("_x", F.col("feature") + 1) > F.col("threshold")
    return rows.join(small, ["tree", "node"]).withColumn(
        "node", F.col("node") * 2 + right.cast("long")).drop("feature", "threshold")


def descend(rows: DataFrame, trees: Trees, tree: str | None = None) -> DataFrame:
    """`rows` with `path`: array<struct<n, prediction>> of the nodes on each
    row's way, root first."""
    columns = rows.columns
    number = F.col(tree).cast("int") if tree else F.lit(0)
    # written first: as constants these two would turn the join into a loop
    now = materialize(_values(rows, trees.features).withColumns(
        {"_tree": number, "_node": F.lit(1).cast("long")}), "tree-ways")
    nodes = trees.nodes.select(F.col("tree").alias("_tree"), F.col("node").alias("_node"),
                               F.struct("n", "prediction").alias("_at"), "feature", "threshold")
    nodes = nodes.withColumnsRenamed({"feature": "_feature", "threshold": "_threshold"})
    now = now.withColumn("path", F.array().cast("array<struct<n:bigint,prediction:double>>"))
    for level in range(trees.depth + 1):
        # a leaf's rows leave the tree: their next node is none
        now = now.join(_small(nodes, trees.n_nodes), ["_tree", "_node"], "left")
        right = (F.element_at("_x", F.col("_feature") + 1) > F.col("_threshold")).cast("long")
        now = now.withColumns({
            "path": F.when(F.col("_at").isNull(), F.col("path")).otherwise(F.concat("path", F.array("_at"))),
            "_node": F.when(F.col("_feature").isNotNull(), F.col("_node") * 2 + right)}).drop(
            "_at", "_feature", "_threshold")
        if level % STAGE_EVERY == STAGE_EVERY - 1:
            now = materialize(now, "tree-ways")
    return now.select(*columns, "path")


def predict(rows: DataFrame, trees: Trees, tree: str | None = None, out: str = "prediction") -> DataFrame:
    """`rows` with each row's prediction. A missing feature raises."""
    return descend(rows, trees, tree).withColumn(out, F.element_at("path", -1)["prediction"]).drop("path")


def fit(train: DataFrame, features: Sequence[str], label: str = LABEL, criterion: str = "squared_error",
        max_depth: int = MAX_DEPTH, min_samples_split: int = 2) -> Trees:
    """M8: one tree on all of `train`."""
    return grow(train, features, label, None, None, criterion, max_depth, min_samples_split)


def grid_search(train: DataFrame, features: Sequence[str], label: str = LABEL,
                criteria: Sequence[str] = CRITERIA, depths: Sequence[int] = (1, 2, 3, 4),
                min_splits: Sequence[int] = tuple(range(2, 10)), fold_col: str = "fold") -> DataFrame:
    """M9: (criterion, max_depth, min_samples_split, mean_mse): the mean over
    the folds of the mean squared error on a fold of the tree grown on the
    others. One growth for all: the trees of all criteria and folds together,
    to the greatest depth and the smallest minimum."""
    numbers = {c * N_FOLDS + k: name for c, name in enumerate(criteria) for k in range(N_FOLDS)}
    tree = F.explode(F.array(*[F.lit(t) for t in numbers])).alias("_tree_no")
    rows = train.select(*features, label, F.col(fold_col).alias("_fold"), tree)
    own = F.col("_tree_no") % N_FOLDS == F.col("_fold")
    trees = grow(rows.where(~own), features, label, "_tree_no", numbers, max_depth=max(depths),
                 min_samples_split=min(min_splits))
    ways = descend(rows.where(own), trees, "_tree_no")
    # the last node that has come to be under (depth d, minimum m): the first
    # on the way that is at depth d or has fewer than m rows, else the leaf
    grid = F.explode(F.array(*[F.struct(F.lit(d).alias("max_depth"), F.lit(m).alias("min_samples_split"))
                               for d in depths for m in min_splits])).alias("g")
    scored = ways.select("_tree_no", F.col(label).cast("double").alias("_y"), "path", grid)
    place = F.aggregate("path", F.struct(F.lit(0).alias("i"), F.lit(-1).alias("stop")), lambda a, p: F.struct(
        (a["i"] + 1).alias("i"), F.when((a["stop"] < 0) & ((a["i"] == F.col("g.max_depth")) | (
            p["n"] < F.col("g.min_samples_split"))), a["i"]).otherwise(a["stop"]).alias("stop")))["stop"]
    last = F.when(place < 0, F.size("path") - 1).otherwise(place)
    scored = scored.withColumn("_e", F.col("_y") - F.get("path", last)["prediction"])
    per = scored.groupBy("_tree_no", "g.max_depth", "g.min_samples_split").agg(
        F.avg(F.col("_e") * F.col("_e")).alias("mse"))
    name = F.element_at(F.array(*[F.lit(c) for c in criteria]), (F.floor(F.col("_tree_no") / N_FOLDS) + 1).cast("int"))
    return per.groupBy(name.alias("criterion"), "max_depth", "min_samples_split").agg(
        F.avg("mse").alias("mean_mse"))


def best_setting(grid: DataFrame) -> dict:
    """The setting of the smallest error; of errors equal to a relative 1e-12
    the first criterion by `CRITERIA`, the least depth, the least minimum."""
    got = grid.collect()            # one row per setting
    low = min(r["mean_mse"] for r in got)
    near = [r for r in got if r["mean_mse"] <= low * (1 + 1e-12)]
    r = min(near, key=lambda r: (CRITERIA.index(r["criterion"]), r["max_depth"], r["min_samples_split"]))
    return {k: r[k] for k in ("criterion", "max_depth", "min_samples_split")}
