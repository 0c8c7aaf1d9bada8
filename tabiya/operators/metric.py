"""Exact nearest neighbours by cosine distance through a two-level metric partition.

Equal unit vectors are one point that keeps its ``k + 1`` smallest ids. Points go
to the nearest of a few first pivots (at most ``FIRST``), and inside such a cell
to the nearest of second pivots, one for about ``leaf`` points, so that leaves
stay small where points are dense. Every cell and leaf knows its radius; on
unit vectors the Euclidean distance obeys the triangle inequality, and what
is farther from a pivot than radius and search radius together cannot be near.

A point's search radius is the smallest of: the distance of its ``k``-th neighbour
in its own leaf, and distance plus radius of a leaf of its cell, or of a
cell, that holds ``k + 1`` ids. Cells within it are found inside the point's row
(their table is bounded), their leaves through an equi join by cell, and only
the points of those leaves through an equi join by leaf.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

#: First pivots, and second pivots of a cell, at most (about).
FIRST = 512
#: Points of a leaf, about.
LEAF = 32
#: Added to squared search radii: distances are compared after rounding to 9 digits.
SLACK = 1e-7


def _dot(a: list[Column], b: list[Column]) -> Column:
    return reduce(lambda s, p: s + p[0] * p[1], zip(a, b), F.lit(0.0))


def _euclid(cos: Column) -> Column:
    return F.sqrt(F.greatest(2 - 2 * cos, F.lit(0.0)))


def _nearest(pivots: Column, u: list[Column], out: str, distance: str):
    """Number of the pivot with the largest product, and its distance."""
    def use(df: DataFrame) -> DataFrame:
        d = df.withColumn("__dots", F.transform(pivots, lambda p: _dot(u, [p[i] for i in range(len(u))])))
        d = d.withColumn("__top", F.array_max("__dots"))
        return d.withColumn(out, F.array_position("__dots", F.col("__top")).cast("int")).withColumn(distance, _euclid(F.col("__top"))).drop("__dots", "__top")
    return use


def _names(d: int) -> list[str]:
    return [f"u{i}" for i in range(d)]


def partition(points: DataFrame, d: int, k: int, leaf: int = LEAF) -> tuple[DataFrame, DataFrame, list]:
    """Points with their leaf (``c1``, ``c2``), the leaves of each cell as one array, and the cells.

    ``points``: pid, u0.., ids (the smallest ids of the point).
    """
    u = [F.col(c) for c in _names(d)]
    vec = F.array(*u)
    h = F.xxhash64("pid")
    n = points.count()
    # at most FIRST rows reach the driver
    some = points.orderBy(h, "pid").limit(max(1, min(FIRST, int((n / leaf) ** 0.5)))).select(*u).collect()
    first = F.array(*[F.array(*[F.lit(float(x)) for x in r]) for r in some])
    pts = points.transform(_nearest(first, u, "c1", "d1"))
    pts = pts.checkpoint(eager=True)
    stat = pts.groupBy("c1").agg(F.max("d1").alias("radius"), F.sum(F.size("ids")).alias("members"), F.count(F.lit(1)).alias("size"), F.min(h).alias("least"))
    cells = [(r["c1"], list(map(float, some[r["c1"] - 1])), r["radius"], r["members"]) for r in stat.collect()]
    # second pivots: every point with the same chance, and the one with the least hash so that there is one
    chosen = pts.join(stat.select("c1", "size", "least"), "c1").filter((h == F.col("least")) | (F.pmod(h, F.greatest(F.lit(leaf), (F.col("size") / FIRST).cast("long"))) == 0))
    second = chosen.groupBy("c1").agg(F.collect_list(vec).alias("pivots"))
    pts = pts.join(second, "c1")
    pts = pts.transform(_nearest(F.col("pivots"), u, "c2", "d2")).withColumn("pivot", F.element_at("pivots", F.col("c2")))
    pts = pts.drop("pivots").checkpoint(eager=True)
    leaves = pts.groupBy("c1", "c2").agg(F.max("d2").alias("radius"), F.sum(F.size("ids")).alias("members"), F.count(F.lit(1)).alias("size"), F.first("pivot").alias("pivot"))
    tree = leaves.groupBy("c1").agg(F.collect_list(F.struct("c2", "pivot", "radius", "members", "size")).alias("leaves"))
    return pts.drop("pivot", "d1", "d2"), tree.checkpoint(eager=True), cells


def near_leaves(pts: DataFrame, tree: DataFrame, cells: list, d: int, k: int) -> DataFrame:
    """(pid, radius, c1, c2, size, u..) of every point and every leaf that may hold one of its ``k + 1`` nearest ids."""
    u = [F.col(c) for c in _names(d)]
    far = lambda p: _euclid(_dot(u, [p[i] for i in range(d)]))
    known = F.array(*[F.struct(F.lit(c).alias("c1"), F.array(*[F.lit(x) for x in p]).alias("pivot"), F.lit(float(r)).alias("radius"), F.lit(m).cast("long").alias("members")) for c, p, r, m in cells])
    # the own leaf's points
    other = pts.select("c1", "c2", *[F.col(c).alias(f"o_{c}") for c in _names(d)])
    own = pts.join(other, ["c1", "c2"]).select("pid", _euclid(_dot(u, [F.col(f"o_{c}") for c in _names(d)])).alias("far"))
    w = Window.partitionBy("pid").orderBy("far")
    own = own.withColumn("__r", F.row_number().over(w)).filter(F.col("__r") <= k + 1).groupBy("pid").agg(F.max("far").alias("own"), F.count(F.lit(1)).alias("m"))
    q = pts.join(own, "pid").join(tree, "c1")
    enough = lambda xs: F.array_min(F.transform(F.filter(xs, lambda x: x["members"] > k), lambda x: far(x["pivot"]) + x["radius"]))
    limit = F.least(F.when(F.size("ids") > k, 0.0).when(F.col("m") > k, F.col("own")), enough(F.col("leaves")), enough(known))
    q = q.withColumn("radius", F.sqrt(F.coalesce(limit * limit, F.lit(4.0)) + SLACK)).select("pid", "radius", *u)
    q = q.checkpoint(eager=True)
    reached = lambda xs: F.filter(xs, lambda x: far(x["pivot"]) <= x["radius"] + F.col("radius") + SLACK)
    q = q.withColumn("c1", F.explode(F.transform(reached(known), lambda x: x["c1"])))
    q = q.join(tree, "c1").withColumn("leaf", F.explode(reached(F.col("leaves"))))
    return q.select("pid", "radius", "c1", "leaf.c2", "leaf.size", *u)


def knn_neighbours(vectors: DataFrame, k: int = 5, leaf: int = LEAF, d: int = 7) -> DataFrame:
    """(player, neighbour, distance, rank) of the exact k nearest neighbours by cosine distance, self excluded.

    Distances are rounded to 9 digits, ties go to the smaller id. A vector without length is at distance 1 from all.
    """
    ensure_checkpoint_dir(vectors.sparkSession)
    names = _names(d)
    length = F.sqrt(F.aggregate("vec", F.lit(0.0), lambda a, x: a + x * x))
    v = vectors.withColumn("__n", length).select("player", (F.col("__n") > 0).alias("long"), *[F.try_divide(F.col("vec")[i], F.col("__n")).alias(c) for i, c in enumerate(names)])
    v = v.withColumn("long", F.coalesce("long", F.lit(False))).checkpoint(eager=True)
    # equal vectors are one point with its smallest ids
    w = Window.partitionBy(*names).orderBy("player")
    points = v.filter("long").withColumn("__r", F.row_number().over(w)).filter(F.col("__r") <= k + 1).groupBy(*names).agg(F.sort_array(F.collect_list("player")).alias("ids"))
    points = points.withColumn("pid", F.monotonically_increasing_id()).checkpoint(eager=True)
    kind = "array<struct<distance:double,nb:" + v.schema["player"].dataType.simpleString() + ">>"
    as_item = lambda df: [(1.0, r["player"]) for r in df.orderBy("player").limit(k + 1).select("player").collect()]
    short, every = as_item(v.filter("NOT long")), as_item(v)
    item = lambda rows: F.array(*[F.struct(F.lit(x).alias("distance"), F.lit(i).alias("nb")) for x, i in rows]).cast(kind)
    lists = None
    if not points.isEmpty():
        pts, tree, cells = partition(points, d, k, leaf)
        q = near_leaves(pts, tree, cells, d, k)
        data = pts.select("c1", "c2", "ids", *[F.col(c).alias(f"o_{c}") for c in names])
        pairs = q.join(data, ["c1", "c2"]).withColumn("cos", _dot([F.col(c) for c in names], [F.col(f"o_{c}") for c in names]))
        pairs = pairs.filter(2 - 2 * F.col("cos") <= F.col("radius") * F.col("radius") + SLACK)
        pairs = pairs.select("pid", F.round(1.0 - F.col("cos"), 9).alias("distance"), F.explode("ids").alias("nb"))
        top = pairs.withColumn("__r", F.row_number().over(Window.partitionBy("pid").orderBy("distance", "nb"))).filter(F.col("__r") <= k + 1)
        top = top.groupBy("pid").agg(F.collect_list(F.struct("distance", "nb")).cast(kind).alias("near"))
        lists = points.join(top, "pid").select(*names, F.slice(F.sort_array(F.concat("near", item(short))), 1, k + 1).alias("near"))
    none = v.filter("NOT long").select("player", item(every).alias("near"))
    found = none if lists is None else v.filter("long").join(lists, names).select("player", "near").unionAll(none)
    left = F.slice(F.filter("near", lambda x: x["nb"] != F.col("player")), 1, k)
    return found.select("player", F.posexplode(left).alias("rank", "x")).select("player", F.col("x.nb").alias("neighbour"), "x.distance", (F.col("rank") + 1).cast("int").alias("rank"))
