"""Best resources by dyadic ranges against a plain search, with 10^4 distinct bounds."""

import random

from pyspark.sql import functions as F

from tabiya.operators import recommend as R
from tabiya.operators.recommend import _best_by_range
from tabiya.sources import fixtures as fx

from .conftest import SF001


def test_best_by_range(spark):
    rng = random.Random(6)
    res = []
    for i in range(4000):
        lo = rng.randrange(0, 9000)
        res.append((f"r{i:05d}", lo, min(9999, lo + rng.randrange(-20, 3000)) if i % 7 else 9999, rng.choice(["a", "b", None]), float(rng.randrange(12))))
    res += [("all", 0, 9999, "a", 3.0), ("far", 0, 400_000, "b", 99.0), ("one", 1500, 1500, "c", 1.0), ("back", 50, 40, "c", 1.0)]
    ratings = [0, 1, 1499.5, 1500, 1500.5, 2500, 9998.5, 9999, 12_000] + [rng.randrange(0, 20_000) / 2 for _ in range(40)]
    places = {int(2 * r) for r in ratings}
    classes = spark.createDataFrame([(p // 2, -(-p // 2), p) for p in places], "a long, b long, place long")
    got = {}
    for r in _best_by_range(classes, spark.createDataFrame(res, "resource_id string, lo long, hi long, kind string, base double"), ["kind"], 3).collect():
        got.setdefault((r.a, r.b, r.kind), set()).add(r.resource_id)
    want = {}
    for p in places:
        a, b = p // 2, -(-p // 2)
        for kind in ("a", "b", "c", None):
            fit = sorted((-s, i) for i, lo, hi, k, s in res if k == kind and lo <= a and hi >= b)[:3]
            if fit:
                want[a, b, kind] = {i for _, i in fit}
    assert got == want


def test_best_by_range_of_the_same_opening_and_far_places(spark):
    rng = random.Random(8)
    bounds = [-70_000, -5, 0, 1200, 1500, 32_768, 40_000, 2_000_000]
    res = [(f"r{i:04d}", *sorted(rng.sample(bounds, 2)), rng.choice("xy"), rng.choice(["a", None]), float(rng.randrange(4))) for i in range(600)]
    ratings = [-5, -3, 0, 1300.5, 32_768, 35_000, 40_000, 1_999_999]
    classes = [(int(r // 1), int(-(-r // 1)), int(2 * r), o) for r in ratings for o in "xyz"]
    got = {}
    for r in _best_by_range(spark.createDataFrame(classes, "a long, b long, place long, o string"), spark.createDataFrame(res, "resource_id string, lo long, hi long, o string, kind string, base double"), ["kind"], 3, by=("o",)).collect():
        got.setdefault((r.a, r.b, r.o, r.kind), set()).add(r.resource_id)
    want = {}
    for a, b, _, o in classes:
        for kind in ("a", None):
            fit = sorted((-s, i) for i, lo, hi, oo, k, s in res if k == kind and oo == o and lo <= a and hi >= b)[:3]
            if fit:
                want[a, b, o, kind] = {i for _, i in fit}
    assert got == want


def _most_rows(df):
    """The largest number of rows that a step of the executed plan gave out."""
    df.collect()
    most, todo = 0, [df._jdf.queryExecution().executedPlan()]
    while todo:
        p = todo.pop()
        n = p.metrics().get("numOutputRows")
        most = max(most, n.get().value() if n.isDefined() else 0)
        if p.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
            todo.append(p.executedPlan())
        elif p.getClass().getSimpleName().endswith("QueryStageExec"):
            todo.append(p.plan())
        todo += [p.children().apply(i) for i in range(p.children().size())]
    return most


def test_label_plan_makes_no_row_per_key_and_match(spark):
    cat = fx.catalog(spark, SF001)
    cat = cat.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(60)))).withColumn("resource_id", F.concat_ws("_", "resource_id", "copy")).drop("copy")
    lines = [(k, "Slav Defense", ("white", "black")[k % 2], list(R.LABEL_COURSE_TYPE)[k % 5], 1, 60.0 + k % 30, list(R.GROUP_CFG)[k % 3], 600.0 + 5 * k) for k in range(400)]
    prof = spark.createDataFrame(lines, "player int, opening string, color string, label string, label_priority int, accuracy_pct double, group string, rating double")
    out = R.label_driven_plan(prof, cat, 3)
    matches = cat.filter(F.instr(F.lower("openings"), "slav defense") > 0).count()
    # hundreds of rest keys and matches: their pairs, 400 x 1,020, were rows of the plan
    assert out.select("player").distinct().count() == 400 and matches == 1020
    assert _most_rows(out) < 100_000
