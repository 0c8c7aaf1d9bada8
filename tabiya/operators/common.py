"""Plan-shape helpers shared by the operators."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir


def attach_scalars(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Attach the columns of a one-row aggregate to every row of ``df``.

    Two-stage plan, as MLlib estimators do: the aggregate is computed first
    (exactly one row reaches the driver) and its values enter the second plan
    as literals, so ``df`` keeps its partitioning and no join (and no global
    window) is needed.
    """
    rows = one_row.take(2)
    if len(rows) != 1:
        raise ValueError(f"expected a one-row aggregate, got {len(rows)} rows")
    row = rows[0]
    out = df
    for f in one_row.schema.fields:
        out = out.withColumn(f.name, F.lit(row[f.name]).cast(f.dataType))
    return out


def unbroadcast(df: DataFrame) -> DataFrame:
    """``df`` as a side of a join that is always shuffled.

    Spark takes a scan's compressed file size for its rows' size and leaves an explode out of
    it, so a catalogue of a few MB on disk can be sent through the driver as GBs of rows.
    """
    return df.hint("merge")


def keep_first(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    """First row per key by ``order`` (unique tie-break expected).

    Expressed as ``min_by`` over a struct so the choice is a partial
    aggregation: a key holding a third of all rows is pre-reduced map-side
    instead of being buffered in one window task.
    """
    others = [c for c in df.columns if c not in keys]
    ordkey = F.struct(*order)
    agg = df.groupBy(*keys).agg(F.min_by(F.struct(*[F.col(c) for c in others]), ordkey).alias("__r"))
    return agg.select(*keys, *[F.col(f"__r.{c}").alias(c) for c in others])


def _ranged(df: DataFrame, order: list) -> DataFrame:
    """``df`` sorted by range partitions whose number ``__pid`` is kept by a reliable checkpoint, so that
    every later branch sees the same partitions whatever adaptive execution does to its own shuffles."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__pid", F.spark_partition_id()).checkpoint(eager=True)


def nearest_bound(df: DataFrame, value: str, bounds: DataFrame, kind: str, out: str) -> DataFrame:
    """``df`` with the largest bound <= ``value`` (``kind="floor"``) or the smallest bound >= it (``"ceil"``); null where there is none.

    Distinct values and bounds are sorted together by range partitions; within a partition a running
    maximum gives the bound, and the partitions' own maxima, added up in order, give what comes from before.
    No list of bounds is collected or written into the plan, whatever their number.
    """
    sign = 1 if kind == "floor" else -1
    both = df.select((F.col(value) * sign).cast("long").alias("v"), F.lit(1).alias("q")).distinct().unionAll(
        bounds.select((F.col(bounds.columns[0]) * sign).cast("long").alias("v"), F.lit(0).alias("q")).distinct()).filter(F.col("v").isNotNull())
    s = _ranged(both, ["v", "q"])
    bound = F.when(F.col("q") == 0, F.col("v"))
    ends = s.groupBy("__pid").agg(F.max(bound).alias("__top"))
    before = ends.select("__pid", F.max("__top").over(Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)).alias("__before"))
    running = F.max(bound).over(Window.partitionBy("__pid").orderBy("v", "q").rowsBetween(Window.unboundedPreceding, 0))
    found = s.withColumn("__own", running).join(F.broadcast(before), "__pid").filter("q = 1")
    found = found.select((F.col("v") * sign).alias(value), (F.coalesce("__own", "__before") * sign).alias(out))
    return df.join(found, value, "left")


def global_rank(df: DataFrame, order: list, rank_col: str = "rank") -> DataFrame:
    """Dense 1..N position of every row under ``order`` without a single-task
    window: range-partition + sort, count rows per partition (a tiny table of
    one row per partition), prefix-sum the counts, add the row index inside the
    partition."""
    s = _ranged(df, order).withColumn("__i", F.row_number().over(Window.partitionBy("__pid").orderBy(*order)))
    counts = s.groupBy("__pid").agg(F.count(F.lit(1)).alias("__c"))
    offs = counts.withColumn("__off", F.sum("__c").over(Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)))
    offs = F.broadcast(offs.select("__pid", F.coalesce(F.col("__off"), F.lit(0)).alias("__off")))
    return s.join(offs, "__pid").withColumn(rank_col, F.col("__off") + F.col("__i")).drop("__pid", "__i", "__off")


def running_total(df: DataFrame, keys: list[str], order: str, value: str, out: str) -> DataFrame:
    """``df`` with the sum of ``value`` over the rows of the same keys that come before under ``order`` (unique within the keys).

    Range partitions, sums inside each, and what the earlier partitions hold of a key (one row per
    partition and key) instead of a window over all rows of a key.
    """
    s = _ranged(df, [*keys, order])
    inside = F.sum(value).over(Window.partitionBy(*keys, "__pid").orderBy(order).rowsBetween(Window.unboundedPreceding, -1))
    ends = s.groupBy(*keys, "__pid").agg(F.sum(value).alias("__s"))
    before = Window.partitionBy(*keys).orderBy("__pid") if keys else Window.orderBy("__pid")
    ends = ends.select(*keys, "__pid", F.coalesce(F.sum("__s").over(before.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__before"))
    d = s.withColumn("__inside", F.coalesce(inside, F.lit(0))).join(F.broadcast(ends), [*keys, "__pid"])
    return d.withColumn(out, F.col("__before") + F.col("__inside")).drop("__pid", "__inside", "__before")


def exact_quantiles(df: DataFrame, cols: list[str], probs: list[float]) -> dict[str, list[float | None]]:
    """Exact quantiles (linear interpolation) of numeric columns over all rows.

    No task holds all distinct values: (column, value) pairs are counted,
    range-partitioned and prefix-summed, one sum per partition and column
    reaches the driver, and so do the two order statistics around each quantile.
    """
    stack = f"stack({len(cols)}, " + ", ".join(f"'{c}', CAST(`{c}` AS DOUBLE)" for c in cols) + ") AS (name, value)"
    counts = df.selectExpr(stack).filter(F.col("value").isNotNull()).groupBy("name", "value").agg(F.count(F.lit(1)).alias("n"))
    s = _ranged(counts, ["name", "value"])
    before: dict[str, int] = {}
    parts, total = [], {}
    for r in s.groupBy("name", "__pid").agg(F.sum("n").alias("n")).orderBy("name", "__pid").collect():
        parts.append((r["name"], r["__pid"], before.get(r["name"], 0), r["n"]))
        before[r["name"]] = total[r["name"]] = before.get(r["name"], 0) + r["n"]
    wanted = {(c, k) for c, n in total.items() for p in probs for k in {math.floor(p * (n - 1)), math.ceil(p * (n - 1))}}
    at = [(c, pid, base, k) for c, pid, base, n in parts for cc, k in wanted if cc == c and base <= k < base + n]
    if not at:
        return {c: [None] * len(probs) for c in cols}
    at_df = df.sparkSession.createDataFrame(at, "name string, __pid int, base long, k long")
    running = F.sum("n").over(Window.partitionBy("name", "__pid").orderBy("value").rowsBetween(Window.unboundedPreceding, 0))
    hit = s.withColumn("upto", running).join(F.broadcast(at_df), ["name", "__pid"]).filter(
        (F.col("k") < F.col("base") + F.col("upto")) & (F.col("k") >= F.col("base") + F.col("upto") - F.col("n")))
    value = {(r["name"], r["k"]): r["value"] for r in hit.select("name", "k", "value").collect()}

    def quantile(c: str, p: float) -> float | None:
        if c not in total:
            return None
        x = p * (total[c] - 1)
        lo, hi = value[c, math.floor(x)], value[c, math.ceil(x)]
        return lo + (hi - lo) * (x - math.floor(x))
    return {c: [quantile(c, p) for p in probs] for c in cols}


def grouped_quantiles(df: DataFrame, group: str, value: str, probs: list[float], out: list[str]) -> DataFrame:
    """Exact quantiles (linear interpolation) of ``value`` in every group, one row a group (null is a group).

    Values are counted per group and ranked by range partitions, so no task holds a whole group; an
    order statistic is the value whose counts cover its place. A group without values has null quantiles.
    """
    # a struct is never null, so the null group joins like any other
    d = df.select(F.struct(F.col(group).alias("v")).alias("g"), F.col(value).cast("double").alias("x"))
    counts = d.groupBy("g", "x").agg(F.count(F.lit(1)).alias("n"))
    total = counts.groupBy("g").agg(F.sum(F.when(F.col("x").isNotNull(), F.col("n")).otherwise(0)).alias("total"))
    ranked = running_total(counts.filter(F.col("x").isNotNull()), ["g"], "x", "n", "before")
    place = [F.lit(float(p)) * (F.col("total") - 1) for p in probs]

    def at(k: F.Column) -> F.Column:
        return F.max(F.when((F.col("before") <= k) & (k < F.col("before") + F.col("n")), F.col("x")))
    found = total.join(ranked, "g", "left").groupBy("g", "total").agg(
        *[at(F.floor(k)).alias(f"lo{i}") for i, k in enumerate(place)], *[at(F.ceil(k)).alias(f"hi{i}") for i, k in enumerate(place)])
    return found.select(F.col("g.v").alias(group), *[(F.col(f"lo{i}") + (F.col(f"hi{i}") - F.col(f"lo{i}")) * (k - F.floor(k))).alias(c) for i, (k, c) in enumerate(zip(place, out))])


def attach_values(df: DataFrame, values: dict[str, float | None]) -> DataFrame:
    """Constant double columns."""
    return df.withColumns({k: F.lit(v).cast("double") for k, v in values.items()})
