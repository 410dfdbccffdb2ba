"""Exact percentiles without a task that holds all values.

Values are counted first (with partial counts on the map side). Approximate splits cut each variable's range into PARTS parts, which
only deal out the work; running counts within the parts and the parts' totals give every value its exact places, and the values at the wanted places are picked.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Parts that a variable's values are dealt out in at most.
PARTS = 64


def beside(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """An inner join in which null keys are equal; right's other columns come after left's."""
    if not keys:
        return left.join(F.broadcast(right))
    other = right.withColumnsRenamed({k: f"_{k}" for k in keys})
    on = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])
    return left.join(other, on).drop(*[f"_{k}" for k in keys])


def placed_counts(long: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, value, n, last, size): how often a value occurs under its keys, how many values are not above it, and how many there are. long: keys, among them variable, and value, not null."""
    splits = long.groupBy("variable").agg(F.percentile_approx("value", [k / PARTS for k in range(1, PARTS)], 2000).alias("splits"))
    counts = long.groupBy(*keys, "value").agg(F.count("*").alias("n"))
    dealt = counts.join(F.broadcast(splits), "variable").withColumn("part", F.size(F.filter("splits", lambda s: s < F.col("value")))).drop("splits")
    totals = dealt.groupBy(*keys, "part").agg(F.sum("n").alias("here"))
    group = Window.partitionBy(*keys)
    totals = totals.withColumns({"size": F.sum("here").over(group), "before": F.sum("here").over(group.orderBy("part").rowsBetween(Window.unboundedPreceding, 0)) - F.col("here")}).drop("here")
    upto = F.sum("n").over(Window.partitionBy(*keys, "part").orderBy("value").rowsBetween(Window.unboundedPreceding, 0))
    placed = beside(dealt.withColumn("upto", upto), totals, [*keys, "part"])
    return placed.select(*keys, "value", "n", (F.col("before") + F.col("upto")).alias("last"), "size")


def percentiles(df: DataFrame, cols: list[str], probabilities: list[float], by: list[str] | None = None) -> DataFrame:
    """(by, variable, q): linear interpolation between neighbours, null values left out. Groups or variables without a value have no row."""
    by = by or []
    keys = [*by, "variable"]
    long = df.select(*by, *[F.col(c).cast("double").alias(c) for c in cols]).unpivot(by, cols, "variable", "value").where("value IS NOT NULL")
    placed, last = placed_counts(long, keys), F.col("last")  # places are numbered from 0: a value has those from last - n on

    def at(place: Column) -> Column:
        return F.max(F.when((place >= last - F.col("n")) & (place < last), F.col("value")))

    places = [F.lit(float(p)) * (F.col("size") - 1) for p in probabilities]
    picked = placed.groupBy(*keys).agg(F.max("size").alias("size"), *[x.alias(f"{side}{i}") for i, p in enumerate(places) for side, x in (("low", at(F.floor(p))), ("high", at(F.ceil(p))))])

    def between(i: int, place: Column) -> Column:
        low, high = F.col(f"low{i}"), F.col(f"high{i}")
        return F.when(low == high, low).otherwise((F.ceil(place) - place) * low + (place - F.floor(place)) * high)

    return picked.select(*keys, F.array(*[between(i, p) for i, p in enumerate(places)]).alias("q"))
