"""Quantile and equal-width bins, right-closed with the lowest edge included, and statistics by bin."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import quantiles


def trim_outliers(df: DataFrame, x: str | None, y: str | None, low: float = 0.01, high: float = 0.99) -> DataFrame:
    """Rows between two quantiles, ends included; those of y are taken after x has been trimmed."""
    for c in (x, y):
        if c:
            q = quantiles.percentiles(df, [c], [low, high]).select(F.col("q").alias("_q"))
            df = df.join(F.broadcast(q)).where(F.col(c).between(F.col("_q")[0], F.col("_q")[1])).drop("_q")
    return df


def quantile_edges(df: DataFrame, x: str, bins: int) -> list[float]:
    """At most bins + 1 different edges."""
    found = quantiles.percentiles(df, [x], [i / bins for i in range(bins + 1)]).first()
    return sorted(set(found["q"])) if found else []


def linear_edges(df: DataFrame, x: str, bins: int) -> list[float]:
    """Equal widths; the lowest edge is a thousandth of the range lower."""
    lo, hi = df.agg(F.min(x).cast("double"), F.max(x).cast("double")).first()
    if lo is None:
        return []
    if lo == hi:
        pad = 0.001 * abs(lo) or 0.001
        lo, hi = lo - pad, hi + pad
        return [lo + (hi - lo) * i / bins for i in range(bins + 1)]
    return [lo - 0.001 * (hi - lo), *[lo + (hi - lo) * i / bins for i in range(1, bins + 1)]]


def bin_of(x: Column, edges: list[float]) -> Column:
    """struct(lo, hi, mid) of a value's bin; mid is that of the edges rounded to three places. One lookup by position, not a chain of comparisons."""
    if len(edges) < 2:
        return F.lit(None).cast("struct<lo:double,hi:double,mid:double>")
    inner = F.array(*[F.lit(float(e)) for e in edges])
    below = F.size(F.filter(inner, lambda e: e < x))
    at = F.greatest(F.lit(1), below)
    lo, hi = F.try_element_at(inner, at), F.try_element_at(inner, at + 1)
    shown = F.when(at == 1, F.round(lo - (0.001 if edges[0] == min(edges) else 0), 3)).otherwise(F.round(lo, 3))
    return F.when(x.between(edges[0], edges[-1]), F.struct(lo.alias("lo"), hi.alias("hi"), ((shown + F.round(hi, 3)) / 2).alias("mid")))


def binned(df: DataFrame, x: str, y: str, bins: int, how: str = "quantile", by: str | None = None) -> DataFrame:
    """Statistics of y (and the range of x) by bin of x, and by category."""
    df = df.where(F.col(x).isNotNull() & F.col(y).isNotNull())
    if how == "quantile":
        edges = quantile_edges(df, x, bins)
        bucket = bin_of(F.col(x), edges)
    else:
        edges = linear_edges(df, x, bins)
        bucket = bin_of(F.col(x), edges)
        bucket = F.when(bucket.isNotNull(), F.struct(bucket["lo"].alias("lo"), bucket["hi"].alias("hi"), ((F.round(bucket["lo"], 3) + F.round(bucket["hi"], 3)) / 2).alias("mid")))
    keys = [F.col(by)] if by else []
    rows = df.withColumn("_b", bucket).where("_b IS NOT NULL").select(*keys, F.col("_b.lo").alias("lo"), F.col("_b.hi").alias("hi"), F.col("_b.mid").alias("x_mid"), F.col(x).alias("x"), F.col(y).alias("y"))
    x, y, names = "x", "y", [*([by] if by else []), "lo", "hi", "x_mid"]
    out = rows.groupBy(*names).agg(F.avg(y).alias("y_mean"), F.count("*").alias("n"), F.min(x).alias("x_min"), F.max(x).alias("x_max"), F.min(y).alias("y_min"), F.max(y).alias("y_max"))
    out = quantiles.beside(out, quantiles.percentiles(rows, ["y"], [0.1, 0.5, 0.9], names).drop("variable"), names)
    return out.select(*keys, "x_mid", F.col("q")[1].alias("y_median"), "y_mean", F.col("q")[0].alias("y_p10"), F.col("q")[2].alias("y_p90"), "n", "x_min", "x_max", "y_min", "y_max")
