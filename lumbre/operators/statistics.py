"""Ratios, correlations and exploratory tests."""

from __future__ import annotations

import math
from itertools import combinations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from . import quantiles


def ratio_summary(df: DataFrame, a: str, b: str) -> DataFrame:
    r = F.col(a) / F.col(b)
    rows = df.where((F.col(b) != 0) & F.col(a).isNotNull()).select(r.cast("double").alias("r"))
    one = rows.agg(F.count("*").alias("n"), F.avg("r").alias("mean"), F.stddev_samp("r").alias("std"))
    one = one.join(F.broadcast(quantiles.percentiles(rows, ["r"], [0.01, 0.5, 0.99])), how="left")
    return one.select("n", "mean", "std", F.col("q")[0].alias("p01"), F.col("q")[1].alias("p50"), F.col("q")[2].alias("p99"))


def correlations(df: DataFrame, cols: list[str]) -> DataFrame:
    """(a, b, r, n) of every pair of columns over its complete rows, in one pass."""
    both = lambda a, b: F.col(a).isNotNull() & F.col(b).isNotNull()
    pairs = [F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.corr(F.when(both(a, b), F.col(a)).cast("double"), F.when(both(a, b), F.col(b)).cast("double")).alias("r"), F.count_if(both(a, b)).alias("n")) for a, b in combinations(cols, 2)]
    return df.agg(F.array(*pairs).alias("p")).select(F.inline("p"))


def correlation_matrix(df: DataFrame, cols: list[str]) -> DataFrame:
    upper = correlations(df, cols).select("a", "b", "r")
    same = df.sparkSession.createDataFrame([(c, c, 1.0) for c in cols], "a string, b string, r double")
    return upper.unionByName(upper.select(F.col("b").alias("a"), F.col("a").alias("b"), "r")).unionByName(same)


def high_correlations(df: DataFrame, cols: list[str], least: float = 0.8) -> DataFrame:
    return correlations(df, cols).where(F.abs("r") >= least).orderBy(F.desc(F.abs("r")), "a", "b").select("a", "b", "r")


def gamma_tail(a: float, x: float) -> float:
    """The regularised upper incomplete gamma function, by series below a + 1 and continued fraction above."""
    if x <= 0:
        return 1.0
    scale = math.exp(-x + a * math.log(x) - math.lgamma(a))
    if x < a + 1:
        term = total = 1 / a
        k = a
        while abs(term) > abs(total) * 1e-16:
            k += 1
            term *= x / k
            total += term
        return max(0.0, 1 - total * scale)
    b, c = x + 1 - a, 1e300
    d = 1 / b
    h = d
    for i in range(1, 10_000):
        an = -i * (i - a)
        b += 2
        d = 1 / ((an * d + b) or 1e-300)
        c = (b + an / c) or 1e-300
        h *= d * c
        if abs(d * c - 1) < 1e-16:
            break
    return h * scale


@F.pandas_udf(DoubleType())
def chi2_tail(x: pd.Series, dof: pd.Series) -> pd.Series:
    """P(chi-squared of dof degrees > x), for a handful of test results."""
    return pd.Series([None if pd.isna(a) or pd.isna(b) or b <= 0 else gamma_tail(b / 2, a / 2) for a, b in zip(x, dof, strict=True)], dtype="float64")


def kruskal_wallis(df: DataFrame, value: str, group: str, tail: bool = True) -> DataFrame:
    """H with tie correction, dof, epsilon squared, and p. Ranks come from counts by value, so the rows themselves are never sorted in one task.

    The ties' sum is made over the counts by group and value too: c * (t^2 - 1) adds up to t^3 - t for each value.
    """
    rows = df.where(F.col(value).isNotNull() & F.col(group).isNotNull()).select(F.col(group).alias("g"), F.col(value).cast("double").alias("v"))
    placed = quantiles.placed_counts(rows.select(F.lit("v").alias("variable"), F.col("v").alias("value")), ["variable"])
    ranked = placed.select(F.col("value").alias("v"), F.col("n").cast("double").alias("t"), (F.col("last") - (F.col("n") - 1) / 2.0).alias("rank"))
    by_group = rows.groupBy("g", "v").agg(F.count("*").alias("c")).join(ranked, "v").groupBy("g").agg(F.sum("c").alias("n"), F.sum(F.col("c") * F.col("rank")).alias("r"), F.sum(F.col("c") * (F.col("t") * F.col("t") - 1)).alias("ties"))
    totals = by_group.agg(F.sum("n").alias("n"), F.count("*").alias("k"), F.sum(F.col("r") * F.col("r") / F.col("n")).alias("s"), F.sum("ties").alias("ties"))
    n, k = F.col("n"), F.col("k")
    h = (12.0 / (n * (n + 1.0)) * F.col("s") - 3.0 * (n + 1.0)) / (1 - F.col("ties") / (F.pow(n.cast("double"), 3) - n))
    out = totals.select(F.when(k >= 2, h).alias("h"), (k - 1).alias("dof"), "n", "k").withColumn("epsilon2", (F.col("h") - k + 1) / (n - k))
    return out.withColumn("p", chi2_tail(F.col("h"), F.col("dof").cast("double"))) if tail else out


def chi2_independence(df: DataFrame, row: str, col: str, tail: bool = True) -> DataFrame:
    """Chi-squared of a contingency table without nulls, dof, Cramer's V and p; Yates' correction at one degree of freedom. Null below two rows or columns.

    Cells that are empty are summed up from the margins, not written out: sum of E over all cells is n.
    """
    cells = df.where(F.col(row).isNotNull() & F.col(col).isNotNull()).groupBy(F.col(row).alias("r"), F.col(col).alias("c")).agg(F.count("*").alias("o"))
    rows, cols = cells.groupBy("r").agg(F.sum("o").alias("nr")), cells.groupBy("c").agg(F.sum("o").alias("nc"))
    one = cells.agg(F.sum("o").alias("n"), F.countDistinct("r").alias("kr"), F.countDistinct("c").alias("kc"))
    e = F.col("nr") * F.col("nc") / F.col("n")
    full = cells.join(rows, "r").join(cols, "c").join(F.broadcast(one)).withColumn("e", e)
    yates = F.greatest(F.lit(0.0), F.abs(F.col("o") - F.col("e")) - 0.5)
    plain = F.pow(F.col("o") - F.col("e"), 2) / F.col("e")
    sums = full.groupBy("n", "kr", "kc").agg(F.sum(plain - F.col("e")).alias("over"), F.sum(F.pow(yates, 2) / F.col("e")).alias("corrected"), F.count("*").alias("cells"))
    dof = (F.col("kr") - 1) * (F.col("kc") - 1)
    chi2 = F.when((F.col("kr") == 2) & (F.col("kc") == 2) & (F.col("cells") == 4), F.col("corrected")).otherwise(F.col("over") + F.col("n"))
    out = sums.where("kr >= 2 AND kc >= 2").select(chi2.alias("chi2"), dof.alias("dof"), "n", F.sqrt(chi2 / (F.col("n") * (F.least("kr", "kc") - 1))).alias("cramers_v"))
    return out.withColumn("p", chi2_tail(F.col("chi2"), F.col("dof").cast("double"))) if tail else out


def by_strata(df: DataFrame, stratum: str, least: int, f) -> DataFrame | None:
    """f of each stratum with enough rows, under the stratum's value. The strata's values must be few: they are listed on the driver."""
    sizes = df.groupBy(stratum).count().where((F.col("count") >= least) & F.col(stratum).isNotNull()).orderBy(stratum).collect()
    out = None
    for r in sizes:
        part = f(df.where(F.col(stratum) == r[0])).withColumn(stratum, F.lit(r[0]))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out


def share_where(condition: Column) -> Column:
    return 100.0 * F.avg(condition.cast("double"))
