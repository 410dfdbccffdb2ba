"""Counts, shares and distribution summaries. Nulls count where the docstring says so."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from ..functions.text import KEYWORDS, has_word
from . import quantiles


def group_share(df: DataFrame, col: str) -> DataFrame:
    """Count of each non-null value and its percentage of all rows, nulls included in the whole."""
    total = df.agg(F.count("*").alias("_total"))
    counts = df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count("*").alias("n"))
    return counts.join(F.broadcast(total)).select(col, "n", F.round(100.0 * F.col("n") / F.col("_total"), 2).alias("pct"))


def non_null_report(df: DataFrame, cols: list[str]) -> DataFrame:
    one = df.agg(F.count("*").alias("_n"), *[F.count(c).alias(c) for c in cols])
    return one.unpivot(["_n"], cols, "variable", "n_non_null").select("variable", "n_non_null", (F.col("_n") - F.col("n_non_null")).alias("n_missing"), (100.0 * F.col("n_non_null") / F.col("_n")).alias("pct_non_null"))


def describe(df: DataFrame, cols: list[str], percentiles: tuple[float, ...] = (0.01, 0.05, 0.5, 0.95, 0.99)) -> DataFrame:
    """One row a column: count, mean, sample deviation, least, exact percentiles, greatest."""
    def stats(c: str):
        return F.struct(F.lit(c).alias("variable"), F.count(c).alias("n"), F.avg(c).alias("mean"), F.stddev_samp(c).alias("std"), F.min(c).cast("double").alias("min"), F.max(c).cast("double").alias("max"))

    one = df.agg(F.array(*[stats(c) for c in cols]).alias("s")).select(F.inline("s"))
    ps = [F.col("q")[i].alias(f"p{round(100 * p):02d}") for i, p in enumerate(percentiles)]
    return one.join(F.broadcast(quantiles.percentiles(df, cols, list(percentiles))), "variable", "left").select("variable", "n", "mean", "std", "min", *ps, "max")


def describe_all(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """One row a column of any kind: count, unique, top, freq (strings), mean, std, min, quartiles, max (numbers)."""
    cols = cols or df.columns
    numeric = [f.name for f in df.schema if f.name in cols and isinstance(f.dataType, NumericType)]
    text = [c for c in cols if c not in numeric]
    empty = {"unique": "bigint", "top": "string", "freq": "bigint", "mean": "double", "std": "double", "min": "double", "p25": "double", "p50": "double", "p75": "double", "max": "double"}
    parts = []
    if numeric:
        parts.append(describe(df, numeric, (0.25, 0.5, 0.75)).withColumnRenamed("n", "count"))
    if text:
        counts = df.select(*[F.col(c).cast("string").alias(c) for c in text]).unpivot([], text, "variable", "value").where("value IS NOT NULL").groupBy("variable", "value").agg(F.count("*").alias("n"))
        first = F.min(F.struct((-F.col("n")).alias("k"), "value")).alias("first")
        parts.append(counts.groupBy("variable").agg(F.sum("n").alias("count"), F.count("*").alias("unique"), first).select("variable", "count", "unique", F.col("first.value").alias("top"), (-F.col("first.k")).alias("freq")))
    full = [p.select("variable", "count", *[F.col(c).cast(t).alias(c) if c in p.columns else F.lit(None).cast(t).alias(c) for c, t in empty.items()]) for p in parts]
    return reduce(DataFrame.unionByName, full)


def value_counts(df: DataFrame, col: str, top: int = 30) -> DataFrame:
    """The most frequent values, null among them; ties by value."""
    return df.groupBy(col).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.asc_nulls_first(col)).limit(top)


def numeric_stats(df: DataFrame, cols: list[str], by: str | None = None) -> DataFrame:
    """Long table by variable (and group): n, mean, median, deviation, least, quartiles, greatest, coefficient of variation (null at mean 0)."""
    long = df.unpivot([by] if by else [], cols, "variable", "value").where("value IS NOT NULL")
    keys = ([by] if by else []) + ["variable"]
    out = long.groupBy(*keys).agg(F.count("*").alias("n"), F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"), F.min("value").alias("min"), F.max("value").alias("max"))
    out = quantiles.beside(out, quantiles.percentiles(df, cols, [0.25, 0.5, 0.75], keys[:-1]), keys)
    return out.select(*keys, "n", "mean", F.col("q")[1].alias("median"), "std", "min", F.col("q")[0].alias("p25"), F.col("q")[2].alias("p75"), "max", F.when(F.col("mean") != 0, F.col("std") / F.col("mean")).alias("cv"))


def category_counts(df: DataFrame, cols: list[str], by: str) -> DataFrame:
    """(by, variable, category, n, total, rank): ranks by count, ties by value, null last of its tie."""
    long = df.select(by, *[F.col(c).cast("string").alias(c) for c in cols]).unpivot([by], cols, "variable", "category")
    counts = long.groupBy(by, "variable", "category").agg(F.count("*").alias("n"))
    group = Window.partitionBy(by, "variable")
    return counts.withColumns({"total": F.sum("n").over(group), "rank": F.row_number().over(group.orderBy(F.desc("n"), F.asc_nulls_last("category")))})


def category_stats(df: DataFrame, cols: list[str], by: str, top: int = 8) -> DataFrame:
    """Mode, its count and percentage, number of categories (null is one) and the top ones as text."""
    counts = category_counts(df, cols, by)
    label = F.format_string("%s: %d (%.1f%%)", F.coalesce("category", F.lit("<NA>")), F.col("n"), 100.0 * F.col("n") / F.col("total"))
    first = lambda c: F.max(F.when(F.col("rank") == 1, F.col(c)))
    listed = F.array_sort(F.collect_list(F.when(F.col("rank") <= top, F.struct("rank", label.alias("t")))))
    return counts.groupBy(by, "variable").agg(first("category").alias("mode"), first("n").alias("mode_n"), (100.0 * first("n") / F.max("total")).alias("mode_pct"), F.count("*").alias("n_categories"), F.array_join(F.transform(listed, lambda s: s["t"]), "; ").alias("top"))


def category_profile(df: DataFrame, cols: list[str], by: str, top: int = 10) -> DataFrame:
    return category_counts(df, cols, by).where(F.col("rank") <= top).select(by, "variable", "category", "n", (100.0 * F.col("n") / F.col("total")).alias("pct"))


def missing_report(before: DataFrame, after: DataFrame, cols: list[str]) -> DataFrame:
    count = lambda df, name: df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols]).unpivot([], cols, "variable", name)
    return count(before, "missing_before").join(count(after, "missing_after"), "variable")


def contingency(df: DataFrame, row: str, col: str) -> DataFrame:
    """Counts of pairs without nulls, as a long table: the number of columns isn't bounded."""
    return df.where(F.col(row).isNotNull() & F.col(col).isNotNull()).groupBy(row, col).agg(F.count("*").alias("n"))


def row_shares(df: DataFrame, row: str, col: str, top: int = 8) -> DataFrame:
    """Percentages within rows over all columns, of the overall top columns."""
    counts = contingency(df, row, col)
    best = counts.groupBy(col).agg(F.sum("n").alias("_all")).orderBy(F.desc("_all"), col).limit(top)
    shares = counts.withColumn("pct", 100.0 * F.col("n") / F.sum("n").over(Window.partitionBy(row)))
    return shares.join(F.broadcast(best), col).select(row, col, "pct")


def keyword_summary(df: DataFrame, folded: str, shown: str, order: str, keywords: list[str] = KEYWORDS, examples: int = 10) -> DataFrame:
    """For each keyword: rows that have it as a word, their percentage, and the first different texts in order. One pass over the rows."""
    hits = F.filter(F.array(*[F.when(has_word(F.col(folded), k), F.lit(k)) for k in keywords]), lambda k: k.isNotNull())
    rows = df.select(hits.alias("k"), shown, order)
    found = rows.select(F.explode("k").alias("keyword"), shown, order)
    counts = found.groupBy("keyword").agg(F.count("*").alias("n"))
    firsts = found.groupBy("keyword", shown).agg(F.min(order).alias("_at"))
    firsts = firsts.withColumn("_r", F.row_number().over(Window.partitionBy("keyword").orderBy("_at"))).where(F.col("_r") <= examples)
    listed = firsts.groupBy("keyword").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_r", shown))), lambda s: s[shown]), " | ").alias("examples"))
    every = df.sparkSession.createDataFrame([(k,) for k in keywords], "keyword string")
    total = df.agg(F.count("*").alias("_total"))
    return every.join(counts, "keyword", "left").join(listed, "keyword", "left").join(F.broadcast(total)).select("keyword", F.coalesce("n", F.lit(0)).alias("n"), (100.0 * F.coalesce("n", F.lit(0)) / F.col("_total")).alias("pct"), F.coalesce("examples", F.lit("")).alias("examples"))


def word_counts(df: DataFrame, array_col: str, name: str = "word") -> DataFrame:
    return df.select(F.explode(array_col).alias(name)).groupBy(name).agg(F.count("*").alias("n"))


def top(df: DataFrame, n: int, *order) -> DataFrame:
    return df.orderBy(*order).limit(n)


def top_per_group(df: DataFrame, by: str, n: int, *order) -> DataFrame:
    return df.withColumn("_r", F.row_number().over(Window.partitionBy(by).orderBy(*order))).where(F.col("_r") <= n).drop("_r")
