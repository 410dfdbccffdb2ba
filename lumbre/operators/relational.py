"""Joins, pivots, top-1 matches, upserts and dedup, on DataFrames of any columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.sinks import staged


def spread(df: DataFrame) -> DataFrame:
    """Rows over all cores before costly expressions, where a small file has come as fewer partitions; large tables pass unchanged."""
    n = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= n else df.repartition(n)


def left_chain(first: DataFrame, *others: tuple[DataFrame, str]) -> DataFrame:
    return reduce(lambda df, other: df.join(other[0], other[1], "left"), others, first)


def pivot_filtered_max(df: DataFrame, key: str, name: str, value: str, wanted: list[str], prefix: str = "") -> DataFrame:
    """One row a key; a column for each wanted name with the largest value. One aggregate, before any join, so that nothing fans out."""
    return df.groupBy(key).agg(*[F.max(F.when(F.col(name) == w, F.col(value))).alias(prefix + w) for w in wanted])


def best_match(left: DataFrame, right: DataFrame, on: Column, left_key: list[str], order: list[Column]) -> DataFrame:
    """A left join that keeps the first right row of each left row in the given (ascending) order. match_order() ranks conditions: a null outranks a match.

    The least row is an aggregate, which is made where the pairs are joined: pairs themselves are neither sorted nor sent on by left row. left_key must name one left row.
    """
    names = [*left.columns, *[c for c in right.columns if c not in left.columns]]
    joined = left.join(right, on, "left").select(*names, *[c.alias(f"_order{i}") for i, c in enumerate(order)])
    best = joined.groupBy(*left_key).agg(F.min(F.struct(*[f"_order{i}" for i in range(len(order))], *[c for c in names if c not in left_key])).alias("_best"))
    return best.select(*[c if c in left_key else F.col(f"_best.{c}").alias(c) for c in names])


def match_order(*conditions: Column) -> list[Column]:
    """Null before true before false, as whole numbers."""
    return [F.when(c.isNull(), 0).when(c, 1).otherwise(2) for c in conditions]


def best_above(left: DataFrame, right: DataFrame, keys: tuple[str, str], values: tuple[str, str], kinds: tuple[Column, Column], tie: str, left_key: list[str]) -> DataFrame:
    """best_match() on equal keys in the order: right value over the left one, same kind, tie. Each pair names the left and the right column.

    A right row that has a lower or equal value and a later tie than another one of its kind (or, for left rows of other kinds, of its key) is never first and is left out. The rest are steps:
    each holds for the left values from the step before up to its own, so that a left row meets a few of them and not all rows of its key.
    """
    value, kind = F.col(values[1]), kinds[1]
    scopes = []
    for within in ([kind], []):
        order = Window.partitionBy(keys[1], *within, value.isNull()).orderBy(tie, value.desc())
        steps = right.withColumns({"_low": F.max(value).over(order.rowsBetween(Window.unboundedPreceding, -1)), "_first": F.row_number().over(order) == 1, "_any": F.lit(not within)})
        scopes.append(steps.where(F.col("_first") | (value > F.col("_low"))))
    t = F.col(values[0])
    same = kinds[1] == kinds[0]
    on = (F.col(keys[1]) == F.col(keys[0])) & (F.col("_any") | F.coalesce(same, F.lit(True))) & (F.col("_first") | ((F.col("_low") <= t) & (value > t)))
    return best_match(left, scopes[0].unionByName(scopes[1]), on, left_key, [*match_order(value > t, same), F.col(tie)]).drop("_low", "_first", "_any")


def plausible_point(lon: Column, lat: Column, lon_range: tuple[float, float], lat_range: tuple[float, float], srid: int = 4326) -> tuple[Column, Column]:
    """(valid, point): three-valued validity, and struct(x, y, srid) or null."""
    valid = lon.between(*lon_range) & lat.between(*lat_range)
    return valid, F.when(valid, F.struct(lon.alias("x"), lat.alias("y"), F.lit(srid).alias("srid")))


def wkt_point(lon: Column, lat: Column) -> Column:
    return F.concat(F.lit("POINT("), lon.cast("string"), F.lit(" "), lat.cast("string"), F.lit(")"))


def load_totals(df: DataFrame, pair: tuple[str, str], date: str) -> DataFrame:
    """Rows, distinct pairs (a pair with nulls counts), least and greatest date."""
    return df.agg(F.count("*").alias("n_rows"), F.countDistinct(F.struct(*pair)).alias("n_pairs"), F.min(date).alias("first_date"), F.max(date).alias("last_date"))


def newest_first(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_n = 1").drop("_n")


def upsert_replace(old: DataFrame, new: DataFrame, keys: list[str], order: list[Column] | None = None) -> DataFrame:
    """Whole rows of new replace those of old with the same key; a column that new lacks becomes null. Of several new rows of a key the first in order wins."""
    if order:
        new = newest_first(new, keys, order)
    kept = old.join(new.select(*keys).distinct(), keys, "left_anti")
    return kept.unionByName(new, allowMissingColumns=True)


def upsert_update(old: DataFrame, new: DataFrame, key: str, surrogate: str, order: Column) -> DataFrame:
    """Rows of new update those of old and keep their surrogate id; the rest are numbered on from the largest, in order. No row vanishes.

    Numbers are dealt out without a single-task window: rows are numbered within range partitions and each partition starts after those before.
    """
    top = old.agg(F.coalesce(F.max(surrogate), F.lit(0))).first()[0]
    columns = [c for c in old.columns if c != surrogate]
    known = old.select(key, surrogate)
    joined = new.join(known, key, "left")
    fresh = numbered(joined.where(F.col(surrogate).isNull()).drop(surrogate), order, surrogate, top + 1)
    updated = joined.where(F.col(surrogate).isNotNull())
    kept = old.join(new.select(key).distinct(), key, "left_anti")
    names = [surrogate, *columns]
    return kept.select(*names).unionByName(updated.select(*names)).unionByName(fresh.select(*names))


def numbered(df: DataFrame, order: Column, name: str, start: int = 1) -> DataFrame:
    """A dense number in the given order over any number of partitions.

    Rows are sorted and written out once with their partition's number and their place in it, so no later loss or re-run can deal them out anew. Holds the partitions' sizes on the driver, one number each.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = staged(df.repartitionByRange(n, order).sortWithinPartitions(order).withColumn("_at", F.monotonically_increasing_id()))
    part, place = F.shiftright("_at", 33), F.col("_at").bitwiseAND((1 << 33) - 1)
    sizes = dealt.groupBy(part.alias("part")).count().collect()
    before, run = {}, start
    for p, size in sorted(map(tuple, sizes)):
        before[p] = run
        run += size
    starts = F.create_map(*[F.lit(x) for kv in (before or {0: start}).items() for x in kv])
    return dealt.withColumn(name, (starts[part] + place).cast("long")).drop("_at")


def update_join(df: DataFrame, changes: DataFrame, key: str, column: str) -> DataFrame:
    """UPDATE ... SET column from changes; rows without a change keep theirs."""
    new = changes.select(key, F.col(column).alias("_new"), F.lit(True).alias("_hit"))
    base = df if column in df.columns else df.withColumn(column, F.lit(None).cast(changes.schema[column].dataType))
    return base.join(new, key, "left").withColumn(column, F.when(F.col("_hit"), F.col("_new")).otherwise(F.col(column))).select(*base.columns)


def resume(candidates: DataFrame, log: DataFrame, key: list[str], title: str, name: str, state: str = "estado") -> DataFrame:
    """Candidates that the log doesn't hold as ok, under their title or their name, against either of the log's."""
    ok = log.where(F.col(state) == "ok")
    done = ok.select(*key, F.explode(F.array(title, name)).alias("_action")).where(F.col("_action").isNotNull() & (F.lower("_action") != "nan") & (F.col("_action") != "")).distinct()
    out = candidates
    for c in (title, name):
        out = out.join(done.withColumnRenamed("_action", c), [*key, c], "left_anti")
    return out.select(*candidates.columns)


def zip_positions(left: Column, right: Column, pad: bool) -> Column:
    """Pairs by position: padded with nulls to the longer, or cut to the shorter."""
    pairs = F.arrays_zip(left, right)
    return pairs if pad else F.slice(pairs, 1, F.least(F.size(left), F.size(right)))


def assign_by_order(rows: Column, fields: list[str | None], convert=lambda c: c) -> list[Column]:
    """Columns for fields from the array's positions; a None field is passed over, missing positions are null."""
    return [convert(F.try_element_at(rows, F.lit(i + 1))).alias(f) for i, f in enumerate(fields) if f]


def dedup_rows(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()


def dedup_keep_last(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    return newest_first(df, keys, [F.col(order).desc()])


def sorted_catalogue(df: DataFrame, keys: list[str], order: str, by: list[str]) -> DataFrame:
    """The last row of each key, sorted."""
    return dedup_keep_last(df, keys, order).orderBy(*by)


def random_sample(df: DataFrame, n: int, seed: int | None = None) -> DataFrame:
    """n rows in random order; without a seed, others each time."""
    return df.orderBy(F.rand(seed) if seed is not None else F.rand()).limit(n)


def seeded_sample(df: DataFrame, key: str, n: int, seed: int) -> DataFrame:
    """n rows that depend on the seed and the keys alone."""
    return df.orderBy(F.xxhash64(F.col(key), F.lit(seed)), key).limit(n)
