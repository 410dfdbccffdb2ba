import numpy as np
from pyspark.sql import functions as F

from lumbre.operators import relational

KEYS, VALUES = ("k", "r_k"), ("v", "r_v")


def test_same_rows_as_all_pairs(spark):
    """Nulls in every column, ties, keys without a partner and values that rise with the tie."""
    rng = np.random.default_rng(4)
    some = lambda n: None if rng.random() < 0.15 else int(rng.integers(0, n))
    left = spark.createDataFrame([(i, some(5), None if i % 9 == 0 else float(i % 13), some(4)) for i in range(300)], "id long, k int, v double, kind int")
    right = spark.createDataFrame([(i, some(4), (lambda x: None if x is None else float(x))(some(14)) if i % 3 else i / 6, some(4)) for i in range(80)] + [(90, 3, float("nan"), 1)], "uid long, r_k int, r_v double, r_kind int")
    order = [*relational.match_order(F.col("r_v") > F.col("v"), F.col("r_kind") == F.col("kind")), F.col("uid")]
    wanted = relational.best_match(left, right, F.col("r_k") == F.col("k"), ["id"], order).select("id", "uid").collect()
    got = relational.best_above(left, right, KEYS, VALUES, (F.col("kind"), F.col("r_kind")), "uid", ["id"])
    assert got.columns == [*left.columns, *right.columns] and sorted(map(tuple, got.select("id", "uid").collect())) == sorted(map(tuple, wanted))


def test_a_hot_key_is_no_square(spark, monkeypatch):
    """Pairs that reach the aggregate are a few for each left row, with any number of right rows of its key."""
    left = spark.range(2000).select("id", F.lit(1).alias("k"), (F.hash("id") % 1000).cast("double").alias("v"), F.lit(0).alias("kind"))
    right = spark.range(1500).select(F.col("id").alias("uid"), F.lit(1).alias("r_k"), (F.col("id") - 750).cast("double").alias("r_v"), (F.col("id") % 3).cast("int").alias("r_kind"))
    pairs, best_match = [], relational.best_match

    def counted(left, right, on, *more):
        pairs.append(left.join(right, on, "left").count())
        return best_match(left, right, on, *more)

    monkeypatch.setattr(relational, "best_match", counted)
    assert relational.best_above(left, right, KEYS, VALUES, (F.col("kind"), F.col("r_kind")), "uid", ["id"]).count() == 2000 and pairs[0] <= 6 * 2000


def test_serving_view_joins_a_hot_nation_without_all_pairs(spark, monkeypatch, tmp_path):
    """Against the SQL, with all customers and suppliers in one nation."""
    import duckdb

    from lumbre.plans import catalogue

    d = "/root/testdata/sf0.001"
    for t, key in (("customer", "c_nationkey"), ("supplier", "s_nationkey"), ("orders", None), ("lineitem", None)):
        df = spark.read.parquet(f"{d}/{t}.parquet")
        if t == "supplier":
            df = df.crossJoin(spark.range(40).withColumnRenamed("id", "i")).withColumns({"s_suppkey": F.col("s_suppkey") + 1000 * F.col("i"), "s_acctbal": F.col("s_acctbal") + F.col("i")}).drop("i")
        (df.withColumn(key, F.lit(3)) if key else df).write.parquet(f"{tmp_path}/{t}.parquet")
    pairs, best_match = [], relational.best_match

    def counted(left, right, on, *more):
        pairs.append(left.join(right, on, "left").count() / left.count())
        return best_match(left, right, on, *more)

    monkeypatch.setattr(relational, "best_match", counted)
    df = catalogue.serving_view(spark, str(tmp_path))
    con = duckdb.connect()
    for t in ("customer", "supplier", "orders", "lineitem"):
        con.execute(f"create view {t} as select * from '{tmp_path}/{t}.parquet/*.parquet'")
    cur = con.execute(catalogue.oracle_sql()["serving_view"])
    names = [c[0] for c in cur.description]
    assert sorted(map(tuple, df.select(*names).collect()), key=str) == sorted(cur.fetchall(), key=str)
    assert max(pairs) <= 6
