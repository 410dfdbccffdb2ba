"""Shared-folder staging, skew-safe joins and contraction-based components."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of one key that a task may receive before the key is salted.
HOT_ROWS = 1000
#: No more keys than this are ever called hot, so the hot list stays small enough to broadcast.
HOT_KEYS = 500
#: Bytes of an Arrow batch.
ARROW_BYTES = 2 << 20


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share: spark.checkpoint.dir. Only a session that is one process (tests) may go without: it gets a new local folder."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = f"file://{tempfile.mkdtemp(prefix='lumbre-')}"
        spark.conf.set("spark.checkpoint.dir", base)
    return base.rstrip("/")


def small_batches(spark: SparkSession) -> None:
    """Arrow batches of at most ARROW_BYTES in this session, unless it asks for smaller ones: texts are long, and a task holds several batches at once."""
    now = spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch", "64m").lower().rstrip("b")
    unit = {"k": 1 << 10, "m": 1 << 20, "g": 1 << 30}.get(now[-1:], 1)
    if (int(now.rstrip("kmg") or -1) * unit) not in range(1, ARROW_BYTES + 1):
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write df to the shared folder and read it back: cuts the lineage and survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/lumbre/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._staged = path
    return out


def discard(*frames: DataFrame) -> None:
    """Delete what stage() wrote for these frames. Only for those that nothing still unread builds on."""
    for df in frames:
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df._staged)
        path.getFileSystem(df.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def as_rows(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the two columns an operator works on, under fixed names: clashing extra columns can't interfere."""
    small_batches(df.sparkSession)
    return df.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))


def packed(df: DataFrame, **keys: Column) -> DataFrame:
    """df as one struct column `row` with the given columns beside it: no name of df can clash with them. `row.*` gives df back."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), *[c.alias(k) for k, c in keys.items()])


def without(df: DataFrame, gone: DataFrame, **keys: Column) -> DataFrame:
    """The rows of df whose keys (expressions over df) are not in gone, which has columns of these names; nulls are equal."""
    theirs = gone.select(*[F.col(k).alias(f"gone_{k}") for k in keys])
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"gone_{k}")) for k in keys])
    return packed(df, **keys).join(theirs, same, "left_anti").select("row.*")


def skew_join(rows: DataFrame, groups: DataFrame, keys: list[str], size: str, salt_by: Column, how: str = "left") -> DataFrame:
    """Join rows to groups (one row a key, with its number of rows in column size) without sending a hot key to one task.

    A key is hot above max(HOT_ROWS, rows / HOT_KEYS); there are at most HOT_KEYS of those, which is
    the proven bound of the one table that is broadcast. The groups' rows of hot keys are repeated once a salt.
    groups must be staged or cheap: it is read twice.
    """
    total = groups.agg(F.sum(size)).first()[0] or 0
    limit = max(HOT_ROWS, total // HOT_KEYS)
    hot = groups.where(F.col(size) > limit).select(*keys, F.ceil(F.col(size) / limit).cast("int").alias("_salts"))
    salted_groups = groups.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.when(F.col(size) > limit, F.ceil(F.col(size) / limit).cast("int") - 1).otherwise(0))))
    salted_rows = rows.join(F.broadcast(hot), keys, "left").withColumn("_salt", F.pmod(salt_by, F.coalesce("_salts", F.lit(1))).cast("int")).drop("_salts")
    return salted_rows.join(salted_groups, [*keys, "_salt"], how).drop("_salt")


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def local_forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Union-find over the links (a, b) of a partition: one row (node, root) for each node; the root is the least id of its tree."""
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        root = x
        while (up := parent.setdefault(root, root)) != root:
            root = up
        while parent[x] != root:
            parent[x], x = root, parent[x]
        return root

    for batch in batches:
        for a, b in zip(column(batch, "a").to_pylist(), column(batch, "b").to_pylist(), strict=True):
            x, y = find(a), find(b)
            if x != y:
                parent[max(x, y)] = min(x, y)
    nodes = list(parent)
    for i in range(0, len(nodes), 50_000):
        part = nodes[i : i + 50_000]
        yield pa.RecordBatch.from_arrays([pa.array(part, pa.int64()), pa.array([find(x) for x in part], pa.int64())], ["node", "root"])


def components(links: DataFrame, name: str = "components", rows_per_task: int = 200_000) -> DataFrame:
    """(node, component) for every node of links (a, b); component is the least id that is reachable.

    Each round runs union-find within partitions and links the roots that share a node; the rounds shrink
    geometrically. Nothing is gathered on the driver but row counts.
    """
    spark = links.sparkSession
    links = stage(links.where(F.col("a") != F.col("b")).select("a", "b"), f"{name}-links")
    levels: list[DataFrame] = []
    while (n := links.count()) or not levels:
        tasks = max(1, min(partitions(spark), n // rows_per_task + 1))
        # Links meet by their smaller end, so that stars are united in one task; a hot end only makes its task's dictionary
        # larger by one entry a link, and is dealt out by both ends in the next line if the tasks are many.
        dealt = links.coalesce(1) if tasks == 1 else links.repartition(tasks, "a", F.pmod(F.xxhash64("b"), F.lit(4)))
        forest = stage(dealt.mapInArrow(local_forest, "node long, root long"), f"{name}-forest")
        least = stage(forest.groupBy("node").agg(F.min("root").alias("component")), f"{name}-least")
        levels.append(least)
        if tasks == 1:
            break
        links = stage(forest.join(least, "node").where("root <> component").select(F.col("component").alias("a"), F.col("root").alias("b")).distinct(), f"{name}-next")
    out = levels.pop()
    while levels:
        upper = out.select(F.col("node").alias("component"), F.col("component").alias("_upper"))
        out = levels.pop().join(upper, "component", "left").select("node", F.coalesce("_upper", "component").alias("component"))
        out = stage(out, f"{name}-labels")
    return out
