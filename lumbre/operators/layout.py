"""From the characters of document pages to words, rows and regions.

A document's parser is pluggable: it must give characters (doc, page, seqno, layer, opacity, text, x0, y0, x1, y1) and covering shapes (doc, page, seqno, kind, bbox).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

COVERING_KINDS = ["fill-path", "fill-image", "fill-shade"]
BOX = ("x0", "y0", "x1", "y1")


def area(x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    return F.greatest(F.lit(0.0), x1 - x0) * F.greatest(F.lit(0.0), y1 - y0)


def box(prefix: str = "") -> tuple[Column, ...]:
    return tuple(F.col(prefix + c) for c in BOX)


def common_area(a: tuple[Column, ...], b: tuple[Column, ...]) -> Column:
    return area(F.greatest(a[0], b[0]), F.greatest(a[1], b[1]), F.least(a[2], b[2]), F.least(a[3], b[3]))


def intersects(a: tuple[Column, ...], b: tuple[Column, ...]) -> Column:
    return (a[0] < b[2]) & (b[0] < a[2]) & (a[1] < b[3]) & (b[1] < a[3])


def overlap_ratio(a: tuple[Column, ...], b: tuple[Column, ...]) -> Column:
    """Common area in the smaller box; 0 if that has none."""
    least = F.least(area(*a), area(*b))
    return F.when(least > 0, common_area(a, b) / least).otherwise(0.0)


def visible_chars(chars: DataFrame, shapes: DataFrame, least_area: float = 20.0, threshold: float = 0.55, least_opacity: float = 0.05) -> DataFrame:
    """chars that are opaque, with `hidden`: a later shape covers the threshold's part of it. Joined on document and page."""
    covers = shapes.where(F.col("kind").isin(COVERING_KINDS) & (area(*box()) >= least_area)).select("doc", "page", F.col("seqno").alias("s_seqno"), *[F.col(c).alias("s_" + c) for c in BOX])
    keys = ["doc", "page", "seqno", *BOX, "text"]
    own = chars.where(F.col("opacity") > least_opacity)
    part = common_area(box(), box("s_")) / F.nullif(area(*box()), F.lit(0.0))
    hit = own.join(covers, ["doc", "page"]).where((F.col("s_seqno") > F.col("seqno")) & intersects(box(), box("s_")) & (part >= threshold)).select(*keys).distinct().withColumn("_hit", F.lit(True))
    return own.join(hit, keys, "left").withColumn("hidden", F.coalesce("_hit", F.lit(False))).drop("_hit")


def bands(df: DataFrame, keys: list[str], y: str, tolerance: float, order: list[str]) -> DataFrame:
    """`line`: rows of a key whose y lies within the tolerance of the running mean of the line before, in order of y. One fold a key, without Python."""
    item = F.struct(F.col(y).cast("double").alias("y"), F.struct(*order).alias("o"), F.struct(*[c for c in df.columns if c not in keys]).alias("r"))
    folded = F.aggregate(
        "_items",
        F.struct(F.lit(0).alias("line"), F.lit(0.0).alias("mean"), F.lit(0).alias("n"), F.array().cast("array<int>").alias("out")),
        lambda a, x: F.when((a["n"] > 0) & (F.abs(x["y"] - a["mean"]) <= tolerance), F.struct(a["line"].alias("line"), ((a["mean"] * a["n"] + x["y"]) / (a["n"] + 1)).alias("mean"), (a["n"] + 1).alias("n"), F.concat(a["out"], F.array(a["line"])).alias("out"))).otherwise(
            F.struct((a["line"] + 1).alias("line"), x["y"].alias("mean"), F.lit(1).alias("n"), F.concat(a["out"], F.array(a["line"] + 1)).alias("out"))
        ),
    )
    grouped = df.groupBy(*keys).agg(F.array_sort(F.collect_list(item)).alias("_items")).withColumn("_lines", folded["out"])
    return grouped.select(*keys, F.explode(F.arrays_zip("_items", "_lines")).alias("_z")).select(*keys, "_z._items.r.*", F.col("_z._lines").alias("line"))


def split_words(chars: DataFrame, keys: list[str], least_gap: float = 2.0, widths: float = 1.8) -> DataFrame:
    """Words of lines of characters: cut at blanks, hidden characters and gaps wider than max(least_gap, widths * median width of the line)."""
    line = Window.partitionBy(*keys)
    ordered = line.orderBy("x0", "x1")
    median = F.percentile("w", 0.5).over(line)
    blank = F.trim("text") == ""
    rows = chars.withColumn("w", F.col("x1") - F.col("x0")).withColumn("_limit", F.greatest(F.lit(least_gap), widths * median)).withColumn("_blank", blank | F.coalesce(F.col("hidden"), F.lit(False)) if "hidden" in chars.columns else blank)
    rows = rows.withColumn("_cut", (F.coalesce(F.col("x0") - F.lag("x1").over(ordered) > F.col("_limit"), F.lit(True)) | F.col("_blank") | F.coalesce(F.lag("_blank").over(ordered), F.lit(False))).cast("int"))
    rows = rows.withColumn("word", F.sum("_cut").over(ordered.rowsBetween(Window.unboundedPreceding, 0))).where(~F.col("_blank"))
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("x0", "x1", "text"))), lambda c: c["text"]), "")
    return rows.groupBy(*keys, "word").agg(text.alias("text"), F.min("x0").alias("x0"), F.min("y0").alias("y0"), F.max("x1").alias("x1"), F.max("y1").alias("y1"))


def words_in_regions(words: DataFrame, regions: DataFrame, margin: float = 0.0) -> DataFrame:
    """Words whose centre lies in a region of their page. The regions are a template of a few dozen; they are broadcast if Spark finds them small."""
    r = regions.select(F.col("id").alias("region_id"), "page", *[F.col(c).alias("r_" + c) for c in BOX])
    cx, cy = (F.col("x0") + F.col("x1")) / 2, (F.col("y0") + F.col("y1")) / 2
    inside = cx.between(F.col("r_x0") - margin, F.col("r_x1") + margin) & cy.between(F.col("r_y0") - margin, F.col("r_y1") + margin)
    return words.join(r, "page").where(inside).drop(*["r_" + c for c in BOX])


def dedup_words(words: DataFrame, keys: list[str], tolerance: float = 1.0, overlap: float = 0.8, near: float = 0.7) -> DataFrame:
    """Equal words of a page that lie on each other, once: first by rounded place, then greedily in reading order (a page at a time)."""
    place = [F.rint(F.col(c) / tolerance).alias("_" + c) for c in BOX]
    order = Window.partitionBy(*keys, "text", *place).orderBy("y0", "x0")
    first = words.withColumn("_n", F.row_number().over(order)).where("_n = 1").drop("_n")

    def same(w: Column, k: Column) -> Column:
        a, b = (tuple(x[c] for c in BOX) for x in (w, k))
        apart = F.greatest(F.abs(a[0] + a[2] - b[0] - b[2]), F.abs(a[1] + a[3] - b[1] - b[3])) / 2
        return (overlap_ratio(a, b) >= overlap) | (apart <= near)

    # Only equal words of a page can lie on each other: one fold over the few of them, without Python.
    others = [c for c in first.columns if c not in (*keys, "text", *BOX)]
    item = F.struct("y0", "x0", "x1", "y1", F.struct(F.lit(0).alias("_"), *others).alias("r"))
    equal = first.groupBy(*keys, "text").agg(F.array_sort(F.collect_list(item)).alias("_all"))
    kept = F.aggregate("_all", F.slice("_all", 1, 0), lambda held, w: F.when(F.exists(held, lambda k: same(w, k)), held).otherwise(F.concat(held, F.array(w))))
    return equal.select(*keys, "text", F.explode(kept).alias("_w")).select(*[F.col(f"_w.{c}") if c in BOX else F.col(f"_w.r.{c}") if c in others else F.col(c) for c in first.columns])


def rows_of(words: DataFrame, keys: list[str], tolerance: float = 3.5) -> DataFrame:
    """Rows of words: text in reading order, bounding box, number of words, row_index from 1."""
    lines = bands(words.withColumn("_y", (F.col("y0") + F.col("y1")) / 2), keys, "_y", tolerance, ["x0"])
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("x0", "text"))), lambda w: w["text"]), " ")
    rows = lines.groupBy(*keys, "line").agg(text.alias("text"), F.min("x0").alias("x0"), F.min("y0").alias("y0"), F.max("x1").alias("x1"), F.max("y1").alias("y1"), F.count("*").alias("n_words"))
    return rows.withColumn("row_index", F.row_number().over(Window.partitionBy(*keys).orderBy("y0", "x0"))).drop("line")


def merge_wrapped(rows: DataFrame, keys: list[str], gap: float = 4.0) -> DataFrame:
    """Rows that follow without a vertical gap become one: islands behind the running bottom."""
    order = Window.partitionBy(*keys).orderBy("y0", "x0")
    bottom = F.max("y1").over(order.rowsBetween(Window.unboundedPreceding, -1))
    marked = rows.withColumn("_new", F.coalesce((F.col("y0") - bottom > gap).cast("int"), F.lit(1)))
    marked = marked.withColumn("record", F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("y0", "x0", "text"))), lambda r: r["text"]), " ")
    return marked.groupBy(*keys, "record").agg(text.alias("text"), F.min("x0").alias("x0"), F.min("y0").alias("y0"), F.max("x1").alias("x1"), F.max("y1").alias("y1"), F.sum("n_words").alias("n_words"))


def page_words(chars: DataFrame, shapes: DataFrame, y_tolerance: float = 2.8) -> DataFrame:
    """Visible words of every page: opacity, covering shapes, lines within a drawing step, gaps."""
    seen = visible_chars(chars, shapes)
    keys = ["doc", "page", "seqno"]
    lines = bands(seen.withColumn("_y", (F.col("y0") + F.col("y1")) / 2), keys, "_y", y_tolerance, ["x0"])
    return split_words(lines, [*keys, "line"]).drop("word", "line")


def region_rows(words: DataFrame, regions: DataFrame, margin: float = 0.0, y_tolerance: float = 3.5) -> DataFrame:
    """doc, region_id, row_index, text, box, n_words of all regions."""
    unique = dedup_words(words.drop("seqno"), ["doc", "page"])
    return rows_of(words_in_regions(unique, regions, margin), ["doc", "region_id"], y_tolerance)
