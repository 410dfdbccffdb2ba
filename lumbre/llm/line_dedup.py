"""Line dedup by winnowing over line hashes, in built-in expressions only.

Each text is cut at line feeds. A run of lines counts as a passage if it has `run` lines or `words` words (pieces between ASCII white space).
Windows are the shortest passages that start at a line and the shortest that end at one: together they cover every passage and nothing else.
The least line hash of a window is its fingerprint, so two places that share a passage share one. Fingerprints that come from one line of the
corpus alone are dropped; around the places of the others all windows that chose them are compared, to both sides, and every line of a window
whose lines have occurred at an earlier place (by doc_id, nulls first, then line) is deleted. Windows that follow each other make the deleted
runs as long as the match is. The first occurrence stays whole.

Nulls: a null text is empty and stays null. Repeated rows (same id, same text) are one document. Empty lines count as lines. A text without
passages (fewer lines and words): untouched. Very long texts: cut and hashed whole. Clashing names: extra columns of any name are kept as they are. Empty table: no rows. Ties in order can't occur between different documents with different ids;
of different texts under one id, the lesser text hash comes first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import skew_join, stage

#: A repeated run is deleted if it has this many lines ...
RUN = 3
#: ... or this many words, in however few lines.
WORDS = 50
WORD = r"[^\x20\x09-\x0D]+"


def shortest(n_words: Column, i: Column, step: int, run: int, words: int) -> Column:
    """Lines of the shortest passage that starts (step 1) or ends (step -1) at line i, from 0; null where the text is over before."""
    length, so_far = F.when(F.get(n_words, i + step * (run - 1)).isNotNull(), run), []
    for k in range(run - 1):
        so_far.append(F.get(n_words, i + step * k))
    for k in range(run - 1, 0, -1):
        length = F.when(sum(so_far[1:k], so_far[0]) >= words, k).otherwise(length)
    return length


def windows(docs: DataFrame, run: int, words: int, id_col: str, text_col: str) -> DataFrame:
    """One row a window: doc_id, mark (hash of the text), code (first line * (run + 1) + lines), print (its fingerprint), at (the line that gave it), a and b (hashes of its lines)."""
    docs = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.xxhash64(f"`{text_col}`").alias("mark"), F.split(F.col(f"`{text_col}`"), "\n", -1).alias("lines")).where("lines IS NOT NULL")
    hashes = [F.transform("lines", lambda x: F.xxhash64(x)).alias("h"), F.transform("lines", lambda x: F.xxhash64(F.lit(run), x)).alias("g")]
    docs = docs.select("doc_id", "mark", *hashes, F.transform("lines", lambda x: F.regexp_count(x, F.lit(WORD))).alias("w"))
    every, width = F.sequence(F.lit(0), F.size("w") - 1), F.lit(run + 1).cast("long")
    starting = F.transform(every, lambda i: (i + 1) * width + shortest(F.col("w"), i, 1, run, words))
    ending = F.transform(every, lambda i: (i + 2 - shortest(F.col("w"), i, -1, run, words)) * width + shortest(F.col("w"), i, -1, run, words))
    docs = docs.withColumn("codes", F.array_compact(F.array_distinct(F.concat(starting, ending))))

    def window(code: Column) -> Column:
        first, length = F.floor(code / width).cast("int"), (code % width).cast("int")
        h = F.slice("h", first, length)
        return F.struct(code.alias("code"), F.array_min(h).alias("print"), (first + F.array_position(h, F.array_min(h))).alias("at"), F.xxhash64(h).alias("a"), F.xxhash64(F.slice("g", first, length)).alias("b"))

    return docs.select("doc_id", "mark", F.inline(F.transform("codes", window))).withColumn("at", F.xxhash64("doc_id", "mark", "at"))


def deletions(docs: DataFrame, run: int = RUN, words: int = WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for every document that loses lines: doc_id, mark, gone (numbers of its deleted lines, from 1)."""
    all_windows = windows(docs, run, words, id_col, text_col)
    # Neighbouring windows often choose the same line: a fingerprint counts as repeated only where two lines gave it.
    counts = all_windows.groupBy("print").agg(F.count("*").alias("n"), F.min("at").alias("one"), F.max("at").alias("other")).where("one <> other").select("print", "n")
    counts = stage(counts, "line-prints")
    places = skew_join(all_windows, counts, ["print"], "n", F.xxhash64("doc_id", "code"), "inner").select("doc_id", "mark", "code", "a", "b")
    places = stage(places, "line-places")
    first = F.min(F.struct(F.col("doc_id").isNotNull().alias("known"), "doc_id", "mark", "code")).alias("first")
    groups = stage(places.groupBy("a", "b").agg(first, F.count("*").alias("n")).where("n > 1"), "line-groups")
    later = skew_join(places, groups, ["a", "b"], "n", F.xxhash64("doc_id", "code"), "inner").where(~(F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("mark") == F.col("first.mark")) & (F.col("code") == F.col("first.code"))))
    codes = later.groupBy("doc_id", "mark").agg(F.collect_set("code").alias("codes"))  # no more than twice the lines of one document
    lines = F.transform("codes", lambda c: F.sequence(F.floor(c / (run + 1)).cast("int"), F.floor(c / (run + 1)).cast("int") + (c % (run + 1)).cast("int") - 1))
    return codes.select("doc_id", "mark", F.array_sort(F.array_distinct(F.flatten(lines))).alias("gone"))


def line_dedup(docs: DataFrame, run: int = RUN, words: int = WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with the text that is left, and _n_lines and _n_removed (in place of columns of these names)."""
    gone = deletions(docs, run, words, id_col, text_col).select(F.col("doc_id").alias("gone_id"), F.col("mark").alias("gone_mark"), "gone")
    names = [c for c in docs.columns if c not in ("_n_lines", "_n_removed")]
    # The lines pass the join as a column of their own, so that they are cut once and not for every line that is looked up. The other columns pass as one struct.
    text = F.col(f"`{text_col}`")
    others = F.struct(*[F.col(f"`{c}`") for c in names if c != text_col])
    cut = docs.select(others.alias("others"), F.col(f"`{id_col}`").cast("long").alias("own_id"), F.xxhash64(text).alias("own_mark"), F.split(text, "\n", -1).alias("lines"))
    joined = cut.join(gone, F.col("own_id").eqNullSafe(F.col("gone_id")) & (F.col("own_mark") == F.col("gone_mark")), "left")
    left = F.array_except(F.sequence(F.lit(1), F.size("lines")), "gone")
    kept = F.array_join(F.when(F.col("gone").isNull(), F.col("lines")).otherwise(F.transform(left, lambda i: F.element_at("lines", i))), "\n")
    n_lines = F.when(F.col("lines").isNull(), 0).otherwise(F.size("lines"))
    n_gone = F.when(F.col("gone").isNull(), 0).otherwise(F.size("gone"))
    return joined.select(*[kept.alias(c) if c == text_col else F.col("others")[c].alias(c) for c in names], n_lines.alias("_n_lines"), n_gone.alias("_n_removed"))


def report(docs: DataFrame, run: int = RUN, words: int = WORDS) -> DataFrame:
    out = line_dedup(docs.select("doc_id", "text"), run, words)
    return out.select("doc_id", F.col("_n_lines").cast("long").alias("n_lines"), F.col("_n_removed").cast("long").alias("n_removed"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


ORACLE = rf"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS pos FROM documents WHERE text IS NOT NULL),
counted AS (SELECT *, len(regexp_extract_all(line, '{WORD}')) AS w FROM lines),
runs AS (
  SELECT doc_id, pos, 1 AS k, line, NULL AS line2, NULL AS line3 FROM counted WHERE w >= {WORDS}
  UNION ALL SELECT doc_id, pos, 2, line, line2, NULL FROM (SELECT *, lead(line) OVER o AS line2, w + lead(w) OVER o AS w2 FROM counted WINDOW o AS (PARTITION BY doc_id ORDER BY pos)) WHERE w2 >= {WORDS}
  UNION ALL SELECT doc_id, pos, 3, line, line2, line3 FROM (SELECT *, lead(line, 1) OVER o AS line2, lead(line, 2) OVER o AS line3 FROM counted WINDOW o AS (PARTITION BY doc_id ORDER BY pos)) WHERE line3 IS NOT NULL),
later AS (
  SELECT doc_id, pos, k, row_number() OVER (PARTITION BY k, line, line2, line3 ORDER BY doc_id, pos) > 1 AS again FROM runs),
gone AS (SELECT DISTINCT doc_id, unnest(range(pos, pos + k)) AS pos FROM later WHERE again),
kept AS (
  SELECT l.doc_id, count(*) AS n_lines, count(g.pos) AS n_removed, coalesce(string_agg(l.line, chr(10) ORDER BY l.pos) FILTER (WHERE g.pos IS NULL), '') AS text
  FROM lines l LEFT JOIN gone g ON l.doc_id = g.doc_id AND l.pos = g.pos GROUP BY l.doc_id)
SELECT d.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(k.text, '')) AS kept_sha256
FROM documents d LEFT JOIN kept k ON d.doc_id = k.doc_id
"""
