"""The queries by name, each an operator bound to driver tables, with the SQL that gives the same rows where SQL can."""

from __future__ import annotations

import re
import sqlite3
import uuid
import zipfile
from collections.abc import Callable
from contextlib import closing
from datetime import datetime
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dates, numbers, text
from ..operators import binning, certificates, clustering, features, layout, profiling, relational, statistics
from ..sources import files, html, parsed, sinks, sqlite, tables
from ..streaming import incremental

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")



# --- joins and the serving view

@query("""SELECT o_orderkey, c_name, n_name, o_totalprice FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey""")
def base_left_join(spark, d):
    orders = table(spark, d, "orders").withColumnRenamed("o_custkey", "c_custkey")
    nation = table(spark, d, "nation").withColumnRenamed("n_nationkey", "c_nationkey")
    return relational.left_chain(orders, (table(spark, d, "customer"), "c_custkey"), (nation, "c_nationkey")).select("o_orderkey", "c_name", "n_name", "o_totalprice")


@query("""SELECT o_orderstatus, count(*) AS n, round(100.0 * count(*) / (SELECT count(*) FROM orders), 2) AS pct FROM orders WHERE o_orderstatus IS NOT NULL GROUP BY 1""")
def group_pct_distribution(spark, d):
    return profiling.group_share(table(spark, d, "orders"), "o_orderstatus")


@query("""SELECT l_orderkey, max(l_extendedprice) FILTER (WHERE l_returnflag = 'A') AS price_A, max(l_extendedprice) FILTER (WHERE l_returnflag = 'N') AS price_N, max(l_extendedprice) FILTER (WHERE l_returnflag = 'R') AS price_R, any_value(o_totalprice) AS o_totalprice
FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1""")
def pivot_filtered_max(spark, d):
    pivot = relational.pivot_filtered_max(table(spark, d, "lineitem"), "l_orderkey", "l_returnflag", "l_extendedprice", ["A", "N", "R"], "price_")
    return pivot.join(table(spark, d, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_totalprice"), "l_orderkey")


@query("""WITH r AS (SELECT c_custkey, s_suppkey, s_acctbal, row_number() OVER (PARTITION BY c_custkey ORDER BY (s_acctbal > c_acctbal) DESC NULLS FIRST, (substr(s_name, -1) = substr(c_name, -1)) DESC NULLS FIRST, s_suppkey) AS k
FROM customer LEFT JOIN supplier ON s_nationkey = c_nationkey) SELECT c_custkey, s_suppkey, s_acctbal FROM r WHERE k = 1""")
def lateral_top1_match(spark, d):
    left = relational.spread(table(spark, d, "customer").select("c_custkey", "c_nationkey", "c_acctbal", "c_name"))
    last = lambda c: F.substring(c, -1, 1)
    out = relational.best_above(left, table(spark, d, "supplier"), ("c_nationkey", "s_nationkey"), ("c_acctbal", "s_acctbal"), (last("c_name"), last("s_name")), "s_suppkey", ["c_custkey"])
    return out.select("c_custkey", "s_suppkey", "s_acctbal")


@query("""SELECT count(*) AS n_rows, count(DISTINCT (o_custkey, o_orderpriority)) AS n_pairs, CAST(min(o_orderdate) AS DATE) AS first_date, CAST(max(o_orderdate) AS DATE) AS last_date FROM orders""")
def load_control_totals(spark, d):
    return relational.load_totals(table(spark, d, "orders").withColumn("day", F.to_date("o_orderdate")), ("o_custkey", "o_orderpriority"), "day")


@query("""SELECT c_custkey, (c_acctbal BETWEEN -500 AND 5000 AND c_nationkey BETWEEN 3 AND 20) AS valid, CASE WHEN c_acctbal BETWEEN -500 AND 5000 AND c_nationkey BETWEEN 3 AND 20 THEN c_acctbal END AS x, CASE WHEN c_acctbal BETWEEN -500 AND 5000 AND c_nationkey BETWEEN 3 AND 20 THEN c_nationkey END AS y FROM customer""")
def coordinate_validity(spark, d):
    valid, point = relational.plausible_point(F.col("c_acctbal"), F.col("c_nationkey"), (-500, 5000), (3, 20))
    return table(spark, d, "customer").select("c_custkey", valid.alias("valid"), point.alias("p")).select("c_custkey", "valid", F.col("p.x").alias("x"), F.col("p.y").alias("y"))


# --- profiling

NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def with_nulls(df: DataFrame) -> DataFrame:
    return df.withColumns({"l_tax": F.when(F.col("l_tax") > 0.01, F.col("l_tax")), "l_discount": F.when(F.col("l_linenumber") != 3, F.col("l_discount"))})


NULLED = "(SELECT * REPLACE (CASE WHEN l_tax > 0.01 THEN l_tax END AS l_tax, CASE WHEN l_linenumber <> 3 THEN l_discount END AS l_discount) FROM lineitem)"


@query(" UNION ALL ".join(f"SELECT '{c}' AS variable, count({c}) AS n_non_null, count(*) - count({c}) AS n_missing, 100.0 * count({c}) / count(*) AS pct_non_null FROM {NULLED}" for c in NUMBERS))
def non_null_report(spark, d):
    return profiling.non_null_report(with_nulls(table(spark, d, "lineitem")), NUMBERS)


@query(" UNION ALL ".join(f"SELECT '{c}' AS variable, (SELECT count(*) - count({c}) FROM {NULLED}) AS missing_before, 0 AS missing_after" for c in NUMBERS))
def missing_report(spark, d):
    before = with_nulls(table(spark, d, "lineitem"))
    return profiling.missing_report(before, features.impute(before, features.imputation_values(before, NUMBERS, [])), NUMBERS)


@query(" UNION ALL ".join(f"SELECT '{c}' AS variable, count({c}) AS n, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std, min({c}) AS min, quantile_cont({c}, 0.01) AS p01, quantile_cont({c}, 0.05) AS p05, quantile_cont({c}, 0.5) AS p50, quantile_cont({c}, 0.95) AS p95, quantile_cont({c}, 0.99) AS p99, max({c}) AS max FROM lineitem" for c in NUMBERS))
def describe_percentiles(spark, d):
    return profiling.describe(table(spark, d, "lineitem"), NUMBERS).withColumns({c: F.round(c, 6) for c in ("mean", "std")})


@query("""SELECT p_type, count(*) AS n FROM part GROUP BY 1 ORDER BY n DESC, p_type NULLS FIRST LIMIT 30""")
def value_counts_top30(spark, d):
    return profiling.value_counts(table(spark, d, "part"), "p_type")


@query(" UNION ALL ".join(f"SELECT l_returnflag, '{c}' AS variable, count({c}) AS n, round(avg({c}), 6) AS mean, median({c}) AS median, round(stddev_samp({c}), 6) AS std, min({c}) AS min, quantile_cont({c}, 0.25) AS p25, quantile_cont({c}, 0.75) AS p75, max({c}) AS max, round(stddev_samp({c}) / avg({c}), 6) AS cv FROM lineitem GROUP BY 1" for c in NUMBERS))
def numeric_stats_by_group(spark, d):
    return profiling.numeric_stats(table(spark, d, "lineitem"), NUMBERS, "l_returnflag").withColumns({c: F.round(c, 6) for c in ("mean", "std", "cv")})


COUNTS = """WITH long AS (SELECT o_orderstatus, 'priority' AS variable, o_orderpriority AS category FROM orders UNION ALL SELECT o_orderstatus, 'year', CAST(year(o_orderdate) AS VARCHAR) FROM orders),
c AS (SELECT o_orderstatus, variable, category, count(*) AS n FROM long GROUP BY ALL),
r AS (SELECT *, sum(n) OVER w AS total, row_number() OVER (PARTITION BY o_orderstatus, variable ORDER BY n DESC, category NULLS LAST) AS k FROM c WINDOW w AS (PARTITION BY o_orderstatus, variable))"""


def order_kinds(spark, d):
    return table(spark, d, "orders").select("o_orderstatus", F.col("o_orderpriority").alias("priority"), F.year("o_orderdate").cast("string").alias("year"))


@query(COUNTS + """ SELECT o_orderstatus, variable, max(category) FILTER (WHERE k = 1) AS mode, max(n) FILTER (WHERE k = 1) AS mode_n, round(100.0 * max(n) FILTER (WHERE k = 1) / max(total), 6) AS mode_pct, count(*) AS n_categories,
string_agg(printf('%s: %d (%.1f%%)', category, n, 100.0 * n / total), '; ' ORDER BY k) FILTER (WHERE k <= 8) AS top FROM r GROUP BY 1, 2""")
def categorical_stats_by_group(spark, d):
    return profiling.category_stats(order_kinds(spark, d), ["priority", "year"], "o_orderstatus").withColumn("mode_pct", F.round("mode_pct", 6))


@query(COUNTS + " SELECT o_orderstatus, variable, category, n, round(100.0 * n / total, 6) AS pct FROM r WHERE k <= 10")
def categorical_profile(spark, d):
    return profiling.category_profile(order_kinds(spark, d), ["priority", "year"], "o_orderstatus").withColumn("pct", F.round("pct", 6))


@query("""SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders WHERE o_orderstatus IS NOT NULL AND o_orderpriority IS NOT NULL GROUP BY 1, 2""")
def contingency(spark, d):
    return profiling.contingency(table(spark, d, "orders"), "o_orderstatus", "o_orderpriority")


@query("""WITH c AS (SELECT p_brand, p_size, count(*) AS n FROM part GROUP BY 1, 2), t AS (SELECT p_size FROM c GROUP BY 1 ORDER BY sum(n) DESC, p_size LIMIT 8)
SELECT p_brand, p_size, round(pct, 6) AS pct FROM (SELECT p_brand, p_size, 100.0 * n / sum(n) OVER (PARTITION BY p_brand) AS pct FROM c) WHERE p_size IN (SELECT p_size FROM t)""")
def row_pct_crosstab(spark, d):
    return profiling.row_shares(table(spark, d, "part"), "p_brand", "p_size").withColumn("pct", F.round("pct", 6))


# --- bins

@query("""WITH q AS (SELECT quantile_cont(l_extendedprice, 0.01) AS a, quantile_cont(l_extendedprice, 0.99) AS b FROM lineitem), x AS (SELECT l.* FROM lineitem l, q WHERE l_extendedprice BETWEEN a AND b),
r AS (SELECT quantile_cont(l_quantity, 0.01) AS a, quantile_cont(l_quantity, 0.99) AS b FROM x) SELECT count(*) AS n, round(sum(l_quantity), 2) AS quantity, round(sum(l_extendedprice), 2) AS price FROM x, r WHERE l_quantity BETWEEN a AND b""")
def outlier_trim(spark, d):
    rows = binning.trim_outliers(table(spark, d, "lineitem"), "l_extendedprice", "l_quantity")
    return rows.agg(F.count("*").alias("n"), F.round(F.sum("l_quantity"), 2).alias("quantity"), F.round(F.sum("l_extendedprice"), 2).alias("price"))


BIN_COLUMNS = "median(y) AS y_median, round(avg(y), 6) AS y_mean, quantile_cont(y, 0.1) AS y_p10, quantile_cont(y, 0.9) AS y_p90, count(*) AS n, min(x) AS x_min, max(x) AS x_max, min(y) AS y_min, max(y) AS y_max"


def bins_sql(edges: str, key: str = "") -> str:
    return f"""WITH v AS (SELECT l_quantity AS x, l_extendedprice AS y, l_returnflag AS g FROM lineitem), e AS (SELECT {edges} AS e FROM v),
    b AS (SELECT v.*, greatest(1, len(list_filter(e, lambda k: k < x))) AS i FROM v, e) SELECT {key and "g AS l_returnflag, "}{BIN_COLUMNS} FROM b GROUP BY i{key}"""


QUANTILES = "list_sort(list_distinct(quantile_cont(x, [" + ", ".join(str(i / 10) for i in range(11)) + "])))"


def rounded_bins(df: DataFrame) -> DataFrame:
    return df.drop("x_mid").withColumn("y_mean", F.round("y_mean", 6))


@query(bins_sql(QUANTILES))
def quantile_bins(spark, d):
    return rounded_bins(binning.binned(table(spark, d, "lineitem"), "l_quantity", "l_extendedprice", 10))


@query(bins_sql("[min(x) - 0.001 * (max(x) - min(x))] || list_transform(range(1, 9), lambda i: min(x) + (max(x) - min(x)) * i / 8)"))
def linear_bins(spark, d):
    return rounded_bins(binning.binned(table(spark, d, "lineitem"), "l_quantity", "l_extendedprice", 8, "linear"))


@query(bins_sql(QUANTILES, ", g"))
def colored_bins(spark, d):
    return rounded_bins(binning.binned(table(spark, d, "lineitem"), "l_quantity", "l_extendedprice", 10, by="l_returnflag"))


# --- correlations and tests

@query("""SELECT count(*) AS n, round(avg(r), 6) AS mean, round(stddev_samp(r), 6) AS std, round(quantile_cont(r, 0.01), 6) AS p01, round(quantile_cont(r, 0.5), 6) AS p50, round(quantile_cont(r, 0.99), 6) AS p99 FROM (SELECT l_extendedprice / l_quantity AS r FROM lineitem WHERE l_quantity <> 0)""")
def ratio_summary(spark, d):
    out = statistics.ratio_summary(table(spark, d, "lineitem"), "l_extendedprice", "l_quantity")
    return out.withColumns({c: F.round(c, 6) for c in out.columns[1:]})


CORR = " UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, corr({a}, {b}) AS r, count(*) FILTER (WHERE {a} IS NOT NULL AND {b} IS NOT NULL) AS n FROM {NULLED}" for i, a in enumerate(NUMBERS) for b in NUMBERS[i + 1 :])


@query(f"SELECT a, b, round(r, 8) AS r, n FROM ({CORR})")
def corr_pairs(spark, d):
    return statistics.correlations(with_nulls(table(spark, d, "lineitem")), NUMBERS).withColumn("r", F.round("r", 8))


@query(f"WITH c AS ({CORR}) SELECT a, b, round(r, 8) AS r FROM c UNION ALL SELECT b, a, round(r, 8) FROM c UNION ALL SELECT unnest({NUMBERS!r}), unnest({NUMBERS!r}), 1.0")
def corr_matrix(spark, d):
    return statistics.correlation_matrix(with_nulls(table(spark, d, "lineitem")), NUMBERS).withColumn("r", F.round("r", 8))


@query(f"SELECT a, b, round(r, 8) AS r FROM ({CORR}) WHERE abs(r) >= 0.3")
def high_corr(spark, d):
    return statistics.high_correlations(with_nulls(table(spark, d, "lineitem")), NUMBERS, 0.3).withColumn("r", F.round("r", 8))


@query("""WITH v AS (SELECT l_returnflag AS g, l_extendedprice AS v FROM lineitem), k AS (SELECT g, v, rank() OVER (ORDER BY v) + (count(*) OVER (PARTITION BY v) - 1) / 2.0 AS rank FROM v),
s AS (SELECT sum(n) AS n, count(*) AS k, sum(r * r / n) AS s FROM (SELECT g, count(*) AS n, sum(rank) AS r FROM k GROUP BY g)), t AS (SELECT sum(CAST(t AS DOUBLE) ** 3 - t) AS t FROM (SELECT count(*) AS t FROM v GROUP BY v)),
h AS (SELECT (12.0 / (n * (n + 1.0)) * s - 3.0 * (n + 1.0)) / (1 - t / (CAST(n AS DOUBLE) ** 3 - n)) AS h, n, k FROM s, t) SELECT round(h, 4) AS h, k - 1 AS dof, n, round((h - k + 1) / (n - k), 8) AS epsilon2 FROM h""")
def kruskal_wallis(spark, d):
    out = statistics.kruskal_wallis(table(spark, d, "lineitem"), "l_extendedprice", "l_returnflag", tail=False)
    return out.select(F.round("h", 4).alias("h"), "dof", F.col("n").cast("decimal(38,0)").alias("n"), F.round("epsilon2", 8).alias("epsilon2"))


CHI2 = """WITH o AS (SELECT l_returnflag AS r, l_linestatus AS c, count(*) AS o FROM lineitem GROUP BY 1, 2), g AS (SELECT r, c FROM (SELECT DISTINCT r FROM o), (SELECT DISTINCT c FROM o)),
e AS (SELECT coalesce(o, 0) AS o, (SELECT sum(o) FROM o x WHERE x.r = g.r) * 1.0 * (SELECT sum(o) FROM o x WHERE x.c = g.c) / (SELECT sum(o) FROM o) AS e FROM g LEFT JOIN o ON o.r = g.r AND o.c = g.c),
s AS (SELECT sum((o - e) ** 2 / e) AS chi2, sum(o) AS n, (SELECT count(DISTINCT r) FROM o) AS a, (SELECT count(DISTINCT c) FROM o) AS b FROM e)"""


@query(CHI2 + " SELECT round(chi2, 4) AS chi2, (a - 1) * (b - 1) AS dof, CAST(n AS BIGINT) AS n, round(sqrt(chi2 / (n * (least(a, b) - 1))), 8) AS cramers_v FROM s")
def chi2_cramers_v(spark, d):
    return statistics.chi2_independence(table(spark, d, "lineitem"), "l_returnflag", "l_linestatus", tail=False).withColumns({"chi2": F.round("chi2", 4), "cramers_v": F.round("cramers_v", 8)})


@query(f"SELECT 'kruskal_wallis' AS test, round(exp(-h / 2), 4) AS p FROM ({SQL['kruskal_wallis']}) UNION ALL SELECT 'chi2', round(exp(-chi2 / 2), 4) FROM ({SQL['chi2_cramers_v']})")
def exploratory_p_values(spark, d):
    """The tests' tails; both have two degrees of freedom here, where the tail is exp(-x / 2)."""
    rows = table(spark, d, "lineitem")
    a = statistics.kruskal_wallis(rows, "l_extendedprice", "l_returnflag").select(F.lit("kruskal_wallis").alias("test"), "p")
    return a.unionByName(statistics.chi2_independence(rows, "l_returnflag", "l_linestatus").select(F.lit("chi2").alias("test"), "p")).withColumn("p", F.round("p", 4))


# --- text

FOLD = r"trim(regexp_replace(regexp_replace(strip_accents(lower(trim(text))), '[^a-z0-9\s]', ' ', 'g'), '\s+', ' ', 'g'))"
WORDS = f"(SELECT doc_id, list_filter(string_split({FOLD}, ' '), lambda w: len(w) >= 2 AND NOT list_contains({text.STOPWORDS!r}, w) AND NOT regexp_full_match(w, '[0-9]+')) AS w FROM documents)"


def document_words(spark, d):
    rows = relational.spread(table(spark, d, "documents").select("doc_id", "text"))
    # One-element explode: the words become a column of their own, and what is built on them doesn't cut the text again.
    return rows.select("doc_id", F.explode(F.array(text.tokens(text.fold_builtin(F.col("text"))))).alias("w"))


@query(f"SELECT doc_id, len(w) AS n_words, array_to_string(w[1:5], ' ') AS first_words FROM {WORDS}")
def normalize_and_tokenize(spark, d):
    return document_words(spark, d).select("doc_id", F.size("w").cast("long").alias("n_words"), F.array_join(F.slice("w", 1, 5), " ").alias("first_words"))


@query(f"SELECT doc_id, md5({FOLD}) AS folded FROM documents")
def fold_text(spark, d):
    return table(spark, d, "documents").select("doc_id", F.md5(text.fold(F.col("text"))).alias("folded"))


@query(f"SELECT word, count(*) AS n FROM (SELECT unnest(w) AS word FROM {WORDS}) GROUP BY 1 ORDER BY n DESC, word LIMIT 50")
def word_counts(spark, d):
    return profiling.top(profiling.word_counts(document_words(spark, d), "w"), 50, F.desc("n"), "word")


@query(f"SELECT word, count(*) AS n FROM (SELECT unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS word FROM {WORDS}) GROUP BY 1 ORDER BY n DESC, word LIMIT 50")
def bigram_counts(spark, d):
    rows = document_words(spark, d).withColumn("w", text.ngrams(F.col("w"), 2))
    return profiling.top(profiling.word_counts(rows, "w"), 50, F.desc("n"), "word")


@query(f"SELECT word, count(*) AS n FROM (SELECT unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) AS word FROM {WORDS}) GROUP BY 1 ORDER BY n DESC, word LIMIT 50")
def trigram_counts(spark, d):
    rows = document_words(spark, d).withColumn("w", text.ngrams(F.col("w"), 3))
    return profiling.top(profiling.word_counts(rows, "w"), 50, F.desc("n"), "word")


DWELLING = ['casa pareada', 'Casa Aislada', 'departamento', 'torrente', 'casa', 'sitio', 'condominio casa pareada', 'Edificio Torre', 'vivienda continua', '']


def dwellings(spark, d):
    kinds = F.array(*[F.lit(x) for x in DWELLING])
    return table(spark, d, "part").select("p_partkey", F.concat(kinds[(F.col("p_partkey") % 10).cast("int")], F.lit(" "), F.lower("p_brand")).alias("shown")).withColumn("folded", text.fold_builtin(F.col("shown")))


DWELLINGS = f"(SELECT p_partkey, {DWELLING}[p_partkey % 10 + 1] || ' ' || lower(p_brand) AS shown, trim(regexp_replace(regexp_replace(lower({DWELLING}[p_partkey % 10 + 1] || ' ' || lower(p_brand)), '[^a-z0-9\\s]', ' ', 'g'), '\\s+', ' ', 'g')) AS folded FROM part)"


@query(f"""WITH k AS (SELECT unnest({text.KEYWORDS!r}) AS keyword), h AS (SELECT keyword, shown, p_partkey FROM k JOIN {DWELLINGS} ON regexp_matches(folded, '\\b' || keyword || '\\b')),
f AS (SELECT keyword, shown, min(p_partkey) AS at, row_number() OVER (PARTITION BY keyword ORDER BY min(p_partkey)) AS r FROM h GROUP BY 1, 2), x AS (SELECT keyword, string_agg(shown, ' | ' ORDER BY r) AS examples FROM f WHERE r <= 10 GROUP BY 1)
SELECT k.keyword, (SELECT count(*) FROM h WHERE h.keyword = k.keyword) AS n, round(100.0 * (SELECT count(*) FROM h WHERE h.keyword = k.keyword) / (SELECT count(*) FROM part), 6) AS pct, coalesce(examples, '') AS examples FROM k LEFT JOIN x ON k.keyword = x.keyword""")
def keyword_summary(spark, d):
    return profiling.keyword_summary(dwellings(spark, d), "folded", "shown", "p_partkey").withColumn("pct", F.round("pct", 6))


@query(f"""SELECT kind AS property_type, count(*) AS n, round(100.0 * count(*) / (SELECT count(*) FROM part), 2) AS pct FROM (SELECT coalesce(CASE WHEN regexp_matches(folded, 'departamento|depto|edificio|torre|condominio|duplex') THEN 'depto' WHEN regexp_matches(folded, 'pareada|pareado|continua') THEN 'casa_pareada' WHEN regexp_matches(folded, 'aislada|aislado') THEN 'casa_aislada' WHEN contains(folded, 'casa') THEN 'casa_aislada' END, 'indeterminado') AS kind FROM {DWELLINGS}) GROUP BY 1""")
def property_type_distribution(spark, d):
    rows = dwellings(spark, d).withColumn("property_type", F.coalesce(text.property_type(F.col("folded")), F.lit("indeterminado")))
    return profiling.group_share(rows, "property_type")


@query("""SELECT page_id, coalesce(nullif(regexp_replace(regexp_replace(coalesce(url, ''), '[^A-Za-z0-9_\\-.]+', '_', 'g'), '^[._]+|[._]+$', '', 'g'), ''), 'sin_nombre') AS name FROM pages""")
def safe_name(spark, d):
    return table(spark, d, "pages").select("page_id", text.safe_name(F.col("url")).alias("name"))


@query("""SELECT page_id, substr(coalesce(nullif(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(translate(lower(trim(url)), 'áéíóúñü', 'aeiounu'), '[/\\\\:*?"<>|]', '_', 'g'), '[^a-z0-9\\-_. ]+', '', 'g'), '\\s+', '_', 'g'), '_+', '_', 'g'), '^[._\\-]+|[._\\-]+$', '', 'g'), ''), 'ficha_sin_identificacion'), 1, 180) AS name FROM pages""")
def clean_filename(spark, d):
    return table(spark, d, "pages").select("page_id", text.file_name(F.col("url")).alias("name"))


STATUSES = ["x_precalificadas_ver.pdf", "x_calificada_ver.pdf", "x.pdf", "recalificadas.pdf", "Calificados", "x.calificadas_z.pdf", "x precalificado.pdf"]


@query(f"""SELECT o_orderkey, CASE WHEN regexp_matches(lower(f), '(^|[_\\-\\s])precalificad[ao]s?([_\\-\\s\\.]|$)') THEN 'precalificada' WHEN regexp_matches(lower(f), '(^|[_\\-\\s])calificad[ao]s?([_\\-\\s\\.]|$)') THEN 'calificada' END AS status FROM (SELECT o_orderkey, {STATUSES}[o_orderkey % 7 + 1] AS f FROM orders)""")
def status_from_filename(spark, d):
    names = F.array(*[F.lit(x) for x in STATUSES])
    return table(spark, d, "orders").select("o_orderkey", text.status_from_name(names[(F.col("o_orderkey") % 7).cast("int")]).alias("status"))


# --- numbers and dates

@query("""SELECT l_orderkey, l_linenumber, CAST(replace(replace(v, '.', ''), ',', '.') AS DOUBLE) AS chilean, CAST(replace(replace(v, '.', ''), ',', '.') AS DOUBLE) AS last_number, 7.0 AS first_number FROM (SELECT l_orderkey, l_linenumber, printf('%d.%03d,%02d', CAST(l_quantity AS INTEGER), l_partkey % 1000, CAST(round(l_discount * 100) AS INTEGER)) AS v FROM lineitem)""")
def chilean_number(spark, d):
    v = F.format_string("%d.%03d,%02d", F.col("l_quantity").cast("int"), F.col("l_partkey") % 1000, F.round(F.col("l_discount") * 100).cast("int"))
    row = F.concat(F.lit("7 kWh a12b "), v, F.lit(" m"))
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", numbers.chilean(v).alias("chilean"), numbers.last_number(row).alias("last_number"), numbers.first_number(row).alias("first_number"))


@query("""SELECT l_orderkey, l_linenumber, CASE l_linenumber % 5 WHEN 0 THEN round(l_discount * 100) + 0.5 WHEN 1 THEN CAST(l_quantity AS DOUBLE) WHEN 3 THEN CAST(l_quantity AS DOUBLE) WHEN 4 THEN 0.6 END AS u FROM lineitem""")
def u_and_percent_values(spark, d):
    k = F.col("l_linenumber") % 5
    row = F.when(k == 3, F.format_string("1.%d %%", F.col("l_quantity").cast("int"))).when(k == 4, "% máximo = ,6%").when(k == 0, F.format_string("% máximo = %d,5%%".replace("% m", "%% m"), F.round(F.col("l_discount") * 100).cast("int"))).when(k == 1, F.format_string("%d,0 [W/m2K]", F.col("l_quantity").cast("int"))).otherwise("sin exigencia")
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", numbers.u_value(row).alias("u"))


@query("""SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber = 4 THEN NULL ELSE round(l_extendedprice, 2) END AS x, CASE WHEN l_returnflag = 'A' OR l_linenumber = 2 THEN NULL ELSE lower(l_returnflag) || ' x' END AS c FROM lineitem""")
def clean_numeric_and_category(spark, d):
    x = F.when(F.col("l_linenumber") == 4, "sin dato").otherwise(F.replace(F.format_string("%.2f", "l_extendedprice"), F.lit("."), F.lit(",")))
    c = F.when(F.col("l_returnflag") == "A", " Sin  Información ").when(F.col("l_linenumber") == 2, "\tn/a\u00a0").otherwise(F.concat(F.lit("\t\u00a0"), F.col("l_returnflag"), F.lit(" \t X\n")))
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", numbers.clean_numeric(x).alias("x"), text.clean_category(c).alias("c"))


@query("""SELECT o_orderkey, strftime(o_orderdate, '%d-%m-%Y') AS shown, CAST(o_orderdate AS DATE) AS day, CAST(DATE '1899-12-30' + CAST(o_custkey % 50000 AS INTEGER) AS VARCHAR) AS excel FROM orders""")
def date_extract_parse(spark, d):
    shown = F.concat(F.lit("emitida "), F.date_format("o_orderdate", "dd-MM-yyyy"), F.lit(" fin"))
    return table(spark, d, "orders").select("o_orderkey", dates.date_or_text(shown).alias("shown"), dates.to_date(dates.first_date(shown)).alias("day"), dates.from_excel((F.col("o_custkey") % 50000).cast("string")).alias("excel"))


@query("""SELECT l_orderkey, l_linenumber, ln(1 + l_tax) AS logged, greatest(l_discount - 0.05, 0) AS clipped, CASE WHEN l_discount <> 0 THEN l_tax / l_discount END AS ratio, CAST(round_even(l_extendedprice, 0) AS BIGINT) AS whole FROM lineitem""")
def numeric_transforms(spark, d):
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.log(1 + F.col("l_tax")).alias("logged"), numbers.clip_low(F.col("l_discount") - 0.05).alias("clipped"), numbers.ratio(F.col("l_tax"), F.col("l_discount")).alias("ratio"), numbers.half_even(F.col("l_extendedprice")).alias("whole"))


# --- store

@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_orderstatus END AS o_orderstatus, CASE WHEN o_orderkey % 3 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice FROM orders""")
def upsert_replace(spark, d):
    old = table(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    return relational.upsert_replace(old, old.where("o_orderkey % 3 = 0").select("o_orderkey", (F.col("o_totalprice") + 1).alias("o_totalprice")), ["o_orderkey"])


@query("""WITH old AS (SELECT row_number() OVER (ORDER BY o_orderkey) AS id, o_orderkey, o_totalprice FROM orders WHERE o_orderkey % 4 <> 0), new AS (SELECT o_orderkey, o_totalprice * 2 AS o_totalprice FROM orders WHERE o_orderkey % 2 = 0),
fresh AS (SELECT (SELECT max(id) FROM old) + row_number() OVER (ORDER BY o_orderkey) AS id, o_orderkey, o_totalprice FROM new WHERE o_orderkey NOT IN (SELECT o_orderkey FROM old))
SELECT id, o_orderkey, coalesce((SELECT n.o_totalprice FROM new n WHERE n.o_orderkey = old.o_orderkey), o_totalprice) AS o_totalprice FROM old UNION ALL SELECT id, o_orderkey, o_totalprice FROM fresh""")
def upsert_update(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", "o_totalprice")
    old = relational.numbered(orders.where("o_orderkey % 4 <> 0"), F.col("o_orderkey"), "id")
    new = orders.where("o_orderkey % 2 = 0").withColumn("o_totalprice", F.col("o_totalprice") * 2)
    return relational.upsert_update(old.select("id", "o_orderkey", "o_totalprice"), new, "o_orderkey", "id", F.col("o_orderkey"))


@query("""SELECT DISTINCT user_id, event_type FROM events""")
def dedup_full(spark, d):
    return relational.dedup_rows(table(spark, d, "events").select("user_id", "event_type"))


@query("""SELECT user_id, event_id, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS k FROM events) WHERE k = 1""")
def dedup_keep_last(spark, d):
    return relational.dedup_keep_last(table(spark, d, "events"), ["user_id"], "event_id").select("user_id", "event_id", "value")


@query("""SELECT e.event_id FROM events e WHERE NOT EXISTS (SELECT 1 FROM events l WHERE l.event_id % 5 = 0 AND l.user_id = e.user_id AND (l.event_type = e.event_type OR CAST(l.event_id % 7 AS VARCHAR) = CAST(e.event_id % 7 AS VARCHAR)))""")
def resume_anti_join(spark, d):
    events = table(spark, d, "events").select("event_id", "user_id", F.col("event_type").alias("title"), (F.col("event_id") % 7).cast("string").alias("name"))
    log = events.where("event_id % 5 = 0").withColumn("estado", F.lit("ok"))
    return relational.resume(events, log, ["user_id"], "title", "name").select("event_id")


@query("""SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN 'updated' ELSE c_mktsegment END AS c_mktsegment FROM customer""")
def update_join(spark, d):
    rows = table(spark, d, "customer").select("c_custkey", "c_mktsegment")
    return relational.update_join(rows, rows.where("c_custkey % 2 = 0").withColumn("c_mktsegment", F.lit("updated")), "c_custkey", "c_mktsegment")


@query("""SELECT c_custkey, unnest(['n', 'ne', 'e']) AS orientacion, unnest([c_acctbal, CAST(c_nationkey AS DOUBLE), NULL]) AS area FROM customer""")
def long_orientation(spark, d):
    rows = F.array(F.col("c_acctbal"), F.col("c_nationkey").cast("double"))
    pairs_ = relational.zip_positions(F.array(F.lit("n"), F.lit("ne"), F.lit("e")).alias("orientacion"), rows.alias("area"), pad=True)
    return table(spark, d, "customer").select("c_custkey", F.explode(pairs_).alias("z")).select("c_custkey", "z.orientacion", "z.area")


@query("""SELECT o_orderkey, o_orderstatus AS state, CAST(o_custkey AS VARCHAR) AS customer, NULL::VARCHAR AS beyond FROM orders""")
def positional_assign(spark, d):
    rows = table(spark, d, "orders").withColumn("rows", F.array("o_orderpriority", "o_orderstatus", F.col("o_custkey").cast("string")))
    return rows.select("o_orderkey", *relational.assign_by_order(F.col("rows"), [None, "state", "customer", "beyond"]))


# --- layout

WORDS_BOX = "SELECT l_orderkey AS id, l_linenumber AS line, l_partkey % 3 + 1 AS page, l_quantity * 10 AS x0, l_suppkey % 700 AS y0, l_quantity * 10 + 12 AS x1, l_suppkey % 700 + 8 AS y1 FROM lineitem"
REGIONS = [("page_01_region_01", 1, 50.0, 50.0, 200.0, 300.0), ("page_02_region_01", 2, 100.0, 0.0, 400.0, 90.0), ("page_03_region_01", 3, 0.0, 200.0, 500.0, 210.0)]


def boxes(spark, d):
    return table(spark, d, "lineitem").select(F.col("l_orderkey").alias("id"), F.col("l_linenumber").alias("line"), (F.col("l_partkey") % 3 + 1).alias("page"), (F.col("l_quantity") * 10).alias("x0"), (F.col("l_suppkey") % 700).cast("double").alias("y0"), (F.col("l_quantity") * 10 + 12).alias("x1"), (F.col("l_suppkey") % 700 + 8).cast("double").alias("y1"))


@query(f"WITH w AS ({WORDS_BOX}), r(region_id, page, a, b, c, d) AS (VALUES " + ", ".join(map(str, REGIONS)) + ") SELECT id, line, region_id FROM w JOIN r ON w.page = r.page AND (x0 + x1) / 2.0 BETWEEN a - 1 AND c + 1 AND (y0 + y1) / 2.0 BETWEEN b - 1 AND d + 1")
def word_in_region(spark, d):
    regions = spark.createDataFrame(REGIONS, "id string, page long, x0 double, y0 double, x1 double, y1 double")
    return layout.words_in_regions(boxes(spark, d).withColumnRenamed("id", "word"), regions, 1.0).select(F.col("word").alias("id"), "line", "region_id")


@query("""WITH c AS (SELECT l_orderkey, l_linenumber, l_quantity * 4 AS x0, l_quantity * 4 + 6 AS x1 FROM lineitem), s AS (SELECT o_orderkey, o_custkey % 200 AS x0, o_custkey % 200 + 40 AS x1 FROM orders)
SELECT l_orderkey, l_linenumber, EXISTS (SELECT 1 FROM s WHERE o_orderkey = l_orderkey AND l_linenumber < 5 AND c.x0 < s.x1 AND s.x0 < c.x1 AND (least(c.x1, s.x1) - greatest(c.x0, s.x0)) / (c.x1 - c.x0) >= 0.55) AS hidden FROM c""")
def occlusion_flag(spark, d):
    chars = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("doc"), F.lit(1).alias("page"), F.col("l_linenumber").alias("seqno"), F.lit(1.0).alias("opacity"), F.lit("x").alias("text"), (F.col("l_quantity") * 4).alias("x0"), F.lit(0.0).alias("y0"), (F.col("l_quantity") * 4 + 6).alias("x1"), F.lit(8.0).alias("y1"))
    shapes = table(spark, d, "orders").select(F.col("o_orderkey").alias("doc"), F.lit(1).alias("page"), F.lit(5).alias("seqno"), F.lit("fill-path").alias("kind"), (F.col("o_custkey") % 200).cast("double").alias("x0"), F.lit(0.0).alias("y0"), (F.col("o_custkey") % 200 + 40).cast("double").alias("x1"), F.lit(8.0).alias("y1"))
    return layout.visible_chars(chars, shapes).select(F.col("doc").alias("l_orderkey"), F.col("seqno").alias("l_linenumber"), "hidden")


@query("""SELECT l_orderkey, l_linenumber, round(greatest(0, least(l_quantity, 30) - greatest(l_quantity - l_tax * 100, 5)) / least(l_tax * 100, 25), 8) AS overlap FROM lineitem WHERE l_tax > 0""")
def overlap_ratio(spark, d):
    zero, one = F.lit(0.0), F.lit(1.0)
    ratio = layout.overlap_ratio((F.col("l_quantity") - F.col("l_tax") * 100, zero, F.col("l_quantity"), one), (F.lit(5.0), zero, F.lit(30.0), one))
    return table(spark, d, "lineitem").where("l_tax > 0").select("l_orderkey", "l_linenumber", F.round(ratio, 8).alias("overlap"))


ISLANDS = """WITH e AS (SELECT user_id, event_id, epoch(ts) / 3600 AS y0, epoch(ts) / 3600 + value / 10 AS y1 FROM events), b AS (SELECT *, max(y1) OVER (PARTITION BY user_id ORDER BY y0, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS bottom FROM e),
i AS (SELECT *, sum(CASE WHEN bottom IS NULL OR y0 - bottom > 4 THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY y0, event_id ROWS UNBOUNDED PRECEDING) AS record FROM b)"""


def event_rows(spark, d):
    y0 = F.unix_micros(F.col("ts").cast("timestamp")) / 1e6 / 3600
    return table(spark, d, "events").select("user_id", F.col("event_id").cast("string").alias("text"), F.col("event_id").cast("double").alias("x0"), y0.alias("y0"), F.lit(1.0).alias("x1"), (y0 + F.col("value") / 10).alias("y1"), F.lit(1).alias("n_words"))


@query(ISLANDS + " SELECT user_id, CAST(record AS BIGINT) AS record, CAST(count(*) AS BIGINT) AS n_words, string_agg(CAST(event_id AS VARCHAR), ' ' ORDER BY y0, event_id) AS text FROM i GROUP BY 1, 2")
def merge_vertical_gap(spark, d):
    return layout.merge_wrapped(event_rows(spark, d), ["user_id"]).select("user_id", F.col("record").cast("long").alias("record"), F.col("n_words").cast("long").alias("n_words"), "text")


@query("""SELECT user_id, CAST(list_reduce(list({'line': 1, 'mean': y0, 'n': 1} ORDER BY y0, event_id), lambda a, x: CASE WHEN abs(x.mean - a.mean) <= 3.5 THEN {'line': a.line, 'mean': (a.mean * a.n + x.mean) / (a.n + 1), 'n': a.n + 1}
ELSE {'line': a.line + 1, 'mean': x.mean, 'n': 1} END).line AS INTEGER) AS n_lines, count(*) AS n FROM (SELECT user_id, event_id, epoch(ts) / 3600 AS y0 FROM events) GROUP BY 1""")
def y_clusters(spark, d):
    """Rows by a running mean of their centre: a fold."""
    return layout.bands(event_rows(spark, d).select("user_id", "text", "x0", "y0"), ["user_id"], "y0", 3.5, ["x0"]).groupBy("user_id").agg(F.max("line").alias("n_lines"), F.count("*").alias("n"))


@query("""WITH e AS (SELECT user_id, epoch(ts) / 60 AS x0, epoch(ts) / 60 + 1 AS x1, event_id FROM events), g AS (SELECT *, lag(x1) OVER w AS before FROM e WINDOW w AS (PARTITION BY user_id ORDER BY x0, event_id)),
i AS (SELECT *, sum(CASE WHEN before IS NULL OR x0 - before > 600 THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY x0, event_id ROWS UNBOUNDED PRECEDING) AS word FROM g) SELECT user_id, CAST(word AS BIGINT) AS word, count(*) AS n FROM i GROUP BY 1, 2""")
def gap_split_words(spark, d):
    x0 = F.unix_micros(F.col("ts").cast("timestamp")) / 1e6 / 60
    chars = table(spark, d, "events").select("user_id", F.lit("x").alias("text"), x0.alias("x0"), F.lit(0.0).alias("y0"), (x0 + 1).alias("x1"), F.lit(1.0).alias("y1"))
    return layout.split_words(chars, ["user_id"], least_gap=600.0, widths=0.0).select("user_id", F.col("word").cast("long").alias("word"), F.length("text").cast("long").alias("n"))


# --- pages

def listings(spark, d):
    """Pages with a list of dwellings: a header, page_id % 4 rows (with a hidden cell each), a pager, and the total of their section."""
    k = F.col("page_id").cast("string")
    cells = [F.concat(F.lit("v"), k, F.lit("-"), F.lit(str(i))) for i in range(4)]
    row = lambda i: F.concat(F.lit("<tr><td>"), cells[i], F.lit(f"</td><td>Casa</td><td>Talca {i}</td><td>p</td><td class='hidden'>no</td><td><input type='image' name='n{i}' title='Ver Informe'></td></tr>"))
    rows = F.concat(*[F.when(F.col("page_id") % 4 > i, row(i)).otherwise("") for i in range(4)])
    head = "<table id='g'><tr><td>Identificación Vivienda</td><td>b</td><td>c</td><td>d</td><td>e</td></tr>"
    return table(spark, d, "pages").select("page_id", F.concat(F.lit(head), rows, F.lit("<tr><td>1</td><td>2</td><td>3</td><td>4</td><td>5</td></tr></table>Viviendas Calificadas Se ha(n) encontrado 1."), F.lpad((F.col("page_id") % 1000).cast("string"), 3, "0"), F.lit(" Viviendas")).alias("html"))


@query("""SELECT page_id, 'v' || page_id || '-' || i AS ident, 'Casa' AS kind, 'Talca ' || i AS commune, 'p' AS project, 'n' || i AS action, 'Ver Informe' AS title FROM pages, range(4) r(i) WHERE page_id % 4 > i""")
def html_rows(spark, d):
    out = html.html_rows(listings(spark, d), "page_id", table_id="g")
    return out.select("page_id", "ident", "kind", "commune", "project", F.col("actions")[0]["name"].alias("action"), F.col("actions")[0]["title"].alias("title"))


@query()
def html_form(spark, d):
    return html.html_form(table(spark, d, "pages"), "page_id").select("page_id", F.size("payload").alias("n_fields"))


@query("""SELECT page_id, CAST(1000 + page_id % 1000 AS BIGINT) AS total, CAST(ceil((1000 + page_id % 1000) / 10) AS BIGINT) AS pages FROM pages""")
def html_section_totals(spark, d):
    return html.html_totals(listings(spark, d), "page_id", "calificadas").withColumn("pages", F.col("pages").cast("long"))


@query("""SELECT page_id, coalesce(CAST(replace(list_extract(regexp_extract_all(h, '(?i)Se\\s+ha\\s*\\(?n\\)?\\s+encontrado\\s+([\\d.]+)\\s+Vivienda', 1), 1), '.', '') AS BIGINT), 0) AS total FROM (SELECT page_id, 'Se ha(n) encontrado 1.' || lpad(CAST(page_id % 1000 AS VARCHAR), 3, '0') || ' Viviendas' AS h FROM pages)""")
def html_total_pages(spark, d):
    words = F.concat(F.lit("Se ha(n) encontrado 1."), F.lpad((F.col("page_id") % 1000).cast("string"), 3, "0"), F.lit(" Viviendas"))
    return table(spark, d, "pages").select("page_id", html.totals_builtin(words, 0).alias("total"))


# --- clustering

MIXED = (["c_acctbal"], ["c_mktsegment", "c_nationkey"])
GOWER = """WITH s AS (SELECT max(c_acctbal) - min(c_acctbal) AS r FROM customer), p AS (SELECT a.c_custkey AS i, b.c_custkey AS j, a.c_nationkey % 4 AS ci, b.c_nationkey % 4 AS cj,
(abs(a.c_acctbal - b.c_acctbal) / r + CAST(a.c_mktsegment <> b.c_mktsegment AS INTEGER) + CAST(a.c_nationkey <> b.c_nationkey AS INTEGER)) / 3 AS d FROM customer a, customer b, s)"""


def customers(spark, d):
    return table(spark, d, "customer").withColumn("label", F.col("c_nationkey") % 4)


@query(GOWER + " SELECT i AS id, round(d, 9) AS core_distance FROM (SELECT i, d, row_number() OVER (PARTITION BY i ORDER BY d) AS k FROM p) WHERE k = 15")
def core_distance(spark, d):
    data = clustering.prepare(customers(spark, d), "c_custkey", *MIXED)
    return clustering.core_distances(spark, data, 15).withColumn("core_distance", F.round("core_distance", 9))


SILHOUETTE = GOWER + """, m AS (SELECT i, ci, cj, sum(d) / (count(*) - CAST(ci = cj AS INTEGER)) AS m FROM p GROUP BY 1, 2, 3), ab AS (SELECT i, ci, max(m) FILTER (WHERE ci = cj) AS a, min(m) FILTER (WHERE ci <> cj) AS b FROM m GROUP BY 1, 2), s2 AS (SELECT ci, (b - a) / greatest(a, b) AS s FROM ab)"""


@query(SILHOUETTE + " SELECT ci AS cluster, count(*) AS n, round(avg(s), 8) AS mean, round(min(s), 8) AS min, round(max(s), 8) AS max, round(100.0 * avg(CAST(s < 0 AS INTEGER)), 6) AS pct_negative FROM s2 GROUP BY 1")
def silhouette_by_cluster(spark, d):
    out = clustering.silhouette_summary(clustering.silhouettes(customers(spark, d), "c_custkey", *MIXED, "label"))
    return out.select(F.col("cluster").cast("int").alias("cluster"), "n", *[F.round(c, 8).alias(c) for c in ("mean", "min", "max")], F.round("pct_negative", 6).alias("pct_negative"))


@query(GOWER + ", m AS (SELECT ci, i, round(avg(d), 9) AS m FROM p WHERE ci = cj GROUP BY 1, 2) SELECT ci AS cluster, i AS id, m AS mean_distance FROM (SELECT *, row_number() OVER (PARTITION BY ci ORDER BY m, i) AS k FROM m) WHERE k = 1")
def medoids(spark, d):
    out = clustering.medoids(customers(spark, d), "c_custkey", *MIXED, "label", 9)
    return out.select(F.col("cluster").cast("int").alias("cluster"), "id", F.round("mean_distance", 9).alias("mean_distance"))


@query()
def hdbscan_labels(spark, d):
    return clustering.hdbscan(customers(spark, d), "c_custkey", *MIXED, 50, 15)


@query("""SELECT count(*) AS n_rows, count(DISTINCT CASE WHEN label <> -1 THEN label END) AS n_clusters, count(*) FILTER (WHERE label = -1) AS n_noise, round(100.0 * count(*) FILTER (WHERE label = -1) / count(*), 6) AS pct_noise FROM (SELECT c_nationkey % 5 - 1 AS label FROM customer)""")
def cluster_metrics(spark, d):
    rows = table(spark, d, "customer").withColumn("label", F.col("c_nationkey") % 5 - 1)
    return clustering.cluster_metrics(rows, "label").withColumn("pct_noise", F.round("pct_noise", 6))


@query("""WITH c AS (SELECT c_nationkey % 4 AS label, c_mktsegment AS v, count(*) AS n FROM customer GROUP BY 1, 2), m AS (SELECT label, v, n, row_number() OVER (PARTITION BY label ORDER BY n DESC, v) AS k FROM c)
SELECT label, count(*) AS n, round(100.0 * count(*) / (SELECT count(*) FROM customer), 6) AS pct_total, median(c_acctbal) AS c_acctbal_median, quantile_cont(c_acctbal, 0.25) AS c_acctbal_p25, any_value(m.v) AS c_mktsegment_mode, any_value(m.v) || ' | c_acctbal ' || CAST(CAST(round_even(median(c_acctbal), 0) AS BIGINT) AS VARCHAR) AS archetype
FROM (SELECT *, c_nationkey % 4 AS label FROM customer) JOIN m USING (label) WHERE m.k = 1 GROUP BY 1""")
def cluster_profile(spark, d):
    out = clustering.cluster_profile(customers(spark, d), "label", ["c_acctbal"], ["c_mktsegment"])
    return out.select("label", "n", F.round("pct_total", 6).alias("pct_total"), "c_acctbal_median", "c_acctbal_p25", "c_mktsegment_mode", "archetype")


# --- components and sampling

@query()
def pca_variance(spark, d):
    rows = table(spark, d, "lineitem").select(*NUMBERS, "l_returnflag")
    return features.pca(rows, NUMBERS, ["l_returnflag"], 3)[1].variance_table(spark)


@query()
def pca_scores(spark, d):
    return features.pca(table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", *NUMBERS), NUMBERS, [], 2)[0].select("l_orderkey", "l_linenumber", "pc1", "pc2")


@query()
def top_loadings(spark, d):
    model = features.pca(table(spark, d, "lineitem").select(*NUMBERS, "l_returnflag"), NUMBERS, ["l_returnflag"], 3)[1]
    return profiling.top_per_group(features.aggregate_loadings(model.loading_table(spark), [*NUMBERS, "l_returnflag"]), "component", 15, F.desc("weight"), "variable")


SEEDS = [101, 102, 103]
SWEPT = f"(SELECT unnest({SEEDS}) AS random_state, c_nationkey % 4 AS label, count(*) AS n, round(avg(c_acctbal), 6) AS mean FROM customer GROUP BY 2)"


def swept(spark, d):
    """Samples of all rows: what is left is the sweep itself, whose rows SQL knows."""
    summary = lambda df: df.groupBy("label").agg(F.count("*").alias("n"), F.round(F.avg("c_acctbal"), 6).alias("mean"))
    return clustering.seed_sweep(customers(spark, d), "c_custkey", SEEDS, 1 << 30, summary)


@query(f"SELECT random_state, label, n, mean FROM (SELECT *, row_number() OVER (PARTITION BY random_state ORDER BY n DESC, label) AS k FROM {SWEPT}) WHERE k <= 3")
def seed_sweep(spark, d):
    return profiling.top_per_group(swept(spark, d), "random_state", 3, F.desc("n"), "label").select("random_state", "label", "n", "mean")


@query(" UNION ALL ".join(f"SELECT '{c}' AS variable, count({c}) AS count, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std, CAST(min({c}) AS DOUBLE) AS min, CAST(quantile_cont({c}, 0.25) AS DOUBLE) AS p25, CAST(median({c}) AS DOUBLE) AS p50, CAST(quantile_cont({c}, 0.75) AS DOUBLE) AS p75, CAST(max({c}) AS DOUBLE) AS max, CAST(NULL AS BIGINT) AS unique, CAST(NULL AS VARCHAR) AS top, CAST(NULL AS BIGINT) AS freq FROM {SWEPT}" for c in ("n", "mean"))
+ f" UNION ALL SELECT 'segment', count(*), NULL, NULL, NULL, NULL, NULL, NULL, NULL, count(DISTINCT c_mktsegment), (SELECT c_mktsegment FROM customer GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1), (SELECT max(n) FROM (SELECT count(*) AS n FROM customer GROUP BY c_mktsegment)) FROM customer")
def sweep_describe(spark, d):
    both = profiling.describe_all(swept(spark, d), ["n", "mean"]).unionByName(profiling.describe_all(table(spark, d, "customer").select(F.col("c_mktsegment").alias("segment"))))
    return both.withColumns({c: F.round(c, 6) for c in ("mean", "std")})


@query()
def seeded_sample(spark, d):
    return relational.seeded_sample(table(spark, d, "orders"), "o_orderkey", 100, 42)


@query("""SELECT l_linestatus, n, round(mean, 6) AS mean FROM (SELECT l_linestatus, count(*) AS n, avg(l_extendedprice / l_quantity) AS mean FROM lineitem WHERE l_quantity <> 0 GROUP BY 1)""")
def stratified_diagnostics(spark, d):
    out = statistics.by_strata(table(spark, d, "lineitem"), "l_linestatus", 10, lambda df: statistics.ratio_summary(df, "l_extendedprice", "l_quantity"))
    return out.select("l_linestatus", "n", F.round("mean", 6).alias("mean"))


# --- document tables

ID = "CASE WHEN k % 2 = 0 THEN 'c' || k WHEN k % 3 = 0 THEN 'p' || k ELSE 'doc_' || k || '_calificadas_x.pdf' END"
CERTIFIED = f"(SELECT {ID} AS document_id, k, n, o_custkey, o_orderpriority, o_orderdate FROM (SELECT o_orderkey AS k, o_custkey % 300 + 0.5::DOUBLE AS n, o_custkey, o_orderpriority, o_orderdate FROM orders) WHERE k % 7 <> 0) d"


def certificate_docs(spark, d):
    """A document an order: the rows of its regions; every seventh has the wrong number of pages."""
    k, n = F.col("o_orderkey"), F.format_string("%d,5", F.col("o_custkey") % 300)
    rows = lambda *xs: F.array(*[F.lit(x) if isinstance(x, str) else x for x in xs])
    regions = {
        "page_01_region_01": rows(F.concat(F.lit("Codigo: "), F.when(k % 3 == 0, F.concat(F.lit("p"), k)).otherwise("")), "Region: Maule", F.concat(F.lit("Comuna: "), F.col("o_orderpriority")), "Direccion: x", F.concat(F.lit("Rol: "), F.col("o_custkey")), "Tipo: casa", F.concat(F.lit("Sup: "), n)),
        "page_01_region_02": rows(F.concat(F.lit("AHORRO "), F.col("o_custkey") % 90, F.lit("% B"))), "page_01_region_03": rows(F.concat(F.lit("demanda 10 "), n)), "page_01_region_04": rows("x"), "page_01_region_05": rows(F.concat(F.lit("emitida "), F.date_format("o_orderdate", "dd-MM-yyyy"))),
        "page_02_region_01": rows("Zona: D", "57", "Sol: s", "Ev: e", F.concat(F.lit("Codigo:"), F.when(k % 2 == 0, F.concat(F.lit(" c"), k)).otherwise(""))), "page_03_region_01": rows(F.concat(F.lit("a "), n), "2", "x", "1.000,25"), "page_03_region_02": rows(F.concat(F.lit("total 12 "), n)),
        "page_03_region_04": rows("Bomba", "LED", "", "PV"), "page_03_region_05": rows(n, "1", "2", "3"), "page_03_region_06": rows("Ref"), "page_03_region_07": rows("4"), "page_03_region_08": rows(n, "1", "2", "3"), "page_03_region_09": rows("5", "6"), "page_03_region_10": rows(n), "page_03_region_12": rows("7", "8", "0,9"),
        "page_03_region_13": rows(n, "2"), "page_03_region_14": rows("3", n), "page_03_region_15": rows("0,7 -0,3 0,3 0 0", F.concat(n, F.lit(" x 2"))), "page_03_region_16": rows("0,5"),
    }
    mapped = F.create_map(*[x for name, value in regions.items() for x in (F.lit(name), value)])
    return table(spark, d, "orders").select(F.format_string("doc_%d_calificadas_x.pdf", k).alias("source_pdf"), F.when(k % 7 == 0, 4).otherwise(certificates.PAGES).alias("n_pages"), mapped.alias("regions"))


def certificate_rows(spark, d):
    """Rows of two regions: an even line follows the odd one before it without a gap."""
    line = F.col("l_linenumber")
    rows = table(spark, d, "lineitem").select("l_orderkey", line.cast("double").alias("l_linenumber")).distinct()
    y0 = line * 20
    shown = {certificates.MATERIAL_REGION: F.format_string("capa %.0f", line), certificates.REQUIREMENT_REGION: F.when(line % 2 == 1, F.format_string("%.0f,5", line)).otherwise("[W/m2K]")}
    each = F.explode(F.array(*[F.struct(F.lit(r).alias("region_id"), t.alias("text")) for r, t in shown.items()]))
    rows = rows.select(F.format_string("doc_%d_calificadas_x.pdf", "l_orderkey").alias("source_pdf"), F.lit(0.0).alias("x0"), y0.alias("y0"), F.lit(1.0).alias("x1"), (y0 + F.when(line % 2 == 1, 18.0).otherwise(8.0)).alias("y1"), F.lit(1).alias("n_words"), each.alias("r"))
    return rows.select("source_pdf", "r.*", "x0", "y0", "x1", "y1", "n_words")


def certificate_table(spark, d, name):
    return certificates.build(name, certificate_docs(spark, d), certificate_rows(spark, d))


@query(f"""SELECT document_id, 'doc_' || k || '_calificadas_x.pdf' AS source_pdf, 'calificada' AS estado_cev, 'Maule' AS region, o_orderpriority AS comuna, 'x' AS direccion, CAST(o_custkey AS VARCHAR) AS rol_vivienda, 'casa' AS tipo_vivienda, n AS superficie_util, CAST(o_custkey % 90 AS DOUBLE) AS ahorro, 'B' AS etiqueta, n AS demanda_calef, NULL::DOUBLE AS demanda_refri, strftime(o_orderdate, '%d-%m-%Y') AS fecha_emision, 'D' AS zona_termica, 's' AS solicitante, 'e' AS evaluador FROM {CERTIFIED}""")
def table_descripcion_general(spark, d):
    return certificate_table(spark, d, "descripcion_general")


@query(f"SELECT document_id, n AS acs_kwhm2, 2.0::DOUBLE AS ilum_kwhm2, NULL::DOUBLE AS calef_kwhm2, 1000.25::DOUBLE AS ernc_kwhm2, n AS consumo_kwhm2, NULL::DOUBLE AS emisiones_co2 FROM {CERTIFIED}")
def table_requerimientos(spark, d):
    return certificate_table(spark, d, "requerimientos")


@query(f"""SELECT document_id, 'Bomba' AS calef_proyec_descripcion, 'LED' AS ilum_proyec_descripcion, NULL::VARCHAR AS acs_proyec_descripcion, 'PV' AS ernc_proyec_descripcion, 'Ref' AS calef_ref_descripcion, NULL::VARCHAR AS ilum_ref_descripcion, NULL::VARCHAR AS acs_ref_descripcion, NULL::VARCHAR AS ernc_ref_descripcion,
n AS calef_proyec_kwh, 1.0::DOUBLE AS ilum_proyec_kwh, 2.0::DOUBLE AS acs_proyec_kwh, 3.0::DOUBLE AS ernc_proyec_kwh, 4.0::DOUBLE AS calef_ref_kwh, NULL::DOUBLE AS ilum_ref_kwh, NULL::DOUBLE AS acs_ref_kwh, NULL::DOUBLE AS ernc_ref_kwh FROM {CERTIFIED}""")
def table_descripcion_equipos(spark, d):
    return certificate_table(spark, d, "descripcion_equipos")


@query(f"""SELECT document_id, n AS consumo_primario_calef, 1.0::DOUBLE AS consumo_primario_acs, 2.0::DOUBLE AS consumo_primario_ilum, 3.0::DOUBLE AS consumo_primario_vent, 5.0::DOUBLE AS generacion_pv, 6.0::DOUBLE AS pv_consumos_basicos, NULL::DOUBLE AS dif_pv_consumo, n AS st_calef, NULL::DOUBLE AS st_acs,
NULL::DOUBLE AS consumo_primario, NULL::DOUBLE AS aporte_pv, NULL::DOUBLE AS consumos_energia_externa, 7.0::DOUBLE AS consumo_primario_2, 8.0::DOUBLE AS energia_ref, 0.9::DOUBLE AS coef_energetico_c FROM {CERTIFIED}""")
def table_requerimientos_total(spark, d):
    return certificate_table(spark, d, "requerimientos_total")


@query(f"SELECT document_id, o AS orientacion, CASE i WHEN 1 THEN n WHEN 2 THEN 2.0 END AS area, CASE i WHEN 1 THEN 0.5::DOUBLE END AS u FROM (SELECT document_id, n, unnest({certificates.OPAQUE!r}) AS o, unnest(range(1, {len(certificates.OPAQUE) + 1})) AS i FROM {CERTIFIED})")
def table_elementos_opacos(spark, d):
    return certificate_table(spark, d, "elementos_opacos")


@query(f"SELECT document_id, o AS orientacion, CASE i WHEN 1 THEN 3.0 WHEN 2 THEN n END AS area, NULL::DOUBLE AS u FROM (SELECT document_id, n, unnest({certificates.GLAZED!r}) AS o, unnest(range(1, {len(certificates.GLAZED) + 1})) AS i FROM {CERTIFIED})")
def table_elementos_traslucidos(spark, d):
    return certificate_table(spark, d, "elementos_traslucidos")


@query(f"""SELECT document_id, 'n' AS orientacion, 0.7::DOUBLE AS p01, -0.3::DOUBLE AS p02, 0.3::DOUBLE AS p03, 0.0::DOUBLE AS p04, 0.0::DOUBLE AS p05 FROM {CERTIFIED}
UNION ALL SELECT document_id, 'ne', n, 2.0, NULL, NULL, NULL FROM {CERTIFIED}""")
def table_puentes_termicos(spark, d):
    return certificate_table(spark, d, "puentes_termicos")


WRAPPED = f"""WITH l AS (SELECT DISTINCT l_orderkey AS k, l_linenumber AS n FROM lineitem), b AS (SELECT *, coalesce(n % 2 = 0 AND lag(n) OVER (PARTITION BY k ORDER BY n) = n - 1, false) AS goes_on FROM l),
r AS (SELECT *, sum(CAST(NOT goes_on AS INTEGER)) OVER (PARTITION BY k ORDER BY n ROWS UNBOUNDED PRECEDING) AS record FROM b),
t AS (SELECT k, record, string_agg('capa ' || n, ' ' ORDER BY n) AS material, CASE WHEN count(*) = 2 THEN min(n) + 0.5::DOUBLE END AS u, string_agg(CASE WHEN n % 2 = 1 THEN n || ',5' ELSE '[W/m2K]' END, ' ' ORDER BY n) AS shown FROM r GROUP BY 1, 2),
e AS (SELECT document_id, k, unnest({certificates.ELEMENTS!r}) AS elemento, unnest(range(1, {len(certificates.ELEMENTS) + 1})) AS record FROM {CERTIFIED})"""


@query(WRAPPED + " SELECT document_id, elemento, material AS descripcion FROM e LEFT JOIN t USING (k, record)")
def table_materialidades(spark, d):
    return certificate_table(spark, d, "materialidades")


@query(WRAPPED + " SELECT document_id, elemento, shown AS exigencia_texto, u AS exigencia_u FROM e LEFT JOIN t USING (k, record)")
def table_exigencia_u_normativa(spark, d):
    return certificate_table(spark, d, "exigencia_u_normativa")


@query("""WITH p AS (SELECT l_orderkey, max(l_extendedprice) FILTER (WHERE l_returnflag = 'A') AS price_A, max(l_extendedprice) FILTER (WHERE l_returnflag = 'N') AS price_N, max(l_extendedprice) FILTER (WHERE l_returnflag = 'R') AS price_R FROM lineitem GROUP BY 1),
r AS (SELECT c_custkey, s_suppkey, s_acctbal, row_number() OVER (PARTITION BY c_custkey ORDER BY (s_acctbal > c_acctbal) DESC NULLS FIRST, (substr(s_name, -1) = substr(c_name, -1)) DESC NULLS FIRST, s_suppkey) AS k FROM customer LEFT JOIN supplier ON s_nationkey = c_nationkey)
SELECT o_custkey AS c_custkey, p.*, o_totalprice, s_suppkey, s_acctbal FROM p JOIN orders ON o_orderkey = l_orderkey LEFT JOIN r ON r.c_custkey = o_custkey AND k = 1""")
def serving_view(spark, d):
    return flagship(spark, d)


# --- from characters to tables

TEMPLATE = [("page_01_region_01", 1, 0.0, 0.0, 1000.0, 200.0), ("page_01_region_03", 1, 0.0, 300.0, 1000.0, 340.0), ("page_02_region_01", 2, 0.0, 0.0, 1000.0, 200.0)]


def drawn(spark, d):
    """A document a customer, as a parser gives it: seven pages, a character a letter, one hidden line."""
    key, segment = F.col("c_custkey").cast("string"), F.lower("c_mktsegment")
    lines = [(1, 10, F.lit("Certificado")), (1, 30, F.concat(F.lit("Region: "), segment)), (1, 50, F.lit("Comuna: Talca")), (1, 70, F.concat(F.lit("Direccion: calle "), key)), (1, 90, F.concat(F.lit("Rol: R"), key)), (1, 110, F.lit("Tipo: casa")), (1, 130, F.lit("Sup: 57,2")),
             (1, 150, F.lit("oculto")), (1, 310, F.concat(F.lit("demanda 10 "), key, F.lit(",5"))), (2, 10, F.lit("Zona: D")), (2, 30, F.lit("7")), (2, 50, F.lit("Sol: s")), (2, 70, F.concat(F.lit("Ev: "), segment)), (2, 90, F.concat(F.lit("Codigo: c"), key))]
    names = "struct<page:int,seqno:int,layer:string,opacity:double,text:string,x0:double,y0:double,x1:double,y1:double>"

    def letters(page, y, t):
        return F.transform(F.split(t, ""), lambda c, i: F.struct(F.lit(page).alias("page"), F.lit(1).alias("seqno"), F.lit("l").alias("layer"), F.lit(1.0).alias("opacity"), c.alias("text"), (6.0 * i).alias("x0"), F.lit(float(y)).alias("y0"), (6.0 * i + 6).alias("x1"), F.lit(y + 8.0).alias("y1")).cast(names))

    cover = F.array(F.struct(F.lit(1).alias("page"), F.lit(2).alias("seqno"), F.lit("fill-path").alias("kind"), F.lit(0.0).alias("x0"), F.lit(148.0).alias("y0"), F.lit(900.0).alias("x1"), F.lit(160.0).alias("y1")))
    return table(spark, d, "customer").select(F.concat(F.lit("x"), key, F.lit("_calificadas_i.pdf")).alias("doc"), F.when(F.col("c_custkey") % 10 == 0, 4).otherwise(7).alias("n_pages"), F.concat(*[letters(*line) for line in lines]).alias("chars"), cover.alias("shapes"))


@query("""SELECT 'c' || c_custkey AS document_id, 'calificada' AS estado_cev, lower(c_mktsegment) AS region, 'Talca' AS comuna, 'calle ' || c_custkey AS direccion, 'R' || c_custkey AS rol_vivienda, CAST(57.2 AS DOUBLE) AS superficie_util, c_custkey + CAST(0.5 AS DOUBLE) AS demanda_calef,
'D' AS zona_termica, lower(c_mktsegment) AS evaluador FROM customer WHERE c_custkey % 10 <> 0""")
def extracted_general(spark, d):
    regions = spark.createDataFrame(TEMPLATE, "id string, page int, x0 double, y0 double, x1 double, y1 double")
    return parsed.extract(drawn(spark, d), regions)["descripcion_general"].select("document_id", "estado_cev", "region", "comuna", "direccion", "rol_vivienda", "superficie_util", "demanda_calef", "zona_termica", "evaluador")


# --- names, labels and points

LABELS = ["Pre-Calificación", " Calificación ", "otro", "precalificacion 2", ""]
ZONES = ["zona d", "H ", "3", "CL I", "x-a"]


@query(f"""SELECT o_orderkey, CASE WHEN contains(f, 'calificacion') AND contains(f, 'pre') THEN 'precalificada' WHEN contains(f, 'calificacion') THEN 'calificada' ELSE trim(s) END AS status, CASE WHEN regexp_matches(trim(z), '[A-Ia-i]$') THEN upper(right(trim(z), 1)) ELSE trim(z) END AS zone
FROM (SELECT o_orderkey, s, z, lower(strip_accents(trim(s))) AS f FROM (SELECT o_orderkey, {LABELS}[o_orderkey % 5 + 1] AS s, {ZONES}[o_custkey % 5 + 1] AS z FROM orders))""")
def status_and_zone(spark, d):
    labels, zones = (F.array(*[F.lit(x) for x in v]) for v in (LABELS, ZONES))
    rows = table(spark, d, "orders").select("o_orderkey", labels[(F.col("o_orderkey") % 5).cast("int")].alias("s"), zones[(F.col("o_custkey") % 5).cast("int")].alias("z"))
    return rows.select("o_orderkey", text.status(F.col("s")).alias("status"), text.zone(F.col("z")).alias("zone"))


@query("""SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN CAST(o_custkey % 100 AS DOUBLE) WHEN 1 THEN o_custkey % 100 + 0.5 END AS saving, CASE o_orderkey % 3 WHEN 0 THEN 'C' END AS label FROM orders""")
def saving_label(spark, d):
    k, n = F.col("o_orderkey") % 3, F.col("o_custkey") % 100
    shown = F.when(k == 0, F.concat(F.lit("AHORRO "), n, F.lit("% C fin"))).when(k == 1, F.concat(F.lit("("), n, F.lit(",5)"))).otherwise("sin dato")
    saving = numbers.saving_and_label(F.split(shown, " "))
    return table(spark, d, "orders").select("o_orderkey", saving["saving"].alias("saving"), saving["label"].alias("label"))


@query("""SELECT c_custkey, replace(printf('%.2f%%', c_acctbal), '.', ',') AS shown, contains(lower(c_mktsegment), 'build') AS building, regexp_matches(c_mktsegment, '\\bHOUSE\\b') AS house, split_part(c_name, '#', 2) AS code FROM customer""")
def text_predicates(spark, d):
    return table(spark, d, "customer").select("c_custkey", text.percent_text(F.col("c_acctbal")).alias("shown"), text.contains_fold(F.col("c_mktsegment"), "Build").alias("building"), text.has_word(F.col("c_mktsegment"), "HOUSE").alias("house"), text.after_colon(F.replace("c_name", F.lit("#"), F.lit(": "))).alias("code"))


@query("""SELECT event_id, CASE WHEN n = 1 THEN event_type || s ELSE event_type || '_' || n || s END AS name FROM (SELECT *, CASE WHEN event_id % 2 = 0 THEN '.pdf' ELSE '.bin' END AS s, row_number() OVER (PARTITION BY event_type, event_id % 2 ORDER BY event_id) AS n FROM events)""")
def sniffed_unique_names(spark, d):
    content = F.when(F.col("event_id") % 2 == 0, F.encode(F.lit("%PDF-1.7"), "utf-8")).otherwise(F.encode(F.lit("<html>"), "utf-8"))
    rows = table(spark, d, "events").select("event_id", files.sniffed_name(F.col("event_type"), content, F.lit("text/html")).alias("name"))
    return files.unique_names(rows, "name", "event_id")


@query("""SELECT c_custkey, 'POINT(' || c_nationkey || ' ' || c_custkey || ')' AS point FROM customer""")
def wkt_points(spark, d):
    return table(spark, d, "customer").select("c_custkey", relational.wkt_point(F.col("c_nationkey"), F.col("c_custkey")).alias("point"))


# --- features

@query(f"""WITH i AS (SELECT l_orderkey, coalesce(l_tax, (SELECT median(l_tax) FROM {NULLED})) AS t, coalesce(l_discount, (SELECT median(l_discount) FROM {NULLED})) AS s FROM {NULLED}), m AS (SELECT avg(t) AS mt, stddev_pop(t) AS dt, avg(s) AS ms, stddev_pop(s) AS ds FROM i)
SELECT l_orderkey, round((t - mt) / dt, 8) + 0.0 AS l_tax, round((s - ms) / ds, 8) + 0.0 AS l_discount FROM i, m""")
def impute_standardise(spark, d):
    rows = with_nulls(table(spark, d, "lineitem")).select("l_orderkey", "l_tax", "l_discount")
    cols = ["l_tax", "l_discount"]
    out = features.standardise(features.impute(rows, features.imputation_values(rows, cols, [])), cols)
    return out.select("l_orderkey", *[(F.round(c, 8) + 0.0).alias(c) for c in cols])


@query("""SELECT l_orderkey, l_linenumber, coalesce(CAST(l_returnflag = 'A' AS DOUBLE), 0) AS l_returnflag_A, coalesce(CAST(l_returnflag = 'N' AS DOUBLE), 0) AS l_returnflag_N, coalesce(CAST(l_returnflag = 'R' AS DOUBLE), 0) AS l_returnflag_R FROM lineitem""")
def one_hot_columns(spark, d):
    out, new = features.one_hot(table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag"), ["l_returnflag"])
    return out.select("l_orderkey", "l_linenumber", *new)


MESSY = "CASE WHEN o_orderkey % 7 = 0 THEN NULL WHEN o_orderkey % 7 = 1 THEN chr(9) || ' missing ' ELSE ' ' || o_orderpriority || chr(10) END"


@query(f"""SELECT o_orderkey, CASE WHEN v IS NULL OR v = 'missing' THEN 'missing' ELSE v END AS kind, CASE WHEN v IS NULL OR v = 'missing' THEN 'indeterminado' ELSE v END AS tipo_inmueble FROM (SELECT o_orderkey, trim(x, chr(9) || chr(10) || ' ') AS v FROM (SELECT o_orderkey, {MESSY} AS x FROM orders))""")
def filled_categories(spark, d):
    k = F.col("o_orderkey") % 7
    messy = F.when(k == 0, None).when(k == 1, "\t missing ").otherwise(F.concat(F.lit(" "), "o_orderpriority", F.lit("\n")))
    rows = table(spark, d, "orders").select("o_orderkey", messy.alias("kind"), messy.alias("tipo_inmueble"))
    return features.fill_categories(rows, ["kind", "tipo_inmueble"], {"tipo_inmueble": "indeterminado"})


@query("""WITH t AS (SELECT CASE l_returnflag WHEN 'A' THEN 'casa_aislada' WHEN 'N' THEN 'depto' END AS stratum, l_quantity AS x, l_extendedprice AS y FROM lineitem),
c AS (SELECT stratum, abs(corr(x, y)) AS r, count(*) * 1.0 / (count(*) - 1) AS f FROM t WHERE stratum IS NOT NULL GROUP BY 1)
SELECT stratum, 'pc1' AS component, round((1 + r) * f, 8) AS variance, round((1 + r) / 2, 8) AS share, round((1 + r) / 2, 8) AS cumulative FROM c UNION ALL SELECT stratum, 'pc2', round((1 - r) * f, 8), round((1 - r) / 2, 8), 1.0 FROM c""")
def pca_by_stratum(spark, d):
    """Of two numbers, whose components SQL knows: one plus and one less the correlation. Types are written in several ways; one type is unknown and one has no rows."""
    kind = F.when(F.col("l_returnflag") == "R", "otro").when(F.col("l_returnflag") == "N", F.when(F.col("l_linenumber") % 2 == 0, " Departamento").otherwise("DEPTO")).otherwise(F.when(F.col("l_linenumber") % 2 == 0, "casa aislada").otherwise("Casa_Aislada\t"))
    models = features.pca_by_stratum(table(spark, d, "lineitem").withColumn("kind", kind), "kind", ["l_quantity", "l_extendedprice"], [], 2)
    out = features.variance_by_stratum(spark, models, "stratum")
    return out.select("stratum", "component", *[F.round(c, 8).alias(c) for c in ("variance", "share", "cumulative")])


@query("""WITH g AS (SELECT c_nationkey % 6 - 1 AS label, count(*) AS n FROM customer GROUP BY 1), m AS (SELECT label, v, row_number() OVER (PARTITION BY label ORDER BY k DESC, v) AS i FROM (SELECT c_nationkey % 6 - 1 AS label, c_mktsegment AS v, count(*) AS k FROM customer GROUP BY 1, 2)),
o AS (SELECT g.label, n, v FROM g JOIN m ON g.label = m.label AND i = 1 WHERE g.label <> -1), t AS (SELECT v, row_number() OVER (ORDER BY count(*) DESC, v) AS i FROM o GROUP BY v)
SELECT min(n) AS least_n, median(n) AS median_n, max(n) AS most_n, arg_min(label, (-n, label)) AS largest, round(100.0 * max(n) / (SELECT count(*) FROM customer), 6) AS largest_pct, (SELECT string_agg(v, ', ' ORDER BY i) FROM t WHERE i <= 3) AS top_c_mktsegment FROM o""")
def report_facts(spark, d):
    rows = table(spark, d, "customer").withColumn("label", F.col("c_nationkey") % 6 - 1)
    facts = clustering.report_facts(clustering.cluster_profile(rows, "label", ["c_acctbal"], ["c_mktsegment"]), "label", ["c_mktsegment"])
    return facts.withColumn("largest_pct", F.round("largest_pct", 6)).drop("largest_label")


@query("""SELECT user_id, event_type, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id DESC) AS k FROM events) WHERE k = 1""")
def sorted_catalogue(spark, d):
    return relational.sorted_catalogue(table(spark, d, "events"), ["user_id", "event_type"], "event_id", ["user_id", "event_type"]).select("user_id", "event_type", "value")


# --- sources and sinks, there and back (of the 25 nations or 5 regions: their number never grows)


def scratch(spark, suffix: str) -> str:
    return f"{sinks.shared_folder(spark)}/sources/{uuid.uuid4().hex}{suffix}"


def local_scratch(spark, suffix: str) -> str:
    """For formats that Spark doesn't write: the shared folder as a path that the driver and every executor mount."""
    base = re.sub("^file:/+", "/", sinks.shared_folder(spark))
    if not base.startswith("/"):
        raise ValueError(f"{base} isn't a mounted folder")
    folder = Path(base) / "sources"
    folder.mkdir(parents=True, exist_ok=True)
    return str(folder / f"{uuid.uuid4().hex}{suffix}")


def nations(spark, d):
    return table(spark, d, "nation").select("n_nationkey", "n_name", "n_regionkey").orderBy("n_nationkey")


@query("SELECT n_nationkey, n_name, n_regionkey FROM nation")
def csv_scan(spark, d):
    path = scratch(spark, ".csv")
    sinks.write_semicolon(nations(spark, d), path)
    return tables.read(spark, path, sep=";")


@query("SELECT n_nationkey, n_name FROM nation UNION ALL SELECT n_nationkey, n_name FROM nation WHERE n_regionkey = 1")
def csv_append_log(spark, d):
    path, rows = scratch(spark, ".csv"), nations(spark, d)
    sinks.append_log(rows.select("n_nationkey", "n_name"), path)
    sinks.append_log(rows.where("n_regionkey = 1").select("n_nationkey", "n_name"), path)
    return tables.read(spark, path)


@query("SELECT n_nationkey, n_name, n_regionkey FROM nation")
def json_rows(spark, d):
    path = scratch(spark, ".json")
    sinks.as_json(nations(spark, d)).write.text(path)
    return spark.read.schema("n_nationkey bigint, n_name string, n_regionkey bigint").json(path)


@query("SELECT 2 * row_number() OVER (ORDER BY n_nationkey) + 1 AS fila_origen, CAST(n_nationkey AS VARCHAR) AS clave, n_name AS nombre, '' AS vacio, CASE WHEN n_regionkey = 0 THEN '' ELSE CAST(n_regionkey AS VARCHAR) END AS region FROM nation")
def xlsx_scan(spark, d):
    """A workbook with shared and inline strings, numbers, gaps between cells and empty rows between full ones."""
    rows = nations(spark, d).collect()
    cells = lambda i, xs: f'<row r="{i}">' + "".join(f'<c r="{c}{i}" t="{t}">' + (f"<is><t>{v}</t></is>" if t == "inlineStr" else f"<v>{v}</v>") + "</c>" for c, t, v in xs) + f'</row><row r="{i + 1}"><c r="A{i + 1}"/></row>'
    sheet = cells(1, [("A", "inlineStr", "clave"), ("B", "inlineStr", "nombre"), ("C", "inlineStr", "vacio"), ("D", "inlineStr", "region")])
    sheet += "".join(cells(2 * k + 3, [("A", "n", r[0]), ("B", "s", k)] + [("D", "n", r[2])] * (r[2] != 0)) for k, r in enumerate(rows))
    main = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    path = local_scratch(spark, ".xlsx")
    with zipfile.ZipFile(path, "w") as book:
        book.writestr("xl/sharedStrings.xml", f"<sst {main}>" + "".join(f"<si><r><t>{r[1][:2]}</t></r><r><t>{r[1][2:]}</t></r></si>" for r in rows) + "</sst>")
        book.writestr("xl/worksheets/sheet1.xml", f"<worksheet {main}><sheetData>{sheet}</sheetData></worksheet>")
    return tables.read(spark, f"file://{path}")


def nation_file(spark, d) -> str:
    path = local_scratch(spark, ".sqlite")
    with closing(sqlite3.connect(path)) as con, con:
        con.execute("CREATE TABLE nacion (clave INTEGER PRIMARY KEY, nombre TEXT, region INT, medida REAL)")
        con.executemany("INSERT INTO nacion VALUES (?, ?, ?, ?)", [(1000 * r[0], r[1], r[2], r[0] / 4 if r[0] % 2 else None) for r in nations(spark, d).collect()])
        con.execute("CREATE TABLE region (clave TEXT PRIMARY KEY, n INT) WITHOUT ROWID")
        con.executemany("INSERT INTO region VALUES (?, ?)", [(f"r{r[0]}", r[0]) for r in table(spark, d, "region").select("r_regionkey").collect()])
    return path


@query("SELECT 1000 * n_nationkey AS clave, n_name AS nombre, 'r' || n_regionkey AS region, CASE WHEN n_nationkey % 2 = 1 THEN n_nationkey / 4 END AS medida FROM nation")
def sqlite_scan(spark, d):
    """Two tables of a file joined in SQL: one with rowids, one without."""
    path = nation_file(spark, d)
    return sqlite.read_table(spark, path, "nacion").withColumnRenamed("region", "n").join(sqlite.read_table(spark, path, "region").withColumnRenamed("clave", "region"), "n").select("clave", "nombre", "region", "medida")


@query("SELECT * FROM (VALUES ('nacion', 'clave', 'bigint'), ('nacion', 'nombre', 'string'), ('nacion', 'region', 'bigint'), ('nacion', 'medida', 'double'), ('region', 'clave', 'string'), ('region', 'n', 'bigint')) v(tabla, columna, tipo)")
def sqlite_schema(spark, d):
    path = nation_file(spark, d)
    return spark.createDataFrame([(t, c, k) for t in sqlite.list_tables(path) for c, k in sqlite.table_schema(path, t)], "tabla string, columna string, tipo string")


@query("SELECT printf('page_%02d_region_%02d', n_regionkey + 1, n_nationkey) AS id, n_regionkey + 1 AS page, round(n_nationkey / 3, 2) AS x0, round(n_nationkey / 3, 2) + 5 AS x1, printf('page_%02d_region_%02d', n_regionkey + 1, max(n_nationkey) OVER (PARTITION BY n_regionkey) + 1) AS next_id FROM nation")
def regions_scan(spark, d):
    """Rectangles of two clicks each, to JSON and back, with the next free name of their page."""
    rows = nations(spark, d).collect()
    path = local_scratch(spark, ".json")
    sinks.write_json({"regions": [{"id": f"page_{r[2] + 1:02d}_region_{r[0]:02d}", "page": r[2] + 1, **files.rectangle(round(r[0] / 3, 2) + 5, 9.0, r[0] / 3, 1.0)} for r in rows]}, path)
    found = files.read_regions(spark, f"file://{path}")
    following = spark.createDataFrame([(p, files.next_region_id(found, p)) for p in sorted({r[2] + 1 for r in rows})], "page long, next_id string")
    return found.join(F.broadcast(following), "page").select("id", "page", "x0", "x1", "next_id")


@query("SELECT n_nationkey || '.pdf' AS name, 5 AS length FROM nation WHERE n_regionkey <> 0")
def discovered_files(spark, d):
    """Files of folders by pattern; another kind of file stands beside them."""
    root = Path(local_scratch(spark, ""))
    for r in nations(spark, d).collect():
        folder = root / str(r[2])
        folder.mkdir(parents=True, exist_ok=True)
        (folder / f"{r[0]}.{'pdf' if r[2] else 'txt'}").write_bytes(b"%PDF-")
    found = files.discover(spark, f"file://{root}", after=datetime(2000, 1, 1))
    return found.select(F.substring_index("path", "/", -1).alias("name"), "length")


# --- incremental mode

@query("""SELECT event_id, user_id, event_type, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id DESC) AS k FROM events) WHERE k = 1""")
def incremental_upsert(spark, d):
    """The events as a stream of files (a pattern, since a stream takes a file only so), upserted by key in micro-batches, then the newest row of every key."""
    base = f"{sinks.shared_folder(spark)}/incremental-{uuid.uuid4().hex}"
    stream = incremental.new_files(spark, f"{d}/events.parque[t]", table(spark, d, "events").schema)
    incremental.upsert_stream(stream, ["user_id", "event_type"], "event_id", f"{base}/rows", f"{base}/state").awaitTermination()
    return incremental.read_latest(spark, f"{base}/rows", ["user_id", "event_type"]).select("event_id", "user_id", "event_type", "value")


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The serving view: pivot, inner join, best match."""
    pivot = pivot_filtered_max(spark, sf_dir)
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("c_custkey"))
    return pivot.join(orders, "l_orderkey").join(lateral_top1_match(spark, sf_dir), "c_custkey", "left")


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
