"""Imputation, scaling, one-hot encoding and principal components of mixed columns."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import strip
from . import quantiles

#: Features that a covariance matrix may have: it is held on the driver, features squared.
MOST_FEATURES = 2000
# Fixed value: the category of a missing one in distances.
UNKNOWN = "desconocido"
# Fixed value: a missing category where components are made.
MISSING = "missing"
# The types of dwellings and the spellings of each.
DWELLINGS = {
    "casa_aislada": ["casa_aislada", "casa aislada"],
    "casa_pareada": ["casa_pareada", "casa pareada"],
    "depto": ["depto", "departamento"],
}


def imputation_values(df: DataFrame, numeric: list[str], categorical: list[str]) -> dict[str, object]:
    """Exact medians and most frequent values (the least of equal ones). Raises if a numeric column has no value."""
    values = medians(df, numeric)
    row = df.agg(*[F.mode(F.col(c), True).alias(c) for c in categorical]).first() if categorical else {}
    return values | {c: "missing" if row[c] is None else row[c] for c in categorical}


def medians(df: DataFrame, cols: list[str]) -> dict[str, float]:
    found = {r["variable"]: r["q"][0] for r in quantiles.percentiles(df, cols, [0.5]).collect()} if cols else {}
    if missing := [c for c in cols if c not in found]:
        raise ValueError(f"no values at all in {missing}")
    return {c: found[c] for c in cols}


def imputation_for_distances(df: DataFrame, numeric: list[str], categorical: list[str]) -> dict[str, object]:
    """Exact medians; a missing category is one of its own."""
    return medians(df, numeric) | dict.fromkeys(categorical, UNKNOWN)


def impute(df: DataFrame, values: dict[str, object]) -> DataFrame:
    return df.fillna(values)


def fill_categories(df: DataFrame, cols: list[str], other: dict[str, str] | None = None) -> DataFrame:
    """Stripped text with `missing` for null, or what `other` names for the column; a value that reads `missing` goes the same way."""
    other = other or {}
    return df.withColumns({c: F.when(F.coalesce(strip(F.col(c)) == MISSING, F.lit(True)), other.get(c, MISSING)).otherwise(strip(F.col(c))) for c in cols})


def select_features(df: DataFrame, excluded: list[str]) -> tuple[list[str], list[str]]:
    """Numeric and string columns that aren't excluded and have any value."""
    numeric = [f.name for f in df.schema if isinstance(f.dataType, T.NumericType) and f.name not in excluded]
    text = [f.name for f in df.schema if isinstance(f.dataType, T.StringType) and f.name not in excluded]
    counts = df.agg(*[F.count(c).alias(c) for c in (*numeric, *text)]).first() if numeric or text else {}
    return [c for c in numeric if counts[c]], [c for c in text if counts[c]]


def standardise(df: DataFrame, cols: list[str]) -> DataFrame:
    """Zero mean and unit population deviation; a constant column becomes zero."""
    stats = df.agg(*[F.struct(F.avg(c).alias("m"), F.stddev_pop(c).alias("s")).alias(c) for c in cols]).first()
    return df.withColumns({c: (F.col(c) - F.lit(stats[c]["m"])) / F.lit(stats[c]["s"] or 1.0) for c in cols})


def one_hot(df: DataFrame, cols: list[str]) -> tuple[DataFrame, list[str]]:
    """A 0/1 column for each category, in order of names; unknown or null is all zero."""
    kinds = {c: [r[0] for r in df.select(c).where(F.col(c).isNotNull()).distinct().orderBy(c).limit(MOST_FEATURES + 1).collect()] for c in cols}
    if sum(map(len, kinds.values())) > MOST_FEATURES:
        raise ValueError("more categories than a covariance matrix may have")
    new = {f"{c}_{v}": F.coalesce((F.col(c) == v).cast("double"), F.lit(0.0)) for c in cols for v in kinds[c]}
    return df.withColumns(new), list(new)


@dataclass
class Components:
    features: list[str]
    means: np.ndarray
    loadings: np.ndarray  # feature by component
    variances: np.ndarray
    total: float

    def scores(self, df: DataFrame) -> DataFrame:
        """df with pc1, pc2, ...: linear expressions, no Python."""
        def term(j: int):
            return sum((F.col(f"`{f}`") - float(m)) * float(w) for f, m, w in zip(self.features, self.means, self.loadings[:, j], strict=True))

        return df.withColumns({f"pc{j + 1}": term(j) for j in range(self.loadings.shape[1])})

    def variance_table(self, spark) -> DataFrame:
        share = self.variances / self.total
        return spark.createDataFrame([(f"pc{j + 1}", float(v), float(s), float(c)) for j, (v, s, c) in enumerate(zip(self.variances, share, np.cumsum(share), strict=True))], "component string, variance double, share double, cumulative double")

    def loading_table(self, spark) -> DataFrame:
        return spark.createDataFrame([(f"pc{j + 1}", f, float(self.loadings[i, j])) for j in range(self.loadings.shape[1]) for i, f in enumerate(self.features)], "component string, feature string, loading double")


def components(df: DataFrame, features: list[str], k: int) -> Components:
    """Principal components from the covariance matrix, which one pass sums up; the sign makes each component's largest loading positive."""
    if len(features) > MOST_FEATURES:
        raise ValueError("too many features")
    vector = F.array(*[F.col(f"`{f}`").cast("double") for f in features])
    d = len(features)

    def sums(batches):
        import pyarrow as pa

        n, s, ss = 0, np.zeros(d), np.zeros((d, d))
        for b in batches:
            x = np.asarray(b.column(0).flatten()).reshape(-1, d)
            n, s, ss = n + len(x), s + x.sum(0), ss + x.T @ x
        yield pa.RecordBatch.from_arrays([pa.array([float(n)]), pa.array([s.tolist()], pa.list_(pa.float64())), pa.array([ss.ravel().tolist()], pa.list_(pa.float64()))], ["n", "s", "ss"])

    # Each task's sums are a fixed number of values; they are added up by place, so the driver gets one row a place.
    parts = df.select(vector.alias("x")).mapInArrow(sums, "n double, s array<double>, ss array<double>")
    flat = parts.select(F.posexplode(F.concat(F.array("n"), "s", "ss")).alias("i", "v")).groupBy("i").agg(F.sum("v").alias("v")).orderBy("i").collect()
    v = np.array([r["v"] for r in flat])
    n, mean = v[0], v[1 : 1 + d] / max(1, v[0])
    cov = (v[1 + d :].reshape(d, d) - n * np.outer(mean, mean)) / max(1, n - 1)
    values, vectors = np.linalg.eigh(cov)
    order = np.argsort(values)[::-1][: min(k, d, max(1, int(n) - 1))]
    vectors = vectors[:, order]
    vectors *= np.sign(vectors[np.abs(vectors).argmax(0), np.arange(len(order))])
    return Components(features, mean, vectors, np.maximum(values[order], 0), float(np.trace(cov)))


def pca(df: DataFrame, numeric: list[str], categorical: list[str], k: int = 2) -> tuple[DataFrame, Components]:
    """Impute, scale, encode and project: the frame with its scores, and the components."""
    filled = impute(df, imputation_values(df, numeric, categorical))
    scaled = standardise(filled, numeric)
    encoded, hot = one_hot(scaled, categorical)
    model = components(encoded, [*numeric, *hot], k)
    return model.scores(encoded), model


def pca_by_stratum(df: DataFrame, stratum: str, numeric: list[str], categorical: list[str], k: int = 5, synonyms: dict[str, list[str]] = DWELLINGS) -> dict[str, tuple[DataFrame, Components]]:
    """pca() for each stratum, under its name; a stratum has the rows whose text is one of its spellings, whatever the case. A stratum without rows is left out."""
    written = strip(F.lower(F.coalesce(F.col(stratum), F.lit(MISSING))))
    out = {}
    for name, spellings in synonyms.items():
        part = df.where(written.isin(spellings))
        if not part.isEmpty():
            out[name] = pca(part, numeric, categorical, k)
    return out


def variance_by_stratum(spark, models: dict[str, tuple[DataFrame, Components]], stratum: str) -> DataFrame:
    tables = [model.variance_table(spark).withColumn(stratum, F.lit(name)) for name, (_, model) in models.items()]
    empty = spark.createDataFrame([], f"component string, variance double, share double, cumulative double, `{stratum}` string")
    return reduce(DataFrame.unionByName, tables, empty)


def aggregate_loadings(table: DataFrame, names: list[str]) -> DataFrame:
    """By component and original variable: the sum of absolute loadings, signed like the largest of them."""
    own = F.lit(None).cast("string")
    for c in sorted(names, key=len):
        own = F.when((F.col("feature") == c) | F.startswith(F.col("feature"), F.lit(c + "_")), c).otherwise(own)
    out = table.withColumn("variable", F.coalesce(own, F.col("feature"))).groupBy("component", "variable").agg(F.sum(F.abs("loading")).alias("weight"), F.signum(F.max_by("loading", F.abs("loading"))).alias("sign"))
    return out.select("component", "variable", (F.col("weight") * F.col("sign")).alias("loading"), "weight")
