"""Hierarchical empirical Bayes quality classifier.

Three levels of evidence meet in the log-odds of a document being good: a classifier of the text (a naive Bayes score of marked words and word
beginnings for toxicity, a logistic score of the text's shape for quality), the posterior of its path and that of its host. A site's
posterior is a Beta posterior of the share of good documents (labels where there are any, else the classifier's probabilities),
with the level above as prior: path under host, host under all. No evidence counts twice: a path's prior is its host without that path, and a document's site
is taken without the document itself. Each level's prior weight is fitted by the method of moments from the
spread of its rates around the level above, so sparse sites stay near the rate above them and large ones speak for themselves.

A document is kept if its probability of being toxic is below one half and that of good quality is one half or more.

Nulls: a null or empty text has no evidence but its site's and is of bad quality; a null source is a site of its own; null labels are unknown; a document with a null id has no label.
Repeated rows: each is scored by itself. Labels twice for a document: their mean. Very long texts: scored whole, in pieces of memory. Clashing names: extra columns of any name
are kept as they are. Empty table: no rows. Ties: one half is toxic, and good.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import column, discard, skew_join, small_batches, stage, without
from .textkernel import SPACE, U, chunks, mix, span_hashes, text_bytes, word_spans

#: Labelled documents that the text classifier is fitted on at most, and the most bytes that one may have.
TRAIN_ROWS, TRAIN_BYTES = 4000, 20_000
#: Buckets of hashed words and word beginnings.
BUCKETS = 1 << 18
#: Sites up to which posteriors are broadcast; more are joined.
BROADCAST_SITES = 50_000
#: Letters and bytes above 0x7F are word letters, everything else separates.
NOT_LETTER = np.ones(256, bool)
NOT_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = False
KINDS = np.zeros((256, 6), bool)
KINDS[[*range(97, 123)], 0] = True
KINDS[[*range(65, 91)], 1] = True
KINDS[[*range(128, 256)], 2] = True
KINDS[[*range(48, 58)], 3] = True
KINDS[[10, 13], 4] = True
KINDS[[c for c in range(33, 127) if not chr(c).isalnum() and chr(c) not in ".,;:'\"-?()"], 5] = True


def shape(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A row of numbers for each text: what kinds of bytes and words it has, and how much it repeats itself."""
    n = len(offsets) - 1
    counts = np.stack([np.diff(np.concatenate([[0], np.cumsum(KINDS[data, k])])[offsets]) for k in range(6)], 1).astype(float) if len(data) else np.zeros((n, 6))
    size = np.maximum(1, np.diff(offsets))
    starts, ends, first = word_spans(data, offsets, SPACE)
    words = np.maximum(1, np.diff(first))
    h = span_hashes(data, starts, ends)
    distinct, again = np.ones(n), np.zeros(n)
    for i in range(n):
        w = h[first[i] : first[i + 1]]
        if len(w):
            distinct[i] = len(np.unique(w)) / len(w)
            again[i] = (w[1:] == w[:-1]).sum() / len(w)
    long = np.diff(np.concatenate([[0], np.cumsum((ends - starts) > 25)])[first]) / words
    single = np.diff(np.concatenate([[0], np.cumsum((ends - starts) == 1)])[first]) / words
    shares = counts / size[:, None]
    letters = shares[:, 0] + shares[:, 1] + shares[:, 2]
    odds = [np.sqrt(x) for x in (shares[:, 1], shares[:, 5], shares[:, 3], again, single, long)]
    return np.stack([np.ones(n), *odds, shares[:, 1] / np.maximum(letters, 1e-9), shares[:, 5] * 10, letters, distinct, np.log1p(words) * (1 - distinct), np.log1p(words), shares[:, 4] * 10, again], 1)


STEMS = (4, 5, 6)
#: Different words of one stem in a text that make a mark of their own.
THRICE = 3


def marks(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For each word: its hash, the buckets of itself and its stems (beginnings of four to six bytes), the buckets of its stems as marks of several words; and the index of each text's first word."""
    starts, ends, first = word_spans(data, offsets, NOT_LETTER)
    words = span_hashes(data, starts, ends)
    stems = [span_hashes(data, starts, np.minimum(starts + k, ends)) * U(2 * k + 1) + U(k) for k in STEMS]
    bucket = lambda cols: (np.stack(cols, 1) >> U(64 - 18)).astype(np.int32) if len(starts) else np.zeros((0, len(cols)), np.int32)
    return words, bucket([words, *stems]), bucket([mix(x ^ U(0x5851F42D4C957F2D)) for x in stems]), first


def in_several(text: np.ndarray, bucket: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Whether the text has THRICE or more different words in the bucket, for each (text, bucket, word)."""
    if not len(text):
        return np.zeros(0, bool)
    group = text.astype(np.int64) * BUCKETS + bucket
    order = np.lexsort((words, group))
    g, w = group[order], words[order]
    new = np.concatenate([[True], (g[1:] != g[:-1]) | (w[1:] != w[:-1])])
    start = np.concatenate([[True], g[1:] != g[:-1]])
    number = np.cumsum(start) - 1
    out = np.empty(len(text), bool)
    out[order] = (np.bincount(number, new) >= THRICE)[number]
    return out


class Model:
    """toxic: log-odds a bucket adds where it is present; weights: of shape(); both with their priors."""

    def __init__(self, texts: list[str], quality: np.ndarray, toxic: np.ndarray):
        # In parts, so that only the texts themselves are held whole.
        parts = [text_bytes(pa.array(texts[i : i + 250], pa.string())) for i in range(0, len(texts), 250)]
        self.toxic_weights = self.fit_toxic(parts, toxic)
        x = np.concatenate([shape(*p) for p in parts]) if parts else shape(np.zeros(0, np.uint8), np.zeros(1, np.int64))
        self.mean, self.scale = (x.mean(0), x.std(0) + 1e-6) if len(x) else (np.zeros(x.shape[1]), np.ones(x.shape[1]))
        self.mean[0], self.scale[0] = 0, 1
        known = ~np.isnan(quality)
        self.weights = logistic((x[known] - self.mean) / self.scale, quality[known])
        t = np.concatenate([self.toxic_evidence(*p) for p in parts]) if parts else np.zeros(0)
        seen = ~np.isnan(toxic)
        self.toxic_line = logistic(np.stack([np.ones(seen.sum()), t[seen]], 1), toxic[seen], ridge=0.01) if seen.any() else np.array([-5.0, 0.0])

    def fit_toxic(self, parts: list[tuple[np.ndarray, np.ndarray]], toxic: np.ndarray) -> np.ndarray:
        """Log-odds of a word's or stem's bucket where a text has it (first row), and of a stem's bucket where a text has several of its words (second row)."""
        bad, good = toxic == 1, toxic == 0
        a, b, sightings, at = np.zeros((2, BUCKETS)), np.zeros((2, BUCKETS)), np.zeros(BUCKETS), 0
        for data, offsets in parts:
            words, buckets, stems, first = marks(data, offsets)
            text = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
            # A stem is sighted once for each text and different word: one of two words in each of two texts is seen four times.
            cell = (text[:, None].astype(np.int64) * BUCKETS + buckets).ravel()
            seen = np.unique(np.stack([cell, np.repeat(buckets[:, 0], buckets.shape[1])], 1), axis=0)[:, 0]
            sightings += np.bincount(seen[bad[seen // BUCKETS + at]] % BUCKETS, minlength=BUCKETS)
            thrice = [x[in_several(text, x, words)] + text[in_several(text, x, words)].astype(np.int64) * BUCKETS for x in stems.T]
            for row, cells in enumerate((np.unique(seen), np.unique(np.concatenate(thrice)))):
                whose, bucket = cells // BUCKETS + at, cells % BUCKETS
                a[row] += np.bincount(bucket[bad[whose]], minlength=BUCKETS)
                b[row] += np.bincount(bucket[good[whose]], minlength=BUCKETS)
            at += len(offsets) - 1
        na, nb = max(1, bad.sum()), max(1, good.sum())
        w = np.log((a + 0.5) / (na + 1)) - np.log((b + 0.5) / (nb + 1))
        # Only what is nearly never in clean documents speaks: seen in several toxic ones, and far above chance.
        sure = (a >= 2) & (a / na > 100 * (b + 0.02) / nb)
        sure[0] &= sightings >= np.maximum(3, 0.01 * na)
        return np.where(sure, w, 0).astype(np.float32)

    def toxic_evidence(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """The three strongest marks together: long texts don't gather weak ones."""
        words, buckets, stems, first = marks(data, offsets)
        w = self.toxic_weights[0][buckets].max(1) if len(buckets) else np.zeros(0, np.float32)
        for x in stems.T:
            v = self.toxic_weights[1][x]
            at = np.flatnonzero(v > w)
            at = at[in_several(np.searchsorted(first, at, "right") - 1, x[at], words[at])]
            w[at] = v[at]
        out = np.zeros(len(offsets) - 1)
        at = np.flatnonzero(w > 0)
        text = np.searchsorted(first, at, "right") - 1
        for t in np.unique(text):
            out[t] = np.sort(w[at[text == t]])[-3:].sum()
        return out

    def score(self, array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Log-odds of good quality and of toxicity."""
        data, offsets = text_bytes(array)
        good = np.clip(((shape(data, offsets) - self.mean) / self.scale) @ self.weights, -12, 12)
        good[np.diff(offsets) == 0] = -12
        bad = np.clip(self.toxic_line[0] + self.toxic_line[1] * self.toxic_evidence(data, offsets), -12, 12)
        return good, bad


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.05, rounds: int = 30) -> np.ndarray:
    """Weights by Newton's method."""
    w = np.zeros(x.shape[1])
    if not len(y):
        return w
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w)) * len(y) ** 0.5
        step = np.linalg.solve(h, x.T @ (p - y) + ridge * len(y) ** 0.5 * w)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """The text classifier, from at most about TRAIN_ROWS labelled documents taken by a hash of their id."""
    named = labels.select(F.col("doc_id").cast("long").alias("doc_id"), "quality", "toxic").where("doc_id IS NOT NULL AND (quality IS NOT NULL OR toxic IS NOT NULL)")
    n = named.count()
    chosen = named.where(F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(1 << 30)) < int(min(1.0, 0.95 * TRAIN_ROWS / max(1, n)) * (1 << 30))).limit(TRAIN_ROWS)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where(F.octet_length("text") <= TRAIN_BYTES).join(F.broadcast(chosen), "doc_id").limit(2 * TRAIN_ROWS).collect()
    rows.sort(key=lambda r: (r["doc_id"], r["text"]))
    number = lambda c: np.array([np.nan if r[c] is None else float(r[c]) for r in rows])
    return Model([r["text"] for r in rows], number("quality"), number("toxic"))


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, source, good and toxic (log-odds) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch):
                good, bad = model.score(column(part, "text"))
                yield pa.RecordBatch.from_arrays([column(part, "doc_id"), column(part, "source"), column(part, "mark"), pa.array(good), pa.array(bad)], ["doc_id", "source", "mark", "good", "bad"])

    small_batches(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("source"), "text").withColumn("mark", F.xxhash64("text"))
    return rows.mapInArrow(run, "doc_id long, source string, mark long, good double, bad double")


def without_scheme(source: Column) -> Column:
    return F.regexp_replace(source, r"^([A-Za-z][A-Za-z0-9+.\-]*:)?//", "")


def host_of(source: Column) -> Column:
    return F.substring_index(without_scheme(source), "/", 1)


def path_of(source: Column) -> Column:
    """The host and the first step of the path."""
    return F.substring_index(without_scheme(source), "/", 2)


def probability(log_odds: str) -> Column:
    return 1 / (1 + F.exp(-F.col(log_odds)))


def with_evidence(scores: DataFrame, labels: DataFrame) -> DataFrame:
    """scores with path, host, and what the document itself says of its site: w (weight), g and b (weighted good and toxic).

    A label stands for itself, an unlabelled document for its classifier's probability with a quarter of a label's weight.
    """
    named = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("double").alias("q"), F.col("toxic").cast("double").alias("t")).where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.avg("q").alias("q"), F.avg("t").alias("t"))
    # Rows without an id are in no join: they would all meet in one task.
    known = scores.where("doc_id IS NOT NULL").join(named, "doc_id", "left")
    rows = known.unionByName(scores.where("doc_id IS NULL").withColumns({"q": F.lit(None).cast("double"), "t": F.lit(None).cast("double")}))
    w = F.when(F.col("q").isNotNull() | F.col("t").isNotNull(), 1.0).otherwise(0.25)
    site = {"path": path_of(F.col("source")), "host": host_of(F.col("source"))}
    return rows.withColumns(site | {"w": w, "g": w * F.coalesce("q", probability("good")), "b": w * F.coalesce("t", probability("bad"))}).drop("q", "t")


class Sites:
    """The tree of sites: sums of evidence by path (with those of the rest of its host), the global rates and each level's prior weight."""

    def __init__(self, rows: DataFrame):
        sums = lambda: [F.sum(c).alias(c) for c in "wgbn"]
        paths = stage(rows.withColumn("n", F.lit(1)).groupBy("host", "path").agg(*sums()), "quality-paths")
        hosts = stage(paths.groupBy("host").agg(*sums()), "quality-hosts")
        rest = [(F.col(f"all_{c}") - F.col(c)).alias(f"rest_{c}") for c in "wgb"]
        table = paths.join(hosts.select("host", *[F.col(c).alias(f"all_{c}") for c in "wgb"]), "host").select("path", "n", *"wgb", *rest)
        self.table = stage(table, "quality-sites")
        one = hosts.agg(*[F.sum(c).alias(c) for c in "wgb"]).first()
        self.rate, self.weight = {}, {}
        for c in "gb":
            self.rate[c] = min(1 - 1e-4, max(1e-4, (one[c] or 0) / max(1e-9, one["w"] or 0)))
            host = self.spread(hosts, F.col("w"), F.col(c), F.lit(self.rate[c]), self.rate[c])
            above = (F.col(f"rest_{c}") + self.rate[c] * host) / (F.col("rest_w") + host)
            self.weight[c] = (host, self.spread(self.table, F.col("w"), F.col(c), above, self.rate[c]))
        discard(paths, hosts)

    @staticmethod
    def spread(sites: DataFrame, w: Column, c: Column, above: Column, m: float) -> float:
        """The prior's weight m (1 - m) / spread - 1; the spread is that of the sites' rates around the level above, beyond what chance gives."""
        row = sites.where(w > 0).agg(F.sum(w * F.pow(c / w - above, 2)).alias("s"), F.count("*").alias("k"), F.sum(w).alias("w")).first()
        spread = max(1e-6, ((row["s"] or 0) - m * (1 - m) * row["k"]) / max(1e-9, row["w"] or 0))
        return min(1e4, max(10.0, m * (1 - m) / spread - 1))

    def shift(self, c: str) -> Column:
        """What a document's site adds to its log-odds against the global rate. The row has own_w, own_g, own_b beside the site's sums."""
        m, (host, path) = self.rate[c], self.weight[c]
        above = (F.col(f"rest_{c}") + m * host) / (F.col("rest_w") + host)
        w, x = F.greatest(F.lit(0.0), F.col("w") - F.col("own_w")), F.greatest(F.lit(0.0), F.col(c) - F.col(f"own_{c}"))
        p = F.least(F.lit(1 - 1e-4), F.greatest(F.lit(1e-4), (x + above * path) / (w + path)))
        return F.log(p / (1 - p)) - math.log(m / (1 - m))


def with_sites(rows: DataFrame, sites: Sites) -> DataFrame:
    """rows (of with_evidence()) with good_shift and bad_shift."""
    rows = rows.withColumnsRenamed({c: f"own_{c}" for c in "wgb"})
    if sites.table.count() <= BROADCAST_SITES:
        joined = rows.join(F.broadcast(sites.table), "path")
    else:
        joined = skew_join(rows, sites.table, ["path"], "n", F.xxhash64("doc_id", "mark"), "inner")
    return joined.withColumns({"good_shift": sites.shift("g"), "bad_shift": sites.shift("b")})


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row a document: doc_id, p_good, p_toxic, kept (and mark, the hash of its text)."""
    scores = stage(scored(docs, fit(docs, labels)), "quality-scores")  # written first: each text is scored once
    rows = stage(with_evidence(scores, labels), "quality-evidence")
    discard(scores)
    rows = with_sites(rows, Sites(rows)).withColumns({"good": F.col("good") + F.col("good_shift"), "bad": F.col("bad") + F.col("bad_shift")})
    return rows.select("doc_id", probability("good").alias("p_good"), probability("bad").alias("p_toxic"), "mark").withColumn("kept", (F.col("p_good") >= 0.5) & (F.col("p_toxic") < 0.5))


def filter_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that are kept."""
    gone = quality(docs, labels).where(~F.col("kept")).select("doc_id", "mark").distinct()
    return without(docs, gone, doc_id=F.col("doc_id").cast("long"), mark=F.xxhash64("text"))
