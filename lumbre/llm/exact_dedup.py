"""Exact dedup by an extendible-hash index on shared files.

Each input task folds its own rows first (one entry for each different text it has read), so a group of copies sends at most one entry a
task and FOLD_BYTES. A directory over the leading bits of the 64-bit hashes is doubled until no bucket holds more than `capacity` different hashes: its
first DEPTH levels are a table of fixed size on the driver, and the levels below are split by the owner of a bucket, as deep as the hashes go.
Owner tasks process ranges of keys: neighbouring buckets with about the same number of bytes together. An owner chains the entries of one hash, compares bytes,
and holds the entries of no more than one bucket. The chains are written to the shared folder as the index, bucket by bucket, that rows then look up.

Nulls: a null text counts as empty; a null id is less than any other. Repeated rows (same id, same text) are one document: both stay or go.
Very long texts: a task holds one beyond FOLD_BYTES. Clashing names: extra columns of any name are kept as they are. Empty table: no rows. Ties: the largest id stays.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import as_rows, column, partitions, skew_join, stage, without
from .textkernel import chunks

#: Levels of the directory that are a table on the driver, of 2**DEPTH numbers whatever the input.
DEPTH = 16
#: Bytes of memory that the texts may take which a task keeps while it folds copies; beyond, it emits what it has and starts anew.
FOLD_BYTES = 16 << 20


def directory(counts: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """The bucket of each of 2**depth prefixes, and the local depth of each bucket. counts: hashes by prefix of DEPTH bits.

    Starts with one bucket and doubles while some bucket is overfull; only overfull buckets are split.
    """
    depth, local, bucket = 0, [0], np.zeros(1, np.int64)
    most = len(counts).bit_length() - 1
    load = lambda: np.bincount(np.repeat(bucket, len(counts) >> depth), counts, len(local))
    while True:
        full = [b for b, n in enumerate(load()) if n > capacity and local[b] < most]
        if not full:
            return bucket, np.array(local)
        if any(local[b] == depth for b in full):
            depth, bucket = depth + 1, np.repeat(bucket, 2)
        for b in full:
            if local[b] < depth:
                at = np.flatnonzero(bucket == b)
                local[b] += 1
                local.append(local[b])
                bucket[at[len(at) // 2 :]] = len(local) - 1


def owners(bucket: np.ndarray, load: np.ndarray, tasks: int) -> np.ndarray:
    """The owner of each prefix: ranges of whole neighbouring buckets with about equal load. load: by prefix of DEPTH bits."""
    by_entry = load.reshape(len(bucket), -1).sum(1)
    first = np.flatnonzero(np.diff(bucket, prepend=-1))  # a bucket's prefixes are neighbours
    before = np.cumsum(np.add.reduceat(by_entry, first)) - np.add.reduceat(by_entry, first) / 2
    owner = np.minimum(tasks - 1, (before * tasks / max(1.0, float(by_entry.sum()))).astype(np.int64))
    return np.repeat(np.repeat(owner, np.diff(np.append(first, len(bucket)))), len(load) // len(bucket))


def fold(batches: Iterator[pa.RecordBatch], owner: np.ndarray) -> Iterator[pa.RecordBatch]:
    """(owner, h, text, top_id, n) for each different text of a task."""

    def out(seen: dict) -> Iterator[pa.RecordBatch]:
        items = list(seen.items())
        for i in range(0, len(items), 1000):
            part = items[i : i + 1000]
            h = np.array([v[0] for _, v in part], np.int64)
            whose = owner[(h.view(np.uint64) >> np.uint64(64 - DEPTH)).astype(np.int64)]
            yield pa.RecordBatch.from_arrays([pa.array(whose), pa.array(h), pa.array([k for k, _ in part], pa.string()), pa.array([v[1] for _, v in part], pa.int64()), pa.array([v[2] for _, v in part], pa.int64())], ["owner", "h", "text", "top_id", "n"])

    seen: dict[str, list] = {}
    held = 0
    for batch in batches:
        for part in chunks(batch):
            for doc_id, h, text in zip(column(part, "doc_id").to_pylist(), column(part, "h").to_pylist(), column(part, "text").to_pylist(), strict=True):
                if (entry := seen.get(text)) is None:
                    seen[text] = [h, doc_id, 1]
                    held += sys.getsizeof(text) + 300
                else:
                    entry[2] += 1
                    if doc_id is not None and (entry[1] is None or doc_id > entry[1]):
                        entry[1] = doc_id
            if held > FOLD_BYTES:
                yield from out(seen)
                seen, held = {}, 0
    yield from out(seen)


class Buckets:
    """The extendible hash below the driver's table, for entries that come in ascending order of their (unsigned) hash.

    A bucket covers the hashes with one prefix of `depth` bits. It is split in two when it is overfull, as often as needed; as entries
    ascend, a half that lies below the newest hash is complete and is given out, so no more than one bucket is ever held.
    """

    def __init__(self, capacity: int, depth_of):
        self.capacity, self.depth_of = capacity, depth_of
        self.low, self.depth, self.open = 0, -1, []  # of the bucket that is being filled; ends of the halves above it
        self.held: list[tuple] = []

    def add(self, h: int, entries: list[tuple]) -> Iterator[tuple]:
        """The finished entries, each with its bucket's prefix and depth, once those of a later hash have come."""
        if self.depth < 0 or (h ^ self.low) >> (64 - self.depth):
            yield from self.close()
            self.depth = self.depth_of(h)
            self.low = h >> (64 - self.depth) << (64 - self.depth)
        self.held += [(h, *e) for e in entries]
        while len(self.held) > self.capacity and self.depth < 64 and self.held[0][0] != self.held[-1][0]:
            self.depth += 1
            middle = self.low + (1 << (64 - self.depth))
            if h >= middle:  # the lower half is complete
                above = [e for e in self.held if e[0] >= middle]
                yield from ((*e, self.low >> (64 - self.depth), self.depth) for e in self.held if e[0] < middle)
                self.held, self.low = above, middle

    def close(self) -> Iterator[tuple]:
        if self.held:
            yield from ((*e, self.low >> (64 - self.depth) if self.depth else 0, self.depth) for e in self.held)
        self.held = []


def chain(batches: Iterator[pa.RecordBatch], capacity: int, depths: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The index rows of an owner, from its entries sorted by unsigned hash; different texts of one hash are links of its chain."""
    links: dict[str, list] = {}
    now: int | None = None
    done: list[tuple] = []
    buckets = Buckets(capacity, lambda h: int(depths[h >> (64 - DEPTH)]))
    signed = lambda x: x - (1 << 64) if x >= 1 << 63 else x

    def out() -> Iterator[pa.RecordBatch]:
        for i in range(0, len(done), 5000):
            h, link, sha, top, n, prefix, depth = zip(*done[i : i + 5000], strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(map(signed, h), pa.int64()), pa.array(link, pa.int32()), pa.array(sha, pa.string()), pa.array(top, pa.int64()), pa.array(n, pa.int64()), pa.array(map(signed, prefix), pa.int64()), pa.array(depth, pa.int32())], ["h", "link", "text_sha256", "keep_id", "group_size", "bucket", "depth"])
        done.clear()

    def close() -> None:
        if links:  # a dict of texts compares their bytes
            done.extend(buckets.add(now % (1 << 64), [(k, hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest(), top, n) for k, (text, (top, n)) in enumerate(links.items())]))
        links.clear()

    for batch in batches:
        for part in chunks(batch):
            for h, text, top, n in zip(*(column(part, c).to_pylist() for c in ("h", "text", "top_id", "n")), strict=True):
                if h != now:
                    close()
                    now = h
                if (link := links.get(text)) is None:
                    links[text] = [top, n]
                else:
                    link[1] += n
                    if top is not None and (link[0] is None or top > link[0]):
                        link[0] = top
        if len(done) >= 5000:
            yield from out()
    close()
    done.extend(buckets.close())
    yield from out()


def hashed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return as_rows(docs, id_col, text_col).select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("h", F.xxhash64("text"))


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = 4000) -> DataFrame:
    """The index of all texts: (h, link, text_sha256, keep_id, group_size, bucket, depth), one row for each different text."""
    rows = hashed(docs, id_col, text_col)
    n_tasks = partitions(docs.sparkSession)
    prefix = F.shiftrightunsigned("h", 64 - DEPTH)
    counts, load = np.zeros(1 << DEPTH), np.zeros(1 << DEPTH)
    kinds = rows.groupBy("h").agg(F.max(F.octet_length("text")).alias("size"))
    for p, n, size in kinds.groupBy(prefix.alias("p")).agg(F.count("*"), F.sum("size")).collect():  # at most 2**DEPTH rows
        counts[p], load[p] = n, size + 100 * n
    bucket, local = directory(counts, capacity)
    owner = owners(bucket, load, n_tasks)
    depths = np.repeat(local[bucket], len(counts) // len(bucket)).astype(np.int8)
    entries = rows.mapInArrow(lambda b: fold(b, owner), "owner long, h long, text string, top_id long, n long")
    unsigned = F.col("h").bitwiseXOR(F.lit(-(1 << 63)))
    owned = entries.repartitionById(n_tasks, F.col("owner").cast("int")).sortWithinPartitions(unsigned)
    return stage(owned.mapInArrow(lambda b: chain(b, capacity, depths), "h long, link int, text_sha256 string, keep_id long, group_size long, bucket long, depth int"), "exact-index")


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = 4000) -> DataFrame:
    """One row a document: doc_id, keep_id, group_size, kept, text_sha256."""
    index = build_index(docs, id_col, text_col, capacity)
    rows = hashed(docs, id_col, text_col).select("doc_id", "h", F.sha2("text", 256).alias("text_sha256"))
    found = skew_join(rows, index.select("h", "text_sha256", "keep_id", "group_size"), ["h", "text_sha256"], "group_size", F.xxhash64("doc_id"))
    return found.select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = 4000) -> DataFrame:
    """The rows of docs that stay, with all their columns."""
    gone = exact_groups(docs, id_col, text_col, capacity).where(~F.col("kept"))
    return without(docs, gone, doc_id=F.col(f"`{id_col}`").cast("long"), text_sha256=F.sha2(F.coalesce(F.col(f"`{text_col}`"), F.lit("")), 256))


ORACLE = """
WITH d AS (SELECT doc_id, sha256(coalesce(text, '')) AS text_sha256 FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, text_sha256
FROM d WINDOW w AS (PARTITION BY text_sha256)
"""
