"""Benchmark decontamination by SimHash fingerprints of item-sized windows.

An item is the sequence of its five-word shingles. Every window of a document with as many shingles as some item has gets a 64-bit SimHash of its
different shingles (each counts once, so a word repeated many times can't drown the rest). The fingerprint is cut into eight blocks of
eight bits: two that differ in at most RADIUS = 23 bits differ in at most two bits in some block, so looking up each block under all values within two flips finds every
item of that size within the radius. Pairs of a document and an item found this way are verified by the exact weighted Jaccard similarity of the
shingle counts, over all windows of the pair.

Windows that hold too few shingles of any item to reach the similarity get no fingerprint: a bitmap over all items' shingles bounds
each window's share from above, so this loses nothing. What can be lost are windows of similarity 0.75 or more outside the radius; the README gives the measured recall.

Nulls: a null text or item is empty; an item without words is left out. Items of fewer than five words are one shingle, their whole sequence: they match
documents that are that sequence, not longer ones. A document shorter than an item is one window. Empty tables: no rows. Ties: the first of the best windows is
reported. Repeated rows: each has its row. Very long texts: windows are worked on in blocks of bounded size. Clashing names: extra columns of any name are kept as they are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import as_rows, column, without
from .textkernel import U, chunks, text_shingles

SIMILARITY = 0.75
RADIUS = 23
BLOCKS, FLIPS = 8, 2
#: Bytes of benchmark text that one index may hold (about 40 bytes of index for each byte); larger benchmarks are handled in as many passes as needed.
INDEX_BYTES = 8 << 20
#: Windows that are fingerprinted at once: 64 numbers each.
WINDOWS = 1 << 14
_BITS = np.arange(64, dtype=np.uint64)


def bit_signs(h: np.ndarray) -> np.ndarray:
    """For each shingle, +1 or -1 by bit of its hash."""
    return ((h[:, None] >> _BITS) & U(1)).astype(np.int32) * 2 - 1


def fingerprint(sums: np.ndarray) -> np.ndarray:
    """The SimHash of rows of bit sums."""
    return ((sums > 0).astype(np.uint64) << _BITS).sum(-1, dtype=np.uint64)


class WindowPrints:
    """SimHashes of the different shingles of windows of a text, from running sums of the shingles' bits."""

    def __init__(self, h: np.ndarray):
        signs = bit_signs(h)
        self.sums = np.concatenate([np.zeros((1, 64), np.int32), np.cumsum(signs, 0, dtype=np.int32)])
        order = np.argsort(h, kind="stable")
        same = h[order][1:] == h[order][:-1]
        self.again, self.last = order[1:][same], order[:-1][same]  # repeated shingles, and where each was last
        self.signs = signs[self.again]

    def at(self, starts: np.ndarray, size: int) -> np.ndarray:
        sums = self.sums[starts + size] - self.sums[starts]
        # A repeated shingle counts once: it is taken out of the windows that hold its last occurrence too.
        near = np.flatnonzero(self.again - self.last < size)
        if len(near):
            n = len(self.sums) - size
            steps = np.zeros((n + 1, 64), np.int32)
            begins, ends = np.maximum(0, self.again[near] - size + 1), np.minimum(self.last[near], n - 1) + 1
            some = begins < ends
            np.add.at(steps, begins[some], self.signs[near][some])
            np.subtract.at(steps, ends[some], self.signs[near][some])
            sums -= np.cumsum(steps, 0)[starts]
        return fingerprint(sums)


class ItemIndex:
    def __init__(self, item_ids: list[int | None], texts: list[str | None]):
        h, bounds = text_shingles(pa.array(texts, pa.string()))
        self.items: list[tuple[int | None, np.ndarray, np.ndarray]] = []  # id, distinct shingles, their counts
        for k, item_id in enumerate(item_ids):
            if bounds[k + 1] > bounds[k]:
                self.items.append((item_id, *np.unique(h[bounds[k] : bounds[k + 1]], return_counts=True)))
        self.sizes = np.array([n.sum() for _, _, n in self.items], np.int64)
        self.prints = np.array([fingerprint(bit_signs(s).sum(0)) for _, s, _ in self.items], np.uint64)
        every = np.concatenate([s for _, s, _ in self.items]) if self.items else np.zeros(0, np.uint64)
        self.filter = np.zeros(1 << 22, bool)
        self.filter[(every >> U(42)).astype(np.int64)] = True
        #: By size: its items, and for each block and value the items whose block is within two flips of the value.
        self.of_size = {int(n): self.blocks(np.flatnonzero(self.sizes == n)) for n in np.unique(self.sizes)}

    def blocks(self, items: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        values = [(self.prints[items] >> U(8 * b)).astype(np.uint8) for b in range(BLOCKS)]
        return items, [np.bitwise_count(np.arange(256, dtype=np.uint8)[:, None] ^ v) <= FLIPS for v in values]

    def candidates(self, prints: np.ndarray, size: int) -> np.ndarray:
        """Pairs (window, item) within the radius, of items of that many shingles."""
        items, near = self.of_size.get(size, (np.zeros(0, np.int64), []))
        found, step = [np.zeros((0, 2), np.int64)], max(1, (1 << 22) // max(1, len(items)))
        for at in range(0, len(prints) if len(items) else 0, step):
            part = prints[at : at + step]
            maybe = near[0][(part & U(255)).astype(np.uint8)]
            for b in range(1, BLOCKS):
                maybe = maybe | near[b][((part >> U(8 * b)) & U(255)).astype(np.uint8)]
            w, i = np.nonzero(maybe)
            close = np.bitwise_count(part[w] ^ self.prints[items[i]]) <= RADIUS
            found.append(np.stack([at + w[close], items[i[close]]], 1))
        return np.concatenate(found)

    def near_items(self, h: np.ndarray) -> list[int]:
        """The items within the radius of some window of a text's shingles that can reach SIMILARITY."""
        hits = np.concatenate([[0], np.cumsum(self.filter[(h >> U(42)).astype(np.int64)])])
        windows = []
        for size in self.of_size:
            length = min(size, len(h))
            starts = np.flatnonzero(hits[length:] - hits[:-length] >= SIMILARITY * size)
            if len(starts):
                windows.append((size, length, starts))
        if not windows:
            return []
        found: set[int] = set()
        every, longest = np.unique(np.concatenate([s for *_, s in windows])), max(n for _, n, _ in windows)
        at = 0
        while at < len(every):  # neighbouring windows together, a bounded number of them at once
            low = int(every[at])
            to = int(np.searchsorted(every, low + WINDOWS))
            apart = np.flatnonzero(np.diff(every[at:to]) > longest)
            to = at + int(apart[0]) + 1 if len(apart) else to
            prints = WindowPrints(h[low : int(every[to - 1]) + longest])
            for size, length, starts in windows:
                own = starts[np.searchsorted(starts, low) : np.searchsorted(starts, every[to - 1], "right")] - low
                if len(own):
                    found.update(self.candidates(np.unique(prints.at(own, length)), size)[:, 1].tolist())
            at = to
        return sorted(found)

    def matches(self, h: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[int, int, float, int]]:
        """(text, item, similarity, first word) of the best window for every text and item that reach SIMILARITY."""
        if not len(self.items):
            return
        hits = np.concatenate([[0], np.cumsum(self.filter[(h >> U(42)).astype(np.int64)])])[bounds]
        for text in np.flatnonzero(np.diff(hits) >= SIMILARITY * self.sizes.min()).tolist():
            own = h[bounds[text] : bounds[text + 1]]
            for item in self.near_items(own):
                best = self.best(own, item)
                if best is not None:
                    yield text, item, *best

    def best(self, h: np.ndarray, item: int) -> tuple[float, int] | None:
        """Similarity and start of the first best of all windows of a text, if it reaches SIMILARITY. Every window is compared exactly.

        A hit counts in a window that holds it, unless the window also holds as many hits of the same shingle before it as the item has
        in all. So each counts for the starts of one range, and the windows' shares are sums of ranges; they are largest where a range begins.
        """
        _, shingles, counts = self.items[item]
        size = int(self.sizes[item])
        length = min(size, len(h))
        which = np.searchsorted(shingles, h)
        place = np.flatnonzero(shingles[np.minimum(which, len(shingles) - 1)] == h)
        which = which[place]
        order = np.argsort(which, kind="stable")
        which, place = which[order], place[order]
        back = np.arange(len(place)) - counts[which]
        full, back = back >= 0, np.maximum(back, 0)
        full &= which[back] == which
        begins = np.maximum(np.maximum(place - length, np.where(full, place[back], -1)) + 1, 0)
        ends = np.minimum(place, len(h) - length)
        some = begins <= ends
        if not some.any():
            return None
        starts = np.unique(begins[some])
        both = np.searchsorted(np.sort(begins[some]), starts, "right") - np.searchsorted(np.sort(ends[some]), starts, "left")
        k = int(both.argmax())
        s = float(both[k] / (length + size - both[k]))
        return (s, int(starts[k])) if s >= SIMILARITY else None

    def similarity(self, window: np.ndarray, item: int) -> float:
        _, shingles, counts = self.items[item]
        own, n = np.unique(window, return_counts=True)
        _, i, j = np.intersect1d(own, shingles, assume_unique=True, return_indices=True)
        both = np.minimum(n[i], counts[j]).sum()
        return float(both / (n.sum() + counts.sum() - both))


def item_blocks(benchmark: DataFrame) -> Iterator[list]:
    """The benchmark's (item_id, text) in blocks of at most INDEX_BYTES of text (one item at least)."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.coalesce("text", F.lit("")).alias("text"))
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    passes = 1 + total // (INDEX_BYTES // 2)
    for k in range(passes):
        block = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(passes)) == k).collect()
        if block:
            yield sorted(block, key=lambda r: (r[0] is None, r[0], r[1]))


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for every document and item it holds: doc_id, item_id, similarity, first_word, text_hash."""
    rows = as_rows(docs, id_col, text_col)
    schema = "doc_id long, item_id long, similarity double, first_word long, text_hash long"
    out = None
    for block in item_blocks(benchmark):
        index = ItemIndex([r[0] for r in block], [r[1] for r in block])

        def run(batches: Iterator[pa.RecordBatch], index: ItemIndex = index) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part in chunks(batch):
                    found = list(index.matches(*text_shingles(column(part, "text"))))
                    if found:
                        ids, marks = column(part, "doc_id").to_pylist(), column(part, "mark").to_pylist()
                        yield pa.RecordBatch.from_arrays([pa.array([ids[t] for t, *_ in found], pa.int64()), pa.array([index.items[i][0] for _, i, _, _ in found], pa.int64()), pa.array([s for _, _, s, _ in found], pa.float64()), pa.array([w for *_, w in found], pa.int64()), pa.array([marks[t] for t, *_ in found], pa.int64())], ["doc_id", "item_id", "similarity", "first_word", "text_hash"])

        found = rows.withColumn("mark", F.xxhash64("text")).mapInArrow(run, schema)
        out = found if out is None else out.unionByName(found)
    return docs.sparkSession.createDataFrame([], schema) if out is None else out


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs without the documents that hold a benchmark item."""
    gone = contaminated(docs, benchmark, id_col, text_col).select("doc_id", "text_hash").distinct()
    return without(docs, gone, doc_id=F.col(f"`{id_col}`").cast("long"), text_hash=F.xxhash64(f"`{text_col}`"))


ORACLE = rf"""
WITH texts AS (SELECT true AS is_item, row_number() OVER () AS r, item_id AS id, text FROM benchmark UNION ALL SELECT false, row_number() OVER (), doc_id, text FROM documents),
words AS (SELECT is_item, r, id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM texts),
lists AS (SELECT is_item, r, id, CASE WHEN len(w) < 5 THEN [array_to_string(w, ' ')] ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END AS l FROM words WHERE len(w) > 0),
places AS (SELECT is_item, r, unnest(l) AS shingle, unnest(range(0, len(l))) AS pos FROM lists),
items AS (SELECT r AS item, shingle, count(*) AS wanted FROM places WHERE is_item GROUP BY 1, 2),
docs AS (SELECT r, shingle, pos FROM places WHERE NOT is_item),
pairs AS (SELECT DISTINCT item, r FROM items JOIN docs USING (shingle)),
bounded AS (SELECT item, p.r, len(i.l) AS size, least(len(i.l), len(d.l)) AS length, len(d.l) AS n, i.id AS item_id, d.id AS doc_id FROM pairs p JOIN lists i ON i.is_item AND i.r = p.item JOIN lists d ON NOT d.is_item AND d.r = p.r),
windows AS (SELECT *, unnest(range(0, n - length + 1)) AS first_word FROM bounded),
held AS (
  SELECT w.item, w.r, first_word, any_value(size + length) AS total, any_value(item_id) AS item_id, any_value(doc_id) AS doc_id, least(count(*), any_value(wanted)) AS n
  FROM windows w JOIN docs d ON d.r = w.r AND d.pos BETWEEN first_word AND first_word + length - 1 JOIN items i ON i.item = w.item AND i.shingle = d.shingle GROUP BY w.item, w.r, first_word, d.shingle),
alike AS (SELECT item, r, first_word, any_value(item_id) AS item_id, any_value(doc_id) AS doc_id, sum(n) / (any_value(total) - sum(n)) AS similarity FROM held GROUP BY item, r, first_word)
SELECT doc_id, item_id, similarity, first_word FROM (SELECT *, row_number() OVER (PARTITION BY item, r ORDER BY similarity DESC, first_word) AS k FROM alike WHERE similarity >= {SIMILARITY}) WHERE k = 1
"""
