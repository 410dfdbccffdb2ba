"""Near-duplicate grouping with SuperMinHash signatures.

SuperMinHash gives each shingle a random permutation of the SLOTS places of the signature and counts upwards through it: at
level j it offers j plus a random fraction to its j-th place. A place keeps the least offer. Levels run side by side for all shingles of a batch and
stop for a text once every place has an offer below the next level, which for long texts is after one or two levels.

Signatures are cut into BANDS bands of ROWS places; texts that share a band are candidates. Two texts of similarity 0.75 share none of the
32 bands of four with a probability of 5e-6. Candidates are confirmed on their full sets of 64-bit shingle hashes, links are grouped by union-find.

No group is expanded into pairs. Equal sets are one representative. In each band's bucket the least representative is compared with
every other one. Buckets that are then still in several components are looked at again, in tiles of bounded size: pairs of different components whose
signatures agree in at least ESTIMATE of the places (four and a half standard deviations below 0.75) are confirmed, first the
two best of each text and, once these have united what they can, all that remain. So every candidate link between different texts is
either confirmed, refuted, or known to be inside one component.

Nulls: a null id has component null, is kept and linked with nothing; a null or blank text has no shingle and is linked with nothing. Repeated rows of an id
are one document; where its rows have different texts, each row is in the component of its own text if that is a copy of another id's, and else links come from the
text with the least hash. Empty table: no rows. Ties: the least id stands for its component. Very long texts are hashed in pieces. Clashing names: extra columns of any name
are kept as they are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import as_rows, column, components, discard, partitions, skew_join, stage, without
from .textkernel import U, chunks, mix, text_shingles

BANDS, ROWS = 32, 4
SLOTS = BANDS * ROWS
#: Links have 100 * intersection >= PERCENT * union.
PERCENT = 75
ESTIMATE = 0.58
#: Representatives, and shingles of theirs, that a tile of a bucket has about; a task holds two tiles at once.
TILE, TILE_SHINGLES = 1024, 1_000_000
#: Shingles that permutations are drawn for at once: SLOTS bytes each.
BLOCK = 1 << 16


def superminhash(h: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Signatures (one row of SLOTS numbers a text) of texts whose distinct shingle hashes are h[bounds[i]:bounds[i + 1]]."""
    n = len(bounds) - 1
    sig = np.full(n * SLOTS, np.iinfo(np.uint32).max, np.uint32)
    text = np.repeat(np.arange(n), np.diff(bounds))
    offer = lambda level, r: np.uint32(level << 24) | (r >> U(40)).astype(np.uint32)  # noqa: E731  a fraction of 24 bits
    r = mix(h ^ U(0x243F6A8885A308D3))
    np.minimum.at(sig, text * SLOTS + (r % U(SLOTS)).astype(np.int64), offer(0, r))
    full = sig.reshape(n, SLOTS).max(1) < 1 << 24
    open_shingles = np.flatnonzero(~full[text])
    # Texts that still have free places are taken in blocks of whole texts.
    starts = 0
    while starts < len(open_shingles):
        to = min(len(open_shingles), starts + BLOCK)
        if to < len(open_shingles):
            last = text[open_shingles[to]]
            to = max(int(np.searchsorted(text[open_shingles], last)), starts + 1)
            if to <= starts + 1:
                to = int(np.searchsorted(text[open_shingles], last, "right"))
        at = open_shingles[starts:to]
        places = np.tile(np.arange(SLOTS, dtype=np.uint8), (len(at), 1))
        rows = np.arange(len(at))
        own, hh = text[at], h[at]
        k = (r[at] % U(SLOTS)).astype(np.int64)
        places[rows, k], places[:, 0] = places[:, 0].copy(), k
        for level in range(1, SLOTS):
            x = mix(hh + U(level * 0x9E3779B97F4A7C15 % 2**64))
            k = level + (x % U(SLOTS - level)).astype(np.int64)
            chosen = places[rows, k]
            places[rows, k] = places[rows, level]
            places[rows, level] = chosen
            np.minimum.at(sig, own * SLOTS + chosen, offer(level, x))
            whose = np.unique(own)
            done = whose[sig.reshape(n, SLOTS)[whose].max(1) < (level + 1) << 24]
            if len(done) == len(whose):
                break
            if len(done):
                stay = ~np.isin(own, done)
                places, own, hh = places[stay], own[stay], hh[stay]
                rows = np.arange(len(own))
        starts = to
    return sig.reshape(n, SLOTS)


def distinct(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each text, end to end, and their bounds."""
    h, bounds = text_shingles(array)
    sets = [np.unique(h[a:b]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    return np.concatenate([*sets, np.zeros(0, np.uint64)]), np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int64)


def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """doc_id, mark, n, f1 and f2 (128-bit hash of the set; null if it is empty), bands, sig (low 16 bits of the places)."""
    for batch in batches:
        for part in chunks(batch):
            h, bounds = distinct(column(part, "text"))
            n = np.diff(bounds)
            sig = superminhash(h, bounds)
            seeds = U(0x9E3779B97F4A7C15) * np.arange(1, BANDS + 1, dtype=np.uint64)
            bands = np.broadcast_to(seeds, (len(n), BANDS)).copy()
            for k in range(ROWS):
                bands = mix(bands + sig[:, k::ROWS].astype(np.uint64) * U(2 * k + 0x51ED2701))
            marks = [xxhash.xxh3_128_intdigest(h[a:b].tobytes()) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
            signed = lambda x: x - (1 << 64) if x >= 1 << 63 else x
            f1 = pa.array([signed(m >> 64) if k else None for m, k in zip(marks, n, strict=True)], pa.int64())
            f2 = pa.array([signed(m & (1 << 64) - 1) if k else None for m, k in zip(marks, n, strict=True)], pa.int64())
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, len(n) * BANDS + 1, BANDS), pa.int32()), pa.array(bands.view(np.int64).ravel()))
            low = pa.array([row.tobytes() for row in sig.astype(np.uint16)], pa.binary())
            yield pa.RecordBatch.from_arrays([column(part, "doc_id"), column(part, "mark"), pa.array(n, pa.int64()), f1, f2, lists, low], ["doc_id", "mark", "n", "f1", "f2", "bands", "sig"])


def shingle_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """rep and its set as sorted 64-bit numbers."""
    for batch in batches:
        for part in chunks(batch):
            h, bounds = distinct(column(part, "text"))
            sets = [h[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([column(part, "doc_id"), pa.array(sets, pa.binary())], ["rep", "shingles"])


def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links (a, b) among rows sorted so that each a's own set (other null) comes before the sets of its candidates; only a's set is held."""
    own, name = np.zeros(0, np.uint64), None
    for batch in batches:
        a_out, b_out = [], []
        for a, other, shingles in zip(*(column(batch, c) for c in ("a", "b", "shingles")), strict=True):
            s = np.frombuffer(shingles.as_buffer(), np.uint64)
            if not other.is_valid:
                own, name = s, a.as_py()
                continue
            if a.as_py() != name:
                raise ValueError(f"no set of {a}")
            if linked(s, own):
                a_out.append(name)
                b_out.append(other.as_py())
        if a_out:
            yield pa.RecordBatch.from_arrays([pa.array(a_out, pa.int64()), pa.array(b_out, pa.int64())], ["a", "b"])


def confirm(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The links among distinct pairs (a, b). Candidates of a frequent a are dealt out in salts of about 256."""
    n = partitions(pairs.sparkSession)
    counts = pairs.groupBy("a").agg(F.ceil(F.count("*") / 256).cast("int").alias("salts"))
    salted = stage(pairs.join(counts, "a").select("a", "b", F.pmod(F.xxhash64("b"), "salts").cast("int").alias("salt")), "near-pairs")
    theirs = salted.join(sets, salted["b"] == sets["rep"]).select("a", "salt", "b", "shingles")
    heads = salted.select("a", "salt").distinct()
    own = heads.join(sets, heads["a"] == sets["rep"]).select("a", "salt", F.lit(None).cast("long").alias("b"), "shingles")
    rows = own.unionByName(theirs).repartition(n, "a", "salt").sortWithinPartitions("a", "salt", F.col("b").asc_nulls_first())
    return rows.mapInArrow(compare, "a long, b long")


def unresolved(members: DataFrame, labels: DataFrame, reps: DataFrame) -> DataFrame:
    """Rows of the buckets that are in several components, dealt out in tiles: key, lo, hi, tile, pivot, rep, comp, n, bands, sig."""
    rows = members.join(labels, members["rep"] == labels["node"], "left").select("key", "pivot", "rep", "n", F.coalesce("component", "rep").alias("comp"))
    rows = stage(rows, "near-members")
    keys = rows.groupBy("key").agg(F.min("comp").alias("least"), F.max("comp").alias("most"), F.count("*").alias("size"), F.sum("n").alias("shingles")).where("least <> most").select("key", "size", "shingles")
    keys = stage(keys, "near-open")
    open_rows = skew_join(rows, keys, ["key"], "size", F.xxhash64("rep"), "inner")
    tiles = F.greatest(F.ceil(F.col("size") / TILE), F.ceil(F.col("shingles") / TILE_SHINGLES)).cast("int")
    open_rows = open_rows.withColumn("tile", F.pmod(F.xxhash64("rep", F.lit(1)), tiles).cast("int")).withColumn("with", F.explode(F.sequence(F.lit(0), tiles - 1)))
    open_rows = open_rows.select("key", F.least("tile", "with").alias("lo"), F.greatest("tile", "with").alias("hi"), "tile", "pivot", "rep", "comp")
    return open_rows.join(reps, "rep").select(*TILE_COLUMNS)


def candidates(rows: list[tuple], best: int) -> Iterator[tuple[int, int]]:
    """Places of candidate pairs of a tile pair: different components, this band the first that both share, estimate reached; the best few of each text, or (0) all."""
    key, lo, hi = rows[0][:3]
    tile = np.array([r[3] for r in rows])
    pivot, rep, comp, n = (np.array([r[k] for r in rows], np.int64) for k in (4, 5, 6, 7))
    bands = np.stack([r[8] for r in rows])
    sig = np.stack([np.frombuffer(r[9], np.uint16) for r in rows])
    here = (bands == key).argmax(1)
    names, sizes = np.unique(comp, return_counts=True)
    # Every pair has an end outside the largest component: only those are gone through.
    large = comp == names[sizes.argmax()]
    for u in np.flatnonzero(~large):
        v = np.flatnonzero((comp != comp[u]) & (large | (rep > rep[u])) & (100 * np.minimum(n, n[u]) >= PERCENT * np.maximum(n, n[u])))
        if lo != hi:
            v = v[tile[v] != tile[u]]
        v = v[(rep[v] != pivot[u]) & (rep[u] != pivot[v])]
        v = v[(bands[v] == bands[u]).argmax(1) == here[u]] if len(v) else v
        if not len(v):
            continue
        same = (sig[v] == sig[u]).sum(1)
        v, same = v[same >= ESTIMATE * SLOTS], same[same >= ESTIMATE * SLOTS]
        if best:
            v = v[np.argsort(-same, kind="stable")[:best]]
        for w in v:
            yield int(u), int(w)


def linked(s: np.ndarray, t: np.ndarray) -> bool:
    small, large = (s, t) if len(s) < len(t) else (t, s)
    if 100 * len(small) < PERCENT * len(large):
        return False
    at = np.searchsorted(large, small)
    both = int((large[np.minimum(at, len(large) - 1)] == small).sum())
    return 100 * both >= PERCENT * (len(s) + len(t) - both)


TILE_COLUMNS = ("key", "lo", "hi", "tile", "pivot", "rep", "comp", "n", "bands", "sig")


def cells(array: pa.Array) -> list:
    """The values of an array; lists as numpy arrays of their numbers."""
    if not pa.types.is_list(array.type):
        return array.to_pylist()
    flat, offsets = np.asarray(array.flatten()), np.concatenate([[0], np.cumsum(np.asarray(array.value_lengths()))])
    return [flat[a:b].copy() for a, b in zip(offsets[:-1], offsets[1:], strict=True)]


def per_tile(found, columns: tuple[str, ...], names: tuple[str, ...]):
    """A mapInArrow function over rows sorted by (key, lo, hi): calls found on the rows of each tile pair, which gives tuples of whole numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        done: list[tuple] = []

        def out() -> Iterator[pa.RecordBatch]:
            for i in range(0, len(done), 50_000):
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*done[i : i + 50_000], strict=True)], names)
            done.clear()

        def close() -> None:
            if len(held) > 1:
                done.extend(found(held))
            held.clear()

        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                part = batch.slice(i, 256)
                for row in zip(*[cells(column(part, c)) for c in columns], strict=True):
                    if held and held[0][:3] != row[:3]:
                        close()
                    held.append(row)
            if len(done) > 50_000:
                yield from out()
        close()
        yield from out()

    return run


def best_pairs(rows: list[tuple]) -> Iterator[tuple[int, int]]:
    for u, w in candidates(rows, best=2):
        yield min(rows[u][5], rows[w][5]), max(rows[u][5], rows[w][5])


def in_question(rows: list[tuple]) -> Iterator[tuple]:
    """The rows of a tile pair that any candidate pair needs."""
    for k in sorted({k for pair in candidates(rows, best=0) for k in pair}):
        yield (*rows[k][:3], rows[k][5])


def tile_links(rows: list[tuple]) -> Iterator[tuple[int, int]]:
    """Links between the components of a tile pair, found on the full sets (the last column); what is united already isn't compared again."""
    parent = {r[6]: r[6] for r in rows}

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    sets = [np.frombuffer(r[10], np.uint64) for r in rows]
    for u, w in candidates(rows, best=0):
        x, y = find(rows[u][6]), find(rows[w][6])
        if x != y and linked(sets[u], sets[w]):
            parent[x] = y
            yield min(rows[u][5], rows[w][5]), max(rows[u][5], rows[w][5])


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a document: doc_id, n_shingles, component_id, kept."""
    rows = as_rows(docs, id_col, text_col).withColumn("mark", F.xxhash64("text"))
    n_tasks = partitions(docs.sparkSession)
    sketches = stage(rows.mapInArrow(sketch, "doc_id long, mark long, n long, f1 long, f2 long, bands array<long>, sig binary"), "near-sketches")
    known = sketches.where("doc_id IS NOT NULL AND f1 IS NOT NULL")
    sets_of = stage(known.groupBy("f1", "f2").agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies")), "near-sets")
    chosen = known.join(sets_of, (known["doc_id"] == sets_of["rep"]) & (known["f1"] == sets_of["f1"]) & (known["f2"] == sets_of["f2"])).select("rep", "mark", "n", "bands", "sig")
    reps = stage(chosen.groupBy("rep").agg(F.min_by(F.struct("mark", "n", "bands", "sig"), "mark").alias("r")).select("rep", "r.*"), "near-reps")
    keyed = reps.select("rep", "n", F.explode("bands").alias("key"))
    keys = stage(keyed.groupBy("key").agg(F.min("rep").alias("pivot"), F.count("*").alias("size")).where("size > 1"), "near-keys")
    members = stage(skew_join(keyed, keys, ["key"], "size", F.xxhash64("rep"), "inner").select("key", "pivot", "rep", "n"), "near-buckets")
    discard(keys)
    needed = reps.join(members.select("rep").distinct(), "rep", "left_semi").select(F.col("rep").alias("doc_id"), "mark")
    sets = stage(rows.join(needed, ["doc_id", "mark"], "left_semi").mapInArrow(shingle_sets, "rep long, shingles binary"), "near-shingles")
    first = stage(confirm(members.where("rep <> pivot").select(F.col("pivot").alias("a"), F.col("rep").alias("b")).distinct(), sets), "near-links")
    dealt = lambda rows: rows.repartition(n_tasks, "key", "lo", "hi").sortWithinPartitions("key", "lo", "hi", "rep")
    tiles = dealt(unresolved(members, components(first, "near-components"), reps))
    pairs = stage(tiles.mapInArrow(per_tile(best_pairs, TILE_COLUMNS, ("a", "b")), "a long, b long").distinct(), "near-more")
    links = stage(first.unionByName(confirm(pairs, sets)), "near-links")
    discard(first, pairs)
    # What is still open is settled inside the tiles: pairs are never written out, only the texts that some pair needs, and links.
    tiles = stage(unresolved(members, components(links, "near-components"), reps), "near-tiles")
    asked = stage(dealt(tiles).mapInArrow(per_tile(in_question, TILE_COLUMNS, ("key", "lo", "hi", "rep")), "key long, lo long, hi long, rep long"), "near-asked")
    full = tiles.join(asked, ["key", "lo", "hi", "rep"], "left_semi").join(sets, "rep").select(*TILE_COLUMNS, "shingles")
    last = dealt(full).mapInArrow(per_tile(tile_links, (*TILE_COLUMNS, "shingles"), ("a", "b")), "a long, b long")
    every = stage(links.unionByName(last), "near-links")
    discard(members, sets, links, tiles, asked, reps)
    labels = components(every, "near-components")
    by_set = sets_of.join(labels, sets_of["rep"] == labels["node"], "left").select("f1", "f2", "copies", F.coalesce("component", "rep").alias("component_id"))
    by_set = stage(by_set, "near-by-set")
    discard(every, sets_of)
    # Rows without a set are in no join: their keys are all null, and would meet in one task.
    some = skew_join(sketches.where("f1 IS NOT NULL").select("doc_id", "n", "f1", "f2"), by_set, ["f1", "f2"], "copies", F.xxhash64("doc_id"))
    none = sketches.where("f1 IS NULL").select("doc_id", "n", F.lit(None).cast("long").alias("component_id"))
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    out = some.select("doc_id", "n", "component_id").unionByName(none).select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with one document of each component."""
    gone = near_groups(docs, id_col, text_col).where(~F.col("kept")).select("doc_id").distinct()
    return without(docs, gone, doc_id=F.col(f"`{id_col}`").cast("long"))


ORACLE = rf"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (
  SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')] ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END) AS shingle FROM words),
sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS i, b.doc_id AS j, count(*) AS common FROM sets a JOIN sets b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (SELECT i, j FROM pairs JOIN sizes a ON a.doc_id = i JOIN sizes b ON b.doc_id = j WHERE 100 * common >= 75 * (a.n + b.n - common)),
edges AS (SELECT i, j FROM links UNION ALL SELECT j, i FROM links),
reach(doc_id, other) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.doc_id, e.j FROM reach r JOIN edges e ON r.other = e.i),
least AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept FROM documents d JOIN least USING (doc_id) LEFT JOIN sizes USING (doc_id)
"""
