"""Removal of repeated byte strings by bounded interval expansion on a Burrows-Wheeler transform.

A byte goes if a string of SIZE bytes that covers it also starts anywhere else, in another document or the same.

1.  Anchors. Of every SIZE - GRAM + 1 grams of GRAM bytes in a row, the one with the least hash is an anchor (the rightmost of equal ones). A string of SIZE bytes holds
    an anchor wherever it occurs, at the same place in it. An anchor's context is the bytes of the strings that it is the anchor of: these start in a row, and every string has one anchor.
2.  Anchors whose gram occurs once are dropped: their strings are unique. Copies of a context are counted before anything is shuffled by gram (by the 128 bits of gram and
    context hash): each is repeated as a whole, and one of them stands for all in the next step.
3.  The different contexts of a gram go to an owner task. All strings of a context hold the gram whole, so a short code stands for its bytes (one code for equal bytes, and with a
    byte that no text has): strings are equal if and only if they are with the code in them. Over the concatenation the transform is built (suffixes sorted by as many bytes as a string
    has then) and intervals are extended backwards breadth-first: each round sets the boundaries whose common prefix is one byte longer and goes on with the intervals that set one. After
    as many rounds as a string has bytes the boundaries that are still unset are those between suffixes with a common prefix of a string or more; their places start repeated strings.
4.  A gram with more than GROUP contexts is no group of one task: its strings are dealt out by the place that the gram has in them. The strings with places in one half all hold more
    bytes before the gram, those with places in the other half more bytes behind it, and with these bytes the key is longer and the groups are smaller. As in
    step 2, copies of a half's bytes are counted first and one stands for all. Halving goes on while a group is larger than GROUP; at a single place a key has one body.

Nulls: a null text is empty; rows with a null id are documents like others. Repeated rows are documents of their own, so each of two repeats the other. Texts
under SIZE bytes have nothing to remove of. Very long texts are read in overlapping pieces. Ties: every copy of a string goes, none is first. Clashing names: only the id and the text are
read. Empty table: no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import as_rows, column, discard, partitions, skew_join, stage
from .textkernel import EXACT, U, chunks, mix, powers, text_bytes

SIZE = 400
GRAM = 200
WINDOW = SIZE - GRAM + 1
#: Contexts that share a key up to which one task compares them (at most 600 bytes each). A transform takes about 60 bytes of memory for each byte.
GROUP = 4000
#: Bytes of contexts that a transform is built over: whole groups are added until there are as many.
TRANSFORM = 1 << 20
#: Bytes of a text that are searched for anchors at once.
PIECE = 1 << 20
#: Bytes that no UTF-8 text has: one between bodies, one that a code begins with. A code goes on with CODE - 1 bytes under 0x80.
BETWEEN, CODED = 0xFF, 0xFE
CODE = 5


def rolling(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Prefix sums of a polynomial hash, and the inverse powers that make its differences independent of place."""
    power, inverse = powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(EXACT[data] * power[: len(data)], out=sums[1:])
    return sums, inverse


def sliding_least(x: np.ndarray, width: int) -> np.ndarray:
    """The least of every width neighbours, by running minima from both ends of blocks."""
    n = len(x) - width + 1
    pad = -len(x) % width
    blocks = np.concatenate([x, np.full(pad, np.iinfo(x.dtype).max, x.dtype)]).reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])


def anchors(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, ...]:
    """text, place, bytes before, bytes after (of the context), gram hash, context hash of every anchor."""
    none = np.zeros(0, np.int64)
    if len(data) < SIZE:
        return none, none, none, none, none, none
    sums, inverse = rolling(data)
    grams = mix((sums[GRAM:] - sums[:-GRAM]) * inverse[: len(data) - GRAM + 1])
    low = np.arange(len(grams), dtype=np.uint64)
    least = sliding_least((grams >> U(24) << U(24)) | (U((1 << 24) - 1) - low), WINDOW)
    # Windows that lie in one text: those that start SIZE bytes or more before its end.
    inside = np.zeros(len(data) + 1, np.int64)
    long = np.diff(bounds) >= SIZE
    np.add.at(inside, bounds[:-1][long], 1)
    np.add.at(inside, bounds[1:][long] - SIZE + 1, -1)
    begin = np.flatnonzero(np.cumsum(inside)[: len(least)] > 0)
    place = ((1 << 24) - 1) - (least[begin] & U((1 << 24) - 1)).astype(np.int64)
    # Places ascend, so the windows of one anchor are in a row.
    new = np.flatnonzero(np.diff(place, prepend=-1))
    at = place[new]
    text = np.searchsorted(bounds, at, "right") - 1
    before = at - begin[new]
    after = begin[np.append(new[1:], len(begin)) - 1] + SIZE - at
    whole = mix((sums[at + after] - sums[at - before]) * inverse[at - before] + before.astype(np.uint64) * U(0xD1B54A32D192ED03) + after.astype(np.uint64) * U(0x8CB92BA72F3D8DD7))
    return text, at, before, after, grams[at].view(np.int64), whole.view(np.int64)


def pieces(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, int, int]]:
    """(first text, place in it, bytes, bounds, from, to): all texts at once, or a text longer than PIECE in pieces that overlap by three sizes.

    Anchors of the places [from, to) of bytes are a piece's own: these ranges meet without overlap, and contexts in them are whole.
    """
    if len(data) <= PIECE:
        yield 0, 0, data, offsets, 0, len(data)
        return
    for t in range(len(offsets) - 1):
        own = data[offsets[t] : offsets[t + 1]]
        step = PIECE - 3 * SIZE
        for low in range(0, max(1, len(own) - 3 * SIZE), step):
            part = own[low : low + PIECE]
            yield t, low, part, np.array([0, len(part)]), SIZE if low else 0, step + SIZE if low + step < len(own) - 3 * SIZE else len(part)


def find_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """rid, at, before, after, gram, context."""
    for batch in batches:
        for chunk in chunks(batch):
            rid = column(chunk, "rid")
            data, offsets = text_bytes(column(chunk, "text"))
            for first, low, part, bounds, own, to in pieces(data, offsets):
                text, at, before, after, gram, whole = anchors(part, bounds)
                # Every place is one piece's own: two rows of one place would make a unique context a repeated one.
                ok = (at >= own) & (at < to)
                text, at, before, after, gram, whole = (x[ok] for x in (text, at, before, after, gram, whole))
                if len(at):
                    place = at - bounds[text] + low
                    yield pa.RecordBatch.from_arrays([rid.take(pa.array(first + text)), pa.array(place), pa.array(before), pa.array(after), pa.array(gram), pa.array(whole)], ["rid", "at", "before", "after", "gram", "context"])


def order_by(t: np.ndarray, size: int) -> np.ndarray:
    """The order of all rotations of t by their first size bytes or more, by doubling the sorted length from 8."""
    n = len(t)
    key = np.zeros(n, np.uint64)
    for k in range(8):
        key <<= U(8)
        key |= np.roll(t, -k)
    length = 8
    while True:
        order = np.argsort(key).astype(np.int32)
        key = key[order]
        new = np.zeros(n, bool)
        np.not_equal(key[1:], key[:-1], out=new[1:])
        if length >= size or int(new.sum()) == n - 1:
            return order
        rank = np.empty(n, np.uint32)
        rank[order] = np.cumsum(new, dtype=np.uint32)
        key = rank.astype(np.uint64) << U(32)
        key |= np.roll(rank, -length)
        length *= 2


def repeated(t: np.ndarray, size: int = SIZE) -> np.ndarray:
    """Places of t whose next size bytes are also the next size bytes of another place (rotations; BETWEEN counts as a byte)."""
    n = len(t)
    order = order_by(t, size)
    last = t[order - 1]  # the transform: the byte before each suffix
    lf = np.empty(n, np.int32)
    lf[np.argsort(last, kind="stable")] = np.arange(n, dtype=np.int32)
    first = np.sort(last)
    unset = np.ones(n + 1, bool)
    unset[[0, n]] = False
    owner = np.full(n, -1, np.int64)
    lows, highs = np.array([0]), np.array([n])
    stamp = 0
    for _ in range(size):
        sizes = highs - lows
        total = int(sizes.sum())
        if not total:
            break
        to = lf[np.repeat((lows - np.concatenate([[0], np.cumsum(sizes)[:-1]])).astype(np.int32), sizes) + np.arange(total, dtype=np.int32)]
        owner[to] = np.repeat(np.arange(stamp, stamp + len(lows)), sizes)
        stamp += len(lows)
        # An extended interval ends where its neighbour comes from another interval or has another byte.
        here, byte = owner[to], first[to]
        up, down = np.minimum(to + 1, n - 1), np.maximum(to - 1, 0)
        ends = np.sort(to[(to == n - 1) | (owner[up] != here) | (first[up] != byte)]) + 1
        begins = np.sort(to[(to == 0) | (owner[down] != here) | (first[down] != byte)])
        fresh = unset[ends]
        unset[ends[fresh]] = False
        lows, highs = begins[fresh], ends[fresh]
    pair = np.flatnonzero(unset)
    return np.unique(np.concatenate([order[pair - 1], order[pair]]))


def search(bodies: list[list]) -> list[tuple[bytes, int, int]]:
    """(rid, start, end) of what is repeated among bodies (low, high, rid, start, gram_at, body), whose strings are those that start in them and are whole."""
    # The strings of a body all hold its core, the bytes around the gram that its key is of. A code stands for the first `gone` of them.
    gone = SIZE - max(high - low for low, high, *_ in bodies)
    codes: dict[bytes, bytes] = {}
    starts, parts, at = [], [], 0
    for low, high, _, _, gram_at, body in bodies:
        first = gram_at - low
        core = body[first : gram_at - high + SIZE]
        if (code := codes.get(core)) is None:
            n = len(codes)
            code = codes[core] = bytes((CODED, *(n >> 7 * k & 127 for k in range(CODE - 1))))
        starts.append(at)
        parts += [body[:first], code, body[first + gone :], b"\xff"]
        at += len(body) - gone + CODE + 1
    size = SIZE - gone + CODE
    found = repeated(np.frombuffer(b"".join(parts), np.uint8), size)
    starts_at = np.array([*starts, at])
    which = np.searchsorted(starts_at, found, "right") - 1
    ok = found + size < starts_at[which + 1]
    found, which = found[ok], which[ok]
    found -= starts_at[which]
    # Runs of places that strings cover together, body by body.
    new = np.flatnonzero((np.diff(which, prepend=-1) != 0) | (np.diff(found, prepend=0) > SIZE))
    last = np.append(new[1:], len(found)) - 1
    return [(bodies[i][2], bodies[i][3] + a, bodies[i][3] + b + SIZE) for i, a, b in zip(which[new].tolist(), found[new].tolist(), found[last].tolist(), strict=True)] if len(found) else []


def compare_contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spans (rid, start, end) from bodies sorted by key; whole groups are taken together until there are TRANSFORM bytes."""
    held: list[list] = []
    size, now = 0, None

    def out() -> Iterator[pa.RecordBatch]:
        spans = search(held)
        if spans:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*spans, strict=True), (pa.binary(), pa.int64(), pa.int64()), strict=True)], ["rid", "start", "end"])

    for batch in batches:
        for at in range(0, batch.num_rows, 1000):
            for key, *row in zip(*(column(batch.slice(at, 1000), c).to_pylist() for c in ("key", "low", "high", "rid", "start", "gram_at", "body")), strict=True):
                if key != now and size >= TRANSFORM:
                    yield from out()
                    held.clear()
                    size = 0
                now = key
                held.append(row)
                size += len(row[-1])
    if held:
        yield from out()


#: A row of the search: the key that it is compared under, the places that the gram may have in its strings, the document, where the body starts in it, where the gram is in the body, the body.
BODY = "key long, low int, high int, rid binary, start long, gram_at int, body binary"
BODY_TYPES = [pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.int64(), pa.int32(), pa.binary(), pa.int64()]
HALF, COUNTED = BODY + ", whole long", BODY + ", n long"


def body_batches(rows: list[tuple], schema: str = BODY) -> Iterator[pa.RecordBatch]:
    names = [x.split(" ")[0] for x in schema.split(", ")]
    for i in range(0, len(rows), 1000):
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows[i : i + 1000], strict=True), BODY_TYPES[: len(names)], strict=True)], names)


def cut_contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of the wanted contexts of each text, under their gram, with the gram's number of contexts."""
    for batch in batches:
        for text, wanted, rid in zip(*(column(batch, c) for c in ("text", "wanted", "rid")), strict=True):
            data, rid = (text.as_py() or "").encode("utf-8", "surrogatepass"), rid.as_py()
            rows = wanted.as_py()
            for i in range(0, len(rows), 1000):
                yield from body_batches([(w["gram"], 0, SIZE - GRAM, rid, w["at"] - w["before"], w["before"], data[w["at"] - w["before"] : w["at"] + w["after"]], w["n"]) for w in rows[i : i + 1000]], COUNTED)


def halve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each body for either half of the gram's places: cut to the strings of that half, under a key of the bytes that all of these share; whole is a hash of what is left."""
    import xxhash

    for batch in batches:
        for i in range(0, batch.num_rows, 500):
            out = []
            for key, low, high, rid, start, gram_at, body in zip(*(c.to_pylist() for c in batch.slice(i, 500).columns), strict=True):
                middle = (low + high) // 2
                for a, b in ((low, middle), (middle + 1, high)):
                    first, last = max(a, SIZE - (len(body) - gram_at)), min(b, gram_at)  # of the body's own strings
                    if first <= last:
                        longer = xxhash.xxh3_64_intdigest(body[gram_at - a : gram_at - b + SIZE], seed=(key + (a << 32) + b) % (1 << 64))
                        own = body[gram_at - last : gram_at - first + SIZE]
                        out.append((longer - (1 << 63), a, b, rid, start + gram_at - last, last, own, xxhash.xxh3_64_intdigest(own) - (1 << 63)))
            yield from body_batches(out, HALF)


def spans_of_bodies(bodies: DataFrame) -> DataFrame:
    """(rid, start, end) of the strings that bodies under one key share. bodies: those columns, and n, the number of bodies of the key."""
    n_tasks, spans = partitions(bodies.sparkSession), None
    names = [x.split(" ")[0] for x in BODY.split(", ")]
    while True:
        owned = bodies.where(F.col("n") <= GROUP).select(*names).repartition(n_tasks, "key").sortWithinPartitions("key")
        found = owned.mapInArrow(compare_contexts, "rid binary, start long, end long")
        spans = found if spans is None else spans.unionByName(found)
        crowded = bodies.where(F.col("n") > GROUP)
        if crowded.isEmpty():
            return spans
        halves = stage(crowded.select(*names).mapInArrow(halve, HALF), "bwt-halves")
        kinds = stage(halves.groupBy("key", "whole").agg(F.min(F.struct(*names[1:])).alias("first"), F.count("*").alias("copies")), "bwt-kinds")
        copied = kinds.where("copies > 1").select("key", "whole", "copies")
        end = F.col("start") + F.octet_length("body")
        again = skew_join(halves.select("key", "whole", "rid", "start", end.alias("end")), copied, ["key", "whole"], "copies", F.xxhash64("rid", "start"), "inner").select("rid", "start", "end")
        spans = spans.unionByName(stage(again, "bwt-spans"))
        sizes = stage(kinds.groupBy("key").agg(F.count("*").alias("n"), F.min("copies").alias("least")).where("n > 1 AND least = 1").drop("least"), "bwt-sizes")
        bodies = stage(skew_join(kinds.select("key", "first.*"), sizes, ["key"], "n", F.xxhash64("rid", "start"), "inner"), "bwt-bodies")
        discard(halves, kinds, sizes)


def repeated_spans(rows: DataFrame) -> DataFrame:
    """(rid, start, end) of repeated bytes; spans may overlap. rows: rid, text (a rid stands for one (id, text), with copies)."""
    found = rows.select("rid", "text").where(F.octet_length("text") >= SIZE).mapInArrow(find_anchors, "rid binary, at long, before long, after long, gram long, context long")
    found = stage(found, "bwt-anchors")
    grams = stage(found.groupBy("gram").agg(F.count("*").alias("n")).where("n > 1"), "bwt-grams")
    shared = stage(skew_join(found, grams, ["gram"], "n", F.xxhash64("rid", "at"), "inner").drop("n"), "bwt-shared")
    discard(found, grams)
    first = F.min(F.struct("rid", "at", "before", "after")).alias("first")
    contexts = stage(shared.groupBy("gram", "context").agg(first, F.count("*").alias("n")), "bwt-contexts")
    whole = contexts.where("n > 1").select("gram", "context", "n")
    inner = skew_join(shared, whole, ["gram", "context"], "n", F.xxhash64("rid", "at"), "inner").select("rid", (F.col("at") - F.col("before")).alias("start"), (F.col("at") + F.col("after")).alias("end"))
    # A gram with one context, or with repeated ones only, is settled by then; of all others one of each context is compared.
    sizes = stage(contexts.groupBy("gram").agg(F.count("*").alias("n_contexts"), F.min("n").alias("least")).where("n_contexts > 1 AND least = 1").drop("least"), "bwt-edges")
    wanted = skew_join(contexts.select("gram", "first"), sizes, ["gram"], "n_contexts", F.xxhash64("first"), "inner").select("gram", "first.*", F.col("n_contexts").alias("n"))
    by_text = wanted.groupBy("rid").agg(F.collect_list(F.struct("gram", "at", "before", "after", "n")).alias("wanted"))
    bodies = stage(rows.join(by_text, "rid").mapInArrow(cut_contexts, COUNTED), "bwt-bodies")
    spans = stage(inner.unionByName(spans_of_bodies(bodies)), "bwt-spans")
    discard(shared, contexts, sizes, bodies)
    return spans


def strip(batches: Iterator[pa.RecordBatch], keep_text: bool) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "n_kept", "n_chars_kept", "changed", "kept_bytes"][: 8 + keep_text]
    types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.binary()][: 8 + keep_text]
    for batch in batches:
        cols = []
        for doc_id, text, spans in zip(*(column(batch, c) for c in ("doc_id", "text", "spans")), strict=True):
            data = (text.as_py() or "").encode("utf-8", "surrogatepass")
            kept, at, gone, runs, last = [], 0, 0, 0, -1
            for s in sorted((x["start"], x["end"]) for x in spans.as_py() or ()):
                a, b = max(s[0], at), s[1]
                if b <= at:
                    continue
                if s[0] > last:
                    runs += 1
                    kept.append(data[at:a])
                gone += b - a
                at = last = b
            kept.append(data[at:])
            left = b"".join(kept)
            cols.append((doc_id.as_py(), len(data), gone, runs, hashlib.sha256(left).hexdigest(), len(left), len(left.decode("utf-8", "ignore")), gone > 0, left)[: 8 + keep_text])
        if cols:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*cols, strict=True), types, strict=True)], names)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep_text: bool = False) -> DataFrame:
    """One row a document: doc_id, n_bytes, n_removed, n_spans, kept_sha256, n_kept (bytes left), n_chars_kept (whole letters left), changed (and kept_bytes: a cut may leave half a letter)."""
    name = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.lit(":"), F.col("text"))
    rows = as_rows(docs, id_col, text_col).select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("rid", F.unhex(F.md5(name)))
    spans = repeated_spans(rows)
    by_text = spans.groupBy("rid").agg(F.collect_set(F.struct("start", "end")).alias("spans"))
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, n_kept long, n_chars_kept long, changed boolean" + ", kept_bytes binary" * keep_text
    return rows.join(by_text, "rid", "left").mapInArrow(lambda b: strip(b, keep_text), schema)


ORACLE = f"""
WITH bytes AS (SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
strings AS MATERIALIZED (SELECT r, s, md5_number(substr(h, 2 * s - 1, {2 * SIZE})) AS k FROM (SELECT r, h, unnest(range(1, len(h) // 2 - {SIZE - 2})) AS s FROM bytes)),
again AS (SELECT r, s FROM strings WHERE k IN (SELECT k FROM strings GROUP BY k HAVING count(*) > 1)),
marked AS (SELECT r, s, coalesce(s - lag(s) OVER (PARTITION BY r ORDER BY s) > {SIZE}, true) AS first FROM again),
runs AS (SELECT r, min(s) AS a, max(s) + {SIZE - 1} AS b FROM (SELECT r, s, sum(CAST(first AS INTEGER)) OVER (PARTITION BY r ORDER BY s) AS run FROM marked) GROUP BY r, run),
gaps AS (SELECT r, a, b, lag(b, 1, 0) OVER (PARTITION BY r ORDER BY a) AS before FROM runs),
cut AS (
  SELECT r, count(*) AS n_spans, sum(b - a + 1) AS n_removed, string_agg(substr(h, 2 * before + 1, 2 * (a - 1 - before)), '' ORDER BY a) || substr(any_value(h), 2 * max(b) + 1) AS kept
  FROM gaps JOIN bytes USING (r) GROUP BY r),
whole AS (SELECT doc_id, len(h) // 2 AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans, coalesce(kept, h) AS kept FROM bytes LEFT JOIN cut USING (r))
SELECT doc_id, n_bytes, n_removed, n_spans, sha256(unhex(kept)) AS kept_sha256, len(kept) // 2 AS n_kept,
  len(regexp_extract_all(regexp_replace(kept, '(..)', '\\1 ', 'g'), '[0-7]. |[CD]. [89AB]. |E. [89AB]. [89AB]. |F. [89AB]. [89AB]. [89AB]. ')) AS n_chars_kept, n_removed > 0 AS changed
FROM whole
"""
