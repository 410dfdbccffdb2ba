"""Every corpus operator against brute force on a fixture with nulls, empty and long texts, ties, repeats and clashing columns."""

import collections
import hashlib
import random
import re
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import public_tokenizers
from lumbre.llm import arc_warc, bpe_trie, decontaminate, exact_dedup, language_crf, line_dedup, near_dedup, quality, queries, shared, substring_dedup, token_store

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, h long, rep long, kept string, _gone long, _sha string, _mark long, _lines string, `row` string, mark long"
WORD = "word_bpe_49k.json"
BYTE = "byte_bpe_50k.json"


def words(rnd, n):
    return " ".join("".join(rnd.choice("etaoinshr") for _ in range(rnd.randint(2, 8))) for _ in range(n))


@pytest.fixture(scope="module")
def texts():
    rnd = random.Random(7)
    base = words(rnd, 150)
    passage = words(rnd, 90)
    out = [(1, base), (2, base), (3, base.replace("e", "E", 3)), (4, base + " tail " + words(rnd, 10)), (5, None), (6, ""), (7, "one two"), (8, "one two"), (9, "ONE two"), (None, base), (10, None), (11, "  \n\t ")]
    out += [(20 + k, words(rnd, 30) + "\n" + passage + "\n" + words(rnd, 20)) for k in range(5)]
    parts = base.split(" ")
    for k in range(12):  # near copies, some far from each other
        edited = list(parts)
        for i in rnd.sample(range(len(edited)), 1 + k // 2):
            edited[i] = words(rnd, 1)
        out.append((40 + k, " ".join(edited)))
    out += [(60, "ab " * 400), (61, "a" * 450), (62, "é" * 399 + "ü"), (63, words(rnd, 6000)), (64, "l1\nl2\nl3\nl4\nx"), (65, "y\nl2\nl3\nl4"), (66, "l2\nl3"), (67, "q\nq\nq\nq\nq"), (68, "don't <|endoftext|> ΑΣ ÿ\x00 12 ²\x1c🙂"), (69, "\n\n\n\n")]
    return out + [(1, base)]


@pytest.fixture(scope="module")
def docs(spark, texts):
    return spark.createDataFrame([(i, t, "en" if (i or 0) % 2 else None, None if i == 7 else "a/b/c", 0, 1, 2, "x", i, "s", 3, "l", "r", 4) for i, t in texts], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def test_exact(docs, empty, texts):
    groups = collections.defaultdict(list)
    for i, t in texts:
        groups[t or ""].append(i)
    wanted = []
    for i, t in texts:
        g = groups[t or ""]
        top = max((x for x in g if x is not None), default=None)
        wanted.append((i, top, len(g), i == top, hashlib.sha256((t or "").encode()).hexdigest()))
    for capacity in (1, 4000):
        got = [tuple(r) for r in exact_dedup.exact_groups(docs, capacity=capacity).collect()]
        assert sorted(got, key=str) == sorted(wanted, key=str)
    left = exact_dedup.exact_dedup(docs)
    assert left.columns == docs.columns and left.where("text = 'one two'").count() == 1 and left.where("doc_id IS NULL").count() == 0
    assert exact_dedup.exact_groups(empty).count() == 0


def test_directory_splits():
    counts = np.zeros(1 << exact_dedup.DEPTH)
    counts[:100] = 50
    counts[40_000] = 9000
    d, local = exact_dedup.directory(counts, 200)
    load = np.bincount(np.repeat(d, len(counts) // len(d)), counts)
    assert sorted(load)[-1] == 9000 and sorted(load)[-2] <= 200 and local.max() == exact_dedup.DEPTH
    assert len(exact_dedup.directory(np.zeros(1 << 16), 1)[0]) == 1
    rng = np.random.default_rng(1)
    counts = rng.integers(0, 40, 1 << exact_dedup.DEPTH).astype(float)
    d, _ = exact_dedup.directory(counts, 500)
    owner = exact_dedup.owners(d, counts, 13)
    shares = np.bincount(owner, counts)
    assert (np.diff(owner) >= 0).all() and len(shares) == 13 and shares.max() < 1.1 * shares.mean()
    at = np.repeat(d, len(counts) // len(d))
    assert all(len(np.unique(owner[at == b])) == 1 for b in range(0, d.max(), 97))  # buckets are whole


def test_buckets_below_the_table():
    rnd = random.Random(4)
    top = 0x1234 << 48
    hashes = sorted({top | rnd.getrandbits(48) for _ in range(300)} | {top | 77 << 10 | rnd.getrandbits(8) for _ in range(120)} | {rnd.getrandbits(64) for _ in range(100)})
    buckets = exact_dedup.Buckets(10, lambda h: exact_dedup.DEPTH)
    out, most = [], 0
    for h in hashes:
        out += buckets.add(h, [(0, "x", 1, 1)])
        most = max(most, len(buckets.held))
    out += buckets.close()
    assert [e[0] for e in out] == hashes and most <= 11
    by = collections.Counter((e[-2], e[-1]) for e in out)
    assert max(by.values()) <= 10 and all(e[0] >> (64 - e[-1]) == e[-2] for e in out) and max(d for _, d in by) > 50
    same = exact_dedup.Buckets(1, lambda h: 0)
    assert [e[-1] for e in [*same.add(5, [(k, "x", 1, 1) for k in range(4)]), *same.close()]] == [0] * 4  # a chain isn't split


def near_brute(texts):
    fold = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets = {}
    for i, t in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(fold))
        sets[i] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    parent = {i: i for i in sets if i is not None}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in parent:
        for b in parent:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return [(i, len(sets[i]), None if i is None else find(i), i is None or find(i) == i) for i, _ in texts]


def test_near(docs, empty, texts):
    got = [tuple(r) for r in near_dedup.near_groups(docs).collect()]
    assert sorted(got, key=str) == sorted(near_brute(texts), key=str)
    assert near_dedup.near_dedup(docs).columns == docs.columns
    assert near_dedup.near_groups(empty).count() == 0


def test_ids_of_different_texts(spark):
    rnd = random.Random(15)
    a, b = words(rnd, 60), words(rnd, 60)
    docs = spark.createDataFrame([(1, a), (1, b), (2, a), (3, b), (4, words(rnd, 9))], "doc_id long, text string")
    first = sorted(map(tuple, near_dedup.near_groups(docs).collect()))
    assert len(first) == 5 and first == sorted(map(tuple, near_dedup.near_groups(docs.repartition(5, "text")).collect()))
    assert {r[2] for r in first} == {1, 4}


def test_near_in_small_tiles(docs, texts, monkeypatch):
    monkeypatch.setattr(near_dedup, "TILE", 2)
    got = [tuple(r) for r in near_dedup.near_groups(docs).collect()]
    assert sorted(got, key=str) == sorted(near_brute(texts), key=str)


def test_components(spark):
    rnd = random.Random(3)
    links = [(rnd.randint(0, 400), rnd.randint(0, 400)) for _ in range(300)] + [(500, k) for k in range(501, 700)]
    parent = {x: x for ab in links for x in ab}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    df = spark.createDataFrame(links, "a long, b long")
    for rows in (10, 10_000):
        got = dict(map(tuple, shared.components(df, rows_per_task=rows).collect()))
        assert all(got.get(x, x) == find(x) for x in parent)


def test_superminhash_estimates():
    rng = np.random.default_rng(1)
    common, a, b = (rng.integers(0, 2**63, n, dtype=np.uint64) for n in (300, 50, 50))
    s = near_dedup.superminhash(np.concatenate([common, a, common, b]), np.array([0, 350, 700]))
    assert abs((s[0] == s[1]).mean() - 0.75) < 0.15
    one = near_dedup.superminhash(common[:1], np.array([0, 1]))
    assert sorted((one[0] >> 24).tolist()) == list(range(near_dedup.SLOTS))


def substring_brute(texts, size):
    data = [(i, (t or "").encode()) for i, t in texts]
    seen = collections.Counter(b[k : k + size] for _, b in data for k in range(len(b) - size + 1))
    out = []
    for i, b in data:
        gone = bytearray(len(b))
        for k in range(len(b) - size + 1):
            if seen[b[k : k + size]] > 1:
                gone[k : k + size] = b"\1" * size
        kept = bytes(c for c, g in zip(b, gone, strict=True) if not g)
        out.append((i, len(b), sum(gone), len(re.findall(rb"\x01+", bytes(gone))), hashlib.sha256(kept).hexdigest(), len(kept), len(kept.decode("utf-8", "ignore")), len(kept) < len(b)))
    return out


@pytest.mark.parametrize("group", [2000, 3, 0])
def test_substrings(docs, empty, texts, group, monkeypatch):
    monkeypatch.setattr(substring_dedup, "GROUP", group)
    got = [tuple(r) for r in substring_dedup.remove_repeats(docs).collect()]
    assert sorted(got, key=str) == sorted(substring_brute(texts, 400), key=str)
    assert substring_dedup.remove_repeats(empty).count() == 0


def test_anchors_of_long_texts_in_pieces(monkeypatch):
    rnd = random.Random(2)
    t = words(rnd, 3000)
    batch = pa.RecordBatch.from_arrays([pa.array([b"1"]), pa.array([t])], ["rid", "text"])
    rows = lambda: sorted({tuple(r.values()) for b in substring_dedup.find_anchors(iter([batch])) for r in b.to_pylist()})
    whole = rows()
    monkeypatch.setattr(substring_dedup, "PIECE", 5000)
    assert rows() == whole and len(whole) > 50


def test_long_texts_in_pieces_against_brute_force(spark, monkeypatch):
    def in_small_pieces(batches):  # the tasks have modules of their own
        from lumbre.llm import substring_dedup as own

        size, own.PIECE = own.PIECE, 5000
        try:
            yield from own.find_anchors(batches)
        finally:
            own.PIECE = size

    rnd = random.Random(12)
    long, passage = words(rnd, 6000), words(rnd, 150)
    rows = [(1, long), (2, words(rnd, 2000) + passage + words(rnd, 1500)), (3, long[8000:14_000] + words(rnd, 3000)), (4, passage), (5, words(rnd, 5000)), (6, words(rnd, 833))]
    rows += [(7, words(rnd, 3000)[:n]) for n in (5000, 5001, 6200, 8800, 8801, 10_000)]
    rows += [(8, rows[4][1]), (9, "a" * 12_000), (5, rows[4][1])]
    monkeypatch.setattr(substring_dedup, "find_anchors", in_small_pieces)
    got = [tuple(r) for r in substring_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()]
    assert sorted(got) == sorted(substring_brute(rows, 400))


def test_every_string_is_in_one_context():
    rnd = random.Random(21)
    texts = [words(rnd, 2000), "ab" * 700, "a" * 400, "b" * 399, words(rnd, 70) * 3, "é" * 500 + words(rnd, 400)]
    data, bounds = substring_dedup.text_bytes(pa.array(texts))
    text, at, before, after, _, _ = substring_dedup.anchors(data, bounds)
    starts = collections.Counter(x for t, a, b, c in zip(text.tolist(), at.tolist(), before.tolist(), after.tolist(), strict=True) for x in range(a - b, a + c - 399) if bounds[t] <= x and a + c <= bounds[t + 1])
    assert starts == collections.Counter(x for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True) for x in range(a, b - 399))


def test_a_code_stands_for_what_all_strings_of_a_key_hold(monkeypatch):
    rnd = random.Random(22)
    letters = lambda n: bytes(rnd.choice(b"abc \xc3\xa9") for _ in range(n))
    grams, left, right = [letters(200) for _ in range(3)], letters(200), letters(200)
    bodies = []  # key, low, high, rid, start, gram_at, body: the second gram has the first one's key, as with equal hashes
    for k, gram in enumerate(grams):
        for n in range(12):
            a, b = rnd.randrange(201), rnd.randrange(201)
            l, r = bytearray(left[200 - max(a, 200 - b) :]), bytearray(right[:b])
            if n % 3:
                l[rnd.randrange(len(l))] ^= 1
            if n % 4 and r:
                r[rnd.randrange(len(r))] ^= 1
            bodies.append((k // 2, 0, 200, b"%d.%d" % (k, n), rnd.randrange(1000), len(l), bytes(l) + gram + bytes(r)))
    half = [next(substring_dedup.halve(iter([pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*bodies, strict=True), substring_dedup.BODY_TYPES)], [x.split(" ")[0] for x in substring_dedup.BODY.split(", ")])])))]
    half = [tuple(r.values())[:7] for r in half[0].to_pylist()]
    searched, transform = [], substring_dedup.repeated
    monkeypatch.setattr(substring_dedup, "repeated", lambda t, *size: searched.append(len(t)) or transform(t, *size))
    for rows in (bodies, sorted(half)):
        seen = collections.Counter(body[k : k + 400] for *_, body in rows for k in range(len(body) - 399))
        want = {(rid, start + k + i) for _, _, _, rid, start, _, body in rows for k in range(len(body) - 399) if seen[body[k : k + 400]] > 1 for i in range(400)}
        batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), substring_dedup.BODY_TYPES)], [x.split(" ")[0] for x in substring_dedup.BODY.split(", ")])
        searched.clear()
        got = {(x["rid"], i) for b in substring_dedup.compare_contexts(iter([batch])) for x in b.to_pylist() for i in range(x["start"], x["end"])}
        assert got == want and want
        assert sum(searched) < sum(len(r[-1]) - 190 for r in rows)


def test_transform_against_brute_force():
    rnd = random.Random(9)
    for size in (3, 8):
        for _ in range(20):
            t = "".join(rnd.choice("abcd") for _ in range(120))
            t = (t + t[:40] + "\x7f").encode()
            seen = collections.defaultdict(list)
            for i in range(len(t)):
                seen[(t + t)[i : i + size]].append(i)
            assert substring_dedup.repeated(np.frombuffer(t, np.uint8), size).tolist() == sorted(i for v in seen.values() if len(v) > 1 for i in v)


def test_lines(docs, empty, texts):
    rows = sorted({(i, t) for i, t in texts if t is not None}, key=lambda r: (r[0] is not None, r[0] or 0))
    first, gone = {}, collections.defaultdict(set)
    for i, t in rows:
        lines = t.split("\n")
        for n in (1, 2, 3):
            for k in range(len(lines) - n + 1):
                run = tuple(lines[k : k + n])
                if (n == 3 or len(re.findall(r"[^\x20\x09-\x0D]+", "\n".join(run))) >= 50) and first.setdefault(run, (i, k)) != (i, k):
                    gone[i].update(range(k, k + n))
    wanted = []
    for i, t in texts:
        lines = [] if t is None else t.split("\n")
        left = "\n".join(x for k, x in enumerate(lines) if k not in gone[i])
        wanted.append((i, len(lines), len(gone[i]) if t is not None else 0, hashlib.sha256(left.encode()).hexdigest()))
    got = [tuple(r) for r in line_dedup.report(docs).collect()]
    assert sorted(got, key=str) == sorted(wanted, key=str)
    out = line_dedup.line_dedup(docs)
    assert out.where("doc_id = 67").first()["text"] == "q" and out.where("doc_id = 5").first()["text"] is None
    assert line_dedup.report(empty).count() == 0
    removed = {r[0]: r[2] for r in got}
    assert [removed[20 + k] for k in range(5)] == [0, 1, 1, 1, 1]  # a passage of 90 words on one line


def test_passages_of_few_lines(spark):
    rnd = random.Random(3)
    head, tail, long, short = words(rnd, 30), words(rnd, 25), words(rnd, 60), words(rnd, 5)
    rows = [(1, f"a\n{head}\n{tail}\nb"), (2, f"c\n{head}\n{tail}\nd"), (3, f"{head}\ne"), (4, f"{tail}\n{short}\n{long}"), (5, f"f\n{short}\n{long}"), (6, f"{short}\n{words(rnd, 70)}\n{short}"), (7, f"{long}\n{long}")]
    got = dict(line_dedup.line_dedup(spark.createDataFrame(rows, "doc_id long, text string")).select("doc_id", "text").collect())
    assert got == dict(rows) | {2: "c\nd", 5: "f", 7: ""}


def test_bpe(docs, empty, texts):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path(WORD))
    wanted = []
    for i, x in texts:
        ids = t.encode(x or "", add_special_tokens=False).ids
        wanted.append((i, len(ids), " ".join(map(str, ids)), t.decode(ids, skip_special_tokens=False)))
    got = [tuple(r) for r in bpe_trie.encode_decode(docs, public_tokenizers.path(WORD), digests=False).collect()]
    assert sorted(got, key=str) == sorted(wanted, key=str)
    assert bpe_trie.encode_decode(empty, public_tokenizers.path(WORD)).count() == 0


def test_bpe_words_and_letters():
    from tokenizers import Tokenizer

    rnd = random.Random(1)
    path = public_tokenizers.path(WORD)
    t, mine = Tokenizer.from_file(path), bpe_trie.WordTokenizer(path)
    samples = ["".join(rnd.choice(a) for _ in range(rnd.randint(1, 24))) for a in ("aaab", "etaoinshrdlu", "ab.!'-") for _ in range(300)]
    samples += [f"a{chr(c)}b{chr(c)}{chr(c)}1" for c in range(1, 0x700)] + ["".join(map(chr, range(0x4E00, 0x4E40)))]
    assert [x[0] for x in mine.batch(samples)] == [" ".join(map(str, e.ids)) for e in t.encode_batch(samples, add_special_tokens=False)]


def test_bpe_forgets_and_gives_the_same(texts, monkeypatch):
    path = public_tokenizers.path(WORD)
    samples = [t or "" for _, t in texts]
    wanted = list(bpe_trie.WordTokenizer(path).batch(samples))
    for limit in ("PAIRS", "STEPS", "REMEMBER", "REMEMBER_LETTERS"):
        monkeypatch.setattr(bpe_trie, limit, 3)
    mine = bpe_trie.WordTokenizer(path)
    assert [x for t in samples for x in mine.batch([t])] == wanted
    assert len(mine.bpe.known) <= 3 and len(mine.bpe.steps) <= 3


def test_token_store(spark, docs, empty, texts, monkeypatch):
    from tokenizers import Tokenizer

    monkeypatch.setattr(token_store, "BLOCK", 2000)
    path = public_tokenizers.path(BYTE)
    t = Tokenizer.from_file(path)
    known, wanted, start = [x for x in texts if x[0] is not None], [], 0
    null = [x for x in texts if x[0] is None]
    for i, x in null + sorted(known, key=lambda r: r[0]):
        ids = np.array([*t.encode(x or "", add_special_tokens=False).ids, 0], "<u4")
        wanted.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    blocks = token_store.write_tokens(docs, path)
    assert blocks.count() > 3
    assert sorted((tuple(r) for r in token_store.read_tokens(blocks).collect()), key=str) == sorted(wanted, key=str)
    assert token_store.read_tokens(token_store.write_tokens(empty, path)).count() == 0


@pytest.mark.parametrize("n", [0, 1, 63, 64, 65, 500])
def test_elias_fano(n):
    rng = np.random.default_rng(n)
    values = np.sort(rng.integers(0, 50 * n + 1, n)).astype(np.uint64)
    own = token_store.EliasFano.of(values)
    back, _ = token_store.EliasFano.from_bytes(memoryview(own.to_bytes()), 0)
    assert back.all().tolist() == values.tolist() and [back.select(i) for i in range(n)] == values.tolist()
    with pytest.raises(IndexError):
        back.select(n)


def test_warc(spark):
    long = "x" * 1200
    rows = [(1, "http://a b/", long), (2, None, long), (3, "u", None), (4, "u", "short"), (5, "u", "short"), (None, "u", long), (7, "u", "é" * 600), (2, "v", long)]
    pages = spark.createDataFrame([(*r, "z") for r in rows], "page_id long, url string, html string, digest string").repartition(2)
    out = arc_warc.read_warc(arc_warc.arc_to_warc(arc_warc.pages_to_arc(pages))).collect()
    wanted = []
    for i, _, h in rows:
        b = (h or "").encode()
        again = h == long and i != 2
        wanted.append((i, len(b), hashlib.sha1(b).hexdigest(), "revisit" if again else "response", 2 if again else None))
    assert sorted((tuple(r)[:5] for r in out), key=str) == sorted(wanted, key=str)
    none = spark.createDataFrame([], pages.schema)
    assert arc_warc.read_warc(arc_warc.arc_to_warc(arc_warc.pages_to_arc(none))).count() == 0


def test_arc_versions_and_faults():
    for version in (1, 2):
        name = f"v{version}.arc"
        blob = arc_warc.arc_head(name, version, "19990102030405")
        blob += arc_warc.arc_record(version, "http://h/p", "19990102030405", "text/html", b"HTTP/1.0 200 OK\r\n\r\nbody\nmore", len(blob), name)
        blob += arc_warc.arc_record(version, "dns:h", "1999010203", "text/dns", b"1.2.3.4", len(blob), name)
        records = list(arc_warc.parse_warc(arc_warc.convert(name, blob, {})))
        assert [f["WARC-Type"] for f, _ in records] == ["warcinfo", "response", "resource"]
        assert records[1][0]["WARC-Date"] == "1999-01-02T03:04:05Z" and bytes(records[1][1]).endswith(b"body\nmore")
        assert records[1][0]["WARC-Payload-Digest"] == arc_warc.sha1(b"body\nmore")
        with pytest.raises(ValueError, match="cut short"):
            list(arc_warc.parse_arc(blob[:-5]))
    with pytest.raises(ValueError, match="version block"):
        list(arc_warc.parse_arc(b"http://x 1 2 3 1\na\n"))


def test_contamination(spark, empty):
    rnd = random.Random(4)
    item = words(rnd, 40)
    edited = item.split(" ")
    edited[20] = "zzz"
    rows = [(1, words(rnd, 50) + "\n" + item.upper() + "  " + words(rnd, 9)), (2, " ".join(edited)), (3, item[: len(item) // 2]), (4, words(rnd, 80)), (5, None), (6, ""), (7, item + " " + item), (8, "tiny item"), (None, item)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame([(10, item), (11, "tiny item"), (12, None), (13, words(rnd, 12))], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]): r for r in decontaminate.contaminated(docs, bench).collect()}
    assert set(got) == {(1, 10), (2, 10), (7, 10), (None, 10), (8, 11)}  # a short item is found where it is the whole text
    assert got[1, 10]["similarity"] == 1.0 and got[1, 10]["first_word"] == 50 and 0.75 <= got[2, 10]["similarity"] < 1
    assert sorted(r["doc_id"] for r in decontaminate.decontaminate(docs, bench).collect()) == [3, 4, 5, 6]
    assert decontaminate.contaminated(docs, bench.limit(0)).count() == 0 and decontaminate.contaminated(empty, bench).count() == 0


def test_every_window_is_compared_whatever_its_fingerprint():
    rnd = random.Random(8)
    items, texts = [], []
    for n, blank in ((154, 17), (204, 20), (204, 24), (404, 53)):
        for _ in range(10):  # a run of one word in the middle of a copy
            item = words(rnd, n).split(" ")
            low = (n - blank) // 2
            items.append(" ".join(item))
            texts.append(" ".join([words(rnd, 30), *item[:low], *["_"] * blank, *item[low + blank :], words(rnd, 30)]))
    for _ in range(30):  # repeated shingles in items and texts, texts shorter than items, ties
        some = " ".join(rnd.choice("ab") for _ in range(rnd.randint(5, 30)))
        items.append(some)
        texts += [" ".join(rnd.choice("ab") for _ in range(rnd.randint(1, 60))), some[: rnd.randint(1, len(some))] + " " + some]
    index = decontaminate.ItemIndex(list(range(len(items))), items)
    h, bounds = decontaminate.text_shingles(pa.array(texts))
    wanted = []
    for t in range(len(texts)):
        own = h[bounds[t] : bounds[t + 1]]
        for i, (_, shingles, _) in enumerate(index.items):
            size = min(int(index.sizes[i]), len(own))
            near = [index.similarity(own[k : k + size], i) for k in range(len(own) - size + 1)] if np.isin(own, shingles).any() else [0.0]
            if max(near) >= decontaminate.SIMILARITY:
                wanted.append((t, i, max(near), near.index(max(near))))
    assert {t for t, *_ in wanted} >= set(range(40))
    assert list(index.matches(h, bounds)) == wanted


def test_window_prints_against_sets():
    rng = np.random.default_rng(5)
    for n, size, kinds in ((40, 7, 5), (90, 30, 1000), (12, 12, 4), (5, 1, 3)):
        h = rng.integers(0, 2**63, kinds, dtype=np.uint64)[rng.integers(0, kinds, n)]
        wanted = [decontaminate.fingerprint(decontaminate.bit_signs(np.unique(h[k : k + size])).sum(0)) for k in range(n - size + 1)]
        assert decontaminate.WindowPrints(h).at(np.arange(n - size + 1), size).tolist() == [int(x) for x in wanted]


def test_recall_of_the_radius():
    rnd = random.Random(13)
    found = total = 0
    for n in (12, 20, 40, 60, 150):
        for _ in range(60):
            item = words(rnd, n).split(" ")
            edited = list(item)
            for i in rnd.sample(range(n), max(1, n // 50)):  # far edits: each costs five shingles
                edited[i] = words(rnd, 1)
            index = decontaminate.ItemIndex([1], [" ".join(item)])
            h, _ = decontaminate.text_shingles(pa.array([words(rnd, 40) + " " + " ".join(edited) + " " + words(rnd, 40)]))
            if index.best(h, 0):
                total += 1
                found += index.near_items(h) == [0]
    assert total > 100 and found >= 0.99 * total


def test_short_and_empty_items(spark):
    docs = spark.createDataFrame([(1, "one two three four five six"), (2, "One  two"), (3, ""), (4, "字" * 40), (5, "one two three")], "doc_id long, text string")
    bench = spark.createDataFrame([(1, "one two three four five"), (2, "one two"), (3, None), (4, "字" * 40), (5, "  ")], "item_id long, text string")
    assert sorted((r["doc_id"], r["item_id"]) for r in decontaminate.contaminated(docs, bench).collect()) == [(1, 1), (2, 2), (4, 4)]
    assert sorted((r["doc_id"], r["item_id"]) for r in decontaminate.contaminated(docs, bench.where("item_id = 1")).collect()) == [(1, 1)]


def test_hamming_blocks_find_all_within_radius():
    rng = np.random.default_rng(0)
    texts = [" ".join(map(str, rng.integers(0, 99, 30))) for _ in range(20)]
    index = decontaminate.ItemIndex(list(range(20)), texts)
    prints = index.prints ^ np.bitwise_or.reduce(np.uint64(1) << rng.permuted(np.tile(np.arange(64, dtype=np.uint64), (20, 1)), axis=1)[:, : decontaminate.RADIUS], axis=1)
    found = {tuple(map(int, p)) for p in index.candidates(prints, 26)}
    assert found == {(w, i) for w in range(20) for i in range(20) if int(prints[w] ^ index.prints[i]).bit_count() <= decontaminate.RADIUS}


def test_language(spark, empty):
    rnd = random.Random(5)
    syllables = {"aa": ["ka", "mo", "ri", "tu"], "bb": ["sch", "eng", "orf", "ult"]}
    make = lambda g: " ".join("".join(rnd.choice(syllables[g]) for _ in range(rnd.randint(2, 4))) for _ in range(rnd.randint(5, 90)))
    rows = [(k, make("aa" if k % 2 else "bb"), "aa" if k % 2 else "bb") for k in range(300)] + [(900, None, "aa"), (901, "12 34 !!", "aa"), (902, "", None), (None, make("aa"), "aa")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    out = language_crf.identify(docs, language_crf.fit(docs)).collect()
    held = [r for r in out if r["held_out"]]
    assert all(r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in out)
    truth = {k: g for k, _, g in rows}
    assert np.mean([truth[r["doc_id"]] == r["lang_pred"] for r in held if r["doc_id"] < 900]) > 0.98
    assert {r["doc_id"] for r in out if r["lang_pred"] == "und"} == {900, 901, 902} and all(0 <= r["score"] <= 1 for r in out)
    model = language_crf.fit(docs)
    first, probs = model.label_words(pa.array([make("aa") + " " + make("bb")]))
    assert probs[0].argmax() == 0 and probs[-1].argmax() == 1
    assert model.steps[0, 1] > -3.9 and model.steps[1, 0] > -3.9  # changes of language are seen in learning
    mixed = [make("aa" if k % 2 else "bb").split(" ")[:6] for k in range(40)]
    first, probs = model.label_words(pa.array([" ".join(w for part in mixed for w in part)]))
    assert np.mean(probs.argmax(1) == np.repeat([0 if k % 2 else 1 for k in range(40)], [len(p) for p in mixed])) > 0.95
    long = make("aa") * 3000
    odd = spark.createDataFrame([(1, long, "aa", 5), (1, long, "aa", 5)], "doc_id long, text string, held_out string, lang_pred long")
    twice = language_crf.identify(odd, model).collect()
    assert [r["lang_pred"] for r in twice] == ["aa", "aa"] and twice[0]["score"] == twice[1]["score"]
    assert language_crf.identify(empty, language_crf.fit(empty)).count() == 0


def test_all_of_many_languages_are_learned(spark):
    rnd = random.Random(11)
    names = [f"l{k:02d}" for k in range(66)]
    lexicon = {g: [words(rnd, 1) + g for _ in range(6)] for g in names}
    make = lambda g: " ".join(rnd.choice(lexicon[g]) for _ in range(20))
    rows = [(100 * k + i, make(g), g) for k, g in enumerate(names) for i in range(12 if k < 64 else 9)]
    model = language_crf.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert model.labels == names
    assert model.predict(pa.array([make(g) for g in names]))[0] == names


def test_forward_backward_across_segments():
    rng = np.random.default_rng(3)
    emit, step = rng.random((150, 3)) + 0.01, rng.random((3, 3)) + 0.1
    first = np.array([0, 1, 1, 100, 150])
    got, expected = language_crf.Chain(first).marginals(emit, step, pairs=True)
    total = np.zeros((3, 3))
    for a, b in zip(first[:-1], first[1:], strict=True):
        f, m = [], np.full(3, 1 / 3)
        for t in range(a, b):
            f.append(m)
            m = (m @ step) * emit[t]
            m /= m.sum()
        back = np.ones(3)
        for t in range(b - 1, a - 1, -1):
            p = (f[t - a] @ step) * emit[t] * back
            assert np.allclose(got[t], p / p.sum())
            j = f[t - a][:, None] * step * (emit[t] * back)
            total += j / j.sum()
            back = step @ (emit[t] * back)
            back /= back.sum()
    assert np.allclose(expected, total)


def test_quality(spark, empty):
    rnd = random.Random(6)
    rows, labels = [], []
    for k in range(400):
        good, toxic = k % 3 > 0, k % 7 == 0
        t = words(rnd, 60) if good else "BUY!! NOW$$ " * 30
        rows.append((k, t + (" vile scumbag " if toxic else "") + words(rnd, 5), f"h{k % 4}/p{k % 8}" if k % 11 else None))
        if k % 2 == 0:
            labels.append((k, int(good), int(toxic)))
    rows += [(900, None, "new"), (901, "", "h0")]
    docs = spark.createDataFrame([(*r, 1.0) for r in rows], "doc_id long, text string, source string, good double")
    lab = spark.createDataFrame([*labels, (5000, 1, 0), (1, None, None)], "doc_id long, quality int, toxic int")
    out = {r["doc_id"]: r for r in quality.quality(docs, lab).collect()}
    wrong = [k for k in range(400) if out[k]["kept"] != (k % 3 > 0 and k % 7 > 0)]
    assert len(out) == 402 and len(wrong) <= 6 and not out[900]["kept"] and not out[901]["kept"]
    assert quality.filter_quality(docs, lab).columns == docs.columns
    assert quality.quality(docs.where("doc_id < 0"), lab).count() == 0
    assert quality.quality(docs, lab.limit(0)).count() == 402
    rows = quality.with_evidence(quality.scored(docs, quality.fit(docs, lab)), lab)
    assert quality.Sites(rows).table.where("path = 'h0/p0'").count() == 1
    again = docs.unionByName(docs.where("doc_id < 3")).unionByName(docs.where("doc_id = 1").select(F.lit(None).cast("long").alias("doc_id"), F.repeat("text", 8000).alias("text"), "source", "good"))
    more = quality.quality(again, lab).collect()
    assert len(more) == 406 and sum(r["doc_id"] == 2 for r in more) == 2


def site_shifts_brute(rows):
    """What each row's site adds to its log-odds, in plain Python. rows: (path, host, w, g)."""
    m = min(1 - 1e-4, max(1e-4, sum(r[3] for r in rows) / sum(r[2] for r in rows)))

    def spread(groups):  # (weight, good, rate above)
        s = sum(w * (g / w - above) ** 2 for w, g, above in groups)
        v = max(1e-6, (s - m * (1 - m) * len(groups)) / sum(w for w, _, _ in groups))
        return min(1e4, max(10.0, m * (1 - m) / v - 1))

    total = lambda keep: (sum(r[2] for r in rows if keep(r)), sum(r[3] for r in rows if keep(r)))
    hosts, paths = {h: total(lambda r, h=h: r[1] == h) for _, h, _, _ in rows}, {p: total(lambda r, p=p: r[0] == p) for p, _, _, _ in rows}
    host_weight = spread([(w, g, m) for w, g in hosts.values()])
    above = {p: (hosts[h][1] - paths[p][1] + m * host_weight) / (hosts[h][0] - paths[p][0] + host_weight) for p, h, _, _ in rows}
    path_weight = spread([(w, g, above[p]) for p, (w, g) in paths.items()])
    logit = lambda p: np.log(p / (1 - p))
    return [logit(min(1 - 1e-4, max(1e-4, (paths[p][1] - g + above[p] * path_weight) / (paths[p][0] - w + path_weight)))) - logit(m) for p, _, w, g in rows]


def test_site_evidence_against_brute_force(spark):
    rnd = random.Random(21)
    rows = []
    for k in range(300):
        host = f"h{rnd.randint(0, 9)}.example"
        path = f"{host}/{rnd.choice('abc')}" if rnd.random() < 0.8 else host
        rows.append((k, f"https://{path}/x" if "/" in path else path, path, host, rnd.gauss(float(host[1]) - 4, 1), rnd.gauss(-1, 1)))
    labels = {k: (int(rnd.random() < 0.5), int(rnd.random() < 0.2)) for k in range(0, 300, 3)}
    scores = spark.createDataFrame([(k, s, 0, g, b) for k, s, _, _, g, b in rows], "doc_id long, source string, mark long, good double, bad double")
    given = quality.with_evidence(scores, spark.createDataFrame([(k, *v) for k, v in labels.items()], "doc_id long, quality int, toxic int"))
    got = {r["doc_id"]: r for r in quality.with_sites(given, quality.Sites(given)).collect()}
    sig = lambda x: 1 / (1 + np.exp(-x))
    for at, column in ((0, "good_shift"), (1, "bad_shift")):
        own = [(p, h, 1.0 if k in labels else 0.25, float(labels[k][at]) if k in labels else 0.25 * sig((g, b)[at])) for k, _, p, h, g, b in rows]
        assert np.allclose([got[k][column] for k in range(300)], site_shifts_brute(own))


def test_sites_of_urls(spark):
    sources = [f"{scheme}{host}/{path}" for scheme in ("https://", "http://", "//", "") for host in ("good.example", "bad.example:8080") for path in ("p/1?q=a//b", "p/2", "r/1")] + ["https://alone.example", "src0", ""]
    rows = [(k, sources[k % len(sources)], 0.0, 0.0) for k in range(540)]
    labels = [(k, int("good" in s), int("bad" in s)) for k, s, *_ in rows if "example/" in s or ":8080" in s]
    scores = spark.createDataFrame(rows, "doc_id long, source string, good double, bad double")
    given = quality.with_evidence(scores.withColumn("mark", F.lit(0)), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    sites = quality.Sites(given)
    out = {r["path"]: r for r in sites.table.collect()}
    assert out.keys() == {"good.example/p", "good.example/r", "bad.example:8080/p", "bad.example:8080/r", "alone.example", "src0", ""}
    assert [out[p]["n"] for p in ("good.example/p", "good.example/r", "alone.example")] == [160, 80, 20]
    found = quality.with_sites(given, sites).collect()
    assert len(found) == 540
    assert all((r["good_shift"] > 0.5 and r["bad_shift"] < -0.5) if "good" in r["path"] else (r["good_shift"] < -0.5 and r["bad_shift"] > 0.5) for r in found if "/" in r["path"])


def test_filters_with_clashing_names_and_empty_tables(spark, docs, empty):
    labels = spark.createDataFrame([(20, 1, 0), (60, 0, 0), (21, 1, 0), (61, 0, 0)], "doc_id long, quality int, toxic int")
    bench = spark.createDataFrame([(1, docs.where("doc_id = 63").first()["text"][:400])], "item_id long, text string")
    for f in (exact_dedup.exact_dedup, near_dedup.near_dedup, lambda d: quality.filter_quality(d, labels), lambda d: decontaminate.decontaminate(d, bench)):
        left = f(docs)
        assert left.columns == docs.columns and 0 < left.count() < docs.count()
        assert left.where("_sha = 's' AND `row` = 'r' AND _gone <=> doc_id").count() == left.count()
        assert f(empty).count() == 0


def as_text(rows):
    return sorted(tuple(str(v) for v in r) for r in rows)


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_queries_against_sql(spark, name):
    d = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in ("documents", "benchmark", "pages"):
        con.execute(f"create view {t} as select * from read_parquet('{d}/{t}.parquet')")
    got = queries.queries()[name](spark, d)
    assert as_text(got.collect()) == as_text(con.execute(f"select {', '.join(got.columns)} from ({queries.oracle_sql()[name]})").fetchall())


def test_pipeline(spark):
    """Each stage after the classifier against SQL or the library on the very rows that the stage before it kept."""
    import corpus_pipeline
    from tokenizers import Tokenizer

    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "exact_dedup", "near_dedup", "decontamination", "bpe"]
    d = "/root/testdata/sf0.001"
    docs, rows = shared.documents(spark, d), [shared.documents(spark, d).count()]
    gone = {
        "exact_dedup": f"select doc_id from ({exact_dedup.ORACLE}) where not kept", "near_dedup": f"select doc_id from ({near_dedup.ORACLE}) where not kept",
        "decontamination": f"select doc_id from ({decontaminate.ORACLE})",
    }
    for name, f in corpus_pipeline.STAGES[:-1]:
        con = duckdb.connect()
        con.register("documents", docs.toArrow())
        con.execute(f"create view benchmark as select * from read_parquet('{d}/benchmark.parquet')")
        docs = shared.stage(f(spark, docs, d), "test")
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        rows.append(docs.count())
        if name in gone:
            assert as_text(docs.collect()) == as_text(con.execute(f"select * from documents where doc_id not in ({gone[name]})").fetchall())
    assert rows == sorted(rows, reverse=True) and rows[0] > rows[1] > rows[2] > 0
    t = Tokenizer.from_file(public_tokenizers.path(WORD))
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    encoded = [(i, t.encode(x or "", add_special_tokens=False).ids) for i, x in docs.select("doc_id", "text").collect()]
    wanted = [(i, len(ids), sha(" ".join(map(str, ids))), sha(t.decode(ids, skip_special_tokens=False))) for i, ids in encoded]
    assert as_text(corpus_pipeline.run(spark, d).collect()) == as_text(wanted)
