import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from lumbre.llm import token_store

PATH = public_tokenizers.path("byte_bpe_50k.json")


def test_remembered_pieces_are_bounded_by_their_letters(monkeypatch):
    """Few long words are as much memory as many short ones."""
    monkeypatch.setattr(token_store, "REMEMBER_LETTERS", 1000, raising=False)
    mine = token_store.ByteTokenizer(PATH)
    texts = [f"{'abcdefgh'[i % 8] * 300}{'xyz'[i % 3] * i}" for i in range(40)]
    wanted = [[*Tokenizer.from_file(PATH).encode(t, add_special_tokens=False).ids, 0] for t in texts]
    assert [x.tolist() for t in texts for x in mine.batch([t], 0)] == wanted
    assert sum(map(len, mine.known)) + sum(map(len, mine.known.before)) <= 3000


def test_long_texts_are_encoded_in_parts_as_a_whole(monkeypatch):
    monkeypatch.setattr(token_store, "PART", 20)
    mine, library = token_store.ByteTokenizer(PATH), Tokenizer.from_file(PATH)
    rng = np.random.default_rng(5)
    bits = ["don't", "we'll", " ", "  ", "\n", "\n\n ", "\t", "\x1c", "\u00a0", "\u3000", "é", "Ж", "漢字", "\u2019s", "123", "4.5", "<|endoftext|>", "<|end", "!?", "word", "Wort", "\u0301", "🙂", "\r\n"]
    texts = ["".join(rng.choice(bits, 200)) for _ in range(300)] + ["a " * 500, "x" * 500, " " * 500]
    for t, own in zip(texts, mine.batch(texts, 0), strict=True):
        assert own.tolist() == [*library.encode(t, add_special_tokens=False).ids, 0]
        assert "".join(mine.parts(t)) == t
    assert max(len(list(mine.parts(t))) for t in texts) > 10


def test_blocks_of_short_texts_are_bounded(spark):
    """Two bytes of ids a document don't fill a block: its boundaries would take the memory instead."""
    n = 150_000
    docs = spark.range(n).selectExpr("id * 1000003 AS doc_id", "IF(id % 7 = 0, NULL, '') AS text").coalesce(1)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        blocks = token_store.write_tokens(docs, PATH)
        rows = token_store.read_tokens(blocks).selectExpr("count(*)", "count(DISTINCT doc_id)", "min(start)", "max(start)", "sum(n_tokens)", "sum(IF(start = doc_id div 1000003, 1, 0))").first()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert max(token_store.Block(r.block).n for r in blocks.select("block").collect()) <= 1 << 16
    assert tuple(rows) == (n, n, 0, n - 1, n, n)
