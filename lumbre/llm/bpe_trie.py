"""BPE encoding and decoding by a traversal of a trie of the distinct words.

The tokens of every prefix of an encoding are the encoding of that prefix, so the last token of each
prefix holds the whole encoding: the rest is that of the prefix without it. Words are put into a trie and a
depth-first walk gives each node the last token of its prefix, from those of the nodes above; words that share a
prefix share that work. A candidate token fits behind the token before it if no merge across the two would have come first.

Nulls: a null text is empty and gives no token. Empty table: no rows. Repeated rows: each row has its own result. Very long texts: encoded whole. Ties: none, each text has
one encoding. Clashing names: only the id and the text are read.
Special tokens in a text are matched as the tokenizers library does by default, before anything else.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import as_rows, column

#: Words that a worker remembers, and the letters of these and of their tokens; then it forgets all and starts anew.
REMEMBER, REMEMBER_LETTERS = 450_000, 48 << 20
#: Pairs of tokens and steps of the trie that a worker remembers, about 160 and 400 bytes each.
PAIRS, STEPS = 500_000, 200_000
#: Beyond these letters, the library's own normalizer and splitter are used: its Unicode tables are of another version.
RARE = re.compile("[\u0530-\U0010ffff\x00]")


def byte_letters() -> list[str]:
    """The letter that stands for each byte in byte-level vocabularies: printable Latin-1 stands for itself, the rest for what follows U+0100."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    out, spare = [], 0x100
    for b in range(256):
        out.append(chr(b if b in plain else spare))
        spare += b not in plain
    return out


def simple_pattern(pattern: str) -> re.Pattern:
    """A splitter's pattern for the standard engine, which is faster, with letters, numbers and white space below U+0530 spelled out. \\p{L}, \\p{N} and \\s must stand in brackets."""
    kinds = {c: unicodedata.category(chr(c))[0] for c in range(0x530)}

    def spelled(kind: str) -> str:
        parts, at = [], 0
        while at < 0x530:
            to = at
            while to < 0x530 and kinds[to] == kind:
                to += 1
            if to > at:
                parts.append(re.escape(chr(at)) + "-" + re.escape(chr(to - 1)))
            at = max(to, at + 1)
        return "".join(parts)

    white = "\\t\\n\\x0b\\x0c\\r \\x85\\xa0"  # without 1C to 1F, as in the library's engine
    return re.compile(pattern.replace(r"\p{L}", spelled("L")).replace(r"\p{N}", spelled("N")).replace(r"\s", white))


class TrieBpe:
    """A BPE vocabulary with one merge for each token that isn't a single letter."""

    def __init__(self, spec: dict):
        model = spec["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.end: str = model.get("end_of_word_suffix") or ""
        self.merge: dict[tuple[int, int], int] = {}
        self.parts: dict[int, tuple[int, int]] = {}
        for rank, pair in enumerate(model["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            left, right = self.vocab[a], self.vocab[b]
            joined = self.vocab[(a[: -len(self.end)] if self.end and a.endswith(self.end) else a) + b]
            self.merge[left, right] = rank
            self.parts[joined] = (left, right)
        self.rank = {t: self.merge[p] for t, p in self.parts.items()}
        bare = lambda s: s[: -len(self.end)] if self.end and s.endswith(self.end) and len(s) > len(self.end) else s
        self.letters = {t: len(bare(s)) for s, t in self.vocab.items()}
        #: What tokens begin with; the letters read so far are remembered as the longest end that is one of these.
        self.beginnings = {bare(s)[:k] for s in self.vocab for k in range(len(bare(s)) + 1)}
        self.steps: dict[tuple[str, str, bool], tuple[str, list[tuple[int, int]]]] = {}
        self.strings = {t: s for s, t in self.vocab.items()}
        self.known: dict[tuple[int, int], bool] = {}
        #: Tokens whose own letters are encoded as this token.
        self.alone = {t for t in self.letters if t not in self.parts}
        for token in sorted(self.parts, key=self.rank.__getitem__):
            left, right = self.parts[token]
            if left in self.alone and right in self.alone and self.fits(left, right, self.rank[token]):
                self.alone.add(token)

    def fits(self, left: int, right: int, before: int | None = None) -> bool:
        """Whether the encoding of the two tokens' letters keeps them apart until merge number before (ever, if None).

        The merges along the seam are undone from the latest: the one made last is undone first, and whatever then meets
        at the seam must not have a merge that comes before the one just undone.
        """
        limit = len(self.merge) if before is None else before
        rank, parts, merge = self.rank, self.parts, self.merge
        while True:
            across = merge.get((left, right), limit)
            if across < limit:
                return False
            a, b = rank.get(left, -1), rank.get(right, -1)
            if a < 0 and b < 0:
                return True
            # On equal footing the merge to the left is made first, so a seam merge of the same number as the right part's comes before it.
            if a >= b:
                limit = min(limit, a)
                left = parts[left][1]
            else:
                limit = min(limit, b + 1)
                right = parts[right][0]

    def beside(self, left: int, right: int) -> bool:
        if (known := self.known.get((left, right))) is None:
            if len(self.known) >= PAIRS:
                self.known.clear()
            known = self.known[left, right] = self.fits(left, right)
        return known

    def step(self, state: str, letter: str, end: bool) -> tuple[str, list[tuple[int, int]]]:
        """After one more letter: the longest end of the letters so far that begins a token, and the tokens (with their lengths) that end here, longest first."""
        state += letter
        while state not in self.beginnings:
            state = state[1:]
        mark = self.end if end else ""
        tokens = [(self.vocab.get(state[i:] + mark), len(state) - i) for i in range(len(state))]
        return state, [(t, n) for t, n in tokens if t in self.alone]

    def last(self, fitting: list[tuple[int, int]], last_of: list[int], depth: int) -> int:
        """The one of the tokens that end at this depth that fits behind the encoding of what is before it."""
        known = self.known
        for token, size in fitting:
            if size == depth:
                return token
            before = last_of[depth - size]
            if known.get((before, token)) or (before, token) not in known and self.beside(before, token):
                return token
        raise ValueError("no token ends here")

    def encode_words(self, words: Iterator[str]) -> dict[str, list[int]]:
        """The tokens of every word. words: different, none empty, in byte letters."""
        root: dict = {}
        for word in words:
            node = root
            for letter in word[:-1]:
                if (below := node.get(letter)) is None:
                    below = node[letter] = {}
                node = below
            node.setdefault("", []).append(word)
        out: dict[str, list[int]] = {}
        last_of: list[int] = [0] * 16
        steps, letters, last = self.steps, self.letters, self.last
        stack = [(root, 0, "", "")]
        while stack:
            node, depth, state, letter = stack.pop()
            if depth:
                if (found := steps.get((state, letter, False))) is None:
                    if len(steps) >= STEPS:
                        steps.clear()
                    found = steps[state, letter, False] = self.step(state, letter, False)
                state = found[0]
                if depth >= len(last_of):
                    last_of += [0] * depth
                last_of[depth] = last(found[1], last_of, depth)
            for letter, below in node.items():
                if letter:
                    stack.append((below, depth + 1, state, letter))
                    continue
                for word in below:
                    if (found := steps.get((state, word[-1], True))) is None:
                        if len(steps) >= STEPS:
                            steps.clear()
                        found = steps[state, word[-1], True] = self.step(state, word[-1], True)
                    tokens = [last(found[1], last_of, depth + 1)]
                    at = depth + 1 - letters[tokens[0]]
                    while at:
                        tokens.append(last_of[at])
                        at -= letters[tokens[-1]]
                    tokens.reverse()
                    out[word] = tokens
        return out


def fold_case(text: str) -> str:
    """NFC, then lower case letter by letter, as the vocabulary's normalizer does (no special final sigma)."""
    if text.isascii():
        return text.lower()
    return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()


class WordTokenizer:
    """Encodes and decodes whole texts with a word-end vocabulary file, remembering the strings of words it has met."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.library = Tokenizer.from_file(path)
        self.bpe = TrieBpe(spec)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        split = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.words = simple_pattern(split)
        self.specials = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self.byte_letter = {bytes([b]): c for b, c in enumerate(byte_letters())}
        self.table = str.maketrans({b: c for b, c in enumerate(byte_letters())})
        self.numbers = {t: str(t) for t in self.bpe.strings}
        self.ids: dict[str, str] = {}
        self.tokens: dict[str, str] = {}
        self.held = 0

    def plain(self, text: str) -> list[str]:
        """The words of a text without special tokens. A word in byte letters is marked by a leading NUL."""
        if text.isascii() and "\0" not in text:
            return self.words.findall(text.lower())
        if not RARE.search(text) and not RARE.search(folded := fold_case(text)):
            return self.words.findall(folded)
        normal = self.library.normalizer.normalize_str(text)
        return ["\0" + w for w, _ in self.library.pre_tokenizer.pre_tokenize_str(normal)]

    def learn(self, words: set[str]) -> None:
        spell = lambda w: w if w.isascii() and w.isalnum() else w[1:] if w[0] == "\0" else w.encode("utf-8", "surrogatepass").decode("latin-1").translate(self.table)
        numbers, letters = self.numbers, self.bpe.strings
        new: dict[str, list[str]] = {}
        for w in words:
            new.setdefault(spell(w), []).append(w)
        for spelled, tokens in self.bpe.encode_words(iter(new)).items():
            ids, strings = " ".join([numbers[t] for t in tokens]), " ".join([letters[t] for t in tokens])
            for word in new[spelled]:
                self.ids[word], self.tokens[word] = ids, strings
                self.held += len(word) + len(ids) + len(strings)

    def split(self, text: str) -> list[str]:
        """The words of a text; special tokens stand for themselves."""
        if self.specials is None or not any(s in text for s in self.special):
            return self.plain(text)
        out: list[str] = []
        for k, part in enumerate(self.specials.split(text)):
            out += [part] if k % 2 else self.plain(part)
        return out

    def batch(self, texts: list[str]) -> Iterator[tuple[str, str, int]]:
        """(ids joined by spaces, decoded text, number of tokens) of each text."""
        if len(self.ids) > REMEMBER or self.held > REMEMBER_LETTERS:
            self.ids.clear()
            self.tokens.clear()
            self.held = 0
        for s, i in self.special.items():
            self.ids[s], self.tokens[s] = str(i), s
        split = [self.split(t) for t in texts]
        new: set[str] = set()
        for words in split:
            new.update(words)
        self.learn({w for w in new if w not in self.ids})
        for words in split:
            ids = " ".join(map(self.ids.__getitem__, words))
            yield ids, " ".join(map(self.tokens.__getitem__, words)), ids.count(" ") + bool(ids)


@lru_cache(maxsize=2)
def word_tokenizer(path: str) -> WordTokenizer:
    return WordTokenizer(path)


def text_slices(batch: pa.RecordBatch, size: int = 2 << 20) -> Iterator[tuple[list, list[str]]]:
    ids, texts, held = [], [], 0
    for doc_id, text in zip(column(batch, "doc_id").to_pylist(), column(batch, "text"), strict=True):
        ids.append(doc_id)
        texts.append(text.as_py() or "")
        held += len(texts[-1])
        if held >= size:
            yield ids, texts
            ids, texts, held = [], [], 0
    if ids:
        yield ids, texts


def encode_decode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", digests: bool = True) -> DataFrame:
    """doc_id, n_tokens and the ids joined by spaces and the decoded text, or (digests) the SHA-256 of both."""
    names = ["ids_sha256", "decoded_sha256"] if digests else ["ids", "decoded"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = word_tokenizer(path)
        for batch in batches:
            for doc_ids, texts in text_slices(batch):
                n, a, b = [], [], []
                for ids, decoded, count in tokenizer.batch(texts):
                    n.append(count)
                    a.append(hashlib.sha256(ids.encode()).hexdigest() if digests else ids)
                    b.append(hashlib.sha256(decoded.encode()).hexdigest() if digests else decoded)
                yield pa.RecordBatch.from_arrays([pa.array(doc_ids, pa.int64()), pa.array(n, pa.int64()), pa.array(a, pa.string()), pa.array(b, pa.string())], ["doc_id", "n_tokens", *names])

    return as_rows(docs, id_col, text_col).mapInArrow(run, f"doc_id long, n_tokens long, {names[0]} string, {names[1]} string")
