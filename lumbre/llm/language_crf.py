"""Language identification by a linear-chain conditional random field over words.

Each word has features: itself (a lexicon, by hash), its beginnings and endings of one to three bytes and its byte bigrams and trigrams. Their weights and the weights of
transitions between neighbouring labels are learned together by gradient steps on the sequence likelihood; forward-backward gives the
gradient and, in use, the probability of every label for each word, so that code-switched texts have their words labelled one by one.
Transitions between languages are learned from spliced texts: parts of learned documents of different languages, one after the other.
A text's language is the label with the largest mean probability over its words, and that mean is the score.

Forward-backward runs over segments of SEGMENT words side by side: products of the steps' matrices carry the messages across segments,
so the result is that of the whole chain, however long a text is.

Nulls: a null text, or one without a letter, is `und` with score 0; a null id is never held out nor learned from. Repeated rows: each has its result. Empty table
or no labelled rows: all `und`. Ties: the first label in alphabetical order. Very long texts: labelled whole. Clashing names: only id, text and (to learn) lang are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import as_rows, column
from .textkernel import FOLDED, U, chunks, mix, span_hashes, text_bytes, word_spans

#: Documents to learn from for each language at most (chosen by a hash of the id), and the most bytes that one may have.
TRAIN_DOCS, TRAIN_BYTES = 250, 20_000
#: Buckets of hashed features.
BUCKETS = 1 << 16
SEGMENT = 32
ROUNDS, RATE, RIDGE = 12, 0.35, 1e-4
#: One in so many learned documents is also part of a spliced text, in parts of this many words.
SPLICED, PART = 4, 12
NOT_LETTER = np.ones(256, bool)
NOT_LETTER[[39, *range(65, 91), *range(97, 123), *range(128, 256)]] = False


def word_features(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(word, bucket) of every feature of the words in the spans."""
    t = FOLDED[data]
    size = ends - starts
    rows = np.arange(len(starts))
    word, key = [rows], [hashes]
    for k in (1, 2, 3):
        ok = rows[size >= k]
        for kind, base in ((2 * k, starts[ok]), (2 * k + 1, ends[ok] - k)):
            h = np.full(len(ok), U(kind * 0x9E3779B97F4A7C15 % 2**64))
            for j in range(k):
                h = (h ^ t[base + j]) * U(0x100000001B3)
            word.append(ok)
            key.append(h)
    for k in (2, 3):
        n = np.maximum(0, size - k + 1)
        owner = np.repeat(rows, n)
        at = np.repeat(starts - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
        h = np.full(len(at), U((50 + k) * 0x9E3779B97F4A7C15 % 2**64))
        for j in range(k):
            h = (h ^ t[at + j]) * U(0x100000001B3)
        word.append(owner)
        key.append(h)
    return np.concatenate(word), (mix(np.concatenate(key)) >> U(48)).astype(np.int64)


class Chain:
    """The words of a batch of texts cut into segments of SEGMENT; padding steps don't change a message."""

    def __init__(self, first: np.ndarray):
        words = np.diff(first)
        self.segments = -(-words // SEGMENT)
        self.bounds = np.concatenate([[0], np.cumsum(self.segments)])
        owner = np.repeat(np.arange(len(words)), self.segments)
        begin = first[:-1][owner] + SEGMENT * (np.arange(len(owner)) - self.bounds[owner])
        at = begin[:, None] + np.arange(SEGMENT)
        self.real = at < first[1:][owner][:, None]
        self.at = np.where(self.real, at, 0)

    def marginals(self, emit: np.ndarray, step: np.ndarray, pairs: bool = False) -> tuple[np.ndarray, np.ndarray | None]:
        """Label probabilities of each word, and the expected number of each transition. emit: word by label, positive; step: label by label, positive."""
        n, k = len(self.at), emit.shape[1]
        out = np.zeros_like(emit)
        if not n:
            return out, np.zeros((k, k))
        e = emit[self.at]
        # What each segment does to a message from the left: a row vector times the product of (step, emission) matrices.
        whole = np.broadcast_to(np.eye(k, dtype=emit.dtype), (n, k, k)).copy()
        for s in range(SEGMENT):
            live = self.real[:, s]
            new = (whole[live] @ step) * e[live, s][:, None, :]
            whole[live] = new / new.sum((1, 2), keepdims=True)
        left = np.empty((n, k), emit.dtype)
        right = np.empty((n, k), emit.dtype)
        most = int(self.segments.max())
        order = np.argsort(-self.segments, kind="stable")
        lengths = self.segments[order]
        message = np.full((len(order), k), 1 / k, emit.dtype)
        for s in range(most):  # over all texts that have so many segments, side by side
            live = int(np.searchsorted(-lengths, -s, "left"))
            at = self.bounds[order[:live]] + s
            left[at] = message[:live]
            m = np.einsum("nk,nkl->nl", message[:live], whole[at])
            message[:live] = m / m.sum(1, keepdims=True)
        message = np.ones((len(order), k), emit.dtype)
        for s in range(most):
            live = int(np.searchsorted(-lengths, -s, "left"))
            at = self.bounds[order[:live] + 1] - 1 - s
            right[at] = message[:live]
            m = np.einsum("nkl,nl->nk", whole[at], message[:live])
            message[:live] = m / m.sum(1, keepdims=True)
        forward = np.empty((SEGMENT, n, k), emit.dtype)
        now = left
        for s in range(SEGMENT):
            forward[s] = now
            new = (now @ step) * e[:, s]
            new /= new.sum(1, keepdims=True)
            now = np.where(self.real[:, s, None], new, now)
        expected = np.zeros((k, k))
        now = right
        for s in range(SEGMENT - 1, -1, -1):
            live = np.flatnonzero(self.real[:, s])
            both = (forward[s][live] @ step) * e[live, s] * now[live]
            out[self.at[live, s]] = both / both.sum(1, keepdims=True)
            if pairs:
                joint = forward[s][live][:, :, None] * step * (e[live, s] * now[live])[:, None, :]
                expected += (joint / joint.sum((1, 2), keepdims=True)).sum(0)
            new = (e[live, s] * now[live]) @ step.T
            now = now.copy()
            now[live] = new / new.sum(1, keepdims=True)
        return out, expected


class LanguageCrf:
    def __init__(self, labels: list[str]):
        self.labels = labels
        self.weights = np.zeros((BUCKETS, len(labels)), np.float32)
        self.steps = np.zeros((len(labels), len(labels)))

    def words(self, array: pa.Array) -> tuple[np.ndarray, np.ndarray, tuple[np.ndarray, np.ndarray], np.ndarray]:
        """First word of each text, each word's number among the distinct ones, and those' features and counts."""
        data, offsets = text_bytes(array)
        starts, ends, first = word_spans(data, offsets, NOT_LETTER)
        h = span_hashes(data, starts, ends)
        _, at, inverse, counts = np.unique(h, return_index=True, return_inverse=True, return_counts=True)
        return first, inverse, word_features(data, starts[at], ends[at], h[at]), counts

    def emissions(self, features: tuple[np.ndarray, np.ndarray], n: int) -> np.ndarray:
        word, bucket = features
        order = np.argsort(word, kind="stable")
        sums = np.add.reduceat(self.weights[bucket[order]], np.searchsorted(word[order], np.arange(n)), axis=0) if n else np.zeros((0, len(self.labels)), np.float32)
        return np.exp(np.maximum(sums - sums.max(1, keepdims=True), -30)).astype(np.float64)

    def fit(self, texts: list[list[tuple[str, int]]]) -> None:
        """Learn from texts, each a list of parts with the number of their label."""
        first, inverse, features, counts = self.words(pa.array([" ".join(t for t, _ in parts) for parts in texts], pa.large_string()))
        k, n = len(self.labels), len(counts)
        pieces = [word_spans(*text_bytes(pa.array([t for t, _ in parts], pa.large_string())), NOT_LETTER)[2] for parts in texts]
        label = np.repeat([g for parts in texts for _, g in parts], np.concatenate([np.diff(x) for x in pieces]))
        chain = Chain(first)
        wanted = np.stack([np.bincount(inverse[label == c], minlength=n) for c in range(k)], 1).astype(float)
        word, bucket = features
        moves = np.zeros((k, k))
        inner = np.ones(len(label), bool)
        inner[first[:-1][np.diff(first) > 0]] = False
        np.add.at(moves, (label[inner], label[inner]), 1)
        total = max(1, len(label))
        square, square_steps = np.full((BUCKETS, k), 1e-8), np.full((k, k), 1e-8)
        for _ in range(ROUNDS):
            probs, expected = chain.marginals(self.emissions(features, n)[inverse], np.exp(self.steps), pairs=True)
            got = np.stack([np.bincount(inverse, probs[:, c], n) for c in range(k)], 1)
            gap = (wanted - got) / total
            grad = np.stack([np.bincount(bucket, gap[word, c], BUCKETS) for c in range(k)], 1) - RIDGE * self.weights / BUCKETS
            square += grad**2
            self.weights += (RATE * grad / np.sqrt(square)).astype(np.float32)
            # The chain's first step comes from an even message; it is in expected but isn't a transition.
            grad_steps = (moves - expected * (inner.sum() / total)) / total - RIDGE * self.steps
            square_steps += grad_steps**2
            self.steps = np.clip(self.steps + RATE * grad_steps / np.sqrt(square_steps), -4, 4)

    def label_words(self, array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The first word of each text and the label probabilities of each word."""
        first, inverse, features, counts = self.words(array)
        emit = self.emissions(features, len(counts))[inverse]
        return first, Chain(first).marginals(emit, np.exp(self.steps))[0]

    def predict(self, array: pa.Array) -> tuple[list[str], np.ndarray]:
        if not self.labels:
            return ["und"] * len(array), np.zeros(len(array))
        first, probs = self.label_words(array)
        n = np.diff(first)
        sums = np.concatenate([np.zeros((1, len(self.labels))), np.cumsum(probs, 0)])[first]
        mean = np.diff(sums, axis=0) / np.maximum(1, n)[:, None]
        best = mean.argmax(1)
        texts = array.to_pylist()
        lettered = [w > 0 and any(c.isalpha() for c in t or "") for w, t in zip(n, texts, strict=True)]
        pred = [self.labels[b] if ok else "und" for b, ok in zip(best, lettered, strict=True)]
        return pred, np.where(lettered, np.clip(mean.max(1), 0, 1), 0.0)


def spliced(texts: list[str], gold: list[int]) -> list[list[tuple[str, int]]]:
    """Parts of some texts and of their next neighbours of another language in turn."""
    out = []
    for i in range(0, len(texts), SPLICED):
        j = next((k % len(texts) for k in range(i + 1, i + len(texts)) if gold[k % len(texts)] != gold[i]), None)
        if j is not None:
            a, b = texts[i].split(), texts[j].split()
            parts = [(" ".join(w[at : at + PART]), g) for at in range(0, max(len(a), len(b)), PART) for w, g in ((a, gold[i]), (b, gold[j])) if at < len(w)]
            out.append(parts[:20])
    return out


def held_out(doc_id: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def fit(docs: DataFrame, train_docs: int = TRAIN_DOCS) -> LanguageCrf:
    """Learn every language, from a bounded sample of each one's labelled rows that aren't held out."""
    known = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.col("lang").cast("string").alias("lang")).where(F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & ~held_out() & F.col("text").isNotNull())
    counts = known.groupBy("lang").count().collect()
    labels = sorted(r["lang"] for r in counts)
    model = LanguageCrf(labels)
    if not labels:
        return model
    share = F.create_map(*[F.lit(x) for r in counts for x in (r["lang"], int(min(1.0, train_docs / r["count"]) * (1 << 30)))])
    rows = known.where((F.octet_length("text") <= TRAIN_BYTES) & (F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(1 << 30)) < F.try_element_at(share, F.col("lang")))).limit(2 * train_docs * len(labels)).collect()
    rows.sort(key=lambda r: (r["doc_id"], r["text"]))
    if rows:
        texts, gold = [r["text"] for r in rows], [labels.index(r["lang"]) for r in rows]
        model.fit([*([pair] for pair in zip(texts, gold, strict=True)), *spliced(texts, gold)])
    return model


def identify(docs: DataFrame, model: LanguageCrf) -> DataFrame:
    """doc_id, held_out, lang_pred, score. Only the texts are looked at."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch):
                pred, score = model.predict(column(part, "text"))
                yield pa.RecordBatch.from_arrays([column(part, "doc_id"), column(part, "held_out"), pa.array(pred, pa.string()), pa.array(score)], ["doc_id", "held_out", "lang_pred", "score"])

    return as_rows(docs).withColumn("held_out", held_out()).mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")
