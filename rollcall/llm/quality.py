"""Document quality by a linear-chain conditional random field over lines.

Each non-blank line is labelled good or bad from features of itself and of the lines before and after
it, and from its neighbours' labels. A document's score is the mean of its lines' marginal probability
of being good, weighted by length.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.llm.words import hash_words, mix, slices, split_words

FEATURES = ("log_size", "letters", "upper", "digits", "marks", "symbols", "bangs", "word_size", "closed", "opened", "long_runs", "repeated", "echoes")
N = len(FEATURES)

# classes of bytes: letters (all bytes of non-ASCII characters are taken as such), capitals, digits, marks of prose, others
_BYTE = np.zeros((6, 256), bool)
_BYTE[0, [*range(65, 91), *range(97, 123), *range(128, 256)]] = True
_BYTE[1, 65:91] = True
_BYTE[2, 48:58] = True
_BYTE[3, [ord(c) for c in ".,;:'\"-?()"]] = True
_BYTE[4, [i for i in range(33, 127) if not (_BYTE[0, i] or _BYTE[2, i] or _BYTE[3, i] or i == 33)]] = True
_BYTE[5, 33] = True
#: The six counts side by side, so that one cumulative sum gives the counts of any stretch.
_CODE = _BYTE.T.astype(np.int32)


def line_features(texts: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(features of each non-blank line, bytes of each, number of them in each text)."""
    plain = pc.fill_null(texts, "").combine_chunks()
    if isinstance(plain, pa.ChunkedArray):
        plain = pa.concat_arrays(plain.chunks) if plain.num_chunks else pa.array([], pa.string())
    lines = pc.split_pattern(plain, "\n")
    doc = np.repeat(np.arange(len(plain)), pc.list_value_length(lines).to_numpy(zero_copy_only=False))
    flat = pc.ascii_trim_whitespace(lines.flatten())
    keep = pc.not_equal(flat, "")
    flat, doc = flat.filter(keep), doc[keep.to_numpy(zero_copy_only=False)]
    count = np.bincount(doc, minlength=len(plain))
    if not len(flat):
        return np.zeros((0, N)), np.zeros(0), count
    at = np.frombuffer(flat.buffers()[1], np.int32)[flat.offset : flat.offset + len(flat) + 1].astype(np.int64)
    data = np.frombuffer(flat.buffers()[2], np.uint8)[at[0] : at[-1]]
    at = at - at[0]
    size = np.diff(at).astype(float)
    sums = [np.add.reduceat(_CODE[:, k][data], at[:-1]) for k in range(6)]
    letters, upper, digits, marks, symbols, bangs = (s / size for s in sums)
    words = np.add.reduceat((data == 32).astype(np.int32), at[:-1]) + 1.0
    first, last = data[at[:-1]], data[at[1:] - 1]
    same = np.zeros(len(data), bool)
    same[2:] = (data[2:] == data[1:-1]) & (data[1:-1] == data[:-2])
    runs = np.add.reduceat(same.astype(np.int32), at[:-1]) / size
    _, inverse, times = np.unique(mix(_line_hash(data, at)) ^ mix(doc.astype(np.uint64) + np.uint64(1)), return_inverse=True, return_counts=True)
    spoken, n = split_words(pa.chunked_array([flat]))
    word, line = hash_words(spoken), np.repeat(np.arange(len(n)), n)
    echo = np.zeros(len(word), bool)  # a word that is one of the two before it
    for k in (1, 2):
        echo[k:] |= (word[k:] == word[:-k]) & (line[k:] == line[:-k])
    echoes = np.bincount(line, echo, len(n)) / np.maximum(n, 1)
    x = np.stack([np.log1p(size) / 4, letters, upper, digits * 4, marks * 8, symbols * 8, bangs * 8, np.minimum(size / words, 40) / 8, np.isin(last, [46, 33, 63, 58, 34]), (first >= 65) & (first < 91), runs * 8, np.minimum(times[inverse] - 1, 5) / 2, echoes * 4], 1)
    return x, size, count


def _line_hash(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    place = (np.arange(len(data)) - np.repeat(at[:-1], np.diff(at))).astype(np.uint64)
    return np.add.reduceat(mix(place * np.uint64(257) + data + np.uint64(1)), at[:-1])


def with_neighbours(x: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Own features, those of the line before and of the line after (0 at a text's ends), ends, 1."""
    before, after = np.zeros_like(x), np.zeros_like(x)
    before[1:], after[:-1] = x[:-1], x[1:]
    end = np.cumsum(count[count > 0])
    first, last = np.zeros(len(x)), np.zeros(len(x))
    first[np.r_[0, end[:-1]]], last[end - 1] = 1, 1
    before[first > 0], after[last > 0] = 0, 0
    return np.concatenate([x, before, after, np.stack([first, last, np.ones(len(x))], 1)], 1)


@dataclass
class Crf:
    """State 1 is a good line. ``weights``: log-odds of state 1 by feature; ``moves[a, b]``: from a to b."""

    weights: np.ndarray
    moves: np.ndarray

    def marginals(self, x: np.ndarray, count: np.ndarray, pairs: bool = False):
        """P(line is good) of each line by forward and backward passes over all texts in step; with
        ``pairs`` also the expected number of each move over all of them."""
        n, total = count[count > 0], len(x)
        order = np.argsort(-n, kind="stable")
        start = (np.cumsum(n) - n)[order]
        n = n[order]
        steps = int(n.max(initial=0))
        active = np.searchsorted(-n, -np.arange(steps), side="left")  # texts longer than t
        odds = np.exp(np.clip(x @ self.weights, -30, 30))
        emit = np.stack([1 / (1 + odds), odds / (1 + odds)], 1)
        move = np.exp(self.moves)
        ahead, back = np.empty((total, 2)), np.ones((total, 2))
        for t in range(steps):
            i = start[: active[t]] + t
            a = emit[i] if t == 0 else emit[i] * (ahead[i - 1] @ move)
            ahead[i] = a / a.sum(1, keepdims=True)
        for t in range(steps - 2, -1, -1):
            i = start[: active[t + 1]] + t
            b = (emit[i + 1] * back[i + 1]) @ move.T
            back[i] = b / b.sum(1, keepdims=True)
        both = ahead * back
        good = both[:, 1] / both.sum(1)
        if not pairs:
            return good
        inner = np.ones(total, bool)
        inner[start] = False
        i = np.flatnonzero(inner)
        joint = ahead[i - 1][:, :, None] * move[None] * (emit[i] * back[i])[:, None, :]
        return good, (joint / joint.sum((1, 2), keepdims=True)).sum(0)


def fit_crf(x: np.ndarray, count: np.ndarray, label: np.ndarray, rounds: int = 200, rate: float = 0.1, l2: float = 1e-3) -> Crf:
    """Maximum conditional likelihood by Adam; the lines of a text all carry the text's label."""
    z, has = with_neighbours(x, count), count > 0
    y = np.repeat(label[has].astype(float), count[has])
    inner = np.ones(len(z), bool)
    inner[np.cumsum(count[has]) - count[has]] = False
    seen = np.array([[np.sum(inner & (y == 0)), 0], [0, np.sum(inner & (y == 1))]], float)
    crf = Crf(np.zeros(z.shape[1]), np.zeros((2, 2)))
    m = v = np.zeros(z.shape[1] + 4)
    share = np.repeat(1.0 / count[has], count[has])  # each text weighs the same, however long
    for k in range(1, rounds + 1):
        good, expected = crf.marginals(z, count, pairs=True)
        g = np.r_[z.T @ ((y - good) * share) / share.sum() - l2 * crf.weights, ((seen - expected) / max(1, inner.sum())).ravel() - 0.05 * crf.moves.ravel()]
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        step = rate * (m / (1 - 0.9**k)) / (np.sqrt(v / (1 - 0.99**k)) + 1e-8) * (1 - k / (rounds + 1))
        crf = Crf(crf.weights + step[:-4], crf.moves + step[-4:].reshape(2, 2))
    return crf


def training_sample(docs: DataFrame, labels: DataFrame, max_rows: int, max_bytes: int) -> DataFrame:
    """At most ``max_rows`` labelled texts (the first by a hash of doc_id) of at most ``max_bytes``
    bytes. This bound is on learning alone; a score reads every text whole."""
    chosen = labels.filter("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.min("quality").alias("y")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    texts = docs.select("doc_id", "text").filter(F.octet_length("text") <= max_bytes)
    return texts.join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "y")


def learn_quality(docs: DataFrame, labels: DataFrame, max_rows: int = 4000, max_bytes: int = 100_000, max_lines: int = 400) -> Crf | None:
    """The field learnt from a bounded sample; None without any labelled line.

    ``labels`` has doc_id and quality (0 or 1; nulls are left out, of several for a document the
    smallest counts). Features are made in the tasks; the driver fits on at most ``max_rows`` documents of
    at most ``max_bytes`` and ``max_lines`` non-blank lines (13 floats each), so on some 80 MB at most.
    Labels are of documents, and a document's lines all carry its label.
    """

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches):
            x, size, count = line_features(piece.column("text"))
            end = np.cumsum(count)
            rows = [x[e - c : e].astype(np.float32).tobytes() if c <= max_lines else None for c, e in zip(count, end, strict=True)]
            yield pa.RecordBatch.from_arrays([piece.column("doc_id").combine_chunks(), pc.cast(piece.column("y"), pa.int32()).combine_chunks(), pa.array(rows, pa.binary())], ["doc_id", "y", "x"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = training_sample(docs, labels, max_rows, max_bytes).mapInArrow(features, f"doc_id {kind}, y int, x binary").filter("x is not null").collect()
    rows = sorted(rows, key=lambda r: r["doc_id"])
    xs = [np.frombuffer(r["x"], np.float32).reshape(-1, N).astype(float) for r in rows]
    if not sum(map(len, xs)):
        return None
    return fit_crf(np.concatenate(xs), np.array([len(x) for x in xs]), np.array([r["y"] for r in rows]))


def text_scores(texts: pa.ChunkedArray, crf: Crf | None) -> np.ndarray:
    x, size, count = line_features(texts)
    good = np.ones(len(x)) if crf is None or not len(x) else crf.marginals(with_neighbours(x, count), count)
    doc = np.repeat(np.arange(len(count)), count)
    mean = np.bincount(doc, size * good, len(count)) / np.maximum(np.bincount(doc, size, len(count)), 1)
    return np.clip(mean, 0, 1)


def score_quality(docs: DataFrame, crf: Crf | None) -> DataFrame:
    """``docs`` columns doc_id and text become doc_id and score, one row per row, nothing shuffled.

    Score: mean of the lines' marginals weighted by their bytes, between 0 and 1. A null, empty or
    blank text has no good line and scores 0. Without a model every text with a line scores 1.
    """

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches):
            scores = pa.array(text_scores(piece.column("text"), crf))
            yield pa.RecordBatch.from_arrays([piece.column("doc_id").combine_chunks(), scores], ["doc_id", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(score, f"doc_id {kind}, score double")


def keep_good(docs: DataFrame, crf: Crf | None, threshold: float) -> DataFrame:
    """The rows of ``docs``, with all their columns, whose text scores ``threshold`` or more."""

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches):
            yield from piece.filter(pa.array(text_scores(piece.column("text"), crf) >= threshold)).to_batches()

    return docs.mapInArrow(keep, docs.schema)


def held_out(doc_id: str = "doc_id"):
    """Rows whose labels are never learnt from."""
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))
