"""Runs: stretches of words that repeat with a period at least four times, by Lyndon words.

By the runs theorem every run has a root that is the longest Lyndon word at its place, under one of two
orders of the words, the second being the first reversed. The longest Lyndon word at a place ends where
the next smaller suffix begins, and those are found by one scan from right to left with a stack, under each
order. Suffixes are compared by the length of their longest common extension, which is found by binary search on
rolling hashes; so is how far a root's period reaches to both sides. What is found is held against the
words themselves.

A run of four periods holds each of its words four times or more. So a word that occurs less often in a
stretch is in no run of that stretch and divides it, and most stretches are gone before the scan.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from rollcall.llm.words import mix, slices, split_words

#: A run has at least LEAST words and REPEATS periods.
LEAST, REPEATS = 6, 4
_PRIME, _BASE = (1 << 61) - 1, 0x1B873593CC9E2D51 % ((1 << 61) - 1)
#: Words compared one by one before hashes are.
_DIRECT = 4


class Extensions:
    """Longest common extensions of a sequence of numbers, by rolling hashes."""

    def __init__(self, word: list[int]):
        self.word, self.sums, self.powers = word, [0], [1]
        total, power = 0, 1
        # values that follow from the words but are spread over the whole range
        spread = [int(v) % _PRIME for v in mix(np.array(word, np.uint64) + np.uint64(0x9E3779B97F4A7C15))]
        for v in spread:
            total = (total * _BASE + v) % _PRIME
            power = power * _BASE % _PRIME
            self.sums.append(total)
            self.powers.append(power)

    def same(self, i: int, j: int, n: int) -> bool:
        s, p = self.sums, self.powers[n]
        return (s[i + n] - s[i] * p - s[j + n] + s[j] * p) % _PRIME == 0

    def ahead(self, i: int, j: int) -> int:
        """How many words from ``i`` on equal those from ``j`` on, j > i."""
        word, most = self.word, len(self.word) - j
        k, direct = 0, min(most, _DIRECT)
        while k < direct and word[i + k] == word[j + k]:
            k += 1
        if k < direct or k == most:
            return k
        step = _DIRECT
        while k + step <= most and self.same(i + k, j + k, step):
            k += step
            step *= 2
        while step:
            if k + step <= most and self.same(i + k, j + k, step):
                k += step
            step >>= 1
        return k

    def behind(self, i: int, j: int) -> int:
        """How many words before ``i`` equal those before ``j``, j > i."""
        word = self.word
        k, direct = 0, min(i, _DIRECT)
        while k < direct and word[i - k - 1] == word[j - k - 1]:
            k += 1
        if k < direct or k == i:
            return k
        step = _DIRECT
        while k + step <= i and self.same(i - k - step, j - k - step, step):
            k += step
            step *= 2
        while step:
            if k + step <= i and self.same(i - k - step, j - k - step, step):
                k += step
            step >>= 1
        return k


def find_runs(word: list[int], least: int = LEAST, repeats: int = REPEATS) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of ``word``, by start and period."""
    n, ext = len(word), Extensions(word)
    found: dict[int, list[tuple[int, int]]] = {}  # of each period, from right to left
    for sign in (1, -1):
        rank = [sign * w for w in word]
        stack = [n]  # starts of ever smaller suffixes; the empty suffix is the smallest
        last: dict[int, tuple[int, int]] = {}
        for i in range(n - 1, -1, -1):
            here = rank[i]
            while (j := stack[-1]) < n:
                there = rank[j]
                if there < here:
                    break
                if there == here:
                    p = j - i
                    known = last.get(p)
                    k = known[1] - j if known and known[0] <= i and j < known[1] else ext.ahead(i, j)
                    if j + k == n or rank[j + k] < rank[i + k]:
                        break
                stack.pop()
            p = j - i
            stack.append(i)
            if j == n or word[j] != word[i]:
                continue
            known = last.get(p)
            if known and known[0] <= i and j < known[1]:
                continue  # the root lies in a stretch already measured
            span = last[p] = (i - ext.behind(i, j), j + ext.ahead(i, j))
            if span[1] - span[0] >= max(least, repeats * p):
                found.setdefault(p, []).append(span)
    out = {(s, e - s, p) for p, spans in found.items() for s, e in spans}
    for s, length, p in out:
        e = s + length
        if word[s : e - p] != word[s + p : e] or (s and word[s - 1] == word[s - 1 + p]) or (e < n and word[e] == word[e - p]):
            raise ArithmeticError("hashes of different words agree")  # chance of some 2^-50 for a million words
    return sorted(out, key=lambda r: (r[0], r[2]))


def stretches(code: np.ndarray, doc: np.ndarray, least: int = LEAST, repeats: int = REPEATS) -> Iterator[tuple[int, int]]:
    """(first word, end) of the stretches of words in which there may be runs: in each of a document's
    stretches every word occurs ``repeats`` times or more."""
    at, group = np.arange(len(code)), doc.astype(np.int64)
    while len(at):
        order = np.lexsort((code[at], group))
        g, c = group[order], code[at][order]
        new = np.r_[True, (g[1:] != g[:-1]) | (c[1:] != c[:-1])]
        times = np.diff(np.r_[np.flatnonzero(new), len(g)])
        keep = np.empty(len(at), bool)
        keep[order] = np.repeat(times >= repeats, times)
        done = keep.all()
        at, group = at[keep], group[keep]
        if not len(at):
            return
        cut = np.r_[True, (np.diff(at) != 1) | (np.diff(group) != 0)]
        group = np.cumsum(cut) - 1
        size = np.bincount(group)
        long_ = size[group] >= max(least, repeats)
        if done and long_.all():
            first = np.flatnonzero(cut)
            yield from zip(at[first].tolist(), (at[first] + size).tolist(), strict=True)
            return
        at, group = at[long_], group[long_]


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def detect_runs(docs: DataFrame, texts: bool = False) -> DataFrame:
    """doc_id, n_runs, start, length, period, exponent_milli, runs_sha256, collapsed_sha256 (and with ``texts``
    collapsed_text) for every row of ``docs`` (doc_id and text); start to exponent_milli are those of the longest run, of equally long ones of the
    first, then of the least period.

    A word is a run of characters other than ASCII white space, numbered from 0. A run is a stretch of at least
    six words and four periods whose words one period apart are equal and which no neighbour extends; its
    period is its smallest. Collapsing keeps a word unless a run contains it behind its first
    period; kept words are joined by one space. Whole texts are read, each by itself: nothing is shuffled. Null, empty and
    blank texts have no words. Repeated rows each have a result, doc_id may be null, and an
    empty table gives an empty result. Other columns are ignored.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches):
            flat, count = split_words(piece.column("text"))
            begin = np.r_[0, np.cumsum(count)]
            doc = np.repeat(np.arange(len(count)), count)
            code = flat.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64) if len(flat) else np.zeros(0, np.int64)
            runs: list[list] = [[] for _ in count]
            for lo, hi in stretches(code, doc):
                k = doc[lo]
                runs[k] += [(lo - int(begin[k]) + s, n, p) for s, n, p in find_runs(code[lo:hi].tolist())]
            rows = []
            for k, got in enumerate(runs):
                got.sort(key=lambda r: (r[0], r[2]))
                best = min(got, key=lambda r: (-r[1], r[0], r[2]), default=None)
                words = flat.slice(begin[k], count[k])
                gone = np.zeros(count[k], bool)
                for s, n, p in got:
                    gone[s + p : s + n] = True
                kept = " ".join((words.filter(pa.array(~gone)) if got else words).to_pylist())
                told = [*best, 1000 * best[1] // best[2]] if best else [None] * 4
                rows.append((len(got), *told, _sha("".join(f"{s},{n},{p}\n" for s, n, p in got)), _sha(kept), *([kept] if texts else [])))
            columns = [pa.array(c, pa.int64()) for c in zip(*[r[:5] for r in rows], strict=True)] + [pa.array(c, pa.string()) for c in zip(*[r[5:] for r in rows], strict=True)]
            names = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256", *(["collapsed_text"] if texts else [])]
            yield from pa.table([piece.column("doc_id"), *columns], names=names).to_batches()

    schema = f"doc_id {kind}, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string" + ", collapsed_text string" * texts
    return docs.select("doc_id", "text").mapInArrow(work, schema)
