"""Removal of repeated passages by suffix automata of reference shards.

Every window of 20 words has one minimiser: the smallest hash of the short word sequences in it. Equal
windows have equal minimisers, so the windows that share a minimiser hash can be judged by themselves.
A stretch is a run of consecutive windows with the same minimiser occurrence. Stretches whose hash
occurs once hold no repeat. Of the rest, stretches of equal words are one reference text, and the
reference texts of a hash go to one shard, where a suffix automaton knows the first place of each
sequence; streaming a text through it gives the matching statistics and so each window's first place.

The reference here is the corpus itself and has no size bound, so shards of bounded size are dealt
over tasks by minimiser instead of being broadcast whole to every task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.llm.common import drop_stash, stash
from rollcall.llm.words import gram_hashes, hash_words, mix, slices, sliding_argmin, split_words

#: Words of a minimiser. Reference texts in a shard.
MINIMISER, SHARD_TEXTS = 5, 4000
#: A stretch's windows are bits of an int, and its length has 5 bits beside its place.
LEAST_WIDTH, MOST_WIDTH = MINIMISER, MINIMISER + 30


def stretches(words: np.ndarray, count: np.ndarray, width: int) -> tuple[np.ndarray, ...]:
    """(text, first window, windows, minimiser hash, hash of all its words) of each stretch."""
    windows = np.maximum(count - width + 1, 0)
    if len(words) < width or not windows.sum():
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),) * 2
    grams, whole = gram_hashes(words, MINIMISER), gram_hashes(words, width)
    least = sliding_argmin(grams, width - MINIMISER + 1)
    text = np.repeat(np.arange(len(count)), count)[: len(whole)]
    begin = np.cumsum(count) - count
    at = np.arange(len(whole)) - begin[text]
    ok = at < windows[text]
    text, at, least, whole = text[ok], at[ok], least[ok], whole[ok]
    new = np.ones(len(text), bool)
    new[1:] = (least[1:] != least[:-1]) | (text[1:] != text[:-1])
    first = np.flatnonzero(new)
    size = np.diff(np.r_[first, len(text)])
    # fewer windows than words in one: the first and the last window have all words between them
    content = mix(mix(whole[first]) * np.uint64(3) + whole[first + size - 1]) + size.astype(np.uint64)
    return text[first], at[first], size, grams[least[first]], content


class SuffixAutomaton:
    """Automaton of all suffixes of several texts, with the first place where each sequence ends."""

    def __init__(self) -> None:
        self.next: list[dict] = [{}]
        self.link, self.length, self.first = [-1], [0], [1 << 62]

    def _state(self, length: int, moves: dict, link: int) -> int:
        self.next.append(moves)
        self.link.append(link)
        self.length.append(length)
        self.first.append(1 << 62)
        return len(self.next) - 1

    def _split(self, p: int, word, q: int) -> int:
        clone = self._state(self.length[p] + 1, dict(self.next[q]), self.link[q])
        self.link[q] = clone
        while p != -1 and self.next[p].get(word) == q:
            self.next[p][word] = clone
            p = self.link[p]
        return clone

    def add(self, words: list, place: int) -> None:
        """Adds a text whose first word is at ``place``; places order occurrences."""
        last = 0
        for i, word in enumerate(words):
            q = self.next[last].get(word)
            if q is not None:
                cur = q if self.length[q] == self.length[last] + 1 else self._split(last, word, q)
            else:
                cur, p = self._state(self.length[last] + 1, {}, 0), last
                while p != -1 and word not in self.next[p]:
                    self.next[p][word] = cur
                    p = self.link[p]
                if p != -1:
                    q = self.next[p][word]
                    self.link[cur] = q if self.length[q] == self.length[p] + 1 else self._split(p, word, q)
            last = cur
            self.first[cur] = min(self.first[cur], place + i)

    def finish(self) -> None:
        """Hands first places on to the suffixes, longest sequences first."""
        for v in sorted(range(1, len(self.next)), key=self.length.__getitem__, reverse=True):
            up = self.link[v]
            if self.first[v] < self.first[up]:
                self.first[up] = self.first[v]

    def first_places(self, words: list, width: int) -> list[int]:
        """Streams a text through; for each window of ``width`` words with a match that long, the
        first place of its last word, else -1."""
        out, v, n = [], 0, 0
        for i, word in enumerate(words):
            while v and word not in self.next[v]:
                v = self.link[v]
                n = self.length[v]
            if word in self.next[v]:
                v, n = self.next[v][word], n + 1
            while self.link[v] >= 0 and self.length[self.link[v]] >= width:
                v = self.link[v]
            n = min(n, self.length[v])
            if i >= width - 1:
                out.append(self.first[v] if n >= width else -1)
        return out


def joined(words: pa.Array, count: np.ndarray) -> pa.Array:
    """The words of each text, of which it has ``count``, with one space between two."""
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(count)], pa.int32()), words), " ")


def _scan(docs: DataFrame, width: int) -> DataFrame:
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches):
            flat, count = split_words(piece.column("text"))
            text, at, size, mini, content = stretches(hash_words(flat), count, width)
            ids = piece.column("doc_id").to_numpy()[text]
            yield pa.RecordBatch.from_arrays([pa.array(mini.view(np.int64)), pa.array(content.view(np.int64)), pa.array(ids), pa.array(at * 32 + size)], ["mini", "content", "doc_id", "at"])

    rows = docs.filter("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(scan, "mini long, content long, doc_id long, at long")


def first_windows(docs: DataFrame, width: int) -> DataFrame:
    """doc_id, spans (array of first window, bits of the windows from there that start earlier too)."""
    seen = stash(_scan(docs, width))
    often = stash(seen.groupBy("mini").agg(F.count("*").alias("n")).filter("n > 1").select("mini"))
    again = stash(seen.join(often, "mini"))
    drop_stash(seen, often)
    start, size = F.floor(F.col("at") / 32), F.pmod(F.col("at"), F.lit(32))

    texts = stash(again.groupBy("mini", "content").agg(F.min(F.struct("doc_id", "at")).alias("f")).select("mini", "content", "f.doc_id", "f.at"))
    several = texts.groupBy("mini").agg(F.count("*").alias("texts")).filter("texts > 1")
    parts = F.ceil(F.col("texts") / SHARD_TEXTS).cast("int")
    several = texts.join(stash(several.select("mini", parts.alias("parts"))), "mini")
    several = stash(several.withColumn("part", F.pmod(F.col("content"), F.col("parts").cast("long")).cast("int")))
    firsts = stash(_first_places(docs, several, width))

    known = texts.join(firsts, ["mini", "content"], "left")
    known = stash(known.select("mini", "content", F.col("doc_id").alias("f_doc"), F.floor(F.col("at") / 32).alias("f_start"), "docs", "starts"))
    both = again.join(known, ["mini", "content"]).withColumn("start", start).withColumn("size", size)
    later = lambda doc, at, here: (doc < F.col("doc_id")) | ((doc == F.col("doc_id")) & (at < here))
    each = F.aggregate(
        F.sequence(F.lit(0), F.col("size").cast("int") - 1),
        F.lit(0),
        lambda bits, t: bits + F.when(later(F.get("docs", t), F.get("starts", t), F.col("start") + t), F.pow(F.lit(2), t).cast("int")).otherwise(0),
    )
    one = F.when(later(F.col("f_doc"), F.col("f_start"), F.col("start")), (F.pow(F.lit(2), F.col("size")) - 1).cast("int")).otherwise(0)
    gone = both.select("doc_id", "start", F.when(F.col("docs").isNull(), one).otherwise(each).alias("bits")).filter("bits <> 0")
    return stash(gone.groupBy("doc_id").agg(F.collect_set(F.struct("start", "bits")).alias("spans")))


def _first_places(docs: DataFrame, several: DataFrame, width: int) -> DataFrame:
    """mini, content, docs, starts: for each window of a reference text, its first document and place."""
    own = docs.filter("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    wanted = several.groupBy("doc_id").agg(F.collect_list(F.struct("mini", "content", "at", "part", "parts")).alias("wanted"))
    units = "mini long, content long, doc_id long, at long, part int, parts int, words string"

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches):
            flat, count = split_words(piece.column("text"))
            begin = np.cumsum(count) - count
            lists = piece.column("wanted").combine_chunks()
            lists = lists if isinstance(lists, pa.ListArray) else pa.concat_arrays(lists.chunks)
            rows, size = lists.flatten(), pc.list_value_length(lists).to_numpy(zero_copy_only=False)
            doc = np.repeat(np.arange(len(size)), size)
            at = rows.field("at").to_numpy()
            lo = begin[doc] + at // 32
            hi = lo + at % 32 + width - 1
            # of repeated rows of a document with other texts, those that lack the place are left out
            fits = hi <= begin[doc] + count[doc]
            size = (hi - lo)[fits]
            words = joined(flat.take(pa.array(np.arange(size.sum()) + np.repeat(lo[fits] - (np.cumsum(size) - size), size))), size)
            keep = pa.array(fits)
            ids = piece.column("doc_id").to_numpy()[doc[fits]]
            yield pa.RecordBatch.from_arrays([rows.field("mini").filter(keep), rows.field("content").filter(keep), pa.array(ids), rows.field("at").filter(keep), rows.field("part").filter(keep), rows.field("parts").filter(keep), words], ["mini", "content", "doc_id", "at", "part", "parts", "words"])

    fetched = own.join(wanted, "doc_id").mapInArrow(take, units)
    shards = max(1, several.count() // SHARD_TEXTS)
    fetched = fetched.withColumn("shard", F.pmod(F.xxhash64("mini", "part"), F.lit(shards)))

    def resolve(frame: pd.DataFrame) -> pd.DataFrame:
        """One shard: its automaton is built of its texts, then each text is streamed through it."""
        frame = frame.drop_duplicates(["mini", "content"])
        ids, rank = np.unique(frame["doc_id"].to_numpy(), return_inverse=True)
        begin = frame["at"].to_numpy() // 32
        codes: dict[str, int] = {}
        texts = [[codes.setdefault(w, len(codes)) for w in x.split(" ")] for x in frame["words"]]
        machine = SuffixAutomaton()
        for text, place in zip(texts, (rank.astype(np.int64) << 32) + begin, strict=True):
            machine.add(text, int(place))
        machine.finish()
        places = [np.array(machine.first_places(x, width), np.int64) - (width - 1) for x in texts]
        many = frame["parts"].to_numpy() > 1
        hashes = [gram_hashes(hash_words(pa.array(x.split(" "))), width).view(np.int64).tolist() if m else None for x, m in zip(frame["words"], many, strict=True)]
        return pd.DataFrame({"mini": frame["mini"], "content": frame["content"], "docs": [ids[p >> 32].tolist() for p in places], "starts": [(p & 0xFFFFFFFF).tolist() for p in places], "windows": hashes})

    local = stash(fetched.groupBy("shard").applyInPandas(resolve, "mini long, content long, docs array<long>, starts array<long>, windows array<long>"))
    alone = local.filter("windows is null").select("mini", "content", "docs", "starts")
    # a hash with more texts than a shard takes: the shards' first places of a window are merged
    spread = local.filter("windows is not null").select("mini", "content", F.posexplode(F.arrays_zip("windows", "docs", "starts")).alias("t", "w"))
    spread = spread.select("mini", "content", "t", F.col("w.windows").alias("window"), F.struct("w.docs", "w.starts").alias("place"))
    least = stash(spread.groupBy("mini", "window").agg(F.min("place").alias("place")))
    merged = spread.drop("place").join(least, ["mini", "window"]).groupBy("mini", "content").agg(F.sort_array(F.collect_list(F.struct("t", "place"))).alias("all"))
    merged = merged.select("mini", "content", F.transform("all", lambda x: x.place.docs).alias("docs"), F.transform("all", lambda x: x.place.starts).alias("starts"))
    return alone.unionByName(merged)


def remove_repeats(docs: DataFrame, width: int = 20, carry: tuple[str, ...] = (), original: bool = False) -> DataFrame:
    """doc_id, n_words, n_removed, kept_text for every row of ``docs`` (doc_id, an integer, and text).

    A word is a run of characters other than ASCII white space; kept_text has the kept words joined by
    one space, or with ``original`` the text as it was where nothing goes. ``carry`` names columns to
    pass on in a struct ``rest``. A word goes if a window of ``width`` words over it has a sequence that also
    starts earlier: in a smaller doc_id, or earlier in the same document. Windows are judged on the input.
    Null, empty and short texts lose nothing; a null text has no words. Rows without doc_id lose nothing and
    nothing is removed on their account. Repeated rows are one document, which does not precede itself.
    Other columns are ignored, and an empty table gives an empty result. ``width`` is from LEAST_WIDTH to MOST_WIDTH.
    """
    if not LEAST_WIDTH <= width <= MOST_WIDTH:
        raise ValueError(f"width must be from {LEAST_WIDTH} to {MOST_WIDTH}: {width}")
    spans = first_windows(docs, width)
    rows = docs.select("doc_id", "text", F.struct(*carry).alias("rest") if carry else F.lit(0).alias("rest"))
    kind, rest = rows.schema["doc_id"].dataType.simpleString(), rows.schema["rest"].dataType.simpleString()

    def cut_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches):
            flat, count = split_words(piece.column("text"))
            begin = np.cumsum(count) - count
            span = piece.column("spans").combine_chunks()
            span = span if isinstance(span, pa.ListArray) else pa.concat_arrays(span.chunks)
            doc = np.repeat(np.arange(len(count)), pc.fill_null(pc.list_value_length(span), 0).to_numpy(zero_copy_only=False))
            start, bits = span.flatten().field("start").to_numpy(), span.flatten().field("bits").to_numpy()
            cover = np.zeros(len(flat) + 1, np.int64)
            for t in range(min(width, 31)):
                gone = (bits >> t & 1 > 0) & (start + t + width <= count[doc])
                at = (begin[doc] + start + t)[gone]
                cover += np.bincount(at, minlength=len(cover)) - np.bincount(at + width, minlength=len(cover))
            keep = np.cumsum(cover[:-1]) == 0
            kept = np.diff(np.r_[0, np.cumsum(keep)][np.r_[0, np.cumsum(count)]])
            removed = count - kept
            whole = (removed == 0) if original else np.zeros(len(count), bool)
            words = np.repeat(~whole, count)
            texts = joined(flat.filter(pa.array(keep & words)), np.where(whole, 0, kept))
            if original:
                texts = pc.if_else(pa.array(whole), piece.column("text"), texts)
            out = pa.table([piece.column("doc_id"), piece.column("rest"), pa.array(count), pa.array(removed, pa.int64()), texts], names=["doc_id", "rest", "n_words", "n_removed", "kept_text"])
            yield from out.to_batches()

    # whether the spans are few enough to be broadcast is left to Spark's own size check
    both = rows.join(spans, "doc_id", "left").select("doc_id", "rest", "text", "spans")
    out = both.mapInArrow(cut_out, f"doc_id {kind}, rest {rest}, n_words long, n_removed long, kept_text string")
    return out.select("doc_id", *(["rest"] if carry else []), "n_words", "n_removed", "kept_text")


def cut_repeats(docs: DataFrame, width: int = 20) -> DataFrame:
    """``docs`` with their columns; repeated passages are cut out of text, and n_chars follows it."""
    carry = tuple(c for c in docs.columns if c not in ("doc_id", "text"))
    out = remove_repeats(docs, width, carry, original=True)
    size = {"n_chars": F.length("kept_text").cast(docs.schema["n_chars"].dataType)} if "n_chars" in docs.columns else {}
    take = {"doc_id": F.col("doc_id"), "text": F.col("kept_text"), **{c: F.col("rest")[c] for c in carry}} | size
    return out.select(*[take[c].alias(c) for c in docs.columns])


def digest(removed: DataFrame) -> DataFrame:
    return removed.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))
