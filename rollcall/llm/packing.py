"""Packing token sequences with a bounded number of open windows."""

from __future__ import annotations

import base64
import json
import re
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from functools import partial
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.llm.common import stash
from rollcall.llm.words import slices

PIECE = "doc_id {}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
#: Encoded chunks that a worker remembers.
CACHE = 200_000
#: White space so long is cut out of a text before the encoder's own search, whose stack a million of it overflows.
LONG = 100_000
BLANK = re.compile(r"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{%d,}" % LONG)


class ByteBpe:
    """Ids of texts under a byte-level BPE vocabulary given as ranks.

    The vocabulary's word pattern always ends a word before a single space between two other
    characters, so such texts are cut there, each distinct chunk is encoded once, and ids are gathered;
    texts with any other white space around a space are encoded whole, and so are those that hold a
    token of ``added`` (token: id), which stands for its id; without ``added`` such a token is text.
    """

    PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
    ODD = r"(^|[\s\p{Z}\x{85}\x{1c}-\x{1f}]) | ([\s\p{Z}\x{85}\x{1c}-\x{1f}]|$)"

    def __init__(self, path: str, added: dict[str, int] | None = None):
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.added = added or {}
        codec = tiktoken.Encoding("byte-bpe", pat_str=self.PATTERN, mergeable_ranks=ranks, special_tokens=self.added)
        self.encode = partial(self._cut, partial(codec.encode, allowed_special="all") if self.added else codec.encode_ordinary)
        self.plain = partial(self._cut, codec.encode_ordinary)  # of texts without added tokens
        self.piece = codec._encode_single_piece
        self.known: dict[str, list[int]] = {}

    def _cut(self, encode: Callable[[str], list[int]], text: str) -> list[int]:
        """The ids of a text. The pattern makes one piece of white space but for its last character where a word
        follows, and of all of it before an added token or the end; so long runs are encoded as such pieces."""
        if len(text) < LONG:
            return encode(text)
        out, at = [], 0
        for run in BLANK.finditer(text):
            whole = run.end() == len(text) or text.startswith(tuple(self.added), run.end())
            end = run.end() - (not whole)
            out += encode(text[at : run.start()])
            out += self.piece(text[run.start() : end])
            at = end
        return out + encode(text[at:])

    def chunk(self, text: str) -> list[int]:
        ids = self.known.get(text)
        if ids is None:
            if len(self.known) >= CACHE:
                self.known.clear()
            ids = self.known[text] = self.plain(" " + text)
        return ids

    def batch(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """The ids of each text, in order."""
        odd = pc.match_substring_regex(texts, self.ODD)
        for token in self.added:
            odd = pc.or_(odd, pc.match_substring(texts, token))
        odd = odd.to_numpy(zero_copy_only=False)
        parts = pc.split_pattern(pc.if_else(pa.array(odd), "", texts), " ")
        count = pc.list_value_length(parts).to_numpy(zero_copy_only=False).astype(np.int64)
        flat = parts.flatten()
        first = np.zeros(len(flat), bool)
        first[np.cumsum(count) - count] = True
        heads = flat.filter(pa.array(first)).to_pylist()
        rest = flat.filter(pa.array(~first)).dictionary_encode()
        each = [self.chunk(x) for x in rest.dictionary.to_pylist()]
        size = np.fromiter(map(len, each), np.int64, len(each))
        at = np.cumsum(size) - size
        pool = np.fromiter(chain.from_iterable(each), np.uint32, int(size.sum()))
        index = rest.indices.to_numpy().astype(np.int64)
        lens = size[index] if len(index) else np.zeros(0, np.int64)
        ends = np.cumsum(lens)
        ids = pool[np.repeat(at[index] - (ends - lens), lens) + np.arange(ends[-1])] if len(index) else pool
        bounds = np.r_[0, ends][np.r_[0, np.cumsum(count - 1)]]
        for k, head in enumerate(heads):
            if odd[k]:
                yield np.array(self.encode(texts[k].as_py()), np.uint32)
            else:
                yield np.concatenate([np.array(self.plain(head), np.uint32), ids[bounds[k] : bounds[k + 1]]])


def added_tokens(path: str) -> dict[str, int]:
    """The added tokens of a tokenizer file, with their ids."""
    with open(path, encoding="utf-8") as f:
        tokens = json.load(f)["added_tokens"]
    if any(t[x] for t in tokens for x in ("single_word", "lstrip", "rstrip", "normalized")):
        raise ValueError(f"added tokens that match by more than their text: {path}")
    return {t["content"]: t["id"] for t in tokens}


@dataclass
class Window:
    used: int = 0
    pieces: list[tuple] = field(default_factory=list)  # (doc_id, start, ids, doc_tokens)


def crc(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


def pack_stream(docs: Iterator[tuple[object, np.ndarray]], size: int, windows: int) -> Iterator[tuple[bool, Window]]:
    """(is leftover, window) of a stream of documents.

    Whole windows are cut off a long document first. What remains goes to the open window that it
    fills best; if it fits in none and all are open, the fullest is emitted. Those open at the end
    are leftovers.
    """
    open_: list[Window] = []
    for doc_id, ids in docs:
        n, start = len(ids), 0
        while n - start >= size:
            yield False, Window(size, [(doc_id, start, ids[start : start + size], n)])
            start += size
        if start == n:
            continue
        tail = n - start
        best = max((w for w in open_ if w.used + tail <= size), key=lambda w: w.used, default=None)
        if best is None:
            if len(open_) == windows:
                fullest = max(range(windows), key=lambda i: open_[i].used)
                yield False, open_.pop(fullest)
            open_.append(best := Window())
        best.pieces.append((doc_id, start, ids[start:], n))
        best.used += tail
        if best.used == size:
            open_.remove(best)
            yield False, best
    for w in open_:
        yield True, w


def merge_leftovers(pieces: list[tuple], size: int) -> Iterator[Window]:
    """Leftover pieces laid end to end and cut at window borders: one partial window at most."""
    w = Window()
    for doc_id, start, ids, n in pieces:
        while len(ids):
            take = min(size - w.used, len(ids))
            w.pieces.append((doc_id, start, ids[:take], n))
            w.used += take
            start, ids = start + take, ids[take:]
            if w.used == size:
                yield w
                w = Window()
    if w.used:
        yield w


def _rows(window: Window, sequence: int) -> list[tuple]:
    out, offset = [], 0
    for doc_id, start, ids, n in window.pieces:
        out.append((doc_id, start, len(ids), crc(ids), n, sequence, offset))
        offset += len(ids)
    return out


def pack_documents(docs: DataFrame, encoder: Callable[[], object], size: int = 2048, windows: int = 64, end_id: int = 1, merge: int = 32) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset for every piece; see ``padding``.

    ``encoder()`` is called once in a task and gives an object whose ``batch(texts)`` yields ids. Each
    row of ``docs`` (doc_id, text; other columns are ignored) is its ids and ``end_id``; a null text is
    empty and so just ``end_id``; repeated rows are packed each for itself. A partition keeps
    ``windows`` windows open; the leftovers of ``merge`` partitions meet in one task and are filled by
    cutting, so at most one window of such a group is short. A sequence is padded to ``size``, unless
    its length is a power of two. Nothing is shuffled but leftovers.
    An empty table gives an empty result.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, codec = TaskContext.get().partitionId(), encoder()

        def stream():
            for piece in slices(batches):
                texts = pc.fill_null(piece.column("text"), "").combine_chunks()
                texts = texts.combine_chunks() if isinstance(texts, pa.ChunkedArray) else texts
                for doc_id, ids in zip(piece.column("doc_id").to_pylist(), codec.batch(texts), strict=True):
                    yield doc_id, np.r_[ids, np.uint32(end_id)]

        rows: list[tuple] = []
        for k, (left, w) in enumerate(pack_stream(stream(), size, windows)):
            more = _rows(w, (part << 32) + k)
            rows += [(*r, part // merge if left else -1, p[2].astype("<u4").tobytes() if left else None) for r, p in zip(more, w.pieces, strict=True)]
            if len(rows) >= 5000:
                yield _batch(rows, schema)
                rows = []
        yield _batch(rows, schema)

    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    ddl = PIECE.format(kind) + ", left_group long, ids binary"
    schema = to_arrow_schema(_parse_datatype_string(ddl))
    packed = stash(docs.select("doc_id", "text").mapInArrow(pack, ddl))

    def fill(key: tuple, pieces: pd.DataFrame) -> pd.DataFrame:
        pieces = pieces.sort_values(["sequence_id", "offset"])
        own = [(d, s, np.frombuffer(i, "<u4"), n) for d, s, i, n in zip(pieces["doc_id"], pieces["start"], pieces["ids"], pieces["doc_tokens"], strict=True)]
        base = ((1 << 30) + int(key[0])) << 32
        rows = [r for k, w in enumerate(merge_leftovers(own, size)) for r in _rows(w, base + k)]
        return pd.DataFrame(rows, columns=columns)

    merged = packed.filter("left_group >= 0").groupBy("left_group").applyInPandas(fill, PIECE.format(kind))
    pieces = packed.filter("left_group < 0").select(*columns).unionByName(merged)
    return pieces


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True) if rows else [[]] * len(schema), schema, strict=True)], schema=schema)


def padding(pieces: DataFrame, size: int = 2048) -> DataFrame:
    """sequence_id, used, padded: tokens of each sequence and its length once padded."""
    used = pieces.groupBy("sequence_id").agg(F.sum("length").alias("used"))
    power = F.col("used").bitwiseAND(F.col("used") - 1) == 0
    return used.withColumn("padded", F.when(power, F.col("used")).otherwise(F.lit(size).cast("long")))
