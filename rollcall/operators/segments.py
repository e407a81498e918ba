"""Words and captions folded into segments: as steps over rows, for whole groups and for streams.

A fold's state is what is open: a segment that the next row may extend. At some rows it starts anew whatever came before
(another speaker, a long pause, a turn's mark); there a group can be cut, and the pieces folded by themselves.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Rows of a group that one task folds; a larger group is cut.
STRETCH = 50_000


class TurnFold:
    """Caption rows (t0, text) as turns (t_sec, text): a new one at the first row, at '>>', more than ``gap`` after
    the turn's start, or once the turn has more than ``most`` characters. Rows without text are passed over."""

    takes, schema = ["t0", "text"], "t_sec double, text string"

    def __init__(self, gap: float = 18, most: int = 280) -> None:
        self.gap, self.most = gap, most
        self.open: list[tuple] = []  # (start, text), at most one

    def push(self, t: float, raw: str | None) -> Iterator[tuple]:
        raw = " ".join((raw or "").split())
        text = re.sub(r"^>>\s*", "", raw)
        if not text:
            return
        if self.open:
            start, words = self.open[0]
            if not (raw.startswith(">>") or t - start > self.gap or len(words) > self.most):
                self.open = [(start, f"{words} {text}")]
                return
        yield from self.open
        self.open = [(t, text)]

    def finish(self) -> Iterator[tuple]:
        yield from self.open
        self.open = []

    def cuts(self, before: dict[str, Column]) -> Column:
        """Whether no row ahead of this one can be in its turn; ``before`` has the values of the row ahead and ``latest``,
        the greatest t0 of all rows ahead. A row without text does not cut."""
        plain = F.trim(F.regexp_replace(F.coalesce("text", F.lit("")), r"(?U)\s+", " "))
        return plain.rlike(r"^>>\s*\S") | (plain.rlike(r"[^>\s]") & (F.col("t0") - before["latest"] > self.gap))


class WordFold:
    """Words (speaker, t0, t1, word) as segments (t0, t1, speaker, words, text): closed before a word of another
    speaker, after a pause of more than 1.2 s, at 12 s or 35 words; and after a closing mark once it has 4 words and 1 s."""

    takes, schema = ["speaker", "t0", "t1", "word"], "t0 double, t1 double, speaker string, words int, text string"

    def __init__(self) -> None:
        self.open: list[tuple] = []

    def push(self, speaker: str, t0: float, t1: float, word: str) -> Iterator[tuple]:
        now = self.open
        if now and (speaker != now[0][0] or t0 - now[-1][2] > 1.2 or now[-1][2] - now[0][1] >= 12.0 or len(now) >= 35):
            yield from self.finish()
        self.open.append((speaker, t0, t1, word))
        if len(self.open) >= 4 and t1 - self.open[0][1] >= 1.0 and re.search(r"[.!?]$", word):
            yield from self.finish()

    def finish(self) -> Iterator[tuple]:
        if self.open:
            now, self.open = self.open, []
            yield now[0][1], now[-1][2], now[0][0], len(now), " ".join(w[3] for w in now)

    def cuts(self, before: dict[str, Column]) -> Column:
        return ~F.col("speaker").eqNullSafe(before["speaker"]) | (F.col("t0") - before["t1"] > 1.2)


def _pieces(rows: DataFrame, group: list[str], order: str, fold: TurnFold | WordFold) -> DataFrame:
    """``rows`` with _piece: how many certain cuts of the group lie ahead of the row, itself included.

    A group of any size is dealt into stretches by its order; of each only the last row, the latest time and the
    number of cuts are passed on, so no task orders a whole group.
    """
    span = W.partitionBy(*group).orderBy("_s")
    low = rows.groupBy(*group).agg(F.min(order).alias("_lo"), F.max(order).alias("_hi"), F.count("*").alias("_n"))
    # stretches of equal width in the order's values
    width = F.greatest((F.col("_hi") - F.col("_lo") + 1) / F.ceil(F.col("_n") / STRETCH), F.lit(1e-9))
    rows = rows.join(low, group).withColumn("_s", F.coalesce(F.floor((F.col(order) - F.col("_lo")) / width), F.lit(-1)).cast("long")).drop("_lo", "_hi", "_n")
    inside = W.partitionBy(*group, "_s").orderBy(order)
    ahead = inside.rowsBetween(W.unboundedPreceding, -1)
    now = F.struct(*fold.takes)
    last = rows.groupBy(*group, "_s").agg(F.max_by(now, F.coalesce(order, F.lit(float("-inf")))).alias("_end"), F.max("t0").alias("_top"))
    last = last.select(*group, "_s", F.lag("_end").over(span).alias("_end"), F.max("_top").over(span.rowsBetween(W.unboundedPreceding, -1)).alias("_top"))
    rows = rows.join(last, [*group, "_s"]).withColumn("_before", F.when(F.row_number().over(inside) == 1, F.col("_end")).otherwise(F.lag(now).over(inside)))
    before = {c: F.col("_before")[c] for c in fold.takes} | {"latest": F.greatest("_top", F.max("t0").over(ahead))}
    rows = rows.withColumn("_cut", F.coalesce(F.col("_before").isNull() | fold.cuts(before), F.lit(False)).cast("long")).drop("_before", "_end", "_top")
    count = rows.groupBy(*group, "_s").agg(F.sum("_cut").alias("_cuts"))
    count = count.select(*group, "_s", F.coalesce(F.sum("_cuts").over(span.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("_cuts"))
    piece = F.col("_cuts") + F.sum("_cut").over(inside.rowsBetween(W.unboundedPreceding, 0))
    return rows.join(count, [*group, "_s"]).withColumn("_piece", piece).drop("_cuts", "_cut", "_s")


def fold_segments(rows: DataFrame, group: list[str], order: str, fold: TurnFold | WordFold, place: bool = False) -> DataFrame:
    """The segments of each group of ``rows`` in the order of ``order``, a number that tells a group's rows apart
    (rows without it come first). A group of more than STRETCH rows is folded in pieces that end where a fold starts
    anew for certain; other groups are folded whole. With ``place`` there is a number by which a group's segments are in order."""
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    names = [x.split()[0] for x in fold.schema.split(", ")]
    cls, start = fold.__class__, {k: v for k, v in vars(fold).items() if k != "open"}

    def run(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        state = cls.__new__(cls)
        vars(state).update(start, open=[])
        frame = frame.sort_values(order, kind="stable", na_position="first")
        out = [x for row in zip(*[frame[c] for c in fold.takes], strict=True) for x in state.push(*row)]
        frame = pd.DataFrame([*out, *state.finish()], columns=names)
        if place:  # behind the group there is the piece's number
            frame["place"] = (int(key[len(group)]) << 32 if len(key) > len(group) else 0) + frame.index
        for name, value in zip(group, key, strict=False):
            frame.insert(0, name, value)
        return frame[[*group, *names, *(["place"] if place else [])]]

    rows = rows.select(*group, order, *fold.takes)
    ddl = ", ".join(f"{g} {kinds[g]}" for g in group) + ", " + fold.schema + ", place long" * place
    large = rows.groupBy(*group).count().filter(F.col("count") > STRETCH).select(*group)
    if large.isEmpty():
        return rows.groupBy(*group).applyInPandas(run, ddl)
    same = [F.col(f"r.{g}").eqNullSafe(F.col(f"l.{g}")) for g in group]
    usual = rows.alias("r").join(large.alias("l"), same, "left_anti").groupBy(*group).applyInPandas(run, ddl)
    cut = _pieces(rows.alias("r").join(large.alias("l"), same, "left_semi"), group, order, fold)
    return usual.unionByName(cut.groupBy(*group, "_piece").applyInPandas(run, ddl))
