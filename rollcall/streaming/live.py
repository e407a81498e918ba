"""Operators whose state outlives a micro-batch: live captions, and recordings that wait for their event."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from rollcall.operators.segments import TurnFold, WordFold


def live_segments(rows: DataFrame, group: str, order: str, fold: TurnFold | WordFold, wait: str | None = None) -> DataFrame:
    """Segments of a stream of rows (group, order, the fold's columns, ``ended``), each as soon as it is closed.

    What is open stays in the state from batch to batch, so any cut of the rows into batches gives the segments that
    the whole group gives at once. A row that says ``ended`` closes what is open; ``wait`` does so for groups that
    have been silent for that long. A batch's rows are put in order; rows of earlier batches are taken to be earlier.
    """
    kind = rows.schema[group].dataType.simpleString()
    names = [x.split()[0] for x in fold.schema.split(", ")]
    cls, start = fold.__class__, {k: v for k, v in vars(fold).items() if k != "open"}

    def run(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        now = cls.__new__(cls)
        vars(now).update(start, open=[tuple(x) for x in json.loads(state.get[0])] if state.exists else [])
        out: list[tuple] = []
        if state.hasTimedOut:
            out += now.finish()
        else:
            frame = pd.concat(list(frames)).sort_values(order, kind="stable")
            for ended, *row in zip(frame["ended"], *[frame[c] for c in now.takes], strict=True):
                if ended:
                    out += now.finish()
                else:
                    out += now.push(*row)
        if now.open:
            state.update((json.dumps(now.open),))
            if wait:
                state.setTimeoutDuration(wait)
        elif state.exists:
            state.remove()
        frame = pd.DataFrame(out, columns=names)
        frame.insert(0, group, key[0])
        yield frame

    timeout = GroupStateTimeout.ProcessingTimeTimeout if wait else GroupStateTimeout.NoTimeout
    return rows.groupBy(group).applyInPandasWithState(run, f"{group} {kind}, {fold.schema}", "open string", "append", timeout)


HALVES = "key string, event string, recording string, matched boolean"


class _Halves(StatefulProcessor):
    """The first event of a key, and its recordings until there is one."""

    def __init__(self, wait_ms: int) -> None:
        self.wait_ms = wait_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.event = handle.getValueState("event", "id string, at long")
        self.waiting = handle.getListState("waiting", "id string, until long")

    def _out(self, key: tuple, pairs: list[tuple]) -> pd.DataFrame:
        return pd.DataFrame([(key[0], e, r, e is not None) for e, r in pairs], columns=["key", "event", "recording", "matched"])

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802
        frame = pd.concat(list(rows)).sort_values(["at", "id"], kind="stable")
        moment = lambda at: int(at.timestamp() * 1000)
        found = [(e, moment(at)) for e, at in frame.loc[frame["kind"] == "event", ["id", "at"]].itertuples(index=False)]
        new = [(r, moment(at) + self.wait_ms) for r, at in frame.loc[frame["kind"] == "recording", ["id", "at"]].itertuples(index=False)]
        event = tuple(self.event.get()) if self.event.exists() else None
        if event is None and found:
            event = found[0]
            self.event.update(event)
        pairs: list[tuple] = []
        if event is not None:
            # an event that comes when the wait is over is none for the recording
            pairs = [(event[0] if event[1] <= until else None, r) for r, until in [*map(tuple, self.waiting.get()), *new]]
            self.waiting.clear()
        else:
            for r, until in new:
                self.waiting.appendValue((r, until))
                self.handle.registerTimer(until)
        yield self._out(key, pairs)

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802
        now = expiredTimerInfo.getExpiryTimeInMs()
        held = [(r[0], r[1]) for r in self.waiting.get()]
        self.waiting.clear()
        for r in held:
            if r[1] > now:
                self.waiting.appendValue(r)
        yield self._out(key, [(None, r) for r, until in held if until <= now])

    def close(self) -> None:
        pass


def late_halves(rows: DataFrame, wait: str = "7 days", late: str = "1 hour") -> DataFrame:
    """(key, event, recording, matched) of a stream of rows (kind: event or recording, key, id, at).

    A recording is matched with the first event of its key, whichever comes first, if that is not more than ``wait``
    behind it; else it comes out unmatched, once the stream's time is past that. Rows that come more than ``late`` behind the
    stream's time are dropped. The state of a key is its event and what waits.
    Needs the RocksDB state store (spark.sql.streaming.stateStore.providerClass).
    """
    ms = int(pd.Timedelta(wait).total_seconds() * 1000)
    keyed = rows.withWatermark("at", late).select(F.col("key").cast("string"), "kind", F.col("id").cast("string"), "at")
    return keyed.groupBy("key").transformWithStateInPandas(statefulProcessor=_Halves(ms), outputStructType=HALVES, outputMode="append", timeMode="eventTime")
