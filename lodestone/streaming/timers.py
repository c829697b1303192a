"""Schedules as keyed state with timers: which connector is due when, from which cursor, and what is forgotten.

A stream of notices (connector, kind, at, every, cursor) keeps one state a connector, and event time drives the timers:

schedule  the connector runs every so many seconds from ``at`` on; a later schedule takes the place of one before
done      a run has ended: the cursor moves on, never back, and the schedule counts from here
delete    no more runs; the connector's tombstone is kept for ``keep`` seconds, in which late notices change nothing

Out come rows (connector, kind, at, cursor): due, with the time that was asked for and the cursor to go on from, and
expired, when a tombstone goes. State and timers are in the checkpoint, so a restarted query goes on where it was: no due
time is lost, and none comes twice. Where time passes several due times at once, each has its row.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import datetime, timezone
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

OUTPUT = "connector string, kind string, at timestamp, cursor string"
#: Where state with timers is kept.
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
NONE = 0


def _millis(t: Any) -> int:
    t = pd.Timestamp(t)
    return int((t.tz_localize("UTC") if t.tzinfo is None else t).timestamp() * 1000)


class Schedule(StatefulProcessor):
    def __init__(self, keep: int) -> None:
        self.keep = keep

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        # every: milliseconds; due: of the timer that counts; dead: when the tombstone goes; 0 for none
        self.state = handle.getValueState("schedule", "every long, due long, dead long, cursor string")

    def _get(self) -> list:
        return list(self.state.get()) if self.state.exists() else [NONE, NONE, NONE, None]

    def _timer(self, at: int, before: int) -> None:
        if before:
            self.handle.deleteTimer(before)
        self.handle.registerTimer(at)

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        every, due, dead, cursor = self._get()
        notices = pd.concat(list(rows))
        for n in notices.sort_values(["at", "kind"], kind="stable").itertuples():
            if dead:
                continue
            at = _millis(n.at)
            if n.kind == "delete":
                dead = at + 1000 * self.keep
                self._timer(dead, due)
                due = NONE
            elif n.kind == "schedule" and n.every and n.every > 0:
                every, before = 1000 * int(n.every), due
                due = at + every
                self._timer(due, before)
            elif n.kind == "done":
                if n.cursor is not None and (cursor is None or n.cursor > cursor):
                    cursor = n.cursor
                if every and at + every > due:
                    self._timer(at + every, due)
                    due = at + every
        self.state.update((every, due, dead, cursor))
        yield pd.DataFrame({c: pd.Series(dtype=t) for c, t in (("connector", "object"), ("kind", "object"), ("at", "datetime64[ns]"), ("cursor", "object"))})

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        every, due, dead, cursor = self._get()
        fired = expiredTimerInfo.getExpiryTimeInMs()
        time = lambda ms: datetime.fromtimestamp(ms / 1000, timezone.utc).replace(tzinfo=None)
        if dead:
            if fired >= dead:
                self.state.clear()
                yield pd.DataFrame({"connector": [key[0]], "kind": ["expired"], "at": [time(dead)], "cursor": [cursor]})
            return
        if fired != due:
            return
        now, times = max(timerValues.getCurrentWatermarkInMs(), due), []
        while due <= now:
            times.append(due)
            due += every
        self.handle.registerTimer(due)
        self.state.update((every, due, dead, cursor))
        yield pd.DataFrame({"connector": [key[0]] * len(times), "kind": ["due"] * len(times), "at": [time(t) for t in times], "cursor": pd.Series([cursor] * len(times), dtype="object")})

    def close(self) -> None:
        pass


def schedules(notices: DataFrame, late: str = "10 minutes", keep: int = 86_400) -> DataFrame:
    """The rows of a streaming query; ``late`` is how far behind the newest notice others may come, ``keep`` seconds that a
    tombstone stays. The session's spark.sql.streaming.stateStore.providerClass must be ROCKS."""
    rows = notices.select("connector", "kind", "at", "every", "cursor").withWatermark("at", late)
    return rows.groupBy("connector").transformWithStateInPandas(Schedule(keep), OUTPUT, "Append", "EventTime")

