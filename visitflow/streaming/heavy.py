"""Heavy clickers of a stream, found at the click that makes them heavy.

``transformWithState`` keeps, per user, the clicks of each (day, ad) that has not ended and whether the user
was reported.  The reported users are all that stays for ever: a day's counts go with an event-time timer once
the watermark has passed its end, and those of a reported user at once.  (Spark offers a time to live only
for processing time, under which a replay could forget other days, so days end by timer.)
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo, StatefulProcessor, StatefulProcessorHandle, TimerValues

from visitflow.functions.predicates import all_not_null

HEAVY_SCHEMA = T.StructType([
    T.StructField("user_id", T.LongType()),
    T.StructField("click_date", T.DateType()),
    T.StructField("ad_id", T.LongType()),
    T.StructField("listed_at", T.TimestampType()),
])
_EPOCH = dt.date(1970, 1, 1)
_DAY_MS = 86_400_000


class HeavyClickers(StatefulProcessor):
    """Reports a user once, with the day, ad and time of click number ``threshold`` (in order of arrival)."""

    def __init__(self, threshold: int):
        self.threshold = threshold

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.listed = handle.getValueState("listed", T.StructType([T.StructField("listed", T.BooleanType())]))
        self.counts = handle.getMapState(
            "counts", T.StructType([T.StructField("day", T.LongType()), T.StructField("ad_id", T.LongType())]),
            T.StructType([T.StructField("clicks", T.LongType())]))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues: TimerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        if self.listed.exists():
            for _ in rows:
                pass
            return
        counts: dict[tuple[int, int], int] = {}
        new_days: set[int] = set()
        found = None
        for chunk in rows:
            if found is not None:
                continue
            for (day, ad), ts in chunk.groupby([chunk["click_date"], chunk["ad_id"]])["ts"]:
                place = ((day - _EPOCH).days, int(ad))
                if place not in counts:
                    known = self.counts.containsKey(place)
                    counts[place] = self.counts.getValue(place)[0] if known else 0
                    if not known:
                        new_days.add(place[0])
                before = counts[place]
                counts[place] = before + len(ts)
                if before < self.threshold <= counts[place]:
                    crossing = (ts.index[self.threshold - before - 1], day, place[1], ts.iloc[self.threshold - before - 1])
                    found = crossing if found is None else min(found, crossing)
        if found is None:
            for place, n in counts.items():
                self.counts.updateValue(place, (n,))
            for day in new_days:
                self.handle.registerTimer((day + 1) * _DAY_MS)
            return
        self.listed.update((True,))
        self._forget()
        yield pd.DataFrame({"user_id": [key[0]], "click_date": [found[1]], "ad_id": [found[2]], "listed_at": [found[3]]})

    def handleExpiredTimer(self, key, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        ended = expiredTimerInfo.getExpiryTimeInMs() // _DAY_MS
        for place in [p for p in self.counts.keys() if p[0] < ended]:
            self.counts.removeKey(place)
        return iter(())

    def _forget(self) -> None:
        self.counts.clear()
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)

    def close(self) -> None:
        pass


def heavy_clickers(clicks: DataFrame, threshold: int = 100, watermark_delay: str = "1 day") -> DataFrame:
    """``(user_id, click_date, ad_id, listed_at)`` of every user of a stream of clicks with ``threshold`` clicks on one
    ad on one day, once.  Equals ``blacklist_candidates`` over the counts; clicks later than the watermark are dropped.

    Needs the RocksDB state store.  Clicks of one micro-batch are read in Arrow batches, so a user with a
    large share of them takes time, not memory."""
    known = clicks.where(all_not_null("user_id", "ad_id", "click_date", "ts")).select("user_id", "click_date", "ad_id", "ts")
    return known.withWatermark("ts", watermark_delay).groupBy("user_id").transformWithStateInPandas(
        statefulProcessor=HeavyClickers(int(threshold)), outputStructType=HEAVY_SCHEMA, outputMode="append", timeMode="eventTime"
    ).select(*(F.col(f.name) for f in HEAVY_SCHEMA))
