"""Exact distinct users on a stream, with state that grows with the users of a
slide-long bucket and not with the windows they fall into.

State of a page: per user the buckets they were seen in, and per open window
its three counts.  A record changes the counts of a window only if its user was
in none of the window's other buckets.  When the watermark has passed a window,
its counts go, and so do buckets (and users) that no open window covers; an
event-time timer sweeps once per window length.

Tasks combine their records by (page, bucket, user) before the shuffle, so a
page of a third of all records reaches its task as its distinct users.

A (row, window) pair counts unless the window had ended at the watermark of
its own batch (``late_pairs(..., own_batch=True)`` names the others).
"""

from __future__ import annotations

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from clickpulse.operators.metrics import abandonment, interval_seconds, page_key
from clickpulse.session import ship_package

US = 1_000_000
_OUT = "page_url string, start_us bigint, active_users bigint, cart_additions bigint, purchases bigint"


class UserProcessor(StatefulProcessor):
    def __init__(self, length_s: int, slide_s: int):
        if length_s % slide_s:
            raise ValueError("the window length must be a multiple of the slide")
        self.slide, self.span = slide_s * US, length_s // slide_s

    def init(self, handle) -> None:
        self.handle = handle
        self.users = handle.getMapState("users", "user_id string", "buckets array<bigint>")
        self.windows = handle.getMapState("windows", "start bigint", "users bigint, adds bigint, purchases bigint")

    def _open_from(self, timerValues) -> int:
        """The first window start (in slides) whose window is still open."""
        mark = max(0, timerValues.getCurrentWatermarkInMs()) * 1000
        return mark // self.slide - self.span + 1

    def handleInputRows(self, key, rows, timerValues):
        batch = pd.concat(rows)
        first = self._open_from(timerValues)
        batch = batch[batch["bucket"] >= first]
        if not len(batch):
            return
        change: dict[int, list[int]] = {}

        def windows_of(bucket):
            return range(max(first, bucket - self.span + 1), bucket + 1)

        sums = batch.groupby("bucket")[["adds", "purchases"]].sum()
        for bucket, adds, purchases in sums.itertuples():
            for w in windows_of(int(bucket)):
                c = change.setdefault(w, [0, 0, 0])
                c[1] += int(adds)
                c[2] += int(purchases)
        named = batch[batch["user_id"].notna()]
        for user, buckets in named.groupby("user_id")["bucket"].unique().items():
            stored = self.users.getValue((user,))
            known = set(stored[0]) if stored else set()
            had = len(known)
            known = {b for b in known if b >= first}
            for b in sorted(int(x) for x in buckets):
                if b not in known:
                    for w in windows_of(b):
                        if not any(x in known for x in range(w, w + self.span)):
                            change[w][0] += 1
                    known.add(b)
            if len(known) != had or not stored:
                self.users.updateValue((user,), (sorted(known),))
        out = []
        for w, c in sorted(change.items()):
            old = self.windows.getValue((w,)) or (0, 0, 0)
            now = tuple(int(a) + b for a, b in zip(old, c))
            self.windows.updateValue((w,), now)
            out.append((key[0], w * self.slide, *now))
        # when the newest window that a record of now can be in has ended, in whole lengths
        end, length = (int(batch["bucket"].max()) + self.span) * self.slide, self.span * self.slide
        self.handle.registerTimer(-(-end // length) * length // 1000)
        yield pd.DataFrame(out, columns=["page_url", "start_us", "active_users", "cart_additions", "purchases"])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        first = self._open_from(timerValues)
        for (w,) in list(self.windows.keys()):
            if w < first:
                self.windows.removeKey((w,))
        for (user,), (buckets,) in list(self.users.iterator()):
            left = [b for b in buckets if b >= first]
            if not left:
                self.users.removeKey((user,))
            elif len(left) < len(buckets):
                self.users.updateValue((user,), (left,))
        return iter(())

    def close(self) -> None:
        pass


_KEYS = ["page_url", "bucket", "user_id"]


def _combined(batches):
    """Records of a task, a few batches at a time, by page, bucket and user."""
    held, rows = [], 0

    def combine():
        t = pa.Table.from_batches(held).group_by(_KEYS).aggregate([("adds", "sum"), ("purchases", "sum")])
        t = t.select([*_KEYS, "adds_sum", "purchases_sum"]).rename_columns([*_KEYS, "adds", "purchases"])
        t = t.set_column(3, "adds", pc.cast(t["adds"], pa.int64())).set_column(4, "purchases", pc.cast(t["purchases"], pa.int64()))
        return t.combine_chunks().to_batches()

    for b in batches:
        held.append(b)
        rows += b.num_rows
        if rows >= 100_000:
            yield from combine()
            held, rows = [], 0
    if rows:
        yield from combine()


def exact_page_metrics(events: DataFrame, length: str = "60 seconds", slide: str | None = "10 seconds") -> DataFrame:
    """``page_metrics`` with exact users over a stream with a watermark on
    ``event_time``: the windows that a batch changed, with all their counts."""
    ship_package(events.sparkSession)
    slide_s = interval_seconds(slide or length)
    is_type = lambda t: F.coalesce(F.col("event_type") == t, F.lit(False)).cast("bigint")
    # the time goes on as a number, so that rows are judged window by window
    rows = events.filter(F.col("event_time").isNotNull()).select(
        page_key(F.col("page_url")).alias("page_url"), F.floor(F.unix_micros("event_time") / (slide_s * US)).cast("bigint").alias("bucket"),
        "user_id", is_type("cart_add").alias("adds"), is_type("purchase").alias("purchases"))
    combined = rows.mapInArrow(_combined, rows.schema)
    processor = UserProcessor(interval_seconds(length), slide_s)
    found = combined.groupBy("page_url").transformWithStateInPandas(processor, _OUT, "Update", "EventTime")
    start = F.timestamp_micros("start_us")
    return found.select(start.alias("window_start"), F.timestamp_micros(F.col("start_us") + interval_seconds(length) * US).alias("window_end"),
                        "page_url", "active_users", "cart_additions", "purchases",
                        abandonment(F.col("cart_additions"), F.col("purchases")).alias("cart_abandonment_rate"))
