"""Near copies and chunks of a stream, with typed state and timers (RocksDB state stores).

State of a chat are its waiting rows, one map entry each, and a few numbers: a row is
written once when it comes and removed once when it is decided.  What waits is bounded by
the window and the watermark's delay.
"""

from __future__ import annotations

from bisect import bisect_right

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StatefulProcessor

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def use_rocksdb(spark: SparkSession) -> None:
    """Typed state needs this store; queries started afterwards use it."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)


def micros(times: pd.Series) -> list[int]:
    return times.astype("datetime64[us]").astype("int64").tolist()


class NearCopies(StatefulProcessor):
    """The time at which a text of a chat was kept last; forgotten once no row in time can be near it."""

    def __init__(self, span_us: int, columns: list[str]):
        self.span_us, self.columns = span_us, columns

    def init(self, handle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "at long")

    def handleInputRows(self, key, rows, timerValues):
        rows = pd.concat(list(rows)).sort_values(["ts", "msg_id"], kind="stable")
        last, keep = self.last.get()[0] if self.last.exists() else None, []
        for user, at in zip(rows["type"] == "user", micros(rows["ts"]), strict=True):
            copy = not user and last is not None and at <= last + self.span_us
            keep.append(not copy)
            if not user and not copy:
                last = at
        if last is not None:
            self.last.update((last,))
            for old in list(self.handle.listTimers()):
                self.handle.deleteTimer(old)
            self.handle.registerTimer(max((last + self.span_us) // 1000 + 1, timerValues.getCurrentWatermarkInMs() + 1))
        yield rows[keep][self.columns]

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        self.last.clear()
        yield pd.DataFrame(columns=self.columns)

    def close(self) -> None:
        pass


class Chunks(StatefulProcessor):
    """Waiting rows of a chat by time and id, the last chunk's number, and the time of the bot row before.

    A user's window is decided when the watermark is past its end, a bot row outside of windows when it is
    past the row.  ``forget_us`` after its last row a chat without waiting rows is forgotten (None: its two
    numbers stay, as later rows must go on from them).
    """

    def __init__(self, gap_us: int, window_us: int, reply_us: int, forget_us: int | None):
        self.gap_us, self.window_us, self.reply_us, self.forget_us = gap_us, window_us, reply_us, forget_us

    def init(self, handle) -> None:
        self.handle = handle
        self.waiting = handle.getMapState("waiting", "at long, msg_id long", "kind string")
        self.done = handle.getValueState("done", "number long, prior long, last long")

    def handleInputRows(self, key, rows, timerValues):
        for f in rows:
            for at, i, kind in zip(micros(f["ts"]), f["msg_id"].tolist(), f["type"].tolist(), strict=True):
                self.waiting.updateValue((at, i), (kind,))
        yield self._decide(key[0], timerValues)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        yield self._decide(key[0], timerValues)

    def _decide(self, chat, timerValues) -> pd.DataFrame:
        mark = timerValues.getCurrentWatermarkInMs() * 1000
        number, prior, last = self.done.get() if self.done.exists() else (0, None, None)
        rows = sorted((at, i, kind[0]) for (at, i), kind in self.waiting.iterator())
        times, out, at = [r[0] for r in rows], [], 0
        while at < len(rows) and times[at] < mark:
            start, i, kind = rows[at]
            if kind != "user":
                number += prior is None or start - prior > self.gap_us
                out.append((chat, i, number, "bot_only"))
                prior, at = start, at + 1
                continue
            if mark <= start + self.window_us:
                break
            end = bisect_right(times, start + self.window_us)
            latest = max(t for t, _, k in rows[at:end] if k == "user")
            if latest != start:
                end = bisect_right(times, latest + self.reply_us, at, end)
            number, prior = number + 1, None
            out += [(chat, i, number, "user_engaged") for _, i, _ in rows[at:end]]
            at = end
        for t, i, _ in rows[:at]:
            self.waiting.removeKey((t, i))
        last = times[-1] if times else last
        self.done.update((number, prior, last))
        for old in list(self.handle.listTimers()):
            self.handle.deleteTimer(old)
        if at < len(rows):
            self._wake(times[at] + (self.window_us if rows[at][2] == "user" else 0), mark)
        elif self.forget_us is not None and last is not None:
            if mark > last + self.forget_us:
                self.done.clear()
            else:
                self._wake(last + self.forget_us, mark)
        return pd.DataFrame(out, columns=["chat_id", "msg_id", "chunk_no", "kind"])

    def _wake(self, due_us: int, mark: int) -> None:
        self.handle.registerTimer(max(due_us // 1000 + 1, mark // 1000 + 1))

    def close(self) -> None:
        pass


def without_near_copies(stream: DataFrame, span_us: int = 2_000_000, delay: str = "10 minutes") -> DataFrame:
    """Rows less those not from users whose text was kept at most ``span_us`` earlier in the chat.

    Rows of a batch are taken in order of time and id.
    """
    use_rocksdb(stream.sparkSession)
    rows = stream.withWatermark("ts", delay).groupBy("chat_id", "message")
    return rows.transformWithStateInPandas(NearCopies(span_us, [f.name for f in stream.schema.fields]), stream.schema, "append", "eventTime")


def chunks(stream: DataFrame, gap_us: int = 60_000_000, window_us: int = 3 * 86_400_000_000, reply_us: int = 3_600_000_000, delay: str = "10 minutes", forget_us: int | None = None) -> DataFrame:
    """chat_id, msg_id, chunk_no and kind of each row, as the chunks of a table have them, once no row in time can change them.

    Rows later than the watermark are left to ``replay.segment_batches``.
    """
    use_rocksdb(stream.sparkSession)
    rows = stream.withWatermark("ts", delay).groupBy("chat_id")
    return rows.transformWithStateInPandas(Chunks(gap_us, window_us, reply_us, forget_us), "chat_id long, msg_id long, chunk_no long, kind string", "append", "eventTime")
