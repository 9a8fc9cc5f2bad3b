"""Streaming click attribution against the list last served to each user.

Every user has a state of their own: the newest list before the watermark, and the lists and clicks
after it, which late rows can still change. A click is answered in the micro-batch it comes in; a list
that comes after its click corrects the answer in a later micro-batch. State is kept by RocksDB beside
the checkpoint, and a timer ends it when a user is served no more.
"""

from __future__ import annotations

import sys
from bisect import bisect_right
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor

from marquee.streaming.ingest import ROCKSDB, run_available

# Ship the processor inside the tasks, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

STATE = """lists ARRAY<STRUCT<at: BIGINT, id: BIGINT, items: ARRAY<STRING>, model: STRING>>,
  clicks ARRAY<STRUCT<at: BIGINT, id: BIGINT, item: STRING, list_at: BIGINT, list_id: BIGINT>>, timer BIGINT"""
ANSWER = "event_id BIGINT, served_event BIGINT, model_version STRING, matched BOOLEAN"
NEVER = -(1 << 62)


class Attribution(StatefulProcessor):
    """Answers for the clicks of one user; times are microseconds."""

    def __init__(self, keep: int):
        self.keep = keep

    def init(self, handle) -> None:
        self.handle = handle
        self.state = handle.getValueState("served", STATE)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        held = self.state.get() if self.state.exists() else ([], [], 0)
        lists, clicks, timer = [tuple(x) for x in held[0]], [tuple(x) for x in held[1]], held[2]
        fresh = []
        for frame in rows:
            for event, at, items, model, item in zip(*(frame[c] for c in ("event_id", "at", "items", "model_version", "item_id"))):
                at = NEVER if pd.isna(at) else int(at)
                if items is not None:
                    lists.append((at, int(event), [str(i) for i in items], model))
                if item is not None:
                    fresh.append((at, int(event), item, None, None))
        lists.sort(key=lambda x: x[:2])
        order = [x[:2] for x in lists]
        answers, waiting = [], []
        for at, event, item, list_at, list_id in [*clicks, *fresh]:
            place = bisect_right(order, (at, 1 << 62)) - 1
            seen = lists[place] if place >= 0 and lists[place][0] >= at - self.keep else None
            now = seen[:2] if seen else (None, None)
            waiting.append((at, event, item, *now))
            if now != (list_at, list_id) or len(waiting) > len(clicks):  # a late list, or a click not answered yet
                answers.append((event, now[1], seen[3] if seen else "unknown", bool(seen and item in seen[2])))
        self._store(lists, waiting, timer, timerValues)
        if answers:
            yield pd.DataFrame(answers, columns=["event_id", "served_event", "model_version", "matched"]).astype({"served_event": "Int64"})

    def _store(self, lists: list, clicks: list, timer: int, timerValues) -> None:
        """Keep what a row after the watermark can still meet: later rows, and the newest list before."""
        mark = timerValues.getCurrentWatermarkInMs() * 1000
        before = [x for x in lists if x[0] <= mark][-1:]
        lists = [x for x in before if x[0] >= mark - self.keep] + [x for x in lists if x[0] > mark]
        clicks = [x for x in clicks if x[0] > mark]
        if not lists and not clicks:
            self.state.clear()
            return
        if not timer:
            timer = (max(x[0] for x in [*lists, *clicks]) + self.keep) // 1000 + 1
            timer = max(timer, timerValues.getCurrentWatermarkInMs() + 1)
            self.handle.registerTimer(timer)
        self.state.update((lists, clicks, timer))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if self.state.exists():
            lists, clicks, _ = self.state.get()
            self._store([tuple(x) for x in lists], [tuple(x) for x in clicks], 0, timerValues)
        yield from ()

    def close(self) -> None:
        pass


def attribute_clicks(events: DataFrame, out: str, checkpoint: str, keep: str = "24 hours", late: str = "2 hours") -> None:
    """Match each click of a stream with the list last served to its user, at most ``keep`` before.

    ``events`` holds served rows (``items`` set) and click rows (``item_id`` set). Rows may come up to
    ``late`` after the newest row seen. Every answer is written with its micro-batch, which a repetition
    replaces; ``attributed`` reads the newest answer of every click.
    """
    spark = events.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    horizon = spark.range(1).select(F.expr(f"INTERVAL {keep}").cast("interval day to second").alias("k")).first()["k"]
    rows = events.withWatermark("ts", late).withColumn("at", F.unix_micros("ts"))
    answers = rows.groupBy("user_id").transformWithStateInPandas(
        Attribution(int(horizon.total_seconds() * 1_000_000)), outputStructType=ANSWER, outputMode="update", timeMode="eventTime"
    )

    def store(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={number}")

    run_available(answers.writeStream.outputMode("update").foreachBatch(store), checkpoint)


def attributed(spark: SparkSession, out: str) -> DataFrame:
    """The newest answer for every click."""
    stored = spark.read.schema(f"{ANSWER}, batch BIGINT").parquet(out)
    columns = ["served_event", "model_version", "matched"]
    newest = stored.groupBy("event_id").agg(F.max_by(F.struct(*columns), "batch").alias("a"))
    return newest.select("event_id", "a.*")
