"""Spacing of requests as a stream with state: requests come in, leases come out when they are due.

Requests are kept apart within a lane: the whole run where the spacing is global, a host where
each host has its own. A lane's state is its waiting requests, the time before which it may not
lease again, and the hosts that turned out to be walls. A timer wakes the lane when its next
lease is due; requests to a wall are then skipped and take no time. The plan does not depend on how
many requests wait, and a run that ends goes on from its checkpoint where it was.

Time is event time: that of the requests, held back by the delay that late ones are given. Rows
that come later than that are dropped by the stream.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ..session import shared_dir

#: What comes in: requests, and hosts that blocked one (`wall`, no url).
INPUT = "lane string, seq long, at timestamp, url string, host string, preprint boolean, wall boolean"
LEASE = "lane string, seq long, url string, host string, lease_ms long, skipped boolean"
SPACING_MS, PREPRINT_MS = 3_000, 15_000
#: The lane of a marker that ends a bounded input.
END = ""


class Lane(StatefulProcessor):
    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.queue = handle.getListState("queue", "seq long, at long, url string, host string, preprint boolean")
        self.due = handle.getValueState("due", "any long, preprint long")
        self.walls = handle.getMapState("walls", "host string", "since long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        first = None
        for batch in rows:
            at = batch["at"].astype("datetime64[us]").astype("int64") // 1000
            for host, since in zip(batch["host"][batch["wall"]], at[batch["wall"]], strict=True):
                if not self.walls.containsKey((host,)):
                    self.walls.updateValue((host,), (int(since),))
            new = [(int(s), int(t), u, h, bool(p)) for s, t, u, h, p, w in zip(batch["seq"], at, batch["url"], batch["host"], batch["preprint"], batch["wall"], strict=True) if not w]
            if new:
                self.queue.appendList(new)
                first = min([r[1] for r in new] + ([] if first is None else [first]))
        if first is not None:
            self.handle.registerTimer(max(first, timerValues.getCurrentWatermarkInMs() + 1))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        """All leases that are due by now, in order of arrival; a timer for the next one."""
        now = timerValues.getCurrentWatermarkInMs()
        free, free_preprint = self.due.get() if self.due.exists() else (0, 0)
        waiting = sorted((r[1], r[0], *r[2:]) for r in self.queue.get())
        out, done = [], 0
        for at, seq, url, host, preprint in waiting:
            start = max(at, free, free_preprint if preprint else 0)
            if start > now:
                break
            wall = self.walls.containsKey((host,)) and self.walls.getValue((host,))[0] <= start
            if not wall:
                free, free_preprint = start + SPACING_MS, start + PREPRINT_MS if preprint else free_preprint
            out.append((key[0], seq, url, host, start, wall))
            done += 1
        rest = waiting[done:]
        if done:
            self.due.update((free, free_preprint))
            if rest:
                self.queue.put([(seq, at, url, host, preprint) for at, seq, url, host, preprint in rest])
            else:
                self.queue.clear()
        if rest:
            at, _, _, _, preprint = rest[0]
            self.handle.registerTimer(max(at, free, free_preprint if preprint else 0, now + 1))
        if out:
            yield pd.DataFrame(out, columns=[c.split()[0] for c in LEASE.split(", ")])

    def close(self) -> None:
        pass


def leases(requests: DataFrame, delay: str = "10 seconds") -> DataFrame:
    """LEASE of a stream of INPUT. Needs the state store that keeps timers, see `settings`."""
    rows = requests.withWatermark("at", delay)
    return rows.groupBy("lane").transformWithStateInPandas(Lane(), LEASE, "Append", "eventTime").where(F.col("lane") != END)


def settings(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


def run_once(spark: SparkSession, inbox: str, out: str, checkpoint: str, delay: str = "10 seconds") -> None:
    """Leases what can be leased by the requests (Parquet, INPUT) that came since the last run."""
    settings(spark)
    stream = spark.readStream.schema(INPUT).option("recursiveFileLookup", "true").parquet(inbox)
    leases(stream, delay).writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def schedule(parts: list[DataFrame], delay: str = "10 seconds") -> DataFrame:
    """The leases of requests (INPUT) that came in parts, a run each, until the last one is leased.

    A marker far ahead of all requests ends the input, so that time passes every one of them.
    """
    spark = parts[0].sparkSession
    root = shared_dir(spark)
    for i, part in enumerate(parts):
        part.write.parquet(f"{root}/inbox/{i}")
        run_once(spark, f"{root}/inbox", f"{root}/leases", f"{root}/checkpoint", delay)
    everything = spark.read.schema(INPUT).option("recursiveFileLookup", "true").parquet(f"{root}/inbox")
    ends = everything.groupBy("lane").agg(F.count("*").alias("n"), F.max("at").alias("at")).agg(F.max("n").alias("n"), F.max("at").alias("at"))
    far = F.timestamp_micros(F.unix_micros("at") + (F.col("n") + 1) * PREPRINT_MS * 1000 + 86_400_000_000)
    none = F.lit(None)
    marker = ends.where("at is not null").select(F.lit(END).alias("lane"), F.lit(-1).cast("long").alias("seq"), far.alias("at"), none.cast("string").alias("url"), none.cast("string").alias("host"), F.lit(False).alias("preprint"), F.lit(False).alias("wall"))
    marker.write.parquet(f"{root}/inbox/end")
    run_once(spark, f"{root}/inbox", f"{root}/leases", f"{root}/checkpoint", delay)
    return spark.read.schema(LEASE).parquet(f"{root}/leases")
