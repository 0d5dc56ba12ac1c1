"""Conversation turns put together from batches, as a stateful streaming query.

Turns of a conversation arrive in any order, some more than once. State holds its kept turns as fragments,
maximal runs of neighbouring turns, in two maps: `starts` leads from a fragment's first turn to its last turn,
role breaks and roles at both ends, `ends` from its last turn to its first. An arriving turn looks up the
fragment that ends before it and the one that starts after it, and the three become one: their breaks add up,
and one more counts wherever a role repeats at a seam. A fragment that starts at the next turn to release is
released whole. So an arrival costs a constant number of look-ups, however many turns are held; contents of
turns that wait lie in a third map, one entry each.

The clock is the number of the batch, as event time: every batch holds a tick beside its rows, so batches
without turns count too. The watermark in a batch is the number of the batch before. A conversation's timer is
set to the batch after its last arrival, and goes off in the next one: `patience` batches have passed
without an arrival. It is moved only when it goes off, not with every arrival.

A conversation is one key of the state: its turns meet in one task by the order they are released in, one row
at a time; what is held of it is in the state store, not in memory.

Defined results: rows without a turn are dropped; null roles and texts are empty; null conversation ids
are a conversation of their own; of a turn's rows in a batch the smallest payload (role|text in UTF-8 bytes;
ties: the smallest role) arrives; a turn below `first` counts as kept; an empty table gives an empty result;
further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor
from pyspark.sql.types import StructType

from weft.llm.common import scratch
from weft.session import ship
from weft.sources.writers import _filesystem, _renamed

ARRIVAL = "batch int, tick boolean, at timestamp, conv_id long, turn long, first long, role string, text string"
EVENT = "event string, conv_id long, turn long, batch long, role string, text string, waiting string, n_missing long, n_breaks long"
#: Event time of the ticks that end a stream, in batches: later than any batch.
LAST = 1 << 30
PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class Reassembly(StatefulProcessor):
    """Events of conversations: release, reject and close. `end` is the number that a conversation closes in
    which is still open when the stream ends."""

    def __init__(self, end: int, patience: int = 2):
        self.end, self.patience = end, patience

    def init(self, handle) -> None:
        self.handle = handle
        # next: the turn to release; kept, largest: number and largest of all kept turns; last: batch of the last arrival.
        self.head = handle.getValueState("head", "first long, next long, role string, breaks long, kept long, largest long, last long, closed boolean")
        self.starts = handle.getMapState("starts", "start long", "end long, breaks long, first_role string, last_role string")
        self.ends = handle.getMapState("ends", "end long", "start long")
        self.waiting = handle.getMapState("waiting", "turn long", "role string, text string")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        if key[1]:
            return  # a tick
        head = self.head.get()
        timed = head is not None
        for r in rows:
            if head is None:
                head = (r.first, r.first, None, 0, 0, r.first - 1, r.batch, False)
            first, next, role, breaks, kept, largest, _, closed = head
            if closed:
                yield self._event("reject", key, r.turn, r.batch, r.role, r.text)
                continue
            if r.turn >= next and (r.turn == next or not self.waiting.containsKey((r.turn,))):
                start, end, own, low, high = self._joined(r.turn, r.role)
                if start == next:
                    yield from self._released(key, r, end)
                    breaks += own + (next > first and low == role)
                    next, role = end + 1, high
                else:
                    self.waiting.updateValue((r.turn,), (r.role, r.text))
                    self.starts.updateValue((start,), (end, own, low, high))
                    self.ends.updateValue((end,), (start,))
                kept, largest = kept + 1, max(largest, r.turn)
            head = (first, next, role, breaks, kept, largest, r.batch, False)
        if head is not None and not head[7]:
            if not timed:
                self.handle.registerTimer(self._due(head[6]))
            self.head.update(head)

    def _joined(self, turn: int, role: str) -> tuple[int, int, int, str, str]:
        """(start, end, breaks, first role, last role) of the fragment that a turn makes with its neighbours,
        which leave the maps."""
        start = end = turn
        low = high = role
        breaks = 0
        left, right = self.ends.getValue((turn - 1,)), self.starts.getValue((turn + 1,))
        if left is not None:
            (start,) = left
            _, own, low, before = self.starts.getValue((start,))
            breaks += own + (before == role)
            self.ends.removeKey((turn - 1,))
            self.starts.removeKey((start,))
        if right is not None:
            end, own, after, high = right
            breaks += own + (after == role)
            self.starts.removeKey((turn + 1,))
            self.ends.removeKey((end,))
        return start, end, breaks, low, high

    def _released(self, key, r: Row, end: int) -> Iterator[Row]:
        yield self._event("release", key, r.turn, r.batch, r.role, r.text)
        for turn in range(r.turn + 1, end + 1):
            role, text = self.waiting.getValue((turn,))
            self.waiting.removeKey((turn,))
            yield self._event("release", key, turn, r.batch, role, text)

    @staticmethod
    def _event(event: str, key, turn: int, batch: int, role: str | None, text: str | None, waiting: str | None = None, missing: int | None = None, breaks: int | None = None) -> Row:
        return Row(event=event, conv_id=key[0], turn=turn, batch=batch, role=role, text=text, waiting=waiting, n_missing=missing, n_breaks=breaks)

    def _due(self, last: int) -> int:
        """Milliseconds of the watermark with which a conversation closes: that in its last batch."""
        return (last + self.patience) * 1000

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        first, next, _, breaks, kept, largest, last, _ = self.head.get()
        if timerValues.getCurrentWatermarkInMs() < self._due(last):
            self.handle.registerTimer(self._due(last))
            return
        fragments = sorted((start[0], end[0], end[1]) for start, end in self.starts.iterator())
        turns = ",".join(str(t) for start, end, _ in fragments for t in range(start, end + 1))
        breaks += sum(own for _, _, own in fragments)
        self.starts.clear()
        self.ends.clear()
        self.waiting.clear()
        self.head.update((first, next, None, 0, kept, largest, last, True))
        yield self._event("close", key, -1, min(last + self.patience, self.end), None, None, turns, largest - first + 1 - kept, breaks)

    def close(self) -> None:
        pass


@contextmanager
def state_settings(spark: SparkSession) -> Iterator[None]:
    """While it lasts, streaming queries keep state in the store that has maps and timers, and only ticks move
    the clock: no micro-batch runs without a file. Executors look every second for stores of queries that have
    ended, and close and delete them: each start of the query opens new ones."""
    wanted = {"spark.sql.streaming.stateStore.providerClass": PROVIDER, "spark.sql.streaming.noDataMicroBatches.enabled": "false", "spark.sql.streaming.stateStore.maintenanceInterval": "1s"}
    before = {k: spark.conf.get(k, None) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def arrivals(rows: DataFrame) -> DataFrame:
    """Rows (batch, conv_id, turn, role, text) as they arrive: of equal turns of a batch the smallest payload,
    with the conversation's smallest turn. Sums of a conversation are made before its rows are shuffled."""
    payload = F.concat("role", F.lit("|"), "text")
    plain = rows.filter("turn is not null").select(F.col("batch").cast("int"), F.col("conv_id").cast("long"), F.col("turn").cast("long"), *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text")])
    firsts = plain.groupBy("conv_id").agg(F.min("turn").alias("first")).select(F.col("conv_id").alias("_conv"), "first").hint("merge")
    once = plain.groupBy("batch", "conv_id", "turn").agg(F.min(F.struct(payload.alias("payload"), "role", "text")).alias("r"))
    joined = once.join(firsts, F.col("conv_id").eqNullSafe(F.col("_conv")))
    return joined.select("batch", F.lit(False).alias("tick"), _time(F.col("batch")).alias("at"), "conv_id", "turn", "first", "r.role", "r.text")


def _time(batch: Column) -> Column:
    return F.timestamp_seconds(batch + 1)  # the first watermark is 0, and rows at or before it count as late


def ticks(spark: SparkSession, batches: dict[int, int]) -> DataFrame:
    """A tick for each batch at an event time, in batches."""
    rows = spark.createDataFrame(list(batches.items()), "batch int, time long")
    null = lambda kind: F.lit(None).cast(kind)
    return rows.select("batch", F.lit(True).alias("tick"), _time(F.col("time")).alias("at"), null("long").alias("conv_id"), null("long").alias("turn"), null("long").alias("first"), null("string").alias("role"), null("string").alias("text"))


def reassemble(stream: DataFrame, end: int, patience: int = 2) -> DataFrame:
    """Events (EVENT) of a stream of arrivals and ticks."""
    ship(stream.sparkSession)
    keyed = stream.withWatermark("at", "0 seconds").groupBy("conv_id", "tick")
    return keyed.transformWithState(statefulProcessor=Reassembly(end, patience), outputStructType=StructType.fromDDL(EVENT), outputMode="Append", timeMode="EventTime")


def replay(rows: DataFrame, batches: int, patience: int = 2, each: Callable[[int], None] | None = None) -> DataFrame:
    """Feed rows (batch from 0 to batches - 1, conv_id, turn, role, text) to the query in the order of their
    batches, started anew for each on one checkpoint, and return all events. The last batch's tick stands at the
    end of time, and a start with a tick alone follows: in it all open conversations close, as batch `batches`.
    `each` is called after every batch."""
    spark = rows.sparkSession
    root = scratch(spark, "turns")
    source, events, log = f"{root}/in", f"{root}/events", f"{root}/log"
    clock = ticks(spark, {b: b for b in range(batches - 1)} | {batches - 1: LAST, batches: LAST})
    arrivals(rows).unionByName(clock).repartition("batch", F.pmod(F.xxhash64("conv_id", "turn"), F.lit(_files(spark)))).write.partitionBy("batch").parquet(f"{root}/ready")
    fs, target = _filesystem(spark, source)
    fs.mkdirs(target)
    with state_settings(spark):
        for b in range(batches + 1):
            _renamed(fs, _filesystem(spark, f"{root}/ready/batch={b}")[1], _filesystem(spark, f"{source}/batch={b}")[1])
            stream = spark.readStream.schema(ARRIVAL).parquet(source)
            query = reassemble(stream, batches, patience).writeStream.format("parquet").option("path", events).option("checkpointLocation", log).trigger(availableNow=True).start()
            query.awaitTermination()
            if each:
                each(b)
    return spark.read.schema(EVENT).parquet(events)


def _files(spark: SparkSession) -> int:
    """Files of a batch: as many as a batch has tasks."""
    return max(1, spark.sparkContext.defaultParallelism)
