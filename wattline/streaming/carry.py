"""Repeating the last record of a device for every period in which it is silent.

Input has one record per device and closed period (see ``windows``), so the state function sees a
bounded number of rows however much a device sends. A period of silence is emitted when the
watermark passes its end, because until then a record for it may still arrive.
"""

from __future__ import annotations

import sys

from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from wattline.schemas import FLAGS, TRIPLE

# The state function travels to the workers by value, so they need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
# Periods travel as epoch microseconds, which are the same number in every worker's time zone.
# One row per record or per run of repeats; runs become rows on the JVM side.
_RUNS = (
    "space_id bigint, zone_device_id bigint, zone_device_control_id bigint, at bigint, "
    "run_end bigint, value double, is_online boolean, is_scenario boolean, carried boolean"
)
_STATE = "at bigint, reached bigint, value double, is_online boolean, is_scenario boolean"
_RUN = Row(*TRIPLE, "at", "run_end", "value", *FLAGS, "carried")


def use_rocksdb(spark: SparkSession) -> None:
    """Stateful functions need the RocksDB state store."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)


class CarryForward(StatefulProcessor):
    """State per device: the last record, and the period up to which rows were emitted."""

    def __init__(self, step_seconds: int, max_steps: int | None):
        self.step = step_seconds * 1_000_000
        self.max_steps = max_steps

    def init(self, handle):
        self.handle = handle
        self.last = handle.getValueState("last", _STATE)

    def handleInitialState(self, key, initialState, timerValues):
        """Take over a device from a table that an earlier stream wrote."""
        state = tuple(initialState[c] for c in ("at", "reached", "value", "is_online", "is_scenario"))
        self.last.update(state)
        self.handle.registerTimer(self._wake(state[1]))

    def handleInputRows(self, key, rows, timerValues):
        state = self.last.get()
        if state is not None:
            self.handle.deleteTimer(self._wake(state[1]))
        for row in sorted(rows, key=lambda r: r.at):
            if state is not None:
                # Whole periods strictly between the last emitted one and this record.
                yield from self._repeats(key, state, (row.at - state[1] - 1) // self.step)
            values = (row.value, row.is_online, row.is_scenario)
            yield _RUN(*key, row.at, row.at, *values, False)
            if state is None or row.at >= state[0]:
                reached = row.at if state is None else max(row.at, state[1])
                state = (row.at, reached, *values)
        self.last.update(state)
        self.handle.registerTimer(self._wake(state[1]))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        state = self.last.get()
        if state is None:
            return
        # Periods after the last emitted one whose end the watermark has passed.
        open_time = timerValues.getCurrentWatermarkInMs() * 1000 - state[1]
        closed = max(open_time // self.step - 1, 0)
        yield from self._repeats(key, state, closed)
        if closed > self._left(state, closed):
            self.last.clear()
            return
        reached = state[1] + closed * self.step
        self.last.update((state[0], reached, *state[2:]))
        self.handle.registerTimer(self._wake(reached))

    def close(self):
        pass

    def _wake(self, reached: int) -> int:
        """End of the first period after ``reached``, in milliseconds."""
        return (reached + 2 * self.step) // 1000

    def _left(self, state, wanted: int) -> int:
        """How many of the wanted repeats the limit still allows."""
        if self.max_steps is None:
            return wanted
        return min(wanted, self.max_steps - (state[1] - state[0]) // self.step)

    def _repeats(self, key, state, wanted: int):
        count = self._left(state, wanted)
        if count > 0:
            start, end = state[1] + self.step, state[1] + count * self.step
            yield _RUN(*key, start, end, *state[2:], True)


def carry_runs(
    periods: DataFrame,
    time: str,
    step_seconds: int,
    max_steps: int | None = None,
    initial: DataFrame | None = None,
) -> DataFrame:
    """Stream of records and of runs of repeats: ``time`` is the first period, ``until`` the last.

    ``max_steps`` bounds the repeats, and with them the state of devices that never come back.
    ``initial`` (of :func:`last_states`) is what the devices start from when the stream is new.
    """
    runs = (
        periods.withColumn("at", F.unix_micros(time))
        .groupBy(*TRIPLE)
        .transformWithState(
            statefulProcessor=CarryForward(step_seconds, max_steps),
            outputStructType=_RUNS,
            outputMode="Append",
            timeMode="EventTime",
            initialState=None if initial is None else initial.groupBy(*TRIPLE),
        )
    )
    first, last = F.timestamp_micros("at"), F.timestamp_micros("run_end")
    return runs.select(*TRIPLE, first.alias(time), last.alias("until"), "value", *FLAGS, "carried")


def every_period(runs: DataFrame, time: str, step_seconds: int) -> DataFrame:
    """Runs as one row per period. Works on a stream and on stored runs."""
    step = F.make_dt_interval(secs=F.lit(step_seconds))
    periods = runs.withColumn(time, F.explode(F.sequence(time, "until", step)))
    return periods.select(*TRIPLE, time, "value", *FLAGS, "carried")


def carry_forward(
    periods: DataFrame,
    time: str,
    step_seconds: int,
    max_steps: int | None = None,
    initial: DataFrame | None = None,
) -> DataFrame:
    """Stream of one row per device and period: its own record, or a repeat of the last one."""
    return every_period(carry_runs(periods, time, step_seconds, max_steps, initial), time, step_seconds)


def last_states(table: DataFrame, time: str) -> DataFrame:
    """What a new stream needs of the table an earlier one wrote (of periods or of runs): per device the
    last record of its own and the period up to which rows were written. Two aggregates in one pass,
    with map-side combine."""
    at = F.unix_micros(F.col(time).cast("timestamp"))
    end = F.unix_micros(F.col("until").cast("timestamp")) if "until" in table.columns else at
    record = F.when(~F.col("carried"), F.struct(at.alias("at"), "value", *FLAGS))
    last = table.groupBy(*TRIPLE).agg(F.max(record).alias("record"), F.max(end).alias("reached"))
    return last.filter("record is not null").select(
        *TRIPLE, "record.at", "reached", "record.value", *(f"record.{c}" for c in FLAGS)
    )


def hours_of_runs(runs: DataFrame, time: str = "ts") -> DataFrame:
    """Per device and hour sums over the minutes that runs stand for, without making the minutes: a run
    is cut at the hours it crosses and each part counts its minutes."""
    hour = F.explode(F.sequence(F.date_trunc("hour", time), F.date_trunc("hour", "until"), F.expr("interval 1 hour")))
    parts = runs.withColumn("hour", hour)
    first = F.greatest(F.unix_seconds(time), F.unix_seconds("hour"))
    last = F.least(F.unix_seconds("until"), F.unix_seconds("hour") + 3540)
    n = F.expr("0L") + ((last - first) / 60).cast("bigint") + 1
    where = lambda c: F.sum(F.when(F.col(c), n).otherwise(0))
    return parts.groupBy(*TRIPLE, "hour").agg(
        F.sum(n).alias("minutes"),
        where("carried").alias("carried"),
        F.min("value").alias("least"),
        F.max("value").alias("most"),
        where("is_online").alias("online"),
        where("is_scenario").alias("scenario"),
    )
