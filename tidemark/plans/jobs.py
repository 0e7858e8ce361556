"""Questions about the job registry: what is due, what failed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.times import freq_minutes, minutes_between, zero_date_null
from tidemark.plans.control import RUNNING

# The texts given as reason and health.
FIRST_RUN = "starting the first Run Ever . . ."
NEXT_OK = "starting the Next Run | previous OK . . ."
NEXT_NOT_OK = "starting the Next Run | previous NOT OK . . ."
EARLY_NOT_OK = "starting the Next Run before next scheduled time | previous NOT OK . . ."
HEALTH_BAD = "something's wrong . . ."
HEALTH_GOOD = "things look good !"
HEALTH_EMPTY = "no records found ! "
STREAMS_GOOD = "various streams in parallel !"
STREAMS_EMPTY = "no kafka records found ! "


def jobs_due(registry: DataFrame, now: Column) -> DataFrame:
    """Registry rows to run now, with the reason.  A filter: no shuffle.

    Uses the columns ``lastStarted``, ``lastEnded`` (text), ``runFrequency``,
    ``totalRuns`` and ``currentState``.  A run that "ended" a minute or more
    before it started is still running or has failed.
    """
    timed = registry.withColumns(
        {"__started": zero_date_null("lastStarted"), "__ended": zero_date_null("lastEnded")}
    ).withColumns(
        {
            "__overdue": minutes_between("__started", now) > freq_minutes("runFrequency"),
            "__open": minutes_between("__started", "__ended") < 0,
        }
    )
    first, unfinished, overdue = F.col("totalRuns") == 0, F.col("__open"), F.col("__overdue")
    running = F.col("currentState") == RUNNING
    reason = (
        F.when(first, F.lit(FIRST_RUN))
        .when(unfinished & overdue, F.lit(NEXT_NOT_OK))
        .when(unfinished, F.lit(EARLY_NOT_OK))
        .otherwise(F.lit(NEXT_OK))
    )
    due = first | F.when(unfinished, ~running).otherwise(overdue)
    return timed.filter(due).withColumn("reason", reason).drop("__started", "__ended", "__overdue", "__open")


def health_summary(registry: DataFrame) -> DataFrame:
    """One row: number of jobs, number with failures, and the message shown."""
    faults = F.count_if(F.col("failureRuns") > 0)
    jobs = F.count(F.lit(1))
    message = F.when(jobs == 0, HEALTH_EMPTY).when(faults > 0, HEALTH_BAD).otherwise(HEALTH_GOOD)
    return registry.agg(jobs.alias("jobs"), faults.alias("faulty"), message.alias("message"))


def stream_health(registry: DataFrame) -> DataFrame:
    """One row: number of streams and the message shown."""
    streams = F.count(F.lit(1))
    message = F.when(streams == 0, STREAMS_EMPTY).otherwise(STREAMS_GOOD)
    return registry.agg(streams.alias("streams"), message.alias("message"))
