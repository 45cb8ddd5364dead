"""Throughput and lag, as queries over metric tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _grown(before: str, now: str) -> str:
    """Increase between two counter values; a falling counter was reset to zero."""
    return f"case when {before} is null then 0 when {now} < {before} then {now} else {now} - {before} end"


def topic_rates(samples: DataFrame, window: str = "1 minute") -> DataFrame:
    """Messages per second and topic from counter samples (ts, instance, topic, count).

    Per counter and window: the increase between neighbouring samples of the window, divided
    by the time between its first and last sample. Windows with one sample have no rate. Windows
    are tumbling, and the increase is not extrapolated to their borders: what a dashboard that
    does so shows is larger by the share of the window outside its first and last sample.

    The increase is summed up per second first and then across the seconds of a window, so no
    window function sees more than one second of a counter, or the seconds of one window.
    """
    counter = ["instance", "topic", "_second"]
    in_second = Window.partitionBy(*counter).orderBy("ts", "count")
    across = Window.partitionBy("_w", "instance", "topic").orderBy("_second")
    seconds = (
        samples.withColumn("_second", F.date_trunc("second", "ts"))
        .withColumn("_before", F.lag("count").over(in_second))
        .withColumn("_increase", F.expr(_grown("_before", "count")))
        .groupBy(*counter)
        .agg(
            F.sum("_increase").alias("_increase"),
            F.expr("min_by(count, struct(ts, count))").alias("_opening"),
            F.expr("max_by(count, struct(ts, count))").alias("_closing"),
            F.min("ts").alias("_from"),
            F.max("ts").alias("_to"),
        )
    )
    per_counter = (
        seconds.withColumn("_w", F.window("_second", window)["start"])
        .withColumn("_before", F.lag("_closing").over(across))
        .groupBy("_w", "instance", "topic")
        .agg(
            F.sum(F.col("_increase") + F.expr(_grown("_before", "_opening"))).alias("increase"),
            ((F.unix_micros(F.max("_to")) - F.unix_micros(F.min("_from"))) / 1e6).alias("_seconds"),
        )
        .where(F.col("_seconds") > 0)
    )
    return (
        per_counter.withColumn("_rate", F.col("increase") / F.col("_seconds"))
        .groupBy("_w", "topic")
        .agg(F.sum("increase").alias("increase"), F.sum("_rate").alias("rate"))
        .withColumnRenamed("_w", "window_start")
    )


# Panes of a block in which a pane looks for the one before it.
_BLOCK_PANES = 4096


def rate_steps(samples: DataFrame, step_seconds: int, panes: int) -> DataFrame:
    """step_time, topic and rate: ``sum by (topic) (rate(count[range]))`` of a dashboard, evaluated
    at every multiple of ``step_seconds``, over a trailing range of ``panes`` steps.

    Fixed rule of such a rate, for each counter (instance and topic): of the samples later than the
    start of the range, up to its end, the increase is the last less the first, plus the value
    before every reset. It needs two samples. The increase is extrapolated to the borders of the
    range: at each side by the distance of the border, but only by half the mean distance of
    samples if the border is 1.1 times that mean or more away, and at the start by no more than
    it takes the counter to have come from zero. It is divided by the whole range.

    A step's samples are first summed up as one pane, spread over all tasks whatever the counter's
    share of the rows; the increase between a pane and the one before it is found in blocks of
    panes, and each pane then counts in the ranges of the steps that reach back to it.
    """
    micros, step = F.unix_micros("ts"), step_seconds * 1_000_000
    pane = F.call_function("div", micros + step - 1, F.lit(step))  # ends at the step, included
    counter = ["instance", "topic"]
    inside = Window.partitionBy(*counter, "_pane").orderBy("ts", "count")
    made = (
        samples.where((F.col("topic") != "") & F.col("count").isNotNull())
        .withColumn("_t", micros)
        .withColumn("_pane", pane)
        .withColumn("_before", F.lag("count").over(inside))
        .groupBy(*counter, "_pane")
        .agg(
            F.count("*").alias("_n"),
            F.sum(F.expr(_grown("_before", "count"))).alias("_increase"),
            F.expr("min_by(count, struct(_t, count))").alias("_opening"),
            F.expr("max_by(count, struct(_t, count))").alias("_closing"),
            F.min("_t").alias("_from"),
            F.max("_t").alias("_to"),
        )
    )
    # A pane that the first panes of the next block may look back to stands there, too.
    block = F.call_function("div", F.col("_pane"), F.lit(_BLOCK_PANES))
    later = F.call_function("div", F.col("_pane") + panes - 1, F.lit(_BLOCK_PANES))
    held = made.withColumn("_block", F.explode(F.sequence(block, later)))
    before = Window.partitionBy(*counter, "_block").orderBy("_pane")
    joined = held.withColumn("_last", F.lag("_closing").over(before)).where(block == F.col("_block"))
    joined = joined.withColumn("_joint", F.expr(_grown("_last", "_opening")))
    ends = F.sequence(F.col("_pane"), F.col("_pane") + panes - 1)
    ranges = (
        joined.withColumn("_step", F.explode(ends))
        .groupBy(*counter, "_step")
        .agg(
            F.sum("_n").alias("_n"),
            # The first pane's own joint leads out of the range.
            (F.sum("_increase") + F.sum("_joint") - F.min_by("_joint", "_pane")).alias("_grown"),
            F.min_by("_opening", "_pane").alias("_first"),
            F.min("_from").alias("_from"),
            F.max("_to").alias("_to"),
        )
        .where("_n > 1 and _to > _from")
    )
    end = F.col("_step") * step
    seconds = ranges.select(
        "topic",
        "_step",
        F.col("_grown").cast("double").alias("_grown"),
        F.col("_first").cast("double").alias("_first"),
        ((F.col("_from") - (end - step * panes)) / 1e6).alias("_head"),
        ((end - F.col("_to")) / 1e6).alias("_tail"),
        ((F.col("_to") - F.col("_from")) / 1e6).alias("_span"),
        ((F.col("_to") - F.col("_from")) / 1e6 / (F.col("_n") - 1)).alias("_mean"),
    )
    near = F.when(F.col("_head") >= F.col("_mean") * 1.1, F.col("_mean") / 2).otherwise(F.col("_head"))
    from_zero = F.when(
        (F.col("_grown") > 0) & (F.col("_first") >= 0),
        F.col("_span") * (F.col("_first") / F.col("_grown")),
    )
    head = F.least(near, from_zero)  # a null is left out
    tail = F.when(F.col("_tail") >= F.col("_mean") * 1.1, F.col("_mean") / 2).otherwise(F.col("_tail"))
    whole = (F.col("_span") + head + tail) / F.col("_span")
    rate = F.col("_grown") * whole / (step_seconds * panes)
    return (
        seconds.withColumn("rate", rate)
        .groupBy("_step", "topic")
        .agg(F.sum("rate").alias("rate"))
        .select(F.timestamp_micros(end).alias("step_time"), "topic", "rate")
    )


def topic_throughput(records: DataFrame, window: str = "1 minute") -> DataFrame:
    """Messages per second and topic, counted on a topic table itself."""
    seconds = F.unix_seconds(F.col("w.end")) - F.unix_seconds(F.col("w.start"))
    return (
        records.groupBy(F.window("timestamp", window).alias("w"), "topic")
        .agg(F.count("*").alias("n_messages"))
        .select(
            F.col("w.start").alias("window_start"),
            "topic",
            "n_messages",
            (F.col("n_messages") / seconds).alias("rate"),
        )
    )


def consumer_lag(offsets: DataFrame) -> DataFrame:
    """Lag per snapshot and group from (ts, group, topic, partition, end_offset, committed).

    ``offsets`` has one row per snapshot, group, topic and partition; ``latest_offsets`` makes it so.
    """
    return offsets.groupBy("ts", "group").agg(
        F.sum(F.col("end_offset") - F.coalesce("committed", F.lit(0))).alias("lag")
    )


def latest_offsets(offsets: DataFrame, every: str = "hour") -> DataFrame:
    """The last row of each group, topic and partition in each interval, with the interval's start
    as its time; of rows of one time the one with the larger offsets counts."""
    place = F.struct("ts", "end_offset", "committed")
    last = offsets.groupBy(
        F.date_trunc(every, "ts").alias("_start"), "group", "topic", "partition"
    ).agg(F.max(place).alias("_last"))
    return last.select(
        F.col("_start").alias("ts"), "group", "topic", "partition", "_last.end_offset", "_last.committed"
    )


def topic_list(samples: DataFrame) -> DataFrame:
    return samples.where(F.col("topic") != "").select("topic").distinct()
