"""Run metrics, rates, alerts and log selection over sample and log tables.

Samples are (ts, metric, labels, value). A series is one metric with one label set.
Rates are plain sums of counter steps inside the window; nothing is extrapolated to
the window's edges.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chatloom.operators.sequence import previous, running_total

# Histogram bounds in seconds; +Inf closes the list.
DURATION_BOUNDS: tuple[float, ...] = (
    0.005, 0.01, 0.025, 0.05, 0.075, 0.1, 0.25, 0.5, 0.75, 1.0, 2.5, 5.0, 7.5, 10.0,
)
LOG_SCHEMA = (
    "timestamp string, level string, logger string, service string, correlation_id string, "
    "message string, event string, details map<string,string>"
)
# Long series are cut into spans of this many seconds; one span's samples go to one task.
SPAN_SECONDS = 600


def counters(df: DataFrame, *labels: str, out: str = "total") -> DataFrame:
    """Counter value per label set."""
    return df.groupBy(*labels).agg(F.count("*").alias(out))


def stage_histogram(
    df: DataFrame, stage: str, seconds: str, bounds: Sequence[float] = DURATION_BOUNDS
) -> DataFrame:
    """(stage, le, bucket, total, seconds): cumulative buckets with count and sum per stage.

    All bounds are counted in one pass and turned into rows afterwards.
    """
    labels = [f"{b:g}" if b != int(b) else f"{b:.1f}" for b in bounds]
    counted = df.groupBy(stage).agg(
        *[F.count_if(F.col(seconds) <= b).alias(f"_b{i}") for i, b in enumerate(bounds)],
        F.count(seconds).alias("total"),
        F.sum(F.col(seconds).cast("decimal(38,6)")).alias("seconds"),
    )
    buckets = [
        F.struct(F.lit(label).alias("le"), F.col(f"_b{i}").alias("bucket"))
        for i, label in enumerate(labels)
    ]
    buckets.append(F.struct(F.lit("+Inf").alias("le"), F.col("total").alias("bucket")))
    return counted.select(
        stage, F.explode(F.array(*buckets)).alias("b"), "total", F.col("seconds").cast("double").alias("seconds")
    ).select(stage, "b.le", "b.bucket", "total", "seconds")


def throughput(runs: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Latest run's records and records per second; no rate without positive seconds.

    ``runs`` has (ts, run_id, records, seconds) and the ``by`` columns.
    """
    latest = runs.groupBy(*by).agg(
        F.max_by(F.struct("records", "seconds"), F.struct("ts", "run_id")).alias("r"),
        F.max_by(
            F.when(F.col("seconds") > 0, F.col("records") / F.col("seconds")),
            F.when(F.col("seconds") > 0, F.struct("ts", "run_id")),
        ).alias("records_per_second"),
    )
    return latest.select(*by, F.col("r.records").alias("last_run_records"), "records_per_second")


def select_series(samples: DataFrame, metric: str, **labels: str) -> DataFrame:
    """Samples of one metric; ``*`` at its end matches a prefix, labels match exactly."""
    name = F.col("metric")
    picked = samples.filter(
        name.startswith(metric[:-1]) if metric.endswith("*") else name == metric
    )
    for key, value in labels.items():
        picked = picked.filter(F.col("labels").getItem(key) == value)
    return picked


def _span(ts: str = "ts") -> Column:
    return F.floor(F.unix_timestamp(ts) / SPAN_SECONDS)


def counter_steps(samples: DataFrame, series: Sequence[str], tie: str = "event_id") -> DataFrame:
    """Add prev_ts and step: growth since the series' sample before; a reset counts in full."""
    with_prev = previous(
        samples, series, ["ts", tie], _span(), {"ts": "prev_ts", "value": "prev_value"}
    )
    step = F.when(F.col("value") >= F.col("prev_value"), F.col("value") - F.col("prev_value")).otherwise(
        F.col("value")
    )
    return with_prev.withColumn("step", F.when(F.col("prev_value").isNotNull(), step)).drop("prev_value")


def increase(
    samples: DataFrame,
    series: Sequence[str],
    by: Sequence[str],
    range_minutes: int,
    tie: str = "event_id",
) -> DataFrame:
    """(by…, minute, increase): counter growth over the range ending at each ``minute``.

    A step counts where both its samples lie in (minute - range, minute]. It enters the
    sum at one minute and leaves it at another: two events per step, whatever the range. Events
    are summed per minute before the sweep, so a key has at most one row a minute there.
    Sums are kept to nine decimals, so that what has left does not leave a rest.
    """
    steps = counter_steps(samples, series, tie).filter(F.col("step").isNotNull())
    first = F.ceil(F.unix_timestamp("ts") / 60)
    # The first minute that no longer sees the earlier sample; a wider gap is never inside.
    after = F.ceil(F.unix_timestamp("prev_ts") / 60) + range_minutes
    step = F.col("step").cast("decimal(38,9)")
    events = steps.filter(first < after).select(
        *by,
        F.explode(
            F.array(
                F.struct(first.alias("at"), step.alias("step"), F.lit(1).alias("live")),
                F.struct(after.alias("at"), (-step).alias("step"), F.lit(-1).alias("live")),
            )
        ).alias("e"),
    )
    summed = events.groupBy(*by, "e.at").agg(F.sum("e.step").alias("step"), F.sum("e.live").alias("live"))
    sweep = Window.partitionBy(*by).orderBy("at")
    swept = summed.select(
        *by,
        "at",
        F.lead("at").over(sweep).alias("next"),
        F.sum("step").over(sweep).alias("increase"),
        F.sum("live").over(sweep).alias("live"),
    ).filter("live > 0")
    return swept.select(
        *by,
        F.explode(F.sequence("at", F.col("next") - 1)).alias("at"),
        F.col("increase").cast("double").alias("increase"),
    ).select(*by, F.timestamp_seconds(F.col("at") * 60).alias("minute"), "increase")


def increase_alert(samples: DataFrame, series: Sequence[str], by: Sequence[str], range_minutes: int = 15) -> DataFrame:
    """Minutes at which the counter grew within the range."""
    return increase(samples, series, by, range_minutes).filter("increase > 0")


def rate_by_label(
    samples: DataFrame, series: Sequence[str], label: str, range_minutes: int = 5
) -> DataFrame:
    """(label, minute, rate): per-second growth summed over the series of a non-empty label."""
    labelled = samples.filter(F.col(label) != "")
    return increase(labelled, series, [label], range_minutes).select(
        label, "minute", (F.col("increase") / (range_minutes * 60)).alias("rate")
    )


def gauge_sum_by_label(
    samples: DataFrame, series: Sequence[str], label: str, tie: str = "event_id"
) -> DataFrame:
    """Sum over series of each series' latest sample, per non-empty label."""
    latest = (
        samples.filter(F.col(label) != "")
        .groupBy(*series)
        .agg(F.max_by("value", F.struct("ts", tie)).alias("value"))
    )
    return latest.groupBy(label).agg(F.sum(F.col("value").cast("decimal(38,6)")).cast("double").alias("value"))


def sustained(
    samples: DataFrame,
    series: Sequence[str],
    predicate: Column,
    minutes: int,
    tie: str = "event_id",
) -> DataFrame:
    """(series…, since, until, fires_at): stretches where the predicate held long enough.

    A stretch is a run of samples that all satisfy the predicate. Samples that do not are
    counted along the series; satisfying samples with the same count form one stretch.
    """
    flagged = samples.withColumn("_ok", F.coalesce(predicate, F.lit(False)))
    second = flagged.withColumn("_at", F.unix_timestamp("ts"))
    numbered = running_total(
        second, series, "_at", F.when(F.col("_ok"), 0).otherwise(1), "_stretch", chunk=SPAN_SECONDS, tie=[tie]
    )
    stretches = (
        numbered.filter("_ok")
        .groupBy(*series, "_stretch")
        .agg(F.min("ts").alias("since"), F.max("ts").alias("until"))
    )
    hold = F.expr(f"INTERVAL {minutes} MINUTE")
    return stretches.filter(F.col("until") >= F.col("since") + hold).select(
        *series, "since", "until", (F.col("since") + hold).alias("fires_at")
    )


def held(
    samples: DataFrame,
    series: Sequence[str],
    predicate: Column,
    minutes: int,
    until: Column,
    tie: str = "event_id",
) -> DataFrame:
    """(series…, since, fires_at): stretches that no sample has ended in time, seen at ``until``.

    Unlike in ``sustained``, a stretch goes on until a sample that ends it, so it fires
    without a further sample. Samples after ``until`` are not looked at.
    """
    seen = samples.filter(F.col("ts") <= until).withColumn("_ok", F.coalesce(predicate, F.lit(False)))
    before = previous(seen, series, ["ts", tie], _span(), {"_ok": "_before"})
    # Samples that change the state, and for each the next such sample.
    turns = before.filter(F.col("_ok") != F.coalesce("_before", F.lit(False))).select(*series, "ts", tie, "_ok")
    # Going back in time, the sample before is the next one.
    back = turns.withColumns({"_back": -F.unix_micros("ts"), "_tie": -F.col(tie)})
    stretches = previous(back, series, ["_back", "_tie"], -_span(), {"ts": "_end"})
    fires = F.col("ts") + F.expr(f"INTERVAL {minutes} MINUTE")
    return stretches.filter(F.col("_ok") & (fires <= until) & (F.col("_end").isNull() | (F.col("_end") > fires))).select(
        *series, F.col("ts").alias("since"), fires.alias("fires_at")
    )


def parse_logs(lines: DataFrame) -> DataFrame:
    """JSON log lines to columns; the container name loses its leading slash."""
    return lines.select(
        "line_no",
        F.regexp_extract("container_name", "^/(.*)$", 1).alias("container"),
        F.from_json("line", LOG_SCHEMA).alias("log"),
    ).select("line_no", "container", "log.*")


def select_logs(logs: DataFrame, **labels: str) -> DataFrame:
    """Log rows whose labels match; patterns are anchored at both ends."""
    for name, pattern in labels.items():
        logs = logs.filter(F.col(name).rlike(f"^(?:{pattern})$"))
    return logs
