import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from chatloom.operators import monitor
from chatloom.streaming import monitor as live

T0 = datetime(2024, 5, 1, 23, 50)


def at(minutes):
    return T0 + timedelta(minutes=minutes)


def samples(spark, rows):
    return spark.createDataFrame(
        [(at(m), i, s, float(v)) for i, (m, s, v) in enumerate(rows)],
        "ts timestamp, event_id bigint, series string, value double",
    )


def test_increase_counts_steps_inside_the_range(spark):
    df = samples(spark, [(0, "a", 5), (1, "a", 7), (12, "a", 8), (13, "a", 2), (40, "a", 9), (0.5, "b", 1), (1.5, "b", 4)])
    got = {(r.series, r.minute): r.increase for r in monitor.increase(df, ["series"], ["series"], 15).collect()}
    points = {"a": [(0, 5), (1, 7), (12, 8), (13, 2), (40, 9)], "b": [(0.5, 1), (1.5, 4)]}
    expected = {}
    for series, line in points.items():
        for minute in range(0, 60):
            inside = [p for p in line if minute - 15 < p[0] <= minute]
            steps = [b[1] - a[1] if b[1] >= a[1] else b[1] for a, b in zip(inside, inside[1:])]
            if steps:
                expected[series, at(minute)] = float(sum(steps))
    assert got == expected
    assert monitor.increase_alert(df, ["series"], ["series"]).count() == sum(v > 0 for v in expected.values())


def test_sustained_stretches(spark):
    df = samples(spark, [(0, "a", 0), (4, "a", 0), (6, "a", 0), (7, "a", 1), (8, "a", 0), (12, "a", 0), (15, "a", 1), (0, "b", 0)])
    got = monitor.sustained(df, ["series"], F.col("value") == 0, 5).collect()
    assert [(r.series, r.since, r.until, r.fires_at) for r in got] == [("a", at(0), at(6), at(5))]


def test_histogram_bounds(spark):
    df = spark.createDataFrame([("v", 0.005), ("v", 0.0051), ("v", 99.0)], "stage string, s double")
    got = {r.le: r.bucket for r in monitor.stage_histogram(df, "stage", "s").collect()}
    assert got["0.005"] == 1 and got["0.01"] == 2 and got["10.0"] == 2 and got["+Inf"] == 3
    assert len(got) == 15


def test_throughput_needs_time(spark):
    df = spark.createDataFrame(
        [(at(0), 1, 10, 2.0), (at(1), 2, 50, 0.0)], "ts timestamp, run_id int, records int, seconds double"
    )
    row = monitor.throughput(df).first()
    assert (row.last_run_records, row.records_per_second) == (50, 5.0)


def test_logs_match_whole_values(spark):
    line = '{"level":"INFO","service":"%s","details":{"a":"b"}}'
    rows = [(i, f"/{s}-1", line % s) for i, s in enumerate(["db", "db-2", "chat", "xchat"])]
    logs = monitor.parse_logs(spark.createDataFrame(rows, "line_no int, container_name string, line string"))
    got = monitor.select_logs(logs, service="chat|db").collect()
    assert sorted(r.container for r in got) == ["chat-1", "db-1"]
    assert got[0].details == {"a": "b"}


def stream_of(spark, folder, batches, schema):
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(folder / f"in/{i}"))
    return (
        spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true")
        .parquet(str(folder / "in"))
    )


def drain(df, name, mode, folder):
    run = (
        df.writeStream.format("memory").queryName(name).outputMode(mode)
        .option("checkpointLocation", str(folder / "state")).trigger(availableNow=True).start()
    )
    run.awaitTermination(240)
    return df.sparkSession.table(name).collect()


def test_stream_counters(spark, tmp_path):
    src = stream_of(spark, tmp_path, [[("post",), ("user",)], [("post",)]], "type string")
    got = drain(live.counters(src, "type"), "live_counts", "complete", tmp_path)
    assert {r.type: r.total for r in got} == {"post": 2, "user": 1}


def shuffled_batches(rows, order, minutes):
    """Rows (ts first) in small batches, each at most ``minutes`` behind the latest seen before."""
    rows = sorted(rows, key=lambda r: r[0])
    moved = sorted(rows, key=lambda r: r[0] + timedelta(minutes=order.uniform(0, minutes - 1)))
    return [moved[i : i + 9] for i in range(0, len(moved), 9)]


def test_stream_counter_steps_in_any_order(spark, tmp_path):
    order = random.Random(3)
    rows = [(at(order.choice(range(120))), i, order.choice("ab"), float(order.randint(0, 9))) for i in range(70)]
    last = (at(200), 99, "a", 1.0)  # lets the watermark pass all others
    schema = "ts timestamp, event_id bigint, series string, value double"
    src = stream_of(spark, tmp_path, [*shuffled_batches(rows, order, 30), [last]], schema)
    got = drain(live.counter_steps(src, "30 minutes", "event_id"), "live_steps", "append", tmp_path)
    batch = monitor.counter_steps(spark.createDataFrame(rows, schema), ["series"]).filter("step is not null").collect()
    assert sorted((r.series, r.ts, r.step) for r in got) == sorted((r.series, r.ts, r.step) for r in batch)


def test_stream_steps_of_late_rows(spark, tmp_path):
    batches = [[(at(0), 5.0), (at(10), 20.0)], [(at(5), 8.0)], [(at(12), 22.0)], [(at(40), 0.0)]]
    rows = [[("a", *row) for row in batch] for batch in batches]
    src = stream_of(spark, tmp_path, rows, "series string, ts timestamp, value double")
    got = drain(live.counter_steps(src, "10 minutes"), "late_steps", "append", tmp_path)
    assert [(r.ts, r.step) for r in sorted(got, key=lambda r: r.ts)] == [(at(5), 3.0), (at(10), 12.0), (at(12), 2.0)]


def held_model(rows, hold, end):
    out = []
    for series in {r[2] for r in rows}:
        since, fired = None, False
        line = sorted(r for r in rows if r[2] == series and r[0] <= end)
        for ts, _, _, ok in [*line, (end + timedelta(days=9), 0, series, False)]:
            if ok:
                since = ts if since is None else since
            else:
                if since is not None and since + hold < ts and since + hold <= end:
                    out.append((series, since, since + hold))
                since = None
    return sorted(out)


def test_stream_held_threshold_in_any_order(spark, tmp_path):
    order = random.Random(4)
    rows = [(at(order.choice(range(300))), i, order.choice("abc"), order.random() < 0.7) for i in range(80)]
    schema = "ts timestamp, event_id bigint, series string, ok boolean"
    src = stream_of(spark, tmp_path, [*shuffled_batches(rows, order, 30), [(at(330), 99, "z", False)]], schema)
    got = drain(live.held_threshold(src, 300, "30 minutes", "event_id"), "live_held", "append", tmp_path)
    want = held_model(rows, timedelta(minutes=5), at(300))
    assert sorted((r.series, r.since, r.fires_at) for r in got) == want and len(want) > 5
    batch = monitor.held(spark.createDataFrame(rows, schema), ["series"], F.col("ok"), 5, F.lit(at(300))).collect()
    assert sorted((r.series, r.since, r.fires_at) for r in batch) == want


def test_stream_alert_needs_no_further_sample(spark, tmp_path):
    batches = [[("a", at(0), True), ("b", at(0), False)], [("a", at(4), True), ("a", at(3.5), False)], [("b", at(9), False)], [("b", at(10), False)]]
    src = stream_of(spark, tmp_path, batches, "series string, ts timestamp, ok boolean")
    got = drain(live.held_threshold(src, 300, "1 minute"), "alone", "append", tmp_path)
    assert [(r.series, r.since, r.fires_at) for r in got] == [("a", at(4), at(9))]


def test_stream_windows_and_logs(spark, tmp_path):
    src = stream_of(spark, tmp_path, [[(at(0), 1.0)], [(at(1), 2.0)], [(at(90), 1.0)], [(at(91), 1.0)]], "ts timestamp, step double")
    got = drain(live.windowed_increase(src, [], "15 minutes", "15 minutes", "5 minutes"), "live_windows", "append", tmp_path)
    assert [r.increase for r in got if r.window.start <= at(0)] == [3.0]
    other = tmp_path / "logs"
    lines = stream_of(spark, other, [[(1, "/a-1", '{"service":"a"}'), (2, "/b-1", '{"service":"b"}')]], "line_no int, container_name string, line string")
    assert [r.line_no for r in drain(live.logs(lines, service="a"), "live_logs", "append", other)] == [1]
