from helpers import make_workspace, post

from chatloom.operators import render
from chatloom.operators.sequence import global_index
from chatloom.plans.options import JobOptions
from chatloom.sources import payload


def test_shape_runs_once_per_row(spark):
    from pyspark.sql import functions as F

    made = spark.sparkContext.accumulator(0)

    def told(value):
        made.add(1)
        return f"v{value}"

    def shape(df):
        return df.withColumn("line", F.udf(told, "string")("id"))

    rows = global_index(spark.range(0, 500, 1, 4), ["id"], "n", shape=shape).collect()
    assert sorted((r.n, r.line) for r in rows) == [(i, f"v{i}") for i in range(500)]
    assert made.value == 500


def test_lines_are_made_behind_the_sort(spark, tmp_path, monkeypatch):
    ws = make_workspace(
        spark,
        users=[(0, "ann", "a@x.y", "A")],
        teams=[(0, "it-team", "IT", "")],
        channels=[(0, 0, "it-team", "general", "General", False)],
        posts=[post(i, "ann", f"m{i}", 100 - i, id=f"o{i}") for i in range(30)],
    )
    records = render.all_records(ws, JobOptions())
    expected = [r.line for r in render.json_lines(records).orderBy(*render.ORDER).collect()]
    plans = []

    def lines(df):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return render.json_lines(df)

    monkeypatch.setattr(payload, "json_lines", lines)
    payload.write_payload(records, str(tmp_path / "out"))
    assert plans[0].startswith("Sort [")
    files = sorted((tmp_path / "out").glob("part-*"))
    assert [line for f in files for line in f.read_text().splitlines()] == expected
