import __spark_entry__ as entry_module
from checks.oracle import ORACLE
from checks.queries import QUERIES

SMALL = "/root/testdata/sf0.001"


def test_every_sql_belongs_to_a_query():
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())
    # Sizes of parts hang on the text of every line; tests/test_payload.py has a model of the packing.
    assert set(QUERIES) - set(ORACLE) == {"payload_parts"}


def test_entry_lines(spark):
    rows = entry_module.entry(spark)
    assert rows.columns == ["type", "line"]
    counts = {r.type: r["count"] for r in rows.groupBy("type").count().collect()}
    assert counts["version"] == 1 and counts["post"] == 1500


def test_parts_hold_every_record(spark):
    parts = entry_module.queries()["payload_parts"](spark, SMALL).collect()
    # One header line in every part but the first.
    assert sum(r.records for r in parts) == 1788 + len(parts) - 1
    assert all(r.bytes <= 1 << 20 for r in parts)
