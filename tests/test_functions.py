import hashlib
import hmac
import json
import re

import pytest
from helpers import keyed, slug_model
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chatloom.functions import text as tx
from chatloom.functions.hashing import hmac_hex
from chatloom.functions.jsonline import json_text

GOLDEN_SLUGS = {
    "!!!": "fallback-e84c538e7f",
    "---": "fallback-cb3f91d54e",
    "": "default-slug",
    "John Doe": "john-doe",
    "  --A__b--  ": "a-b",
    "Zoë İstanbul": "zo-i-stanbul",
    "Kelvin K": "kelvin-k",
}


def one(spark, value, build):
    return spark.createDataFrame([(value,)], "v string").select(build(F.col("v")).alias("r")).first().r


@pytest.mark.parametrize("value,expected", GOLDEN_SLUGS.items())
def test_slug(spark, value, expected):
    assert one(spark, value, tx.slugify) == expected == slug_model(value)


def test_alias_golden(spark):
    assert one(spark, "john-doe", tx.stable_alias) == "user-312189df6c3b"
    assert one(spark, "admin-user", tx.stable_alias) == "user-f0433380e3ad"


@pytest.mark.parametrize("salt", ["s", "x" * 64, "y" * 65, "ключ" * 30])
def test_hmac_matches_library(spark, salt):
    got = one(spark, "grüße\n", lambda c: hmac_hex(c, salt, 64))
    assert got == hmac.new(salt.encode(), "grüße\n".encode(), hashlib.sha256).hexdigest()


def test_attachment_name(spark):
    cases = {
        "attachments/report.pdf": "report.pdf",
        "a b/c?d*.txt": "c_d_.txt",
        "folder/": "folder",
        "folder/.": "folder",
        "": "file",
        ".": "file",
        "/": "file",
        "a/..": "..",
        "x/日本.doc": "_.doc",
    }
    for path, name in cases.items():
        expected = hashlib.sha256(path.encode()).hexdigest()[:8] + "_" + name
        assert one(spark, path, tx.safe_attachment_name) == expected, path
    assert one(spark, "attachments/report.pdf", tx.safe_attachment_name).startswith("28f2b7eb_")


def test_redaction_markers(spark):
    text = (
        "Mail a.b@corp.example.com or call +1 555-123-4567, see https://x.example/a?b=1 "
        "by EMP-12345, card 4111 1111 1111 1111, host 10.0.0.12"
    )
    got = one(spark, text, tx.redact_or_scrub)
    assert got == (
        "Mail [REDACTED EMAIL] or call +[REDACTED PHONE], see [REDACTED URL] "
        "by [REDACTED EMPLOYEE ID], card [REDACTED CREDIT CARD], host [REDACTED IP]"
    )


def test_redaction_agrees_with_python(spark):
    texts = [
        "E12345 e12345 EMP-1 EMP-123456789 xEMP-1234",
        "at 1700000000000 ms",
        "(555) 123 4567 and 555.123.4567.",
        "http://a.example, https://b.example).",
        "1.2.3.4.5 and 999.999.999.999",
        "a@b.c. A@B.CO-uk..",
        "Kſ@ıİ.K é@é.fr x@é.fr",
        "é4111111111111111é 4111111111111111",
        "٤١١١١١١١١١١١١١١١ arabic digits",
        "12 34-56 7890123 nbsp",
    ]
    df = spark.createDataFrame([(t,) for t in texts], "v string")
    got = [r.r for r in df.select(tx.redact(F.col("v")).alias("r")).collect()]
    for text, result in zip(texts, got, strict=True):
        for rule in tx.REDACTIONS:
            flags = re.IGNORECASE if rule.name == "email" else 0
            pattern = r"[a-zA-Z0-9_.+-]+@[a-zA-Z0-9-]+\.[a-zA-Z0-9-.]+" if flags else rule.pattern
            text = re.sub(pattern, rule.marker, text, flags=flags)
        assert result == text


def test_block_words(spark):
    assert one(spark, "Top SECRET plan", tx.redact_or_scrub) == "[PII SCRUBBED]"
    assert one(spark, "", tx.redact_or_scrub) == ""


def test_epoch(spark):
    cases = {
        "2024-01-02T03:04:05Z": 1704164645000,
        "2024-01-02T03:04:05.678912Z": 1704164645678,
        "2024-01-02T03:04:05+02:00": 1704157445000,
        "soon": 0,
        None: 0,
    }
    for text, expected in cases.items():
        assert one(spark, text, tx.iso_to_epoch_ms) == expected


def test_json_line_is_sorted_ascii_json(spark):
    schema = T.StructType.fromDDL("z string, a array<struct<q:string,b:bigint>>, n string, ok boolean")
    value = {"z": 'é"\\\n\t😀', "a": [{"q": "x", "b": 2}, {"q": None, "b": 3}], "n": None, "ok": True}
    df = spark.createDataFrame([(value,)], T.StructType([T.StructField("r", schema)]))
    line = df.select(json_text(F.col("r"), schema).alias("line")).first().line
    expected = json.dumps(
        {"a": [{"b": 2, "q": "x"}, {"b": 3}], "ok": True, "z": value["z"]}, sort_keys=True
    )
    assert line.lower() == expected.lower()
    assert json.loads(line) == json.loads(expected)


def test_direct_post_id_golden(spark):
    assert "direct-post-" + keyed("john-doe,sarah-khan|0|1000|john-doe|Earlier message") == "direct-post-b0cf1727d581"


def test_iso_times_are_whole_dates(spark):
    from pyspark.sql import functions as F

    from chatloom.functions.text import iso_to_epoch_ms

    cases = {
        "20240102T030405Z": 1704164645000,
        "2024-01-02T03:04:05Z": 1704164645000,
        "2024-01-02T03:04:05.678+01:00": 1704161045678,
        "2024-01-02": 1704153600000,
        "12:30": 0, "T12:30": 0, "2024-01": 0, "2024": 0, " 2024-01-02": 0, "2024-01-02T03:04:05 Europe/Paris": 0, "": 0, None: 0,
    }
    df = spark.createDataFrame([(k,) for k in cases], "t string")
    got = {r.t: r.ms for r in df.select("t", iso_to_epoch_ms(F.col("t")).alias("ms")).collect()}
    assert got == cases


def test_import_mark_is_a_like_pattern(spark):
    from chatloom.operators.postimport import keep_first_import

    rows = [("a", 1, '{"importXid": "q"}'), ("b", 2, '{"importXid": "q"}'), ("c", 3, None), ("d", 4, "{}")]
    df = spark.createDataFrame(rows, "id string, createat long, props string")
    assert {r.id for r in keep_first_import(df).collect()} == {"a", "c", "d"}


def test_files_keep_apart_by_address(spark):
    from chatloom.operators.attachments import attach

    item = "array<struct<name:string,path:string,url:string>>"
    posts = spark.createDataFrame(
        [(1, [("f", "file", "http://a")]), (2, [("f", "file", "http://b")])], f"p long, attachments {item}"
    )
    done = spark.createDataFrame(
        [("file", "http://a", "A", "success"), ("file", "http://b", "B", "success")],
        "path string, source string, file_id string, status string",
    )
    got = {r.p: r.file_ids for r in attach(posts, ["p"], done, identity="url").collect()}
    assert got == {1: ["A"], 2: ["B"]}


def test_each_rule_is_applied_once(spark):
    """The address rule tests the text as it came, not what the rule before made of it."""
    plan = spark.range(1).select(tx.redact(F.col("id").cast("string")).alias("t"))._jdf.queryExecution()
    assert plan.analyzed().toString().count("[REDACTED CREDIT CARD]") == 2  # one a branch, of which one is taken
    rules = [tx.Redaction("at", "at", "@"), *tx.REDACTIONS]
    df = spark.createDataFrame([("x at y.z",), ("xaty.z",), ("a@b.c",)], "t string")
    got = [row.t for row in df.select(tx.redact(F.col("t"), rules=rules).alias("t")).collect()]
    assert got == ["x @ y.z", "[REDACTED EMAIL]", "[REDACTED EMAIL]"]
