import json

import pytest

from chatloom.operators import validate
from chatloom.plans import job
from chatloom.plans.options import JobOptions
from chatloom.sources import documents


def docs_of(spark, *bodies):
    rows = [(i, b if isinstance(b, str) else json.dumps(b)) for i, b in enumerate(bodies)]
    return spark.createDataFrame(rows, "doc_idx bigint, body string").coalesce(1)


EXPORT = {
    "schema_version": "1",
    "comment": "ignored",
    "users": [
        {"username": "john-doe", "email": "john@x.example", "nickname": "John", "teams": ["it"]},
        "not an object",
        {"username": "ann", "email": "ann@x.example", "nickname": "Ann"},
    ],
    "teams": [
        {
            "name": "it",
            "display_name": "IT",
            "owners": ["ann"],
            "channels": [
                {"name": "general", "display_name": "General", "posts": [
                    {"username": "ann", "message": "hi", "timestamp_ms": 5},
                    {"username": "john-doe", "message": "yo", "timestamp_ms": " 1_000 ", "id": "p", "parent_id": None,
                     "attachments": [{"name": "n", "path": "a/b", "url": None}]},
                ]},
                {"name": "ops", "display_name": "Ops", "is_private": "Yes", "members": ["john-doe"]},
            ],
        }
    ],
    "direct_channels": [
        {"members": ["ann", "john-doe"], "posts": [{"username": "ann", "message": "dm", "timestamp_ms": 7.0}]}
    ],
}


def test_flatten(spark):
    ws = documents.load(docs_of(spark, EXPORT, {"users": [{"username": "z", "email": "z@z.zz", "nickname": "Z"}]}))
    assert validate.summary(ws).first().asDict() == {
        "teams": 1, "channels": 2, "users": 3, "posts": 2, "direct_channels": 1, "direct_posts": 1,
    }
    posts = {r.p_idx: r for r in ws.posts.collect()}
    assert (posts[0].timestamp_ms, posts[0].id, posts[0].attachments) == (5, None, [])
    assert (posts[1].timestamp_ms, posts[1].id, posts[1].parent_id) == (1000, "p", None)
    assert posts[1].attachments[0].path == "a/b"
    assert {r.name: r.is_private for r in ws.channels.collect()} == {"general": False, "ops": True}
    assert [(r.username, r.is_owner) for r in ws.team_people.collect()] == [("ann", True)]
    assert ws.teams.first().description == ""
    users = [r.username for r in ws.users.orderBy("u_idx").collect()]
    assert users == ["john-doe", "ann", "z"]
    assert ws.direct_posts.first().timestamp_ms == 7


def test_large_document(spark):
    """A document and a channel beyond the bound of one variant (16 MiB) load in full."""
    posts = [post(message=f"{i} " + "x" * 2000, timestamp_ms=i) for i in range(10_500)]
    ws = documents.load(docs_of(spark, {"users": [user()], "teams": [team(posts)]}))
    got = ws.posts.selectExpr("count(*)", "sum(timestamp_ms)", "sum(length(message))", "max(p_idx)").first()
    assert tuple(got) == (
        len(posts), sum(p["timestamp_ms"] for p in posts), sum(len(p["message"]) for p in posts), len(posts) - 1,
    )
    assert (ws.users.count(), ws.teams.count(), ws.channels.count()) == (1, 1, 1)
    late = [*posts, post(timestamp_ms="x")]
    assert problems(spark, {"teams": [team(late)]}) == [
        ("teams.item", f"0.channels.0.posts.{len(posts)}", "timestamp_ms", "must be a whole number"),
    ]


@pytest.mark.parametrize(
    "body,broken",
    [
        ('{"users": []} x', True), ('{"users": [{"a": 1, "a": 2}]}', True), ("", True), ("[1]", False), ("null", False),
        ('{"direct_channels": [{"posts": [{"m": 1, "m": 2}]}]}', True), ('{"users": 3}', False),
    ],
)
def test_unreadable(spark, body, broken):
    assert (documents.unreadable(docs_of(spark, body)).count() == 1) is broken


@pytest.mark.parametrize(
    "doc,fine",
    [
        ({"schema_version": 1}, True),
        ({"version": "1"}, True),
        ({"version": None}, True),
        ({"version": {"major": 2}}, True),
        ({}, True),
        ({"schema_version": 2}, False),
        ({"version": 1.0}, False),
        ({"version": True}, False),
        ({"schema_version": "1", "version": "x"}, False),
    ],
)
def test_version_gate(spark, doc, fine):
    assert (documents.bad_versions(docs_of(spark, doc)).count() == 0) is fine


def test_load_errors(spark):
    with pytest.raises(documents.SourceError, match="not valid JSON"):
        documents.load(docs_of(spark, '{"users": ['))
    with pytest.raises(documents.ContractError, match="Unsupported schema version: 2"):
        documents.load(docs_of(spark, {"schema_version": 2}))
    with pytest.raises(documents.ContractError, match="invalid object in 'users.item'"):
        documents.load(docs_of(spark, {"users": [{"username": "a"}]}))
    with pytest.raises(documents.SourceError, match="does not exist"):
        documents.read_documents(spark, "file:/tmp/no-such-folder-here/x.json")


def problems(spark, doc):
    found = documents.contract_violations(docs_of(spark, doc)).collect()
    return sorted((r.section, r.path, r.field, r.problem) for r in found)


def user(**changes):
    return {"username": "a", "email": "a@b.cc", "nickname": "n"} | changes


def post(**changes):
    return {"username": "a", "message": "m", "timestamp_ms": 1} | changes


def team(posts=(), **channel):
    chan = {"name": "c", "display_name": "C", "posts": list(posts)} | channel
    return {"name": "t", "display_name": "T", "channels": [chan]}


def test_contract(spark):
    assert problems(spark, EXPORT) == []
    assert problems(spark, {"users": [user(), user(extra=1, nickname=None, teams=["x", 3])]}) == [
        ("users.item", "1", "extra", "is not a known field"),
        ("users.item", "1", "nickname", "must be a text"),
        ("users.item", "1", "teams", "must hold only texts"),
    ]
    assert problems(spark, {"direct_channels": [{"posts": [post(timestamp_ms="x")]}]}) == [
        ("direct_channels.item", "0", "members", "is required"),
        ("direct_channels.item", "0.posts.0", "timestamp_ms", "must be a whole number"),
    ]
    bad_file = post(attachments=[{"name": "n", "path": 1}, {"name": "n", "path": "p", "url": None, "size": 3}])
    assert problems(spark, {"teams": [team([bad_file], is_private=2, members=None)]}) == [
        ("teams.item", "0.channels.0", "is_private", "must be a boolean"),
        ("teams.item", "0.channels.0", "members", "must be a list"),
        ("teams.item", "0.channels.0.posts.0.attachments.0", "path", "must be a text"),
        ("teams.item", "0.channels.0.posts.0.attachments.1", "size", "is not a known field"),
    ]


@pytest.mark.parametrize(
    "value,expected",
    [
        (12, 12), ("12", 12), (" 12 ", 12), ("1.0", 1), ("1_000", 1000), (1.0, 1), (True, 1), (1e3, 1000),
        (1.5, "must be a whole number"), ("1.5", "must be a whole number"), ("x", "must be a whole number"),
        (None, "must be a whole number"), (-1, "must not be negative"), ("-1", "must not be negative"),
        (10**19, "must fit 64 bits"), ([1], "must be a whole number"),
    ],
)
def test_whole_numbers(spark, value, expected):
    doc = {"teams": [team([post(timestamp_ms=value)])]}
    found = problems(spark, doc)
    if isinstance(expected, int):
        assert found == []
        assert documents.workspace(docs_of(spark, doc)).posts.first().timestamp_ms == expected
    else:
        assert [p[-1] for p in found] == [expected]


def test_file_to_payload(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text(json.dumps(EXPORT, indent=2), encoding="utf-8")
    docs = documents.read_documents(spark, f"file:{tmp_path}/in")
    summary = job.run(documents.load(docs), JobOptions(), f"file:{tmp_path}/out", input_bytes=640).first()
    assert summary.asDict() == {"bytes": 640, "teams": 1, "channels": 2, "users": 2, "posts": 2, "records": 10}


def test_contract_parses_each_text_once(spark):
    # Levels are staged: what is left to run reads parsed objects, whatever the number of contracts.
    found = documents.contract_violations(docs_of(spark, {"users": [user(nickname=3)], "teams": [team([post()])]}))
    assert "from_json" not in found._jdf.queryExecution().optimizedPlan().toString()
    assert [(r.path, r.field) for r in found.collect()] == [("0", "nickname")]


def test_counts_with_and_without_the_short_way(spark):
    right = [0, 7, "12", " 0012 ", "1_000", "+5", "-0", "3.0", "\t4", True, 2.0, 10**18, "9" * 18, "0" * 30]
    negative = [-1, "-1", " -30 ", "-05", "-1_0", -2.0]
    wrong = ["", " ", "x", "1 2", "--1", 1.5, [], {}]
    above = ["9" * 19, "9" * 25]
    values = right + negative + wrong + above
    posts = [post(timestamp_ms=v) for v in values]
    expected = {}
    for at, value in enumerate(values[len(right):], len(right)):
        kind = "must not be negative" if value in negative else "must be a whole number"
        expected[f"0.posts.{at}"] = "must fit 64 bits" if at >= len(values) - len(above) else kind
    found = problems(spark, {"direct_channels": [{"members": ["a"], "posts": posts}]})
    assert {path: problem for _, path, field, problem in found if field == "timestamp_ms"} == expected
