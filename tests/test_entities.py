import json

from chatloom.operators import validate
from chatloom.plans.workspace import SCHEMAS
from chatloom.sources import documents, entities

TEAM = {
    "name": "it", "display_name": "IT", "description": "d", "members": ["ann", "gone"], "owners": ["bob"],
    "channels": [
        {"name": "gen", "display_name": "Gen", "is_private": False, "members": ["ann"], "owners": [], "posts": []},
        {"name": "ops", "display_name": "Ops", "is_private": True, "members": ["who"], "owners": ["bob"], "posts": []},
    ],
}
USERS = [{"username": n, "email": f"{n}@x.org", "nickname": n.title(), "teams": ["it", "no-team"]} for n in ("ann", "bob", "ann")]
POSTS = [
    {"username": "ann" if i % 3 else "nobody", "message": f"post {i}", "timestamp_ms": 1000 - i, "id": f"p{i % 50}", "parent_id": f"p{i + 1}" if i % 7 == 0 else None}
    for i in range(60)
]


def write(folder, name, rows, files=1):
    (folder / name).mkdir(parents=True)
    for k in range(files):
        part = rows[k * len(rows) // files : (k + 1) * len(rows) // files]
        (folder / name / f"part-{k:05d}.json").write_text("".join(json.dumps(r) + "\n" for r in part))


def landed(folder, files=3):
    write(folder, "users", USERS)
    write(folder, "teams", [{k: v for k, v in TEAM.items() if k != "channels"}])
    write(folder, "channels", [{"team": "it", **{k: v for k, v in c.items() if k != "posts"}} for c in TEAM["channels"]])
    write(folder, "posts", [{"team": "it", "channel": "gen" if i < 40 else "ops", **p} for i, p in enumerate(POSTS)], files)
    write(folder, "direct_channels", [{"channel": "d", "members": ["ann", "bob"]}])
    write(folder, "direct_posts", [{"channel": "d", "username": "ann", "message": "hi", "timestamp_ms": 5}])


def exported(spark):
    first, second = ({**c, "posts": posts} for c, posts in zip(TEAM["channels"], (POSTS[:40], POSTS[40:]), strict=True))
    body = {"users": USERS, "teams": [{**TEAM, "channels": [first, second]}]}
    body["direct_channels"] = [{"members": ["ann", "bob"], "posts": [{"username": "ann", "message": "hi", "timestamp_ms": 5}]}]
    return documents.workspace(spark.createDataFrame([(0, json.dumps(body))], "doc_idx bigint, body string"))


def bare(rows):
    """Rows without their indexes, in the order of these."""
    keys = [c for c in rows.columns if c.endswith("_idx")]
    return [tuple(r) for r in rows.orderBy(*keys, *[c for c in rows.columns if c == "username"]).drop(*keys).collect()]


def test_same_workspace_as_from_a_document(spark, tmp_path):
    landed(tmp_path)
    found = entities.read_entities(spark, str(tmp_path))
    got, want = entities.workspace(found), exported(spark)
    for name, schema in SCHEMAS.items():
        assert getattr(got, name).columns == [part.split()[0] for part in schema.replace("array<struct<name:string,path:string,url:string>>", "x").split(", ")]
        assert bare(getattr(got, name)) == bare(getattr(want, name)), name
    rules = [sorted(r.message for r in validate.violations(ws).select("message").collect()) for ws in (got, want)]
    assert rules[0] == rules[1] and len(rules[0]) > 5
    assert entities.dangling(found).count() == 0


def test_order_over_many_splits(spark, tmp_path):
    rows = [{"team": "it", "channel": "gen", "username": "u", "message": f"{i} " + "x" * (i % 90), "timestamp_ms": 1} for i in range(3000)]
    write(tmp_path, "posts", rows, 2)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        read = entities.read_entity(spark, str(tmp_path), "posts")
        got = [r.message.split()[0] for r in read.orderBy("idx").collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert got == [str(i) for i in range(3000)]


def test_absent_folders_and_unknown_parents(spark, tmp_path):
    write(tmp_path, "teams", [{"name": "a"}, {"name": "a"}])
    write(tmp_path, "channels", [{"team": "a", "name": "c"}, {"team": "b", "name": "c"}])
    write(tmp_path, "posts", [{"team": "a", "channel": "c", "message": "1"}, {"team": "a", "channel": "x"}, {"channel": "c"}])
    found = entities.read_entities(spark, str(tmp_path))
    ws = entities.workspace(found)
    assert [(r.t_idx, r.message, r.attachments) for r in ws.posts.collect()] == [(0, "1", [])]
    assert ws.users.count() == ws.direct_posts.count() == ws.team_people.count() == 0
    assert sorted((r.entity, r.idx, r.parent) for r in entities.dangling(found).collect()) == [
        ("channels", 1, "b"), ("posts", 1, "a/x"), ("posts", 2, "/c"),
    ]
