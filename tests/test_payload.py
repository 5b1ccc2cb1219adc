import json
import os
import random

from helpers import make_workspace, post

from chatloom.operators import attachments, postimport, render, resume
from chatloom.plans import job
from chatloom.plans.options import JobOptions
from chatloom.plans.staging import stage
from chatloom.sources import payload, resumable
from pyspark.sql import functions as F

OPTS = JobOptions()


def sample(spark, **extra):
    rows = {
        "users": [(0, "john-doe", "John@X.y", "John"), (1, "sarah-khan", "s@x.y", "Sarah"), (2, "admin", "a@x.y", "Admin")],
        "user_teams": [(0, "john-doe", "it-team"), (1, "sarah-khan", "it-team")],
        "teams": [(0, "it-team", "IT", "about")],
        "channels": [(0, 0, "it-team", "general", "General", False), (0, 1, "it-team", "ops", "Ops", True)],
        "posts": [
            post(0, "john-doe", "Confidential: budget", 2000, "m1"),
            post(1, "sarah-khan", "hé sarah-khan", 1000, "m2"),
            post(2, "admin", "re", 3000, "m3", "m1"),
        ],
        "direct_channels": [(0, ["sarah-khan", "john-doe"])],
        "direct_posts": [
            (0, 0, "sarah-khan", "Later message", 2000, None, []),
            (0, 1, "john-doe", "Earlier message", 1000, None, []),
        ],
    }
    rows.update(extra)
    return make_workspace(spark, **rows)


def read(path):
    names = sorted(n for n in os.listdir(path) if n.startswith("part-"))
    lines = []
    for name in names:
        with open(os.path.join(path, name), encoding="utf-8") as handle:
            lines += [json.loads(line) for line in handle]
    return lines


def test_whole_job(spark, tmp_path):
    out = str(tmp_path / "out")
    summary = job.run(sample(spark), OPTS, out).first()
    lines = read(out)
    assert [x["type"] for x in lines] == (
        ["version", "team", "channel", "channel", "user", "user", "user", "post", "post", "post", "direct_channel"]
        + ["direct_post"] * 2
    )
    assert summary.records == 13 and summary.posts == 3
    posts = [x["post"] for x in lines if x["type"] == "post"]
    assert [p["create_at"] for p in posts] == [1000, 2000, 3000]
    assert posts[2]["root_id"] == posts[1]["id"] and "root_id" not in posts[0]
    assert all("attachments" not in p for p in posts)
    direct = [x["direct_post"] for x in lines if x["type"] == "direct_post"]
    assert [d["message"] for d in direct] == ["Earlier message", "Later message"]
    assert direct[0]["id"] == "direct-post-b0cf1727d581"
    assert lines[10]["direct_channel"]["members"] == ["sarah-khan", "john-doe"]
    user = next(x["user"] for x in lines if x["type"] == "user")
    assert user["email"] == "john@x.y"
    assert user["teams"] == [
        {"channels": [{"name": "general", "roles": ["channel_user"]}], "name": "it-team", "roles": ["team_user"]}
    ]
    assert sorted(r.name for r in payload.rollback_targets(payload.read_lines(spark, out)).collect()) == [
        "general", "it-team", "ops",
    ]


def test_anonymized(spark, tmp_path):
    out = str(tmp_path / "out")
    job.run(sample(spark), JobOptions(anonymize=True), out)
    lines = read(out)
    messages = [x["post"]["message"] for x in lines if x["type"] == "post"]
    assert messages.count("[PII SCRUBBED]") == 1
    assert any(m.startswith("hé user-") for m in messages)
    users = [x["user"] for x in lines if x["type"] == "user"]
    assert all(u["email"].endswith("@example.invalid") and u["nickname"] == "Anonymized User" for u in users)
    assert users[0]["username"] == "user-312189df6c3b"


def test_attachments(spark):
    files = [("r", "attachments/report.pdf", None), ("m", "attachments/missing.pdf", None)]
    ws = sample(
        spark,
        posts=[
            post(0, "john-doe", "one", 1, "a", files=files[:1]),
            post(1, "john-doe", "two", 2, "b", files=files[1:]),
            post(2, "john-doe", "both", 3, "c", files=files + [("x", "attachments/report.pdf", "http://h/x")]),
        ],
    )
    listing = spark.createDataFrame([("attachments/report.pdf",)], "source string")
    outcome = attachments.outcomes(attachments.manifest(ws), listing)
    assert {r.status: r.files for r in attachments.outcome_counts(outcome).collect()} == {"success": 1, "failed": 1}
    rows = {r.p_idx: r for r in render.render_posts(ws, render.build_maps(ws, OPTS), OPTS, outcome).collect()}
    name = "28f2b7eb_report.pdf"
    assert rows[0].file_ids == [name]
    assert rows[0].attachments[0].path == "attachments/" + name
    assert rows[1].attachments is None and rows[1].file_ids is None
    assert rows[2].file_ids == [name, name]


def test_file_listing(spark, tmp_path):
    (tmp_path / "a" / "b").mkdir(parents=True)
    (tmp_path / "a" / "b" / "x.txt").write_text("x")
    assert [r.source for r in attachments.list_files(spark, f"file:{tmp_path}").collect()] == ["a/b/x.txt"]


def pack_model(sizes, limit):
    parts, part, held = [], 1, 0
    for size in sizes:
        if held > 0 and held + size > limit:
            part, held = part + 1, 34
        held += size
        parts.append(part)
    return parts


def test_packing_equals_walk_in_order(spark):
    rng = random.Random(9)
    cases = [([5], 100), ([200, 200, 10], 100), ([50, 50, 1], 100), ([66, 34, 66, 1], 100)]
    for _ in range(3):
        limit = rng.randint(80, 400)
        cases.append(([rng.choice([1, 7, 30, 66, 100, 500]) for _ in range(rng.randint(1, 60))], limit))
    for sizes, limit in cases:
        df = spark.createDataFrame(list(enumerate(sizes)), "batch bigint, bytes bigint")
        got = {r.batch: r.part for r in payload.part_numbers(df, limit).collect()}
        assert [got[i] for i in range(len(sizes))] == pack_model(sizes, limit), (sizes, limit)


def test_parts_of_a_large_payload(spark, tmp_path):
    big = "x" * 1_100_000
    ws = sample(spark, posts=[post(0, "john-doe", big, 1, "a"), post(1, "john-doe", "small", 2, "b")])
    records = render.all_records(ws, OPTS)
    out = str(tmp_path / "parts")
    payload.write_parts(payload.with_parts(records, 1, 1), out)
    parts = sorted(n for n in os.listdir(out) if n.startswith("part="))
    assert parts == ["part=part001", "part=part002", "part=part003"]
    second, third = (read(os.path.join(out, p)) for p in parts[1:])
    assert second[0] == {"type": "version", "version": 1} and len(second) == 2
    assert third[0]["type"] == "version" and third[1]["post"]["message"] == "small"
    line = json.dumps({"type": "version", "version": 1}, sort_keys=True)
    assert payload.VERSION_LINE == line


def test_large_channel(spark, tmp_path):
    ws = sample(
        spark,
        user_teams=[],
        posts=[post(i, "john-doe", f"message-{i}", i, f"m{i}") for i in range(250)],
        channels=[(0, 0, "it-team", "general", "General", False)],
        users=[(0, "john-doe", "j@x.y", "J")],
        direct_channels=[],
        direct_posts=[],
    )
    out = str(tmp_path / "out")
    assert job.run(ws, JobOptions(batch_size=17), out).first().records == 254
    assert read(out)[-1]["post"]["message"] == "message-249"


def ties(spark):
    return sample(
        spark,
        posts=[
            post(0, "john-doe", "1", 1000, "p1"),
            post(1, "john-doe", "2", 2000, "p2"),
            post(2, "john-doe", "3", 2000, "p3"),
            post(3, "john-doe", "4", 3000, "p4"),
        ],
    )


def test_resume_by_state(spark):
    records = render.all_records(ties(spark), OPTS)
    posts = {r.message: r.id for r in records.select("post.*").filter("id is not null").collect()}
    written = records.filter((F.col("type") != "direct_post") & (F.col("type") != "direct_channel")).filter(
        (F.col("type") != "post") | F.col("post.message").isin("1", "2")
    )
    state = resume.resume_state(written)
    assert [(r.scope, r.last_ts, r.id) for r in state.collect()] == [("it-team/general", 2000, posts["2"])]
    assert resume.finished_scopes(written).count() == 0
    assert resume.finished_scopes(written, ended=True).count() == 1
    left = resume.remaining_by_state(records, written, state, resume.finished_scopes(written))
    assert sorted(r.message for r in left.select("post.message").dropna().collect()) == ["3", "4"]
    assert left.filter("type = 'direct_post'").count() == 2
    by_id = resume.remaining(records, written)
    assert sorted(r.message for r in by_id.select("post.message").dropna().collect()) == ["3", "4"]
    assert resume.remaining(records, None) is records
    assert resume.remaining(records, records.filter("false")) is records


def test_keep_first_import(spark):
    rows = [
        (1, 50, '{"import_id": "a"}'),
        (2, 40, '{"import_id":"a"}'),
        (3, 40, '{"import_id"  : "a", "z": 1}'),
        (4, 10, '{"import_id": 5}'),
        (5, 11, '{"import_id": ""}'),
        (6, 1, "{}"),
        (7, 1, "{}"),
        (8, 1, None),
    ]
    df = spark.createDataFrame(rows, "id bigint, createat bigint, props string")
    assert sorted(r.id for r in postimport.keep_first_import(df).collect()) == [2, 4, 6, 7, 8]
    empty = df.filter("false")
    assert not postimport.verify_counts(df, empty, df, empty).first().healthy
    assert postimport.verify_counts(df, empty, df, df).first().healthy


def stem_files(path):
    return sorted(n for n in os.listdir(path) if n.endswith(".jsonl"))


def all_lines(path):
    lines = []
    for name in stem_files(path):
        with open(os.path.join(path, name), encoding="utf-8") as handle:
            lines.append(handle.read())
    return lines


def long_posts(n, size=30_000):
    return [post(i, "john-doe", f"{i} " + "x" * size, i, f"m{i}") for i in range(n)]


def cut_run(folder, records, batch, start, keep):
    """A run that gets as far as the first records in order."""
    first = records.orderBy(*render.ORDER).limit(keep)
    return resumable.write(folder, first, batch, 1, start)


def test_a_cut_run_and_a_second_one_equal_a_full_run(spark, tmp_path):
    ws = sample(spark, posts=long_posts(120))
    opts = JobOptions(batch_size=5, max_chunk_mb=1)
    records = stage(render.all_records(ws, opts))
    total = records.count()
    whole, cut = (resumable.Folder(spark, str(tmp_path / n), "chat") for n in ("whole", "cut"))
    resumable.write(whole, records, 5, 1, resumable.gate(whole))
    assert stem_files(whole.path) == [f"chat.part00{k}.jsonl" for k in (1, 2, 3, 4)]
    cut_run(cut, records, 5, resumable.gate(cut), 60)
    # The process ends in the middle of a line of the last part.
    with open(os.path.join(cut.path, stem_files(cut.path)[-1]), "a", encoding="utf-8") as handle:
        handle.write('{"post": {"attachments": [], "cha')
    os.remove(os.path.join(cut.path, f".{stem_files(cut.path)[-1]}.crc"))
    start = resumable.gate(cut)
    assert start.resumed and start.last == 2 and start.written.count() == 60
    left = resume.remaining(records, start.written)
    assert left.count() == total - 60
    manifest = resumable.write(cut, left, 5, 1, start)
    assert all_lines(cut.path) == all_lines(whole.path)
    sizes = {r.part: (r.bytes, r.records) for r in manifest.collect()}
    for number, text in enumerate(all_lines(cut.path), 1):
        assert sizes[number] == (len(text), text.count("\n")) and len(text) <= 1 << 20
    again = resumable.gate(cut)
    assert resume.remaining(records, again.written).count() == 0
    back = resumable.read_records(cut).select("type", *render.RECORD_TYPES)
    assert back.exceptAll(records.select("type", *render.RECORD_TYPES)).count() == 0 and back.count() == total


def test_what_a_run_without_a_manifest_left_is_replaced(spark, tmp_path):
    records = stage(render.all_records(sample(spark), OPTS))
    folder = resumable.Folder(spark, str(tmp_path / "out"), "chat")
    os.makedirs(folder.path)
    for number in (1, 7):
        (tmp_path / "out" / f"chat.part00{number}.jsonl").write_text('{"type": "version", "version": 1}\n')
    start = resumable.gate(folder)
    assert not start.resumed and start.written is None
    resumable.write(folder, records, 17, 1, start)
    assert stem_files(folder.path) == ["chat.part001.jsonl"]
    # A manifest without any record: start afresh as well.
    (tmp_path / "out" / "chat.part001.jsonl").write_text('{"type": "ver')
    os.remove(tmp_path / "out" / ".chat.part001.jsonl.crc")
    assert not resumable.gate(folder).resumed


def test_job_goes_on_with_its_parts(spark, tmp_path):
    out, opts = str(tmp_path / "out"), JobOptions(batch_size=3, max_chunk_mb=1)
    first = job.run(sample(spark, posts=long_posts(2, 10)), opts, out).first()
    summary = job.run(sample(spark, posts=long_posts(40)), opts, out, source=spark.read.text(__file__)).first()
    assert (first.records, summary.records, summary.bytes) == (12, 38, os.path.getsize(__file__))
    lines = [json.loads(x) for text in all_lines(out) for x in text.splitlines()]
    assert sum(x["type"] == "post" for x in lines) == 40 and len(stem_files(out)) == 2


def test_state_kept_up_per_batch(spark):
    rng = random.Random(2)
    posts = [post(i, "john-doe", str(i), rng.randint(0, 6), f"p{i}", c=rng.randint(0, 1)) for i in range(60)]
    records = stage(render.all_records(sample(spark, posts=posts), OPTS))
    batches = [records.filter(F.pmod(F.xxhash64("post.id"), F.lit(3)) == k) for k in range(3)]
    state = stage(resume.resume_state(records.filter("false")))
    done = records.filter("false")
    for batch in batches:
        state, done = stage(resume.merged_state(state, batch)), done.unionByName(batch)
        assert set(state.collect()) == set(resume.resume_state(done).collect())
