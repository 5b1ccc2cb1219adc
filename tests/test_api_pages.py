import json

from chatloom.sources import api_pages


def landed(spark):
    def upn(name):
        return {"userPrincipalName": name}

    def message(id, author, when, text, **more):
        return {"id": id, "from": {"user": upn(author)} if author else None, "createdDateTime": when,
                "body": {"content": text}} | more

    pages = [
        ("users", None, 0, [upn("ann@c.x") | {"mail": "a@mail.x", "displayName": "Ann"}, upn(None), upn("bob@c.x")]),
        ("users", None, 1, [upn("cid@c.x") | {"mail": "", "displayName": ""}]),
        ("groups", None, 0, [{"id": "g1", "mailNickname": "it", "displayName": "IT"}, {"id": "g2"}]),
        ("owners", "g1", 0, [upn("ann@c.x"), {"id": "device"}]),
        ("members", "g1", 0, [upn("ann@c.x"), upn("bob@c.x")]),
        ("members", "g2", 0, [upn("bob@c.x")]),
        ("channels", "g1", 0, [{"id": "c1", "displayName": "General", "membershipType": "standard"},
                               {"id": "c2", "membershipType": "private"}]),
        ("messages", "c1", 0, [message("m1", "ann@c.x", "2024-01-02T03:04:05.678Z", "hi"),
                               message("m2", None, "2024-01-02T03:04:05Z", "system")]),
        ("messages", "c1", 1, [message("m3", "bob@c.x", "bad", None, replyToId="m1",
                                       attachments=[{"name": "f.txt", "contentUrl": "http://h/f"}, {"contentUrl": "http://h/g"}])]),
        ("chats", None, 0, [{"id": "t1"}, {"id": "t2"}]),
        ("chat_members", "t1", 0, [{"email": "zed@o.x"}, upn("ann@c.x"), {}]),
        ("chat_members", "t2", 0, [upn("ann@c.x")]),
        ("chat_messages", "t1", 0, [message("d1", "ann@c.x", "2024-01-02T03:04:05+02:00", "dm", replyToId="x")]),
        ("chat_messages", "t2", 0, [message("d2", "ann@c.x", None, "gone")]),
    ]
    rows = [(e, p, n, json.dumps({"value": v, "@odata.nextLink": "more"})) for e, p, n, v in pages]
    return spark.createDataFrame(rows, "endpoint string, parent_id string, page int, body string")


def test_workspace(spark):
    ws = api_pages.workspace(landed(spark))
    users = [(r.username, r.email, r.nickname) for r in ws.users.orderBy("u_idx").collect()]
    assert users == [("ann", "a@mail.x", "Ann"), ("bob", "bob@c.x", "bob"), ("cid", "cid@c.x", "cid")]
    assert sorted((r.username, r.team_name) for r in ws.user_teams.collect()) == [
        ("ann", "it"), ("bob", "g2"), ("bob", "it"),
    ]
    teams = [(r.name, r.display_name, r.description) for r in ws.teams.orderBy("t_idx").collect()]
    assert teams == [("it", "IT", ""), ("g2", "g2", "")]
    channels = [(r.name, r.display_name, r.is_private) for r in ws.channels.orderBy("c_idx").collect()]
    assert channels == [("General", "General", False), ("c2", "c2", True)]
    assert sorted((r.channel_name, r.username, r.is_owner) for r in ws.channel_people.collect()) == [
        ("General", "ann", False), ("General", "ann", True), ("General", "bob", False),
        ("c2", "ann", False), ("c2", "ann", True), ("c2", "bob", False),
    ]
    posts = ws.posts.orderBy("p_idx").collect()
    assert [(r.id, r.username, r.timestamp_ms, r.message, r.parent_id) for r in posts] == [
        ("m1", "ann", 1704164645678, "hi", None), ("m3", "bob", 0, "", "m1"),
    ]
    assert [(a.name, a.path, a.url) for a in posts[1].attachments] == [
        ("f.txt", "f.txt", "http://h/f"), ("file", "file", "http://h/g"),
    ]
    assert [r.members for r in ws.direct_channels.collect()] == [["zed", "ann"]]
    assert [(r.message, r.timestamp_ms) for r in ws.direct_posts.collect()] == [("dm", 1704157445000)]
