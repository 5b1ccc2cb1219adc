from helpers import make_workspace

from chatloom.operators import membership, naming, render
from chatloom.plans.options import JobOptions


def nested(spark, ws):
    rows = membership.memberships(ws, naming.team_slugs(ws), naming.channel_slugs(ws)).collect()
    return {
        r.username: [(t.name, list(t.roles), [(c.name, list(c.roles)) for c in t.channels]) for t in r.teams]
        for r in rows
    }


def test_roles_and_visibility(spark):
    ws = make_workspace(
        spark,
        users=[(0, "ann", "a@x.y", "A"), (1, "bob", "b@x.y", "B"), (2, "cid", "c@x.y", "C"), (3, "dan", "d@x.y", "D")],
        user_teams=[(0, "ann", "T One"), (1, "bob", "Ghost Team")],
        teams=[(0, "T One", "T", ""), (1, "T Two", "T", "")],
        team_people=[(0, "T One", "bob", True), (0, "T One", "bob", False)],
        channels=[
            (0, 0, "T One", "Gen", "G", False),
            (0, 1, "T One", "Sec", "S", True),
            (1, 0, "T Two", "Only", "O", True),
        ],
        channel_people=[
            (0, 1, "T One", "Sec", "bob", True),
            (1, 0, "T Two", "Only", "cid", False),
            (0, 0, "T One", "Gen", "ann", True),
        ],
    )
    team, owner = ["team_user"], ["team_admin", "team_user"]
    chan, chief = ["channel_user"], ["channel_admin", "channel_user"]
    got = nested(spark, ws)
    assert got == {
        "ann": [("t-one", team, [("gen", chief)])],
        "bob": [("t-one", owner, [("gen", chan), ("sec", chief)]), ("ghost-team", team, [])],
        "cid": [("t-two", team, [("only", chan)])],
    }
    opts = JobOptions()
    users = {r.username: r for r in render.render_users(ws, render.build_maps(ws, opts), opts).collect()}
    assert users["dan"].teams == []
    assert users["ann"].auth_service is None


def test_scale_shape(spark):
    people = 1000
    ws = make_workspace(
        spark,
        users=[(i, f"user{i}", "e@x.y", "n") for i in range(people)],
        user_teams=[(i, f"user{i}", f"team{i % 10}") for i in range(people)],
        teams=[(t, f"team{t}", "T", "") for t in range(10)],
        channels=[(t, c, f"team{t}", f"chan{c}", "C", c % 2 == 1) for t in range(10) for c in range(20)],
    )
    got = nested(spark, ws)
    assert len(got) == people
    assert all(len(teams) == 1 and len(teams[0][2]) == 10 for teams in got.values())


def test_auth_columns(spark):
    ws = make_workspace(spark, users=[(0, "Ann Lee", " A@X.y ", "A")])

    def user(**options):
        opts = JobOptions(**options)
        return render.identities(ws, render.build_maps(ws, opts), opts).first()

    plain = user(auth_service="saml")
    assert (plain.username, plain.email, plain.auth_data) == ("ann-lee", "a@x.y", " A@X.y ")
    assert user(auth_service="saml", auth_data_field=" Username ").auth_data == "ann-lee"
    hidden = user(anonymize=True, auth_service="ldap")
    assert hidden.auth_data == hidden.email == hidden.username + "@example.invalid"
    assert user(anonymize=True, auth_service="ldap", mask_auth_data=False).auth_data == " A@X.y "
