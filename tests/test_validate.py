import pytest
from helpers import make_workspace, post

from chatloom.operators import validate


def found(ws):
    return sorted(r.message for r in validate.violations(ws).collect())


def base(**extra):
    rows = {
        "users": [(0, "Ann", "a@x.y", "A"), (1, "bob", "b@x.y", "B")],
        "teams": [(0, "Team", "Team", "")],
        "channels": [(0, 0, "Team", "Gen", "Gen", False)],
    }
    rows.update(extra)
    return rows


def test_clean_export(spark):
    ws = make_workspace(
        spark,
        **base(
            user_teams=[(0, "Ann", "team")],
            team_people=[(0, "Team", "BOB", True)],
            posts=[post(0, "ann", "x", 1, "a"), post(1, "bob", "y", 2, "b", "a"), post(2, "bob", "self", 3, "c", "c")],
            direct_channels=[(0, ["Ann", "bob"])],
        ),
    )
    assert found(ws) == []
    validate.check(ws)
    assert validate.summary(ws).first().asDict() == {
        "teams": 1, "channels": 1, "users": 2, "posts": 3, "direct_channels": 1, "direct_posts": 0,
    }


def test_each_rule(spark):
    ws = make_workspace(
        spark,
        **base(
            users=[(0, "Ann", "a@x.y", "A"), (1, "ann", "b@x.y", "B")],
            user_teams=[(0, "Ann", "lost"), (1, "ann", "zoo"), (1, "ann", "ark")],
            teams=[(0, "Team", "Team", ""), (1, "team", "T", "")],
            team_people=[(0, "Team", "eve", True), (0, "Team", "eve", False)],
            channels=[(0, 0, "Team", "Gen", "G", False), (0, 1, "Team", "gen", "G", False)],
            channel_people=[(0, 0, "Team", "Gen", "mallory", False)],
            posts=[
                post(0, "ann", "x", 1, "a", "b", channel="Gen"),
                post(1, "ghost", "x", 1, "b", channel="Gen"),
                post(2, "ann", "x", 1, "b", channel="Gen"),
                post(3, "ann", "x", 1, None, "zzz", channel="Gen"),
            ],
            direct_channels=[(0, ["Ann"]), (1, ["Ann", "eve", "eve"])],
            direct_posts=[(1, 0, "trent", "m", 1, None, [])],
        ),
    )
    assert found(ws) == sorted(
        [
            "duplicate username after normalization: ann",
            "duplicate team name after normalization: team",
            "team member 'eve' in team 'Team' is missing from users",
            "duplicate channel name in team 'Team' after normalization: gen",
            "post reply 'a' in channel 'Gen' references unknown parent 'b'",
            "post author 'ghost' in channel 'Gen' is missing from users",
            "duplicate post id in channel 'Gen': b",
            "post reply 'ann' in channel 'Gen' references unknown parent 'zzz'",
            "channel member 'mallory' in channel 'Gen' is missing from users",
            "user 'ann' references unknown teams: ['ark', 'zoo']",
            "direct channel has invalid member count: 1 (minimum 2 required)",
            "direct channel member 'eve' is missing from users",
            "direct channel member 'eve' is missing from users",
            "direct post author 'trent' in DM channel is missing from users",
        ]
    )
    with pytest.raises(validate.ExportInvalid) as info:
        validate.check(ws)
    lines = str(info.value).split("\n")
    assert lines[0].startswith("duplicate username")
    assert lines[1].startswith("team member 'eve'")
    assert lines[-1].startswith("direct post author")


def test_report_keeps_first_twenty(spark):
    ws = make_workspace(spark, **base(direct_posts=[(0, i, f"nobody{i:02d}", "m", 1, None, []) for i in range(30)]))
    with pytest.raises(validate.ExportInvalid) as info:
        validate.check(ws)
    lines = str(info.value).split("\n")
    assert [line.split("'")[1] for line in lines] == [f"nobody{i:02d}" for i in range(20)]


def test_empty(spark):
    ws = make_workspace(spark)
    assert found(ws) == ["input export must contain at least one team and one user"]
    assert validate.violations(ws, fail_on_empty=False).count() == 0
