"""Who belongs to which team and channel, with roles. Names match exactly as written."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatloom.functions.text import slugify
from chatloom.plans.workspace import Workspace

# Role names of the target system.
TEAM_OWNER_ROLES = ("team_admin", "team_user")
TEAM_ROLES = ("team_user",)
CHANNEL_OWNER_ROLES = ("channel_admin", "channel_user")
CHANNEL_ROLES = ("channel_user",)


def _roles(is_owner, owner_roles, roles):
    return F.when(is_owner, F.array(*map(F.lit, owner_roles))).otherwise(F.array(*map(F.lit, roles)))


def _last_teams(ws: Workspace) -> DataFrame:
    """Of teams sharing a raw name, the last entry speaks for the name."""
    return ws.teams.groupBy(F.col("name").alias("team_name")).agg(F.max("t_idx").alias("t_idx"))


def user_team_pairs(ws: Workspace) -> DataFrame:
    """Distinct (username, team_name) from users, team people and channel people."""
    pairs = ["username", "team_name"]
    return (
        ws.user_teams.select(*pairs)
        .unionByName(ws.team_people.select(*pairs))
        .unionByName(ws.channel_people.select(*pairs))
        .distinct()
    )


def team_roles(ws: Workspace) -> DataFrame:
    """(username, team_name, roles); one shuffle unites the pairs and the owner flags."""
    owners = (
        ws.team_people.filter("is_owner")
        .join(_last_teams(ws), ["team_name", "t_idx"], "left_semi")
        .select("username", "team_name", F.lit(True).alias("is_owner"))
    )
    pairs = ["username", "team_name"]
    flagged = owners
    for source in (ws.user_teams, ws.team_people, ws.channel_people):
        flagged = flagged.unionByName(source.select(*pairs, F.lit(False).alias("is_owner")))
    return flagged.groupBy(*pairs).agg(
        _roles(F.max("is_owner"), TEAM_OWNER_ROLES, TEAM_ROLES).alias("roles")
    )


def _channel_rows(ws: Workspace) -> DataFrame:
    """(username, team_name, channel_name, is_owner) before merging.

    Public channels reach every member of the team; private ones only the people
    listed, and those are rows of ``channel_people`` already.
    """
    live = ws.channels.join(_last_teams(ws), ["team_name", "t_idx"], "left_semi")
    names = live.groupBy("team_name", F.col("name").alias("channel_name")).agg(
        F.max("c_idx").alias("c_idx"), F.max(~F.col("is_private")).alias("is_public")
    )
    public = names.filter("is_public").select("team_name", "channel_name")
    open_to_all = user_team_pairs(ws).join(public, "team_name").withColumn("is_owner", F.lit(False))
    listed = (
        ws.channel_people.join(_last_teams(ws), ["team_name", "t_idx"], "left_semi")
        .join(names.drop("is_public"), ["team_name", "channel_name", "c_idx"], "left_semi")
        .select("username", "team_name", "channel_name", "is_owner")
    )
    return open_to_all.unionByName(listed)


def channel_roles(ws: Workspace) -> DataFrame:
    """(username, team_name, channel_name, roles) of every channel a user can see."""
    return (
        _channel_rows(ws)
        .groupBy("username", "team_name", "channel_name")
        .agg(_roles(F.max("is_owner"), CHANNEL_OWNER_ROLES, CHANNEL_ROLES).alias("roles"))
    )


def memberships(ws: Workspace, teams: DataFrame, channels: DataFrame) -> DataFrame:
    """(username, teams) with teams → channels nested, slugs resolved, source order kept.

    ``teams`` and ``channels`` are the slug maps. Names without a map entry fall back to
    their slug and sort last.
    """
    team_order = _last_teams(ws)
    channel_order = ws.channels.groupBy("team_name", F.col("name").alias("channel_name")).agg(
        F.min("c_idx").alias("c_idx")
    )
    per_channel = (
        channel_roles(ws)
        .join(channels, ["team_name", "channel_name"], "left")
        .join(channel_order, ["team_name", "channel_name"], "left")
        .select(
            "username",
            "team_name",
            F.lit(None).cast("array<string>").alias("team_roles"),
            F.struct(
                F.col("c_idx"),
                F.coalesce("channel_slug", slugify(F.col("channel_name"))).alias("name"),
                "roles",
            ).alias("channel"),
        )
    )
    per_team = team_roles(ws).select(
        "username",
        "team_name",
        F.col("roles").alias("team_roles"),
        F.lit(None).cast(per_channel.schema["channel"].dataType).alias("channel"),
    )
    # Both levels group under the user's partition, so one shuffle serves both.
    nested = (
        per_team.unionByName(per_channel)
        .repartition("username")
        .groupBy("username", "team_name")
        .agg(
            F.first("team_roles", ignorenulls=True).alias("roles"),
            F.array_sort(F.collect_list("channel")).alias("channels"),
        )
        .join(teams, "team_name", "left")
        .join(team_order, "team_name", "left")
    )
    entry = F.struct(
        F.coalesce("t_idx", F.lit(1 << 62)).alias("t_idx"),
        F.coalesce("team_slug", slugify(F.col("team_name"))).alias("name"),
        F.transform("channels", lambda c: F.struct(c["name"].alias("name"), c["roles"].alias("roles"))).alias("channels"),
        F.col("roles"),
    )
    return (
        nested.groupBy("username")
        .agg(F.array_sort(F.collect_list(entry)).alias("teams"))
        .select(
            "username",
            F.transform(
                "teams",
                lambda t: F.struct(
                    t["channels"].alias("channels"), t["name"].alias("name"), t["roles"].alias("roles")
                ),
            ).alias("teams"),
        )
    )
