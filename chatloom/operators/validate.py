"""Cross-reference checks. Every rule is a table of (rule, order_key, message).

Names are compared as slugs. "First" and "last" rules use min/max aggregates, which
combine before the shuffle, so a name that fills a third of a table stays cheap.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatloom.functions.text import non_empty, slugify
from chatloom.plans.workspace import Workspace

REPORT_LIMIT = 20  # fixed value: a failed check reports this many messages


class ExportInvalid(ValueError):
    """The export breaks at least one rule."""


def _key(*parts: Column | int) -> Column:
    """Order key: phase, then alternating source positions and stages, then a text."""
    names = ("phase", "a", "a_stage", "b", "b_stage", "c", "c_stage")
    values = [p if isinstance(p, Column) else F.lit(p) for p in parts]
    values += [F.lit(0)] * (len(names) - len(values))
    return F.struct(*[v.cast("bigint").alias(n) for n, v in zip(names, values, strict=True)])


def _rule(df: DataFrame, rule: str, key: Column, message: Column) -> DataFrame:
    return df.select(F.lit(rule).alias("rule"), key.alias("order_key"), message.alias("message"))


def _known(ws: Workspace) -> DataFrame:
    return ws.users.select(slugify(F.col("username")).alias("_slug")).distinct()


def _missing(df: DataFrame, column: str, known: DataFrame) -> DataFrame:
    return df.withColumn("_slug", slugify(F.col(column))).join(known, "_slug", "left_anti")


def _repeats(df: DataFrame, keys: list[str], position: str) -> DataFrame:
    """Rows of a key after its first one."""
    firsts = (
        df.groupBy(*keys)
        .agg(F.min(position).alias("_first"), F.count("*").alias("_n"))
        .filter("_n > 1")
        .drop("_n")
    )
    return df.join(firsts, keys).filter(F.col(position) > F.col("_first"))


def duplicate_users(ws: Workspace) -> DataFrame:
    df = ws.users.select("u_idx", "username", slugify(F.col("username")).alias("_slug"))
    return _rule(
        _repeats(df, ["_slug"], "u_idx"),
        "duplicate_user",
        _key(1, F.col("u_idx")),
        F.concat(F.lit("duplicate username after normalization: "), "username"),
    )


def duplicate_teams(ws: Workspace) -> DataFrame:
    df = ws.teams.select("t_idx", "name", slugify(F.col("name")).alias("_slug"))
    return _rule(
        _repeats(df, ["_slug"], "t_idx"),
        "duplicate_team",
        _key(2, F.col("t_idx")),
        F.concat(F.lit("duplicate team name after normalization: "), "name"),
    )


def missing_team_people(ws: Workspace) -> DataFrame:
    people = ws.team_people.select("t_idx", "team_name", "username").distinct()
    return _rule(
        _missing(people, "username", _known(ws)),
        "team_member_missing",
        _key(2, F.col("t_idx"), 1),
        F.format_string("team member '%s' in team '%s' is missing from users", "username", "team_name"),
    )


def duplicate_channels(ws: Workspace) -> DataFrame:
    df = ws.channels.select("t_idx", "c_idx", "team_name", "name", slugify(F.col("name")).alias("_slug"))
    return _rule(
        _repeats(df, ["t_idx", "_slug"], "c_idx"),
        "duplicate_channel",
        _key(2, F.col("t_idx"), 2, F.col("c_idx")),
        F.format_string(
            "duplicate channel name in team '%s' after normalization: %s", "team_name", "name"
        ),
    )


def _post_key(stage: int) -> Column:
    return _key(2, F.col("t_idx"), 2, F.col("c_idx"), 1, F.col("p_idx"), stage)


def duplicate_posts(ws: Workspace) -> DataFrame:
    df = ws.posts.select("t_idx", "c_idx", "p_idx", "channel_name", "id").filter(
        non_empty(F.col("id")).isNotNull()
    )
    return _rule(
        _repeats(df, ["t_idx", "c_idx", "id"], "p_idx"),
        "duplicate_post",
        _post_key(0),
        F.format_string("duplicate post id in channel '%s': %s", "channel_name", "id"),
    )


def missing_post_authors(ws: Workspace) -> DataFrame:
    df = ws.posts.select("t_idx", "c_idx", "p_idx", "channel_name", "username")
    return _rule(
        _missing(df, "username", _known(ws)),
        "post_author_missing",
        _post_key(1),
        F.format_string(
            "post author '%s' in channel '%s' is missing from users", "username", "channel_name"
        ),
    )


def unknown_parents(ws: Workspace) -> DataFrame:
    """Replies whose parent id does not occur at or before them in the channel."""
    posts = ws.posts.select("t_idx", "c_idx", "p_idx", "channel_name", "username", "id", "parent_id")
    firsts = (
        posts.filter(non_empty(F.col("id")).isNotNull())
        .groupBy("t_idx", "c_idx", F.col("id").alias("parent_id"))
        .agg(F.min("p_idx").alias("_first"))
    )
    replies = posts.filter(non_empty(F.col("parent_id")).isNotNull())
    broken = replies.join(firsts, ["t_idx", "c_idx", "parent_id"], "left").filter(
        F.col("_first").isNull() | (F.col("_first") > F.col("p_idx"))
    )
    return _rule(
        broken,
        "reply_parent_unknown",
        _post_key(2),
        F.format_string(
            "post reply '%s' in channel '%s' references unknown parent '%s'",
            F.coalesce(non_empty(F.col("id")), F.col("username")),
            "channel_name",
            "parent_id",
        ),
    )


def missing_channel_people(ws: Workspace) -> DataFrame:
    people = ws.channel_people.select("t_idx", "c_idx", "channel_name", "username").distinct()
    return _rule(
        _missing(people, "username", _known(ws)),
        "channel_member_missing",
        _key(2, F.col("t_idx"), 2, F.col("c_idx"), 2),
        F.format_string(
            "channel member '%s' in channel '%s' is missing from users", "username", "channel_name"
        ),
    )


def unknown_user_teams(ws: Workspace) -> DataFrame:
    """Per user slug, teams of its last entry that do not exist."""
    latest = (
        ws.users.groupBy(slugify(F.col("username")).alias("_slug"))
        .agg(F.min("u_idx").alias("_first"), F.max("u_idx").alias("u_idx"))
    )
    known = ws.teams.select(slugify(F.col("name")).alias("_team")).distinct()
    stray = (
        ws.user_teams.select("u_idx", slugify(F.col("team_name")).alias("_team"))
        .join(known, "_team", "left_anti")
        .join(latest, "u_idx")
        .groupBy("_slug", "_first")
        .agg(F.array_sort(F.collect_set("_team")).alias("_teams"))
    )
    listed = F.array_join(F.transform("_teams", lambda t: F.concat(F.lit("'"), t, F.lit("'"))), ", ")
    return _rule(
        stray,
        "user_unknown_teams",
        _key(3, F.col("_first")),
        F.format_string("user '%s' references unknown teams: [%s]", "_slug", listed),
    )


def bad_direct_sizes(ws: Workspace) -> DataFrame:
    size = F.size("members")
    return _rule(
        ws.direct_channels.filter(size < 2),
        "direct_channel_size",
        _key(4, F.col("d_idx")),
        F.format_string(
            "direct channel has invalid member count: %d (minimum 2 required)", size
        ),
    )


def missing_direct_members(ws: Workspace) -> DataFrame:
    people = ws.direct_channels.select("d_idx", F.posexplode("members").alias("pos", "username"))
    return _rule(
        _missing(people, "username", _known(ws)),
        "direct_member_missing",
        _key(4, F.col("d_idx"), 1, F.col("pos")),
        F.format_string("direct channel member '%s' is missing from users", "username"),
    )


def missing_direct_authors(ws: Workspace) -> DataFrame:
    df = ws.direct_posts.select("d_idx", "p_idx", "username")
    return _rule(
        _missing(df, "username", _known(ws)),
        "direct_author_missing",
        _key(4, F.col("d_idx"), 2, F.col("p_idx")),
        F.format_string("direct post author '%s' in DM channel is missing from users", "username"),
    )


def empty_export(ws: Workspace) -> DataFrame:
    sides = ws.teams.select(F.lit("t").alias("side")).limit(1).unionByName(
        ws.users.select(F.lit("u").alias("side")).limit(1)
    )
    return _rule(
        sides.agg(F.count("*").alias("_n")).filter("_n < 2"),
        "empty_export",
        _key(5),
        F.lit("input export must contain at least one team and one user"),
    )


def violations(ws: Workspace, fail_on_empty: bool = True) -> DataFrame:
    """Every broken rule of the export."""
    rules = [
        duplicate_users,
        duplicate_teams,
        missing_team_people,
        duplicate_channels,
        duplicate_posts,
        missing_post_authors,
        unknown_parents,
        missing_channel_people,
        unknown_user_teams,
        bad_direct_sizes,
        missing_direct_members,
        missing_direct_authors,
    ]
    if fail_on_empty:
        rules.append(empty_export)
    result = rules[0](ws)
    for rule in rules[1:]:
        result = result.unionByName(rule(ws))
    return result


def report(found: DataFrame) -> DataFrame:
    """The first messages in report order (a top-k, not a full sort)."""
    return found.orderBy("order_key", "message").limit(REPORT_LIMIT)


def check(ws: Workspace, fail_on_empty: bool = True) -> None:
    """Raise ``ExportInvalid`` with the report when any rule is broken."""
    lines = [row.message for row in report(violations(ws, fail_on_empty)).collect()]
    if lines:
        raise ExportInvalid("\n".join(lines))


def summary(ws: Workspace) -> DataFrame:
    """One row of entity counts."""
    counted = {
        "teams": ws.teams,
        "channels": ws.channels,
        "users": ws.users,
        "posts": ws.posts,
        "direct_channels": ws.direct_channels,
        "direct_posts": ws.direct_posts,
    }
    # One grouped count over tags instead of six separate results to stitch together.
    tags = None
    for name, df in counted.items():
        part = df.select(F.lit(name).alias("entity"))
        tags = part if tags is None else tags.unionByName(part)
    return tags.agg(*[F.count_if(F.col("entity") == name).alias(name) for name in counted])


def slug_sets(ws: Workspace) -> DataFrame:
    """The distinct team and user slugs the checks compare against, as rows."""
    return (
        ws.teams.select(F.lit("team").alias("kind"), slugify(F.col("name")).alias("slug"))
        .unionByName(ws.users.select(F.lit("user").alias("kind"), slugify(F.col("username")).alias("slug")))
        .distinct()
    )
