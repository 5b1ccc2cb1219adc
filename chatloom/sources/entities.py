"""A workspace from one folder of JSON lines or Parquet per entity.

An export document is one row, so one task. Here every entity is a folder of files that
Spark reads in splits: a channel may span many files, and a file many tasks. Source order
is that of the files' paths, and in a file that of the splits and their lines.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chatloom.operators.sequence import global_index
from chatloom.plans.staging import stage, together
from chatloom.plans.workspace import ATTACHMENTS, Workspace

#: Fields of each entity's rows; ``team`` and ``channel`` name the entry a row belongs to.
FIELDS = {
    "users": "username string, email string, nickname string, teams array<string>",
    "teams": "name string, display_name string, description string, members array<string>, owners array<string>",
    "channels": "team string, name string, display_name string, is_private boolean, "
    "members array<string>, owners array<string>",
    "posts": "team string, channel string, username string, message string, timestamp_ms bigint, id string, "
    f"parent_id string, attachments {ATTACHMENTS}",
    "direct_channels": "channel string, members array<string>",
    "direct_posts": f"channel string, username string, message string, timestamp_ms bigint, id string, attachments {ATTACHMENTS}",
}


@dataclass(frozen=True)
class Entities:
    """Staged rows of each entity with ``idx``, their place in source order."""

    users: DataFrame
    teams: DataFrame
    channels: DataFrame
    posts: DataFrame
    direct_channels: DataFrame
    direct_posts: DataFrame


def read_entity(spark: SparkSession, root: str, entity: str, file_format: str = "json") -> DataFrame:
    """(idx, fields): the rows of one entity in source order; an absent folder has none."""
    root = root.rstrip("/")
    at = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/{entity}")
    if not at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at):
        return spark.createDataFrame([], f"idx bigint, {FIELDS[entity]}")
    rows = spark.read.schema(FIELDS[entity]).format(file_format).load(f"{root}/{entity}")
    placed = rows.select(
        *rows.columns,
        F.col("_metadata.file_path").alias("_path"),
        F.col("_metadata.file_block_start").alias("_start"),
        # Lines of one split are read one after another.
        F.monotonically_increasing_id().alias("_line"),
    )
    indexed = global_index(placed, ["_path", "_start", "_line"], "idx", label=entity)
    return indexed.select("idx", *rows.columns)


def read_entities(spark: SparkSession, root: str, file_format: str = "json") -> Entities:
    read = [lambda e=e: stage(read_entity(spark, root, e, file_format), e) for e in FIELDS]
    return Entities(*together(*read))


def _first(rows: DataFrame, names: dict[str, str], idx: str) -> DataFrame:
    """One row per name: the first entry that bears it."""
    renamed = [F.col(source).alias(name) for name, source in names.items()]
    return rows.select(*renamed, "idx").groupBy(*names).agg(F.min("idx").alias(idx))


def _people(rows: DataFrame) -> DataFrame:
    """Members and owners of teams or channels, one row each, with the other columns."""
    none = F.array().cast("array<string>")
    members = F.transform(F.coalesce("members", none), lambda p: F.struct(p.alias("username"), F.lit(False).alias("is_owner")))
    owners = F.transform(F.coalesce("owners", none), lambda p: F.struct(p.alias("username"), F.lit(True).alias("is_owner")))
    others = [c for c in rows.columns if c not in ("members", "owners")]
    return rows.select(*others, F.explode(F.concat(members, owners)).alias("p")).select(*others, "p.username", "p.is_owner")


def workspace(found: Entities) -> Workspace:
    """The tables of ``Workspace``; rows whose team or channel does not exist are left out (see ``dangling``)."""
    teams = _first(found.teams, {"team": "name"}, "t_idx")
    channels = found.channels.join(teams, "team")
    places = stage(_first(channels, {"team": "team", "channel": "name"}, "c_idx").join(teams, "team"), "places")
    chats = _first(found.direct_channels, {"channel": "channel"}, "d_idx")
    no_files = F.array().cast(ATTACHMENTS)
    return Workspace(
        users=found.users.select(F.col("idx").alias("u_idx"), "username", "email", "nickname"),
        user_teams=found.users.select(F.col("idx").alias("u_idx"), "username", F.explode("teams").alias("team_name")),
        teams=found.teams.select(
            F.col("idx").alias("t_idx"), "name", "display_name", F.coalesce("description", F.lit("")).alias("description")
        ),
        team_people=_people(
            found.teams.select(F.col("idx").alias("t_idx"), F.col("name").alias("team_name"), "members", "owners")
        ),
        channels=channels.select(
            "t_idx", F.col("idx").alias("c_idx"), F.col("team").alias("team_name"), "name", "display_name",
            F.coalesce("is_private", F.lit(False)).alias("is_private"),
        ),
        channel_people=_people(
            channels.select(
                "t_idx", F.col("idx").alias("c_idx"), F.col("team").alias("team_name"),
                F.col("name").alias("channel_name"), "members", "owners",
            )
        ),
        posts=found.posts.join(places, ["team", "channel"]).select(
            "t_idx", "c_idx", F.col("idx").alias("p_idx"), F.col("team").alias("team_name"),
            F.col("channel").alias("channel_name"), "username", "message", "timestamp_ms", "id", "parent_id",
            F.coalesce("attachments", no_files).alias("attachments"),
        ),
        direct_channels=found.direct_channels.select(F.col("idx").alias("d_idx"), "members"),
        direct_posts=found.direct_posts.join(chats, "channel").select(
            "d_idx", F.col("idx").alias("p_idx"), "username", "message", "timestamp_ms", "id",
            F.coalesce("attachments", no_files).alias("attachments"),
        ),
    )


def dangling(found: Entities) -> DataFrame:
    """(entity, idx, parent): rows that name a team or channel no entry has."""
    teams = found.teams.select(F.col("name").alias("team"))
    places = found.channels.select("team", F.col("name").alias("channel"))
    place = F.concat_ws("/", F.coalesce("team", F.lit("")), F.coalesce("channel", F.lit("")))
    parts = [
        found.channels.join(teams, "team", "left_anti").select(F.lit("channels").alias("entity"), "idx", F.col("team").alias("parent")),
        found.posts.join(places, ["team", "channel"], "left_anti").select(F.lit("posts").alias("entity"), "idx", place.alias("parent")),
        found.direct_posts.join(found.direct_channels.select("channel"), "channel", "left_anti").select(
            F.lit("direct_posts").alias("entity"), "idx", F.col("channel").alias("parent")
        ),
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def write_entities(ws: Workspace, root: str) -> None:
    """A workspace as JSON lines per entity, in source order; its indexes become places."""
    team = ws.teams.select("t_idx", F.col("name").alias("team"))

    def listed(people: DataFrame, keys: list[str]) -> DataFrame:
        kinds = [F.sort_array(F.collect_list(F.when(is_owner, F.col("username")))).alias(name) for name, is_owner in (("members", ~F.col("is_owner")), ("owners", F.col("is_owner")))]
        return people.groupBy(*keys).agg(*kinds)

    own_teams = ws.user_teams.groupBy("u_idx").agg(F.sort_array(F.collect_list("team_name")).alias("teams"))
    chat = F.concat(F.lit("d"), F.col("d_idx")).alias("channel")
    rows = {
        "users": (ws.users.join(own_teams, "u_idx", "left"), ["u_idx"]),
        "teams": (ws.teams.join(listed(ws.team_people, ["t_idx"]), "t_idx", "left"), ["t_idx"]),
        "channels": (
            ws.channels.join(team, "t_idx").join(listed(ws.channel_people, ["t_idx", "c_idx"]), ["t_idx", "c_idx"], "left"),
            ["t_idx", "c_idx"],
        ),
        "posts": (
            ws.posts.select("*", F.col("team_name").alias("team"), F.col("channel_name").alias("channel")),
            ["t_idx", "c_idx", "p_idx"],
        ),
        "direct_channels": (ws.direct_channels.select("*", chat), ["d_idx"]),
        "direct_posts": (ws.direct_posts.select("*", chat), ["d_idx", "p_idx"]),
    }
    for entity, (df, order) in rows.items():
        fields = [part.split(" ")[0] for part in FIELDS[entity].replace(f" {ATTACHMENTS}", "").split(", ")]
        df.orderBy(*order).select(*fields).write.json(f"{root.rstrip('/')}/{entity}")
