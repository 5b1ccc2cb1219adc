"""A workspace from landed pages of a directory-and-chat web API.

``pages(endpoint, parent_id, page, body)`` holds raw response bodies; ``value`` lists are
concatenated over pages. Endpoints: users, groups, owners, members and channels (parent:
group id), messages (parent: channel id), chats, chat_members and chat_messages (parent:
chat id).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatloom.functions.text import iso_to_epoch_ms, non_empty, upn_local_part
from chatloom.plans.workspace import Workspace

_SPAN = 1 << 32
_MESSAGE = (
    "id:string, `from`:struct<user:struct<userPrincipalName:string>>, createdDateTime:string, "
    "body:struct<content:string>, replyToId:string, attachments:array<struct<name:string,contentUrl:string>>"
)
_ITEMS = {
    "users": "userPrincipalName:string, mail:string, displayName:string",
    "groups": "id:string, mailNickname:string, displayName:string, description:string",
    "owners": "userPrincipalName:string",
    "members": "userPrincipalName:string",
    "channels": "id:string, displayName:string, membershipType:string",
    "messages": _MESSAGE,
    "chats": "id:string",
    "chat_members": "userPrincipalName:string, email:string",
    "chat_messages": _MESSAGE,
}


def items(pages: DataFrame, endpoint: str) -> DataFrame:
    """(parent_id, idx, fields…) of one endpoint; idx follows pages, then list order."""
    schema = f"struct<value:array<struct<{_ITEMS[endpoint]}>>>"
    return (
        pages.filter(F.col("endpoint") == endpoint)
        .select("parent_id", "page", F.posexplode(F.from_json("body", schema)["value"]).alias("pos", "item"))
        .select("parent_id", (F.col("page").cast("bigint") * _SPAN + F.col("pos")).alias("idx"), "item.*")
    )


def _or(first: str, second: Column) -> Column:
    return F.coalesce(non_empty(F.col(first)), second)


def _person(df: DataFrame, upn: Column) -> DataFrame:
    """Keep rows with a principal name; add its local part as username."""
    return df.withColumn("_upn", non_empty(upn)).filter(F.col("_upn").isNotNull()).withColumn(
        "username", upn_local_part(F.col("_upn"))
    )


def teams(pages: DataFrame) -> DataFrame:
    name = _or("mailNickname", F.col("id"))
    return items(pages, "groups").select(
        F.col("idx").alias("t_idx"),
        F.col("id").alias("group_id"),
        name.alias("name"),
        _or("displayName", name).alias("display_name"),
        F.coalesce("description", F.lit("")).alias("description"),
    )


def team_people(pages: DataFrame) -> DataFrame:
    groups = teams(pages).select(F.col("group_id").alias("parent_id"), "t_idx", F.col("name").alias("team_name"))
    folk = None
    for endpoint, owner in (("members", False), ("owners", True)):
        part = _person(items(pages, endpoint), F.col("userPrincipalName")).select(
            "parent_id", "username", F.lit(owner).alias("is_owner")
        )
        folk = part if folk is None else folk.unionByName(part)
    return folk.join(groups, "parent_id").select("t_idx", "team_name", "username", "is_owner")


def users(pages: DataFrame) -> DataFrame:
    return _person(items(pages, "users"), F.col("userPrincipalName")).select(
        F.col("idx").alias("u_idx"),
        "username",
        _or("mail", F.col("_upn")).alias("email"),
        _or("displayName", F.col("username")).alias("nickname"),
    )


def user_teams(pages: DataFrame) -> DataFrame:
    """Distinct teams each listed user owns or belongs to."""
    joined = team_people(pages).select("username", "team_name").distinct()
    return users(pages).select("u_idx", "username").join(joined, "username").select(
        "u_idx", "username", "team_name"
    )


def channels(pages: DataFrame) -> DataFrame:
    groups = teams(pages).select(F.col("group_id").alias("parent_id"), "t_idx", F.col("name").alias("team_name"))
    name = _or("displayName", F.col("id"))
    return (
        items(pages, "channels")
        .join(groups, "parent_id")
        .select(
            "t_idx",
            F.col("idx").alias("c_idx"),
            F.col("id").alias("channel_id"),
            "team_name",
            name.alias("name"),
            name.alias("display_name"),
            F.coalesce(F.col("membershipType") == "private", F.lit(False)).alias("is_private"),
        )
    )


def channel_people(pages: DataFrame) -> DataFrame:
    """Every channel takes over the people of its team."""
    chans = channels(pages).select("t_idx", "c_idx", F.col("name").alias("channel_name"))
    return chans.join(team_people(pages), "t_idx").select(
        "t_idx", "c_idx", "team_name", "channel_name", "username", "is_owner"
    )


def _messages(pages: DataFrame, endpoint: str) -> DataFrame:
    df = _person(items(pages, endpoint), F.col("from.user.userPrincipalName"))
    files = F.transform(
        F.coalesce("attachments", F.array().cast("array<struct<name:string,contentUrl:string>>")),
        lambda a: F.struct(
            F.coalesce(non_empty(a["name"]), F.lit("file")).alias("name"),
            F.coalesce(non_empty(a["name"]), F.lit("file")).alias("path"),
            a["contentUrl"].alias("url"),
        ),
    )
    return df.select(
        "parent_id",
        F.col("idx").alias("p_idx"),
        "username",
        F.coalesce(F.col("body.content"), F.lit("")).alias("message"),
        iso_to_epoch_ms(F.col("createdDateTime")).alias("timestamp_ms"),
        "id",
        F.col("replyToId").alias("reply_to"),
        files.alias("attachments"),
    )


def posts(pages: DataFrame) -> DataFrame:
    chans = channels(pages).select(
        F.col("channel_id").alias("parent_id"), "t_idx", "c_idx", "team_name", F.col("name").alias("channel_name")
    )
    return (
        _messages(pages, "messages")
        .join(chans, "parent_id")
        .select(
            "t_idx", "c_idx", "p_idx", "team_name", "channel_name", "username", "message",
            "timestamp_ms", "id", F.col("reply_to").alias("parent_id"), "attachments",
        )
    )


def _chats(pages: DataFrame) -> DataFrame:
    """(parent_id, d_idx, members) of chats with at least two members."""
    folk = _person(
        items(pages, "chat_members"), F.coalesce(non_empty(F.col("userPrincipalName")), F.col("email"))
    )
    members = folk.groupBy("parent_id").agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct("idx", "username"))), lambda m: m["username"]
        ).alias("members")
    )
    return (
        items(pages, "chats")
        .select(F.col("id").alias("parent_id"), F.col("idx").alias("d_idx"))
        .join(members.filter(F.size("members") >= 2), "parent_id")
    )


def direct_channels(pages: DataFrame) -> DataFrame:
    return _chats(pages).select("d_idx", "members")


def direct_posts(pages: DataFrame) -> DataFrame:
    """Chat messages; they carry no parent."""
    return (
        _messages(pages, "chat_messages")
        .join(_chats(pages).select("parent_id", "d_idx"), "parent_id")
        .select("d_idx", "p_idx", "username", "message", "timestamp_ms", "id", "attachments")
    )


def workspace(pages: DataFrame) -> Workspace:
    return Workspace(
        users=users(pages),
        user_teams=user_teams(pages),
        teams=teams(pages).drop("group_id"),
        team_people=team_people(pages),
        channels=channels(pages).drop("channel_id"),
        channel_people=channel_people(pages),
        posts=posts(pages),
        direct_channels=direct_channels(pages),
        direct_posts=direct_posts(pages),
    )
