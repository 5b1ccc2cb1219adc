"""Import records: one function per record type, then their ordered union.

Struct fields are declared in alphabetical order, the key order of the JSON lines.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatloom.functions.hashing import hmac_hex
from chatloom.functions.jsonline import json_text
from chatloom.functions.text import (
    ANONYMOUS_DOMAIN,
    BLOCKED_TEXT,
    has_block_word,
    member_key,
    non_empty,
    normalize_email,
    redact,
    redact_or_scrub,
)
from chatloom.operators import attachments as att
from chatloom.operators import membership, naming, threads
from chatloom.operators.sequence import position_in_group
from chatloom.operators.usernames import redact_usernames
from chatloom.plans.options import JobOptions
from chatloom.plans.staging import stage, together
from chatloom.plans.workspace import Workspace

# Texts and codes of the target format.
HEADER_PREFIX = "Migrated from Teams: "
ANONYMOUS_NICKNAME = "Anonymized User"
DIRECT_POST_PREFIX = "direct-post-"
FORMAT_VERSION = 1
_FILES = "array<struct<file_id:string,path:string>>"
_ROLES = "name:string,roles:array<string>"
#: Types of the records as they are read back from JSON lines.
RECORD_SCHEMA = (
    "version int, "
    "team struct<description:string,display_name:string,name:string,type:string>, "
    "channel struct<display_name:string,header:string,name:string,team:string,type:string>, "
    "user struct<auth_data:string,auth_service:string,email:string,nickname:string,"
    f"teams:array<struct<channels:array<struct<{_ROLES}>>,{_ROLES}>>,username:string>, "
    f"post struct<attachments:{_FILES},channel:string,create_at:bigint,file_ids:array<string>,id:string,"
    "import_id:string,message:string,root_id:string,team:string,user:string>, "
    "direct_channel struct<members:array<string>>, "
    f"direct_post struct<attachments:{_FILES},channel_members:array<string>,create_at:bigint,"
    "file_ids:array<string>,id:string,import_id:string,message:string,user:string>"
)
RECORD_TYPES = ("version", "team", "channel", "user", "post", "direct_channel", "direct_post")


@dataclass(frozen=True)
class SlugMaps:
    users: DataFrame
    teams: DataFrame
    channels: DataFrame


def build_maps(ws: Workspace, opts: JobOptions) -> SlugMaps:
    """Slug maps, staged: every record type joins them."""
    users, teams, channels = together(
        lambda: stage(naming.user_slugs(ws, opts), "user-slugs"),
        lambda: stage(naming.team_slugs(ws), "team-slugs"),
        lambda: stage(naming.channel_slugs(ws), "channel-slugs"),
    )
    return SlugMaps(users, teams, channels)


def render_teams(ws: Workspace, maps: SlugMaps) -> DataFrame:
    return ws.teams.join(maps.teams, F.col("name") == F.col("team_name")).select(
        "t_idx",
        F.col("team_slug").alias("name"),
        "display_name",
        "description",
        F.lit("O").alias("type"),
    )


def render_channels(ws: Workspace, maps: SlugMaps) -> DataFrame:
    return (
        ws.channels.withColumnRenamed("name", "channel_name")
        .join(maps.teams, "team_name")
        .join(maps.channels, ["team_name", "channel_name"])
        .select(
            "t_idx",
            "c_idx",
            F.col("team_slug").alias("team"),
            F.col("channel_slug").alias("name"),
            "display_name",
            F.concat(F.lit(HEADER_PREFIX), "display_name").alias("header"),
            F.when(F.col("is_private"), F.lit("P")).otherwise(F.lit("O")).alias("type"),
        )
    )


def with_auth(df: DataFrame, opts: JobOptions) -> DataFrame:
    """Add auth_service and auth_data (null without a service); never a password."""
    if not opts.auth_service:
        none = F.lit(None).cast("string")
        return df.withColumn("auth_service", none).withColumn("auth_data", none)
    if opts.auth_data_field == "email":
        masked = opts.anonymize and opts.mask_auth_data
        data = F.col("email") if masked else F.col("raw_email")
    else:
        data = F.col("username")
    return df.withColumn("auth_service", F.lit(opts.auth_service)).withColumn("auth_data", data)


def identities(ws: Workspace, maps: SlugMaps, opts: JobOptions) -> DataFrame:
    """User rows with resolved username, email and nickname, before memberships."""
    df = ws.users.withColumnsRenamed({"username": "raw_username", "email": "raw_email", "nickname": "raw_nickname"})
    df = naming.resolve_username(df, "raw_username", maps.users, opts, "username")
    if opts.anonymize:
        email = F.concat("username", F.lit("@" + ANONYMOUS_DOMAIN))
        nickname = F.lit(ANONYMOUS_NICKNAME)
    else:
        email = normalize_email(F.col("raw_email"))
        nickname = F.col("raw_nickname")
    df = df.withColumn("email", email).withColumn("nickname", nickname)
    return with_auth(df, opts).drop("raw_email", "raw_nickname")


def render_users(ws: Workspace, maps: SlugMaps, opts: JobOptions) -> DataFrame:
    member = membership.memberships(ws, maps.teams, maps.channels).withColumnRenamed("username", "raw_username")
    kind = member.schema["teams"].dataType
    return (
        identities(ws, maps, opts)
        .join(member, "raw_username", "left")
        .select(
            "u_idx",
            "username",
            "email",
            "nickname",
            "auth_service",
            "auth_data",
            F.coalesce("teams", F.array().cast(kind)).alias("teams"),
        )
    )


def anonymize(
    df: DataFrame, key: str, column: str, users: DataFrame | None, opts: JobOptions
) -> DataFrame:
    """Block words, pattern rules, then usernames; blocked and empty texts stay as they are.

    A blocked text is final: its marker goes through no further rule. The cleaned texts
    are staged, as matching and rewriting names would otherwise clean them twice.
    """
    if users is None:
        return df.withColumn(column, redact_or_scrub(F.col(column)))
    blocked = has_block_word(F.col(column))
    # Text is kept once: either open to names or final.
    cleaned = df.withColumns(
        {column: F.when(blocked, F.lit(BLOCKED_TEXT)), "_open": F.when(~blocked, redact(F.col(column)))}
    )
    named = redact_usernames(stage(cleaned, "cleaned"), key, "_open", users, opts.salt)
    return named.withColumn(column, F.coalesce("_open", column)).select(*df.columns)


def clean_messages(posts: DataFrame, keys: list[str], ws: Workspace, opts: JobOptions) -> DataFrame:
    """(keys, clean): anonymised messages of posts, staged for the join with the rest."""
    texts = posts.select(*keys, F.struct(*keys).alias("_row"), F.col("message").alias("clean"))
    return stage(anonymize(texts, "_row", "clean", ws.users, opts).drop("_row"), "messages")


POST_KEYS = ["t_idx", "c_idx", "p_idx"]
DIRECT_KEYS = ["d_idx", "p_idx"]


def _with_clean(posts: DataFrame, keys: list[str], clean: DataFrame) -> DataFrame:
    return posts.drop("message").join(clean, keys).withColumnRenamed("clean", "message")


def render_posts(
    ws: Workspace,
    maps: SlugMaps,
    opts: JobOptions,
    outcome: DataFrame | None = None,
    threaded: DataFrame | None = None,
    clean: DataFrame | None = None,
) -> DataFrame:
    """Channel posts with their thread order columns and, for replies, the root's id."""
    posts = threaded if threaded is not None else threads.with_threads(ws.posts, opts)
    posts = posts.join(maps.teams, "team_name").join(maps.channels, ["team_name", "channel_name"])
    own_id = threads.import_id(F.col("team_slug"), F.col("channel_slug"), F.col("source_key"), opts)
    root_id = threads.import_id(F.col("team_slug"), F.col("channel_slug"), F.col("root_key"), opts)
    is_reply = non_empty(F.col("parent_id")).isNotNull()
    posts = posts.withColumn("id", own_id).withColumn(
        "root_id",
        F.when(
            is_reply & F.col("root_exists") & (F.col("root_key") != F.col("source_key")), root_id
        ),
    )
    posts = naming.resolve_username(posts, "username", maps.users, opts, "user")
    posts = _deliver(posts, POST_KEYS, outcome)
    if opts.anonymize:
        clean = clean if clean is not None else clean_messages(ws.posts, POST_KEYS, ws, opts)
        posts = _with_clean(posts, POST_KEYS, clean)
    return posts.select(
        "t_idx",
        "c_idx",
        "p_idx",
        "root_ts",
        "root_key",
        "source_key",
        "id",
        F.col("id").alias("import_id"),
        F.col("team_slug").alias("team"),
        F.col("channel_slug").alias("channel"),
        "user",
        "message",
        F.col("timestamp_ms").alias("create_at"),
        "root_id",
        F.col("files").alias("attachments"),
        "file_ids",
    )


FILES = "array<struct<file_id:string,path:string>>"


def _deliver(posts: DataFrame, keys: list[str], outcome: DataFrame | None) -> DataFrame:
    if outcome is None:
        return posts.withColumn("files", F.lit(None).cast(FILES)).withColumn(
            "file_ids", F.lit(None).cast("array<string>")
        )
    return att.attach(posts, keys, outcome)


def resolved_members(ws: Workspace, maps: SlugMaps, opts: JobOptions) -> DataFrame:
    """(d_idx, members): resolved usernames in their source order."""
    each = ws.direct_channels.select("d_idx", F.posexplode_outer("members").alias("pos", "name"))
    each = naming.resolve_username(each, "name", maps.users, opts, "member")
    entry = F.when(F.col("pos").isNotNull(), F.struct("pos", "member"))
    return each.groupBy("d_idx").agg(
        F.transform(F.array_sort(F.collect_list(entry)), lambda m: m["member"]).alias("members")
    )


def render_direct_channels(ws: Workspace, maps: SlugMaps, opts: JobOptions) -> DataFrame:
    return resolved_members(ws, maps, opts)


def with_direct_id(ws: Workspace, opts: JobOptions) -> DataFrame:
    """Direct posts with their time-sorted index and keyed id."""
    slim = ws.direct_posts.select("d_idx", "p_idx", "timestamp_ms")
    ranked = position_in_group(slim, ["d_idx"], ["timestamp_ms", "p_idx"], "index", label="direct")
    people = ws.direct_channels.select("d_idx", member_key(F.col("members")).alias("_people"))
    payload = F.concat_ws(
        "|",
        "_people",
        F.col("index").cast("string"),
        F.col("timestamp_ms").cast("string"),
        "username",
        "message",
    )
    return (
        ws.direct_posts.drop("timestamp_ms")
        .join(ranked, ["d_idx", "p_idx"])
        .join(people, "d_idx")
        .withColumn("id", F.concat(F.lit(DIRECT_POST_PREFIX), hmac_hex(payload, opts.salt)))
        .drop("_people")
    )


def render_direct_posts(
    ws: Workspace,
    maps: SlugMaps,
    opts: JobOptions,
    outcome: DataFrame | None = None,
    indexed: DataFrame | None = None,
    clean: DataFrame | None = None,
) -> DataFrame:
    posts = indexed if indexed is not None else with_direct_id(ws, opts)
    posts = naming.resolve_username(posts, "username", maps.users, opts, "user")
    posts = posts.join(
        resolved_members(ws, maps, opts).withColumnRenamed("members", "channel_members"), "d_idx"
    )
    posts = _deliver(posts, DIRECT_KEYS, outcome)
    if opts.anonymize:
        clean = clean if clean is not None else clean_messages(ws.direct_posts, DIRECT_KEYS, ws, opts)
        posts = _with_clean(posts, DIRECT_KEYS, clean)
    return posts.select(
        "d_idx",
        "p_idx",
        "index",
        "id",
        F.col("id").alias("import_id"),
        "channel_members",
        "user",
        "message",
        F.col("timestamp_ms").alias("create_at"),
        F.col("files").alias("attachments"),
        "file_ids",
    )


ORDER = ["k_type", "k1", "k2", "k3", "k4", "k5", "k6", "k7"]


def _record(df: DataFrame, kind: str, fields: list[str], order: list[Column]) -> DataFrame:
    """(order columns, type, body); body is the typed struct, keys in alphabetical order."""
    shape = [F.lit(RECORD_TYPES.index(kind)).alias("k_type")]
    kinds = ["bigint", "bigint", "bigint", "string", "int", "bigint", "bigint"]
    for i, cast in enumerate(kinds):
        part = order[i] if i < len(order) else F.lit(None)
        shape.append(part.cast(cast).alias(f"k{i + 1}"))
    return df.select(*shape, F.lit(kind).alias("type"), F.struct(*sorted(fields)).alias(kind))


def all_records(
    ws: Workspace, opts: JobOptions, outcome: DataFrame | None = None, maps: SlugMaps | None = None
) -> DataFrame:
    """Every record: order columns, ``type`` and one nullable struct per type."""
    builds = [
        lambda: maps or build_maps(ws, opts),
        lambda: threads.with_threads(ws.posts, opts),
        lambda: with_direct_id(ws, opts),
    ]
    if opts.anonymize:
        builds.append(lambda: clean_messages(ws.posts, POST_KEYS, ws, opts))
        builds.append(lambda: clean_messages(ws.direct_posts, DIRECT_KEYS, ws, opts))
    found, threaded, indexed, *cleaned = together(*builds)
    maps = found
    clean, clean_direct = cleaned or (None, None)
    none = F.lit(None)
    version = (
        ws.teams.sparkSession.range(1)
        .select(F.lit(0).alias("k_type"), F.lit("version").alias("type"), F.lit(FORMAT_VERSION).alias("version"))
    )
    post_order = [
        F.col("t_idx"),
        F.col("c_idx"),
        F.col("root_ts"),
        F.col("root_key"),
        (F.col("source_key") != F.col("root_key")).cast("int"),
        F.col("create_at"),
        F.col("p_idx"),
    ]
    user_fields = ["username", "email", "nickname", "teams", "auth_service", "auth_data"]
    post_fields = [
        "id", "import_id", "team", "channel", "user", "message", "create_at", "root_id",
        "attachments", "file_ids",
    ]
    direct_fields = [
        "id", "import_id", "channel_members", "user", "message", "create_at", "attachments", "file_ids",
    ]
    parts = [
        _record(render_teams(ws, maps), "team", ["name", "display_name", "description", "type"], [F.col("t_idx")]),
        _record(
            render_channels(ws, maps),
            "channel",
            ["team", "name", "display_name", "header", "type"],
            [F.col("t_idx"), F.col("c_idx")],
        ),
        _record(render_users(ws, maps, opts), "user", user_fields, [F.col("u_idx")]),
        _record(render_posts(ws, maps, opts, outcome, threaded, clean), "post", post_fields, post_order),
        _record(
            render_direct_channels(ws, maps, opts), "direct_channel", ["members"], [F.col("d_idx")]
        ),
        _record(
            render_direct_posts(ws, maps, opts, outcome, indexed, clean_direct),
            "direct_post",
            direct_fields,
            [F.col("d_idx"), F.col("index"), none],
        ),
    ]
    result = version
    for part in parts:
        result = result.unionByName(part, allowMissingColumns=True)
    return result.select(*ORDER, "type", *RECORD_TYPES)


def json_lines(records: DataFrame) -> DataFrame:
    """Order columns, type and ``line``, the record as one JSON object."""
    fields = {f.name: f.dataType for f in records.schema.fields}
    body = F.coalesce(
        *[
            F.concat(F.lit(f'{{"{kind}": '), json_text(F.col(kind), fields[kind]), F.lit(f', "type": "{kind}"}}'))
            for kind in RECORD_TYPES
            if kind < "type"
        ],
        *[
            F.concat(F.lit(f'{{"type": "{kind}", "{kind}": '), json_text(F.col(kind), fields[kind]), F.lit("}"))
            for kind in RECORD_TYPES
            if kind > "type"
        ],
    )
    return records.select(*ORDER, "type", body.alias("line"))
