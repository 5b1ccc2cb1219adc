"""The workspace: flat entity tables that every operator reads.

Member and owner lists are relations, one row per person, so a team that holds a
third of all users is many rows rather than one giant array. Index columns carry
the source order and must be unique ascending integers within their parent.
"""

from __future__ import annotations

from dataclasses import dataclass, fields

from pyspark.sql import DataFrame

from chatloom.plans.staging import stage, together

ATTACHMENTS = "array<struct<name:string,path:string,url:string>>"

SCHEMAS: dict[str, str] = {
    "users": "u_idx bigint, username string, email string, nickname string",
    "user_teams": "u_idx bigint, username string, team_name string",
    "teams": "t_idx bigint, name string, display_name string, description string",
    "team_people": "t_idx bigint, team_name string, username string, is_owner boolean",
    "channels": "t_idx bigint, c_idx bigint, team_name string, name string, "
    "display_name string, is_private boolean",
    "channel_people": "t_idx bigint, c_idx bigint, team_name string, channel_name string, "
    "username string, is_owner boolean",
    "posts": "t_idx bigint, c_idx bigint, p_idx bigint, team_name string, channel_name string, "
    "username string, message string, timestamp_ms bigint, id string, parent_id string, "
    f"attachments {ATTACHMENTS}",
    "direct_channels": "d_idx bigint, members array<string>",
    "direct_posts": "d_idx bigint, p_idx bigint, username string, message string, "
    f"timestamp_ms bigint, id string, attachments {ATTACHMENTS}",
}


@dataclass(frozen=True)
class Workspace:
    """Entity tables of one export; columns as in ``SCHEMAS``."""

    users: DataFrame
    user_teams: DataFrame
    teams: DataFrame
    team_people: DataFrame
    channels: DataFrame
    channel_people: DataFrame
    posts: DataFrame
    direct_channels: DataFrame
    direct_posts: DataFrame


def staged(ws: Workspace) -> Workspace:
    """The workspace written once as flat Parquet tables.

    Checks, naming and rendering read every table several times; a staged table costs
    each of them a pruned column scan instead of the source's parsing and joins.
    """
    names = [f.name for f in fields(Workspace)]
    tables = together(*[lambda name=name: stage(getattr(ws, name), name) for name in names])
    return Workspace(**dict(zip(names, tables, strict=True)))
