"""Continue an interrupted payload: what is left, and the state a finished part implies.

The default compares record ids. The time-based form follows the recorded state
(finished scopes, last time per channel, ids at that time) and is there for payloads
that were cut by that rule; late replies can make it skip posts never written.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatloom.functions.text import member_key
from chatloom.operators.render import ORDER


def record_key() -> Column:
    """Identity of a record inside its type."""
    return F.coalesce(
        F.col("team.name"),
        F.when(F.col("channel").isNotNull(), F.concat_ws("/", "channel.team", "channel.name")),
        F.col("user.username"),
        F.col("post.id"),
        member_key(F.col("direct_channel.members")),
        F.col("direct_post.id"),
        F.lit("version"),
    )


def scope_key() -> Column:
    """Channel of a post, member key of a direct post; null for other records."""
    return F.coalesce(
        F.when(F.col("post").isNotNull(), F.concat_ws("/", "post.team", "post.channel")),
        member_key(F.col("direct_post.channel_members")),
    )


def record_keys(records: DataFrame) -> DataFrame:
    return records.select("type", record_key().alias("key"))


def remaining(records: DataFrame, written: DataFrame | None) -> DataFrame:
    """Records not yet in ``written``; everything when nothing was written."""
    if written is None or written.isEmpty():
        return records
    done = record_keys(written).distinct()
    return (
        records.filter(F.col("type") != "version")
        .withColumn("key", record_key())
        .join(done, ["type", "key"], "left_anti")
        .drop("key")
    )


def _posts(records: DataFrame) -> DataFrame:
    return records.filter(F.col("type").isin("post", "direct_post")).select(
        *ORDER,
        "type",
        scope_key().alias("scope"),
        F.coalesce("post.create_at", "direct_post.create_at").alias("create_at"),
        F.coalesce("post.id", "direct_post.id").alias("id"),
    )


def resume_state(records: DataFrame) -> DataFrame:
    """(type, scope, last_ts, id): per channel its latest time and each id at that time.

    Ties are rows, not a set, so a channel whose posts all share one time stays spread.
    """
    posts = _posts(records).select("type", "scope", "create_at", "id")
    latest = posts.groupBy("type", "scope").agg(F.max("create_at").alias("create_at"))
    return (
        posts.join(latest, ["type", "scope", "create_at"], "left_semi")
        .distinct()
        .select("type", "scope", F.col("create_at").alias("last_ts"), "id")
    )


def merged_state(state: DataFrame, batch: DataFrame) -> DataFrame:
    """The state after a further batch of records, from the state before it alone."""
    both = state.unionByName(resume_state(batch))
    latest = both.groupBy("type", "scope").agg(F.max("last_ts").alias("last_ts"))
    return both.join(latest, ["type", "scope", "last_ts"], "left_semi").distinct()


def finished_scopes(records: DataFrame, ended: bool = False) -> DataFrame:
    """(type, scope) of channels the writer has left behind.

    While running, the channel written last is still open, unless posts of another
    channel came between its own.
    """
    place = F.struct(*ORDER)
    spans = (
        _posts(records)
        .groupBy("type", "scope")
        .agg(F.min(place).alias("first"), F.max(place).alias("last"))
    )
    if ended:
        return spans.select("type", "scope")
    # Per type: the open channel (latest span) and the end of the one before it.
    newest = spans.groupBy("type").agg(F.max_by("scope", "last").alias("open"))
    runner_up = (
        spans.join(newest, "type")
        .filter(F.col("scope") != F.col("open"))
        .groupBy("type")
        .agg(F.max("last").alias("other"))
    )
    return (
        spans.join(newest, "type")
        .join(runner_up, "type", "left")
        .filter((F.col("scope") != F.col("open")) | (F.col("first") < F.col("other")))
        .select("type", "scope")
    )


def remaining_by_state(
    records: DataFrame, written: DataFrame, state: DataFrame, finished: DataFrame
) -> DataFrame:
    """Records the recorded state lets through."""
    others = remaining(records.filter(~F.col("type").isin("post", "direct_post")), written)
    posts = records.filter(F.col("type").isin("post", "direct_post")).withColumns(
        {
            "scope": scope_key(),
            "_ts": F.coalesce("post.create_at", "direct_post.create_at"),
            "_id": F.coalesce("post.id", "direct_post.id"),
        }
    )
    latest = state.groupBy("type", "scope").agg(F.max("last_ts").alias("last_ts"))
    ties = state.select("type", "scope", F.col("last_ts").alias("_ts"), F.col("id").alias("_id"))
    left = (
        posts.join(finished, ["type", "scope"], "left_anti")
        .join(latest, ["type", "scope"], "left")
        .filter(F.col("_ts") >= F.coalesce("last_ts", F.lit(0)))
        .join(ties, ["type", "scope", "_ts", "_id"], "left_anti")
        .select(*records.columns)
    )
    return others.unionByName(left)


def record_stats(records: DataFrame) -> DataFrame:
    return records.groupBy("type").agg(F.count("*").alias("records"))
