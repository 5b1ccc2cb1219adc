"""Checks on the target's tables after an import."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatloom.functions.text import non_empty

# Fixed value: how the import id sits inside a post's props.
IMPORT_ID = r'"import_id"\s*:\s*"([^"]+)"'
#: A LIKE pattern, so the underscore stands for any one character.
IMPORT_ID_LIKE = '%"import_id"%'


def keep_first_import(posts: DataFrame) -> DataFrame:
    """Drop later copies of an imported post; the earliest by (createat, id) stays.

    Rows without an import id mark stay; rows whose mark cannot be read count as copies
    of one another. The minimum combines before the shuffle, so an id with very many
    copies costs one row per task.
    """
    has_mark = F.coalesce(F.col("props").like(IMPORT_ID_LIKE), F.lit(False))
    marked, rest = posts.filter(has_mark), posts.filter(~has_mark)
    captured = non_empty(F.regexp_extract("props", IMPORT_ID, 1))
    first = marked.groupBy(captured.alias("_import")).agg(
        F.min_by(F.struct(*posts.columns), F.struct("createat", "id")).alias("row")
    )
    return rest.unionByName(first.select("row.*"))


def verify_counts(teams: DataFrame, channels: DataFrame, users: DataFrame, posts: DataFrame) -> DataFrame:
    """Row counts and whether the state is healthy; channels may be empty."""
    tables = {"teams": teams, "channels": channels, "users": users, "posts": posts}
    tags = None
    for name, df in tables.items():
        part = df.select(F.lit(name).alias("entity"))
        tags = part if tags is None else tags.unionByName(part)
    counted = tags.agg(*[F.count_if(F.col("entity") == name).alias(name) for name in tables])
    return counted.withColumn(
        "healthy", (F.col("teams") > 0) & (F.col("users") > 0) & (F.col("posts") > 0)
    )


def import_again(posts: DataFrame) -> DataFrame:
    """The posts table after importing the same payload once more: fresh ids, later times."""
    newest = posts.agg(F.max("id").alias("id"), F.max("createat").alias("createat")).first()
    again = posts.filter(F.col("props").like(IMPORT_ID_LIKE)).select(
        (F.col("id") + (newest.id + 1)).alias("id"),
        (F.col("createat") + 1).alias("createat"),
        "props",
    )
    return posts.unionByName(again)
