"""Attachment manifest and outcome, without moving any file."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatloom.functions.text import is_remote, non_empty, safe_attachment_name
from chatloom.plans.workspace import Workspace

FOLDER = "attachments"


def references(ws: Workspace) -> DataFrame:
    """One row per attachment mention, channel posts before direct posts, in file order."""
    position = ["a", "b", "c", "pos"]
    in_channels = ws.posts.select(
        F.lit(0).alias("phase"),
        F.col("t_idx").alias("a"),
        F.col("c_idx").alias("b"),
        F.col("p_idx").alias("c"),
        F.posexplode("attachments").alias("pos", "att"),
    )
    in_direct = ws.direct_posts.select(
        F.lit(1).alias("phase"),
        F.col("d_idx").alias("a"),
        F.lit(0).cast("bigint").alias("b"),
        F.col("p_idx").alias("c"),
        F.posexplode("attachments").alias("pos", "att"),
    )
    return in_channels.unionByName(in_direct).select("phase", *position, "att.*")


def _key(identity: str, path: Column, url: Column) -> Column:
    return path if identity == "path" else F.coalesce(non_empty(url), path)


def manifest(ws: Workspace, identity: str = "path") -> DataFrame:
    """One row per distinct attachment; the first mention gives name and source.

    ``identity="url"`` keeps files apart that share a path but not an address.
    """
    key = _key(identity, F.col("path"), F.col("url"))
    first = (
        references(ws)
        .groupBy(key.alias("key"))
        .agg(
            F.min_by(F.struct("name", "path", "url"), F.struct("phase", "a", "b", "c", "pos")).alias("att")
        )
    )
    source = F.coalesce(non_empty(F.col("att.url")), F.col("att.path"))
    return first.select(
        F.col("att.name").alias("name"),
        F.col("att.path").alias("path"),
        source.alias("source"),
        is_remote(source).alias("remote"),
        safe_attachment_name(F.col("key")).alias("file_id"),
    )


def outcomes(files: DataFrame, listing: DataFrame) -> DataFrame:
    """Manifest rows with status: found in ``listing(source)`` or failed."""
    found = listing.select("source").distinct().withColumn("_found", F.lit(True))
    return files.join(found, "source", "left").select(
        *files.columns,
        F.when(F.col("_found"), F.lit("success")).otherwise(F.lit("failed")).alias("status"),
    )


def outcome_counts(outcome: DataFrame) -> DataFrame:
    return outcome.groupBy("status").agg(F.count("*").alias("files"))


def list_files(spark, folder: str) -> DataFrame:
    """Paths below ``folder``, relative to it; file contents are not read."""
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder).select("path")
    )
    prefix = folder.rstrip("/") + "/"
    return files.select(F.element_at(F.split("path", F.concat(F.lit(r"\Q"), F.lit(prefix), F.lit(r"\E"))), -1).alias("source"))


def attach(posts: DataFrame, keys: list[str], outcome: DataFrame, identity: str = "path") -> DataFrame:
    """Replace each post's attachment list by its delivered files.

    ``identity`` is the one that the manifest was made with.

    Adds ``files`` (array of file_id and path) and ``file_ids``; both are null when
    nothing was delivered.
    """
    mentions = posts.select(*keys, F.posexplode("attachments").alias("pos", "att")).select(
        *keys, "pos", _key(identity, F.col("att.path"), F.col("att.url")).alias("_key")
    )
    # A file's source is its address, or its path without one: the key by url.
    own = "path" if identity == "path" else "source"
    good = outcome.filter("status = 'success'").select(F.col(own).alias("_key"), "file_id")
    delivered = (
        mentions.join(good, "_key")
        .groupBy(*keys)
        .agg(F.array_sort(F.collect_list(F.struct("pos", "file_id"))).alias("_files"))
    )
    return (
        posts.join(delivered, keys, "left")
        .withColumn(
            "files",
            F.transform(
                "_files",
                lambda f: F.struct(
                    f["file_id"].alias("file_id"),
                    F.concat(F.lit(FOLDER + "/"), f["file_id"]).alias("path"),
                ),
            ),
        )
        .withColumn("file_ids", F.transform("_files", lambda f: f["file_id"]))
        .drop("_files")
    )
