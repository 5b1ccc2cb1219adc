"""Reply threads: roots by pointer doubling, order inside a channel, root references.

Everything is keyed by (team, channel, post key), so a busy channel or a huge thread
spreads over all tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatloom.functions.hashing import hmac_hex
from chatloom.functions.text import non_empty
from chatloom.plans.options import JobOptions
from chatloom.plans.staging import stage, stage_counted

# Prefixes of derived ids.
SOURCE_KEY_PREFIX = "source-post-"
IMPORT_ID_PREFIX = "post-"

SCOPE = ["t_idx", "c_idx"]


def with_source_key(posts: DataFrame, opts: JobOptions) -> DataFrame:
    """Add ``source_key``: the post's own id, or a keyed hash of what it says and where."""
    payload = F.concat_ws(
        "|",
        "team_name",
        "channel_name",
        F.col("p_idx").cast("string"),
        F.col("timestamp_ms").cast("string"),
        "username",
        "message",
    )
    return posts.withColumn(
        "source_key",
        F.coalesce(
            non_empty(F.col("id")), F.concat(F.lit(SOURCE_KEY_PREFIX), hmac_hex(payload, opts.salt))
        ),
    )


def import_id(team_slug, channel_slug, source_key, opts: JobOptions):
    payload = F.concat_ws("|", team_slug, channel_slug, source_key)
    return F.concat(F.lit(IMPORT_ID_PREFIX), hmac_hex(payload, opts.salt))


def reply_links(keyed: DataFrame) -> DataFrame:
    """(scope, source_key, parent): one row per replying key; the last reply's parent wins."""
    return (
        keyed.filter(non_empty(F.col("parent_id")).isNotNull())
        .groupBy(*SCOPE, "source_key")
        .agg(F.max_by("parent_id", "p_idx").alias("parent"))
    )


# Hops per staged round: three joins against one table quadruple the distance covered.
HOPS = 3


def _follow(pointers: DataFrame, jumps: DataFrame, hops: int = HOPS) -> DataFrame:
    """Move each pointer on to where its target points, ``hops`` times; ``live`` while it moved."""
    onward = jumps.select(*SCOPE, F.col("source_key").alias("ptr"), F.col("ptr").alias("_next"))
    for _ in range(hops):
        pointers = pointers.join(onward, [*SCOPE, "ptr"], "left").select(
            *SCOPE,
            "source_key",
            F.coalesce("_next", "ptr").alias("ptr"),
            F.col("_next").isNotNull().alias("live"),
        )
    return pointers


def _chase(links: DataFrame, label: str) -> tuple[DataFrame, DataFrame | None]:
    """Move pointers until they rest. Returns (settled, live): live ones never rest.

    An endless pointer leads into a circle. As long as finite chains are left, every
    round settles some key, because all shorter distances occur on a chain too. A round
    that settles nothing therefore leaves only endless pointers.
    """
    settled: DataFrame | None = None
    jumps = live = links.select(*SCOPE, "source_key", F.col("parent").alias("ptr"))
    left = None
    while True:
        step, moving = stage_counted(_follow(live, jumps), label, F.col("live"))
        done = step.filter("not live").select(*SCOPE, "source_key", "ptr")
        settled = done if settled is None else settled.unionByName(done)
        live = step.filter("live").select(*SCOPE, "source_key", "ptr")
        if moving == 0:
            return settled, None
        if moving == left:
            return settled, live
        left = moving
        # Settled pointers stay in the jump table: others still pass through them.
        jumps = settled.unionByName(live)


def _circle_keys(endless: DataFrame) -> DataFrame:
    """Keys on a circle: move endless pointers until their targets stop getting fewer."""
    before = None
    while True:
        targets, count = stage_counted(
            endless.select(*SCOPE, F.col("ptr").alias("source_key")).distinct(), "circles", F.lit(True)
        )
        if count == before:
            return targets
        before = count
        endless = stage(_follow(endless, endless), "circles").select(*SCOPE, "source_key", "ptr")


def thread_roots(links: DataFrame) -> DataFrame:
    """(scope, source_key, root) for every replying key.

    The root is the end of the parent chain: a post without parent, or the missing
    parent's key. In a circle, the walk stops before the first key it would repeat:
    the key whose parent is the point where the walk entered the circle.
    """
    links = stage(links, "links")
    plain = links.filter(F.col("parent") != F.col("source_key"))
    selfish = links.filter(F.col("parent") == F.col("source_key")).select(
        *SCOPE, "source_key", F.col("source_key").alias("root")
    )
    settled, endless = _chase(plain, "threads")
    roots = settled.select(*SCOPE, "source_key", F.col("ptr").alias("root")).unionByName(selfish)
    if endless is None:
        return roots
    on_circle = _circle_keys(endless)
    circle_links = plain.join(on_circle, [*SCOPE, "source_key"], "left_semi")
    before = circle_links.select(*SCOPE, F.col("parent").alias("entry"), F.col("source_key").alias("root"))
    entries = on_circle.withColumn("entry", F.col("source_key"))
    # Tails end where they meet the circle: without the circle's own links they are finite.
    lost = endless.select(*SCOPE, "source_key").join(on_circle, [*SCOPE, "source_key"], "left_anti")
    tails, count = stage_counted(plain.join(lost, [*SCOPE, "source_key"], "left_semi"), "tails", F.lit(True))
    if count:
        reached, _ = _chase(tails, "tails")
        entries = entries.unionByName(reached.select(*SCOPE, "source_key", F.col("ptr").alias("entry")))
    return roots.unionByName(entries.join(before, [*SCOPE, "entry"]).select(*SCOPE, "source_key", "root"))


def with_threads(posts: DataFrame, opts: JobOptions) -> DataFrame:
    """Add source_key, root_key, root_exists and root_ts to posts.

    ``root_ts`` is the root's time when the root is present and its own root, else the
    post's own time; together with root_key it orders whole threads.
    """
    keyed = with_source_key(posts, opts)
    slim = keyed.select(*SCOPE, "p_idx", "source_key", "parent_id", "timestamp_ms")
    slim = stage(slim, "keys")
    links = reply_links(slim)
    roots = thread_roots(links)
    # One row per key: when it was last posted, and whether it heads its own thread.
    heads = (
        slim.groupBy(*SCOPE, "source_key")
        .agg(F.max_by("timestamp_ms", "p_idx").alias("_ts"))
        .join(roots, [*SCOPE, "source_key"], "left")
        .withColumn("root_key", F.coalesce("root", "source_key"))
        .select(*SCOPE, "source_key", "root_key", "_ts")
    )
    heads = stage(heads, "heads")
    targets = heads.select(
        *SCOPE,
        F.col("source_key").alias("root_key"),
        F.when(F.col("source_key") == F.col("root_key"), F.col("_ts")).alias("_root_ts"),
        F.lit(True).alias("_found"),
    )
    resolved = heads.drop("_ts").join(targets, [*SCOPE, "root_key"], "left")
    return (
        keyed.join(resolved, [*SCOPE, "source_key"])
        .withColumn("root_exists", F.coalesce("_found", F.lit(False)))
        .withColumn("root_ts", F.coalesce("_root_ts", "timestamp_ms"))
        .drop("_found", "_root_ts")
    )


# Sort columns that give the emission order inside all channels.
def thread_sort_columns():
    return [
        F.col("t_idx"),
        F.col("c_idx"),
        F.col("root_ts"),
        F.col("root_key"),
        (F.col("source_key") != F.col("root_key")).cast("int"),
        F.col("timestamp_ms"),
        F.col("p_idx"),
    ]


def orphan_replies(threaded: DataFrame) -> DataFrame:
    """Replies whose root is missing or is the reply itself."""
    return threaded.filter(
        non_empty(F.col("parent_id")).isNotNull()
        & (~F.col("root_exists") | (F.col("root_key") == F.col("source_key")))
    ).select("team_name", "channel_name", F.col("id").alias("post_id"), "parent_id", "p_idx")
