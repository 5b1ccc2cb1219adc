"""Collision-free slugs and the raw-name to slug maps."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatloom.functions.text import slugify, stable_alias
from chatloom.operators import stepmaps
from chatloom.operators.sequence import ordinal, position_in_group, running_total
from chatloom.plans.options import JobOptions
from chatloom.plans.staging import stage, stage_counted
from chatloom.plans.workspace import Workspace

# A numbered name: stem, dash, number without leading zeros.
_NUMBERED = r"^(.+)-([1-9][0-9]{0,17})$"
# Rival numbers of one base that are solved in one piece, and rows held by a task at a time.
SPAN = 1 << 17


def unique_slugs(
    df: DataFrame, name: str, position: str, scope: Sequence[str] = (), out: str = "slug"
) -> DataFrame:
    """Give each row, in ``position`` order, the first unused of slug, slug-1, slug-2, …

    A numbered name ``b-k`` can be taken by two bases only: its own, and ``b`` as its
    k-th choice. Once the base ``b-k`` has occurred the name is gone for ``b``. So each
    (b, b-k) pair needs one flag, "``b`` has to skip k", and everything else follows from
    ranks and running counts. Flags are solved over the pairs alone, in rounds whose number
    grows with the logarithm of the nesting (``a-1-1-…``) only; plain repeats without
    numbered rivals need no round at all.
    """
    keys = [*scope, "_base"]
    based = df.withColumn("_base", slugify(F.col(name)))
    rows = ordinal(based, keys, position, "_nth")
    pairs = _rival_pairs(based, keys, scope, position)
    if pairs is None:
        suffix = F.col("_nth") - 1
        return _named(rows, suffix, df.columns, out)
    flags = _solve_skips(pairs, keys, scope)
    # A base whose own name its parent already took starts at suffix 1.
    late = flags.filter(~F.col("_skip")).select(*scope, F.col("_child").alias("_base"), F.lit(1).alias("_shift"))
    shifted = (
        rows.join(late, keys, "left")
        .select(*rows.columns, F.coalesce("_shift", F.lit(0)).alias("_shift"))
        .withColumn("_choice", F.col("_nth") - 1 + F.col("_shift"))
    )
    # The i-th skipped number k pushes every choice from k - (i - 1) on by one.
    skipped = ordinal(flags.filter("_skip"), keys, "_k", "_i")
    pushes = skipped.groupBy(*keys, (F.col("_k") - F.col("_i") + 1).alias("_choice")).agg(
        F.count("*").alias("_push")
    )
    # Pushes sort before the row that makes the same choice.
    both = shifted.withColumn("_push", F.lit(0)).unionByName(pushes, allowMissingColumns=True)
    both = both.withColumn("_row", F.when(F.col("_nth").isNull(), 0).otherwise(1))
    placed = running_total(both, keys, "_choice", F.col("_push"), "_pushed", tie=["_row"])
    placed = placed.filter("_row = 1").select(*rows.columns, "_choice", "_pushed")
    return _named(placed, F.col("_choice") + F.col("_pushed"), df.columns, out)


def _named(rows: DataFrame, suffix: Column, columns: Sequence[str], out: str) -> DataFrame:
    slug = F.when(suffix == 0, F.col("_base")).otherwise(F.concat("_base", F.lit("-"), suffix))
    return rows.select(*columns, slug.alias(out))


def _rival_pairs(
    rows: DataFrame, keys: Sequence[str], scope: Sequence[str], position: str
) -> DataFrame | None:
    """(base, child ``base-k``) pairs that can matter, or None when there are none."""
    bases = rows.groupBy(*keys).agg(F.count("*").alias("_n"), F.min(position).alias("_t"))
    numbered = bases.select(
        *scope,
        F.col("_base").alias("_child"),
        F.col("_t").alias("_child_t"),
        F.regexp_extract("_base", _NUMBERED, 1).alias("_base"),
        F.regexp_extract("_base", _NUMBERED, 2).alias("_digits"),
    ).filter(F.col("_base") != "")
    pairs = numbered.join(bases.drop("_t"), keys).select(
        *keys, "_child", "_child_t", F.col("_digits").cast("bigint").alias("_k"), "_n"
    )
    pairs, count = stage_counted(pairs, "rivals", F.lit(True))
    if count == 0:
        return None
    # A base that occurs once and lost no name itself never goes past its own slug.
    children = pairs.select(*scope, F.col("_child").alias("_base")).withColumn("_is_child", F.lit(True))
    pairs = pairs.join(children, keys, "left")
    pairs = pairs.filter((F.col("_n") > 1) | F.col("_is_child")).drop("_is_child", "_n")
    if pairs.isEmpty():
        return None
    # How often the base occurred before the child's first occurrence.
    marks = pairs.withColumn(position, F.col("_child_t"))
    busy = pairs.select(*keys).distinct()
    seen = rows.join(busy, keys, "left_semi").select(
        *keys, position, F.lit(1).alias("_one")
    )
    merged = seen.unionByName(marks, allowMissingColumns=True)
    counted = running_total(
        merged, keys, position, F.coalesce(F.col("_one"), F.lit(0)), "_before", tie=["_one"]
    )
    return stage(counted.filter(F.col("_child").isNotNull()).drop(position, "_one"), "rivals")


def _solve_skips(pairs: DataFrame, keys: Sequence[str], scope: Sequence[str]) -> DataFrame:
    """The pairs with ``_skip``: whether the base has to skip the child's number.

    With A skipped numbers below k and start shift s, the base reaches choice k at its
    occurrence k - s + 1 - A; it must skip k exactly when the child came before that
    occurrence. The shift is 0 or 1 and comes from the base's own parent, so each pair is
    solved for both, and the chains of parents are followed afterwards by doubling.
    """
    both = _skips_for_both_shifts(pairs, keys)
    # A child's shift is 1 when its parent did not skip it: a map from shift to shift.
    maps = both.select(
        *keys, "_child", (1 - F.col("_skip0")).alias("_m0"), (1 - F.col("_skip1")).alias("_m1")
    )
    parents = maps.select(*scope, F.col("_child").alias("_base"), F.lit(True).alias("_has_parent"))
    rooted = maps.join(parents, keys, "left").withColumn(
        "_m1", F.when(F.col("_has_parent"), F.col("_m1")).otherwise(F.col("_m0"))
    )
    # Maps that are constant need no parent any more.
    is_open = F.col("_m0") != F.col("_m1")
    above = F.when(is_open, F.col("_base"))
    maps, left = stage_counted(
        rooted.select(*scope, "_child", "_m0", "_m1", above.alias("_up")), "shifts", is_open
    )
    while left:
        upper = maps.select(
            *scope,
            F.col("_child").alias("_up"),
            F.col("_m0").alias("_a0"),
            F.col("_m1").alias("_a1"),
            F.col("_up").alias("_next"),
        )
        composed = maps.join(upper, [*scope, "_up"], "left").select(
            *scope,
            "_child",
            F.when(F.col("_a0") == 1, F.col("_m1")).otherwise(F.col("_m0")).alias("_m0"),
            F.when(F.col("_a1") == 0, F.col("_m0")).otherwise(F.col("_m1")).alias("_m1"),
            "_next",
        )
        maps, left = stage_counted(
            composed.withColumn("_up", F.when(is_open, F.col("_next"))).drop("_next"), "shifts", is_open
        )
    solved = maps.select(*scope, "_child", (F.col("_m0") == 0).alias("_skip"))
    return stage(both.select(*keys, "_child", "_k").join(solved, [*scope, "_child"]), "skips")


def _skips_for_both_shifts(pairs: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``_skip0`` and ``_skip1`` of each pair: 1 where the base skips it, for shift 0 and 1.

    In order of k, each pair is a step of the count of skipped numbers. Spans of one base
    are composed to one map each, all at the same time; one fold over the maps of a base
    gives the count before every span, and then all spans are solved at the same time.
    """
    narrow = pairs.select(*keys, "_child", "_k", "_before")
    ranked = position_in_group(narrow, keys, ["_k"], "_rank", label="rivals")
    spans = ranked.withColumn("_span", F.floor(F.col("_rank") / SPAN))
    spans, more = stage_counted(spans, "rivals", F.col("_span") > 0)
    zero = F.lit(0).cast("bigint")
    if more:
        later = spans.filter("_span > 0").select(*keys).distinct()
        long = spans.join(later, list(keys), "left_semi")
        counted = stage(_span_starts(long, keys), "span-starts")
        spans = spans.join(counted, [*keys, "_span"], "left")
        spans = spans.withColumns({c: F.coalesce(c, zero) for c in ("_x0", "_x1")})
    else:
        spans = spans.withColumns({"_x0": zero, "_x1": zero})
    dealt = spans.repartition(*keys, "_span").sortWithinPartitions(*keys, "_span", "_k")
    result = spans.withColumns({"_skip0": zero, "_skip1": zero}).schema
    size = SPAN
    solved = stage(dealt.mapInPandas(lambda frames: _solve_spans(frames, size), result), "skips")
    return solved.select(*keys, "_child", "_k", "_skip0", "_skip1")


def _whole_spans(frames: Iterator[pd.DataFrame], size: int) -> Iterator[pd.DataFrame]:
    """The rows in pieces of about ``size`` that hold whole spans; a span begins at a multiple of it."""
    held: list[pd.DataFrame] = []
    rows = 0
    for frame in frames:
        begins = np.flatnonzero(frame["_rank"].to_numpy() % size == 0)
        if rows >= size and len(begins):
            yield pd.concat([*held, frame.iloc[: begins[-1]]], ignore_index=True)
            held, rows, frame = [], 0, frame.iloc[begins[-1] :]
        held.append(frame)
        rows += len(frame)
    if rows:
        yield pd.concat(held, ignore_index=True)


def _bounds(frame: pd.DataFrame, size: int) -> tuple[np.ndarray, np.ndarray, int]:
    """The step of each pair, where spans begin, and a count that none reaches.

    A base that starts at suffix 1 has all its steps one lower, which is the same as a
    count that is one higher.
    """
    top = int(frame["_rank"].max()) + 3
    wanted = np.clip((frame["_k"] + 1 - frame["_before"]).to_numpy(), 0, top)
    return wanted, np.flatnonzero(frame["_rank"].to_numpy() % size == 0), top


def _solve_spans(frames: Iterator[pd.DataFrame], size: int) -> Iterator[pd.DataFrame]:
    for frame in _whole_spans(frames, size):
        bounds, first, top = _bounds(frame, size)
        skips = {shift: np.zeros(len(frame), np.int64) for shift in (0, 1)}
        for chosen, rows, padded in stepmaps.sequences(bounds, first):
            maps, used = stepmaps.levels(padded, top), rows >= 0
            for shift, skip in skips.items():
                start = frame[f"_x{shift}"].to_numpy()[first[chosen]] + shift
                count = stepmaps.counts_before(maps, start).reshape(rows.shape)
                skip[rows[used]] = (count < padded)[used]
        yield frame.assign(_skip0=skips[0], _skip1=skips[1])


def _span_starts(spans: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, _span, _x0, _x1): the counts before each span of a base."""
    chosen = [*keys, "_span"]
    types = {f.name: f.dataType.simpleString() for f in spans.schema.fields}
    size = SPAN

    def compose(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in _whole_spans(frames, size):
            bounds, first, top = _bounds(frame, size)
            whole = {
                at: maps
                for group, _, padded in stepmaps.sequences(bounds, first)
                for at, maps in zip(group.tolist(), stepmaps.levels(padded, top)[-1], strict=True)
            }
            out = frame.iloc[first][chosen].copy()
            out["_map"] = [whole[i][whole[i] > 0] for i in range(len(first))]
            yield out

    schema = ", ".join(f"`{c}` {types[c]}" for c in chosen)
    dealt = spans.repartition(*chosen).sortWithinPartitions(*chosen, "_k")
    maps = stage(dealt.mapInPandas(compose, f"{schema}, _map array<bigint>"), "span-maps")

    def fold(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts = [0, 1]
        for frame in frames:
            before = []
            for span, thresholds in zip(frame["_span"], frame["_map"], strict=True):
                if span == 0:
                    counts = [0, 1]
                before.append(counts)
                counts = [x + len(thresholds) - int(np.searchsorted(thresholds, x, side="right")) for x in counts]
            out = frame[chosen].copy()
            out["_x0"], out["_x1"] = [b[0] for b in before], [b[1] - 1 for b in before]
            yield out

    # One base's maps pass through one task as a stream, a span at a time.
    ordered = maps.repartition(*keys).sortWithinPartitions(*chosen)
    return ordered.mapInPandas(fold, f"{schema}, _x0 bigint, _x1 bigint")


def user_slugs(ws: Workspace, opts: JobOptions) -> DataFrame:
    """(username, slug): one row per raw username; of repeated names the last row's slug."""
    if opts.anonymize:
        return (
            ws.users.select("username")
            .distinct()
            .withColumn("slug", stable_alias(F.col("username"), opts.salt))
        )
    named = unique_slugs(ws.users.select("u_idx", "username"), "username", "u_idx")
    return named.groupBy("username").agg(F.max_by("slug", "u_idx").alias("slug"))


def team_slugs(ws: Workspace) -> DataFrame:
    """(team_name, team_slug)."""
    named = unique_slugs(ws.teams.select("t_idx", "name"), "name", "t_idx")
    return named.groupBy(F.col("name").alias("team_name")).agg(
        F.max_by("slug", "t_idx").alias("team_slug")
    )


def channel_slugs(ws: Workspace) -> DataFrame:
    """(team_name, channel_name, channel_slug); slugs are unique inside one team entry."""
    named = unique_slugs(
        ws.channels.select("t_idx", "c_idx", "team_name", "name"), "name", "c_idx", ["t_idx"]
    )
    return named.groupBy("team_name", F.col("name").alias("channel_name")).agg(
        F.max_by("slug", F.struct("t_idx", "c_idx")).alias("channel_slug")
    )


def slug_maps(ws: Workspace, opts: JobOptions) -> DataFrame:
    """All three maps in one table: kind, scope, name, slug."""
    none = F.lit(None).cast("string")
    return (
        user_slugs(ws, opts)
        .select(F.lit("user").alias("kind"), none.alias("scope"), F.col("username").alias("name"), "slug")
        .unionByName(
            team_slugs(ws).select(
                F.lit("team").alias("kind"),
                none.alias("scope"),
                F.col("team_name").alias("name"),
                F.col("team_slug").alias("slug"),
            )
        )
        .unionByName(
            channel_slugs(ws).select(
                F.lit("channel").alias("kind"),
                F.col("team_name").alias("scope"),
                F.col("channel_name").alias("name"),
                F.col("channel_slug").alias("slug"),
            )
        )
    )


def resolve_username(
    df: DataFrame, column: str, slugs: DataFrame, opts: JobOptions, out: str
) -> DataFrame:
    """Mapped slug of a raw name; unknown names become an alias or a plain slug."""
    fallback = stable_alias(F.col(column), opts.salt) if opts.anonymize else slugify(F.col(column))
    lookup = slugs.select(F.col("username").alias("_name"), F.col("slug").alias("_slug"))
    return (
        df.join(lookup, F.col(column) == F.col("_name"), "left")
        .withColumn(out, F.coalesce("_slug", fallback))
        .drop("_name", "_slug")
    )
