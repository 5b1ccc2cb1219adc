"""Mixing sources to target weights: Sainte-Laguë quotas of equal blocks, per source and shard.

DataFrame functions only. Sources and shards are small tables; documents are shuffled once,
by shard, without their texts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chatloom.llm.words import WHITE_CLASS, filled, word_count
from chatloom.plans.staging import stage

BLOCK_WORDS = 64
SHARD_WORDS = 1 << 20


def source_targets(sources: DataFrame, weights: Sequence[float], max_epochs: float) -> DataFrame:
    """Add ``weight`` and ``target`` to (source, source_size).

    Sources in order of code points, null last, take the weights in turn and share the
    total by weight. A target stops at ``max_epochs`` times its source's size, and the
    excess goes to the others by weight until none is above. That is one level L with
    target = min(cap, weight * L): capped are the sources with the smallest cap per
    weight, so running sums in that order give L.
    """
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    cap = F.lit(float(max_epochs)) * F.col("source_size")
    turn = F.array(*[F.lit(float(w)) for w in weights])
    weighed = sources.withColumn("weight", F.get(turn, (place - 1) % len(weights))).withColumn("_cap", cap)
    by_ratio = Window.orderBy(F.col("_cap") / F.col("weight"), F.col("source").asc_nulls_last())
    upto, after = by_ratio.rowsBetween(Window.unboundedPreceding, -1), by_ratio.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    # The level if exactly the sources before this one were capped; the true one is the first
    # that leaves this source (and so all later ones) under its cap.
    level = (F.sum("source_size").over(everything) - F.coalesce(F.sum("_cap").over(upto), F.lit(0.0))) / F.sum(
        "weight"
    ).over(after)
    tried = weighed.withColumn("_level", level)
    fits = F.when(F.col("_level") * F.col("weight") <= F.col("_cap"), F.col("_level"))
    common = F.coalesce(F.max(fits).over(everything), F.lit(float("inf")))
    return (
        tried.withColumn("_common", common)
        .withColumn("target", F.least("_cap", F.col("weight") * F.col("_common")))
        .drop("_cap", "_level", "_common")
    )


def sainte_lague(parties: DataFrame, keys: Sequence[str], votes: str, seats: str, most: str, out: str) -> DataFrame:
    """Add ``out``: each party's seats when the highest quotients votes / (2k + 1) win.

    Parties are rows; each group of ``keys`` hands out its own ``seats``, and a party takes
    at most ``most``. With n parties, V votes and N seats, the last quotient lies within
    (1 ± n / 2N) of its ideal, so all but a few seats per party are certain; only the
    seats in doubt, about two per party, become rows and are ranked.
    """
    group = Window.partitionBy(*keys)
    total, n = F.sum(votes).over(group), F.count(F.lit(1)).over(group)
    share = F.when(total > 0, F.col(votes) * F.col(seats) / total).otherwise(0.0)
    slack = n / (2.0 * F.greatest(F.col(seats), F.lit(1)))
    low = F.floor(F.greatest(share * (1 - slack) - 0.5, F.lit(0.0)))
    high = F.ceil(share * (1 + slack) + 0.5)
    numbered = (
        parties.withColumn("_low", F.least(low, F.col(most)).cast("long"))
        .withColumn("_high", F.least(high, F.col(most)).cast("long"))
        .withColumn("_party", F.row_number().over(group.orderBy(F.col(votes).desc(), *_order(parties))))
        .withColumn("_left", F.col(seats) - F.sum("_low").over(group))
    )
    doubtful = numbered.where((F.col("_high") > F.col("_low")) & (F.col(votes) > 0)).select(
        *keys, "_party", "_left", votes, F.explode(F.sequence(F.col("_low"), F.col("_high") - 1)).alias("_k")
    )
    quotient = F.col(votes) / (2 * F.col("_k") + 1)
    won = (
        doubtful.withColumn("_rank", F.row_number().over(group.orderBy(quotient.desc(), "_party", "_k")))
        .where(F.col("_rank") <= F.col("_left"))
        .groupBy(*keys, "_party")
        .agg(F.count(F.lit(1)).alias("_won"))
        .select(*[F.col(k).alias(f"_w_{k}") for k in keys], F.col("_party").alias("_w_party"), "_won")
    )
    same = F.col("_party") == F.col("_w_party")
    for key in keys:
        same = same & F.col(key).eqNullSafe(F.col(f"_w_{key}"))
    return numbered.join(won, same, "left").select(
        *parties.columns, (F.col("_low") + F.coalesce("_won", F.lit(0))).alias(out)
    )


def _order(parties: DataFrame) -> list[Column]:
    return [F.col(c) for c in parties.columns]


def mix(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: Sequence[float] = (5, 2, 1),
    max_epochs: int = 3,
    block_words: int = BLOCK_WORDS,
    shard_words: int = SHARD_WORDS,
    seed: int = 17,
) -> DataFrame:
    """(id, _row, size, source_size, target, taken, epochs, runs) for every row of ``docs``.

    A source's documents are dealt over shards of about ``shard_words`` by a seeded hash
    and stand in seeded order there; a shard is cut into equal blocks of about
    ``block_words``. Blocks are apportioned to sources, then to a source's shards, by
    highest quotients. A shard takes its blocks as whole passes and one seeded cyclic run,
    so nearly all documents are taken whole.

    ``taken`` counts words, repeats included; ``epochs`` the whole passes, and ``runs`` the
    (start, length) in words taken beyond those, two at most. Null texts have size 0 and
    take nothing; a null source is a source of its own, the last one; repeated rows are
    rows like any other; ties stand in order of id and text hash. Sources without words
    have target 0.
    """
    sized = stage(
        docs.select(
            F.col(id_col).alias("_id"),
            F.xxhash64(filled(F.col(text_col))).alias("_row"),
            F.col(source_col).alias("source"),
            word_count(F.col(text_col)).alias("size"),
        ),
        "sizes",
    )
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = source_targets(sources, weights, max_epochs).withColumn(
        "_shards", F.greatest(F.ceil(F.col("source_size") / shard_words), F.lit(1))
    )
    t = stage(targets, "targets")
    hashed = F.xxhash64(F.lit(seed), F.col("_id"), F.col("_row"))
    dealt = (
        sized.join(
            F.broadcast(t.select(F.col("source").alias("_s"), "source_size", "target", "_shards"))
            if t.count() <= 100_000
            else t.select(F.col("source").alias("_s"), "source_size", "target", "_shards"),
            F.col("source").eqNullSafe(F.col("_s")),
        )
        .drop("_s")
        .withColumn("_hash", hashed)
        .withColumn("_shard", F.pmod(F.xxhash64("_hash"), F.col("_shards")))
    )
    shards = stage(
        dealt.groupBy("source", "_shard").agg(
            F.sum("size").alias("_shard_size"),
            F.first("source_size").alias("source_size"),
            F.first("target").alias("target"),
        ),
        "shards",
    ).withColumn("_blocks", F.when(F.col("_shard_size") > 0, F.greatest(F.round(F.col("_shard_size") / block_words), F.lit(1))).otherwise(0).cast("long"))
    houses = shards.groupBy("source").agg(
        F.first("target").alias("target"), (max_epochs * F.sum("_blocks")).alias("_most"), F.sum("_blocks").alias("_own"),
        F.first("source_size").alias("_size"),
    )
    # A source's votes are its target in blocks, which are its own blocks times its epochs.
    houses = houses.withColumn("_votes", F.when(F.col("_size") > 0, F.col("target") * F.col("_own") / F.col("_size")).otherwise(0.0))
    houses = houses.withColumn("_seats", F.round(F.sum("_votes").over(Window.partitionBy())).cast("long"))
    quota = sainte_lague(houses, [], "_votes", "_seats", "_most", "_quota").select(
        F.col("source").alias("_s"), "_quota"
    )
    by_shard = (
        shards.join(quota, F.col("source").eqNullSafe(F.col("_s")))
        .withColumn("_most", max_epochs * F.col("_blocks"))
        .withColumn("_votes", F.col("_blocks").cast("double"))
        .select("source", "_shard", "_shard_size", "_blocks", "_most", "_votes", "_quota")
    )
    given = sainte_lague(by_shard, ["source"], "_votes", "_quota", "_most", "_take")
    picked = given.select(
        F.col("source").alias("_p_source"), F.col("_shard").alias("_p_shard"), "_shard_size", "_blocks", "_take"
    )
    in_shard = Window.partitionBy("source", "_shard").orderBy("_hash", "_id", "_row")
    placed = dealt.withColumn(
        "_from", F.coalesce(F.sum("size").over(in_shard.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ).join(picked, F.col("source").eqNullSafe(F.col("_p_source")) & (F.col("_shard") == F.col("_p_shard")))
    blocks = F.greatest(F.col("_blocks"), F.lit(1))
    epochs = F.floor(F.col("_take") / blocks)
    first = F.pmod(F.xxhash64(F.lit(seed), F.col("source"), F.col("_shard")), blocks)
    start = F.floor(first * F.col("_shard_size") / blocks)
    # Word positions of the run, which may go past the end and on from the beginning.
    stop_block = first + (F.col("_take") - epochs * blocks)
    stop = F.when(
        stop_block <= blocks, F.floor(stop_block * F.col("_shard_size") / blocks)
    ).otherwise(F.col("_shard_size") + F.floor((stop_block - blocks) * F.col("_shard_size") / blocks))

    def overlap(shift: Column) -> Column:
        low = F.greatest(F.col("_from") + shift, F.col("_start"))
        high = F.least(F.col("_from") + F.col("size") + shift, F.col("_stop"))
        return F.struct(
            (low - shift - F.col("_from")).cast("long").alias("start"),
            F.greatest(high - low, F.lit(0)).cast("long").alias("length"),
        )

    runs = F.filter(
        F.array(overlap(F.lit(0)), overlap(F.col("_shard_size"))), lambda run: run["length"] > 0
    )
    return (
        placed.withColumn("epochs", epochs.cast("long"))
        .withColumn("_start", start)
        .withColumn("_stop", stop)
        .withColumn("runs", runs)
        .withColumn(
            "taken",
            F.col("epochs") * F.col("size")
            + F.aggregate("runs", F.lit(0).cast("long"), lambda acc, run: acc + run["length"]),
        )
        .select(F.col("_id").alias(id_col), "_row", "size", "source_size", "target", "taken", "epochs", "runs")
    )


def mixed_documents(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The mix as documents with the columns of ``docs``: a row per pass and one per part.

    A part that is cut from a document has its words joined by single spaces. Documents
    without words have nothing to take and go; a column ``n_chars`` follows the text.
    """
    taken = mix(docs, id_col=id_col, text_col=text_col, **options).select(
        F.col(id_col).alias("_m_id"), F.col("_row").alias("_m_row"), "size", "epochs", "runs", "taken"
    )
    # Exactly repeated rows are told apart by nothing; each gets the fullest share of them.
    once = (
        taken.where(F.col("taken") > 0)
        .groupBy("_m_id", "_m_row")
        .agg(F.max(F.struct("taken", "size", "epochs", "runs")).alias("_m"))
        .select("_m_id", "_m_row", "_m.size", "_m.epochs", "_m.runs")
    )
    keyed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"),
        F.col(id_col).alias("_id"),
        F.col(text_col).alias("_text"),
        F.xxhash64(filled(F.col(text_col))).alias("_key"),
    )
    joined = keyed.join(once, (F.col("_key") == F.col("_m_row")) & F.col("_id").eqNullSafe(F.col("_m_id")))
    whole = F.struct(F.lit(0).cast("long").alias("start"), F.col("size").alias("length"))
    pieces = F.concat(F.array_repeat(whole, F.col("epochs").cast("int")), F.col("runs"))
    spread = joined.select("_doc", "_text", "size", F.explode(pieces).alias("_piece"))
    words = F.filter(F.split("_text", f"[{WHITE_CLASS}]+"), lambda w: w != "")
    part = F.array_join(
        F.slice(words, F.col("_piece.start").cast("int") + 1, F.col("_piece.length").cast("int")), " "
    )
    cut = spread.withColumn("_new", F.when(F.col("_piece.length") == F.col("size"), F.col("_text")).otherwise(part))
    changed = {text_col: F.col("_new")}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.length("_new").cast(docs.schema["n_chars"].dataType)
    return cut.select(*[changed.get(c, F.col(f"_doc.`{c}`")).alias(c) for c in docs.columns])
