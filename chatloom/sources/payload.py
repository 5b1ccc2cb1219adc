"""Write the ordered payload as JSON lines, whole or in size-bounded parts; read it back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from chatloom.operators.render import ORDER, json_lines
from chatloom.operators.sequence import global_index, running_total
from chatloom.plans.staging import stage, stage_counted

VERSION_LINE = '{"type": "version", "version": 1}'  # fixed value: heads every part
MEGABYTE = 1 << 20


def write_payload(records: DataFrame, path: str) -> None:
    """One record per line; files sort by name in record order (range-partitioned sort)."""
    # Lines are made behind the sort, whose sampling would make them all a first time.
    json_lines(records.orderBy(*ORDER)).select("line").write.text(path)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """(line, type) of a written payload."""
    return spark.read.text(path).select(
        F.col("value").alias("line"), F.get_json_object("value", "$.type").alias("type")
    )


def rollback_targets(lines: DataFrame) -> DataFrame:
    """Team and channel names a rollback has to remove."""
    return lines.filter(F.col("type").isin("team", "channel")).select(
        F.col("type").alias("kind"),
        F.coalesce(
            F.get_json_object("line", "$.team.name"), F.get_json_object("line", "$.channel.name")
        ).alias("name"),
    )


def _next_starts(sized: DataFrame, limit: int) -> DataFrame:
    """(batch, nxt): where the following part would start if one started at ``batch``.

    Batch j covers the byte span [end - bytes, end); the following part starts at the
    batch that covers the last byte a part from ``batch`` may hold. Spans and probes
    meet in buckets of ``limit`` bytes, so one bucket holds about one part's batches.
    """
    header = F.when(F.col("batch") == 0, 0).otherwise(len(VERSION_LINE) + 1)
    begin = F.col("end") - F.col("bytes")
    spans = sized.select(
        F.explode(F.sequence(F.floor(begin / limit), F.floor((F.col("end") - 1) / limit))).alias("bucket"),
        begin.alias("at"),
        F.col("batch").alias("owner"),
        F.lit(None).cast("bigint").alias("batch"),
    )
    probes = sized.withColumn("at", begin + F.lit(limit) - header).select(
        F.floor(F.col("at") / limit).alias("bucket"), "at", F.lit(None).cast("bigint").alias("owner"), "batch"
    )
    seen = Window.partitionBy("bucket").orderBy("at", F.col("batch").isNotNull())
    covered = (
        spans.unionByName(probes)
        .withColumn("owner", F.last("owner", ignorenulls=True).over(seen))
        .filter(F.col("batch").isNotNull())
    )
    nxt = F.greatest(F.col("owner"), F.col("batch") + 1)
    # A probe behind the final byte, and the last batch, have nothing to follow.
    final = sized.agg(F.max("end").alias("bytes"), F.max("batch").alias("batch")).first()
    return covered.filter((F.col("at") < final.bytes) & (nxt <= final.batch)).select(
        "batch", nxt.alias("nxt")
    )


def part_numbers(batches: DataFrame, limit: int) -> DataFrame:
    """(batch, bytes, part): greedy packing of ordered batches into parts of ``limit`` bytes.

    Same result as filling parts one after another, without walking the batches in
    order: every batch knows where the next part would start, and repeated doubling of
    these jumps from batch 0 marks the true starts.
    """
    sized = stage(running_total(batches, [], "batch", F.col("bytes"), "end"), "batches")
    if sized.isEmpty():
        return sized.select("batch", "bytes", F.lit(1).cast("bigint").alias("part"))
    jumps = stage(_next_starts(sized, limit), "jumps")
    starts = sized.filter("batch = 0").select("batch")
    while True:
        fresh, count = stage_counted(
            starts.join(jumps, "batch").select(F.col("nxt").alias("batch")), "starts", F.lit(True)
        )
        if count == 0:
            break
        starts = starts.unionByName(fresh)
        onward = jumps.select(F.col("batch").alias("nxt"), F.col("nxt").alias("_nxt"))
        jumps = stage(jumps.join(onward, "nxt").select("batch", F.col("_nxt").alias("nxt")), "jumps")
    flagged = sized.join(starts.withColumn("_start", F.lit(1)), "batch", "left")
    return running_total(flagged, [], "batch", F.coalesce("_start", F.lit(0)), "part").select(
        "batch", "bytes", "part"
    )


def with_parts(
    records: DataFrame, batch_size: int, max_chunk_mb: int, last: tuple[int, int] | None = None
) -> DataFrame:
    """(part, n, line): lines in order with their part; parts after the first get a header.

    ``last`` is the number and the bytes of a part that the first of these lines go on with.
    """
    lines = global_index(records, ORDER, "n", label="payload", shape=json_lines).select(
        "n", "line", F.floor(F.col("n") / batch_size).alias("batch")
    )
    batches = lines.groupBy("batch").agg(F.sum(F.octet_length("line") + 1).alias("bytes"))
    begun = 1
    if last:
        # What is there already counts as a batch before all others.
        begun, size = last
        lines = lines.withColumn("batch", F.col("batch") + 1)
        there = records.sparkSession.createDataFrame([(0, size)], "batch bigint, bytes bigint")
        batches = there.unionByName(batches.withColumn("batch", F.col("batch") + 1))
    numbered = part_numbers(batches, max_chunk_mb * MEGABYTE).withColumn("part", F.col("part") + (begun - 1))
    numbered = stage(numbered, "parts")
    body = lines.join(numbered.select("batch", "part"), "batch").select("part", "n", "line")
    heads = (
        numbered.filter(F.col("part") > begun)
        .select("part")
        .distinct()
        .select("part", F.lit(-1).cast("bigint").alias("n"), F.lit(VERSION_LINE).alias("line"))
    )
    return body.unionByName(heads)


def write_parts(parts: DataFrame, path: str) -> None:
    """One folder per part, ``part=part001`` …; a part is bounded, so one task writes it."""
    (
        parts.withColumn("part", F.format_string("part%03d", F.col("part")))
        .repartition("part")
        .sortWithinPartitions("part", "n")
        .select("part", "line")
        .write.partitionBy("part")
        .text(path)
    )
