"""The whole transformation: check, name, resolve, render, write."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatloom.operators import attachments, render, resume, validate
from chatloom.plans.options import JobOptions
from chatloom.plans.staging import stage
from chatloom.plans.workspace import Workspace, staged
from chatloom.sources import payload, resumable


def build_payload(
    ws: Workspace, opts: JobOptions, listing: DataFrame | None = None
) -> DataFrame:
    """All records of a workspace; ``listing(source)`` names the attachments at hand."""
    outcome = None
    if listing is not None:
        outcome = stage(attachments.outcomes(attachments.manifest(ws), listing), "attachments")
    return render.all_records(ws, opts, outcome)


def summarize(ws: Workspace, records: DataFrame, input_bytes: int = 0) -> DataFrame:
    """One row: bytes, teams, channels, users, posts and records written."""
    counts = resume.record_stats(records).agg(F.sum("records").alias("records")).first()
    return validate.summary(ws).select(
        F.lit(input_bytes).cast("bigint").alias("bytes"),
        "teams",
        "channels",
        "users",
        "posts",
        F.lit(counts.records or 0).cast("bigint").alias("records"),
    )


def source_bytes(source: DataFrame) -> int:
    """Bytes of the files a table is read from: their metadata is looked at, not their rows.

    A table that comes from no files has none.
    """
    try:
        files = source.select("_metadata.file_path", "_metadata.file_size").distinct()
    except AnalysisException:
        return 0
    return files.agg(F.coalesce(F.sum("file_size"), F.lit(0)).alias("bytes")).first().bytes


def run(
    ws: Workspace,
    opts: JobOptions,
    output: str,
    listing: DataFrame | None = None,
    written: DataFrame | None = None,
    input_bytes: int = 0,
    source: DataFrame | None = None,
    stem: str = "payload",
) -> DataFrame:
    """Check the workspace, write its payload below ``output`` and return the summary.

    With a part size, ``output`` holds numbered parts and a manifest, and a run goes on where
    the manifest ends; otherwise ``written`` may hold the records of an earlier run.
    ``source`` is what the workspace was read from; its files give the summary's bytes.
    """
    spark = ws.posts.sparkSession
    taken = source_bytes(source) if source is not None else input_bytes
    ws = staged(ws)
    validate.check(ws, opts.fail_on_empty)
    records = build_payload(ws, opts, listing)
    if opts.max_chunk_mb:
        folder = resumable.Folder(spark, output, stem)
        start = resumable.gate(folder) if opts.resume else resumable.Gate(False, None, 0)
        records = stage(resume.remaining(records, start.written), "records")
        resumable.write(folder, records, opts.batch_size, opts.max_chunk_mb, start)
    else:
        if opts.resume:
            records = resume.remaining(records, written)
        records = stage(records, "records")
        payload.write_payload(records, output)
    return summarize(ws, records, taken)
