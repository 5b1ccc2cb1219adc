"""Payload parts that a later run goes on with, and the manifest committed beside them.

A folder holds ``<stem>.part001.jsonl`` and so on, and under ``_manifest`` one version of the
manifest per finished run. Parts come first, then the manifest: a run that is cut off
leaves the version before it, and what it wrote behind that is replaced by the next.
"""

from __future__ import annotations

import re
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chatloom.operators.render import RECORD_SCHEMA
from chatloom.plans.staging import stage
from chatloom.sources.payload import with_parts

MANIFEST = "_manifest"
_TORN = "_torn"


class Folder:
    """A payload folder on whatever file system its path names."""

    def __init__(self, spark: SparkSession, path: str, stem: str) -> None:
        self.spark, self.path, self.stem = spark, path.rstrip("/"), stem
        self._hadoop = spark._jvm.org.apache.hadoop.fs
        self._fs = self._at("").getFileSystem(spark._jsc.hadoopConfiguration())

    def _at(self, name: str):
        return self._hadoop.Path(f"{self.path}/{name}" if name else self.path)

    def names(self, folder: str = "") -> list[str]:
        at = self._at(folder)
        return sorted(s.getPath().getName() for s in self._fs.listStatus(at)) if self._fs.exists(at) else []

    def exists(self, name: str) -> bool:
        return self._fs.exists(self._at(name))

    def delete(self, name: str) -> None:
        self._fs.delete(self._at(name), True)

    def replace(self, source: str, target: str) -> None:
        self.delete(target)
        if not self._fs.rename(self._at(source), self._at(target)):
            raise OSError(f"could not rename {source} to {target} in {self.path}")

    def part(self, number: int) -> str:
        return f"{self.stem}.part{number:03d}.jsonl"

    def parts(self) -> dict[int, str]:
        pattern = re.compile(re.escape(self.stem) + r"\.part(\d{3,})\.jsonl")
        found = [(pattern.fullmatch(name), name) for name in self.names()]
        return {int(match[1]): name for match, name in found if match}


def read_manifest(folder: Folder) -> DataFrame | None:
    """(part, bytes, records) of the last finished run; None where there is none."""
    done = [v for v in folder.names(MANIFEST) if folder.exists(f"{MANIFEST}/{v}/_SUCCESS")]
    if not done:
        return None
    return folder.spark.read.schema("part bigint, bytes bigint, records bigint").parquet(
        f"{folder.path}/{MANIFEST}/{done[-1]}"
    )


def part_lines(folder: Folder, numbers: list[int]) -> DataFrame:
    """(part, n, line) of some parts; ``n`` follows the order in the file.

    A file may be read in several splits: their order is that of their place in the file.
    """
    names = [f"{folder.path}/{folder.part(k)}" for k in numbers]
    if not names:
        return folder.spark.createDataFrame([], "part bigint, n bigint, line string")
    number = F.regexp_extract(F.col("_metadata.file_path"), r"\.part(\d+)\.jsonl$", 1).cast("bigint")
    within = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
    return folder.spark.read.text(names).select(
        number.alias("part"),
        # Parts hold below 2^31 bytes a split; no split has more lines than bytes.
        (F.col("_metadata.file_block_start") + within).alias("n"),
        F.col("value").alias("line"),
    )


def typed(lines: DataFrame) -> DataFrame:
    """(columns of ``lines``, type, one nullable struct per type) of the lines that are whole records.

    A line that is no whole record, as the last one of a run that was cut off, is left out:
    its record counts as not written.
    """
    schema = f"type string, {RECORD_SCHEMA}, {_TORN} string"
    parsed = F.from_json("line", schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _TORN})
    return (
        lines.withColumn("_record", parsed)
        .filter(F.col(f"_record.{_TORN}").isNull() & F.col("_record.type").isNotNull())
        .select(*lines.columns, "_record.*")
        .drop(_TORN)
    )


def read_records(folder: Folder) -> DataFrame:
    """(part, n, line, type, structs) of all parts the manifest lists; later parts' headers left out."""
    manifest = read_manifest(folder)
    numbers = [] if manifest is None else [row.part for row in manifest.select("part").collect()]
    present = folder.parts()
    records = typed(part_lines(folder, [k for k in numbers if k in present]))
    return records.filter((F.col("type") != "version") | (F.col("part") == 1))


@dataclass(frozen=True)
class Gate:
    """Whether a run goes on with an earlier one, and with which records."""

    resumed: bool
    written: DataFrame | None
    last: int


def gate(folder: Folder) -> Gate:
    """Go on only if there is a manifest and its parts hold records; else start afresh."""
    manifest = read_manifest(folder)
    if manifest is None:
        return Gate(False, None, 0)
    written = read_records(folder)
    if written.isEmpty():
        return Gate(False, None, 0)
    return Gate(True, written, manifest.agg(F.max("part")).first()[0])


def write(folder: Folder, records: DataFrame, batch_size: int, max_chunk_mb: int, start: Gate) -> DataFrame:
    """Write the records behind those of ``start`` and commit a manifest; returns it.

    The last part is filled up before the next one starts, as if one run had written all:
    its whole lines and the new ones are written again as one file.
    """
    last = None
    old = part_lines(folder, [])
    if start.resumed:
        kept = typed(part_lines(folder, [start.last])).select("part", "n", "line")
        size = kept.agg(F.coalesce(F.sum(F.octet_length("line") + 1), F.lit(0)).alias("bytes")).first().bytes
        last, old = (start.last, size), kept
    new = with_parts(records, batch_size, max_chunk_mb, last)
    # Old lines sort before the new ones of their part.
    parts = old.withColumn("n", F.col("n") - (1 << 62)).unionByName(new)
    parts = stage(parts, "parts")
    sizes = stage(
        parts.groupBy("part").agg(
            F.sum(F.octet_length("line") + 1).alias("bytes"), F.count(F.lit(1)).alias("records")
        ),
        "part-sizes",
    )
    label = f"_writing-{start.last:06d}"
    folder.delete(label)
    (
        parts.withColumn("number", F.col("part"))
        .repartition("number")
        .sortWithinPartitions("number", "n")
        .select("number", "line")
        .write.partitionBy("number")
        .text(f"{folder.path}/{label}")
    )
    for number, name in folder.parts().items():
        if number > start.last:
            folder.delete(name)

    def place(written: str) -> None:
        (file,) = [n for n in folder.names(f"{label}/{written}") if n.startswith("part-")]
        folder.replace(f"{label}/{written}/{file}", folder.part(int(written.removeprefix("number="))))

    with ThreadPoolExecutor(16) as pool:
        list(pool.map(place, [n for n in folder.names(label) if n.startswith("number=")]))
    folder.delete(label)
    manifest = sizes
    if start.resumed:
        manifest = read_manifest(folder).join(sizes, "part", "left_anti").unionByName(sizes)
    version = f"{MANIFEST}/v{len(folder.names(MANIFEST)) + 1:06d}"
    manifest.write.mode("overwrite").parquet(f"{folder.path}/{version}")
    return read_manifest(folder)

