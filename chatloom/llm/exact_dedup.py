"""Exact deduplication by sorting normalised contents."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatloom.llm.words import WHITE_CLASS, filled
from chatloom.plans.staging import stage

#: Characters of the content that lead the sort key; the digest and the id follow them.
_LEAD = 24
_ROWS_OUT = 20_000


def sorted_contents(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(_id, _points, _sha, _norm), range-partitioned and sorted by normalised content.

    Splitters are sampled from a short key: the first characters, the digest of the whole
    content, then the id. So equal contents lie side by side, a common beginning is split
    by digest, and a large group of copies is split by id over neighbouring partitions.
    """
    norm = F.regexp_replace(filled(F.col(text_col)), f"[{WHITE_CLASS}]+", "")
    keyed = docs.select(
        F.col(id_col).alias("_id"),
        F.length(filled(F.col(text_col))).cast("long").alias("_points"),
        norm.alias("_norm"),
    ).select(
        "_id",
        "_points",
        F.substring("_norm", 1, _LEAD).alias("_lead"),
        F.sha2(F.col("_norm"), 256).alias("_sha"),
        "_norm",
    )
    ranged = keyed.repartitionByRange("_lead", "_sha", F.col("_id").asc_nulls_last())
    best = [F.col("_points").desc(), F.col("_id").asc_nulls_last()]
    return ranged.sortWithinPartitions("_lead", "_sha", "_norm", *best).select("_id", "_points", "_sha", "_norm")


def exact_groups(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, keep_id, group_size, kept, text_sha256) for every row of ``docs``.

    Texts are equal when they are identical without white space; null counts as empty.
    Of equal texts the row with most code points stays, then the one with the smallest id
    (null ids last), then one of the exactly repeated rows. Sorted neighbours are compared
    in full. A run that touches the end of its partition is joined to its like in the
    next ones by digest, through a table of two rows per partition.
    """
    id_type = docs.schema[id_col].dataType.simpleString()
    schema = (
        f"_id {id_type}, _keep {id_type}, _points long, _size long, _first boolean, _sha string, "
        "_part int, _run long, _edge boolean"
    )

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, run, out, ids, now = TaskContext.get().partitionId(), 0, [], [], None
        key_type = None

        def close(last: bool) -> None:
            edge = run == 0 or last
            keep, (points, sha, _) = ids[0], now
            out.extend(
                (x, keep, points, len(ids), i == 0, sha, part, run, edge) for i, x in enumerate(ids)
            )

        def table() -> pa.RecordBatch:
            types = [key_type, key_type, pa.int64(), pa.int64(), pa.bool_(), pa.string(), pa.int32(), pa.int64(), pa.bool_()]
            names = ["_id", "_keep", "_points", "_size", "_first", "_sha", "_part", "_run", "_edge"]
            arrays = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)]
            return pa.RecordBatch.from_arrays(arrays, names)

        for batch in batches:
            key_type = batch.schema.field(0).type
            columns = [batch.column(k) for k in range(4)]
            for i in range(batch.num_rows):
                key, points, sha, norm = (c[i].as_py() for c in columns)
                if now is None or norm != now[2]:
                    if now is not None:
                        close(last=False)
                        run += 1
                        if len(out) >= _ROWS_OUT:
                            yield table()
                            out = []
                    ids, now = [], (points, sha, norm)
                ids.append(key)
        if now is not None:
            close(last=True)
            yield table()

    found = stage(sorted_contents(docs, id_col=id_col, text_col=text_col).mapInArrow(scan, schema), "runs")
    # Of every run at an edge, its first row: two rows per partition, a proven bound.
    order = F.struct(
        (-F.col("_points")).alias("p"), F.col("_keep").isNull().alias("n"), F.col("_keep").alias("k"), "_part", "_run"
    )
    edges = found.where(F.col("_edge") & F.col("_first"))
    joined = edges.groupBy("_sha").agg(F.min(order).alias("_best"), F.sum("_size").alias("_all"))
    fixes = edges.join(joined, "_sha").select(
        F.col("_part").alias("_f_part"), F.col("_run").alias("_f_run"), "_best", "_all"
    )
    own = (F.col("_best._part") == F.col("_part")) & (F.col("_best._run") == F.col("_run"))
    fixed = F.col("_all").isNotNull()
    return found.join(
        F.broadcast(fixes), (F.col("_part") == F.col("_f_part")) & (F.col("_run") == F.col("_f_run")), "left"
    ).select(
        F.col("_id").alias(id_col),
        F.when(fixed, F.col("_best.k")).otherwise(F.col("_keep")).alias("keep_id"),
        F.coalesce("_all", "_size").alias("group_size"),
        (F.col("_first") & F.coalesce(own, F.lit(True))).alias("kept"),
        F.col("_sha").alias("text_sha256"),
    )
