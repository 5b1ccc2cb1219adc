"""Line deduplication by range-partitioned line hashes, with keep bitmaps as the result.

DataFrame functions only. Only 128-bit hashes of lines are shuffled; the texts move once,
when the bitmaps are applied.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chatloom.llm.words import WHITE, ascii_lower, filled
from chatloom.plans.staging import stage

#: At most so many keys, the most frequent ones of a sample of documents, are counted
#: apart from the others, if the sample has them at least ``_HOT_SEEN`` times.
HOT_KEYS = 1000
_HOT_SEEN = 40
_SAMPLE_SHARE = 0.02


def line_key(line: Column) -> Column:
    """A line without white space at its ends, A-Z in lower case."""
    return ascii_lower(F.trim(line, F.lit(WHITE)))


def _row(id_col: str, text_col: str) -> list[Column]:
    """A document is told by its id and a hash of its text."""
    return [F.col(id_col).alias("_id"), F.xxhash64(filled(F.col(text_col))).alias("_row")]


def _lines(docs: DataFrame, id_col: str, text_col: str, min_points: int) -> DataFrame:
    """(_id, _row, pos, h1, h2) for every line whose key has ``min_points`` code points."""
    cut = docs.select(*_row(id_col, text_col), F.split(filled(F.col(text_col)), "\n").alias("_lines"))
    one = cut.select("_id", "_row", F.posexplode("_lines").alias("pos", "_line"))
    keyed = one.select("_id", "_row", "pos", line_key(F.col("_line")).alias("_key"))
    return keyed.where(F.length("_key") >= min_points).select(
        "_id", "_row", "pos", F.xxhash64("_key").alias("h1"), F.xxhash64("_key", F.lit(1)).alias("h2")
    )


def _hot_keys(docs: DataFrame, id_col: str, text_col: str, min_points: int) -> list[int]:
    """First hashes of the keys that may hold a large share of all lines.

    A bounded list from a mergeable sketch over a sample of documents. It only decides by
    which of two exact ways a key is counted.
    """
    lines = _lines(docs.sample(_SAMPLE_SHARE, seed=7), id_col, text_col, min_points)
    top = lines.agg(F.expr(f"approx_top_k(h1, {HOT_KEYS}, {10 * HOT_KEYS})").alias("top"))
    found = top.select(F.explode("top").alias("t")).where(F.col("t.count") >= _HOT_SEEN)
    return [row["item"] for row in found.select("t.item").collect() if row["item"] is not None]


def repeated_lines(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_docs: int = 10,
    min_points: int = 1,
) -> DataFrame:
    """(_id, _row, pos, first) of every line whose key is in at least ``min_docs`` documents.

    Hashes are range-partitioned (they are uniform, so the splitters are known without a
    sample) and sorted by document and position within, so one streaming pass over a key
    sees its documents in order: it numbers them and marks the first occurrence. A key
    that may hold a large share of all lines is counted with partial aggregates instead
    and never sorted into one task.
    """
    lines = _lines(docs, id_col, text_col, min_points)
    hot = _hot_keys(docs, id_col, text_col, min_points)
    is_hot = F.col("h1").isin(hot) if hot else F.lit(False)
    width = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    span = F.shiftright(F.shiftrightunsigned("h1", 33) * width, 31).cast("int")
    ranged = lines.where(~is_hot).withColumn("_span", span).repartitionById(width, F.col("_span"))
    by_doc = Window.partitionBy("_span", "h1", "h2").orderBy("_id", "_row")
    whole = Window.partitionBy("_span", "h1", "h2")
    numbered = (
        ranged.withColumn("_n", F.dense_rank().over(by_doc))
        .withColumn("_docs", F.max("_n").over(whole))
        .where(F.col("_docs") >= min_docs)
        .withColumn("first", F.row_number().over(by_doc.orderBy("_id", "_row", "pos")) == 1)
        .select("_id", "_row", "pos", "first")
    )
    if not hot:
        return numbered
    common = stage(lines.where(is_hot), "hot-lines")
    once = common.groupBy("h1", "h2", "_id", "_row").agg(F.min("pos").alias("pos"))
    place = F.struct(F.col("_id"), F.col("_row"), F.col("pos"))
    counts = (
        once.groupBy("h1", "h2")
        .agg(F.count(F.lit(1)).alias("_docs"), F.min(place).alias("_first"))
        .where(F.col("_docs") >= min_docs)
    )
    # One row per hot key: bounded by the share, so it may go to every task.
    found = common.join(F.broadcast(counts), ["h1", "h2"]).select(
        "_id", "_row", "pos", place.eqNullSafe(F.col("_first")).alias("first")
    )
    return numbered.unionByName(found)


def keep_bitmaps(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_docs: int = 10,
    min_points: int = 1,
    keep_first: bool = False,
) -> DataFrame:
    """(_id, _row, runs): per document with dropped lines, its keep bitmap in compressed form.

    ``runs`` holds (start, length) of each maximal run of dropped lines, by position; all
    other lines stay. With ``keep_first`` the first occurrence of a key, by id, stays too.
    Documents without dropped lines have no row.
    """
    found = repeated_lines(docs, id_col=id_col, text_col=text_col, min_docs=min_docs, min_points=min_points)
    if keep_first:
        found = found.where(~F.col("first"))
    at = F.col("_at")
    starts = F.filter(at, lambda x, i: (i == 0) | (F.get(at, i - 1) != x - 1))
    ends = F.filter(at, lambda x, i: (i == F.size(at) - 1) | (F.get(at, i + 1) != x + 1))
    runs = F.zip_with(
        starts, ends, lambda s, e: F.struct(s.alias("start"), (e - s + 1).alias("length"))
    )
    return (
        found.groupBy("_id", "_row")
        .agg(F.sort_array(F.collect_set("pos")).alias("_at"))
        .select("_id", "_row", runs.alias("runs"))
    )


def apply_bitmaps(
    docs: DataFrame, bitmaps: DataFrame, *, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc, n_lines, n_dropped, kept): each row of ``docs`` as a struct, and its remaining text."""
    text = F.col("_text")
    lines = F.split(text, "\n")
    keyed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"),
        F.col(id_col).alias("_d_id"),
        filled(F.col(text_col)).alias("_text"),
        F.xxhash64(filled(F.col(text_col))).alias("_d_row"),
    )
    b = bitmaps.select("_id", "_row", F.col("runs").alias("_runs"))
    joined = keyed.join(b, (F.col("_d_row") == F.col("_row")) & F.col("_d_id").eqNullSafe(F.col("_id")), "left")
    runs = F.coalesce(F.col("_runs"), F.array().cast("array<struct<start:int,length:int>>"))
    n_lines = F.size(lines)
    # Flags by position: false before each run, true inside it, false after the last one.
    pieces = F.transform(
        runs,
        lambda run, i: F.concat(
            F.array_repeat(
                F.lit(False),
                run["start"] - F.when(i == 0, 0).otherwise(F.get(runs, i - 1)["start"] + F.get(runs, i - 1)["length"]),
            ),
            F.array_repeat(F.lit(True), run["length"]),
        ),
    )
    # zip_with pads the flags with null; a null entry is left out by array_join.
    kept = F.zip_with(lines, F.flatten(pieces), lambda line, drop: F.when(drop, None).otherwise(line))
    return joined.select(
        "doc",
        n_lines.cast("long").alias("n_lines"),
        F.aggregate(runs, F.lit(0).cast("long"), lambda acc, run: acc + run["length"]).alias("n_dropped"),
        F.when(F.size(runs) == 0, text).otherwise(F.array_join(kept, "\n")).alias("kept"),
    )


def drop_common_lines(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_docs: int = 10,
    min_points: int = 1,
    keep_first: bool = False,
) -> DataFrame:
    """(doc, n_lines, n_dropped, kept) for every row of ``docs``, the row itself as a struct.

    A null or empty text is one empty line. A document is its id and its text: an exactly
    repeated row counts once and is treated alike each time; null ids compare as equal.
    Empty keys are never dropped while ``min_points`` is at least 1.
    """
    bitmaps = keep_bitmaps(
        docs, id_col=id_col, text_col=text_col, min_docs=min_docs, min_points=min_points, keep_first=keep_first
    )
    return apply_bitmaps(docs, bitmaps, id_col=id_col, text_col=text_col)
