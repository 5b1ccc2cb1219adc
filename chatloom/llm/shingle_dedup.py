"""Near-duplicates by the Jaccard similarity of word shingles, verified for every link.

SimHash fingerprints of the sets, searched by generalised pigeonhole, find the nearest copies.
Sets of similarity 0.8 differ in about 10 of 64 bits, which no such search reaches at scale;
banded MinHash finds the links that fingerprints leave open.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatloom.llm import simhash
from chatloom.llm.components import components
from chatloom.llm.words import LOWER_BYTES, filled, utf8
from chatloom.plans.staging import stage

_CHUNK = 512
#: Buckets of more members that are not connected yet are compared in pairs of blocks of
#: about so many members or shingles; none is left out.
PAIRS_UP_TO = 16
BLOCK = 512
BLOCK_SHINGLES = 1_000_000
_MIX = np.uint64(0x9E3779B97F4A7C15)
_SHIFT = np.uint64(29)


@dataclass(frozen=True)
class Bands:
    """Two sets meet if all ``rows`` minima of any of ``count`` bands are equal.

    Sets of similarity s meet with chance 1 - (1 - s^rows)^count: all but 1.3e-7 at 0.8.
    """

    count: int = 40
    rows: int = 5
    seed: int = 42

    def seeds(self) -> np.ndarray:
        rng = np.random.default_rng(self.seed)
        return rng.integers(0, 1 << 63, self.count * self.rows, dtype=np.uint64) * np.uint64(2)


def shingle_set(text: str | None, shingle: int = 5) -> np.ndarray:
    """Different shingles of a whole text as sorted 64-bit hashes.

    Words are in ASCII lower case. A text of fewer words is one shingle; one without words
    has none.
    """
    words = utf8(text).translate(LOWER_BYTES).split()
    if not words:
        return np.zeros(0, np.uint64)
    digest, size = xxhash.xxh3_64_intdigest, min(shingle, len(words))
    hashes = np.fromiter(map(digest, words), np.uint64, len(words))
    odd = np.random.default_rng([7, size]).integers(0, 1 << 63, size, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    count = len(words) - size + 1
    total = np.zeros(count, np.uint64)
    for k in range(size):
        total += hashes[k : k + count] * odd[k]
    total ^= total >> _SHIFT
    total *= _MIX
    return np.unique(total ^ (total >> _SHIFT))


def band_hashes(shingles: np.ndarray, seeds: np.ndarray, bands: Bands) -> np.ndarray:
    """One hash for each band of a set's minima; none for an empty set."""
    if not len(shingles):
        return np.zeros(0, np.int64)
    low = np.full(len(seeds), np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(shingles), _CHUNK):
        grid = shingles[at : at + _CHUNK, None] ^ seeds
        grid *= _MIX
        np.minimum(low, grid.min(axis=0), out=low)
    rows = low.reshape(bands.count, bands.rows)
    found = [xxhash.xxh3_64_intdigest(row.tobytes(), k) for k, row in enumerate(rows)]
    return np.array(found, np.uint64).view(np.int64)


def _signatures(docs: DataFrame, shingle: int, bands: Bands) -> DataFrame:
    """(_id, _row, key, size, fp, bands): ``key`` is a hash of the whole set of shingles."""
    id_type = docs.schema["_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seeds = bands.seeds()
        for batch in batches:
            keys, sizes, prints, found = [], [], [], []
            for text in batch.column(2):
                shingles = shingle_set(text.as_py(), shingle)
                keys.append(xxhash.xxh3_64_intdigest(shingles.tobytes()))
                sizes.append(len(shingles))
                prints.append(simhash.fingerprint_of(shingles))
                found.append(band_hashes(shingles, seeds, bands))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), batch.column(1), pa.array(np.array(keys, np.uint64).view(np.int64)),
                    pa.array(sizes, pa.int32()), pa.array(prints, pa.int64()), pa.array(found, pa.list_(pa.int64())),
                ],
                ["_id", "_row", "key", "size", "fp", "bands"],
            )

    return docs.mapInArrow(run, f"_id {id_type}, _row long, key long, size int, fp long, bands array<long>")


def _sets(docs: DataFrame, places: DataFrame, shingle: int) -> DataFrame:
    """(key, shingles) of the documents at ``places`` (key, at)."""
    wanted = stage(places.select("key", F.col("at._id").alias("_w_id"), F.col("at._row").alias("_w_row")), "places")
    texts = docs.join(wanted, (F.col("_row") == F.col("_w_row")) & F.col("_id").eqNullSafe(F.col("_w_id")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_set(text.as_py(), shingle).view(np.int64) for text in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sets, pa.list_(pa.int64()))], ["key", "shingles"]
            )

    found = texts.select("key", "_text").mapInArrow(run, "key long, shingles array<long>")
    return found.dropDuplicates(["key"])


def _sizes_allow(a: Column, b: Column, least: float) -> Column:
    """No two sets are more alike than the smaller one's share of the larger one."""
    return F.least(a, b) / F.greatest(a, b) >= least


def _verified(pairs: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """The pairs (a, b) whose sets have at least that similarity."""
    both = pairs.join(sets.select(F.col("key").alias("a"), F.col("shingles").alias("s")), "a").join(
        sets.select(F.col("key").alias("b"), F.col("shingles").alias("t")), "b"
    )
    common = F.size(F.array_intersect("s", "t"))
    return both.where(common / (F.size("s") + F.size("t") - common) >= least).select("a", "b")


def _print_stars(prints: DataFrame, parts: list[simhash.Part], least: float, distance: int) -> DataFrame:
    """(a, b): the sets near the smallest one of a bucket of fingerprints, with that one."""
    own = stage(simhash.indexed(prints, parts), "prints")
    shared = stage(
        own.groupBy("part", "bucket").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("key", "size", "fp")).alias("first"))
        .where("n > 1").drop("n"),
        "buckets",
    )
    met = own.join(shared, ["part", "bucket"]).where(
        (F.col("key") != F.col("first.key"))
        & simhash.within(F.col("fp"), F.col("first.fp"), distance)
        & _sizes_allow(F.col("size"), F.col("first.size"), least)
    )
    return met.select(F.col("first.key").alias("a"), F.col("key").alias("b")).distinct()


def _print_pairs(prints: DataFrame, roots: DataFrame, parts: list[simhash.Part], least: float, distance: int) -> DataFrame:
    """(a, b): all sets whose fingerprints are near and that no link connects yet."""
    placed = stage(prints.join(roots, "key", "left").withColumn("root", F.coalesce("root", "key")), "placed")
    left = simhash.probing(placed, parts).toDF("part", "bucket", "a", "n", "p", "ra")
    right = simhash.indexed(placed, parts).toDF("part", "bucket", "b", "m", "q", "rb")
    apart = (F.col("ra") < F.col("rb")) & simhash.within(F.col("p"), F.col("q"), distance)
    apart &= _sizes_allow(F.col("n"), F.col("m"), least)
    return left.join(right, ["part", "bucket"]).where(apart).select("a", "b").distinct()


def _keys(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("key")).unionByName(pairs.select(F.col("b").alias("key")))


def _links(docs: DataFrame, classes: DataFrame, shingle: int, least: float, bands: Bands, distance: int) -> DataFrame:
    """(a, b) of verified pairs that connect all that verified pairs of any bucket connect.

    Fingerprints come first: the sets of a bucket are compared with its smallest one, then
    all pairs within ``distance`` that are not connected by then. In buckets of bands the
    members are compared with the smallest one too. Pairs that are connected by then need
    no comparison; all others of a bucket get one, in large buckets without a row of their own.
    """
    prints = stage(classes.where("size > 0").select("key", "size", "fp"), "prints")
    parts = simhash.search_parts(prints, distance)
    near = stage(_print_stars(prints, parts, least, distance), "pairs")
    each = classes.select("key", "size", F.explode("bands").alias("bucket"))
    shared = stage(
        each.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("key", "size")).alias("first"))
        .where("n > 1").drop("n"),
        "buckets",
    )
    members = stage(each.join(shared, "bucket"), "members")
    met = members.select("key").unionByName(_keys(near)).distinct()
    sets = stage(_sets(docs, classes.join(met, "key").select("key", "at"), shingle), "sets")
    links = stage(_verified(near, sets, least), "links")
    roots = stage(components(links), "roots").withColumnRenamed("node", "key")
    left_open = stage(_print_pairs(prints, roots, parts, least, distance), "pairs")
    unread = _keys(left_open).distinct().join(met, "key", "left_anti")
    more_sets = stage(_sets(docs, classes.join(unread, "key").select("key", "at"), shingle), "sets")
    links = stage(links.unionByName(_verified(left_open, sets.unionByName(more_sets), least)), "links")
    roots = stage(components(links), "roots").withColumnRenamed("node", "key")

    others = members.where(F.col("key") != F.col("first.key"))
    star = others.where(_sizes_allow(F.col("size"), F.col("first.size"), least))
    pairs = star.select(F.col("first.key").alias("a"), F.col("key").alias("b")).distinct()
    for end in ("a", "b"):
        pairs = pairs.join(roots.toDF(end, f"r{end}"), end, "left").withColumn(f"r{end}", F.coalesce(f"r{end}", end))
    pairs = stage(pairs.where("ra <> rb").select("a", "b"), "pairs")
    links = stage(links.unionByName(_verified(pairs, sets, least)), "links")

    roots = stage(components(links), "roots").withColumnRenamed("node", "key")
    placed = others.join(roots, "key", "left").select("bucket", "key", "size", F.coalesce("root", "key").alias("root"))
    several = F.min("root") != F.max("root")
    unsettled = stage(
        placed.groupBy("bucket").agg(several.alias("several"), (F.count(F.lit(1)) > PAIRS_UP_TO).alias("large"))
        .where("several").select("bucket", "large"),
        "open",
    )
    rest = stage(placed.join(unsettled, "bucket"), "rest")
    small = rest.where(~F.col("large"))
    left = small.select("bucket", F.col("key").alias("a"), F.col("size").alias("n"), F.col("root").alias("ra"))
    right = small.select("bucket", F.col("key").alias("b"), F.col("size").alias("m"), F.col("root").alias("rb"))
    apart = (F.col("a") < F.col("b")) & (F.col("ra") != F.col("rb")) & _sizes_allow(F.col("n"), F.col("m"), least)
    more = stage(left.join(right, "bucket").where(apart).select("a", "b").distinct(), "pairs")
    links = links.unionByName(_verified(more, sets, least))
    crowds = rest.where("large")
    if crowds.limit(1).count():
        links = links.unionByName(_crowd_links(crowds, sets, least))
    return links


def compare_crowd(keys: np.ndarray, roots: np.ndarray, sets: list[np.ndarray], least: float) -> list[tuple[int, int]]:
    """Links between sets of different roots; one that joins what is joined already is left out."""
    sizes = np.array([len(s) for s in sets])
    starts = np.concatenate([[0], np.cumsum(sizes)])
    names, places = np.unique(np.concatenate(sets), return_inverse=True)
    group, out = np.unique(roots, return_inverse=True)[1], []
    mark = np.zeros(len(names), np.int32)
    for i in range(len(sets) - 1):
        own, first = places[starts[i] : starts[i + 1]], starts[i + 1]
        later = group[i + 1 :] != group[i]
        later &= np.minimum(sizes[i + 1 :], sizes[i]) / np.maximum(sizes[i + 1 :], sizes[i]) >= least
        if not later.any():
            continue
        mark[own] = 1
        common = np.add.reduceat(mark[places[first:]], starts[i + 1 : -1] - first)
        mark[own] = 0
        alike = later & (common / (sizes[i + 1 :] + sizes[i] - common) >= least)
        for j in (np.flatnonzero(alike) + i + 1).tolist():
            if group[j] != group[i]:
                out.append((int(keys[i]), int(keys[j])))
                group[group == group[j]] = group[i]
    return out


def _crowd_links(crowds: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """(a, b) of links within large buckets, without a row for each pair.

    Buckets that overlap are one crowd. A crowd is cut into blocks, every pair of blocks is
    compared in full by one task, and each returns fewer links than it has members.
    """
    low = stage(crowds.groupBy("bucket").agg(F.min("key").alias("low")), "low")
    ties = crowds.join(low, "bucket").select(F.col("key").alias("a"), F.col("low").alias("b")).distinct()
    crowd = stage(components(ties), "crowds").select(F.col("node").alias("key"), F.col("root").alias("crowd"))
    one = stage(crowds.select("key", "size", "root").distinct().join(crowd, "key"), "members")
    blocks = F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK), F.ceil(F.sum("size") / BLOCK_SHINGLES)).cast("int")
    counted = stage(one.groupBy("crowd").agg(blocks.alias("k")), "blocks")
    own = F.pmod(F.xxhash64("key"), F.col("k")).cast("int")
    each = one.join(counted, "crowd").select(
        "crowd", "key", "root", own.alias("own"), F.explode(F.sequence(F.lit(0), F.col("k") - 1)).alias("other")
    )
    pair = F.xxhash64("crowd", F.least("own", "other"), F.greatest("own", "other"))

    def compare(batch: pd.DataFrame) -> pd.DataFrame:
        shingles = [np.asarray(s, np.int64) for s in batch["shingles"]]
        found = compare_crowd(batch["key"].to_numpy(), batch["root"].to_numpy(), shingles, least)
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    return each.select(pair.alias("node"), "key", "root").join(sets, "key").groupBy("node").applyInPandas(
        compare, "a long, b long"
    )


def _identified(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("_id"), _row_of(text_col).alias("_row"), F.col(text_col).alias("_text"))


def _row_of(text_col: str) -> Column:
    return F.xxhash64(filled(F.col(text_col)))


def near_duplicates(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = 5,
    least: float = 0.8,
    bands: Bands | None = None,
    distance: int = 3,
) -> DataFrame:
    """(_id, _row, component_id) for every row of ``docs``; ``_row`` is a hash of its text.

    Texts link if the Jaccard similarity of their sets of ``shingle`` words is at least
    ``least``, which is verified for every link. Candidates are fingerprints within
    ``distance`` bits, all of them, and sets that share a band; component_id is the smallest id that
    links reach. Equal sets are one node whatever their number, null and empty texts among
    them; null ids are never smallest.
    """
    bands = bands or Bands()
    whole = _identified(docs, id_col, text_col)
    rows = stage(_signatures(whole, shingle, bands), "signatures")
    classes = stage(
        rows.groupBy("key").agg(
            F.min("_id").alias("low"),
            F.min(F.struct("_id", "_row")).alias("at"),
            F.first("size").alias("size"),
            F.first("fp").alias("fp"),
            F.first("bands").alias("bands"),
        ),
        "classes",
    )
    linked = components(_links(whole, classes, shingle, least, bands, distance))
    rooted = classes.join(linked, F.col("key") == F.col("node"), "left").select(
        "key", "low", F.coalesce("root", "key").alias("root")
    )
    lows = rooted.groupBy("root").agg(F.min("low").alias("component_id"))
    by_key = stage(rooted.join(lows, "root").select("key", "component_id"), "groups")
    return rows.select("_id", "_row", "key").join(by_key, "key").select("_id", "_row", "component_id")


def keep_one(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that stand for their group: the one with the smallest id.

    Of rows that share that id, all in the group stay.
    """
    groups = near_duplicates(docs, id_col=id_col, text_col=text_col, **options)
    stay = groups.where(F.col("_id").eqNullSafe(F.col("component_id"))).select(
        F.col("_id").alias("_stay_id"), F.col("_row").alias("_stay_row")
    ).distinct()
    same = (_row_of(text_col) == F.col("_stay_row")) & docs[id_col].eqNullSafe(F.col("_stay_id"))
    return docs.join(stay, same, "left_semi")
