"""SimHash near-duplicates with a generalised pigeonhole join over the fingerprints."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from itertools import combinations
from math import comb

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatloom.llm.components import components
from chatloom.llm.words import LOWER_BYTES, utf8
from chatloom.plans.staging import stage

BITS = 64
_BLOCK = 1 << 16
_SIGNED = 1 << 63


def _bit_counts(hashes: list[int] | np.ndarray) -> np.ndarray:
    grid = np.array(hashes, dtype="<u8").view(np.uint8).reshape(-1, 8)
    return np.unpackbits(grid, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)


def fingerprint(text: str | None, shingle: int = 3, seed: int = 42) -> int:
    """64-bit SimHash of one whole text over word shingles, repeats included.

    Bit i is 1 if it is set in more than half of the shingles' XXH64 hashes. A text of
    fewer words is one shingle; a text without words has fingerprint 0.
    """
    words = utf8(text).translate(LOWER_BYTES).split()
    if not words:
        return 0
    size = min(shingle, len(words))
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    first = np.concatenate([[0], ends[:-1] + 1])[: len(words) - size + 1].tolist()
    last = ends[size - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    counts = np.zeros(BITS, np.int64)
    for at in range(0, len(first), _BLOCK):
        hashes = [
            digest(joined[a:b], seed)
            for a, b in zip(first[at : at + _BLOCK], last[at : at + _BLOCK], strict=True)
        ]
        counts += _bit_counts(hashes)
    return _majority(counts, len(first))


def _majority(counts: np.ndarray, total: int) -> int:
    bits = (2 * counts > total).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def fingerprint_of(hashes: np.ndarray) -> int:
    """64-bit SimHash of 64-bit hashes as a signed long; 0 if there are none."""
    counts = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), _BLOCK):
        counts += _bit_counts(hashes[at : at + _BLOCK])
    return _signed(_majority(counts, len(hashes)))


def fingerprints(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, seed: int = 42
) -> DataFrame:
    """(id, fp): the fingerprint of each row as a signed long."""

    @F.pandas_udf("long")
    def measure(texts: pd.Series) -> pd.Series:
        values = [fingerprint(t, shingle, seed) for t in texts]
        return pd.Series([v - 2 * _SIGNED if v >= _SIGNED else v for v in values], dtype="int64")

    return docs.select(id_col, measure(F.col(text_col)).alias("fp"))


@dataclass(frozen=True)
class Part:
    """Some bit positions, and the distance up to which they are searched."""

    bits: tuple[int, ...]
    threshold: int

    @property
    def mask(self) -> int:
        return _signed(sum(1 << b for b in self.bits))

    def flips(self) -> list[int]:
        """XOR masks that reach every value within the threshold, unchanged first."""
        return [
            _signed(sum(1 << b for b in chosen))
            for t in range(self.threshold + 1)
            for chosen in combinations(self.bits, t)
        ]


def _signed(value: int) -> int:
    return value - 2 * _SIGNED if value >= _SIGNED else value


def _grouped(bits: np.ndarray, parts: int) -> list[list[int]]:
    """Positions in ``parts`` groups of near equal size; correlated positions go together."""
    centred = bits - bits.mean(axis=0)
    norm = np.sqrt((centred**2).sum(axis=0))
    corr = np.abs(centred.T @ centred) / np.maximum(np.outer(norm, norm), 1e-12)
    left, groups = set(range(BITS)), []
    for k in range(parts):
        size = len(left) // (parts - k)
        pair = corr[np.ix_(sorted(left), sorted(left))] - 2 * np.eye(len(left))
        group = [sorted(left)[int(pair.max(axis=1).argmax())]]
        left.discard(group[0])
        while len(group) < size:
            rest = sorted(left)
            group.append(rest[int(corr[np.ix_(group, rest)].sum(axis=0).argmax())])
            left.discard(group[-1])
        groups.append(sorted(group))
    return groups


def _near_share(bits: np.ndarray, group: Sequence[int], limit: int) -> list[float]:
    """Estimated share of pairs within distance 0..limit on ``group``; never under random bits'."""
    part = bits[:, list(group)].astype(np.float32)
    weight = part.sum(axis=1)
    apart = weight[:, None] + weight[None, :] - 2 * (part @ part.T)
    n = len(bits)
    out, chance = [], 0.0
    for t in range(limit + 1):
        chance += comb(len(group), t) / 2.0 ** len(group)
        seen = ((apart <= t + 0.5).sum() - n) / max(n * (n - 1), 1)
        out.append(max(float(seen), min(1.0, chance)))
    return out


def plan_parts(sample: Sequence[int], rows: int, distance: int) -> list[Part]:
    """Partitions and thresholds such that any pair within ``distance`` meets in one of them.

    With m partitions it is enough that the thresholds sum to distance - m + 1 (-1: not
    searched). For each m, dynamic programming finds the cheapest thresholds, where a
    partition costs its probes and its estimated candidates; the cheapest m wins. The
    sample only steers cost, never results.
    """
    values = np.array([v & (2 * _SIGNED - 1) for v in sample] or [0], dtype="<u8")
    bits = np.unpackbits(values.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    best: tuple[float, list[Part]] | None = None
    for m in range(2, distance + 2):
        groups = _grouped(bits.astype(float), m)
        budget = distance - m + 1
        costs = []
        for group in groups:
            near = _near_share(bits, group, distance)
            by_threshold = {-1: 0.0}
            for t in range(distance + 1):
                probes = sum(comb(len(group), j) for j in range(t + 1))
                by_threshold[t] = 4.0 + 4.0 * probes + rows * near[t]
            costs.append(by_threshold)
        # table: total of the thresholds so far -> (cost, thresholds)
        table: dict[int, tuple[float, tuple[int, ...]]] = {0: (0.0, ())}
        for by_threshold in costs:
            grown: dict[int, tuple[float, tuple[int, ...]]] = {}
            for total, (cost, chosen) in table.items():
                for t, more in by_threshold.items():
                    entry = (cost + more, (*chosen, t))
                    if total + t not in grown or entry < grown[total + t]:
                        grown[total + t] = entry
            table = grown
        cost, chosen = table[budget]
        if best is None or cost < best[0]:
            best = cost, [Part(tuple(g), t) for g, t in zip(groups, chosen, strict=True) if t >= 0]
    return best[1]


def search_parts(prints: DataFrame, distance: int, sample_rows: int = 2048) -> list[Part]:
    """The partitions of a search over ``fp``, planned on a bounded sample."""
    spread = prints.select("fp").orderBy(F.xxhash64("fp"), "fp").limit(sample_rows)
    return plan_parts([r["fp"] for r in spread.collect()], prints.count(), distance)


def _bucket(number: int, value: Column) -> Column:
    return F.struct(F.lit(number).alias("part"), value.alias("bucket"))


def indexed(prints: DataFrame, parts: list[Part]) -> DataFrame:
    """Each row once a partition, with its own bucket there: (part, bucket) and its columns."""
    index = F.array(*[_bucket(i, F.col("fp").bitwiseAND(F.lit(p.mask))) for i, p in enumerate(parts)])
    return prints.select("*", F.explode(index).alias("_k")).select("_k.*", *prints.columns)


def probing(prints: DataFrame, parts: list[Part]) -> DataFrame:
    """Each row once for every bucket that its partitions' thresholds reach."""

    def probes(number: int, part: Part) -> Column:
        own = F.col("fp").bitwiseAND(F.lit(part.mask))
        flips = F.array(*[F.lit(x) for x in part.flips()])
        return F.transform(flips, lambda flip: _bucket(number, own.bitwiseXOR(flip)))

    probe = F.flatten(F.array(*[probes(i, p) for i, p in enumerate(parts)]))
    return prints.select("*", F.explode(probe).alias("_k")).select("_k.*", *prints.columns)


def within(a: Column, b: Column, distance: int) -> Column:
    return F.bit_count(a.bitwiseXOR(b)) <= distance


def near_pairs(prints: DataFrame, *, distance: int = 3, sample_rows: int = 2048) -> DataFrame:
    """(a, b) with a < b: every pair of distinct values of ``fp`` within ``distance`` bits.

    Each partition's bits of a value are its bucket; the other side probes its own bucket
    and those its threshold reaches. Verification is part of the join, so no unverified
    pair becomes a row. ``sample_rows`` bounds the sample that the plan is estimated on.
    """
    parts = search_parts(prints, distance, sample_rows)
    left = probing(prints.select("fp"), parts).withColumnRenamed("fp", "a")
    right = indexed(prints.select("fp"), parts).withColumnRenamed("fp", "b")
    return (
        left.join(right, ["part", "bucket"])
        .where((F.col("a") < F.col("b")) & within(F.col("a"), F.col("b"), distance))
        .select("a", "b")
    )


def near_duplicates(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = 3,
    seed: int = 42,
    distance: int = 3,
) -> DataFrame:
    """(id, fp, component_id) for every row of ``docs``.

    component_id is the smallest id reachable over fingerprints within ``distance`` bits.
    Rows with equal fingerprints, copies of a text above all, are one node of the search,
    whatever their number. Null and empty texts have fingerprint 0 and link like any
    other; a repeated id gets one row for each of its rows; null ids are never smallest.
    """
    prints = stage(fingerprints(docs, id_col=id_col, text_col=text_col, shingle=shingle, seed=seed), "prints")
    classes = stage(prints.groupBy("fp").agg(F.min(id_col).alias("low")), "classes")
    linked = components(near_pairs(classes.select("fp"), distance=distance))
    rooted = classes.join(linked, classes["fp"] == linked["node"], "left").select(
        "fp", "low", F.coalesce("root", "fp").alias("root")
    )
    lows = rooted.groupBy("root").agg(F.min("low").alias("component_id"))
    by_print = rooted.join(lows, "root").select("fp", "component_id")
    return prints.join(by_print, "fp").select(id_col, "fp", "component_id")


def fingerprint_hex(fp: Column) -> Column:
    """16 lowercase hex digits of a fingerprint column."""
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def keep_one(docs: DataFrame, *, id_col: str = "doc_id", **options) -> DataFrame:
    """The rows of ``docs`` that stand for their group: the one with the smallest id.

    Of rows that share that id, all stay if they belong to the same group.
    """
    groups = near_duplicates(docs, id_col=id_col, **options)
    stay = (
        groups.where(F.col(id_col).eqNullSafe(F.col("component_id")))
        .select(F.col(id_col).alias("_stay"))
        .distinct()
    )
    return docs.join(stay, docs[id_col].eqNullSafe(stay["_stay"]), "left_semi")
