"""Near-duplicate embeddings by a forest of random-projection trees with spill."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import ceil, log2

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatloom.llm.components import components
from chatloom.plans.staging import stage


@dataclass(frozen=True)
class Forest:
    """``trees`` trees whose leaves hold about ``leaf`` vectors.

    A split sends the ``spill`` share of vectors on either side of its median to both
    children. Subtrees of up to ``levels`` levels are fitted at a time, each on a sample
    of about ``sample`` of its vectors; every vector is then routed. Nodes in which at least
    the ``tight`` share of sampled pairs would link are not split but compared whole, about
    ``block`` vectors at a time.
    """

    trees: int = 8
    leaf: int = 400
    spill: float = 0.08
    levels: int = 6
    sample: int = 2048
    rounds: int = 12
    tight: float = 0.05
    block: int = 2048
    seed: int = 5


def usable(vectors: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """(cid, vec, label, n): classes of identical vectors that may link, with their ids' number.

    Left out are null ids, labels and vectors, vectors with a null or non-finite
    component, and zero vectors. ``cid`` is the smallest id of the class.
    """
    bad = F.exists("vec", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    some = F.exists("vec", lambda x: x != 0)
    rows = vectors.select(
        F.col(id_col).alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vec"), F.col(label_col).alias("label")
    )
    return (
        rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("vec").isNotNull())
        .where(~F.coalesce(bad, F.lit(True)) & F.coalesce(some, F.lit(False)))
        .groupBy("label", "vec")
        .agg(F.min("vec_id").alias("cid"), F.countDistinct("vec_id").alias("n"))
    )


def _directions(node: int, count: int, width: int, seed: int) -> np.ndarray:
    rng = np.random.default_rng([seed, node & 0xFFFFFFFF, (node >> 32) & 0xFFFFFFFF])
    return rng.standard_normal((count, width))


def _unit(vectors: pd.Series) -> np.ndarray:
    x = np.vstack(vectors.to_numpy()).astype(np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def fit_subtree(x: np.ndarray, directions: np.ndarray, levels: int, spill: float) -> np.ndarray:
    """(low, high) of the spill band of each inner node of a subtree, in heap order."""
    band = np.zeros((2**levels - 1, 2))
    inside = {0: np.arange(len(x))}
    for node in range(2**levels - 1):
        rows = inside.pop(node)
        if not len(rows):
            rows = np.arange(len(x))
        along = x[rows] @ directions[node]
        low, mid, high = np.quantile(along, [0.5 - spill, 0.5, 0.5 + spill])
        band[node] = low, high
        if 2 * node + 2 < 2**levels - 1:
            inside[2 * node + 1], inside[2 * node + 2] = rows[along <= mid], rows[along > mid]
    return band


def route(x: np.ndarray, directions: np.ndarray, band: np.ndarray, levels: int) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers and leaf numbers of a subtree; a row in a band goes both ways."""
    rows, nodes = np.arange(len(x)), np.zeros(len(x), np.int64)
    along = x @ directions.T
    for _ in range(levels):
        here = along[rows, nodes]
        left, right = here <= band[nodes, 1], here > band[nodes, 0]
        left |= ~right
        rows, nodes = (
            np.concatenate([rows[left], rows[right]]),
            np.concatenate([2 * nodes[left] + 1, 2 * nodes[right] + 2]),
        )
    return rows, nodes - (2**levels - 1)


def _sampled(points: DataFrame, sizes: DataFrame, rows: int, forest: Forest) -> DataFrame:
    """A share of each node's points by a hash: about ``rows`` of them, all if fewer."""
    chance = F.pmod(F.xxhash64("cid", "node", F.lit(forest.seed)), F.lit(1 << 20)) / float(1 << 20)
    return points.join(sizes, "node").where(chance * F.col("size") <= rows)


def _tight(points: DataFrame, sizes: DataFrame, forest: Forest, least: float) -> DataFrame:
    """(node): the nodes of which so large a share of pairs links that comparing all is worth it.

    A split of such a node parts vectors that link, and its leaves can't hold all links.
    """

    def judge(batch: pd.DataFrame) -> pd.DataFrame:
        x = _unit(batch["vec"])
        near = (x @ x.T >= least).sum() - len(x)
        held = near >= forest.tight * len(x) * (len(x) - 1)
        return pd.DataFrame({"node": batch["node"].iloc[:1] if held else []}, dtype="int64")

    some = _sampled(points, sizes, min(forest.sample, 1024), forest).select("node", "vec")
    return stage(some.groupBy("node").applyInPandas(judge, "node long"), "tight")


def _split(points: DataFrame, sizes: DataFrame, forest: Forest) -> DataFrame:
    """Route the points of nodes that are too large through a subtree fitted to each node."""
    shrink = log2(1 / (0.5 + forest.spill))
    levels = F.least(F.ceil(F.log2(F.col("size") / forest.leaf) / shrink), F.lit(forest.levels)).cast("int")
    tall = sizes.select("node", F.greatest(levels, F.lit(1)).alias("levels"), "size")
    sample = _sampled(points, tall, forest.sample, forest)

    def fit(batch: pd.DataFrame) -> pd.DataFrame:
        node, depth = int(batch["node"].iloc[0]), int(batch["levels"].iloc[0])
        x = _unit(batch["vec"])
        lines = _directions(node, 2**depth - 1, x.shape[1], forest.seed)
        band = fit_subtree(x, lines, depth, forest.spill)
        return pd.DataFrame({"node": [node], "levels": [depth], "band": [band.ravel()]})

    subtrees = sample.select("node", "levels", "vec").groupBy("node").applyInPandas(
        fit, "node long, levels int, band array<double>"
    )

    def move(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for node, part in batch.groupby("node", sort=False):
                depth = int(part["levels"].iloc[0])
                x = _unit(part["vec"])
                lines = _directions(int(node), 2**depth - 1, x.shape[1], forest.seed)
                rows, leaf = route(x, lines, part["band"].iloc[0].reshape(-1, 2), depth)
                moved = part[["node", "cid", "label", "vec", "n"]].iloc[rows]
                yield moved.assign(leaf=leaf)

    schema = points.select("node", "cid", "label", "vec", "n").schema.add("leaf", "long")
    routed = points.join(stage(subtrees, "subtrees"), "node").mapInPandas(move, schema)
    return routed.select(F.xxhash64("node", "leaf").alias("node"), "cid", "label", "vec", "n")


def leaves(classes: DataFrame, forest: Forest, least: float) -> DataFrame:
    """(node, cid): in which leaves of the forest each class stands.

    Trees begin at a label and a dimension. Nodes above the leaf size are split round by
    round, so that the depth follows the data; nodes that are tight or do not get smaller
    are cut into blocks, and all pairs of blocks become leaves. A root that is tight is so
    for one tree, and the others leave it out.
    """
    root = [F.xxhash64("label", F.size("vec"), F.lit(t)) for t in range(forest.trees)]
    done: list[DataFrame] = []
    whole = classes.select(root[0].alias("node"), "cid", "label", "vec", "n")
    sizes = stage(whole.groupBy("node").agg(F.count(F.lit(1)).alias("size")), "sizes")
    large = sizes.where(F.col("size") > forest.leaf)
    if large.limit(1).count():
        tight = _tight(whole, large, forest, least)
        if tight.limit(1).count():
            done.append(_blocks(whole.join(tight, "node", "left_semi"), forest.block))
            classes = stage(whole.join(tight, "node", "left_anti").drop("node"), "classes")
    points = classes.select(F.explode(F.array(*root)).alias("node"), "cid", "label", "vec", "n")
    for turn in range(forest.rounds):
        if turn:
            points = stage(points, "points")
        sizes = stage(points.groupBy("node").agg(F.count(F.lit(1)).alias("size")), "sizes")
        large = sizes.where(F.col("size") > forest.leaf)
        done.append(points.join(large, "node", "left_anti").select("node", "cid"))
        if not large.limit(1).count():
            break
        if turn:
            tight = _tight(points, large, forest, least)
            if tight.limit(1).count():
                done.append(_blocks(points.join(tight, "node", "left_semi"), forest.block))
                large = stage(large.join(tight, "node", "left_anti"), "sizes")
        points = _split(points.join(large.select("node"), "node", "left_semi"), large, forest)
    else:
        done.append(_blocks(points, forest.leaf))
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


def _blocks(points: DataFrame, size: int) -> DataFrame:
    """Leaves of about ``size`` for nodes that are not split: every pair of blocks of their points."""
    points = stage(points, "points")
    sizes = points.groupBy("node").agg(F.ceil(2 * F.count(F.lit(1)) / size).cast("int").alias("k"))
    own = F.pmod(F.xxhash64("cid"), F.col("k")).cast("int")
    each = points.join(sizes, "node").select(
        "node", "cid", own.alias("own"), F.explode(F.sequence(F.lit(0), F.col("k") - 1)).alias("other")
    )
    return each.select(
        F.xxhash64("node", F.least("own", "other"), F.greatest("own", "other")).alias("node"), "cid"
    )


def compare_leaf(
    x: np.ndarray, n: np.ndarray, earlier: np.ndarray, least: float
) -> tuple[np.ndarray, np.ndarray]:
    """Links of a leaf's vectors that no earlier leaf has, and the smallest row each one reaches.

    ``earlier`` tells which rows stand in which of the leaves that come first; a pair that
    meets in one of them is counted there.
    """
    close = x @ x.T >= least
    np.fill_diagonal(close, False)
    fresh = close & (earlier @ earlier.T == 0)
    links = fresh @ n
    reach = np.arange(len(x))
    while True:
        lower = np.minimum(reach, np.where(close, reach[None, :], len(x)).min(axis=1, initial=len(x)))
        lower = lower[lower]
        if (lower == reach).all():
            return links, reach
        reach = lower


def near_vectors(
    vectors: DataFrame,
    *,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    least: float = 0.93,
    forest: Forest | None = None,
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of ``vectors``.

    Vectors link if their labels are equal and their cosine, in double precision, is at
    least ``least``; pairs are sought within the leaves of the forest and verified there.
    Identical vectors are one class: they link with each other, and one of them stands for
    all. A leaf returns one row per member, never pairs.

    Vectors that are null, zero or hold null or non-finite components, and rows with a null
    id or label, link with nothing and are kept. A repeated id with the same vector is one
    vector with as many rows; vectors of different length never link.
    """
    forest = forest or Forest()
    classes = stage(usable(vectors, id_col, vector_col, label_col), "classes")
    stands = leaves(classes, forest, least)
    where = stands.groupBy("cid").agg(F.sort_array(F.collect_set("node")).alias("leaves"))
    spread = classes.join(where, "cid").select("*", F.explode("leaves").alias("node"))

    def compare(batch: pd.DataFrame) -> pd.DataFrame:
        node = batch["node"].iloc[0]
        before: dict[int, int] = {}
        cells = [
            (row, before.setdefault(other, len(before)))
            for row, all_of_row in enumerate(batch["leaves"])
            for other in all_of_row
            if other < node
        ]
        earlier = np.zeros((len(batch), max(len(before), 1)), np.float32)
        if cells:
            earlier[tuple(np.array(cells).T)] = 1
        links, reach = compare_leaf(_unit(batch["vec"]), batch["n"].to_numpy(), earlier, least)
        cid = batch["cid"].to_numpy()
        return pd.DataFrame({"cid": cid, "links": links, "other": cid[reach]})

    id_type = vectors.schema[id_col].dataType.simpleString()
    met = stage(
        spread.select("node", "cid", "vec", "n", "leaves")
        .groupBy("node")
        .applyInPandas(compare, f"cid {id_type}, links long, other {id_type}"),
        "links",
    )
    totals = met.groupBy("cid").agg(F.sum("links").alias("links"))
    linked = components(met.select(F.col("cid").alias("a"), F.col("other").alias("b")))
    roots = (
        classes.join(totals, "cid", "left")
        .join(linked, F.col("cid") == F.col("node"), "left")
        .select("label", "vec", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("root", "cid").alias("component_id"))
    )
    rows = vectors.select(
        F.col(id_col).alias("vec_id"), F.col(vector_col).cast("array<double>").alias("_vec"), F.col(label_col).alias("_label")
    )
    own = (F.col("_label") == F.col("label")) & (F.col("_vec") == F.col("vec")) & F.col("vec_id").isNotNull()
    found = rows.join(roots, own, "left")
    return found.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"),
        F.col("vec_id").eqNullSafe(F.coalesce("component_id", "vec_id")).alias("kept"),
    )
