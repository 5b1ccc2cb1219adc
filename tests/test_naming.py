import random

import numpy as np
import pytest
from helpers import make_workspace, unique_model

from chatloom.operators import naming, stepmaps
from chatloom.operators.sequence import global_index, ordinal, position_in_group, previous, running_total
from chatloom.plans.options import JobOptions
from pyspark.sql import functions as F

FIXED = [
    ["a", "a-1", "a", "a", "a-1", "a-1-1", "a-1", "a"],
    ["user"] * 4 + ["user-2", "user-1", "user", "user-2"],
    ["a-1", "a", "a", "a-2", "a", "a-1-1", "a-1"],
    ["x-01", "x", "x", "x-1", "x-0", "x-0"],
    ["!!!", "!!!", "", "", "Default Slug"],
]


def draw(rng):
    stems = ["a", "b", "a-1", "a-2", "a-1-1", "b-1", "a-3", "a-1-2", "b-10", "a-1-1-1"]
    return [rng.choice(stems[: rng.randint(1, len(stems))]) for _ in range(rng.randint(1, 40))]


def test_unique_slugs_equals_walk_in_order(spark):
    rng = random.Random(5)
    lists = FIXED + [draw(rng) for _ in range(150)]
    rows = [(scope, i, name) for scope, names in enumerate(lists) for i, name in enumerate(names)]
    df = spark.createDataFrame(rows, "scope int, i bigint, name string")
    got = naming.unique_slugs(df, "name", "i", ["scope"]).collect()
    result = {}
    for row in got:
        result.setdefault(row.scope, {})[row.i] = row.slug
    for scope, names in enumerate(lists):
        assert [result[scope][i] for i in range(len(names))] == unique_model(names), names


def alternating(n):
    """A base and its numbers in turn, so that each number's owner hangs on those below it."""
    return [name for k in range(1, n + 1, 2) for name in ("u", f"u-{k + 1}", f"u-{k}")]


def rounds(spark, monkeypatch, names):
    """Check the names against the model and count the staged tables."""
    staged = []
    for name in ("stage", "stage_counted"):
        plain = getattr(naming, name)
        monkeypatch.setattr(naming, name, lambda *a, _plain=plain: (staged.append(1), _plain(*a))[1])
    df = spark.createDataFrame(list(enumerate(names)), "i bigint, name string")
    got = {r.i: r.slug for r in naming.unique_slugs(df, "name", "i").collect()}
    monkeypatch.undo()
    assert [got[i] for i in range(len(names))] == unique_model(names)
    return len(staged)


def test_rounds_do_not_grow_with_rivals(spark, monkeypatch):
    assert rounds(spark, monkeypatch, alternating(3000)) == rounds(spark, monkeypatch, alternating(50)) <= 8


def test_nested_names_take_few_rounds(spark, monkeypatch):
    chain = ["a" + "-1" * depth for depth in range(30)]
    names = chain[::2] + chain[::-1] + chain[1::2] + chain
    assert rounds(spark, monkeypatch, names) <= 12


@pytest.mark.parametrize("span", [2, 8, 64])
def test_numbers_solved_in_several_spans(spark, monkeypatch, span):
    monkeypatch.setattr(naming, "SPAN", span)
    rng = random.Random(span)
    names = [rng.choice(["u", "u", "u", f"u-{rng.randint(1, 90)}", "u-1-1", "v", f"v-{rng.randint(1, 9)}"]) for _ in range(300)]
    # "u-7" itself starts at suffix 1 where "u" has taken the name before.
    names += [f"u-7-{rng.randint(1, 20)}" for _ in range(40)] + ["u-7"] * 12
    df = spark.createDataFrame(list(enumerate(names)), "i bigint, name string")
    got = {r.i: r.slug for r in naming.unique_slugs(df, "name", "i").collect()}
    assert [got[i] for i in range(len(names))] == unique_model(names)


def test_rounds_do_not_grow_with_spans(spark, monkeypatch):
    monkeypatch.setattr(naming, "SPAN", 64)
    few, many = rounds(spark, monkeypatch, alternating(200)), 0
    monkeypatch.setattr(naming, "SPAN", 64)
    many = rounds(spark, monkeypatch, alternating(3000))
    assert few == many <= 10


def walked(bounds, count):
    before = []
    for bound in bounds:
        before.append(count)
        count += count < bound
    return before, count


@pytest.mark.parametrize("seed", range(5))
def test_composed_steps_equal_a_walk(seed):
    rng = np.random.default_rng(seed)
    for _ in range(60):
        lengths = rng.integers(1, 40, rng.integers(1, 8))
        high = int(rng.integers(1, 60))
        bounds = rng.integers(0, high, lengths.sum())
        if rng.random() < 0.4:
            bounds = np.clip(np.arange(len(bounds)) - rng.integers(0, 5, len(bounds)), 0, None)
        top = int(bounds.max()) + 1 + len(bounds)
        first = np.cumsum(lengths) - lengths
        for chosen, rows, padded in stepmaps.sequences(bounds, first):
            maps = stepmaps.levels(padded, top)
            start = rng.integers(0, high + 3, len(chosen))
            before = stepmaps.counts_before(maps, start).reshape(rows.shape)
            for k, at in enumerate(chosen):
                steps = bounds[first[at] : first[at] + lengths[at]]
                want, end = walked(steps.tolist(), int(start[k]))
                assert before[k][rows[k] >= 0].tolist() == want
                assert start[k] + (maps[-1][k] > start[k]).sum() == end


def test_unique_slugs_without_rivals(spark):
    names = [f"Name {i % 7}!" for i in range(100)]
    df = spark.createDataFrame(list(enumerate(names)), "i bigint, name string")
    got = {r.i: r.slug for r in naming.unique_slugs(df, "name", "i").collect()}
    assert [got[i] for i in range(100)] == unique_model(names)


def test_maps_keep_last_of_repeated_names(spark):
    ws = make_workspace(
        spark,
        users=[(0, "Ann", "a@x.y", "A"), (1, "ann", "b@x.y", "B"), (2, "Ann", "c@x.y", "C")],
        teams=[(0, "T", "T", ""), (1, "T", "T2", "")],
        channels=[(0, 0, "T", "Gen", "G", False), (0, 1, "T", "gen", "G", False), (1, 0, "T", "Gen", "G", False)],
    )
    users = {r.username: r.slug for r in naming.user_slugs(ws, JobOptions()).collect()}
    assert users == {"Ann": "ann-2", "ann": "ann-1"}
    assert [(r.team_name, r.team_slug) for r in naming.team_slugs(ws).collect()] == [("T", "t-1")]
    channels = {r.channel_name: r.channel_slug for r in naming.channel_slugs(ws).collect()}
    assert channels == {"Gen": "gen", "gen": "gen-1"}


@pytest.mark.parametrize("chunk", [1, 3, 1000])
def test_chunked_totals(spark, chunk):
    rng = random.Random(chunk)
    rows = [(rng.choice("ab"), i, rng.randint(0, 9)) for i in rng.sample(range(200), 60)]
    df = spark.createDataFrame(rows, "k string, i bigint, v int")
    got = running_total(df, ["k"], "i", F.col("v"), "s", chunk=chunk).collect()
    below = running_total(df, ["k"], "i", F.col("v"), "s", chunk=chunk, inclusive=False).collect()
    ranks = ordinal(df, ["k"], "i", "n", chunk=chunk).collect()
    for k, i, v in rows:
        upto = [x for x in rows if x[0] == k and x[1] <= i]
        assert [r.s for r in got if (r.k, r.i) == (k, i)] == [sum(x[2] for x in upto)]
        assert [r.s for r in below if (r.k, r.i) == (k, i)] == [sum(x[2] for x in upto) - v]
        assert [r.n for r in ranks if (r.k, r.i) == (k, i)] == [len(upto)]


def test_previous_across_chunks(spark):
    rows = [("a", i, i * i) for i in (1, 2, 9, 10, 31, 55)] + [("b", 4, 1)]
    df = spark.createDataFrame(rows, "k string, i bigint, v bigint")
    got = previous(df, ["k"], ["i"], F.floor(F.col("i") / 5), {"v": "pv"}).collect()
    assert {(r.k, r.i): r.pv for r in got} == {
        ("a", 1): None, ("a", 2): 1, ("a", 9): 4, ("a", 10): 81, ("a", 31): 100, ("a", 55): 961, ("b", 4): None,
    }


def test_global_and_group_positions(spark):
    rows = [(i * 7919 % 1000, i % 3) for i in range(1000)]
    df = spark.createDataFrame(rows, "v bigint, g int").repartition(7)
    assert all(r.n == r.v for r in global_index(df, ["v"], "n").collect())
    placed = position_in_group(df, ["g"], ["v"], "n").collect()
    for g in range(3):
        values = sorted(v for v, h in rows if h == g)
        assert {r.v: r.n for r in placed if r.g == g} == {v: n for n, v in enumerate(values)}
