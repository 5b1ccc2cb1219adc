import random

from helpers import keyed, make_workspace, post, root_model

from chatloom.operators import naming, render, threads
from chatloom.plans.options import JobOptions

OPTS = JobOptions()


def roots_of(spark, graphs):
    rows = [(0, c, key, parent) for c, g in enumerate(graphs) for key, parent in g.items()]
    links = spark.createDataFrame(rows, "t_idx bigint, c_idx bigint, source_key string, parent string")
    return {(r.c_idx, r.source_key): r.root for r in threads.thread_roots(links).collect()}


def test_roots_equal_walk_on_random_graphs(spark):
    rng = random.Random(11)
    graphs = [
        {"a": "a"},
        {"a": "b", "b": "a"},
        {"a": "b", "b": "c", "c": "a", "d": "a", "e": "d", "f": "gone"},
        {"x": "missing", "y": "x", "z": "y"},
    ]
    for _ in range(300):
        n = rng.randint(1, 14)
        names = [f"k{i}" for i in range(n + 2)]
        graphs.append({f"k{i}": rng.choice(names) for i in range(n) if rng.random() < 0.85})
    got = roots_of(spark, graphs)
    for c, graph in enumerate(graphs):
        for key in graph:
            assert got[c, key] == root_model(graph, key), graph


def test_deep_chain_and_long_circle(spark):
    chain = {f"p{i}": f"p{i - 1}" for i in range(1, 1500)}
    ring = {f"r{i}": f"r{(i + 1) % 300}" for i in range(300)}
    tail = {f"t{i}": f"t{i - 1}" for i in range(1, 200)} | {"t0": "r17"}
    got = roots_of(spark, [chain, ring | tail])
    assert {got[0, k] for k in chain} == {"p0"}
    assert all(got[1, k] == root_model(ring | tail, k) for k in ring | tail)


def channel(spark, posts):
    return make_workspace(
        spark,
        users=[(0, "john-doe", "j@x.y", "J")],
        teams=[(0, "it-team", "IT", "")],
        channels=[(0, 0, "it-team", "general", "General", False)],
        posts=posts,
    )


def rendered(spark, ws):
    rows = render.render_posts(ws, render.build_maps(ws, OPTS), OPTS).collect()
    return {r.p_idx: r for r in rows}


def test_chain_shares_one_root_id(spark):
    ws = channel(
        spark,
        [
            post(0, "john-doe", "one", 1000, "p1"),
            post(1, "john-doe", "two", 2000, "p2", "p1"),
            post(2, "john-doe", "three", 3000, "p3", "p2"),
        ],
    )
    rows = rendered(spark, ws)
    assert rows[1].id == "post-5b179d9564db"
    assert rows[0].root_id is None
    assert rows[1].root_id == rows[2].root_id == rows[0].id


def test_keys_orphans_and_order(spark):
    ws = channel(
        spark,
        [
            post(0, "john-doe", "late root", 5000, "b"),
            post(1, "john-doe", "reply to nothing", 1500, "o", "gone"),
            post(2, "john-doe", "early root", 1000, "a"),
            post(3, "john-doe", "reply late", 9000, "a2", "a"),
            post(4, "john-doe", "no id", 2000, None),
            post(5, "john-doe", "self", 2500, "s", "s"),
        ],
    )
    threaded = threads.with_threads(ws.posts, OPTS)
    order = [r.p_idx for r in threaded.orderBy(*threads.thread_sort_columns()).collect()]
    assert order == [2, 3, 1, 4, 5, 0]
    keys = {r.p_idx: r.source_key for r in threaded.collect()}
    assert keys[4] == "source-post-" + keyed("it-team|general|4|2000|john-doe|no id")
    orphans = {r.post_id for r in threads.orphan_replies(threaded).collect()}
    assert orphans == {"o", "s"}
    assert all(r.root_id is None for i, r in rendered(spark, ws).items() if i != 3)


def test_repeated_ids_share_the_last_parent(spark):
    ws = channel(
        spark,
        [
            post(0, "john-doe", "a", 1000, "a"),
            post(1, "john-doe", "b", 1100, "b"),
            post(2, "john-doe", "first copy", 1200, "x", "a"),
            post(3, "john-doe", "second copy", 1300, "x", "b"),
        ],
    )
    rows = rendered(spark, ws)
    assert rows[2].id == rows[3].id
    assert rows[2].root_id == rows[3].root_id == rows[1].id


def test_resolve_unknown_author(spark):
    ws = channel(spark, [post(0, "No Body!", "hi", 1)])
    slugs = naming.user_slugs(ws, OPTS)
    row = naming.resolve_username(ws.posts, "username", slugs, OPTS, "u").first()
    assert row.u == "no-body"
