"""Large groups of near copies in the forest against brute force."""

import numpy as np

from chatloom.llm import vector_dedup


def mutual(rng, count, width=32):
    """Vectors around one direction, nearly all within 0.93 of each other."""
    near = np.eye(width)[0] + rng.standard_normal((count, width)) * 0.035
    return near / np.linalg.norm(near, axis=1, keepdims=True)


def recall(spark, x):
    links = (x @ x.T >= 0.93).sum(axis=1) - 1
    rows = [(i, v, 0) for i, v in enumerate(x.tolist())]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = vector_dedup.near_vectors(df).toPandas().set_index("vec_id").sort_index()
    assert (got["n_links"].to_numpy() <= links).all()
    return got["n_links"].sum() / links.sum(), got, links


def test_a_mutual_group_is_compared_whole(spark):
    x = mutual(np.random.default_rng(8), 3000)
    share, got, links = recall(spark, x)
    assert share == 1 and (got["n_links"].to_numpy() == links).all()
    assert set(got["component_id"]) == {0}


def test_a_mutual_group_among_others(spark):
    rng = np.random.default_rng(9)
    others = rng.standard_normal((3000, 32))
    others /= np.linalg.norm(others, axis=1, keepdims=True)
    share, _, _ = recall(spark, np.vstack([mutual(rng, 2000), others]))
    print("recall among others", share)
    assert share >= 0.99
