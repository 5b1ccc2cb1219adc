"""Deduplication operators against plain-Python versions on awkward rows."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from chatloom.llm import components, exact_dedup, line_dedup, simhash, suffix_dedup, vector_dedup

from llm_rows import AWKWARD

WHITE = re.compile(r"[\x20\x09-\x0D]")


def covered(texts, length):
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[i : i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        mark = bytearray(len(d))
        for i in range(len(d) - length + 1):
            if seen[d[i : i + length]] > 1:
                mark[i : i + length] = b"\1" * length
        out.append((len(d), [m.span() for m in re.finditer(b"\1+", bytes(mark))]))
    return out


def spans_of(df):
    rows = df.select("doc_id", "n_bytes", "spans").collect()
    return Counter((r.doc_id, r.n_bytes, tuple((s.start, s.end) for s in r.spans)) for r in rows)


def expected_spans(rows, length):
    return Counter(
        (row[0], n, tuple(spans)) for row, (n, spans) in zip(rows, covered([r[1] for r in rows], length), strict=True)
    )


def test_suffixes_awkward(awkward):
    assert spans_of(suffix_dedup.remove_repeats(awkward)) == expected_spans(AWKWARD, 400)


def test_suffixes_random(make_docs, monkeypatch):
    rng = random.Random(3)
    words = [bytes(rng.choice(b"abcd") for _ in range(rng.randint(5, 40))).decode() for _ in range(12)]
    rows = [(i, "".join(rng.choice(words) for _ in range(rng.randint(0, 25)))) for i in range(60)]
    shape = suffix_dedup.Shape(length=60, gram=30)
    want = expected_spans(rows, 60)
    assert spans_of(suffix_dedup.remove_repeats(make_docs(rows), shape=shape)) == want
    monkeypatch.setattr(suffix_dedup, "GROUP_LIMIT", 1)
    assert spans_of(suffix_dedup.remove_repeats(make_docs(rows), shape=shape)) == want


def test_suffixes_of_one_id_with_equal_short_hashes(spark, make_docs):
    repeated, other = ("".join(chr(97 + i * k % 26) + str(i) for i in range(200)) for k in (3, 7))
    number = F.lpad(F.col("id").cast("string"), 6, "0")
    a, b = (spark.range(300_000).select(F.concat(number, F.lit(t)).alias(n)) for t, n in ((repeated, "a"), (other, "b")))
    pair = a.join(b, F.hash("a") == F.hash("b")).first()
    rows = [(1, pair.a), (1, pair.b), (2, "z" + repeated)]
    assert spans_of(suffix_dedup.remove_repeats(make_docs(rows))) == expected_spans(rows, 400)


def test_suffixes_empty(none):
    assert suffix_dedup.remove_repeats(none).count() == 0


def test_intervals_and_maximal_repeats():
    assert sorted(suffix_dedup.prefix_intervals([0, 3, 5, 2], 1)) == [(2, 0, 3), (3, 0, 2), (5, 1, 2)]
    # Left contexts are reversed: "xab" before the gram is b"bax".
    lefts = [b"ba", b"ba", b"ca"]
    suffixes = [b"GRAMzz", b"GRAMzy", b"GRAMqq"]
    reached, repeats = suffix_dedup.scan_group(lefts, suffixes, 4, 0, listed=True)
    found = {(r.left, r.right, frozenset(r.members)) for r in repeats}
    assert found == {(2, 5, frozenset({0, 1})), (0, 4, frozenset({0, 1, 2}))}
    assert reached.tolist() == [[2, 1], [2, 1], [0, 0]]


def test_exact(awkward, none):
    got = exact_dedup.exact_groups(awkward).collect()
    groups = {}
    for row in AWKWARD:
        groups.setdefault(WHITE.sub("", row[1] or ""), []).append(row)
    assert len(got) == len(AWKWARD)
    by_sha = {}
    for r in got:
        by_sha.setdefault(r.text_sha256, []).append(r)
    for norm, rows in groups.items():
        mine = by_sha[hashlib.sha256(norm.encode()).hexdigest()]
        best = min(rows, key=lambda r: (-len(r[1] or ""), r[0] is None, r[0] or 0))
        assert {r.keep_id for r in mine} == {best[0]}
        assert {r.group_size for r in mine} == {len(rows)} == {len(mine)}
        assert [r.doc_id for r in mine if r.kept] == [best[0]]
    assert exact_dedup.exact_groups(none).count() == 0


def test_exact_copies_over_partitions(spark, make_docs):
    rows = [(i, "same text" + " " * (i % 3)) for i in range(400)] + [(1000 + i, f"own {i}") for i in range(50)]
    got = exact_dedup.exact_groups(make_docs(rows))
    copies = [r for r in got.collect() if r.doc_id < 400]
    assert {(r.keep_id, r.group_size) for r in copies} == {(2, 400)}
    assert [r.doc_id for r in copies if r.kept] == [2]


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def lines_model(rows, least):
    key = lambda line: lower(line.strip(" \t\n\x0b\x0c\r"))
    where = {}
    for row in set(rows):
        for line in (row[1] or "").split("\n"):
            where.setdefault(key(line), set()).add(row[:2])
    out = Counter()
    for row in rows:
        lines = (row[1] or "").split("\n")
        kept = [x for x in lines if not key(x) or len(where[key(x)]) < least]
        out[(row[0], len(lines), len(lines) - len(kept), "\n".join(kept))] += 1
    return out


@pytest.mark.parametrize("hot", [True, False])
def test_lines(make_docs, monkeypatch, hot):
    if hot:
        monkeypatch.setattr(line_dedup, "_SAMPLE_SHARE", 1.0)
        monkeypatch.setattr(line_dedup, "_HOT_SEEN", 2)
    rng = random.Random(5)
    common = ["Read more", " read MORE\t", "Ä b", "x", "", "  ", "a|b"]
    rows = [(i, "\n".join(rng.choice([*common, f"own {i}"]) for _ in range(rng.randint(0, 9)))) for i in range(40)]
    rows += [row[:2] for row in AWKWARD]
    got = line_dedup.drop_common_lines(make_docs(rows), min_docs=3)
    seen = Counter((r.doc_id, r.n_lines, r.n_dropped, r.kept) for r in got.select("doc.doc_id", "n_lines", "n_dropped", "kept").collect())
    assert seen == lines_model(rows, 3)


def test_lines_first_stays_and_empty(make_docs, none):
    rows = [(i, f"head {i}\nshared line\nshared line") for i in range(5)]
    got = line_dedup.drop_common_lines(make_docs(rows), min_docs=2, keep_first=True)
    assert {r.doc_id: r.n_dropped for r in got.select("doc.doc_id", "n_dropped").collect()} == {0: 1, 1: 2, 2: 2, 3: 2, 4: 2}
    assert line_dedup.drop_common_lines(none).count() == 0


def print_model(text):
    words = lower(text or "").encode()
    words = words.split()
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def roots_of(nodes, edges):
    up = {n: n for n in nodes}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_simhash(awkward, none):
    got = simhash.near_duplicates(awkward).select("doc_id", simhash.fingerprint_hex(F.col("fp")).alias("h"), "component_id").collect()
    prints = [(row[0], print_model(row[1])) for row in AWKWARD]
    assert Counter((r.doc_id, r.h) for r in got) == Counter((i, f"{p:016x}") for i, p in prints)
    values = sorted({p for _, p in prints})
    close = [(a, b) for a in values for b in values if a < b and (a ^ b).bit_count() <= 3]
    root = roots_of(values, close)
    low = {}
    for i, p in prints:
        if i is not None:
            low[root[p]] = min(i, low.get(root[p], i))
    assert Counter((r.doc_id, r.component_id) for r in got) == Counter((i, low.get(root[p])) for i, p in prints)
    assert simhash.near_duplicates(none).count() == 0


def test_pigeonhole_finds_every_pair(spark):
    rng = random.Random(9)
    values = {rng.getrandbits(64) for _ in range(150)}
    for v in list(values):
        for _ in range(3):
            w = v
            for b in rng.sample(range(64), rng.randint(1, 5)):
                w ^= 1 << b
            values.add(w)
    signed = {v: v - (1 << 64) if v >> 63 else v for v in values}
    got = simhash.near_pairs(spark.createDataFrame([(v,) for v in signed.values()], "fp long")).distinct().collect()
    items = sorted(values)
    want = {
        tuple(sorted((signed[a], signed[b]))) for i, a in enumerate(items) for b in items[i + 1 :] if (a ^ b).bit_count() <= 3
    }
    assert {(r.a, r.b) for r in got} == want
    for rows in (10, 10**6, 10**10):
        parts = simhash.plan_parts(list(signed.values()), rows, 3)
        assert sum(p.threshold + 1 for p in parts) == 4


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, x) for x in range(101, 160)] + [(7, 7), (200, 201), (None, 3)]
    got = components.components(spark.createDataFrame(edges, "a long, b long")).collect()
    want = {i: 0 for i in range(41)} | {i: 100 for i in range(100, 160)} | {200: 200, 201: 200}
    assert {r.node: r.root for r in got} == want


def vectors(spark):
    rng = np.random.default_rng(2)
    base = rng.standard_normal((40, 16))
    rows = []
    for i in range(400):
        v = base[i % 40] + rng.standard_normal(16) * rng.choice([0.0, 0.05, 0.3])
        rows.append((i, [float(x) for x in v.astype(np.float32)], int(i % 3)))
    rows += [
        (500, None, 1), (501, [0.0] * 16, 1), (502, [float("nan")] * 16, 1), (503, [None] * 16, 1), (504, [float("inf")] * 16, 1),
        (505, rows[0][1], None), (506, [1.0, 2.0], 0), (507, [2.0, 4.0], 0), (None, rows[0][1], 0), (508, [], 1), (1, rows[1][1], 1),
    ]
    return rows, spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")


def test_vectors(spark):
    rows, df = vectors(spark)
    got = {}
    for r in vector_dedup.near_vectors(df, forest=vector_dedup.Forest(trees=6, leaf=40)).collect():
        got[r.vec_id] = r
    good = {
        i: (np.array(v, float), lab)
        for i, v, lab in rows
        if i is not None and lab is not None and v and None not in v and np.isfinite(v).all() and any(v)
    }
    pairs = {
        (a, b)
        for a in good for b in good
        if a < b and good[a][1] == good[b][1] and len(good[a][0]) == len(good[b][0])
        and good[a][0] @ good[b][0] / np.linalg.norm(good[a][0]) / np.linalg.norm(good[b][0]) >= 0.93
    }
    found = sum(r.n_links for r in got.values())
    assert 0.9 * 2 * len(pairs) <= found <= 2 * len(pairs)
    for i in (500, 501, 502, 503, 504, 505, 508):
        assert (got[i].n_links, got[i].component_id, got[i].kept) == (0, i, True)
    assert got[506].n_links == got[507].n_links == 1
    assert got[507].component_id == 506 and not got[507].kept
    assert vector_dedup.near_vectors(df.limit(0)).count() == 0


def test_vectors_that_no_split_separates(spark):
    rows = [(i, [1.0, 1e-9 * i], 0) for i in range(60)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = vector_dedup.near_vectors(df, forest=vector_dedup.Forest(trees=2, leaf=10, rounds=0)).collect()
    assert {(r.n_links, r.component_id) for r in got} == {(59, 0)}
