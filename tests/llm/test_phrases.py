"""Collocations against plain counts, and quotient filters against dictionaries."""

import re
from collections import Counter

import numpy as np
import pytest

from chatloom.llm import collocations
from chatloom.llm.collocations import Filter, Packing, Permutation

from llm_rows import AWKWARD


def plain(rows, least, inside, top):
    counts, total = {}, Counter()
    for lang, text in rows:
        lowered = re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")
        seen = counts.setdefault(lang or "und", Counter())
        for piece in re.split("[.,;:!?\n-\r]", lowered):
            words = re.findall("[^ \t]+", piece)
            total[lang or "und"] += len(words)
            for size in (1, 2, 3):
                seen.update(tuple(words[i : i + size]) for i in range(len(words) - size + 1))
    out = []
    for lang, f in counts.items():
        phrases = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        hidden = {
            part
            for p, longer in phrases.items()
            if len(p) == 3
            for part in (p[:2], p[1:])
            if 100 * longer >= inside * f[part]
        }
        rated = []
        for p, a in phrases.items():
            if p not in hidden:
                cuts = [(1_000_000 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p))]
                score, k = min(cuts)
                rated.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(rated)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, total[lang], -score))
    return sorted(out)


def texts(rng, n):
    words = ["New", "york", "city", "hall", "é", "Ünder", "x\x00y", "of", "the", "a-b", "..", "rare"]
    share = 1 / np.arange(1, len(words) + 1)
    rows = []
    for i in range(n):
        picked = rng.choice(words, rng.integers(0, 40), p=share / share.sum())
        text = "".join(w + rng.choice([" ", "\t", "  ", ". ", ", ", "\n", "\r"], p=[0.7, 0.05, 0.05, 0.05, 0.05, 0.05, 0.05]) for w in picked)
        rows.append((i, text if i % 17 else None, [None, "en", "en", "und", "de"][i % 5]))
    return rows


@pytest.fixture(scope="module")
def corpus(spark):
    rows = texts(np.random.default_rng(5), 400) + [(1, r[1], "xx") for r in AWKWARD]
    return spark.createDataFrame(
        [(*r, 1, "q") for r in rows], "doc_id long, text string, lang string, n long, word string"
    ).repartition(3), [(r[2], r[1]) for r in rows]


def as_rows(df):
    return sorted(tuple(r) for r in df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


def test_equal_to_plain_counts(corpus):
    docs, rows = corpus
    want = plain(rows, 10, 50, 2000)
    assert as_rows(collocations.collocations(docs)) == want and len(want) > 40


@pytest.mark.parametrize("shard_bytes, bits, top", [(600, None, 7), (5000, 24, 2000), (1 << 20, 40, 3)])
def test_shards_wide_keys_and_ties(corpus, shard_bytes, bits, top):
    docs, rows = corpus
    got = collocations.collocations(docs, shard_bytes=shard_bytes, bits=bits, top=top, least=3, inside=80)
    assert as_rows(got) == plain(rows, 3, 80, top)


def test_all_phrases_and_empty_tables(corpus):
    docs, rows = corpus
    got = collocations.collocations(docs, top=None).select("lang", "phrase", "score").collect()
    assert sorted(map(tuple, got)) == sorted((r[0], r[2], r[7]) for r in plain(rows, 10, 50, 10**9))
    assert collocations.collocations(docs.limit(0)).count() == 0
    assert collocations.collocations(docs.where("doc_id = 0")).count() == 0


def test_counts_beyond_64_bits_are_exact(spark):
    rows = [(10**9, 10**9 + 7, 10**9 + 9), (123_456_789_012, 223_456_789_012, 323_456_789_013), (7, 7, 7)]
    df = spark.createDataFrame(rows, "a long, l long, r long")
    got = df.select("a", collocations._score(df.a, df.l, df.r).alias("s")).collect()
    assert {r.a: r.s for r in got} == {a: 1_000_000 * a * a // (left * right) for a, left, right in rows}


@pytest.mark.parametrize("bits", [8, 13, 21, 22, 32, 42])
def test_keys_come_back_from_the_filter(bits):
    rng = np.random.default_rng(bits)
    ids = rng.integers(0, 1 << bits, (500, 3), dtype=np.uint64)[rng.integers(0, 500, 4000)]
    packing = Packing(bits)
    half, range_bits = packing.half, 3
    mixing = Permutation(half)
    high, low = mixing.there(*packing.pack(*ids.T))
    assert int(high.max()) >> half == 0 and int(low.max()) >> half == 0
    whole = Counter()
    for part in np.array_split(np.arange(4000), 5):
        counted = Filter.counting(high[part], low[part], half)
        back = [
            Filter.from_bytes(f.to_bytes(range_bits, half), owner, range_bits, half)
            for owner, f in counted.cut(range_bits, half)
        ]
        merged = Filter.merged(back, half)
        assert all((getattr(merged, x) == getattr(counted, x)).all() for x in ("high", "low", "counts"))
        words = packing.unpack(*mixing.back(merged.high, merged.low))
        whole.update(dict(zip(zip(*(w.tolist() for w in words), strict=True), merged.counts.tolist(), strict=True)))
    assert whole == Counter(map(tuple, ids.tolist()))


def test_large_counts_in_a_filter():
    half = Packing(8).half
    counts = np.array([254, 255, 256, 10**12])
    f = Filter(np.arange(4, dtype=np.uint64), np.arange(4, dtype=np.uint64), counts)
    back = Filter.from_bytes(f.to_bytes(1, half), 0, 1, half)
    assert back.counts.tolist() == counts.tolist() and back.low.tolist() == [0, 1, 2, 3]
