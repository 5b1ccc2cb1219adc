"""The pipeline's near-duplicate stage against a brute-force version."""

import random

import numpy as np
import pytest

import corpus_pipeline
from chatloom.llm import shingle_dedup, simhash

from llm_rows import AWKWARD
from test_dedup import lower, roots_of


def shingles_of(text):
    words = lower(text or "").encode().split()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def similarity(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def kept_model(rows, least=0.8):
    sets = sorted({shingles_of(r[1]) for r in rows}, key=lambda s: sorted(s))
    close = [(i, j) for i in range(len(sets)) for j in range(i) if similarity(sets[i], sets[j]) >= least]
    root = roots_of(range(len(sets)), close)
    group = {s: root[i] for i, s in enumerate(sets)}
    low = {}
    for r in rows:
        g = group[shingles_of(r[1])]
        if r[0] is not None:
            low[g] = min(r[0], low.get(g, r[0]))
    return sorted([(r[0], r[1]) for r in rows if r[0] == low.get(group[shingles_of(r[1])])], key=repr)


def edited(rng, words, changes):
    out = list(words)
    for at in rng.sample(range(len(words)), changes):
        out[at] = f"new{rng.random()}"
    return out


def near_copies():
    """Originals of 300 words, each with copies of different similarity."""
    rng = random.Random(1)
    rows, alike = [], []
    for group in range(20):
        words = [f"g{group}w{rng.randrange(4000)}" for _ in range(300)]
        rows.append((group * 100, " ".join(words)))
        for k, changes in enumerate((1, 2, 3, 4, 5, 6, 7, 9, 14), 1):
            text = " ".join(edited(rng, words, changes))
            rows.append((group * 100 + k, text))
            alike.append(similarity(shingles_of(rows[-1][1]), shingles_of(" ".join(words))))
    return rows, alike


def test_stage_keeps_one_of_near_copies(spark, make_docs, tmp_path):
    rows, alike = near_copies()
    assert sum(0.8 <= a < 0.85 for a in alike) >= 10 and sum(0.9 <= a < 0.95 for a in alike) >= 10
    assert sum(a < 0.8 for a in alike) >= 20
    rows += [r[:2] for r in AWKWARD]
    docs = make_docs(rows)
    kept = corpus_pipeline.one_of_each(spark, docs, str(tmp_path))
    assert kept.columns == docs.columns
    assert sorted([(r.doc_id, r.text) for r in kept.collect()], key=repr) == kept_model(rows)


@pytest.mark.parametrize("up_to", [0, 16])
def test_chains_and_members_apart_from_the_first(make_docs, none, monkeypatch, up_to):
    """Steps of 0.85 whose ends are not alike, and small edits around other edits."""
    monkeypatch.setattr(shingle_dedup, "PAIRS_UP_TO", up_to)
    monkeypatch.setattr(shingle_dedup, "BLOCK", 8)
    rng = random.Random(4)
    words = [f"w{i}" for i in range(200)]
    rows = []
    for i in range(40):
        rows.append((i, " ".join(words)))
        words = edited(rng, words, 3)
    got = shingle_dedup.keep_one(make_docs(rows)).collect()
    assert sorted([(r.doc_id, r.text) for r in got], key=repr) == kept_model(rows)
    assert shingle_dedup.keep_one(none).count() == 0


def test_fingerprints_link_all_within_three_bits(make_docs):
    """Bands that no two sets share: what is linked, the fingerprints have found."""
    rng = random.Random(8)
    rows = []
    for group in range(12):
        words = [f"g{group}w{rng.randrange(4000)}" for _ in range(400)]
        rows.append((group * 100, " ".join(words)))
        rows += [(group * 100 + k, " ".join(edited(rng, words, 1 + k % 3))) for k in range(1, 12)]
    values = {r[0]: shingle_dedup.shingle_set(r[1]) for r in rows}
    prints = {k: simhash.fingerprint_of(v) & (2**64 - 1) for k, v in values.items()}
    sets = {r[0]: shingles_of(r[1]) for r in rows}
    close = [(i, j) for i in sets for j in sets if i < j and (prints[i] ^ prints[j]).bit_count() <= 3]
    root = roots_of(sets, [(i, j) for i, j in close if similarity(sets[i], sets[j]) >= 0.8])
    lows = {min(k for k in sets if root[k] == r) for r in root.values()}
    assert 12 <= len(lows) < 100
    none_shared = shingle_dedup.Bands(count=1, rows=5000)
    got = shingle_dedup.keep_one(make_docs(rows), bands=none_shared, distance=3).collect()
    assert sorted(r.doc_id for r in got) == sorted(lows)


@pytest.mark.parametrize("alike", [0.8, 0.9])
def test_bands_meet(alike):
    bands, rng = shingle_dedup.Bands(), np.random.default_rng(3)
    seeds, common = bands.seeds(), round(200 * 2 * alike / (1 + alike))
    for _ in range(300):
        pool = rng.integers(0, 1 << 63, 400 - common, dtype=np.uint64)
        a, b = np.sort(pool[:200]), np.sort(pool[200 - common :])
        x, y = (shingle_dedup.band_hashes(s, seeds, bands) for s in (a, b))
        assert (x == y).any()
