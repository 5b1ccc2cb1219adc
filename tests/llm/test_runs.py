"""Periodic runs against a plain search, and the transforms behind them."""

import hashlib
import re
import zlib

import numpy as np
import pytest

from chatloom.llm import periodic
from chatloom.llm.queries import op11_periodic_runs

from llm_rows import AWKWARD, LONG


def plain_runs(words, least=12):
    n, found = len(words), {}
    for period in range(1, n // 2 + 1):
        at = 0
        while at + period < n:
            if words[at] != words[at + period]:
                at += 1
                continue
            start = at
            while at + period < n and words[at] == words[at + period]:
                at += 1
            length = at + period - start
            if length >= max(least, 2 * period):
                found.setdefault((start, length), period)
    return sorted(((s, length, q) for (s, length), q in found.items()), key=lambda r: (r[0], r[2]))


def found(words, least=12):
    return [tuple(r) for r in periodic.find_runs(np.array(words, np.int64), least).tolist()]


def test_transform_round_trip_and_product():
    rng = np.random.default_rng(2)
    for prime in periodic.PRIMES:
        p = np.uint64(prime)
        a, b = (rng.integers(0, prime, (2, 32), dtype=np.uint64) for _ in range(2))
        there = periodic.transform(a, prime)
        assert (periodic.transform(there, prime, inverse=True) == a).all()
        product = periodic.transform(there * periodic.transform(b, prime) % p, prime, inverse=True)
        for x, y, z in zip(a.tolist(), b.tolist(), product.tolist(), strict=True):
            assert z == [sum(x[i] * y[(k - i) % 32] for i in range(32)) % prime for k in range(32)]


def words_with_runs(rng):
    n = int(rng.integers(0, 130))
    words = rng.integers(0, rng.integers(1, 6), n)
    if n > 20 and rng.random() < 0.7:
        at, period = int(rng.integers(0, n)), int(rng.integers(1, n // 3))
        words[at:] = [words[min(at + i % period, n - 1)] for i in range(n - at)]
    if rng.random() < 0.3:
        words = words + (rng.random(n) < 0.1) * rng.integers(0, 1000, n)
    return words.tolist()


@pytest.mark.parametrize("seed", range(4))
def test_equal_to_a_plain_search(seed):
    rng = np.random.default_rng(seed)
    for _ in range(250):
        words = words_with_runs(rng)
        assert found(words) == plain_runs(words), words


def test_blocks_wider_than_the_widest_transform(monkeypatch):
    monkeypatch.setattr(periodic, "WIDEST", 8)
    rng = np.random.default_rng(3)
    for _ in range(40):
        words = rng.integers(0, 3, 300)
        at, period = int(rng.integers(0, 200)), int(rng.integers(1, 150))
        words[at:] = [words[min(at + i % period, 299)] for i in range(300 - at)]
        assert found(words.tolist()) == plain_runs(words.tolist())


def test_equal_hashes_of_different_stretches_are_found_out(monkeypatch):
    monkeypatch.setattr(periodic._Prefixes, "equal", lambda self, a, b, length: np.ones(len(a), bool))
    words = [9, 8, *[1, 2, 3] * 6, 7, 6, 5]
    assert found(words) == plain_runs(words)


def test_highly_periodic_texts_of_many_words():
    n = 30_000
    assert found([1] * n) == [(0, n, 1)]
    a, b = [0], [0, 1]
    while len(b) < 3000:
        a, b = b, b + a
    assert found(b) == plain_runs(b)
    spaced = [i if i % 500 == 0 else 1 for i in range(1, n)]
    assert len(found(spaced)) == 60


def want_row(doc_id, text):
    words = re.findall("[^\x20\x09-\x0d]+", text or "")
    n, h = len(words), None if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h is not None and h % 10 == 0 and n:
        g = h // 10
        at = g % n
        period = 1 + (n - at) // (3 + g % 8)
        words = [words[i] if i < at else words[at + (i - at) % period] for i in range(n)]
    number = {w: i for i, w in enumerate(dict.fromkeys(words))}
    runs = found([number[w] for w in words]) if n > 2000 else plain_runs(words)
    dropped = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
    exponent = None if best[0] is None else 1000 * best[1] // best[2]
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    kept = " ".join(w for i, w in enumerate(words) if i not in dropped)
    digests = [hashlib.sha256(x.encode()).hexdigest() for x in (lines, kept)]
    return (doc_id, len(runs), *best, exponent, *digests)


def test_query_on_awkward_rows(spark, make_docs, none, tmp_path):
    rows = [*AWKWARD, *((100 + i, "so it goes on and " * (i % 7) + f"word{i} and more of it " * 3) for i in range(80))]
    make_docs(rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(map(tuple, op11_periodic_runs(spark, str(tmp_path)).collect()), key=str)
    assert got == sorted((want_row(*r[:2]) for r in rows), key=str)
    none.write.parquet(f"{tmp_path}/none/documents.parquet")
    assert op11_periodic_runs(spark, f"{tmp_path}/none").count() == 0


def test_operator_keeps_texts_and_runs(make_docs):
    got = {r[0]: r for r in periodic.periodic_runs(make_docs([(1, "x " * 20 + "y"), (2, LONG), (3, None)])).collect()}
    assert got[1].kept == "x y" and [tuple(r) for r in got[1].runs] == [(0, 20, 1)]
    assert got[2].n_words == 30_000 and got[2].kept.split() == LONG.split()[:5003]
    assert (got[3].n_words, got[3].runs, got[3].kept) == (0, [], "")
