"""Periodic runs of words, found by block convolution over exact number-theoretic transforms.

At scale B (a power of two) the word sequence is cut into blocks of B words. A block is
compared with every place of the window that follows it at the distances of its scale by
one convolution: the sum of squared differences of word numbers is zero exactly where the
block occurs again. Each such distance seeds a run, which is then extended both ways.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Primes k * 2^25 + 1 below 2^31: products of residues fit 64 bits, transforms go up to 2^25.
PRIMES = (2113929217, 2013265921, 1811939329)
#: Longest block that is transformed; at larger scales a block's head stands for it.
WIDEST = 1 << 18
_CELLS = 1 << 20
_BYTES_OUT = 1 << 23
_U = np.uint64


@lru_cache(maxsize=256)
def _twiddles(prime: int, size: int, inverse: bool) -> np.ndarray:
    """Powers of a primitive root of unity of order ``size``."""
    root = next(
        r for g in range(2, 200) if pow(r := pow(g, (prime - 1) // size, prime), size // 2, prime) == prime - 1
    )
    if inverse:
        root = pow(root, prime - 2, prime)
    out = np.ones(1, _U)
    while len(out) < size // 2:
        step = pow(root, len(out), prime)
        out = np.concatenate([out, out * _U(step) % _U(prime)])
    return out


def transform(rows: np.ndarray, prime: int, *, inverse: bool = False) -> np.ndarray:
    """Number-theoretic transform of each row (length a power of two), exact modulo ``prime``."""
    p, size = _U(prime), rows.shape[1]
    roots = _twiddles(prime, size, inverse)
    x, count = rows.reshape(len(rows), size, 1), size
    while count > 1:
        half = count // 2
        low, high = x[:, :half], x[:, half:]
        total = low + high
        total -= p * (total >= p)
        apart = (low + p - high) * roots[:: size // count][:half, None] % p
        x = np.stack([total, apart], axis=2).reshape(len(rows), half, -1)
        count = half
    out = x.reshape(len(rows), size)
    return out * _U(pow(size, prime - 2, prime)) % p if inverse else out


def _moduli(width: int, highest: int) -> tuple[int, ...]:
    """As many primes as it takes for a sum of squares to be zero when it is zero modulo all."""
    bound, product = width * highest * highest, 1
    for i, prime in enumerate(PRIMES):
        product *= prime
        if product > bound:
            return PRIMES[: i + 1]
    raise ValueError("too many different words")


def zero_mismatches(
    words: np.ndarray, starts: np.ndarray, width: int, low: int, count: int
) -> tuple[np.ndarray, np.ndarray]:
    """(start, distance) wherever words[start:start+width] occurs again ``distance`` words on.

    Distances run from ``low`` to ``low + count - 1``; ``words`` holds positive numbers and
    what lies beyond its end equals nothing.
    """
    window = count + width - 1
    size = 1 << (window - 1).bit_length() if window > 1 else 2
    moduli = _moduli(width, int(words.max()))
    padded = np.zeros(int(starts.max()) + low + window, np.int64)
    padded[: min(len(words), len(padded))] = words[: len(padded)]
    squares = np.concatenate([[0], np.cumsum(padded * padded)])
    found_at, found_far = [], []
    per = max(1, _CELLS // size)
    for i in range(0, len(starts), per):
        at = starts[i : i + per, None]
        view = padded[at + low + np.arange(window)]
        blocks = padded[at + np.arange(width)]
        places = at + low + np.arange(count)
        sums = (squares[places + width] - squares[places]) + (squares[at + width] - squares[at])
        # A place with the end behind it can't be an occurrence: the end's number is zero.
        same = np.ones((len(at), count), bool)
        for prime in moduli:
            a = np.zeros((len(at), size), _U)
            b = np.zeros((len(at), size), _U)
            a[:, :window] = view
            b[:, :width] = blocks[:, ::-1]
            product = transform(a, prime) * transform(b, prime) % _U(prime)
            cross = transform(product, prime, inverse=True)[:, width - 1 : width - 1 + count]
            same &= (sums - 2 * cross.astype(np.int64)) % prime == 0
        row, far = np.nonzero(same)
        found_at.append(starts[i + row])
        found_far.append(far + low)
    return np.concatenate(found_at), np.concatenate(found_far)


class _Prefixes:
    """Rolling hashes of all prefixes, for the longest common extension of two places."""

    def __init__(self, words: np.ndarray) -> None:
        self.n = len(words)
        self.sums, self.powers = [], []
        for prime, base in ((PRIMES[0], 1_000_003), (PRIMES[1], 8_675_309)):
            p = _U(prime)
            powers = np.ones(1, _U)
            while len(powers) <= self.n:
                powers = np.concatenate([powers, powers * _U(pow(base, len(powers), prime)) % p])
            value = words.astype(_U) % p * powers[: self.n] % p
            # Prefix sums of residues stay below 2^63 for any array that fits in memory.
            self.sums.append(np.concatenate([np.zeros(1, _U), np.cumsum(value, dtype=_U) % p]))
            self.powers.append(powers)

    def equal(self, a: np.ndarray, b: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Whether words[a:a+length] and words[b:b+length] agree, with a < b."""
        same = np.ones(len(a), bool)
        for prime, sums, powers in zip(PRIMES, self.sums, self.powers, strict=False):
            p = _U(prime)
            left = (sums[a + length] + p - sums[a]) % p * powers[b - a] % p
            same &= left == (sums[b + length] + p - sums[b]) % p
        return same

    def longest(self, a: np.ndarray, b: np.ndarray, most: np.ndarray, *, back: bool) -> np.ndarray:
        """Common words from a and b on, or (``back``) right before them; at most ``most``."""
        low, high = np.zeros(len(a), np.int64), most.astype(np.int64)
        while (open_ := low < high).any():
            middle = (low + high + 1) // 2
            shift = middle if back else 0
            good = self.equal(a - shift, b - shift, middle)
            low = np.where(open_ & good, middle, low)
            high = np.where(open_ & ~good, middle - 1, high)
        return low


def _followed(order: np.ndarray, group: np.ndarray, starts: np.ndarray, low: int, high: int) -> np.ndarray:
    """Whether the short string at each start begins again ``low`` to ``high`` words on."""
    n = len(group)
    key = group[starts] * n
    at = np.searchsorted(order, key + np.minimum(starts + low, n))
    end = np.searchsorted(order, key + np.minimum(starts + high + 1, n))
    return end > at


def _short_strings(words: np.ndarray, size: int = 4) -> np.ndarray | None:
    """A number for the ``size`` words at each place, equal for equal ones; None if no two are equal."""
    factors = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], _U)
    n = len(words) - size + 1
    value = sum(words[k : k + n].astype(_U) * factors[k] for k in range(size))
    ordered = np.sort(value)
    if not (ordered[1:] == ordered[:-1]).any():
        return None
    return np.unique(value, return_inverse=True)[1].astype(np.int64)


def _covers(runs: np.ndarray, block: int, blocks: int) -> np.ndarray:
    """End of the run that holds each whole block with at most half its length as period; 0 if none."""
    cover = np.zeros(blocks, np.int64)
    start, end = runs[:, 0], runs[:, 0] + runs[:, 1]
    first, last = -(-start // block), (end - block) // block
    use = (2 * runs[:, 2] <= block) & (last >= first)
    first, count, end = first[use], (last - first + 1)[use], end[use]
    place = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    cover[np.repeat(first, count) + place] = np.repeat(end, count)
    return cover


def _direct(words: np.ndarray, at: int, period: int) -> tuple[int, int]:
    """Stretch of ``period`` around words[at], word by word."""
    start, end = at, at
    while start > 0 and words[start - 1] == words[start - 1 + period]:
        start -= 1
    while end + period < len(words) and words[end] == words[end + period]:
        end += 1
    return start, end + period


def _extended(words: np.ndarray, prefixes: _Prefixes, seeds: np.ndarray, block: int, least: int) -> np.ndarray:
    """Runs (start, length, period) around the (start, distance) seeds of one scale."""
    seeds = seeds[np.lexsort((seeds[:, 0], seeds[:, 1]))]
    follows = np.zeros(len(seeds), bool)
    follows[1:] = (np.diff(seeds[:, 0]) == block) & (np.diff(seeds[:, 1]) == 0)
    at, far = seeds[~follows].T
    left = prefixes.longest(at, at + far, at, back=True)
    right = prefixes.longest(at, at + far, len(words) - at - far, back=False)
    found = np.stack([at - left, left + right + far, far], axis=1)
    keep = found[:, 1] >= np.maximum(least, 2 * far)
    found, at = found[keep], at[keep]
    found, first = np.unique(found, axis=0, return_index=True)
    for i, (start, length, period) in enumerate(found.tolist()):
        end = start + length
        if not (
            np.array_equal(words[start : end - period], words[start + period : end])
            and (start == 0 or words[start - 1] != words[start - 1 + period])
            and (end == len(words) or words[end] != words[end - period])
        ):  # two different stretches have had one hash
            start, end = _direct(words, int(at[first[i]]), period)
            found[i, :2] = start, end - start
    return found[found[:, 1] >= np.maximum(least, 2 * found[:, 2])]


def find_runs(words: np.ndarray, least: int = 12) -> np.ndarray:
    """(start, length, period) of all runs, by start, then period.

    ``words`` holds numbers, equal for equal words. A run is a maximal stretch with
    smallest period q of at least ``max(least, 2 * q)`` words. At scale B distances go from
    2B-1 to 4B-2 (from 1 at the lowest): a run's words but for its last period are then
    enough to hold a whole block, which occurs again q words on, so every run is seeded.

    Blocks whose first four words are not found again in reach, and blocks with a word
    that occurs once, equal nothing and are not convolved. Nor are those whose whole window
    lies in one known run of at most half their length: they occur there at multiples of
    its period only, which lead to the same run.
    """
    n = len(words)
    runs = np.zeros((0, 3), np.int64)
    # Short strings have four words; a run has least - q or q words before its last period.
    if n < least or least < 8 or (group := _short_strings(words)) is None:
        if least < 8:
            raise ValueError("least must be at least 8")
        return runs
    places = np.argsort(group, kind="stable")
    order = group[places] * len(group) + places
    _, dense, often = np.unique(words, return_inverse=True, return_counts=True)
    marks = np.where(often > 1, np.cumsum(often > 1), 0)[dense]
    singles = np.concatenate([[0], np.cumsum(marks == 0)])
    prefixes = None
    block, low, high = 2, 1, 6
    while low <= n // 2:
        starts = np.arange(0, n - max(block, 4) + 1, block)
        cover = _covers(runs, block, len(starts))
        starts = starts[(singles[starts + block] == singles[starts]) & (cover < starts + high + block)]
        starts = starts[_followed(order, group, starts, low, high)]
        if len(starts):
            width = min(block, WIDEST)
            parts = [
                zero_mismatches(marks, starts, width, far, min(2 * max(width, 3), high + 1 - far))
                for far in range(low, high + 1, 2 * max(width, 3))
            ]
            at, far = (np.concatenate(x) for x in zip(*parts, strict=True))
            new = at + far + block > cover[at // block]
            if new.any():
                prefixes = prefixes or _Prefixes(words)
                seeds = np.stack([at[new], far[new]], axis=1)
                both = np.concatenate([runs, _extended(words, prefixes, seeds, block, least)])
                # One stretch, several periods: the smallest is the run's.
                both = both[np.lexsort((both[:, 2], both[:, 1], both[:, 0]))]
                first = np.ones(len(both), bool)
                first[1:] = (np.diff(both[:, :2], axis=0) != 0).any(axis=1)
                runs = both[first]
        block, low, high = 2 * block, high + 1, 2 * high + 2
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def without_repeats(words: list[bytes], runs: np.ndarray) -> list[bytes]:
    """The words that no run contains after its first period."""
    if not len(runs):
        return words
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 0] + runs[:, 1], -1)
    return [words[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0).tolist()]


_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def periodic_runs(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", least: int = 12
) -> DataFrame:
    """(id, n_words, runs, kept) for every row of ``docs``, in one pass without a shuffle.

    Words are runs of other than white space; ``runs`` has (start, length, period) by start,
    then period, and ``kept`` the words that stay when each run keeps its first period only.
    Null and empty texts have no words, no runs and an empty ``kept``; repeated rows and
    null ids are rows like any other. Texts of any length are read whole: time grows with
    n log^2 n, memory with n. Other columns of ``docs`` are not read.
    """
    id_type = docs.schema[id_col].dataType.simpleString()
    given = docs.select(F.col(id_col), F.col(text_col).cast("binary").alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            begun, size = 0, 0
            counts, found, kept = [], [], []

            def table(end: int) -> pa.RecordBatch:
                rows = np.concatenate([*found, np.zeros((0, 3), np.int64)])
                offsets = np.concatenate([[0], np.cumsum([len(f) for f in found])]).astype(np.int32)
                structs = pa.StructArray.from_arrays([pa.array(c) for c in rows.T], fields=list(_RUN))
                return pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(begun, end - begun),
                        pa.array(counts, pa.int64()),
                        pa.ListArray.from_arrays(pa.array(offsets), structs),
                        pa.array(kept, pa.binary()),
                    ],
                    [id_col, "n_words", "runs", "kept"],
                )

            for i in range(batch.num_rows):
                words = (batch.column(1)[i].as_py() or b"").split()
                number: defaultdict[bytes, int] = defaultdict(count().__next__)
                ids = np.fromiter(map(number.__getitem__, words), np.int64, len(words))
                runs = find_runs(ids, least)
                counts.append(len(words))
                found.append(runs)
                kept.append(b" ".join(without_repeats(words, runs)))
                size += len(kept[-1]) + 24 * len(runs)
                if size > _BYTES_OUT:
                    yield table(i + 1)
                    begun, size = i + 1, 0
                    counts, found, kept = [], [], []
            yield table(batch.num_rows)

    schema = f"`{id_col}` {id_type}, n_words long, runs array<struct<start:long,length:long,period:long>>, kept binary"
    return given.mapInArrow(run, schema).withColumn("kept", F.col("kept").cast("string"))
