"""Counts along a sequence of thresholds, by composing the steps instead of walking them.

A step with threshold b takes a count x to x + 1 where x < b and leaves it otherwise. Steps
composed in order are again such a map: how much a count grows never increases with the
count, so m steps are m thresholds, and a count grows by the number of thresholds above
it. Neighbouring maps compose pairwise, level by level; the counts then come down the same
levels. Every level is a few array operations over all sequences at once.
"""

from __future__ import annotations

import numpy as np


def composed(first: np.ndarray, then: np.ndarray, top: int) -> np.ndarray:
    """Maps (rows of sorted thresholds) of ``first`` followed by ``then``.

    Thresholds of m steps with bounds in 0 to ``top`` lie in 1 - m to ``top``.
    """
    rows, width = first.shape
    row = np.arange(rows)[:, None]
    apart = row * (top + 4 * width)
    # A threshold u of the second map is met by counts that the first takes below u. With i
    # of its thresholds at or below x the first adds width - i; the first i that fits counts.
    reach = np.maximum.accumulate(first - np.arange(width), axis=1)
    found = np.searchsorted((reach + apart).ravel(), (then - width + apart).ravel(), side="right")
    i = found.reshape(rows, width) - row * width
    pulled = then - width + i
    below = np.take_along_axis(first, np.maximum(i - 1, 0), axis=1)
    pulled = np.where(i > 0, np.maximum(below, pulled), pulled)
    return np.sort(np.concatenate([first, pulled], axis=1), axis=1)


def levels(bounds: np.ndarray, top: int) -> list[np.ndarray]:
    """Maps of 1, 2, 4, … neighbouring steps; each row of ``bounds`` is a sequence of 2^k steps."""
    out = [bounds.reshape(-1, 1)]
    for _ in range(bounds.shape[1].bit_length() - 1):
        out.append(composed(out[-1][0::2], out[-1][1::2], top))
    return out


def counts_before(maps: list[np.ndarray], start: np.ndarray) -> np.ndarray:
    """The count before every step, for the given count before each sequence."""
    count = start
    for left in reversed(maps[:-1]):
        left = left[0::2]
        right = count + (left > count[:, None]).sum(axis=1)
        count = np.stack([count, right], axis=1).ravel()
    return count


def sequences(bounds: np.ndarray, first: np.ndarray):
    """(rows, padded bounds) of the sequences that begin at ``first``, by their rounded size.

    ``rows`` has the place of each step in ``bounds``, -1 where a sequence is filled up with
    steps that never count.
    """
    size = np.diff(np.append(first, len(bounds)))
    rounded = np.array([1 << (int(n) - 1).bit_length() for n in size])
    for width in np.unique(rounded).tolist():
        chosen = np.flatnonzero(rounded == width)
        place = np.arange(width)
        rows = np.where(place < size[chosen, None], first[chosen, None] + place, -1)
        yield chosen, rows, np.where(rows >= 0, bounds[rows], 0)
