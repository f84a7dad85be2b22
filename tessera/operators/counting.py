"""Counting of number rows inside a task."""

from __future__ import annotations

import numpy as np


def counted(numbers: list[np.ndarray]) -> tuple[list[np.ndarray], np.ndarray]:
    """Distinct rows of the parallel columns ``numbers`` and their counts, by sorting (of one packed number a row where it fits)."""
    if not len(numbers[0]):
        return numbers, np.zeros(0, np.int64)
    bits = int(max(c.max() for c in numbers)).bit_length()
    if bits * len(numbers) < 64:
        key = numbers[0].astype(np.int64)
        for c in numbers[1:]:
            key = (key << bits) | c
        key.sort()
        starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        distinct = key[starts]
        columns = [(distinct >> bits * k) & ((1 << bits) - 1) for k in reversed(range(len(numbers)))]
        return columns, np.diff(np.append(starts, len(key)))
    order = np.lexsort(numbers[::-1])
    columns = [c[order] for c in numbers]
    starts = np.flatnonzero(np.concatenate([[True], np.logical_or.reduce([c[1:] != c[:-1] for c in columns])]))
    return [c[starts] for c in columns], np.diff(np.append(starts, len(order)))
