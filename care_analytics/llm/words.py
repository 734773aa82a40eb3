"""Words of many texts at a time: spans of non-blank bytes, as numbers."""

from __future__ import annotations

import numpy as np

from care_analytics.llm.prints import prints

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
BLANK = np.zeros(256, bool)
BLANK[[9, 10, 11, 12, 13, 32]] = True


def spans(data: np.ndarray, offsets: np.ndarray, blank: np.ndarray = BLANK) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and the index of each text's first word (one more at the end)."""
    ink = np.zeros(len(data) + 2, np.int8)
    ink[1:-1] = ~blank[data]
    steps = np.diff(ink)
    starts, ends = np.flatnonzero(steps == 1), np.flatnonzero(steps == -1)
    # a text's end also ends a word
    inner = offsets[1:-1][(offsets[1:-1] > 0) & (offsets[1:-1] < len(data))]
    joined = inner[(ink[inner] == 1) & (ink[inner + 1] == 1)]
    if len(joined):
        # all three ascend, and no joined place is among the others: merged without a sort
        joined = joined[np.append(True, joined[1:] != joined[:-1])]
        starts, ends = (np.insert(x, np.searchsorted(x, joined), joined) for x in (starts, ends))
    return starts, ends, np.searchsorted(starts, offsets)


def numbers(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit number for each word, A-Z taken as a-z."""
    return prints(3).spans(LOWER[data], starts, ends)
