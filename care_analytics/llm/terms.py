"""Terms of many texts at a time: maximal runs of bytes of a class, A-Z taken as a-z.

A class holds some ASCII bytes and every byte beyond ASCII, so a run of its bytes
is a run of whole characters.
"""

from __future__ import annotations

import string

import numpy as np
import pyarrow as pa

from care_analytics.llm.common import text_bytes
from care_analytics.llm.words import LOWER, spans


def outside(members: str) -> np.ndarray:
    """The bytes that end a term whose ASCII bytes are ``members``."""
    out = np.zeros(256, bool)
    out[:128] = True
    out[list(members.encode())] = False
    return out


NO_LETTER = outside(string.ascii_letters)
NO_ALNUM = outside(string.ascii_letters + string.digits)


def terms(array: pa.Array, ending: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All terms end to end in lower case, their bounds (one more at the end), and the index of
    each text's first term (one more at the end)."""
    data, offsets = text_bytes(array)
    starts, ends, first = spans(data, offsets, ending)
    bounds = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(ends - starts, out=bounds[1:])
    return LOWER[data[~ending[data]]], bounds, first


def as_strings(data: np.ndarray, bounds: np.ndarray) -> pa.Array:
    return pa.LargeStringArray.from_buffers(len(bounds) - 1, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data)))
