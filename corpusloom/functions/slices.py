"""Texts in slices of bounded size, so that what a Python worker makes of them does not grow with Spark's batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that are worked on at a time; a larger text is a slice of its own.
SLICE_BYTES = 1 << 20


def cuts(texts: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """(first row, rows) of neighbouring texts that hold up to ``most`` bytes together."""
    ends = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(texts), 0), np.int64))
    first = 0
    while first < len(ends):
        upto = int(ends[first - 1]) if first else 0
        behind = max(first + 1, int(np.searchsorted(ends, upto + most, "right")))
        yield first, behind - first
        first = behind


def slices(texts: pa.Array, most: int = SLICE_BYTES) -> Iterator[list[str | None]]:
    """The texts, as many at a time as ``cuts`` has them."""
    for first, n in cuts(texts, most):
        yield texts.slice(first, n).to_pylist()
