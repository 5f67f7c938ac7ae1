"""Arrow list columns as NumPy: which rows are usable, and their entries."""

from __future__ import annotations

import numpy as np
import pyarrow.compute as pc


def usable_rows(column) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of a list<double> column: ``(row numbers, lengths, starts, flat)``.

    A row is usable when it is not null and holds no null and no non-finite
    entry (an empty list is).  ``flat`` holds the entries of all lists in one
    array, and row ``i`` of the result lies at ``starts[i]``."""
    lens = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False)   # nulls become NaN
    edges = np.concatenate(([0], np.cumsum(lens)))
    bad = np.concatenate(([0], np.cumsum(~np.isfinite(flat))))
    good = column.is_valid().to_numpy(zero_copy_only=False) & (bad[edges[1:]] == bad[edges[:-1]])
    rows = np.flatnonzero(good)
    return rows, lens[rows], edges[:-1][rows], flat


def entries(lens: np.ndarray, starts: np.ndarray, flat: np.ndarray) -> np.ndarray:
    """The entries of the given rows, one row after the other."""
    if not len(lens):
        return flat[:0]
    ends = np.cumsum(lens)
    return flat[np.arange(ends[-1]) + np.repeat(starts - (ends - lens), lens)]
