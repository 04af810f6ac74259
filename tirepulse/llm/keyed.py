"""Rows that meet by a hash key: what a task merges before the shuffle, and
what the task that gets a key decides.

Rows are (key, doc_id, at, settled). Rows that a task already knows the answer
of are ``settled``; they are spread by a key of their own and only pass
through. So a key that a third of all rows share sends a few rows a slice, not
all of them, to its task.
"""

from __future__ import annotations

import numpy as np

from tirepulse.llm.textscan import mix


def ids(column) -> np.ndarray:
    """An Arrow column of integers as int64."""
    return column.to_numpy(zero_copy_only=False).astype(np.int64)


def collected(batches, *columns) -> list[np.ndarray]:
    """The columns of all batches of this partition."""
    table = list(batches)
    return [np.concatenate([ids(b.column(c)) for b in table]) if table else np.zeros(0, np.int64) for c in columns]


def spread(doc: np.ndarray, at: np.ndarray) -> np.ndarray:
    """A key of its own for each row."""
    return mix(at.astype(np.uint64) ^ mix(doc.astype(np.uint64)))


def later_ones(keys: list[np.ndarray], doc: np.ndarray, at: np.ndarray) -> np.ndarray:
    """True for rows whose keys a row at an earlier place (doc, at) has too.

    Rows of one place are one row told twice, not each other's copies.
    """
    out = np.zeros(doc.size, bool)
    if doc.size:
        order = np.lexsort((at, doc, *keys[::-1]))
        fresh = np.zeros(doc.size, bool)
        fresh[0] = True
        for k in keys:
            fresh[1:] |= k[order[1:]] != k[order[:-1]]
        first = order[np.maximum.accumulate(np.where(fresh, np.arange(doc.size), 0))]
        out[order] = (doc[order] != doc[first]) | (at[order] != at[first])
    return out
