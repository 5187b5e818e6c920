"""Sparse matrices in compressed rows, and their product row by row."""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

# Products that are expanded at a time.
EXPANDED = 1 << 22


class Csr(NamedTuple):
    """Row i holds ``columns[starts[i]:starts[i + 1]]`` with their ``weights``; without weights all are 1."""

    starts: np.ndarray
    columns: np.ndarray
    weights: np.ndarray | None = None


class Entries(NamedTuple):
    """The entries of a matrix in order of row and column."""

    row: np.ndarray
    column: np.ndarray
    weight: np.ndarray


def starts_of(lengths: np.ndarray) -> np.ndarray:
    return np.concatenate([np.zeros(1, dtype=np.int64), np.cumsum(lengths, dtype=np.int64)])


def spread(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The ranges of ``lengths`` numbers from each of ``starts``, one after another."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0, dtype=np.int64) + np.repeat(starts - (ends - lengths), lengths)


def runs(ordered: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each run of equal values starts, and how long it is."""
    if not len(ordered):
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    first = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
    return first, np.diff(np.append(first, len(ordered)))


def counted(row: np.ndarray, column: np.ndarray, rows: int, columns: int) -> Csr:
    """The matrix that holds how often each (row, column) occurs."""
    key = np.sort(row * columns + column)
    first, times = runs(key)
    row, column = np.divmod(key[first], columns)
    return Csr(starts_of(np.bincount(row, minlength=rows)), column, times)


def product(left: Csr, right: Csr, columns: int, expanded: int = EXPANDED) -> Entries:
    """left x right by Gustavson: row i adds up the rows of ``right`` that its entries name.

    Rows are taken in blocks of about ``expanded`` products, so memory follows
    the result and not the products; a single row may exceed a block.
    """
    width = np.diff(right.starts)
    per_entry = width[left.columns]
    per_row = np.diff(starts_of(per_entry)[left.starts])
    done, rows = np.cumsum(per_row), len(left.starts) - 1
    found, at = [], 0
    while at < rows:
        reached = done[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(done, reached + expanded, side="right")))
        part = slice(left.starts[at], left.starts[to])
        taken = spread(right.starts[left.columns[part]], per_entry[part])
        key = np.repeat(np.arange(at, to, dtype=np.int64), per_row[at:to]) * columns + right.columns[taken]
        weight = None if right.weights is None else right.weights[taken]
        if left.weights is not None:
            spreading = np.repeat(left.weights[part], per_entry[part])
            weight = spreading if weight is None else weight * spreading
        if (key[1:] < key[:-1]).any():
            order = np.argsort(key)
            key = key[order]
            weight = None if weight is None else weight[order]
        first, times = runs(key)
        if weight is not None and len(first):
            times = np.add.reduceat(weight, first)
        row, column = np.divmod(key[first], columns)
        found.append(Entries(row, column, times))
        at = to
    if not found:
        return Entries(*[np.zeros(0, dtype=np.int64)] * 3)
    return Entries(*[np.concatenate(part) for part in zip(*found)])
