"""Whole groups of sorted rows, taken many at a time."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from .text import ragged


def whole_groups(batches: Iterator[pa.RecordBatch], keys: int = 2, rows: int = 20_000) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of about `rows` rows or more, and where groups begin in them (and the end). A group has equal first `keys`
    columns; rows come sorted by these, and no group is split."""

    def starts(table: pa.Table) -> np.ndarray:
        new = np.zeros(table.num_rows, bool)
        new[:1] = True
        for k in range(keys):
            column = table.column(k).to_numpy()
            new[1:] |= column[1:] != column[:-1]
        return np.append(np.flatnonzero(new), table.num_rows)

    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        held.append(batch)
        size += batch.num_rows
        if size >= rows:
            table = pa.Table.from_batches(held)
            cut = starts(table)
            if len(cut) > 2:  # the last group may go on
                yield table.slice(0, int(cut[-2])).combine_chunks(), cut[:-1]
                held = table.slice(int(cut[-2])).to_batches()
                size = sum(b.num_rows for b in held)
    if size:
        table = pa.Table.from_batches(held).combine_chunks()
        yield table, starts(table)


def pairs_within(first: np.ndarray, sizes: np.ndarray, most: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs i < j of rows of each group, about `most` at a time."""
    rows = ragged(first, sizes)
    after = np.repeat(first + sizes, sizes) - rows - 1
    total = np.concatenate([[0], np.cumsum(after)])
    k = 0
    while k < len(rows):
        e = max(k + 1, int(np.searchsorted(total, total[k] + most, "right")) - 1)
        yield np.repeat(rows[k:e], after[k:e]), ragged(rows[k:e] + 1, after[k:e])
        k = e
