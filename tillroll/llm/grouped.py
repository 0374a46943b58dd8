"""Groups of rows in a sorted partition, for functions given to mapInArrow."""

from __future__ import annotations

import numpy as np
import pyarrow as pa


def groups(batches, n_keys: int):
    """Yield runs of whole groups as ``(table, bounds)``: rows of a partition
    sorted by its first ``n_keys`` integer columns; group g of a run is rows
    bounds[g] to bounds[g + 1]. Only the last, still open group is held over
    from one batch to the next."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        if held and _key(held[-1], n_keys, -1) == _key(batch, n_keys, 0) == _key(batch, n_keys, -1):
            held.append(batch)  # one group goes on through the whole batch
            continue
        table = pa.Table.from_batches([*held, batch]).combine_chunks()
        bounds = _bounds(table, n_keys)
        open_at = int(bounds[-2])
        if open_at:
            yield table.slice(0, open_at), bounds[:-1]
        held = table.slice(open_at).combine_chunks().to_batches()
    if held:
        table = pa.Table.from_batches(held).combine_chunks()
        yield table, _bounds(table, n_keys)


def _key(batch, n_keys: int, row: int) -> tuple:
    at = row if row >= 0 else batch.num_rows + row
    return tuple(batch.column(k)[at].as_py() for k in range(n_keys))


def _bounds(table: pa.Table, n_keys: int) -> np.ndarray:
    change = np.zeros(table.num_rows - 1, bool)
    for k in range(n_keys):
        values = table.column(k).to_numpy()
        change |= values[1:] != values[:-1]
    return np.concatenate([[0], np.flatnonzero(change) + 1, [table.num_rows]])
