"""Arrow batches in slices of bounded text."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PART_BYTES = 2_000_000


def parts(batch: pa.RecordBatch, column: int | str, most: int = PART_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices in order whose texts have about ``most`` bytes; a longer text is a slice of its own.

    What a task derives from texts at a time then does not grow with the bytes of a batch. An
    empty batch has no slices.
    """
    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    part = (np.cumsum(lengths) - lengths) // most
    begins = np.append(np.flatnonzero(np.diff(part, prepend=-1)), len(part))
    for a, b in zip(begins[:-1].tolist(), begins[1:].tolist()):
        yield batch.slice(a, b - a)
