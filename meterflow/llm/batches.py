"""Going through Arrow batches in slices of bounded size."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 2 << 20


def slices(batch: pa.RecordBatch, column: str = "text", most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Row ranges whose texts have about ``most`` bytes together; one row at least."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
    start = total = 0
    for i, size in enumerate(sizes):
        if i > start and total + size > most:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += size
    if start < len(sizes):
        yield batch.slice(start)


def by_slice(
    fn: Callable[[pa.RecordBatch], pa.RecordBatch | None],
    column: str = "text",
    most: int = SLICE_BYTES,
    after: Callable[[], None] | None = None,
):
    """Function for mapInArrow that applies ``fn`` to each slice, and ``after`` at the end of the partition."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            for batch in batches:
                for part in slices(batch, column, most):
                    out = fn(part)
                    if out is not None and out.num_rows:
                        yield out
        finally:
            if after is not None:
                after()

    return run
