"""Arrow batches cut by bytes before anything of them becomes Python objects.

Spark fills a batch by rows, up to ``spark.sql.execution.arrow.maxRecordsPerBatch``, however
long their texts are.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BATCH_BYTES = 8 << 20


def _text_bytes(array: pa.Array) -> np.ndarray:
    """Bytes of each text; 0 for NULL and for arrays of other types."""
    if pa.types.is_string(array.type) or pa.types.is_large_string(array.type):
        import pyarrow.compute as pc

        return np.asarray(pc.fill_null(pc.binary_length(array), 0), dtype=np.int64)
    return np.zeros(len(array), dtype=np.int64)


def by_bytes(
    columns: tuple[pa.Array, ...], limit: int = BATCH_BYTES, rows: int | None = None
) -> Iterator[list[list]]:
    """Values of the columns, in slices of at most ``limit`` bytes of text and ``rows`` rows.

    A row longer than the limit is a slice of its own.
    """
    upto = np.cumsum(sum(_text_bytes(c) for c in columns))
    at, count = 0, len(columns[0])
    while at < count:
        before = upto[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(upto, before + limit, side="right")))
        if rows is not None:
            end = min(end, at + rows)
        yield [c.slice(at, end - at).to_pylist() for c in columns]
        at = end
