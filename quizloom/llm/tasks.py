"""What a Python task should leave behind: nothing."""

import functools

import pyarrow as pa


def releasing(work):
    """A function over Arrow batches whose worker gives its buffers back at the end.

    Workers are used again by later tasks and stages; without this each would keep the
    memory of the largest batches it has ever seen.
    """

    @functools.wraps(work)
    def run(batches):
        try:
            yield from work(batches)
        finally:
            pa.default_memory_pool().release_unused()

    return run
