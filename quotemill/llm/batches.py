"""Documents through Python in bounded Arrow batches."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

BATCH_BYTES = 2 << 20


def release() -> None:
    """Give memory that is no longer used back to the machine: the next task of a worker may need it for something else,
    and other processes of the executor at once."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except AttributeError:  # another C library
        pass


def slices(batch: pa.RecordBatch, column: str) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows of about BATCH_BYTES of text; a longer text is a run of its own."""
    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
    begin, size = 0, 0
    for at, n in enumerate(lengths):
        if at > begin and size + n > BATCH_BYTES:
            yield batch.slice(begin, at - begin)
            begin, size = at, 0
        size += n
    if begin < batch.num_rows:
        yield batch.slice(begin)


def unused(columns: list[str], name: str) -> str:
    """The name, with underscores behind it until no column has it."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def map_texts(
    df: DataFrame, column: str, schema: str, start: Callable[[], Callable[[list], dict]], keep: list[str],
) -> DataFrame:
    """The columns ``keep`` of each row and those that a function makes of its text.

    ``start`` runs once a task and returns the function, which gets a list of texts and
    returns a dict of lists or Arrow arrays, one value a text.
    """
    names = [part.split()[0] for part in schema.split(", ")]

    def run(batches):
        work = start()
        for whole in batches:
            for batch in slices(whole, column):
                made = work(batch.column(column).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(c) for c in keep], *[v if isinstance(v, pa.Array) else pa.array(v) for v in map(made.get, names)]],
                    names=[*keep, *names])
        whole = batch = made = work = None
        release()

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields if f.name in keep]
    return df.select(*dict.fromkeys([*keep, column])).mapInArrow(run, ", ".join([*fields, schema]))
