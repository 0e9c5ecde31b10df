"""Python workers: batches of bounded size in and out, and nothing large kept between tasks.

Spark reuses its Python workers from stage to stage, so what one task leaves behind (caches, freed
memory that the allocator holds on to) counts against every later stage of the executor.
"""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import _parse_datatype_string

#: Bytes of text that are worked on at once.
CHUNK_CHARS = 2_000_000


def _frugal() -> None:
    """Large blocks, Arrow's included, come from the system one by one and go back when they are freed.

    Without this a worker keeps what its largest batch took, beside its next stage's own needs.
    """
    process = ctypes.CDLL(None)
    if hasattr(process, "mallopt"):
        m_mmap_threshold, m_arena_max = -3, -8
        process.mallopt(m_mmap_threshold, 1 << 17)
        process.mallopt(m_arena_max, 1)
    pa.set_memory_pool(pa.system_memory_pool())


_frugal()


def give_back() -> None:
    """Return freed memory to the system."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    process = ctypes.CDLL(None)
    if hasattr(process, "malloc_trim"):
        process.malloc_trim(0)


def _slices(texts: pa.Array, most: int) -> Iterator[pa.Array]:
    """Parts of an array of texts (or lists) of about ``most`` bytes (or items); at least one row each."""
    length = pc.list_value_length if pa.types.is_nested(texts.type) else pc.binary_length
    sizes = pc.fill_null(length(texts), 0).to_numpy(zero_copy_only=False)
    start = held = 0
    for i, size in enumerate(sizes.tolist()):
        if i > start and held + size > most:
            yield texts.slice(start, i - start)
            start, held = i, 0
        held += size
    if start < len(texts):
        yield texts.slice(start)


def text_udf(schema: str, close: Callable[[], None] | None = None):
    """A vectorised UDF of one text column from a function of a list of texts to a frame or series.

    The function gets texts of about ``CHUNK_CHARS`` bytes at a time (at least one text), taken from the Arrow
    batch as they are needed, so that no second copy of a batch is made; at a task's end ``close`` is called
    and memory goes back to the system.
    """

    def make(f: Callable[[list], pd.DataFrame | pd.Series]):
        struct = "," in schema or " " in schema.split("<")[0]
        kind = to_arrow_type(_parse_datatype_string(schema))

        def packed(out: pd.DataFrame | pd.Series) -> pa.Array:
            if not struct:
                return pa.Array.from_pandas(out, type=kind)
            return pa.StructArray.from_arrays([pa.Array.from_pandas(out[x.name], type=x.type) for x in kind], fields=list(kind))

        def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            try:
                for batch in batches:
                    for part in _slices(batch, CHUNK_CHARS):
                        yield packed(f(part.to_pylist()))
            finally:
                if close:
                    close()
                give_back()

        run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
        return F.arrow_udf(run, schema)

    return make
