"""Column-adding maps over Arrow batches of whole texts."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructType, _parse_datatype_string

SLICE_BYTES = 4_000_000
Texts = list  # of str; a null text arrives as ""
Mapper = Callable[[Texts], Sequence[Sequence]]


def ddl(fields: str) -> StructType:
    return _parse_datatype_string(fields)


def without(docs: DataFrame, names: Sequence[str]) -> list[str]:
    """Columns of ``docs`` that do not clash with ``names`` (case is ignored)."""
    taken = {n.lower() for n in names}
    return [c for c in docs.columns if c.lower() not in taken]


def cut(part: pa.RecordBatch, column: int, most: int | None):
    """Slices of a batch whose texts have at most ``most`` bytes together; a longer text is alone. No copies."""
    if most is None or not part.num_rows:
        yield part
        return
    size = np.asarray(pc.fill_null(pc.binary_length(part.column(column)), 0), dtype=np.int64)
    start, held = 0, 0
    for i, n in enumerate(size.tolist()):
        if held and held + n > most:
            yield part.slice(start, i - start)
            start, held = i, 0
        held += n
    yield part.slice(start)


def give_back() -> None:
    """Hands freed memory back to the system, where the C library can: an idle worker keeps no batches."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def add_columns(
    docs: DataFrame, make: Callable[[], Mapper], fields: str, text: str = "text", keep: Sequence[str] | None = None,
    slice_bytes: int | None = SLICE_BYTES,
) -> DataFrame:
    """``docs`` with the columns ``fields`` that a mapper computes from each batch of texts.

    ``make`` runs once per task and returns the mapper: a list of texts goes in, one
    sequence per field comes out. An attribute ``done`` of the mapper is called at the end
    of the task, for what a worker should not keep until its next one. ``keep`` names the input columns to hand through (all
    by default); a column of the input with the name of a new one is replaced. Batches
    are bounded by Spark's own row and byte limits, so memory does not follow the size
    of a partition; with ``slice_bytes`` the mapper sees at most that many bytes of text
    at once (or one longer text). A kept text is not handed to Python twice.
    """
    new = ddl(fields)
    kept = without(docs.select(*keep) if keep is not None else docs, new.names)
    hidden = "__text"
    source = docs.select(*[docs[c] for c in kept], *([] if text in kept else [docs[text].alias(hidden)]))
    place = kept.index(text) if text in kept else len(kept)
    schema = StructType([f for f in source.schema.fields if f.name != hidden] + list(new.fields))
    types = [to_arrow_type(f.dataType) for f in new.fields]

    def run(parts):
        mapper = make()
        try:
            for whole in parts:
                for part in cut(whole, place, slice_bytes):
                    texts = ["" if t is None else t for t in part.column(place).to_pylist()]
                    made = mapper(texts)
                    arrays = [part.column(i) for i in range(len(kept))]
                    arrays += [c if isinstance(c, pa.Array) else pa.array(c, type=kind) for c, kind in zip(made, types)]
                    yield pa.RecordBatch.from_arrays(arrays, names=schema.names)
        finally:
            getattr(mapper, "done", lambda: None)()
            whole = part = texts = made = arrays = None
            give_back()

    return source.mapInArrow(run, schema)
