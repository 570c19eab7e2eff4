"""Numbers as packed rows by bucket: a shuffle moves few large rows, and a bucket's rows meet in one small group.

Buckets follow a hash of a key, so their number is chosen by the size of the table and a
group stays of bounded size.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

#: Numbers of one group, about; buckets at least; bytes of a batch, about.
GROUP, FEWEST, BATCH = 1 << 19, 32, 1 << 21


def buckets(total: int) -> int:
    """A power of two, so that ``total`` numbers make groups of GROUP at most, about."""
    return max(FEWEST, 1 << (total // GROUP).bit_length())


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


def bucket_of(keys: np.ndarray, parts: int) -> np.ndarray:
    return (mixed(keys.view(np.uint64)) >> np.uint64(40)).astype(np.int64) & (parts - 1)


def fields(*names: str) -> str:
    return ", ".join(["bucket int", *[f"{n} binary" for n in names]])


def pack(bucket: np.ndarray, parts: int, **columns: np.ndarray) -> pa.RecordBatch:
    """A row for each bucket that has numbers, with those of each column as bytes."""
    order = np.argsort(bucket.astype(np.uint16) if parts <= 1 << 16 else bucket, kind="stable")
    sizes = np.bincount(bucket, minlength=parts)
    there = np.flatnonzero(sizes)
    bounds = np.append(0, np.cumsum(sizes[there]))
    arrays = [pa.array(there.astype(np.int32))]
    for x in columns.values():
        x = np.ascontiguousarray(x[order])
        places = pa.py_buffer((bounds * x.itemsize).astype(np.int32))
        arrays.append(pa.Array.from_buffers(pa.binary(), len(there), [None, places, pa.py_buffer(x)]))
    return pa.RecordBatch.from_arrays(arrays, names=["bucket", *columns])


def small(rows: pa.RecordBatch) -> list[pa.RecordBatch]:
    """The rows in batches of about BATCH bytes, which the JVM holds outside its heap."""
    step = max(1, rows.num_rows * BATCH // max(1, rows.nbytes))
    return [rows.slice(i, step) for i in range(0, rows.num_rows, step)] or [rows]


def pack_table(bucket: np.ndarray, parts: int, **columns: np.ndarray) -> pa.Table:
    return pa.Table.from_batches(small(pack(bucket, parts, **columns)))


def unpack(rows: pa.Table | pa.RecordBatch, **kinds: type) -> list[np.ndarray]:
    """The numbers of all rows, one array for each column asked for."""
    return [np.frombuffer(b"".join(rows.column(name).to_pylist()), kind) for name, kind in kinds.items()]


def runs(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order that puts equal keys side by side, and where each key begins in it."""
    order = np.argsort(keys)
    ordered = keys[order]
    return order, np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1])[: len(keys)])


def sums(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    return np.add.reduceat(values, starts) if len(starts) else values[:0]
