"""Columns of numbers that travel through a shuffle as compact blobs.

A row for each of many small records costs more than the record. A task therefore sorts its records by target
and sends one blob of columns for each target; the records of a blob are unpacked together.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: A blob for a target; ``kind`` tells blobs of different columns apart.
BLOBS = "target long, kind int, blob binary"
BLOBS_ARROW = pa.schema([("target", pa.int64()), ("kind", pa.int32()), ("blob", pa.binary())])


def pack(**columns: np.ndarray) -> bytes:
    """Columns behind each other, compressed; of each column first the lowest bytes, then the next ones, so that like bytes meet."""
    size = len(next(iter(columns.values())))
    planes = [np.ascontiguousarray(c).view(np.uint8).reshape(size, c.dtype.itemsize).T.tobytes() for c in columns.values()]
    return squeezed(b"".join([size.to_bytes(8, "little"), *planes]))


def sealed(table: pa.Table | pa.RecordBatch) -> bytes:
    """Rows as one compressed blob; texts that travel together compress better than one by one."""
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write(table)
    return sink.getvalue().to_pybytes()


def opened(blobs: list[bytes]) -> Iterator[pa.RecordBatch]:
    for blob in blobs:
        yield from pa.ipc.open_stream(blob)


def steps(values: np.ndarray) -> np.ndarray:
    """Differences of sorted whole numbers, the first one to zero: small values compress better."""
    return np.diff(values, prepend=np.zeros(1, dtype=values.dtype))


def squeezed(raw: bytes) -> bytes:
    """Compressed bytes behind their size."""
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def unsqueezed(raw: bytes) -> bytes:
    size = int.from_bytes(raw[:8], "little")
    return pa.decompress(raw[8:], decompressed_size=size, codec="zstd", asbytes=True)


def unpack(blobs: list[bytes], stepped: tuple[str, ...] = (), **kinds: str) -> dict[str, np.ndarray]:
    """The columns of all blobs; those ``stepped`` were packed as :func:`steps`."""
    parts: dict[str, list[np.ndarray]] = {k: [np.empty(0, dtype=kind)] for k, kind in kinds.items()}
    for blob in map(unsqueezed, blobs):
        size, at = int.from_bytes(blob[:8], "little"), 8
        for name, kind in kinds.items():
            width = np.dtype(kind).itemsize
            planes = np.frombuffer(blob, dtype=np.uint8, count=size * width, offset=at).reshape(width, size)
            values = np.ascontiguousarray(planes.T).reshape(-1).view(kind)
            parts[name].append(np.cumsum(values, dtype=kind) if name in stepped else values)
            at += size * width
    return {k: np.concatenate(v) for k, v in parts.items()}


def runs_of(*sorted_keys: np.ndarray) -> np.ndarray:
    """Where a new combination of the sorted keys begins."""
    new = np.zeros(len(sorted_keys[0]), dtype=bool)
    new[:1] = True
    for key in sorted_keys:
        new[1:] |= key[1:] != key[:-1]
    return np.flatnonzero(new)


def spread(values: np.ndarray, begins: np.ndarray, total: int) -> np.ndarray:
    return np.repeat(values, np.diff(np.append(begins, total)))


def dealt(
    target: np.ndarray, kind: int, columns: dict[str, np.ndarray], stepped: tuple[str, ...] = ()
) -> Iterator[tuple[int, int, bytes]]:
    """A blob for each target, with the records in the order given."""
    order = np.argsort(target, kind="stable")
    begins = runs_of(target[order])
    if not len(begins):
        return
    for a, b in zip(begins, np.append(begins[1:], len(order)), strict=True):
        own = order[a:b]
        yield int(target[own[0]]), kind, pack(**{k: steps(v[own]) if k in stepped else v[own] for k, v in columns.items()})


def batch_of(rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    target, kind, blob = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays(
        [pa.array(target, pa.int64()), pa.array(kind, pa.int32()), pa.array(blob, pa.binary())],
        names=["target", "kind", "blob"],
    )


def emitted(rows: Iterator[tuple[int, int, bytes]], limit: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    some, size = [], 0
    for row in rows:
        some.append(row)
        size += len(row[2])
        if size > limit:
            yield batch_of(some)
            some, size = [], 0
    if some:
        yield batch_of(some)
