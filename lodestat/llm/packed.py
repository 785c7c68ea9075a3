"""Small binary helpers for rows that hold many numbers."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_CODEC = pa.Codec("zstd", 3)


def squeeze(numbers: np.ndarray) -> bytes:
    """Unsigned 32-bit numbers, byte plane after byte plane, compressed."""
    planes = np.ascontiguousarray(numbers.astype("<u4")).view("uint8").reshape(-1, 4).T
    return _CODEC.compress(np.ascontiguousarray(planes), asbytes=True)


def unsqueeze(data: bytes, n: int) -> np.ndarray:
    """The ``n`` numbers that ``squeeze`` took."""
    planes = np.frombuffer(_CODEC.decompress(data, n * 4, asbytes=True), "uint8").reshape(4, n)
    return np.ascontiguousarray(planes.T).reshape(-1).view("<u4")


def lists(values: np.ndarray, before: np.ndarray, kind: pa.DataType) -> pa.Array:
    """List column of the runs ``before[i] .. before[i + 1]`` of ``values``."""
    return pa.ListArray.from_arrays(pa.array(before, pa.int32()), pa.array(values, kind))


def by_weight(weights: np.ndarray, most: int) -> list[tuple[int, int]]:
    """Neighbouring rows in slices of a total weight of at most ``most``, or of one heavier row."""
    out, start, total = [], 0, 0
    for i, w in enumerate(weights.tolist()):
        if i > start and total + w > most:
            out.append((start, i))
            start, total = i, 0
        total += w
    return [*out, (start, len(weights))] if len(weights) else []
