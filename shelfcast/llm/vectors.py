"""Integer vectors in packed blocks: what operators 12 and 13 share.

A block is one row that holds the vectors of one Arrow batch as bytes, in the
smallest integer type that fits them, so that repeated passes neither decode
lists nor shuffle.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_LONG = float(2 ** 63)
_LONG_TOP = float(2 ** 63 - 1024)          # the largest double below 2**63


def kept_vectors(df: DataFrame, *columns: str) -> DataFrame:
    """``columns`` and ``embedding`` of the rows whose vector is not null and holds only finite numbers."""
    e = F.col("embedding")
    bad = F.exists(e, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == F.lit(float("inf"))))
    return df.select(*columns, "embedding").filter(e.isNotNull() & ~bad)


def longest(vectors: DataFrame) -> int:
    """The number of components of the longest vector, at least 1."""
    return max(vectors.agg(F.max(F.size("embedding")).alias("d")).first()["d"] or 0, 1)


def scaled_floor(column: pa.Array, scale: int, width: int) -> np.ndarray:
    """``floor(scale * x)`` of a list column as whole doubles, one row a vector, zeros after the end of shorter ones.

    Products with a power of two are exact; results saturate at the range of a long.
    """
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    whole = np.clip(np.floor(flat * scale), -_LONG, _LONG_TOP) + 0.0
    lengths = np.diff(column.offsets.to_numpy()) if len(column) else np.zeros(0, np.int64)
    if (lengths == width).all():
        return whole.reshape(len(column), width)
    out = np.zeros((len(column), width))
    out[np.arange(width) < lengths[:, None]] = whole
    return out


def smallest_type(x: np.ndarray) -> np.dtype:
    top = np.abs(x).max(initial=0)
    return np.dtype("<i2" if top < 2 ** 15 else "<i4" if top < 2 ** 31 else "<i8")


def pack(x: np.ndarray) -> tuple[str, bytes]:
    kind = smallest_type(x)
    return kind.str, x.astype(kind).tobytes()


def unpack(kind: str, data: bytes, width: int) -> np.ndarray:
    return np.frombuffer(data, dtype=kind).reshape(-1, width)


def exact(x: np.ndarray, limit: int) -> np.ndarray:
    """``x`` for integer arithmetic: longs if all are below ``limit`` in size, else Python integers."""
    if not x.size or (int(x.max()) < limit and int(x.min()) > -limit):
        return x.astype(np.int64)
    return x.astype(object)
