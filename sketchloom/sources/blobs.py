"""Elias-Fano blobs as a BINARY column.

Layout, little endian: "EFU1", count u64, universe u64, low bits u32, bytes of the low part u64,
bytes of the high part u64, low part (bits packed from the lowest), high part (a one for each value
at its high part plus its position).
"""

from __future__ import annotations

import struct

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

HEAD = struct.Struct("<4sQQIQQ")


def pack(values: np.ndarray) -> bytes:
    """A sorted array of unsigned numbers as a blob; the empty array is a blob of none."""
    values = np.asarray(values, np.uint64)
    n, universe = len(values), int(values[-1]) if len(values) else 0
    low = max(0, (universe // n).bit_length() - 1) if n and universe > n else 0
    bits = ((values[:, None] >> np.arange(low, dtype=np.uint64)) & np.uint64(1)).astype(np.uint8)
    lows = np.packbits(bits.ravel(), bitorder="little").tobytes()
    at = (values >> np.uint64(low)).astype(np.int64) + np.arange(n)
    high = np.zeros(int(at[-1]) + 1 if n else 0, np.uint8)
    high[at] = 1
    highs = np.packbits(high, bitorder="little").tobytes()
    return HEAD.pack(b"EFU1", n, universe, low, len(lows), len(highs)) + lows + highs


def unpack(blob: bytes) -> np.ndarray:
    """The values of a blob; a blob of another kind or length is an error."""
    magic, n, _, low, n_low, n_high = HEAD.unpack_from(blob)
    if magic != b"EFU1" or len(blob) != HEAD.size + n_low + n_high:
        raise ValueError("not an Elias-Fano blob")
    body = np.frombuffer(blob, np.uint8, offset=HEAD.size)
    bits = np.unpackbits(body[:n_low], bitorder="little")[: n * low].reshape(n, low).astype(np.uint64)
    lows = (bits << np.arange(low, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)
    at = np.flatnonzero(np.unpackbits(body[n_low:], bitorder="little"))
    if len(at) != n:
        raise ValueError("an Elias-Fano blob with a wrong count")
    return ((at - np.arange(n)).astype(np.uint64) << np.uint64(low)) | lows


def ef_encode(sets: str | Column) -> Column:
    """A column of sorted arrays of longs as blobs; null stays null."""

    def run(values: pd.Series) -> pd.Series:
        return values.map(lambda x: None if x is None else pack(x))

    run.__annotations__ = {"values": pd.Series, "return": pd.Series}
    return F.pandas_udf(run, "binary")(sets)


def ef_decode(blobs: str | Column) -> Column:
    """A column of blobs as sorted arrays of longs; null stays null."""

    def run(values: pd.Series) -> pd.Series:
        return values.map(lambda x: None if x is None else unpack(x).astype(np.int64))

    run.__annotations__ = {"values": pd.Series, "return": pd.Series}
    return F.pandas_udf(run, "array<long>")(blobs)
