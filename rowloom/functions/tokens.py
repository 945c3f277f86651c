"""Partition tokens: a hash (or the bytes) of the partition key."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowloom.functions.types import col
from rowloom.session import ship

ship(__name__)

# The two multipliers and the finalizer of the public 128-bit x64 Murmur3 hash.
C1 = np.uint64(0x87C37B91114253D5)
C2 = np.uint64(0x4CF5AD432745937F)
ADD1, ADD2 = np.uint64(0x52DCE729), np.uint64(0x38495AB5)
FMIX1, FMIX2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
MAX_PART = 65535
UUID = "^[0-9A-Fa-f]{8}(-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}$"


def key_bytes(df: DataFrame, columns: list[str], uuids: Sequence[str] = ()) -> Column:
    """The key as stored: big-endian integers, UTF-8 text.

    A key of several columns is, per column, a two-byte length, the value's
    bytes and a zero byte. Null if any part is null, or longer than its length
    can tell. Text columns named in ``uuids`` are taken as the 16 bytes of a
    UUID, null if they are none.
    """
    parts = [
        _uuid_bytes(col(c)) if c in uuids else _value_bytes(col(c), df.schema[c].dataType)
        for c in columns
    ]
    if len(parts) == 1:
        return parts[0]
    framed = []
    for p in parts:
        size = F.unhex(F.lpad(F.hex(F.length(p).cast("bigint")), 4, "0"))
        framed += [F.when(F.length(p) <= MAX_PART, size), p, F.unhex(F.lit("00"))]
    return F.concat(*framed)


def _value_bytes(c: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, T.BinaryType):
        return c
    if isinstance(dtype, T.BooleanType):
        return F.unhex(F.when(c, "01").when(~c, "00"))
    if isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return _big_endian(F.unix_millis(c.cast("timestamp")), 16)
    for kind, digits in ((T.ByteType, 2), (T.ShortType, 4), (T.IntegerType, 8), (T.LongType, 16)):
        if isinstance(dtype, kind):
            return _big_endian(c.cast("bigint"), digits)
    if isinstance(dtype, T.StringType):
        return c.cast("binary")
    if isinstance(dtype, T.FloatType):
        return float_bytes(c)
    if isinstance(dtype, T.DoubleType):
        return double_bytes(c)
    if isinstance(dtype, T.DecimalType):
        return F.concat(_big_endian(F.lit(dtype.scale).cast("bigint"), 8), unscaled_bytes(c))
    raise TypeError(f"no key bytes for {dtype.simpleString()}")


def _uuid_bytes(c: Column) -> Column:
    return F.when(F.rlike(c, F.lit(UUID)), F.unhex(F.replace(c, F.lit("-"), F.lit(""))))


@F.pandas_udf(T.BinaryType())
def float_bytes(values: pd.Series) -> pd.Series:
    """IEEE bytes of floats, highest first."""
    return values.map(lambda v: np.array(v, ">f4").tobytes(), na_action="ignore")


@F.pandas_udf(T.BinaryType())
def double_bytes(values: pd.Series) -> pd.Series:
    """IEEE bytes of doubles, highest first."""
    return values.map(lambda v: np.array(v, ">f8").tobytes(), na_action="ignore")


@F.pandas_udf(T.BinaryType())
def unscaled_bytes(values: pd.Series) -> pd.Series:
    """The digits of decimals as one whole number, in the fewest signed bytes."""

    def pack(v):
        number = int(v.scaleb(-v.as_tuple().exponent))
        return number.to_bytes((number + (number < 0)).bit_length() // 8 + 1, "big", signed=True)

    return values.map(pack, na_action="ignore")


def _big_endian(c: Column, digits: int) -> Column:
    # hex of a negative bigint is its 16-digit two's complement: keep the low digits
    return F.unhex(F.right(F.lpad(F.hex(c), 16, "0"), F.lit(digits)))


def token(
    df: DataFrame, columns: list[str], partitioner: str = "xxhash64", uuids: Sequence[str] = ()
) -> Column:
    """Token of the key.

    ``xxhash64`` (default) is built in and serves to split and order a table,
    with other values than the store's. ``Murmur3Partitioner`` gives the
    store's bigint, ``RandomPartitioner`` the MD5 hex of the key bytes and
    ``ByteOrderedPartitioner`` the key bytes. Qualified names match by their
    ending; unknown or missing names mean Murmur3.
    """
    if partitioner == "xxhash64":
        return F.xxhash64(*[col(c) for c in columns])
    packed = key_bytes(df, columns, uuids)
    name = partitioner or ""
    if name.endswith("RandomPartitioner"):
        return F.md5(packed)
    if name.endswith("ByteOrderedPartitioner"):
        return packed
    return murmur3_token(packed)


@F.pandas_udf(T.LongType())
def murmur3_token(keys: pd.Series) -> pd.Series:
    """Murmur3 token of binary keys, one vectorised pass per key length in the batch."""
    out = pd.Series([None] * len(keys), dtype="Int64")
    sizes = keys.map(len, na_action="ignore").to_numpy()
    for size in {s for s in sizes if s == s and s is not None}:
        at = np.flatnonzero(sizes == size)
        raw = b"".join(keys.iloc[at])
        rows = np.frombuffer(raw, dtype=np.uint8).reshape(len(at), int(size))
        out.iloc[at] = murmur3_rows(rows)
    return out


def _rotl(x: np.ndarray, r: int) -> np.ndarray:
    return (x << np.uint64(r)) | (x >> np.uint64(64 - r))


def _fmix(h: np.ndarray) -> np.ndarray:
    for factor in (FMIX1, FMIX2):
        h = (h ^ (h >> np.uint64(33))) * factor
    return h ^ (h >> np.uint64(33))


def murmur3_rows(rows: np.ndarray) -> np.ndarray:
    """First 64 bits of Murmur3 x64-128 for equal-length keys (one key per row, seed 0).

    Bytes after the last full block are sign-extended, as the store does. The
    smallest bigint is not a token; it maps to the largest.
    """
    count, size = rows.shape
    h1 = np.zeros(count, dtype=np.uint64)
    h2 = np.zeros(count, dtype=np.uint64)
    full = size // 16 * 16
    with np.errstate(over="ignore"):
        if full:
            words = np.ascontiguousarray(rows[:, :full]).view("<u8")
            for i in range(0, words.shape[1], 2):
                h1 ^= _rotl(words[:, i] * C1, 31) * C2
                h1 = (_rotl(h1, 27) + h2) * np.uint64(5) + ADD1
                h2 ^= _rotl(words[:, i + 1] * C2, 33) * C1
                h2 = (_rotl(h2, 31) + h1) * np.uint64(5) + ADD2
        tail = rows[:, full:].view(np.int8).astype(np.int64).view(np.uint64)
        k1 = np.zeros(count, dtype=np.uint64)
        k2 = np.zeros(count, dtype=np.uint64)
        for i in range(tail.shape[1]):
            shifted = tail[:, i] << np.uint64(8 * (i % 8))
            if i < 8:
                k1 ^= shifted
            else:
                k2 ^= shifted
        h2 ^= _rotl(k2 * C2, 33) * C1
        h1 ^= _rotl(k1 * C1, 31) * C2
        h1 ^= np.uint64(size)
        h2 ^= np.uint64(size)
        h1 = h1 + h2
        h2 = h2 + h1
        h1 = _fmix(h1) + _fmix(h2)
    tokens = h1.view(np.int64)
    limits = np.iinfo(np.int64)
    return np.where(tokens == limits.min, limits.max, tokens)
