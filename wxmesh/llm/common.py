"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def crc_fold(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; a null id is in no fold (-1)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % modulus, F.lit(-1)).cast("int")


def as_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a text column; null is empty."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return [b if b is not None else b"" for b in column.cast(kind).to_pylist()]


def as_texts(column: pa.Array) -> list[str]:
    """A text column as str; null is empty, bytes that are not UTF-8 are replaced."""
    try:
        return [t if t is not None else "" for t in column.to_pylist()]
    except UnicodeDecodeError:
        return [b.decode("utf-8", "replace") for b in as_bytes(column)]


def column_of(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def record(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c.cast(f.type) if isinstance(c, pa.Array) else pa.array(c, f.type)
                                       for c, f in zip(columns, schema)], schema=schema)


def slices(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most ``rows``, so that what a task holds at once is small."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def pack_arrays(*arrays: np.ndarray) -> bytes:
    """Numpy vectors as one compressed binary value; ``unpack_arrays`` reads it back.

    The bytes of the elements are laid out plane by plane, so that the high
    bytes of small numbers compress to nothing.
    """
    out = []
    for a in arrays:
        planes = np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.dtype.itemsize).T.tobytes()
        body = pa.compress(planes, codec="zstd", asbytes=True) if planes else b""
        out.append(struct.pack("<2sqq", a.dtype.str[1:].encode(), len(a), len(body)) + body)
    return b"".join(out)


def unpack_arrays(blob: bytes) -> list[np.ndarray]:
    out, at, head = [], 0, struct.calcsize("<2sqq")
    while at < len(blob):
        kind, n, size = struct.unpack_from("<2sqq", blob, at)
        dtype = np.dtype("<" + kind.decode())
        planes = pa.decompress(blob[at + head:at + head + size], n * dtype.itemsize, codec="zstd", asbytes=True) if n else b""
        out.append(np.frombuffer(np.frombuffer(planes, np.uint8).reshape(dtype.itemsize, n).T.tobytes(), dtype))
        at += head + size
    return out


def smallest(values: np.ndarray) -> np.ndarray:
    """Non-negative integers in the smallest unsigned type that holds them."""
    top = int(values.max(initial=0))
    return values.astype(np.uint8 if top < 1 << 8 else np.uint16 if top < 1 << 16 else np.uint32 if top < 1 << 32 else np.uint64)


def byte_codes(raw: bytes, n: int) -> np.ndarray:
    """One unsigned 64-bit code per n-byte window (n up to 8), in text order."""
    a = np.frombuffer(raw, np.uint8).astype(np.uint64)
    m = len(a) - n + 1
    if m <= 0:
        return np.zeros(0, np.uint64)
    codes = a[:m].copy()
    for j in range(1, n):
        codes |= a[j:j + m] << np.uint64(8 * j)
    return codes


#: An odd multiplier (2**64 over the golden ratio) for multiplicative hashing.
MIX = np.uint64(0x9E3779B97F4A7C15)


def buckets(codes: np.ndarray, bits: int, seed: int) -> np.ndarray:
    """Hash bucket of each code, from the high bits of a seeded product."""
    x = (codes + np.uint64(seed)) * MIX
    x ^= x >> np.uint64(32)
    x *= MIX
    return (x >> np.uint64(64 - bits)).astype(np.int64)
