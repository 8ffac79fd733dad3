"""Texts dealt into chunks, and their hashes into buckets: the exchange behind the corpus-wide operators.

A chunk is some megabytes of whole texts, dealt by a hash of the row.  A chunk sends each
*distinct* hash it has once, packed with those of the same bucket; a bucket compares what
it got and answers the chunks.  So a passage that a third of all documents share is one
hash per chunk, not one per document, and no group is larger than the number of chunks.

In a bucket a hash is sent as ``SHORT`` bytes.  The bucket holds about ``BUCKET_WORDS`` hashes at
every data size, so the chance that two different ones meet stays below one in a million
for each; operators that use short hashes only choose candidates by them.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

U64 = np.uint64
CHUNK_BYTES = 3 << 20
BUCKET_WORDS = 1 << 20
SHORT = 5
_LOW = U64((1 << 8 * SHORT) - 1)


def sizes(docs: DataFrame) -> tuple[int, int]:
    """Numbers of chunks and of buckets, from the bytes of all texts (one pass over the text column)."""
    total = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    return max(1, -(-total // CHUNK_BYTES)), max(1, -(-total // (6 * BUCKET_WORDS)))


def texts_of(group: pa.Table, column: str = "text") -> pa.Array:
    found = group.column(column).combine_chunks()
    return pa.concat_arrays(found.chunks) if isinstance(found, pa.ChunkedArray) and found.chunks else found


def bucket_of(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Rises with the hash, so sorted hashes come bucket by bucket."""
    return ((hashes >> U64(32)) * U64(buckets) >> U64(32)).astype(np.int64)


def short(hashes: np.ndarray) -> bytes:
    return np.ascontiguousarray(hashes.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :SHORT]).tobytes()


def from_short(raw: bytes) -> np.ndarray:
    out = np.zeros((len(raw) // SHORT, 8), np.uint8)
    out[:, :SHORT] = np.frombuffer(raw, np.uint8).reshape(-1, SHORT)
    return out.view("<u8").ravel().astype(U64)


def keys_of(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket and short hash as one number: what a chunk compares with its answers."""
    return (bucket_of(hashes, buckets).astype(U64) << U64(8 * SHORT)) | (hashes & _LOW)


def answered(bucket: int, raw: bytes) -> np.ndarray:
    return (U64(bucket) << U64(8 * SHORT)) | from_short(raw)


def slices(buckets: np.ndarray) -> list[tuple[int, int, int]]:
    """(bucket, from, to) of each run in ascending bucket numbers."""
    if not len(buckets):
        return []
    at = np.flatnonzero(np.diff(buckets)) + 1
    return [(int(buckets[a]), int(a), int(b)) for a, b in zip([0, *at], [*at, len(buckets)], strict=True)]


def find(values: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place of each value in the ascending table, and whether it is there."""
    if not len(table):
        return np.zeros(len(values), np.int64), np.zeros(len(values), bool)
    at = np.minimum(np.searchsorted(table, values), len(table) - 1)
    return at, table[at] == values


def bits(marks: np.ndarray) -> bytes:
    return np.packbits(marks).tobytes()


def from_bits(raw: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(raw, np.uint8), count=n).astype(bool)
