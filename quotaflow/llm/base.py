"""Small helpers the operators of this subpackage share."""

from __future__ import annotations

import shutil
import tempfile
import uuid
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.scratch import shared_root

# Python tasks cut their Arrow batches into pieces of about this many bytes of
# text, so that the arrays made from a piece stay small.
PIECE_BYTES = 2 << 20


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Sends this package to the executors, once per application, so that their Python finds its modules."""
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        package = Path(__file__).resolve().parent.parent
        archive = Path(tempfile.mkdtemp(prefix="package-")) / package.name
        context.addPyFile(shutil.make_archive(str(archive), "zip", package.parent, package.name))
        _shipped.add(context.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def crc_mod(doc_id: Column, n: int) -> Column:
    """crc32 of the id written as text, modulo ``n``; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % n


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back: later steps start from the files."""
    path = f"{shared_root(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def pieces(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive slices of the batches with about ``limit`` bytes of ``column``; a row is never cut."""
    for batch in batches:
        sizes = batch.column(column)
        lengths = pc.binary_length(sizes).fill_null(0).to_numpy(zero_copy_only=False)
        start, total = 0, 0
        for i, n in enumerate(lengths):
            total += int(n)
            if total >= limit:
                yield batch.slice(start, i + 1 - start)
                start, total = i + 1, 0
        if start < len(lengths):
            yield batch.slice(start)


def is_text(column: Column | str) -> bool:
    return isinstance(column, str) and column == "text"


def text_bytes(texts: pa.Array) -> list[bytes]:
    """The rows' texts as UTF-8; null is empty."""
    return [b"" if t is None else t for t in texts.cast(pa.binary()).to_pylist()]
