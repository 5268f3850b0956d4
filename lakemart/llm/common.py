"""Shared helpers: shipping the package, stored interim tables, batches of texts."""

from __future__ import annotations

import hashlib
import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.session import scratch_dir

# Words are maximal runs of anything but these six characters.
SPACES = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once per session."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    target = os.path.join(tempfile.mkdtemp(prefix="ship-"), "lakemart.zip")
    with zipfile.ZipFile(target, "w") as archive:
        for folder, _, names in os.walk(package):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    archive.write(full, os.path.relpath(full, os.path.dirname(package)))
    spark.sparkContext.addPyFile(target)
    _shipped.add(app)


def stored(df: DataFrame, label: str) -> DataFrame:
    """A written copy in the cluster's shared folder, read back."""
    path = scratch_dir(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def read_documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def set_aside(docs: DataFrame) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """The table with other names for columns that begin like the operators' own, and the way back."""
    taken, names = {c.lower() for c in docs.columns}, {}
    for column in docs.columns:
        if column.startswith("__"):
            other = f"caller{column}"
            while other.lower() in taken:
                other += "_"
            taken.add(other.lower())
            names[column] = other
    return docs.withColumnsRenamed(names), lambda out: out.withColumnsRenamed({other: column for column, other in names.items()})


def text_of(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def sha256(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()


def slices(batches: Iterator[pa.RecordBatch], text: str, limit: int = 4 << 20) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Arrow batches cut into slices of about ``limit`` bytes of text, with their texts.

    A slice has at least one row; a NULL text counts as empty.
    """
    for batch in batches:
        column = batch.column(text)
        sizes = np.asarray(pc.fill_null(pc.binary_length(column), 0), dtype=np.int64)
        block = np.cumsum(sizes) // limit
        starts = np.flatnonzero(np.diff(block, prepend=-1))
        for low, high in zip(starts, [*starts[1:], batch.num_rows]):
            part = batch.slice(low, high - low)
            yield part, [t or "" for t in part.column(text).to_pylist()]


def batch_of(keys: pa.RecordBatch, names: list[str], **columns) -> pa.RecordBatch:
    """The named key columns of a batch followed by new columns."""
    arrays = [keys.column(n) for n in names] + [
        a if isinstance(a, (pa.Array, pa.ChunkedArray)) else pa.array(a) for a in columns.values()
    ]
    return pa.RecordBatch.from_arrays(arrays, names=[*names, *columns])


def bucket_hash(*columns: Column | str) -> Column:
    """53 bits of a keyed-by-content hash as a number in [0, 1)."""
    digits = F.substring(F.md5(F.concat_ws("\x1f", *columns)), 1, 13)
    return F.conv(digits, 16, 10).cast("double") / F.lit(float(1 << 52))
