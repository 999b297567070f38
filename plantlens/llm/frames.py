"""Frame helpers shared by the operators of this subpackage."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

import plantlens
from plantlens.session import scratch_path


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the package to the Python workers of every executor, once an application."""
    app = spark.sparkContext.applicationId
    if app not in _shipped:
        package = Path(plantlens.__file__).parent
        target = Path(tempfile.mkdtemp(prefix="plantlens-code-")) / "plantlens_code.zip"
        with zipfile.ZipFile(target, "w") as z:
            for file in sorted(package.rglob("*.py")):
                z.write(file, str(Path("plantlens") / file.relative_to(package)))
        spark.sparkContext.addPyFile(str(target))
        _shipped.add(app)


def map_arrow(df: DataFrame, run: Callable, schema) -> DataFrame:
    """``mapInArrow`` with the package at hand in the workers."""
    ship(df.sparkSession)
    return df.mapInArrow(run, schema)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, label: str) -> DataFrame:
    """Write to the shared folder and read back: a cut that survives lost executors."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` is called so."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def with_columns(df: DataFrame, new: str) -> T.StructType:
    """Schema of ``df`` plus the new columns; one of the same name is replaced."""
    added = T.StructType.fromDDL(new)
    names = {f.name.lower() for f in added}
    return T.StructType([f for f in df.schema if f.name.lower() not in names] + list(added))


def map_batches(
    df: DataFrame, new: str, columns: Callable[[pa.RecordBatch], Iterable], needs: tuple[str, ...] = (),
) -> DataFrame:
    """Append columns computed from whole Arrow batches.

    ``columns`` gives one array for each new column, in order.  A column of
    ``df`` with the name of a new one is replaced.
    """
    schema = with_columns(df, new)
    kept = [f.name for f in schema][:len(schema) - len(T.StructType.fromDDL(new))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = list(columns(batch))
            yield pa.RecordBatch.from_arrays(
                [batch.column(batch.schema.get_field_index(k)) for k in kept] + made,
                names=[f.name for f in schema])

    return map_arrow(df, run, schema)


def bounded(batches: Iterable[pa.RecordBatch], column: str, size: int) -> Iterator[pa.RecordBatch]:
    """Slices of the batches whose ``column`` holds about ``size`` bytes at most; a longer value is a slice of its own."""
    for batch in batches:
        lengths = pc.binary_length(batch.column(batch.schema.get_field_index(column)).cast(pa.large_binary()))
        ends = np.cumsum(lengths.fill_null(0).to_numpy(zero_copy_only=False))
        row = 0
        while row < batch.num_rows:
            before = ends[row - 1] if row else 0
            end = max(row + 1, int(np.searchsorted(ends, before + size, side="right")))
            yield batch.slice(row, end - row)
            row = end


def digest(c) -> F.Column:
    """Lowercase hex SHA-256 of a string's UTF-8 bytes or of binary; null counts as empty."""
    return F.sha2(F.coalesce(c, F.lit("").cast("binary")), 256)


def held_out(remainder: int, buckets: int, doc_id: str = "doc_id") -> F.Column:
    """True where crc32 of the id as text leaves this remainder; a null id is never held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % buckets == remainder, F.lit(False))
