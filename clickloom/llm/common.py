"""Small helpers that several operators of this subpackage share."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
import pyarrow.compute  # noqa: F401  (pa.compute)
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.session import work_path


def text_of(column: str = "text") -> Column:
    """The text of a row; a null text counts as an empty one."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def stored(df: DataFrame, name: str) -> DataFrame:
    """Writes ``df`` below the shared work folder and reads it back.

    This cuts the lineage: what follows survives the loss of executors without doing the
    work again, and several readers share one computation.
    """
    path = work_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fold_remainder(key: Column, divisor: int) -> Column:
    """crc32 of the key as text, modulo ``divisor``; a null key counts as empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % divisor


def slices(batches: Iterator[pa.RecordBatch], rows: int = 256,
           sized: str | None = None, size: int = 1 << 22) -> Iterator[pa.RecordBatch]:
    """Cuts batches to at most ``rows`` rows and, by the bytes of column ``sized``, to
    about ``size`` bytes (one row at least), so that memory in a task stays bounded."""
    for batch in batches:
        if sized is None:
            for at in range(0, batch.num_rows, rows):
                yield batch.slice(at, rows)
            continue
        lengths = pa.compute.fill_null(pa.compute.binary_length(batch.column(sized)), 0)
        begin = total = 0
        for at, length in enumerate(lengths.to_numpy(zero_copy_only=False)):
            if at > begin and (at - begin >= rows or total + length > size):
                yield batch.slice(begin, at - begin)
                begin, total = at, 0
            total += int(length)
        if begin < batch.num_rows:
            yield batch.slice(begin)


def ship(spark: SparkSession) -> SparkSession:
    """Sends this package to the Python workers, as --py-files would, once per context."""
    package = Path(__file__).resolve().parents[1]
    context = spark.sparkContext
    if package.is_dir() and not any("clickloom-src" in f for f in context.listFiles):
        target = Path(tempfile.mkdtemp(prefix="clickloom-")) / "clickloom-src.zip"
        with zipfile.ZipFile(target, "w") as archive:
            for source in sorted(package.rglob("*.py")):
                archive.write(source, source.relative_to(package.parent))
        context.addPyFile(str(target))
    return spark


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
