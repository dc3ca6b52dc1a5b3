"""What a stream carries from one micro-batch to the next, in small tables of its own.

A table has two slots. Micro-batch ``n`` reads the slot that ``n - 1`` wrote and overwrites
the other one. Repeated, it finds the same input and writes the same rows again; no slot is
overwritten before the micro-batch after its own has begun, and nothing piles up.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

_SLOTS = 2


def carried(spark: SparkSession, path: str, schema: str | T.StructType, batch_id: int) -> DataFrame:
    """The rows that the micro-batch before left; none before the first."""
    if batch_id == 0:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{path}/slot={(batch_id - 1) % _SLOTS}")


def carry(rows: DataFrame, path: str, batch_id: int) -> None:
    rows.write.mode("overwrite").parquet(f"{path}/slot={batch_id % _SLOTS}")


def prepare(empty: DataFrame, path: str) -> None:
    """Creates a result table without rows, so that it can be read before it has any."""
    empty.limit(0).write.mode("ignore").parquet(f"{path}/batch=-1")


def drop_folder(spark: SparkSession, path: str) -> None:
    """Removes a folder from the file system it lies in; nothing happens if it is not there."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
