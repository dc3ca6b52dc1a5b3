"""Dimensions written once, one row per key, dealt out by the key.

A stream joins its dimension in every micro-batch. Frozen, the dimension is read from its
source and made unique once; its files are bucketed and sorted by the key, so a join reads
them in place and shuffles the events alone. Small ones are still broadcast, by their size.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickloom.functions.temporal import temporals_as_text
from clickloom.operators.enrich import one_per_key
from clickloom.session import work_path

BUCKETS = 200


def freeze(dimension: DataFrame, key: str, key_type: str, buckets: int = BUCKETS,
           newest_by: str | None = None, path: str | None = None) -> DataFrame:
    """Writes the dimension below ``path`` and returns it as the table that was written.

    ``key_type`` is the type of the key on the events. Rows without a key match nothing and
    are left out. Give as many buckets as the joins have shuffle partitions.
    """
    spark = dimension.sparkSession
    typed = temporals_as_text(dimension).withColumn(key, F.col(key).cast(key_type))
    rows = one_per_key(typed.where(F.col(key).isNotNull()), key, newest_by)
    name = f"frozen_{key}_{uuid.uuid4().hex}"
    path = path or work_path(spark, name)
    writer = rows.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key)
    writer.option("path", path).saveAsTable(name)
    return spark.table(name)


def frozen_at(spark: SparkSession, path: str, schema: T.StructType, key: str, buckets: int) -> DataFrame:
    """A dimension frozen by another session, from its folder; schema and buckets as written."""
    name = f"frozen_{key}_{uuid.uuid4().hex}"
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY (`{key}`) "
              f"SORTED BY (`{key}`) INTO {int(buckets)} BUCKETS LOCATION '{path}'")
    return spark.table(name)
