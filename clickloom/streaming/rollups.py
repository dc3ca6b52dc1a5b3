"""Daily summaries kept up by the enriched stream.

Each micro-batch adds its own days under its id: rows that add up with those of other
micro-batches, bitmaps that unite with theirs, and numbers for sessions and customers that no
earlier micro-batch has seen. Repeated, it overwrites what it wrote, so a retry counts nothing
twice; its numbers depend on its keys and the micro-batches before it alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.readwriter import DataStreamWriter

from clickloom.operators import rollup
from clickloom.streaming.state import prepare

TABLES = ("totals", "sales", *rollup.DISTINCTS)


def rollup_writer(enriched: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    """Tables ``totals``, ``sales``, ``session_id``, ``customer_id`` below ``path``, and the
    dictionaries ``<key>_ids``."""
    used = ["session_id", "customer_id", "event_name", "event_time", "price_usd", "quantity",
            *[k for keys in rollup.BREAKDOWNS.values() for k in keys]]
    rows = enriched.select(*used)
    empty = enriched.sparkSession.createDataFrame([], rows.schema)
    prepare(rollup.daily_totals(empty), f"{path}/totals")
    prepare(rollup.daily_sales(empty), f"{path}/sales")
    for key in rollup.DISTINCTS:
        ids = empty.select(key, F.lit(0).cast("bigint").alias("id"))
        prepare(ids, f"{path}/{key}_ids")
        prepare(rollup.daily_bitmaps(empty, key, ids), f"{path}/{key}")

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession

        def put(table: str, result: DataFrame) -> None:
            result.write.mode("overwrite").parquet(f"{path}/{table}/batch={batch_id}")

        # Six tables read the micro-batch; its messages are parsed and enriched once.
        batch = batch.persist()
        try:
            put("totals", rollup.daily_totals(batch))
            put("sales", rollup.daily_sales(batch))
            for key in rollup.DISTINCTS:
                stored = spark.read.parquet(f"{path}/{key}_ids")
                known = stored.where(F.col("batch") < batch_id)
                start = known.agg(F.coalesce(F.max("id") + 1, F.lit(0))).first()[0]
                put(f"{key}_ids", rollup.new_keys(batch, key, known.select(key, "id"), start))
                known = spark.read.schema(stored.schema).parquet(f"{path}/{key}_ids").where(
                    F.col("batch") <= batch_id)
                put(key, rollup.daily_bitmaps(batch, key, known.select(key, "id")))
        finally:
            batch.unpersist()

    return rows.writeStream.outputMode("append").option(
        "checkpointLocation", checkpoint).foreachBatch(write)


def summary(spark: SparkSession, path: str, table: str) -> DataFrame:
    """One of ``TABLES``, over all micro-batches."""
    return spark.read.parquet(f"{path}/{table}").drop("batch")
