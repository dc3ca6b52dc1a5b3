"""Where rows come from: message topics, folders, database tables, the history table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickloom.schemas import PRODUCT_NAMES


def topic(spark: SparkSession, servers: str, name: str, streaming: bool = True,
          **options: str) -> DataFrame:
    """Messages of a Kafka topic as ``value``; needs the spark-sql-kafka package.

    ``timestamp`` is the publish time, for windows on arrival instead of event time.
    """
    reader = spark.readStream if streaming else spark.read
    source = reader.format("kafka").option("kafka.bootstrap.servers", servers)
    return source.option("subscribe", name).options(**options).load().select(
        "value", "timestamp")


def message_folder(spark: SparkSession, path: str, streaming: bool = True,
                   files_per_batch: int | None = 1000) -> DataFrame:
    """One message per line of the text files in a folder. With no limit on the files, what is
    there when a micro-batch begins is one micro-batch."""
    if not streaming:
        return spark.read.text(path)
    reader = spark.readStream
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.text(path)


def table_folder(spark: SparkSession, path: str, schema: T.StructType,
                 files_per_batch: int = 1000, pattern: str | None = None) -> DataFrame:
    """A stream over the Parquet files that appear in a folder."""
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.parquet(path)


def database_table(spark: SparkSession, url: str, name: str, split_on: str | None = None,
                   bounds: tuple[int, int] | None = None, splits: int = 32,
                   **options: str) -> DataFrame:
    """A JDBC table; column pruning and filters reach the database.

    With ``split_on`` and ``bounds`` it is read by ``splits`` parallel range queries,
    otherwise by one task, which only suits a small dimension.
    """
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", name)
    reader = reader.option("fetchsize", "10000").options(**options)
    if split_on and bounds:
        reader = reader.options(partitionColumn=split_on, lowerBound=str(bounds[0]),
                                upperBound=str(bounds[1]), numPartitions=str(splits))
    return reader.load()


def product_dimension(products: DataFrame) -> DataFrame:
    """The ten product columns an event is enriched with, under their event names."""
    kept = ("id", "gender", "mastercategory", "subcategory", "articletype", "basecolour",
            "season", "year", "usage", "productdisplayname")
    return products.select(*[F.col(c).alias(PRODUCT_NAMES.get(c, c)) for c in kept])


def history(spark: SparkSession, path: str) -> DataFrame:
    """The enriched history table, partitioned by ``event_date``."""
    return spark.read.parquet(path)
