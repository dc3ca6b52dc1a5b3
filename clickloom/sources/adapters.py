"""The driver's star-schema tables, read as a clickstream and its two dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from clickloom.operators.enrich import one_per_key
from clickloom.schemas import ADD_TO_CART, PAGE_VIEW, PURCHASE

# The driver's tables never change, so each file's schema is inferred once per process.
_schemas: dict[str, T.StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir}/{name}.parquet"
    if path not in _schemas:
        _schemas[path] = spark.read.parquet(path).schema
    return spark.read.schema(_schemas[path]).parquet(path)


def as_clickstream(events: DataFrame) -> DataFrame:
    """Works on a batch or a streaming read of ``events``; ``event_time`` is a timestamp."""
    return events.selectExpr(
        "user_id AS customer_id",
        "concat_ws('-', user_id, to_date(ts)) AS session_id",
        f"""CASE event_type WHEN 'view' THEN '{PAGE_VIEW}' WHEN 'click' THEN '{ADD_TO_CART}'
            WHEN 'purchase' THEN '{PURCHASE}' ELSE upper(event_type) END AS event_name""",
        "CAST(ts AS TIMESTAMP) AS event_time",
        "CAST(event_id AS STRING) AS event_id",
        """CASE event_id % 4 WHEN 0 THEN 'Direct' WHEN 1 THEN 'Search' WHEN 2 THEN 'Email'
            ELSE 'Social' END AS traffic_source""",
        "props AS event_metadata",
        "CASE WHEN event_type = 'purchase' THEN 'Success' END AS payment_status",
        "CAST(NULL AS STRING) AS search_keywords",
        "CASE WHEN event_type = 'purchase' THEN concat('B', event_id) END AS booking_id",
        "CAST(get_json_object(props, '$.k') AS DOUBLE) AS product_id",
        "CAST(event_id % 3 + 1 AS DOUBLE) AS quantity",
        "value AS item_price",
        "value AS price_usd",
    )


def clickstream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_clickstream(table(spark, sf_dir, "events"))


def customer_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``customer`` in the stored shape (schemas.CUSTOMER)."""
    nation = one_per_key(
        table(spark, sf_dir, "nation").select("n_nationkey", "n_name"), "n_nationkey", unique=True)
    customers = table(spark, sf_dir, "customer")
    with_nation = customers.join(
        nation, customers["c_nationkey"] == nation["n_nationkey"], "left")
    return with_nation.selectExpr(
        "c_custkey AS customer_id",
        "substring_index(c_name, '#', 1) AS first_name",
        "substring_index(c_name, '#', -1) AS last_name",
        "lower(c_name) AS username",
        "concat('c', c_custkey, '@example.com') AS email",
        "CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS gender",
        "date_add(DATE '1960-01-01', CAST(c_custkey % 15000 AS INT)) AS birthdate",
        "c_mktsegment AS device_type",
        "concat('dev-', c_custkey) AS device_id",
        "concat('v', c_custkey % 5) AS device_version",
        "CAST(c_custkey % 18 * 10 - 85 AS DOUBLE) AS home_location_lat",
        "CAST(c_custkey % 12 * 30 - 165 AS DOUBLE) AS home_location_long",
        "concat('city-', c_custkey % 100) AS home_location",
        "n_name AS home_country",
        "date_add(DATE '2015-01-01', CAST(c_custkey % 3000 AS INT)) AS first_join_date",
    )


def product_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``part`` in the stored shape (schemas.PRODUCT), before projection and renaming."""
    return table(spark, sf_dir, "part").selectExpr(
        "p_partkey AS id",
        "CASE p_size % 3 WHEN 0 THEN 'Men' WHEN 1 THEN 'Women' ELSE 'Unisex' END AS gender",
        "p_type AS mastercategory",
        "p_brand AS subcategory",
        "substring_index(p_name, ' ', -1) AS articletype",
        "substring_index(p_name, ' ', 1) AS basecolour",
        """CASE p_size % 4 WHEN 0 THEN 'Spring' WHEN 1 THEN 'Summer' WHEN 2 THEN 'Fall'
            ELSE 'Winter' END AS season""",
        "CAST(p_size % 10 + 2010 AS BIGINT) AS year",
        "CASE p_size % 2 WHEN 0 THEN 'Casual' ELSE 'Formal' END AS usage",
        "p_name AS productdisplayname",
    )
