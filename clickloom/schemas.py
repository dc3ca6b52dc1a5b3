"""Explicit schemas; nothing is inferred, least of all on a stream."""

from __future__ import annotations

from pyspark.sql import types as T

# Event names and the time format of the message contract.
PAGE_VIEW = "ITEM_DETAIL"
ADD_TO_CART = "ADD_TO_CART"
PURCHASE = "BOOKING"
TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
TIME_OF_DAY_FORMAT = "HH:mm:ss"
# One to nine digits, which a writer may add to the time.
FRACTION = "[.SSSSSSSSS]"

SALES_EVENTS = (ADD_TO_CART, PURCHASE)
KNOWN_EVENTS = (PAGE_VIEW, ADD_TO_CART, PURCHASE)

_KINDS = {"bigint": T.LongType(), "double": T.DoubleType(), "string": T.StringType(),
          "date": T.DateType(), "timestamp": T.TimestampType()}


def schema_of(columns: str) -> T.StructType:
    """A schema from ``name kind`` pairs; unlike DDL it needs no running session."""
    pairs = [pair.split() for pair in columns.split(",")]
    return T.StructType([T.StructField(name, _KINDS[kind.lower()]) for name, kind in pairs])


# The history table, column by column, in its published order.
ENRICHED = schema_of("""
    customer_id BIGINT, session_id STRING, event_name STRING, event_time STRING,
    event_id STRING, traffic_source STRING, event_metadata STRING, payment_status STRING,
    search_keywords STRING, booking_id STRING, product_id DOUBLE, quantity DOUBLE,
    item_price DOUBLE, price_usd DOUBLE, first_name STRING, last_name STRING,
    username STRING, email STRING, gender STRING, birthdate STRING, device_type STRING,
    device_id STRING, device_version STRING, home_location_lat DOUBLE,
    home_location_long DOUBLE, home_location STRING, home_country STRING,
    first_join_date STRING, product_gender STRING, masterCategory STRING,
    subCategory STRING, articleType STRING, baseColour STRING, season STRING,
    product_year BIGINT, usage STRING, productDisplayName STRING
""")

# The message payload is the first part of the same contract.
EVENT = T.StructType(ENRICHED.fields[:14])

CUSTOMER = schema_of("""
    customer_id BIGINT, first_name STRING, last_name STRING, username STRING, email STRING,
    gender STRING, birthdate DATE, device_type STRING, device_id STRING,
    device_version STRING, home_location_lat DOUBLE, home_location_long DOUBLE,
    home_location STRING, home_country STRING, first_join_date DATE
""")

# The product table as stored, and the names its columns carry on an event.
PRODUCT = schema_of("""
    id BIGINT, gender STRING, mastercategory STRING, subcategory STRING,
    articletype STRING, basecolour STRING, season STRING, year BIGINT, usage STRING,
    productdisplayname STRING
""")
PRODUCT_NAMES = {"id": "product_id", "gender": "product_gender", "year": "product_year"}
