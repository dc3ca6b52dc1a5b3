import pytest
from pyspark.sql import functions as F

from clickloom.operators.enrich import conform, enrich, enriched_history, lookup, one_per_key
from clickloom.schemas import CUSTOMER, ENRICHED, PRODUCT
from clickloom.session import work_path
from clickloom.sources.readers import history, product_dimension
from clickloom.sources.sinks import append_history


def plan_of(df, mode="simple"):
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), mode)


@pytest.fixture
def clicks(spark):
    return spark.createDataFrame(
        [(1, "a", 12.0, "from event"), (2, "b", 99.0, "from event"), (None, "c", None, "from event")],
        "customer_id BIGINT, session_id STRING, product_id DOUBLE, gender STRING")


@pytest.fixture
def customers(spark):
    rows = [(1, "Ann", None, "2000-01-02"), (3, "Cid", "M", "2001-01-02")]
    return spark.createDataFrame(
        rows, "customer_id BIGINT, first_name STRING, gender STRING, birthdate STRING"
    ).withColumn("birthdate", F.col("birthdate").cast("date"))


@pytest.fixture
def products(spark):
    row = (12, "Men", "Apparel", "Topwear", "Shirts", "Blue", "Fall", 2011, "Casual", "Shirt")
    return product_dimension(spark.createDataFrame([row], PRODUCT))


def by_session(df):
    return {r.session_id: r for r in df.collect()}


def test_unmatched_and_null_keys_keep_the_event(clicks, customers, products):
    rows = by_session(enrich(clicks, customers, products))
    assert set(rows) == {"a", "b", "c"}
    assert rows["a"].first_name == "Ann" and rows["a"].productdisplayname == "Shirt"
    assert rows["b"].first_name is None and rows["c"].productdisplayname is None


def test_dimension_overwrites_even_with_null(clicks, customers):
    rows = by_session(lookup(clicks, customers, "customer_id"))
    assert rows["a"].gender is None
    assert rows["b"].gender == "from event" and rows["c"].gender == "from event"


def test_double_key_meets_integer_key(clicks, products):
    assert by_session(lookup(clicks, products, "product_id"))["a"].season == "Fall"


def test_duplicate_keys_do_not_multiply(clicks, customers):
    doubled = customers.unionAll(customers.withColumn("first_name", F.lit("Zoe")))
    assert lookup(clicks, doubled, "customer_id").count() == 3


def test_newest_row_of_a_key(spark):
    df = spark.createDataFrame([(1, "old", 1), (1, "new", 2)], "k INT, v STRING, at INT")
    assert one_per_key(df, "k", newest_by="at").first().v == "new"


@pytest.mark.parametrize("salts", [1, 8])
def test_shuffled_and_salted_lookup_equal_the_broadcast_one(spark, customers, salts):
    clicks = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 1).when(F.col("id") % 3 == 1, F.col("id") % 50)
        .cast("bigint").alias("customer_id"), F.col("id").alias("event_id"))
    expected = lookup(clicks, customers, "customer_id").collect()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        shuffled = lookup(clicks, customers, "customer_id", salts)
        assert "BroadcastHashJoin" not in plan_of(shuffled)
        assert sorted(shuffled.collect(), key=lambda r: r.event_id) == sorted(
            expected, key=lambda r: r.event_id)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "64MB")
        spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "64MB")


def test_salted_copies_are_shuffled_not_broadcast(spark, customers):
    clicks = spark.range(3000).select(
        (F.col("id") % 4).cast("bigint").alias("customer_id"), F.col("id").alias("event_id"))
    expected = lookup(clicks, customers, "customer_id").collect()
    salted = lookup(clicks, customers, "customer_id", 8)
    rows = salted.collect()
    assert "BroadcastHashJoin" not in plan_of(salted)
    assert sorted(rows, key=lambda r: r.event_id) == sorted(expected, key=lambda r: r.event_id)


def test_small_dimensions_are_broadcast(spark, tmp_path, clicks, customers, products):
    customers.write.parquet(str(tmp_path / "c"))
    products.write.parquet(str(tmp_path / "p"))
    enriched = enrich(clicks, spark.read.parquet(str(tmp_path / "c")),
                      spark.read.parquet(str(tmp_path / "p")))
    assert plan_of(enriched).count("BroadcastHashJoin") == 2


def test_unused_dimensions_are_not_read(clicks, customers, products):
    used = enrich(clicks, customers, products).groupBy("session_id").agg(F.count("*"))
    assert "Join" not in plan_of(used)


def test_conform_gives_exactly_the_history_columns(clicks, customers, products):
    df = conform(enrich(clicks, customers, products).withColumn("extra", F.lit(1)))
    assert df.schema.fieldNames() == ENRICHED.fieldNames()
    assert [f.dataType for f in df.schema] == [f.dataType for f in ENRICHED]
    row = by_session(df)["a"]
    assert row.masterCategory == "Apparel" and row.birthdate == "2000-01-02 00:00:00"
    assert row.username is None


def test_customer_schema_is_covered():
    assert set(CUSTOMER.fieldNames()) <= set(ENRICHED.fieldNames())


def test_history_is_appended_by_date(spark, events, customers, products):
    path = work_path(spark, "history")
    day1 = events(("s", "BOOKING", "2024-01-01 23:59:59", 12.0, 1.0, 2.0, 1))
    day2 = events(("s", "BOOKING", "2024-01-02 00:00:00", 12.0, 1.0, 2.0, 1))
    for day in (day1, day2):
        append_history(enriched_history(day, customers, products), path)
    table = history(spark, path)
    assert {str(r.event_date) for r in table.collect()} == {"2024-01-01", "2024-01-02"}
    assert table.select(*ENRICHED.fieldNames()).count() == 2
