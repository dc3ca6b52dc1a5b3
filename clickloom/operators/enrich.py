"""Enrichment: events with their customer and product, in the history table's shape."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickloom.functions.temporal import temporals_as_text
from clickloom.schemas import ENRICHED, TIME_FORMAT

_MATCH, _SALT = "_match", "_salt"


def one_per_key(dimension: DataFrame, key: str, newest_by: str | None = None,
                unique: bool = False) -> DataFrame:
    """One row per key, so that a lookup never multiplies events.

    Of several rows the one with the largest ``newest_by`` stays; ties, and all rows if no
    column is named, fall to the largest values of the columns in their order, NULLs least.
    So the same row stays whatever the order and partitioning of the input, but every column
    has to be read to find it.

    ``unique`` is the caller's word that the key has one row, as a primary key has or a frozen
    dimension. Then only the columns that are used are read. Either way Catalyst sees that
    the key is unique and drops the whole join from queries that use no column of the
    dimension.
    """
    rest = [c for c in dimension.columns if c != key]
    if not rest:
        return dimension.dropDuplicates([key])
    if unique:
        return dimension.groupBy(key).agg(*[F.first(c).alias(c) for c in rest])
    first = [F.col(newest_by).alias("_newest")] if newest_by else []
    winner = F.max(F.struct(*first, *rest)).alias("_winner")
    return dimension.groupBy(key).agg(winner).select(key, *[f"_winner.{c}" for c in rest])


def lookup(events: DataFrame, dimension: DataFrame, key: str, salts: int = 1,
           newest_by: str | None = None, unique: bool = False, frozen: bool = False) -> DataFrame:
    """Left lookup: every event stays once, unmatched keys leave the attributes NULL.

    On a match the dimension's columns replace event columns of the same name, NULLs
    included. There is no broadcast hint: Catalyst and AQE broadcast the dimension when
    its size is below the session's thresholds and shuffle it otherwise, where AQE
    splits skewed keys. ``salts`` > 1 spreads each key over that many partitions from
    the start, for joins AQE does not re-plan (streams). Events without a key match nothing
    and are dealt out over all partitions.

    A ``frozen`` dimension (see ``sources.dimensions``) is joined as it lies, one row per key
    and dealt out by the key already, so only the events are shuffled.
    """
    # Cast first: a key of the event's type is a join key without further conversion.
    kind = events.schema[key].dataType
    if frozen:
        if dimension.schema[key].dataType != kind:
            raise ValueError(f"freeze the dimension with {key} as {kind.simpleString()}")
        rows = dimension.withColumn(_MATCH, F.lit(True))
    else:
        typed = dimension.withColumn(key, F.col(key).cast(kind))
        rows = one_per_key(typed, key, newest_by, unique).withColumn(_MATCH, F.lit(True))
    shared = [c for c in events.columns if c in dimension.columns and c != key]
    renamed = rows.withColumnsRenamed({c: f"_dim_{c}" for c in (*shared, key)})
    spread = F.xxhash64(*_atomic_columns(events))
    on = F.col(key) == F.col(f"_dim_{key}")
    if (frozen or salts > 1) and _holds_hashes(kind):
        # All events without a key would meet in one task. They get a place of their own, which
        # the second condition keeps from matching.
        on = (F.coalesce(F.col(key), spread.cast(kind)) == F.col(f"_dim_{key}")) & F.col(key).isNotNull()
    if salts > 1:
        events = events.withColumn(_SALT, F.pmod(spread, F.lit(salts)))
        copies = F.explode(F.sequence(F.lit(0), F.lit(salts - 1)).cast("array<bigint>"))
        # The copies are there to be dealt out by a shuffle; a broadcast would hold all of
        # them in every task, ``salts`` times the dimension.
        renamed = renamed.withColumn("_dim_salt", copies).hint("merge")
        on = on & (F.col(_SALT) == F.col("_dim_salt"))
    joined = events.join(renamed, on, "left")

    def resolved(name: str) -> Column | str:
        if name not in shared:
            return name
        return F.when(F.col(_MATCH), F.col(f"_dim_{name}")).otherwise(F.col(name)).alias(name)

    added = [c for c in dimension.columns if c not in events.columns]
    kept = [c for c in events.columns if c != _SALT]
    return joined.select(*[resolved(c) for c in kept], *added)


def _holds_hashes(kind: T.DataType) -> bool:
    return isinstance(kind, (T.LongType, T.DoubleType, T.StringType))


def _atomic_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.AtomicType)]


def conform(df: DataFrame, schema: T.StructType = ENRICHED) -> DataFrame:
    """Exactly the columns of ``schema``: missing ones NULL, others dropped.

    Names match regardless of case; temporal columns become text where text is wanted.
    """
    present = {c.lower(): c for c in df.columns}

    def column(field: T.StructField) -> Column:
        name = present.get(field.name.lower())
        if name is None:
            return F.lit(None).cast(field.dataType).alias(field.name)
        value = F.col(f"`{name}`")
        source = df.schema[name].dataType
        if isinstance(field.dataType, T.StringType) and isinstance(
            source, (T.DateType, T.TimestampType, T.TimestampNTZType)
        ):
            value = F.date_format(value, TIME_FORMAT)
        elif source != field.dataType:
            value = value.cast(field.dataType)
        return value.alias(field.name)

    return df.select(*[column(field) for field in schema.fields])


def enrich(events: DataFrame, customers: DataFrame, products: DataFrame, salts: int = 1,
           customers_newest_by: str | None = None, products_newest_by: str | None = None,
           unique: bool = False, frozen: bool = False) -> DataFrame:
    """Events with customer, then product attributes; batch or stream. ``unique`` and
    ``frozen`` hold for both dimensions (see ``lookup``)."""
    with_customer = lookup(events, customers if frozen else temporals_as_text(customers),
                           "customer_id", salts, customers_newest_by, unique, frozen)
    return lookup(with_customer, products, "product_id", salts, products_newest_by, unique, frozen)


def enriched_history(events: DataFrame, customers: DataFrame, products: DataFrame,
                     salts: int = 1, customers_newest_by: str | None = None,
                     products_newest_by: str | None = None, unique: bool = False,
                     frozen: bool = False) -> DataFrame:
    return conform(enrich(events, customers, products, salts, customers_newest_by,
                          products_newest_by, unique, frozen))
