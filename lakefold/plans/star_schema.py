"""The three entities, their change logs and their wire events, derived from star-schema tables.

The tables are ``customer``, ``orders``, ``lineitem`` and ``part``.  They stand in for a captured
database when no change topic is at hand: every query and test input is a projection of whole
tables, so it grows with them.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakefold.entities import Entity
from lakefold.functions.columns import line_total

# --- Fixed values of the mapping; the SQL oracle repeats them. ---------------------------------

FIRST_EVENT_MS = 1_704_067_200_000
FIRST_REGISTRATION = "1995-01-01"
REGISTRATION_MONTHS = 24
CANCELLED_EVERY = 10
UPDATED_EVERY = 3
TIED_EVERY = 9
DELETED_EVERY = 11
RETURNED_FLAG = "R"
ITEM_UPDATED_EVERY = 5
ITEM_TIED_EVERY = 15
# Lines of an order are numbered in this order, as order and line number are no identity.
LINE_ORDER = (
    "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_quantity", "l_extendedprice",
    "l_discount", "l_tax", "l_returnflag", "l_linestatus",
)
DAMAGE_KINDS = 13

SCHEMAS = {
    "customer":
        "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "orders":
        "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
        "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "lineitem":
        "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, "
        "l_quantity DOUBLE, l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, "
        "l_returnflag STRING, l_linestatus STRING, l_shipdate TIMESTAMP_NTZ",
    "part":
        "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, "
        "p_retailprice DOUBLE",
}

# -----------------------------------------------------------------------------------------------


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table by its known schema, so that no file is opened to plan a query."""
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    months = (F.col("c_custkey") % REGISTRATION_MONTHS).cast("int")
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_name").alias("first_name"),
        F.col("c_mktsegment").alias("last_name"),
        F.concat("c_name", F.lit("@example.org")).alias("email"),
        F.add_months(F.lit(FIRST_REGISTRATION).cast("date"), months).alias("registration_date"),
    )


def _order_status() -> Column:
    return (
        F.when(F.col("o_orderkey") % CANCELLED_EVERY == 0, "cancelled")
        .when(F.col("o_orderstatus") == "F", "delivered")
        .when(F.col("o_orderstatus") == "O", "shipped")
        .otherwise("processing")
    )


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").alias("order_date"),
        _order_status().alias("status"),
        F.col("o_totalprice").cast("decimal(12,2)").alias("total_amount"),
    )


def priced_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines with name and list price; the price is converted per part, not per line."""
    price = F.col("p_retailprice").cast("decimal(10,2)").alias("unit_price")
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_name", price)
    lines = table(spark, sf_dir, "lineitem")
    return lines.join(parts, lines.l_partkey == parts.p_partkey)


def _item_columns() -> dict[str, Column]:
    """``item_id`` joins the order and the place of the line in it.  The window is only planned where the id is used."""
    place = F.row_number().over(Window.partitionBy("l_orderkey").orderBy(*LINE_ORDER))
    return {
        "item_id": F.col("l_orderkey") * 1000 + place,
        "order_id": F.col("l_orderkey"),
        "product_id": F.col("l_partkey").cast("string"),
        "product_name": F.col("p_name"),
        "quantity": F.col("l_quantity").cast("int"),
        "unit_price": F.col("unit_price"),
        "discount": F.col("l_discount").cast("decimal(5,2)"),
    }


def order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines with the name and list price of their part."""
    columns = _item_columns()
    return priced_lines(spark, sf_dir).select(*(c.alias(n) for n, c in columns.items()))


def _with_operations(df: DataFrame, *operations: Column) -> DataFrame:
    """One row per operation that is not null; the other columns stay outside the generated array,
    so that unused ones are pruned."""
    changes = df.withColumn("__op", F.explode(F.array(*operations)))
    return changes.filter(F.col("__op").isNotNull())


def _change_metadata(ts_ms: Column, lsn: Column) -> dict[str, Column]:
    deletes = F.col("__op") == "d"
    return {
        "__source_ts_ms": ts_ms.cast("bigint"),
        "__lsn": lsn.cast("bigint"),
        "__deleted": F.when(deletes, "true").otherwise("false"),
        "is_deleted": deletes,
    }


def _by_operation(**values: Column | int) -> Column:
    """The value given for the row's operation."""
    chosen = F.lit(None)
    for op, value in values.items():
        chosen = F.when(F.col("__op") == op, value).otherwise(chosen)
    return chosen


def customer_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A snapshot read of every customer."""
    metadata = _change_metadata(F.lit(FIRST_EVENT_MS), F.col("customer_id"))
    return customers(spark, sf_dir).withColumn("__op", F.lit("r")).withColumns(metadata)


def order_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Create every order; update some, at times within the same millisecond; delete some."""
    key, total = F.col("order_id"), F.col("total_amount")
    changes = _with_operations(
        orders(spark, sf_dir),
        F.lit("c"),
        F.when(key % UPDATED_EVERY == 0, "u"),
        F.when(key % DELETED_EVERY == 0, "d"),
    )
    updated_after = F.when(key % TIED_EVERY == 0, 0).otherwise(5)
    ts_ms = F.lit(FIRST_EVENT_MS) + key * 1000 + _by_operation(c=0, u=updated_after, d=9)
    lsn = key * 4 + _by_operation(c=0, u=1, d=2)
    raised = F.when(F.col("__op") == "u", total + F.lit(Decimal(1))).otherwise(total)
    return changes.withColumns(_change_metadata(ts_ms, lsn)).withColumn(
        "total_amount", raised.cast("decimal(12,2)")
    )


def order_item_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Create every line; update some, at times within the same millisecond; delete the returned ones."""
    lines = priced_lines(spark, sf_dir).select(
        *(c.alias(n) for n, c in _item_columns().items()), "l_returnflag"
    )
    key = F.col("item_id")
    changes = _with_operations(
        lines,
        F.lit("c"),
        F.when(key % ITEM_UPDATED_EVERY == 0, "u"),
        F.when(F.col("l_returnflag") == RETURNED_FLAG, "d"),
    ).drop("l_returnflag")
    updated_after = F.when(key % ITEM_TIED_EVERY == 0, 0).otherwise(5)
    ts_ms = F.lit(FIRST_EVENT_MS) + F.col("order_id") * 1000 + _by_operation(c=0, u=updated_after, d=9)
    lsn = key * 4 + _by_operation(c=0, u=1, d=2)
    more = F.when(F.col("__op") == "u", F.col("quantity") + 1).otherwise(F.col("quantity"))
    return changes.withColumns(_change_metadata(ts_ms, lsn)).withColumn("quantity", more.cast("int"))


def _numeric_bytes(amount: Column) -> Column:
    """Base64 of the shortest two's complement bytes that hold a non-negative amount."""
    digits = F.hex((amount * 100).cast("bigint"))
    padded = F.when(F.length(digits) % 2 == 1, F.concat(F.lit("0"), digits)).otherwise(digits)
    signed = F.when(F.substring(padded, 1, 1) >= "8", F.concat(F.lit("00"), padded)).otherwise(padded)
    return F.base64(F.unhex(signed))


def wire_events(log: DataFrame, entity: Entity) -> DataFrame:
    """A change log as broker messages: ``value`` and the broker's ``timestamp``.

    Keeps the wire columns that the log has, with instants in microseconds and money in bytes.
    """
    columns = []
    for name in [part.split()[0] for part in entity.wire_schema.split(",")]:
        if name not in log.columns:
            continue
        value = F.col(name)
        if name in entity.money:
            value = _numeric_bytes(value)
        elif name in entity.epoch_micros:
            value = F.unix_micros(value.cast("timestamp"))
        columns.append(value.alias(name))
    payload = F.struct(*columns, F.lit(entity.name).alias("__table")).alias("payload")
    return log.select(
        F.to_json(F.struct(payload)).cast("binary").alias("value"),
        F.timestamp_millis("__source_ts_ms").alias("timestamp"),
    )


def damaged_order_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A create event for every order, all but every thirteenth damaged, in twelve ways.

    All have one broker time, and many of them equal texts; only their place in the source tells them apart.
    """
    order = F.col("o_orderkey")
    kind = order % DAMAGE_KINDS
    tail = F.lit('"__lsn":1,"__source_ts_ms":1704067200000}}')
    start = F.concat(F.lit('{"payload":{"order_id":'), order.cast("string"), F.lit(","))
    op = F.lit('"__op":"c",')

    def holding(field: str) -> Column:
        return F.concat(start, F.lit(field + ","), op, tail)

    text = (
        F.when(kind == 1, F.lit(None).cast("string"))
        .when(kind == 2, F.lit("not json"))
        .when(kind == 3, F.lit('{"payload":null}'))
        .when(kind == 4, F.concat(F.lit('{"payload":{'), op, tail))
        .when(kind == 5, F.concat(start, tail))
        .when(kind == 6, holding('"total_amount":"AAAAAAAAAAAB"'))
        .when(kind == 7, holding('"total_amount":"!!!"'))
        .when(kind == 8, holding('"total_amount":1234'))
        .when(kind == 9, holding('"total_amount":""'))
        .when(kind == 10, holding('"customer_id":"abc"'))
        .when(kind == 11, holding('"customer_id":99999999999999999999'))
        .when(kind == 12, F.concat(start, F.lit('"__op":"x",'), tail))
        .otherwise(F.concat(start, op, tail))
    )
    return table(spark, sf_dir, "orders").select(
        text.cast("binary").alias("value"),
        F.timestamp_millis(F.lit(FIRST_EVENT_MS)).alias("timestamp"),
        F.lit("damaged").alias("origin"),
        order.alias("origin_offset"),
    )


# --- Tables with faults, for the audits --------------------------------------------------------


def _every(key: str, n: int, faulty: Column, sound: Column) -> Column:
    return F.when(F.col(key) % n == 0, faulty).otherwise(sound)


def _long(key: str, n: int, length: int) -> Column:
    """A text of ``length`` + 1 characters in every ``n``-th row and one of the right length in the others."""
    return _every(key, n, F.repeat(F.lit("x"), length + 1), F.repeat(F.lit("x"), length))


def faulty_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, none = "c_custkey", F.lit(None).cast("string")
    mail = F.concat("c_name", F.lit("@example.org"))
    shared = F.concat(F.lit("shared"), (F.col(key) % 26).cast("string"), F.lit("@example.org"))
    return table(spark, sf_dir, "customer").select(
        _every(key, 47, F.lit(None).cast("bigint"), F.col(key)).alias("customer_id"),
        _every(key, 31, none, _long(key, 37, 50)).alias("first_name"),
        _every(key, 41, none, _long(key, 29, 50)).alias("last_name"),
        _every(key, 11, none, _every(key, 43, F.repeat(F.lit("x"), 101), _every(key, 13, shared, mail))).alias("email"),
        _long(key, 17, 20).alias("phone"),
        _long(key, 19, 200).alias("address"),
        _long(key, 23, 50).alias("city"),
        _long(key, 27, 50).alias("state"),
        _long(key, 33, 20).alias("zip_code"),
    )


def faulty_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = "o_orderkey"
    amount = F.col("o_totalprice").cast("decimal(12,2)")
    status = _every(key, 7, F.lit("unknown"), _every(key, 59, F.repeat(F.lit("x"), 21), _order_status()))
    return table(spark, sf_dir, "orders").select(
        _every(key, 101, F.lit(None).cast("bigint"), F.col(key)).alias("order_id"),
        _every(key, 89, F.col("o_custkey") + 1_000_000_000_000, F.col("o_custkey")).alias("customer_id"),
        status.alias("status"),
        _every(key, 53, F.lit(None).cast("decimal(12,2)"), amount).alias("total_amount"),
        _long(key, 61, 50).alias("payment_method"),
        _long(key, 67, 200).alias("shipping_address"),
        _long(key, 71, 50).alias("shipping_city"),
        _long(key, 73, 50).alias("shipping_state"),
        _long(key, 79, 20).alias("shipping_zip"),
    )


def faulty_order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    items, key = order_items(spark, sf_dir), "item_id"
    quantity = _every(key, 113, F.lit(None).cast("int"), _every(key, 127, F.lit(0), F.col("quantity")))
    return items.withColumns({
        "product_name": _every(
            key, 107, F.lit(None).cast("string"), _every(key, 109, F.repeat(F.lit("x"), 101), F.col("product_name"))),
        "product_id": _every(key, 137, F.repeat(F.lit("x"), 51), F.col("product_id")),
        "quantity": quantity.cast("int"),
        "unit_price": _every(key, 131, F.lit(None).cast("decimal(10,2)"), F.col("unit_price")),
        "item_id": _every(key, 103, F.lit(None).cast("bigint"), F.col(key)),
    })


def reconciled_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with the sum of their lines as total, but one more in every sixth."""
    sums = order_items(spark, sf_dir).groupBy("order_id").agg(F.sum(line_total()).alias("lines_total"))
    total = F.bround(F.coalesce("lines_total", F.lit(0).cast("decimal(38,4)")), 2)
    total = _every("order_id", 6, total + F.lit(Decimal(1)), total)
    plain = orders(spark, sf_dir).drop("total_amount")
    return plain.join(sums, "order_id", "left").withColumn("total_amount", total.cast("decimal(18,2)")).drop("lines_total")
