"""The three change-captured entities: schemas, keys, conversions and rules.

Everything that differs between entities is data in this module, so decoding, processing, folding
and auditing are each written once.  Ids are BIGINT although the source tables use 32-bit
integers, because a 32-bit id stops at about two billion rows.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

# --- Fixed values: names and types that come with the change events. ---------------------------

CHANGE_METADATA = "__deleted STRING, __op STRING, __table STRING, __lsn BIGINT, __source_ts_ms BIGINT"

CUSTOMER_COLUMNS = (
    "customer_id BIGINT, first_name STRING, last_name STRING, email STRING, phone STRING, "
    "address STRING, city STRING, state STRING, zip_code STRING, "
    "registration_date BIGINT, last_update BIGINT"
)
ORDER_COLUMNS = (
    "order_id BIGINT, customer_id BIGINT, order_date BIGINT, status STRING, total_amount BINARY, "
    "payment_method STRING, shipping_address STRING, shipping_city STRING, "
    "shipping_state STRING, shipping_zip STRING, last_update BIGINT"
)
ORDER_ITEM_COLUMNS = (
    "item_id BIGINT, order_id BIGINT, product_name STRING, product_id STRING, quantity INT, "
    "unit_price BINARY, discount BINARY, last_update BIGINT"
)

ORDER_STATUSES = ("pending", "processing", "shipped", "delivered", "cancelled")
CANCELLED = "cancelled"

MAX_LENGTHS = {
    "customers": {
        "first_name": 50, "last_name": 50, "email": 100, "phone": 20, "address": 200,
        "city": 50, "state": 50, "zip_code": 20,
    },
    "orders": {
        "status": 20, "payment_method": 50, "shipping_address": 200, "shipping_city": 50,
        "shipping_state": 50, "shipping_zip": 20,
    },
    "order_items": {"product_name": 100, "product_id": 50},
}

TOPIC_PREFIX = "postgres_server.public"

# -----------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Entity:
    """One change-captured table.

    ``key`` identifies a row in the source table and is what the fold groups by.
    ``epoch_micros`` columns arrive as microseconds since the epoch; ``money`` columns arrive as
    big-endian two's complement bytes and become decimals of the given precision and scale.
    """

    name: str
    key: tuple[str, ...]
    columns: str
    epoch_micros: tuple[str, ...] = ()
    money: Mapping[str, tuple[int, int]] = field(default_factory=dict)
    required: tuple[str, ...] = ()
    max_lengths: Mapping[str, int] = field(default_factory=dict)

    @property
    def wire_schema(self) -> str:
        """DDL of the JSON payload."""
        return f"{self.columns}, {CHANGE_METADATA}"

    @property
    def processed_schema(self) -> str:
        """DDL of the cleaned business columns and change metadata."""
        fields = []
        for field_ddl in self.wire_schema.split(","):
            name, kind = field_ddl.split()
            if name in self.epoch_micros:
                kind = "TIMESTAMP"
            elif name in self.money:
                kind = "DECIMAL({},{})".format(*self.money[name])
            fields.append(f"{name} {kind}")
        return ", ".join(fields)

    @property
    def topic(self) -> str:
        return f"{TOPIC_PREFIX}.{self.name}"

    @property
    def event_identity(self) -> tuple[str, ...]:
        """Columns that tell one change event from another.

        The log sequence number alone is not enough: all rows of one snapshot may share it.
        """
        return (*self.key, "__lsn", "__op", "__source_ts_ms")


CUSTOMERS = Entity(
    name="customers",
    key=("customer_id",),
    columns=CUSTOMER_COLUMNS,
    epoch_micros=("registration_date", "last_update"),
    required=("customer_id", "first_name", "last_name", "email"),
    max_lengths=MAX_LENGTHS["customers"],
)
ORDERS = Entity(
    name="orders",
    key=("order_id",),
    columns=ORDER_COLUMNS,
    epoch_micros=("order_date", "last_update"),
    money={"total_amount": (10, 2)},
    required=("order_id", "total_amount"),
    max_lengths=MAX_LENGTHS["orders"],
)
ORDER_ITEMS = Entity(
    name="order_items",
    key=("item_id",),
    columns=ORDER_ITEM_COLUMNS,
    epoch_micros=("last_update",),
    money={"unit_price": (10, 2), "discount": (5, 2)},
    required=("item_id", "product_name", "quantity", "unit_price"),
    max_lengths=MAX_LENGTHS["order_items"],
)

ENTITIES: dict[str, Entity] = {e.name: e for e in (CUSTOMERS, ORDERS, ORDER_ITEMS)}

# Folding order items by this key instead of their id keeps one row per product of an order, and
# so loses revenue when a product is on two lines of an order.
ORDER_PRODUCT_KEY = ("order_id", "product_id")

# Child column -> parent table and column.
FOREIGN_KEYS = (
    ("orders", "customer_id", "customers", "customer_id"),
    ("order_items", "order_id", "orders", "order_id"),
)
