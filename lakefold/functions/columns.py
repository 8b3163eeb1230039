"""Column expressions shared by the stream and the batch side.  All run inside the JVM."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

MAX_NUMERIC_BYTES = 8


def decode_numeric(raw: Column, precision: int = 10, scale: int = 2) -> Column:
    """Big-endian two's complement bytes to ``decimal(precision, scale)``.

    Null for null, for no bytes, for more than eight and for values that do not fit the decimal.  The hex
    text is sign-extended to 64 bits and read as a signed base-16 number.
    """
    digits = F.hex(raw)
    sign_digit = F.when(F.substring(digits, 1, 1) >= "8", F.lit("F")).otherwise(F.lit("0"))
    unscaled = F.conv(F.lpad(digits, 2 * MAX_NUMERIC_BYTES, sign_digit), 16, -10)
    value = unscaled.cast("decimal(19,0)") * F.lit(Decimal(1).scaleb(-scale))
    return F.when(
        F.octet_length(raw).between(1, MAX_NUMERIC_BYTES), value.try_cast(f"decimal({precision},{scale})")
    )


def is_deleted_flag(deleted: Column | None = None) -> Column:
    """True for the text "true", false for everything else, null included."""
    deleted = F.col("__deleted") if deleted is None else deleted
    return F.coalesce(deleted == "true", F.lit(False))


def change_timestamp(source_ts_ms: Column | None = None) -> Column:
    """Commit time of the change in the source database."""
    return F.timestamp_millis(F.col("__source_ts_ms") if source_ts_ms is None else source_ts_ms)


def change_columns() -> dict[str, Column]:
    """The derived columns every change row carries, for ``DataFrame.withColumns``."""
    return {
        "processing_time": F.current_timestamp(),
        "is_deleted": is_deleted_flag(),
        "cdc_timestamp": change_timestamp(),
    }


def line_total() -> Column:
    """Exact value of an order line after discount.

    The operand types are fixed, so the product is a ``decimal(28,4)`` that cannot overflow.
    """
    quantity = F.col("quantity").cast("decimal(10,0)")
    unit_price = F.col("unit_price").cast("decimal(10,2)")
    kept_share = F.lit(Decimal(1)) - F.col("discount").cast("decimal(5,2)")
    return (quantity * unit_price * kept_share).cast("decimal(28,4)")


def year_month(date: Column) -> Column:
    return F.date_format(date, "yyyy-MM")


def as_double(exact: Column) -> Column:
    """Result tables hold doubles; they are converted once, after exact summation."""
    return exact.cast("double")
