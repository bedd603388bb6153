"""Data-quality flags (0/1 integers, never NULL).

The order-status flags test text *presence* of a date (unparsable text counts
as present); the sequence/late flags compare *parsed* dates, and a comparison
with a NULL date falls through to 0.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from emporia.functions.text import clean_text, parse_dmy, to_dec
from emporia.schemas import (
    FREE_SHIPPING_TEXTS, PAYMENT_NOT_DEFINED, STATUS_CANCELED, STATUS_DELIVERED, STATUS_SHIPPED,
    STATUS_UNAVAILABLE,
)


def flag(cond: Column) -> Column:
    """Three-valued condition -> 1 when TRUE, else 0 (FALSE and NULL)."""
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))


def order_status(status: str | Column) -> Column:
    return F.upper(F.trim(F.col(status) if isinstance(status, str) else status))


def delivery_inconsistent(status: Column, customer_date_text: str) -> Column:
    return flag((status == STATUS_DELIVERED) & clean_text(customer_date_text).isNull())


def shipped_missing(status: Column, carrier_date_text: str) -> Column:
    return flag(status.isin(STATUS_SHIPPED, STATUS_DELIVERED) & clean_text(carrier_date_text).isNull())


def canceled_in_transit(status: Column, carrier_date_text: str, customer_date_text: str) -> Column:
    return flag(
        status.isin(STATUS_CANCELED, STATUS_UNAVAILABLE)
        & clean_text(carrier_date_text).isNotNull()
        & clean_text(customer_date_text).isNull()
    )


def canceled_but_reached(status: Column, carrier_date_text: str, customer_date_text: str) -> Column:
    return flag(
        status.isin(STATUS_CANCELED, STATUS_UNAVAILABLE)
        & clean_text(carrier_date_text).isNotNull()
        & clean_text(customer_date_text).isNotNull()
    )


def invalid_date_sequence(purchase: Column, approved: Column, carrier: Column, delivered: Column) -> Column:
    return flag((approved < purchase) | (carrier < approved) | (delivered < carrier))


def late_delivery(delivered: Column, estimated: Column) -> Column:
    return flag(delivered > estimated)


def free_shipping(freight_text: str) -> Column:
    """Textual test: only '0' and '0.0' count; '0.00' does not."""
    return flag(F.trim(F.col(freight_text)).isin(*FREE_SHIPPING_TEXTS))


def missing_category(category_text: str) -> Column:
    return flag(clean_text(category_text).isNull())


def missing_dimensions(weight_text: str) -> Column:
    """Tests the weight only (the dimensions themselves are not looked at)."""
    return flag(clean_text(weight_text).isNull())


def payment_not_defined(type_text: str) -> Column:
    return flag(F.lower(F.trim(F.col(type_text))) == PAYMENT_NOT_DEFINED)


def payment_zero_value(value_text: str) -> Column:
    """Parsed value equal to 0; a missing value is *not* flagged."""
    return flag(to_dec(value_text) == 0)


# Parsed order dates, shared by the sequence / late flags and silver projection.
def order_dates(prefix: str = "") -> dict[str, Column]:
    return {
        "order_purchase_timestamp": parse_dmy(prefix + "order_purchase_timestamp"),
        "order_approved_at": parse_dmy(prefix + "order_approved_at"),
        "order_delivered_carrier_date": parse_dmy(prefix + "order_delivered_carrier_date"),
        "order_delivered_customer_date": parse_dmy(prefix + "order_delivered_customer_date"),
        "order_estimated_delivery_date": parse_dmy(prefix + "order_estimated_delivery_date"),
    }
