"""Declared schemas: raw pages, flattened tables, optional CSV inputs (fixed values of the data model)."""

from __future__ import annotations

from pyspark.sql import types as T

_S, _L, _B, _D = T.StringType(), T.LongType(), T.BooleanType(), T.DoubleType()


def struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(k, v) for k, v in fields.items()])


def strings(*names: str) -> T.StructType:
    return struct(**{n: _S for n in names})


MONEY = struct(amount=_L, currency=_S)
METADATA = struct(source=_S, entity=_S, page_number=_L, extracted_at=_S, run_id=_S, environment=_S)

RECORDS = {
    "locations": strings("id", "name", "status", "timezone", "currency", "country", "business_name", "merchant_id", "created_at"),
    "objects": struct(
        type=_S, id=_S, updated_at=_S, is_deleted=_B,
        item_data=struct(name=_S, categories=T.ArrayType(struct(id=_S)), reporting_category=struct(id=_S), category_id=_S),
        item_variation_data=struct(item_id=_S, name=_S, sku=_S, price_money=MONEY),
        category_data=struct(name=_S),
    ),
    "orders": struct(
        id=_S, location_id=_S, state=_S, created_at=_S, updated_at=_S, closed_at=_S,
        line_items=T.ArrayType(struct(uid=_S, catalog_object_id=_S, name=_S, variation_name=_S, quantity=_S, gross_sales_money=MONEY, total_discount_money=MONEY, total_tax_money=MONEY, total_money=MONEY)),
    ),
    "payments": struct(
        id=_S, order_id=_S, location_id=_S, amount_money=MONEY, status=_S, source_type=_S, processing_fee=T.ArrayType(struct(amount_money=MONEY)),
        card_details=struct(card=struct(card_brand=_S, last_4=_S)), created_at=_S, updated_at=_S,
    ),
    "counts": strings("catalog_object_id", "catalog_object_type", "location_id", "state", "quantity", "calculated_at"),
}
#: Entity -> key of its record list in the payload.
LIST_KEYS = {"locations": "locations", "catalog": "objects", "orders": "orders", "payments": "payments", "inventory": "counts"}


def envelope(list_key: str) -> T.StructType:
    return struct(metadata=METADATA, payload=struct(**{list_key: T.ArrayType(RECORDS[list_key])}))


SILVER = {
    "locations": strings("location_id", "name", "status", "timezone", "currency", "country", "business_name", "merchant_id", "created_at"),
    "catalog_items": struct(variation_id=_S, item_id=_S, item_name=_S, variation_name=_S, category_id=_S, category_name=_S, price_cents=_L, currency=_S, sku=_S, is_deleted=_B, updated_at=_S),
    "order_lines": struct(
        order_id=_S, line_item_uid=_S, location_id=_S, catalog_object_id=_S, item_name=_S, variation_name=_S, quantity=_S, gross_sales_cents=_L, discount_cents=_L,
        tax_cents=_L, net_sales_cents=_L, currency=_S, order_state=_S, order_created_at=_S, order_updated_at=_S, closed_at=_S,
    ),
    "payments": struct(payment_id=_S, order_id=_S, location_id=_S, amount_cents=_L, currency=_S, status=_S, source_type=_S, card_brand=_S, card_last_4=_S, processing_fee_cents=_L, created_at=_S, updated_at=_S),
    "inventory_snapshots": struct(catalog_object_id=_S, catalog_object_type=_S, location_id=_S, state=_S, quantity=_D, calculated_at=_S),
}

CSV = {
    "vendor_costs": strings("variation_id", "item_name", "category_name", "vendor_name", "unit_cost_cents"),
    "category_overrides": strings("raw_category", "canonical_category"),
}
