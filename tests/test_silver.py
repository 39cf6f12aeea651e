"""Each cleaner on a small frame with one row per trap."""

from decimal import Decimal

import pytest

from shopstrata.plans import silver
from shopstrata.sources.schemas import RAW_COLUMNS, raw_schema


@pytest.fixture()
def raw(spark):
    def build(table, *rows):
        full = [{c: r.get(c) for c in RAW_COLUMNS[table]} for r in rows]
        return spark.createDataFrame(
            [tuple(r.values()) for r in full], raw_schema(table)
        )

    return build


def cleaned(df, key):
    return {r[key]: r.asDict() for r in df.collect()}


def test_customers(raw):
    rows = cleaned(
        silver.silver_customers(
            raw(
                "customers",
                {"customer_id": "A", "first_name": " \tAnn ", "email": " ANN@x.org\t",
                 "zip_code": "01352", "segment": "Consumer", "created_at": "2024-02-29"},
                {"customer_id": "B", "email": "ann@X.org", "created_at": "2024-02-30"},
                {"customer_id": "C", "segment": "nan"},
                {"customer_id": "D", "email": "None", "created_at": "soon"},
                {"customer_id": "E", "email": "e@x.org"},
            )
        ),
        "customer_id",
    )
    assert rows["A"]["first_name"] == "Ann" and rows["A"]["zip_code"] == "01352"
    assert rows["A"]["email"] == rows["B"]["email"] == "ann@x.org"
    assert rows["A"]["segment"] == "Consumer"
    assert rows["C"]["segment"] == rows["B"]["segment"] == "Unknown"
    assert str(rows["A"]["created_at"]) == "2024-02-29"
    assert rows["B"]["created_at"] is None and rows["D"]["created_at"] is None
    assert rows["C"]["email"] is None and rows["D"]["email"] is None
    # Missing emails equal each other.
    assert [rows[i]["_is_duplicate_email"] for i in "ABCDE"] == [True, True, True, True, False]


def test_products(raw):
    rows = cleaned(
        silver.silver_products(
            raw(
                "products",
                {"product_id": "A", "product_name": " Mug ", "unit_price": "abc",
                 "stock_qty": "2.0", "is_active": "False"},
                {"product_id": "B", "unit_price": "nan", "cost_price": "12.345"},
                {"product_id": "C", "unit_price": "", "stock_qty": "7", "is_active": "True"},
            )
        ),
        "product_id",
    )
    assert rows["A"]["product_name"] == "Mug"
    assert [rows[i]["unit_price"] for i in "ABC"] == [None, None, None]
    assert rows["B"]["cost_price"] == Decimal("12.35")
    assert [rows[i]["stock_qty"] for i in "ABC"] == [2, 0, 7]
    assert [rows[i]["is_active"] for i in "ABC"] == [False, True, True]


def test_orders(raw):
    found = silver.silver_orders(
        raw(
            "orders",
            {"order_id": "1", "customer_id": "A", "status": " Completed ", "channel": "WEB",
             "order_date": "2024-05-01", "discount_pct": "5", "order_total": "10.00"},
            {"order_id": "1", "customer_id": "A", "status": "completed", "order_total": "10.00"},
            {"order_id": "2", "order_date": "2024-02-30", "order_total": "x"},
        )
    ).collect()
    assert len(found) == 3, "duplicates are kept"
    first = [r for r in found if r["order_date"]][0]
    assert (first["status"], first["channel"], first["discount_pct"]) == ("completed", "web", 5.0)
    two = [r for r in found if r["order_id"] == "2"][0]
    assert two["order_total"] is None and two["order_date"] is None and two["discount_pct"] == 0
    assert two["_missing_customer_id"] and not two["_is_duplicate_order"]
    assert [r["_is_duplicate_order"] for r in found if r["order_id"] == "1"] == [True, True]


def test_order_items(raw):
    df = raw(
        "order_items",
        {"item_id": "a", "order_id": "1", "product_id": "P", "quantity": "2", "line_total": "3.5"},
        {"item_id": "b", "product_id": "P"},
        {"item_id": "c", "order_id": "1"},
        {"item_id": "d", "order_id": "nan", "product_id": "P"},
        {"item_id": "e", "order_id": "GHOST", "product_id": "P", "quantity": "many"},
    )
    kept = cleaned(silver.silver_order_items(df), "item_id")
    assert set(kept) == {"a", "e"}
    assert kept["a"]["quantity"] == 2 and kept["a"]["line_total"] == Decimal("3.50")
    assert kept["e"]["quantity"] is None
    assert set(cleaned(silver.silver_order_items_rejects(df), "item_id")) == {"b", "c", "d"}


def test_returns(raw):
    rows = cleaned(
        silver.silver_returns(
            raw(
                "returns",
                {"return_id": "a", "refund_amount": "9.99", "status": " Approved"},
                {"return_id": "b", "refund_amount": "", "reason": " Changed mind\n"},
            )
        ),
        "return_id",
    )
    assert rows["a"]["refund_amount"] == Decimal("9.99") and rows["a"]["status"] == "approved"
    assert rows["b"]["refund_amount"] == Decimal("0.00")
    assert rows["b"]["reason"] == "Changed mind" and rows["b"]["status"] is None


def test_shipping_events(raw):
    day = "2024-01-0{}".format
    rows = cleaned(
        silver.silver_shipping_events(
            raw(
                "shipping_events",
                {"shipment_id": "late", "ship_date": day(5), "actual_delivery": day(1)},
                {"shipment_id": "same", "ship_date": day(5), "actual_delivery": day(5)},
                {"shipment_id": "open", "ship_date": day(5)},
                {"shipment_id": "unknown", "actual_delivery": day(5)},
            )
        ),
        "shipment_id",
    )
    assert {k: r["_invalid_ship_date"] for k, r in rows.items()} == {
        "late": True,
        "same": False,
        "open": False,
        "unknown": False,
    }


def test_metadata_passes_through(spark, raw):
    df = raw("products", {"product_id": "A"}).selectExpr("*", "7 AS _row_count")
    assert silver.silver_products(df).first()["_row_count"] == 7
