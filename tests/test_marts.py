"""The marts against plain Python over small random tables with repeats, orphans and NULLs."""

import random
from collections import defaultdict
from datetime import date
from decimal import ROUND_HALF_UP, Decimal

import pytest

from shopstrata.plans import marts

SCHEMAS = {
    "customers": "customer_id string, first_name string, last_name string, segment string, "
    "state string",
    "products": "product_id string, product_name string, category string, "
    "unit_price decimal(18,2), cost_price decimal(18,2)",
    "orders": "order_id string, customer_id string, order_date date, status string, "
    "channel string, order_total decimal(18,2)",
    "order_items": "item_id string, order_id string, product_id string, quantity int, "
    "unit_price decimal(18,2), line_total decimal(18,2)",
    "returns": "return_id string, order_id string, status string, refund_amount decimal(18,2)",
    "shipping_events": "shipment_id string, carrier string, ship_date date, "
    "estimated_delivery date, actual_delivery date, status string, _invalid_ship_date boolean",
}


def _random_rows(seed):
    r = random.Random(seed)

    def maybe(value, odds=0.1):
        return None if r.random() < odds else value

    def money(top):
        return Decimal(r.randint(-500, top)) / 100

    order = lambda: maybe(f"O{r.randint(0, 25)}")
    product = lambda: maybe(f"P{r.randint(0, 9)}")
    return {
        "customers": [(f"C{i % 13}", f"f{i}", "l", "s", "VA") for i in range(15)],
        # P0 is listed three times, twice alike.
        "products": [
            (f"P{max(0, i - 2)}", "n" if i < 2 else f"n{i}", maybe(f"cat{i % 3}"), money(900),
             maybe(money(500)))
            for i in range(11)
        ]
        + [("P0", "n", "cat0", Decimal("1.00"), Decimal("0.50"))] * 2,
        "orders": [
            (order(), maybe(f"C{r.randint(0, 14)}"), maybe(date(2024, r.randint(1, 4), 3)),
             r.choice(["completed", "shipped", "cancelled", None]),
             r.choice(["web", "mobile", "in-store", "referral"]), maybe(money(9000)))
            for _ in range(45)
        ],
        "order_items": [
            (maybe(f"I{i}"), order(), product(), maybe(r.randint(0, 5)), maybe(money(900)),
             maybe(money(4000)))
            for i in range(120)
        ],
        "returns": [
            (maybe(f"R{i}"), order(), r.choice(["approved", "pending", None]), maybe(money(2000)))
            for i in range(25)
        ],
        "shipping_events": [
            (maybe(f"S{i}"), maybe(f"carrier{i % 3}"), maybe(date(2024, 1, r.randint(1, 9))),
             maybe(date(2024, 1, r.randint(5, 15))), maybe(date(2024, 1, r.randint(9, 20))),
             r.choice(["delivered", "delayed", "lost"]), r.random() < 0.1)
            for i in range(40)
        ],
    }


@pytest.fixture(scope="module", params=[1, 2, 3])
def data(request, spark):
    rows = _random_rows(request.param)
    frames = {t: spark.createDataFrame(rows[t], SCHEMAS[t]) for t in SCHEMAS}
    columns = {t: [c.split()[0] for c in SCHEMAS[t].replace("(18,2)", "").split(", ")] for t in SCHEMAS}
    return frames, {t: [dict(zip(columns[t], r)) for r in rows[t]] for t in SCHEMAS}


def total(values):
    """SQL SUM."""
    kept = [v for v in values if v is not None]
    return sum(kept) if kept else None


def rate(part, whole, digits=1):
    if part is None or not whole:
        return None
    step = Decimal(1).scaleb(-digits)
    return (Decimal(part) / Decimal(whole)).quantize(step, ROUND_HALF_UP)


def as_rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def compare(found, expected):
    assert as_rows(found) == sorted(expected, key=repr)


def test_revenue(data):
    frames, t = data
    groups = defaultdict(list)
    for i in t["order_items"]:
        for o in t["orders"]:
            for p in t["products"]:
                if (
                    i["order_id"] is not None
                    and i["order_id"] == o["order_id"]
                    and i["product_id"] is not None
                    and i["product_id"] == p["product_id"]
                    and o["status"] in ("completed", "shipped")
                ):
                    groups[p["category"]].append((i, p))
    expected = []
    for category, pairs in groups.items():
        profit = total(
            None
            if None in (i["line_total"], i["quantity"], p["cost_price"])
            else i["line_total"] - p["cost_price"] * i["quantity"]
            for i, p in pairs
        )
        revenue = total(i["line_total"] for i, _ in pairs)
        prices = [i["unit_price"] for i, _ in pairs if i["unit_price"] is not None]
        expected.append(
            (
                category,
                len({p["product_id"] for _, p in pairs}),
                total(i["quantity"] for i, _ in pairs),
                revenue,
                rate(total(prices), len(prices), 2),
                profit,
                rate(None if profit is None else profit * 100, revenue),
            )
        )
    compare(marts.revenue_by_category(frames), expected)


def test_monthly(data):
    frames, t = data
    groups = defaultdict(list)
    for o in t["orders"]:
        if o["order_date"] and o["order_total"] is not None:
            groups[o["order_date"].strftime("%Y-%m")].append(o)
    count = lambda rows, k, v: sum(r[k] == v for r in rows)
    expected = []
    for month, rows in groups.items():
        orders = sum(r["order_id"] is not None for r in rows)
        spent = total(r["order_total"] for r in rows)
        expected.append(
            (
                month,
                orders,
                len({r["customer_id"] for r in rows} - {None}),
                spent,
                rate(spent, len(rows), 2),
                count(rows, "status", "completed"),
                count(rows, "status", "cancelled"),
                rate(100 * count(rows, "status", "cancelled"), orders),
                count(rows, "channel", "web"),
                count(rows, "channel", "mobile"),
                count(rows, "channel", "in-store"),
            )
        )
    compare(marts.monthly_order_summary(frames), expected)


def test_returns(data):
    frames, t = data
    approved = {r["order_id"] for r in t["returns"] if r["status"] == "approved"} - {None}
    pairs = [
        (i, p)
        for i in t["order_items"]
        for p in t["products"]
        if i["product_id"] is not None and i["product_id"] == p["product_id"]
    ]
    sales, back = defaultdict(list), defaultdict(list)
    for i, p in pairs:
        key = (p["product_id"], p["product_name"], p["category"], p["unit_price"])
        sales[key].append(i)
        if i["order_id"] in approved:
            back[p["product_id"]] += [
                (i, r) for r in t["returns"] if r["order_id"] == i["order_id"]
            ]
    expected = []
    for key, items in sales.items():
        sold = sum(i["item_id"] is not None for i in items)
        returned = sum(i["item_id"] is not None for i, _ in back[key[0]])
        expected.append(
            (
                *key,
                sold,
                total(i["quantity"] for i in items),
                total(i["line_total"] for i in items),
                returned,
                total(r["refund_amount"] for _, r in back[key[0]]) or Decimal("0.00"),
                rate(100 * returned, sold),
            )
        )
    compare(marts.return_rate_by_product(frames), expected)


@pytest.mark.parametrize("high, mid", [(marts.HIGH_VALUE, marts.MID_VALUE), (100, 50)])
def test_lifetime_value(data, high, mid):
    frames, t = data
    expected = []
    for c in t["customers"]:
        own = [o for o in t["orders"] if o["customer_id"] == c["customer_id"]]
        paid = [o for o in own if o["order_total"] is not None]
        back = [
            r
            for o in own
            for r in t["returns"]
            if r["order_id"] is not None and r["order_id"] == o["order_id"]
        ]
        spent = total(o["order_total"] for o in paid) or Decimal("0.00")
        dates = [o["order_date"] for o in paid if o["order_date"]]
        expected.append(
            (
                c["customer_id"], c["first_name"], c["last_name"], c["segment"], c["state"],
                sum(o["order_id"] is not None for o in paid),
                spent,
                rate(spent, len(paid), 2) or Decimal("0.00"),
                min(dates, default=None),
                max(dates, default=None),
                sum(r["return_id"] is not None for r in back),
                total(r["refund_amount"] for r in back) or Decimal("0.00"),
                "High Value" if spent >= high else "Mid Value" if spent >= mid else "Low Value",
            )
        )
    compare(marts.customer_lifetime_value(frames, high, mid), expected)


def test_fulfillment(data):
    frames, t = data
    groups = defaultdict(list)
    for s in t["shipping_events"]:
        if not s["_invalid_ship_date"]:
            groups[s["carrier"]].append(s)
    expected = []
    for carrier, rows in groups.items():
        n = sum(r["shipment_id"] is not None for r in rows)
        days = [
            (r["actual_delivery"] - r["ship_date"]).days
            for r in rows
            if r["actual_delivery"] and r["ship_date"]
        ]
        on_time = [
            r["actual_delivery"] <= r["estimated_delivery"]
            for r in rows
            if r["actual_delivery"] and r["estimated_delivery"]
        ]
        count = lambda s, rows=rows: sum(r["status"] == s for r in rows)
        expected.append(
            (
                carrier, n, count("delivered"), count("delayed"), count("lost"),
                rate(sum(days), len(days)),
                rate(100 * sum(on_time), len(on_time)),
                rate(100 * count("delayed"), n),
            )
        )
    compare(marts.fulfillment_summary(frames), expected)


def test_dedupe_orders(spark):
    """Repeats weigh twice by default and once on request; rows without an id all stay."""
    day = date(2024, 1, 1)
    orders = [("O1", "C", day, "completed", "web", Decimal(10))] * 2 + [
        (None, "C", day, "completed", "web", Decimal(1))
    ] * 2
    frames = {"orders": spark.createDataFrame(orders, SCHEMAS["orders"])}
    as_is = marts.monthly_order_summary(frames).first()
    once = marts.monthly_order_summary(frames, dedupe_orders=True).first()
    assert (as_is["total_revenue"], once["total_revenue"]) == (Decimal(22), Decimal(12))


def test_report_order(spark):
    """NULLs sort as the reports show them, and equal values are split by the key."""
    rows = [("a", Decimal(1)), ("b", None), ("d", Decimal(5)), ("c", Decimal(5))]
    df = spark.createDataFrame(rows, "category string, total_revenue decimal(18,2)")
    shown = marts.in_report_order("gold_revenue_by_category", df)
    assert [r["category"] for r in shown.collect()] == ["b", "c", "d", "a"]
