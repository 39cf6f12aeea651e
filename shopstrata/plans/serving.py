"""Reads behind the dashboard, all over the (small to medium) marts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopstrata.functions.rounding import ratio_half_even


# Ties go to the even neighbour, as the page shows them.
_RETURN_PCT = ratio_half_even("times_returned * 100", "times_sold", 1)


def kpi_summary(monthly: DataFrame, by_product: DataFrame, by_customer: DataFrame) -> DataFrame:
    """Headline figures in one row; the return rate is zero when nothing was sold.

    ``avg_aov_monthly_mean`` is the plain mean of the monthly averages, months weighing alike.
    The other two marts come in as scalar subqueries, so nothing is joined.
    """
    returned = by_product.selectExpr(
        "sum(times_returned) AS times_returned", "sum(times_sold) AS times_sold"
    ).selectExpr(f"CASE WHEN times_sold > 0 THEN {_RETURN_PCT} ELSE 0 END AS pct")
    customers = by_customer.selectExpr("count(DISTINCT customer_id) AS n")
    months = monthly.selectExpr(
        "sum(total_revenue) AS total_revenue",
        "sum(total_orders) AS total_orders",
        "CAST(sum(avg_order_value) AS DOUBLE) / count(avg_order_value) AS avg_aov_monthly_mean",
    )
    return months.withColumns(
        {"overall_return_pct": returned.scalar(), "unique_customers": customers.scalar()}
    )


def revenue_chart(revenue: DataFrame) -> DataFrame:
    """Revenue and margin by category, smallest first."""
    return revenue.select("category", "total_revenue", "gross_margin_pct").orderBy(
        "total_revenue", "category"
    )


def monthly_trend(monthly: DataFrame) -> DataFrame:
    """Revenue and average order value by month."""
    return monthly.select("month_label", "total_revenue", "avg_order_value").orderBy("month_label")


def top_customers(by_customer: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` customers who spent most; the name is NULL when either part is."""
    return (
        by_customer.orderBy(F.col("total_spent").desc_nulls_last(), "customer_id")
        .limit(n)
        .select(
            F.concat("first_name", F.lit(" "), "last_name").alias("customer"),
            "segment",
            "total_orders",
            "total_spent",
            "value_tier",
        )
    )


def return_rate_by_category(by_product: DataFrame) -> DataFrame:
    """Return rate by category as a ratio of sums, highest first."""
    return (
        by_product.groupBy("category")
        .agg(
            F.sum("times_returned").alias("times_returned"),
            F.sum("times_sold").alias("times_sold"),
        )
        .withColumn("return_rate_pct", F.expr(_RETURN_PCT))
        .orderBy(F.col("return_rate_pct").desc_nulls_last(), "category")
    )


def fulfillment_chart(fulfillment: DataFrame) -> DataFrame:
    """Delivery days and on-time rate by carrier."""
    return fulfillment.select("carrier", "avg_days_to_deliver", "on_time_rate_pct").orderBy(
        F.col("avg_days_to_deliver").asc_nulls_last(), "carrier"
    )


def orders_by_channel(monthly: DataFrame) -> DataFrame:
    """Orders per channel over all months, one row per channel."""
    totals = monthly.agg(
        F.sum("web_orders").alias("Web"),
        F.sum("mobile_orders").alias("Mobile"),
        F.sum("instore_orders").alias("In-Store"),
    )
    return totals.unpivot([], ["Web", "Mobile", "In-Store"], "channel", "orders")


def top_categories(revenue: DataFrame, n: int = 5) -> DataFrame:
    """The ``n`` categories with most revenue."""
    return (
        revenue.orderBy(F.col("total_revenue").desc_nulls_first(), "category")
        .limit(n)
        .select("category", "total_revenue", "total_units_sold", "gross_margin_pct")
    )


def latest_months(monthly: DataFrame, n: int = 5) -> DataFrame:
    """The ``n`` newest months."""
    return (
        monthly.orderBy(F.col("month_label").desc_nulls_first())
        .limit(n)
        .select("month_label", "total_orders", "total_revenue", "avg_order_value")
    )
