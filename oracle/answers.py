"""One SQL text per registered query."""

from __future__ import annotations

from oracle.tables import RAW, SILVER, ask, cents, half_even, half_up, strip
from shopstrata.plans.quality import CHECKS

RUN_TIME = "TIMESTAMP '2024-01-02 00:00:00'"
HIGH, MID = 1_050_000, 800_000


def money(expr: str, name: str) -> str:
    return f"({expr})::DOUBLE AS {name}"


def mean_money(total: str, rows: str) -> str:
    return half_up(cents(total), f"100 * {rows}", 2)


# Profit of an item in millionths: quantities have four digits, costs two.
MICROS = """(line_total * 100)::HUGEINT * 10000 - (cost_price * 100)::HUGEINT * (quantity * 10000)::HUGEINT"""

GOLD = {
    "gold_revenue_by_category": f"""
        SELECT category,
               count(DISTINCT product_id) AS unique_products,
               sum(quantity)::DOUBLE AS total_units_sold,
               {money('sum(line_total)', 'total_revenue')},
               {mean_money('sum(i.unit_price)', 'count(i.unit_price)')} AS avg_unit_price,
               {half_up(f'sum({MICROS})', '1000000', 2)} AS total_gross_profit,
               {half_up(f'100 * sum({MICROS})', '10000 * ' + cents('sum(line_total)'), 1)}
                   AS gross_margin_pct
        FROM silver_order_items AS i
        JOIN silver_orders AS o USING (order_id)
        JOIN silver_products AS p USING (product_id)
        WHERE o.status = 'completed' OR o.status = 'shipped'
        GROUP BY category""",
    "gold_monthly_order_summary": f"""
        SELECT strftime(order_date, '%Y-%m') AS month_label,
               count(order_id) AS total_orders,
               count(DISTINCT customer_id) AS unique_customers,
               {money('sum(order_total)', 'total_revenue')},
               {mean_money('sum(order_total)', 'count(*)')} AS avg_order_value,
               count(*) FILTER (status = 'completed') AS completed_orders,
               count(*) FILTER (status = 'cancelled') AS cancelled_orders,
               {half_up("100 * count(*) FILTER (status = 'cancelled')", 'count(order_id)', 1)}
                   AS cancellation_rate_pct,
               count(*) FILTER (channel = 'web') AS web_orders,
               count(*) FILTER (channel = 'mobile') AS mobile_orders,
               count(*) FILTER (channel = 'in-store') AS instore_orders
        FROM silver_orders
        WHERE order_total IS NOT NULL AND order_date IS NOT NULL
        GROUP BY 1""",
    "gold_return_rate_by_product": f"""
        SELECT product_id, product_name, category, unit_price::DOUBLE AS unit_price, times_sold,
               total_units_sold, {money('revenue', 'total_revenue')},
               coalesce(n, 0) AS times_returned, {money('coalesce(refunds, 0)', 'total_refunded')},
               {half_up('100 * coalesce(n, 0)', 'times_sold', 1)} AS return_rate_pct
        FROM (SELECT product_id, product_name, category, p.unit_price, count(item_id) AS times_sold,
                     sum(quantity)::DOUBLE AS total_units_sold, sum(line_total) AS revenue
              FROM silver_order_items JOIN silver_products AS p USING (product_id)
              GROUP BY ALL)
        LEFT JOIN (SELECT product_id, count(item_id) AS n, sum(refund_amount) AS refunds
                   FROM silver_order_items
                   JOIN silver_products USING (product_id)
                   JOIN silver_returns AS r USING (order_id)
                   WHERE order_id IN (SELECT order_id FROM silver_returns
                                      WHERE status = 'approved')
                   GROUP BY product_id) USING (product_id)""",
    "gold_customer_lifetime_value": f"""
        SELECT customer_id, first_name, last_name, segment, state,
               coalesce(n_orders, 0) AS total_orders,
               {money('coalesce(spent, 0)', 'total_spent')},
               coalesce(mean, 0) AS avg_order_value, first_order_date, last_order_date,
               coalesce(n_returns, 0) AS total_returns,
               {money('coalesce(refunds, 0)', 'total_refunded')},
               CASE WHEN spent >= {HIGH} THEN 'High Value' WHEN spent >= {MID} THEN 'Mid Value'
                    ELSE 'Low Value' END AS value_tier
        FROM silver_customers
        LEFT JOIN (SELECT customer_id, count(order_id) AS n_orders, sum(order_total) AS spent,
                          {mean_money('sum(order_total)', 'count(*)')} AS mean,
                          min(order_date) AS first_order_date, max(order_date) AS last_order_date
                   FROM silver_orders WHERE order_total IS NOT NULL GROUP BY 1)
            USING (customer_id)
        LEFT JOIN (SELECT customer_id, count(return_id) AS n_returns, sum(refund_amount) AS refunds
                   FROM silver_returns JOIN silver_orders USING (order_id) GROUP BY 1)
            USING (customer_id)""",
    "gold_fulfillment_summary": f"""
        SELECT carrier, count(shipment_id) AS total_shipments,
               count(*) FILTER (status = 'delivered') AS delivered,
               count(*) FILTER (status = 'delayed') AS delayed,
               count(*) FILTER (status = 'lost') AS lost,
               {half_up('sum(actual_delivery - ship_date)', 'count(actual_delivery - ship_date)', 1)}
                   AS avg_days_to_deliver,
               {half_up('100 * count(*) FILTER (actual_delivery <= estimated_delivery)',
                        'count(actual_delivery <= estimated_delivery)', 1)} AS on_time_rate_pct,
               {half_up("100 * count(*) FILTER (status = 'delayed')", 'count(shipment_id)', 1)}
                   AS delay_rate_pct
        FROM silver_shipping_events WHERE NOT _invalid_ship_date GROUP BY carrier""",
}

SILVER_COLUMNS = {
    "products": "* REPLACE (unit_price::DOUBLE AS unit_price, cost_price::DOUBLE AS cost_price)",
    "orders": "* REPLACE (order_total::DOUBLE AS order_total)",
    "order_items": "* REPLACE (quantity::DOUBLE AS quantity, unit_price::DOUBLE AS unit_price, "
    "line_total::DOUBLE AS line_total)",
    "returns": "* REPLACE (refund_amount::DOUBLE AS refund_amount)",
}

DQ = {
    "dq_001": """
        SELECT order_id, count(*) AS occurrences FROM silver_orders
        GROUP BY order_id HAVING count(*) > 1""",
    "dq_002": """
        SELECT order_id, order_date, order_total::DOUBLE AS order_total FROM silver_orders
        WHERE coalesce(customer_id, 'nan') = 'nan'""",
    "dq_003": """
        SELECT return_id, order_id, return_date, refund_amount::DOUBLE AS refund_amount
        FROM silver_returns AS r
        WHERE NOT EXISTS (FROM silver_orders AS o WHERE o.order_id = r.order_id)""",
    "dq_004": """
        SELECT order_id, order_date, order_total::DOUBLE AS order_total, status
        FROM silver_orders AS o
        WHERE NOT EXISTS (FROM silver_order_items AS i WHERE i.order_id = o.order_id)""",
    "dq_005": """
        SELECT shipment_id, order_id, carrier, ship_date, actual_delivery,
               (actual_delivery - ship_date)::BIGINT AS days_diff
        FROM silver_shipping_events WHERE _invalid_ship_date""",
    "dq_006": """
        SELECT item_id, order_id, product_id, line_total::DOUBLE AS line_total
        FROM silver_order_items AS i
        WHERE NOT EXISTS (FROM silver_orders AS o WHERE o.order_id = i.order_id)""",
    "dq_007": """
        SELECT email, count(*) AS occurrences, min(customer_id) AS first_customer_id,
               max(customer_id) AS last_customer_id
        FROM silver_customers GROUP BY email HAVING count(*) > 1""",
    "dq_008": """
        SELECT product_id, product_name, unit_price::DOUBLE AS unit_price,
               cost_price::DOUBLE AS cost_price
        FROM silver_products WHERE unit_price IS NULL OR unit_price <= 0 OR cost_price > unit_price""",
    "dq_009": """
        SELECT order_id, order_date, status, customer_id
        FROM silver_orders WHERE order_total IS NULL""",
    "dq_010": """
        SELECT return_id, order_id, reason, status
        FROM silver_returns WHERE coalesce(refund_amount, 0) = 0""",
}

# The texts of the report are fixed values kept with the checks; only they are shared.
CHECK_LABELS = [(c.check_id, c.check_name, c.table, c.category, c.description) for c in CHECKS]


def _key(check_id: str) -> str:
    return check_id.lower().replace("-", "_")


REPORT_CTES = {
    f"hits_{_key(label[0])}": DQ[_key(label[0])] for label in CHECK_LABELS
} | {
    "report": " UNION ALL ".join(
        f"""SELECT {RUN_TIME} AS run_time, '{i}' AS check_id, '{name}' AS check_name,
               '{table}' AS "table", '{category}' AS category, '{text}' AS description,
               CASE WHEN count(*) > 0 THEN 'FAIL' ELSE 'PASS' END AS status,
               count(*) AS issue_count, NULL::VARCHAR AS message FROM hits_{_key(i)} """
        for i, name, table, category, text in CHECK_LABELS
    )
}


def _samples() -> str:
    keys = {
        "DQ-001": "order_id", "DQ-002": "order_id", "DQ-003": "return_id", "DQ-004": "order_id",
        "DQ-005": "shipment_id", "DQ-006": "item_id", "DQ-007": "email", "DQ-008": "product_id",
        "DQ-009": "order_id", "DQ-010": "return_id",
    }
    columns = {
        "DQ-001": "order_id occurrences",
        "DQ-002": "order_id order_date order_total",
        "DQ-003": "return_id order_id return_date refund_amount",
        "DQ-004": "order_id order_date order_total status",
        "DQ-005": "shipment_id order_id carrier ship_date actual_delivery days_diff",
        "DQ-006": "item_id order_id product_id line_total",
        "DQ-007": "email occurrences first_customer_id last_customer_id",
        "DQ-008": "product_id product_name unit_price cost_price",
        "DQ-009": "order_id order_date status customer_id",
        "DQ-010": "return_id order_id reason status",
    }
    amounts = {"order_total", "refund_amount", "line_total", "unit_price", "cost_price"}
    parts = []
    for check_id, key in keys.items():
        texts = [
            f"'{c}=' || coalesce({c}{'::DECIMAL(18,2)' if c in amounts else ''}::VARCHAR, 'NULL')"
            for c in columns[check_id].split()
        ]
        record = "concat_ws(', ', " + ", ".join(texts) + ")"
        parts.append(
            f"""SELECT '{check_id}' AS check_id, place AS sample_no, record
                FROM (SELECT {record} AS record, count(*) OVER () AS n,
                             row_number() OVER (ORDER BY {key} NULLS LAST, {record}) AS place
                      FROM hits_{_key(check_id)} )
                WHERE place <= 3 OR (n <= 5 AND place <= 5)"""
        )
    return " UNION ALL ".join(parts)


SERVING = {
    "kpi_summary": f"""
        SELECT (SELECT sum(total_revenue::DECIMAL(38,2)) FROM gold_monthly_order_summary )::DOUBLE
                   AS total_revenue,
               (SELECT sum(total_orders) FROM gold_monthly_order_summary )::BIGINT AS total_orders,
               (SELECT sum(avg_order_value::DECIMAL(18,2))::DOUBLE / count(avg_order_value)
                FROM gold_monthly_order_summary ) AS avg_aov_monthly_mean,
               (SELECT {half_even('100 * sum(times_returned)', 'sum(times_sold)', 1)}
                FROM gold_return_rate_by_product ) AS overall_return_pct,
               (SELECT count(DISTINCT customer_id) FROM silver_customers ) AS unique_customers""",
    "revenue_chart": """
        SELECT category, total_revenue, gross_margin_pct FROM gold_revenue_by_category""",
    "monthly_trend": """
        SELECT month_label, total_revenue, avg_order_value FROM gold_monthly_order_summary""",
    "top_customers": """
        SELECT first_name || ' ' || last_name AS customer, segment, total_orders, total_spent,
               value_tier
        FROM gold_customer_lifetime_value
        ORDER BY total_spent DESC NULLS LAST, customer_id LIMIT 10""",
    "return_rate_by_category": f"""
        SELECT category, sum(times_returned)::BIGINT AS times_returned,
               sum(times_sold)::BIGINT AS times_sold,
               {half_even('100 * sum(times_returned)', 'sum(times_sold)', 1)} AS return_rate_pct
        FROM gold_return_rate_by_product GROUP BY category""",
    "fulfillment_chart": """
        SELECT carrier, avg_days_to_deliver, on_time_rate_pct FROM gold_fulfillment_summary""",
    "orders_by_channel": """
        SELECT 'Web' AS channel, sum(web_orders)::BIGINT AS orders FROM gold_monthly_order_summary
        UNION ALL SELECT 'Mobile', sum(mobile_orders)::BIGINT FROM gold_monthly_order_summary
        UNION ALL SELECT 'In-Store', sum(instore_orders)::BIGINT FROM gold_monthly_order_summary""",
    "top_categories": """
        SELECT category, total_revenue, total_units_sold, gross_margin_pct
        FROM gold_revenue_by_category
        ORDER BY total_revenue DESC NULLS FIRST, category LIMIT 5""",
    "latest_months": """
        SELECT month_label, total_orders, total_revenue, avg_order_value
        FROM gold_monthly_order_summary ORDER BY month_label DESC LIMIT 5""",
}

FIRST_COLUMN = {
    "customers": "customer_id", "products": "product_id", "orders": "order_id",
    "order_items": "item_id", "returns": "return_id", "shipping_events": "shipment_id",
}


def _counts(layer: str, prefix: str, tables) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{layer}' AS layer, '{t}' AS "table", 'OK' AS status, count(*) AS "rows"
            FROM {prefix}{t} """
        for t in tables
    )


# The exact sums of each mart, as the pipeline module defines them.
TOTALS = " UNION ALL ".join(
    f"""SELECT '{mart}' AS mart, count(*) AS "rows",
               sum({' + '.join(f'{c}::DECIMAL(28,4)' for c in money.split())})::DOUBLE AS money,
               sum({' + '.join(f'{c}::DECIMAL(28,4)' for c in units.split())})::DOUBLE AS units FROM {mart} """
    for mart, money, units in [
        ("gold_revenue_by_category", "total_revenue total_gross_profit", "total_units_sold"),
        ("gold_monthly_order_summary", "total_revenue avg_order_value", "total_orders unique_customers"),
        ("gold_return_rate_by_product", "total_revenue total_refunded", "times_sold times_returned"),
        ("gold_customer_lifetime_value", "total_spent total_refunded", "total_orders total_returns"),
        ("gold_fulfillment_summary", "avg_days_to_deliver on_time_rate_pct", "total_shipments delayed"),
    ]
)

LOADS = {
    "bronze_metadata": " UNION ALL ".join(
        f"""SELECT {key} AS id, TIMESTAMP '2024-01-01 00:00:00' AS _ingest_timestamp,
               '{t}.csv' AS _source_file,
               (SELECT count(*) FROM raw_{t} ) AS _row_count FROM raw_{t} """
        for t, key in FIRST_COLUMN.items()
    ),
    "layer_row_counts": _counts("bronze", "raw_", RAW) + " UNION ALL "
    + _counts("silver", "silver_", SILVER),
    "load_totals": f"""
        SELECT layer, count(*) AS tables, sum("rows")::BIGINT AS total_rows
        FROM ({_counts("bronze", "raw_", RAW)}) GROUP BY layer""",
    "silver_metrics": """
        SELECT 'customers' AS "table", unnest(['rows_in', 'rows_out', 'duplicate_emails']) AS metric,
               unnest([count(*), count(*), count(*) FILTER (_is_duplicate_email)]) AS value
        FROM silver_customers
        UNION ALL
        SELECT 'products', unnest(['rows_in', 'rows_out']), unnest([count(*), count(*)])
        FROM silver_products
        UNION ALL
        SELECT 'orders',
               unnest(['rows_in', 'rows_out', 'duplicate_order_ids', 'missing_customer_id']),
               unnest([count(*), count(*), count(*) FILTER (_is_duplicate_order),
                       count(*) FILTER (customer_id IS NULL)])
        FROM silver_orders
        UNION ALL
        SELECT 'order_items', unnest(['rows_in', 'dropped_unlinked', 'rows_out']),
               unnest([count(*), count(*) - count(order_id), count(order_id)])
        FROM raw_order_items
        UNION ALL
        SELECT 'returns', unnest(['rows_in', 'rows_out']), unnest([count(*), count(*)])
        FROM silver_returns
        UNION ALL
        SELECT 'shipping_events', unnest(['rows_in', 'rows_out', 'invalid_ship_dates']),
               unnest([count(*), count(*), count(*) FILTER (_invalid_ship_date)])
        FROM silver_shipping_events""",
    "gold_export": f"SELECT * FROM ({TOTALS})",
    "pipeline_run": f"""
        SELECT layer, s."table", status, "rows", CASE WHEN layer <> 'quality' THEN 0 END::BIGINT AS rejected,
               money, units
        FROM ({_counts("bronze", "raw_", RAW)} UNION ALL {_counts("silver", "silver_", SILVER)}
              UNION ALL SELECT 'quality', 'dq_quality_log', 'OK', 10
              UNION ALL {_counts("gold", "", GOLD)}) s
        LEFT JOIN (SELECT mart AS "table", money, units FROM ({TOTALS})) t ON t."table" = s."table" """,
    "bronze_scan_multiline": """
        SELECT * REPLACE (CASE WHEN refund_amount IS NULL THEN reason || ',' || chr(10) || '"unclear"' || chr(10)
                               ELSE reason END AS reason)
        FROM raw_returns""",
    "bronze_rejects": """
        SELECT 'returns' AS "table", concat_ws(',', return_id, order_id, return_date, reason || ', unclear',
                                               status, '') AS record
        FROM raw_returns WHERE refund_amount IS NULL""",
}

SINGLES = {
    "filter_in_status": """
        SELECT order_id, status FROM silver_orders WHERE status IN ('completed', 'shipped')""",
    "join_items_products": """
        SELECT product_id, item_id, quantity::DOUBLE AS quantity, line_total::DOUBLE AS line_total, product_name,
               category, cost_price::DOUBLE AS cost_price
        FROM silver_order_items JOIN silver_products USING (product_id)""",
    "semi_approved_items": """
        SELECT item_id, order_id, product_id, line_total::DOUBLE AS line_total
        FROM silver_order_items
        WHERE order_id IN (SELECT order_id FROM silver_returns WHERE status = 'approved')""",
    "join_return_rows": """
        SELECT order_id, return_id, r.status, refund_amount::DOUBLE AS refund_amount, customer_id, order_date
        FROM silver_returns AS r JOIN silver_orders USING (order_id)""",
    "dq_007_members": """
        SELECT email, occurrences, customer_id
        FROM (SELECT *, count(*) OVER (PARTITION BY email) AS occurrences FROM silver_customers)
        WHERE occurrences > 1""",
    "dq_007_lists": """
        SELECT email, count(*) AS occurrences, string_agg(customer_id, ', ' ORDER BY customer_id) AS customer_ids
        FROM silver_customers GROUP BY email HAVING count(*) > 1""",
    "dq_007_parts": """
        SELECT email, any_value(occurrences) AS occurrences, place // 3 AS part, min(place) AS first,
               min(chars_before)::BIGINT AS "offset", string_agg(customer_id, ', ' ORDER BY place) AS customer_ids
        FROM (SELECT email, customer_id, count(*) OVER same AS occurrences,
                     row_number() OVER (same ORDER BY customer_id) - 1 AS place,
                     coalesce(sum(length(customer_id) + 2) OVER (
                         same ORDER BY customer_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS chars_before
              FROM silver_customers WINDOW same AS (PARTITION BY email))
        WHERE occurrences > 1 GROUP BY email, place // 3""",
    "join_returns_orders": """
        SELECT order_id, customer_id, count(*) // any_value(copies) AS return_rows,
               (sum(refund_amount) / any_value(copies))::DOUBLE AS refunded,
               any_value(copies) AS order_copies
        FROM silver_returns
        JOIN (SELECT *, count(*) OVER (PARTITION BY order_id, customer_id) AS copies
              FROM silver_orders) USING (order_id)
        GROUP BY order_id, customer_id""",
    "agg_count_distinct": """
        SELECT channel, count(DISTINCT customer_id) AS unique_customers, count(order_id) AS orders
        FROM silver_orders GROUP BY channel""",
    "agg_conditional": """
        SELECT channel, count(*) FILTER (status = 'completed') AS completed_orders,
               count(*) FILTER (status = 'shipped') AS shipped_orders,
               count(*) FILTER (status = 'processing') AS processing_orders,
               count(*) FILTER (status = 'cancelled') AS cancelled_orders
        FROM silver_orders GROUP BY channel""",
    "agg_rates": f"""
        SELECT warehouse,
               {half_up("100 * count(*) FILTER (status = 'delivered')", 'count(shipment_id)', 1)}
                   AS delivered_pct,
               {half_up("100 * count(*) FILTER (status = 'lost')",
                        "count(*) FILTER (status = 'delivered')", 1)} AS lost_per_delivered_pct
        FROM silver_shipping_events GROUP BY warehouse""",
    "distinct_approved_orders": """
        SELECT DISTINCT order_id FROM silver_returns WHERE status = 'approved'""",
    "value_tier": f"""
        SELECT customer_id,
               CASE WHEN sum(order_total) >= {HIGH} THEN 'High Value'
                    WHEN sum(order_total) >= {MID} THEN 'Mid Value' ELSE 'Low Value' END AS value_tier
        FROM silver_orders WHERE customer_id IS NOT NULL AND order_total IS NOT NULL
        GROUP BY customer_id""",
    "scalar_clean_text": f"""
        SELECT order_id, lower({strip('status')}) AS status, lower({strip('channel')}) AS channel
        FROM raw_orders""",
    "scalar_clean_names": f"""
        SELECT customer_id, {strip('first_name')} AS first_name, lower({strip('email')}) AS email
        FROM raw_customers""",
    "scalar_try_parse": """
        SELECT product_id, TRY_CAST(unit_price AS DECIMAL(18,2))::DOUBLE AS unit_price,
               TRY_CAST(cost_price AS DECIMAL(18,2))::DOUBLE AS cost_price,
               TRY_CAST(stock_qty AS BIGINT) AS stock_qty,
               TRY_CAST(is_active AS BOOLEAN) AS is_active
        FROM raw_products""",
    "scalar_try_parse_dates": """
        SELECT order_id, TRY_CAST(order_date AS DATE) AS order_date,
               TRY_CAST(discount_pct AS DOUBLE) AS discount_pct
        FROM raw_orders""",
    "scalar_dates": """
        SELECT shipment_id, date_trunc('month', ship_date)::DATE AS ship_month,
               strftime(ship_date, '%Y-%m') AS month_label,
               (actual_delivery - ship_date)::BIGINT AS days_to_deliver
        FROM silver_shipping_events""",
    "order_total_backfill": """
        SELECT order_id, order_total::DECIMAL(18,2)::DOUBLE AS order_total FROM raw_orders""",
}


def answers() -> dict[str, str]:
    """The SQL text of every registered query."""
    sql = {name: ask(body) for name, body in {**GOLD, **DQ, **SINGLES}.items()}
    for table in SILVER:
        sql[f"silver_{table}"] = ask(
            f"SELECT {SILVER_COLUMNS.get(table, '*')} FROM silver_{table}"
        )
    for table in ("customers", "orders"):
        sql[f"silver_{table}_stored"] = sql[f"silver_{table}"]
    sql["silver_order_items_rejects"] = ask(
        """SELECT item_id, order_id, product_id, quantity::DOUBLE AS quantity,
                  unit_price::DOUBLE AS unit_price, line_total::DOUBLE AS line_total
           FROM raw_order_items WHERE order_id IS NULL OR product_id IS NULL"""
    )
    for table in RAW:
        name = "bronze_scan" if table == "customers" else f"bronze_scan_{table}"
        sql[name] = ask(f"SELECT * FROM raw_{table}")
    LOADS["silver_metrics_written"] = LOADS["silver_metrics"]
    for name, body in {**SERVING, **LOADS}.items():
        sql[name] = ask(body, GOLD)
    sql["dq_report"] = ask("SELECT * FROM report", REPORT_CTES)
    sql["dq_summary"] = ask(
        """SELECT count(*) AS checks_run, count(*) FILTER (status = 'PASS') AS passed,
                  count(*) FILTER (status = 'FAIL') AS failed, 0::BIGINT AS errors,
                  sum(issue_count)::BIGINT AS total_issues,
                  count(*) FILTER (status = 'FAIL') = 0 AS all_passed FROM report""",
        REPORT_CTES,
    )
    sql["dq_latest"] = ask(
        """SELECT check_id AS "ID", check_name AS "Check", category AS "Category",
                  status AS "Status", issue_count AS "Issues Found" FROM report""",
        REPORT_CTES,
    )
    sql["dq_samples"] = ask(_samples(), REPORT_CTES)
    return sql
