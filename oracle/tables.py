"""The raw and Silver tables as SQL over the star schema, and helpers to put queries on them.

Written from the adapter rules, not from the Spark code: regular expressions for whitespace,
windows for duplicates, plain joins. That is fine here and would not be on a cluster.
"""

from __future__ import annotations

STRIP = r"regexp_replace({0}, '^\s+|\s+$', '', 'g')"


def strip(column: str) -> str:
    return STRIP.format(column)


def half_up(num: str, den: str, digits: int) -> str:
    """num/den rounded half away from zero with 128-bit integers; NULL when den is 0."""
    n, d = f"CAST({num} AS HUGEINT)", f"nullif(CAST({den} AS HUGEINT), 0)"
    scale = 10**digits
    return f"(sign({n}) * ((2 * abs({n}) * {scale} + {d}) // (2 * {d})))::DOUBLE / {scale}"


def half_even(num: str, den: str, digits: int) -> str:
    """num/den (both positive) rounded half to even with 128-bit integers."""
    scale = 10**digits
    n, d = f"(CAST({num} AS HUGEINT) * {scale})", f"nullif(CAST({den} AS HUGEINT), 0)"
    q, r = f"({n} // {d})", f"({n} % {d})"
    up = f"CASE WHEN 2 * {r} > {d} OR (2 * {r} = {d} AND {q} % 2 = 1) THEN 1 ELSE 0 END"
    return f"({q} + {up})::DOUBLE / {scale}"


def cents(amount: str) -> str:
    return f"CAST({amount} * 100 AS HUGEINT)"


RAW = {
    "customers": """
        SELECT 'CUST-' || c_custkey AS customer_id,
               CASE WHEN c_custkey % 11 = 0 THEN ' ' || chr(9) || 'First' || (c_custkey % 97) || '  '
                    ELSE 'First' || (c_custkey % 97) END AS first_name,
               'Last' || (c_custkey % 89) AS last_name,
               CASE WHEN c_custkey % 97 = 0 THEN NULL
                    WHEN c_custkey % 7 = 0
                    THEN upper('user' || (c_custkey - (c_custkey % 60 = 59)::INT) || '@example.com')
                    ELSE 'user' || (c_custkey - (c_custkey % 60 = 59)::INT) || '@example.com'
               END AS email,
               c_name AS phone,
               'NATION_' || c_nationkey AS city,
               'S' || c_nationkey AS state,
               lpad((c_custkey % 100000)::VARCHAR, 5, '0') AS zip_code,
               CASE WHEN c_custkey % 29 <> 0 THEN c_mktsegment END AS segment,
               CASE WHEN c_custkey % 211 = 0 THEN 'not-a-date'
                    ELSE (DATE '1994-01-01' + (c_custkey % 365)::INT)::VARCHAR END AS created_at
        FROM customer""",
    "products": """
        SELECT 'PROD-' || p_partkey AS product_id,
               CASE WHEN p_partkey % 13 = 0 THEN '  ' || p_name || ' ' ELSE p_name
               END AS product_name,
               p_type AS category,
               CASE WHEN p_partkey % 251 = 0 THEN 'abc'
                    ELSE p_retailprice::DECIMAL(18,2)::VARCHAR END AS unit_price,
               CASE WHEN p_partkey % 97 = 0 THEN p_retailprice::DECIMAL(18,2) + 1
                    ELSE p_retailprice::DECIMAL(18,2) - 400 - p_partkey % 100
               END::DECIMAL(18,2)::VARCHAR AS cost_price,
               CASE WHEN p_partkey % 17 <> 0 THEN p_size::VARCHAR END AS stock_qty,
               CASE WHEN p_partkey % 19 = 0 THEN NULL
                    WHEN p_partkey % 4 = 0 THEN 'False' ELSE 'True' END AS is_active
        FROM part""",
    "order_items": """
        SELECT 'ITEM-' || l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey
                   AS item_id,
               CASE WHEN (3 * l_orderkey + l_suppkey) % 997 = 0 THEN NULL
                    WHEN (l_orderkey + l_partkey) % 499 = 0 THEN 'ORD-GHOST-' || (l_partkey % 4)
                    ELSE 'ORD-' || l_orderkey END AS order_id,
               'PROD-' || l_partkey AS product_id,
               CASE WHEN (l_orderkey + l_linenumber) % 23 = 0 THEN (l_quantity - 0.5)::DECIMAL(10,1)::VARCHAR
                    ELSE l_quantity::INT::VARCHAR END AS quantity,
               p_retailprice::DECIMAL(18,2)::VARCHAR AS unit_price,
               ((l_quantity - CASE WHEN (l_orderkey + l_linenumber) % 23 = 0 THEN 0.5 ELSE 0 END)::DECIMAL(10,1)
                    * p_retailprice::DECIMAL(18,2))::DECIMAL(18,2)::VARCHAR AS line_total
        FROM lineitem JOIN part ON p_partkey = l_partkey""",
    "orders": """
        SELECT 'ORD-' || o_orderkey AS order_id,
               CASE WHEN o_orderkey % 101 <> 0 THEN 'CUST-' || o_custkey END AS customer_id,
               CASE WHEN o_orderkey % 307 = 0 THEN 'bad-date'
                    ELSE o_orderdate::DATE::VARCHAR END AS order_date,
               CASE WHEN o_orderkey % 9 = 0 THEN ' ' || upper(plain_status) || '  '
                    ELSE plain_status END AS status,
               CASE left(o_orderpriority, 1) WHEN '1' THEN 'web' WHEN '2' THEN 'web'
                    WHEN '3' THEN 'mobile' WHEN '4' THEN 'in-store' ELSE 'referral' END AS channel,
               ['card', 'transfer', 'wallet', 'voucher', 'cash'][o_custkey % 5 + 1]
                   AS payment_method,
               CASE WHEN o_orderkey % 13 <> 0 THEN (5 * (o_orderkey % 4))::VARCHAR END
                   AS discount_pct,
               paid::VARCHAR AS order_total
        FROM (SELECT *, CASE WHEN o_orderstatus = 'F' THEN 'completed'
                             WHEN o_orderstatus = 'O' AND o_orderkey % 2 = 0 THEN 'shipped'
                             WHEN o_orderstatus = 'O' THEN 'processing'
                             WHEN o_orderkey % 2 = 0 THEN 'completed'
                             ELSE 'cancelled' END AS plain_status
              FROM (FROM orders UNION ALL FROM orders WHERE o_orderkey % 167 = 0)) o
        LEFT JOIN (SELECT order_id AS bought, sum(line_total::DECIMAL(18,2))::DECIMAL(18,2) AS paid
                   FROM raw_order_items GROUP BY order_id) ON bought = 'ORD-' || o_orderkey""",
    "returns": """
        SELECT 'RET-' || l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey
                   AS return_id,
               CASE WHEN l_partkey % 53 = 0 THEN 'ORD-MISSING-' || (l_partkey % 5)
                    ELSE 'ORD-' || l_orderkey END AS order_id,
               (l_shipdate::DATE + (3 + l_partkey % 28)::INT)::VARCHAR AS return_date,
               'reason ' || chr(65 + (l_suppkey % 8)::INT) AS reason,
               ['approved', 'approved', 'pending', 'rejected'][l_suppkey % 4 + 1] AS status,
               CASE WHEN l_partkey % 41 <> 0 THEN l_extendedprice::DECIMAL(18,2)::VARCHAR END
                   AS refund_amount
        FROM lineitem WHERE l_returnflag = 'R'""",
    "shipping_events": """
        SELECT 'SHIP-' || l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey AS shipment_id,
               'ORD-' || l_orderkey AS order_id,
               ['UPS', 'FedEx', 'USPS', 'DHL', 'Amazon Logistics'][l_suppkey % 5 + 1] AS carrier,
               ['north', 'east', 'south', 'west', 'centre'][l_partkey % 5 + 1] AS warehouse,
               l_shipdate::DATE::VARCHAR AS ship_date,
               (l_shipdate::DATE + (3 + l_partkey % 5)::INT)::VARCHAR AS estimated_delivery,
               CASE WHEN l_partkey % 10 = 0 THEN NULL
                    WHEN l_partkey % 37 = 5 THEN (l_shipdate::DATE - 5)::VARCHAR
                    ELSE (l_shipdate::DATE + (1 + l_orderkey % 10)::INT)::VARCHAR
               END AS actual_delivery,
               ['delivered', 'delivered', 'delivered', 'in_transit', 'out_for_delivery', 'delayed',
                'lost'][l_orderkey % 7 + 1] AS status,
               'SHIP-' || l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey AS tracking_number
        FROM lineitem WHERE l_linenumber = 1 OR (l_linenumber = 2 AND l_orderkey % 4 = 0)""",
}

SILVER = {
    "customers": f"""
        SELECT *, count(*) OVER (PARTITION BY email) > 1 AS _is_duplicate_email
        FROM (SELECT customer_id, {strip('first_name')} AS first_name,
                     {strip('last_name')} AS last_name, lower({strip('email')}) AS email, phone,
                     {strip('city')} AS city, {strip('state')} AS state,
                     {strip('zip_code')} AS zip_code,
                     coalesce({strip('segment')}, 'Unknown') AS segment,
                     TRY_CAST(created_at AS DATE) AS created_at
              FROM raw_customers)""",
    "products": f"""
        SELECT product_id, {strip('product_name')} AS product_name,
               {strip('category')} AS category,
               TRY_CAST(unit_price AS DECIMAL(18,2)) AS unit_price,
               TRY_CAST(cost_price AS DECIMAL(18,2)) AS cost_price,
               coalesce(TRY_CAST(stock_qty AS BIGINT), 0) AS stock_qty,
               CASE WHEN is_active IS NULL THEN true ELSE TRY_CAST(is_active AS BOOLEAN) END AS is_active
        FROM raw_products""",
    "orders": f"""
        SELECT order_id, customer_id, TRY_CAST(order_date AS DATE) AS order_date,
               lower({strip('status')}) AS status, lower({strip('channel')}) AS channel,
               lower({strip('payment_method')}) AS payment_method,
               coalesce(TRY_CAST(discount_pct AS DOUBLE), 0) AS discount_pct,
               TRY_CAST(order_total AS DECIMAL(18,2)) AS order_total,
               customer_id IS NULL AS _missing_customer_id,
               count(*) OVER (PARTITION BY order_id) > 1 AS _is_duplicate_order
        FROM raw_orders""",
    "order_items": """
        SELECT item_id, order_id, product_id, TRY_CAST(quantity AS DECIMAL(18,4)) AS quantity,
               TRY_CAST(unit_price AS DECIMAL(18,2)) AS unit_price,
               TRY_CAST(line_total AS DECIMAL(18,2)) AS line_total
        FROM raw_order_items WHERE order_id IS NOT NULL AND product_id IS NOT NULL""",
    "returns": f"""
        SELECT return_id, order_id, TRY_CAST(return_date AS DATE) AS return_date,
               {strip('reason')} AS reason, lower({strip('status')}) AS status,
               coalesce(TRY_CAST(refund_amount AS DECIMAL(18,2)), 0) AS refund_amount
        FROM raw_returns""",
    "shipping_events": f"""
        SELECT *, coalesce(ship_date > actual_delivery, false) AS _invalid_ship_date
        FROM (SELECT shipment_id, order_id, {strip('carrier')} AS carrier, warehouse,
                     TRY_CAST(ship_date AS DATE) AS ship_date,
                     TRY_CAST(estimated_delivery AS DATE) AS estimated_delivery,
                     TRY_CAST(actual_delivery AS DATE) AS actual_delivery,
                     lower({strip('status')}) AS status, tracking_number
              FROM raw_shipping_events)""",
}


def ask(body: str, extra: dict[str, str] | None = None) -> str:
    """Put ``body`` on top of the raw and Silver tables it mentions (and ``extra`` CTEs)."""
    ctes = {f"raw_{n}": RAW[n] for n in ("order_items", *[t for t in RAW if t != "order_items"])}
    ctes |= {f"silver_{n}": sql for n, sql in SILVER.items()}
    ctes |= extra or {}
    needed: list[str] = []

    def need(sql: str) -> None:
        for name in ctes:
            if name not in needed and name in sql.replace(",", " ").replace(")", " ").split():
                need(ctes[name])
                needed.append(name)

    need(body)
    head = ",\n".join(f"{n} AS ({ctes[n]})" for n in needed)
    return f"WITH {head}\n{body}" if head else body
